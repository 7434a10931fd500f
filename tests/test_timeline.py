"""Timeline windows: long subjects in slices must equal the plain windows."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from conftest import rows
from cohortline.operators import timeline as tl
from cohortline.operators.resample import resample, resample_fill, sequence_dataset
from cohortline.operators.rolling import rolling_time


@pytest.fixture(scope="module")
def skewed(spark):
    """One subject holds most rows; ties in time, null times, a null subject."""
    rng = np.random.default_rng(11)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(1200):
        subject = "hot" if rng.random() < 0.6 else (None if rng.random() < 0.05 else f"s{rng.integers(0, 40)}")
        at = None if rng.random() < 0.03 else start + dt.timedelta(hours=int(rng.integers(0, 400)))
        value = None if rng.random() < 0.3 else float(rng.integers(0, 100))
        data.append((subject, i, at, value, float(rng.integers(0, 9)), int(rng.random() < 0.3)))
    df = spark.createDataFrame(
        data, "patient_id string, event_id long, observation_date timestamp, heart_rate double, glucose double, readmission_30day int")
    return df.repartition(5).cache()


CUT = {"max_rows": 100, "slice_rows": 37}


def same(a, b, *order):
    a, b = rows(a, *order), rows(b, *order)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y) if not any(isinstance(v, (str, type(None), dt.datetime, list)) for v in x + y) else all(
            (p == q) or (isinstance(p, float) and p == pytest.approx(q)) for p, q in zip(x, y)), (x, y)


def test_rolling_in_slices(skewed):
    stats = ("mean", "std", "min", "max")
    plain = tl.rolling_features(skewed, ("heart_rate", "glucose"), (6, 48), stats, max_rows=None)
    cut = tl.rolling_features(skewed, ("heart_rate", "glucose"), (6, 48), stats, **CUT)
    same(plain, cut, "event_id")


def test_diff_in_slices(skewed):
    same(tl.diff_features(skewed, max_rows=None), tl.diff_features(skewed, **CUT), "event_id")


def test_slices_shorter_than_the_window(skewed):
    plain = tl.rolling_features(skewed, ("glucose",), (48,), ("mean",), max_rows=None)
    cut = tl.rolling_features(skewed, ("glucose",), (48,), ("mean",), max_rows=100, slice_rows=9)
    same(plain, cut, "event_id")


@pytest.mark.parametrize("method", ["ffill", "bfill", "both"])
def test_fill_in_slices(skewed, method):
    same(tl.fill_gaps(skewed, ["heart_rate"], method, max_rows=None),
         tl.fill_gaps(skewed, ["heart_rate"], method, **CUT), "event_id")


def test_interpolate_in_slices(skewed):
    same(tl.interpolate(skewed, ["heart_rate"], max_rows=None),
         tl.interpolate(skewed, ["heart_rate"], **CUT), "event_id")


def test_carry_over_slices_without_any_value(spark):
    start = dt.datetime(2024, 1, 1)
    data = [("a", i, start + dt.timedelta(hours=i), 1.0 if i == 0 else 200.0 if i == 199 else None) for i in range(200)]
    df = spark.createDataFrame(data, "patient_id string, event_id long, observation_date timestamp, v double")
    found = rows(tl.interpolate(df, ["v"], max_rows=50, slice_rows=20), "event_id")
    assert [r[3] for r in found] == pytest.approx([float(i + 1) for i in range(200)])


def test_sequences_in_slices(skewed):
    order = ("observation_date", "event_id")
    keyed = skewed.filter("observation_date is not null")
    made = [
        tl.sliding_sequences(keyed, ("glucose", "event_id"), lookback=5, horizon=3, stride=stride, order=order, **how)
        for stride in (1, 2) for how in ({"max_rows": None}, CUT)
    ]
    for plain, cut in (made[:2], made[2:]):
        pick = lambda df: sorted((r["patient_id"] or "", str(r["sequence"]), r["target"]) for r in df.collect())
        assert pick(plain) == pick(cut) and pick(plain)


def test_rolling_against_pandas(skewed):
    pdf = skewed.filter("patient_id is not null and observation_date is not null").toPandas()
    pdf = pdf.sort_values(["patient_id", "observation_date", "event_id"])
    want = pdf.groupby("patient_id")["heart_rate"].transform(lambda s: s.rolling(6, min_periods=1).mean())
    std = pdf.groupby("patient_id")["heart_rate"].transform(lambda s: s.rolling(6, min_periods=1).std()).fillna(0)
    got = tl.rolling_features(
        skewed.filter("patient_id is not null and observation_date is not null"), ("heart_rate",), (6,)
    ).toPandas().set_index("event_id").loc[pdf["event_id"]]
    assert np.allclose(got["heart_rate_rolling_mean_6"].astype(float), want, equal_nan=True)
    assert np.allclose(got["heart_rate_rolling_std_6"], std)


def test_rolling_time_against_pandas(skewed):
    clean = skewed.filter("patient_id is not null and observation_date is not null")
    pdf = clean.toPandas().sort_values(["patient_id", "observation_date", "event_id"]).reset_index(drop=True)
    got = rolling_time(clean, ("glucose",), (6, 30)).toPandas().set_index("event_id").loc[pdf["event_id"]]
    for hours in (6, 30):
        want = []
        for _, row in pdf.iterrows():
            at = row["observation_date"]
            near = pdf[(pdf["patient_id"] == row["patient_id"]) & (pdf["observation_date"] <= at)
                       & (pdf["observation_date"] > at - pd.Timedelta(hours=hours))]
            want.append(near["glucose"].mean())
        assert np.allclose(got[f"glucose_rolling_mean_{hours}h"], want)
    assert len(got) == len(pdf)


def test_interpolation_edges_and_all_null(spark):
    start = dt.datetime(2024, 1, 1)
    values = {"a": [None, 2.0, None, None, 8.0, None], "b": [None] * 3}
    data = [(s, i, start + dt.timedelta(hours=i), v) for s, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "patient_id string, event_id long, observation_date timestamp, v double")
    found = rows(tl.interpolate(df, ["v"]), "patient_id", "event_id")
    assert [r[3] for r in found] == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0, None, None, None]


def _stays(spark):
    start = dt.datetime(2024, 1, 1, 0, 20)
    data = [("a", 1, start, 10.0, 0, "x"), ("a", 2, start + dt.timedelta(minutes=30), 20.0, 1, None),
            ("a", 3, start + dt.timedelta(hours=3), 40.0, 1, "z"), ("b", 4, start, None, 0, "y")]
    return spark.createDataFrame(
        data, "patient_id string, event_id long, observation_date timestamp_ntz, v double, readmission_30day int, kind string")


HOW = {"v": "mean", "readmission_30day": "last", "kind": "last"}


def test_resample_bins_and_gaps(spark):
    found = rows(resample(_stays(spark), HOW), "patient_id", "observation_date")
    assert [(r[0], r[1].hour, *r[2:]) for r in found] == [
        ("a", 0, 15.0, 1, "x"), ("a", 1, None, None, None), ("a", 2, None, None, None), ("a", 3, 40.0, 1, "z"),
        ("b", 0, None, 0, "y")]


def test_resample_fill_keeps_labels_whole(spark):
    found = rows(resample_fill(_stays(spark), HOW), "patient_id", "observation_date")
    assert [r[2] for r in found] == pytest.approx([15.0, 15.0 + 25 / 3, 15.0 + 50 / 3, 40.0, None])
    assert [r[3] for r in found] == [1, 1, 1, 1, 0] and [r[4] for r in found] == ["x", "x", "x", "z", "y"]


def test_resample_origin_is_the_first_midnight(spark):
    start = dt.datetime(2024, 1, 2, 7)
    df = spark.createDataFrame([("a", 1, start, 1.0), ("a", 2, start + dt.timedelta(days=1), 2.0)],
                               "patient_id string, event_id long, observation_date timestamp, v double")
    found = rows(resample(df, {"v": "mean"}, seconds=5 * 3600), "observation_date")
    want = pd.Series([1.0, 2.0], index=pd.to_datetime([start, start + dt.timedelta(days=1)])).resample("5h").mean()
    assert [r[1] for r in found] == [t.to_pydatetime() for t in want.index]
    assert [r[2] for r in found] == [None if np.isnan(v) else v for v in want]


def test_resample_reports_impossible_gaps(spark):
    df = spark.createDataFrame([("a", 1, dt.datetime(1900, 1, 1), 1.0), ("a", 2, dt.datetime(2024, 1, 1), 2.0)],
                               "patient_id string, event_id long, observation_date timestamp, v double")
    with pytest.raises(Exception, match="check timestamps"):
        resample(df, {"v": "mean"}, max_gap_rows=1_000_000).count()


def test_sequence_shapes(spark):
    start = dt.datetime(2024, 1, 1)
    data = [(p, 100 * p + i, start + dt.timedelta(hours=i), float(i), i % 2) for p, n in ((1, 10), (2, 7)) for i in range(n)]
    df = spark.createDataFrame(data, "patient_id long, event_id long, observation_date timestamp, v double, readmission_30day int")
    made = rows(sequence_dataset(df, {"v": "mean", "readmission_30day": "last"}, ("v",), lookback=5, horizon=3),
                "patient_id", "start_time")
    assert len(made) == 3  # ten rows give three windows, seven rows none
    assert [[x[0] for x in r[4]] for r in made] == [[0.0 + i, 1.0 + i, 2.0 + i, 3.0 + i, 4.0 + i] for i in range(3)]
    assert [r[5] for r in made] == [1.0, 0.0, 1.0]


def test_rolling_time_in_levels(skewed):
    """Chunks summed by instant, second and hour equal the plain windows."""
    from pyspark.sql import functions as F

    # Instants of one hour, ties, seconds on both sides of a window's open end.
    shift = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.pmod(F.hash("event_id"), F.lit(4)) * 1_000_001)
    fine = skewed.withColumn("observation_date", F.timestamp_micros(
        F.unix_micros("observation_date") + shift - F.when(F.col("event_id") % 5 == 0, 3_600_000_000).otherwise(0)))
    stats = ("mean", "std", "min", "max")
    plain = rolling_time(fine, ("heart_rate", "glucose"), (1, 6, 30), stats, max_rows=None)
    cut = rolling_time(fine, ("heart_rate", "glucose"), (1, 6, 30), stats, max_rows=12)
    assert cut.dtypes == plain.dtypes
    same(plain, cut, "event_id")


@pytest.mark.parametrize("seconds", [3600, 7 * 3600])
def test_grids_in_slices(skewed, seconds):
    how = {"heart_rate": "mean", "glucose": "max", "readmission_30day": "last"}
    by = ("patient_id", "observation_date")
    for make in (resample, resample_fill):
        same(make(skewed, how, seconds=seconds, max_rows=None), make(skewed, how, seconds=seconds, **CUT), *by)


def test_sequences_of_grids_in_slices(skewed):
    how = {"heart_rate": "mean", "readmission_30day": "last"}
    made = [sequence_dataset(skewed, how, ("heart_rate",), lookback=20, horizon=5, **limit) for limit in ({"max_rows": None}, CUT)]
    same(*made, "patient_id", "label_time")


def test_long_gaps_in_blocks(spark):
    start = dt.datetime(2024, 1, 1)
    data = [("a", 0, start, 0.0), ("a", 1, start + dt.timedelta(hours=10_000), 10_000.0), ("b", 2, start, 1.0)]
    df = spark.createDataFrame(data, "patient_id string, event_id long, observation_date timestamp, v double")
    found = rows(resample_fill(df, {"v": "mean"}), "patient_id", "observation_date")
    assert [r[2] for r in found] == pytest.approx([float(i) for i in range(10_001)] + [1.0])
    assert [r[1] for r in found[:-1]] == [start + dt.timedelta(hours=i) for i in range(10_001)]
