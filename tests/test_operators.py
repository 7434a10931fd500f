"""Events, profiles, preparation, encodings on small frames with known answers."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from cohortline import defaults as D
from cohortline import fixtures as X
from cohortline.functions.scalar import band
from cohortline.operators import encode as en
from cohortline.operators import events as ev
from cohortline.operators import impute as im
from cohortline.operators import knn as kn
from cohortline.operators import outliers as ou
from cohortline.operators import profile as pf
from cohortline.operators import scale as sc
from cohortline.operators.chained import IterativeImputer
from cohortline.operators.knn import KnnImputer
from cohortline.operators.lookup import map_lookup
from cohortline.plans.features import FeatureSet
from cohortline.plans.preprocess import Preprocessor
from cohortline.plans.training import param_grid_table, stratified_split

WIDE = ("patient_id string, event_id long, observation_date timestamp, bmi double, glucose double, "
        "admission_type string, primary_diagnosis string, has_diabetes int, smoker int, readmission_30day int")


@pytest.fixture
def wide(spark):
    day = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([
        ("a", 2, day, 30.0, None, "Urgent", "CHF", 1, 0, 1),
        ("a", 1, day, 20.0, 90.0, "Urgent", "CHF", 1, 1, 0),
        ("b", 3, day, None, None, None, "COPD", 0, None, 0),
    ], WIDE)


def test_events_values_and_survivors(wide):
    found = {(r["subject_id"], r["code"]): r["numeric_value"] for r in ev.to_events(wide).collect()}
    assert found == {
        ("a", "VITAL/BMI"): 20.0, ("a", "LAB/GLUCOSE"): 90.0, ("a", "PROC/Urgent"): None, ("a", "DIAG/CHF"): None,
        ("a", "DIAG/DIABETES"): 1.0, ("a", "DIAG/SMOKER"): 1.0, ("b", "DIAG/COPD"): None}
    assert ev.to_events(wide, deduplicate=False).count() > len(found) > wide.count()


def test_events_without_subject_or_codes(wide):
    assert {r["subject_id"] for r in ev.to_events(wide.drop("patient_id")).collect()} == {"UNKNOWN"}
    assert ev.to_events(wide.select("patient_id", "event_id", "observation_date")).count() == 0


def test_validation_report(wide):
    events = ev.to_events(wide)
    assert ev.validate_events(events).first()["valid"]
    broken = ev.validate_events(events.withColumn("subject_id", F.lit(None).cast("string"))).first()
    assert not broken["valid"] and broken["null_subjects"] == events.count()
    partial = ev.validate_events(events.drop("code", "timestamp")).first()
    assert partial["missing_columns"] == "timestamp,code" and not partial["valid"]
    textual = ev.validate_events(events.withColumn("timestamp", F.lit("not a time"))).first()
    assert not textual["valid"] and textual["bad_timestamps"] == events.count()
    assert ev.validate_events(events.withColumn("timestamp", F.lit("2024-01-05 10:00:00"))).first()["valid"]


def test_columns_with_many_gaps_are_dropped(spark):
    df = spark.createDataFrame([(i, 1.0 if i == 0 else None, 1.0 if i < 2 else None) for i in range(10)], "i int, a double, b double")
    fitted = im.DropSparse.fit(df, 0.8)
    assert fitted.dropped == ("a",)  # 0.9 > 0.8, while 0.8 itself stays


@pytest.mark.parametrize("strategy, age", [("median", 45.0), ("mean", 130 / 3), ("mode", 25)])
def test_imputation(spark, strategy, age):
    df = spark.createDataFrame(
        [(25, "M"), (None, "F"), (45, None), (60, "F"), (None, "M")], "age int, gender string")
    out = im.Imputer.fit(df, ["age"], ["gender"], strategy).transform(df).collect()
    assert out[1]["age"] == pytest.approx(age) and out[4]["age"] == pytest.approx(age)
    assert out[2]["gender"] == "F"  # tie: the smaller one


def test_indicators_follow_the_fit(spark):
    train = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    fresh = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert im.MissingIndicators.fit(train, ["a", "b"]).transform(fresh).collect()[0].asDict() == {"a": None, "b": 1.0, "b_missing": 0}


def test_outlier_actions(spark):
    df = spark.createDataFrame([(float(v),) for v in (10, 11, 12, 13, 90)] + [(None,)], "x double")
    assert ou.bounds_iqr(df, ["x"]) == {"x": (8.0, 16.0)}
    clipped = [r["x"] for r in ou.Outliers.fit(df, ["x"]).transform(df).collect()]
    assert clipped == [10.0, 11.0, 12.0, 13.0, 16.0, None]
    flags = [r["x_outlier"] for r in ou.Outliers.fit(df, ["x"], action="flag").transform(df).collect()]
    assert flags == [0, 0, 0, 0, 1, 0]
    for sequential in (True, False):
        kept = ou.Outliers.fit(df, ["x"], action="remove", sequential=sequential).transform(df)
        assert kept.count() == 5


def test_sequential_removal_sees_fewer_rows(spark):
    values = [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (100.0, 30.0), (2.0, 12.0)]
    df = spark.createDataFrame(values, "a double, b double")
    bounds = ou.Outliers.fit(df, ["a", "b"], action="remove", sequential=True).bounds
    rest = np.array([b for a, b in values if a <= bounds["a"][1]])
    q1, q3 = np.quantile(rest, (0.25, 0.75))
    assert bounds["b"] == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))


def test_scalers_match_numpy(spark):
    values = np.array([1.0, 2.0, 3.0, 10.0])
    df = spark.createDataFrame([(float(v), 5.0) for v in values], "x double, flat double")
    wanted = {
        "standard": (values - values.mean()) / values.std(), "minmax": (values - 1) / 9,
        "robust": (values - 2.5) / (np.quantile(values, 0.75) - np.quantile(values, 0.25))}
    for method, want in wanted.items():
        out = sc.Scaler.fit(df, ["x", "flat"], method).transform(df).collect()
        assert [r["x"] for r in out] == pytest.approx(list(want)) and {r["flat"] for r in out} == {0.0}


def test_quantile_normal_is_monotone_and_bounded(spark):
    from statistics import NormalDist
    rng = np.random.default_rng(5)
    values = sorted(float(v) for v in rng.exponential(size=2000))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(9999, None)], "i long, x double")
    out = [r["x"] for r in sc.QuantileNormal.fit(df, ["x"]).transform(df).orderBy("i").collect()]
    assert out[-1] is None and out[0] == pytest.approx(-5.199, abs=1e-2) and out[1999] == pytest.approx(5.199, abs=1e-2)
    assert all(a <= b for a, b in zip(out[:2000], out[1:2000]))
    assert out[500] == pytest.approx(NormalDist().inv_cdf(500 / 1999), abs=5e-3)
    probe = spark.createDataFrame([(p,) for p in (1e-6, 0.01, 0.3, 0.5, 0.9, 1 - 1e-6)], "p double")
    for r in sc.inverse_normal(probe, {"z": F.col("p")}).collect():
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-6)


def _cats(spark):
    return spark.createDataFrame(
        [("x", 1), ("x", 0), ("y", 1), (None, 0), ("z", 1)], f"c string, {D.LABEL} int")


def test_encoders_on_unseen_values(spark):
    train, fresh = _cats(spark), spark.createDataFrame([("x",), ("new",), (None,)], "c string")
    assert [r["c"] for r in en.fit_label(train, ["c"]).transform(fresh).collect()] == [0, -1, -1]
    assert [r["c"] for r in en.fit_frequency(train, ["c"]).transform(fresh).collect()] == [0.5, 0.0, 0.0]
    assert [r["c"] for r in en.fit_target(train, ["c"]).transform(fresh).collect()] == pytest.approx([0.5, 0.6, 0.6])
    one_hot = en.OneHot.fit(train, ["c"]).transform(fresh).collect()
    assert [tuple(r) for r in one_hot] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]
    assert en.OneHot.fit(train, ["c"], max_categories=2).transform(fresh).columns == ["c"]


def test_target_without_label_is_frequency(spark):
    train = _cats(spark).drop(D.LABEL)
    assert en.fit_target(train, ["c"]).transform(train).first()["c"] == 0.5


@pytest.mark.parametrize("weight", [None, "n"])
def test_lookup_by_shuffle_equals_broadcast(spark, weight):
    left = spark.range(500).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 17).cast("string")).alias("c"))
    table = left.filter("c <> '5'").groupBy(F.col("c").alias("value")).agg(F.count("*").alias("n"), F.avg("id").alias("m"))
    values = {"m": -1.0}
    small = map_lookup(left, table, "c", values)
    large = map_lookup(left, table, "c", values, broadcast_rows=3, weight=weight, heavy=2)
    assert rows(small, "id") == rows(large, "id") and large.count() == 500


def test_out_of_fold_leaves_own_fold_out(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", int(i % 3 == 0)) for i in range(60)], f"event_id long, c string, {D.LABEL} int")
    import hashlib
    fold = lambda i: int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:8], 16) % 5
    for r in en.encode_target_oof(df, "c").collect():
        others = [int(i % 3 == 0) for i in range(60) if (i % 2 == 1) == (r["c"] == "a") and fold(i) != fold(r["event_id"])]
        assert r["c_oof"] == pytest.approx(sum(others) / len(others))


def test_band_edges(spark):
    df = spark.createDataFrame([(a,) for a in (0, 18, 119, 120, -1)] + [(None,)], "age int")
    left = [r[0] for r in df.select(band(F.col("age"))).collect()]
    right = [r[0] for r in df.select(band(F.col("age"), labels=D.AGE_RANGE_LABELS, right=True)).collect()]
    assert left == ["pediatric", "young_adult", "elderly", None, None, None]
    assert right == [None, "0-18", "80+", "80+", None, None]


def test_knn_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    data = np.round(rng.normal(size=(300, 4)), 3)
    data[rng.random((300, 4)) < 0.15] = np.nan
    data[100:200] = data[7]  # a third are copies of one row
    data[7:8] = data[100]
    df = spark.createDataFrame(
        [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(data)], "i long, a double, b double, c double, d double")
    got = {r["i"]: r for r in kn.impute_knn(df, ["a", "b", "c", "d"], neighbors=5, slice_rows=40).collect()}
    assert len(got) == 300
    for i, row in enumerate(data):
        for f in np.flatnonzero(np.isnan(row)):
            donors = []
            for j, other in enumerate(data):
                both = ~np.isnan(row) & ~np.isnan(other)
                if not np.isnan(other[f]) and both.any():
                    donors.append((4 * np.square(row[both] - other[both]).sum() / both.sum(), other[f]))
            donors.sort()
            want = np.mean([v for _, v in donors[:5]]) if donors else np.nanmean(data[:, f])
            limit = donors[4][0] if len(donors) > 5 else None
            tied = limit is not None and donors[5][0] == limit and donors[5][1] != donors[4][1]
            assert tied or got[i]["abcd"[f]] == pytest.approx(want), (i, f)


@pytest.mark.parametrize("strategy", ["knn", "iterative"])
def test_preprocessor_reuses_fitted_models(spark, folder, strategy):
    """New rows take their values from the rows and regressions of the fit."""
    wide = X.encounters(spark, folder).select("event_id", "patient_id", "bmi", "glucose", "heart_rate", "admission_type", "readmission_30day").cache()
    old, new = wide.filter("event_id % 3 != 0"), wide.filter("event_id % 3 = 0")
    chosen = ("bmi", "glucose", "heart_rate")
    made = Preprocessor(numeric=chosen, categorical=("admission_type",), strategy=strategy, outlier_method="", scaling="", encoding="frequency").fit(old)
    kind = KnnImputer if strategy == "knn" else IterativeImputer
    want = {r["event_id"]: r for r in kind.fit(old, chosen).transform(new).collect()}
    for r in made.transform(new).collect():
        assert [r[c] for c in chosen] == pytest.approx([want[r["event_id"]][c] for c in chosen]) and r["bmi_missing"] in (0, 1)


def test_event_field_names(wide):
    names = ["person", "at", "what", "value"]
    renamed = ev.to_events(wide, names=names)
    assert renamed.columns == names and sorted(map(str, renamed.collect())) != []
    assert rows(renamed, *names) == rows(ev.to_events(wide), *ev.EVENT_COLUMNS)


def test_age_bands_of_a_feature_set(spark):
    df = spark.createDataFrame([(5,), (40,), (95,)], "age int")
    out = FeatureSet(age_edges=(0, 30, 60), age_labels=("young", "old")).transform(df)
    assert [(r["age_grp_young"], r["age_grp_old"]) for r in out.collect()] == [(1, 0), (0, 1), (0, 0)]


def test_defaults_and_ranges(spark):
    df = spark.createDataFrame([(1, 50, None, 300.0), (2, None, 25.0, 100.0)], "event_id long, age int, bmi double, glucose double")
    filled = pf.fill_defaults(df)
    assert filled.columns == ["event_id", *D.FIELD_RULES] and filled.first()["bmi"] == 26.0 and filled.first()["temperature"] == 98.6
    good, bad = pf.split_valid(df.withColumn("glucose", F.col("glucose") * 3))
    assert good.count() == 0 and {r["event_id"]: r["invalid_fields"] for r in bad.collect()} == {1: ["glucose"], 2: ["age"]}
    with pytest.raises(ValueError):
        pf.fill_defaults(df.drop("age"))


def test_null_to_zero_and_unknown_subject(spark):
    df = spark.createDataFrame([("a", float("nan"), None), ("b", None, 2)], "patient_id string, x double, n int")
    assert rows(pf.null_to_zero(df), "patient_id") == [("a", 0.0, 0), ("b", 0.0, 2)]
    with pytest.raises(ValueError):
        pf.filter_subject(df, "nobody")


def test_preprocessor_contract(spark, folder):
    wide = X.encounters(spark, folder).cache()
    with pytest.raises(RuntimeError, match="call fit first"):
        Preprocessor().transform(wide)
    fitted = Preprocessor().fit(wide)
    once, again = fitted.transform(wide), fitted.transform(wide)
    assert once.count() == wide.count() and rows(once, "event_id")[:50] == rows(again, "event_id")[:50]
    names = [c for c in D.NUMERIC if c in once.columns]
    nulls = once.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    assert set(nulls) == {0}
    serving = fitted.transform(wide.limit(3).withColumn("admission_type", F.lit("never seen")))
    assert serving.count() == 3 and set(serving.columns) == set(once.columns)


@pytest.mark.parametrize("options", [
    {"encoding": "onehot", "scaling": "minmax", "outlier_method": "zscore"},
    {"encoding": "label", "scaling": "robust", "outlier_method": "winsorize", "outlier_action": "flag"},
    {"encoding": "frequency", "strategy": "mean", "outlier_action": "remove", "scaling": "quantile"},
])
def test_preprocessor_variants(spark, folder, options):
    wide = X.encounters(spark, folder).cache()
    out = Preprocessor(**options, features=FeatureSet(rolling_windows=(6,))).fit_transform(wide)
    assert 0 < out.count() <= wide.count() and "heart_rate_rolling_mean_6" in out.columns and "charlson_index" in out.columns


def test_derived_features_see_ages_in_years(spark, folder):
    wide = X.encounters(spark, folder).cache()
    natural = Preprocessor(features=FeatureSet(rolling=False, diffs=False)).fit_transform(wide)
    late = Preprocessor(features=FeatureSet(rolling=False, diffs=False), reference_order=True).fit_transform(wide)
    assert natural.agg(F.max("age_grp_senior")).first()[0] == 1
    assert late.agg(F.max("age_grp_senior")).first()[0] == 0  # scaled ages fall into the first band or none


def test_split_shares_and_stability(spark):
    df = spark.range(4000).select(F.col("id").alias("event_id"), (F.col("id") % 4 == 0).cast("int").alias(D.LABEL))
    shares = {(r[0], r[1]): r[2] for r in stratified_split(df).groupBy("split", D.LABEL).count().collect()}
    assert 630 < shares["train", 1] < 770 and 1980 < shares["train", 0] < 2220
    for how in ({}, {"max_rows": 100}):
        exact = stratified_split(df, exact=True, **how)
        counts = {(r[0], r[1]): r[2] for r in exact.groupBy("split", D.LABEL).count().collect()}
        assert counts == {("train", 1): 700, ("validation", 1): 150, ("test", 1): 150,
                          ("train", 0): 2100, ("validation", 0): 450, ("test", 0): 450}


def test_param_grid_numbering(spark):
    lists = spark.sql("SELECT array(0.1, 0.2) AS `training.rate`, array(16, 32, 64) AS size")
    found = rows(param_grid_table(lists, ("training.rate", "size")), "run_index")
    assert [r[0] for r in found] == [1, 2, 3, 4, 5, 6]
    assert found[3][1] == {"training.rate": "0.2", "size": "16"} and found[3][2] == '{"training":{"rate":0.2},"size":16}'


def test_histogram_of_a_flat_label(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (0, 0.0), (0, 30.0)], f"{D.LABEL} int, x double")
    found = {(r["label"], r["bin"]): r["n"] for r in pf.histogram_by_label(df, "x").collect()}
    assert found == {(1, 15): 2, (0, 0): 1, (0, 29): 1}
