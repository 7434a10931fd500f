"""Inputs that used to lose rows or depend on the session."""

from __future__ import annotations

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cohortline.operators.knn import impute_knn
from cohortline.operators.profile import histogram_by_label
from cohortline.operators.resample import resample
from cohortline.plans.training import stratified_split
from cohortline.sources import readers as rd
from cohortline.sources import writers as wr
from cohortline.session import shared_folder


@pytest.mark.parametrize("names", [("a.json", "b.json"), ("b.json", "a.json")])
def test_each_json_file_has_its_own_layout(spark, tmp_path, names):
    array, lines = names
    (tmp_path / array).write_text(json.dumps([{"k": 1}, {"k": 2}], indent=1))
    (tmp_path / lines).write_text('{"k": 3}\n{"k": 4}\n{"k": 5}\n')
    (tmp_path / "c.json").write_text('{\n "k": 6,\n "in": {"x": 7}\n}')
    (tmp_path / "D.CSV").write_text("k\n8\n")
    (tmp_path / "e.csv").write_text("k\n9\n")
    (tmp_path / "f.Jsonl").write_text('{"k": 10}\n')
    rows = rd.scan_auto(spark, str(tmp_path)).select(F.col("k").cast("int")).collect()
    assert sorted(r["k"] for r in rows) == [1, 2, 3, 4, 5, 6, 8, 9, 10]


def test_bad_records_by_choice(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"k": 1}\n{"k": \n')
    path = str(tmp_path / "x.jsonl")
    assert rd.scan_json(spark, path, "k int", lines=True).count() == 2
    assert rd.scan_json(spark, path, "k int", lines=True, mode="DROPMALFORMED").collect() == [(1,)]


def test_subjects_are_found_whatever_the_buckets(spark, tmp_path):
    rows = [(f"S{i}", dt.datetime(2024, 1, 1), "C", float(i)) for i in range(12)]
    events = spark.createDataFrame(rows, "subject_id string, timestamp timestamp_ntz, code string, numeric_value double")
    wr.write_events(events, str(tmp_path), buckets=8)
    assert all(wr.read_subject_events(spark, str(tmp_path), f"S{i}").count() == 1 for i in range(12))


@pytest.mark.parametrize("seconds", [3600, 7 * 3600, 86400])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_bins_follow_the_clock_of_the_data(spark, seconds, kind):
    times = ["2024-03-09 23:10:00", "2024-03-10 00:10:00", "2024-03-10 04:50:30.5", "2024-03-11 13:00:00"]
    rows = [(s, t, float(i)) for s in ("a", None) for i, t in enumerate(times)]
    before, got = spark.conf.get("spark.sql.session.timeZone"), []
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(rows, "patient_id string, t string, v double").withColumn("observation_date", F.col("t").cast(kind))
            out = resample(df.drop("t"), {"v": "mean"}, seconds=seconds)
            got.append(sorted((str(r[0]), r[1], r[2]) for r in out.select("patient_id", F.col("observation_date").cast("string"), "v").collect() if r[2] is not None))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == got[1] == got[2]
    assert len({r[0] for r in got[0]}) == 2 and got[0][0][1] < "2024-03-10"


def test_long_gaps_are_allowed_unless_forbidden(spark):
    rows = [("a", dt.datetime(2024, 1, 1), 1.0), ("a", dt.datetime(2024, 1, 3), 2.0)]
    df = spark.createDataFrame(rows, "patient_id string, observation_date timestamp_ntz, v double")
    assert resample(df, {"v": "mean"}).count() == 49
    with pytest.raises(Exception, match="gap of more than 10"):
        resample(df, {"v": "mean"}, max_gap_rows=10).count()


def test_many_labels(spark):
    df = spark.range(2500).select(F.col("id").alias("event_id"), (F.col("id") % 1250).alias("label"), F.col("id").cast("double").alias("v"))
    assert histogram_by_label(df, "v", "label", bins=2).count() == 2500
    sizes = stratified_split(df, label="label", exact=True).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in sizes} == {"train": 1250, "validation": 1250}  # of two rows one each


def test_split_of_rows_without_ids(spark):
    df = spark.range(400).select(F.lit(None).cast("string").alias("event_id"), F.col("id").alias("v"))
    assert stratified_split(df).groupBy("split").count().count() == 3
    assert stratified_split(df, train=0.5, validation=0.5).where("split = 'test'").count() == 0


def test_many_columns_for_nearest_rows(spark):
    names = [f"c{i}" for i in range(66)]
    rows = [tuple(float(i + j) if (i + j) % 7 or i % 5 else None for j in range(66)) for i in range(30)]
    out = impute_knn(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)), names, neighbors=3)
    assert out.count() == 30 and out.where(F.col("c65").isNull() | F.col("c0").isNull()).count() == 0


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(SimpleNamespace(sparkContext=context, conf=conf))
