"""JSON arrays cut into byte ranges give the records of the whole file."""

from __future__ import annotations

import json
import random

import pytest

from cohortline.sources.arrays import array_records, write_array
from cohortline.sources.readers import scan_json

SCHEMA = "id bigint, text string, more struct<a:array<struct<n:int>>, s:string>"


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def made(n: int) -> list[dict]:
    rng = random.Random(3)
    signs = ["{", "}", "[", "]", '"', "\\", "\\\\", ",", "é", "\n", "},{", '"}', " word "]
    items = []
    for i in range(n):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(0, 30 if i % 50 else 1500)))
        items.append({"id": i, "text": text, "more": {"a": [{"n": k} for k in range(rng.randrange(4))], "s": "}" * (i % 3)}})
    return items


def ids(df):
    return sorted((r["id"], r["text"], [x["n"] for x in r["more"]["a"]], r["more"]["s"]) for r in df.collect())


@pytest.mark.parametrize("layout", [{"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_ranges_equal_the_whole_file(spark, tmp_path, small_ranges, layout):
    items = made(300)
    (tmp_path / "a.json").write_text(json.dumps(items, **layout), encoding="utf-8")
    (tmp_path / "b.json").write_text(" [ ] ")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text(json.dumps([{"id": 1000, "text": None, "more": {"a": [], "s": "x"}}, 7, "a{b", None]))
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json"))
    assert pieces.rdd.getNumPartitions() > 20       # one file, many tasks
    found = scan_json(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema)
    want = [(r["id"], r["text"], [x["n"] for x in r["more"]["a"]], r["more"]["s"]) for r in items]
    assert sorted(ids(found.where("id < 1000"))) == sorted(want)
    assert found.where("id = 1000").count() == 1 and found.count() == 301


def test_one_record_over_many_ranges(spark, tmp_path, small_ranges):
    long = "{[" * 4000 + '"\\'
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "text": "x"}, {"id": 2, "text": long}, {"id": 3, "text": "}"}]))
    found = scan_json(spark, str(tmp_path / "a.json"), spark.createDataFrame([], "id int, text string").schema)
    assert sorted(map(tuple, found.collect())) == [(1, "x"), (2, long), (3, "}")]


def test_lone_objects(spark, tmp_path, small_ranges):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text("\n" * i + json.dumps({"id": i, "more": {"a": [{"n": k} for k in range(400)]}, "text": "}"}, indent=1))
    found = scan_json(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema)
    assert sorted((r["id"], r["text"], len(r["more"]["a"])) for r in found.collect()) == [(i, "}", 400) for i in range(3)]


def test_unreadable_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": oops}, {"id": 3}]')
    schema = spark.createDataFrame([], "id int").schema
    read = lambda mode: [r["id"] for r in scan_json(spark, str(tmp_path / "a.json"), schema, mode=mode).collect()]
    assert sorted(read("PERMISSIVE"), key=str) == [1, 3, None] and sorted(read("DROPMALFORMED")) == [1, 3]
    with pytest.raises(Exception):
        read("FAILFAST")


def test_written_arrays_are_read_again(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(made(100), SCHEMA).repartition(3).withColumn("at", F.timestamp_micros(F.col("id") * 1_000_001))
    write_array(df, str(tmp_path / "out"))
    texts = array_records(spark, str(tmp_path / "out"))
    assert texts.count() == 100
    found = scan_json(spark, str(tmp_path / "out"), df.schema)
    assert ids(found) == ids(df) and found.where("at = timestamp_micros(id * 1000001)").count() == 100
    for file in (tmp_path / "out").glob("part-*"):
        json.loads(file.read_text(encoding="utf-8"))
