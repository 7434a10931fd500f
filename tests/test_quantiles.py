from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from cohortline.functions import quantiles as qt
from cohortline.functions.quantiles import exact_quantiles, landmarks, running_sums
from cohortline.plans import evaluation as ev


def frame(spark, n=5000):
    rng = np.random.default_rng(3)
    columns = {
        "wide": rng.normal(size=n) * np.exp(rng.normal(size=n) * 20),
        "heavy": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 50, n)).astype(float),
        "tight": 1 + rng.integers(0, 900, n) * 1e-12,
        "gaps": np.where(np.arange(n) % 9 == 0, np.nan, rng.exponential(size=n)),
        "same": np.full(n, -2.5),
    }
    rows = [tuple(None if c == "gaps" and math.isnan(v[i]) else float(v[i]) for c, v in columns.items()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(7)
    return df, {c: v[~np.isnan(v)] for c, v in columns.items()}


@pytest.mark.parametrize("options", [{}, {"levels": 8, "most": 40}, {"levels": 2, "most": 1}])
def test_selection_equals_numpy(spark, options):
    """Small bounds force several rounds of narrowing, and ranges that ties keep from narrowing."""
    df, values = frame(spark)
    probabilities = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    found = exact_quantiles(df, list(values), probabilities, **options)
    for name, v in values.items():
        assert found[name] == pytest.approx(list(np.quantile(v, probabilities)), rel=1e-12), name


def test_a_wrong_outline_only_costs_a_pass(spark, monkeypatch):
    df, values = frame(spark, 600)
    monkeypatch.setattr(qt, "_enclosed", lambda outline, first, last: (float(outline[1][-2]), float(outline[1][-1])))
    found = exact_quantiles(df, ["wide", "heavy"], (0.1, 0.5))
    for name in found:
        assert found[name] == pytest.approx(list(np.quantile(values[name], (0.1, 0.5))), rel=1e-12)


def test_integers_nan_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), None), (2, 1.0, None), (3, 5.0, None), (10, float("nan"), None)], "a int, b double, c double")
    found = exact_quantiles(df, ["a", "b", "c"], (0.0, 0.5, 1.0))
    assert found["a"] == [1.0, 2.5, 10.0] and found["c"] == [None] * 3
    assert found["b"][0] == 1.0 and math.isnan(found["b"][1]) and math.isnan(found["b"][2])
    assert exact_quantiles(df.limit(0), ["a"], (0.5,)) == {"a": [None]} and exact_quantiles(df, [], (0.5,)) == {}


def test_sketches_are_not_merged_in_one_task(spark, monkeypatch):
    df, _ = frame(spark, 200)
    plans = []
    kind = type(df)
    original = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: (plans.append(plan_of(self)), original(self))[1])
    exact_quantiles(df, ["wide", "heavy"], (0.25, 0.5))
    sketches = [p for p in plans if "percentile_approx" in p]
    assert sketches and not any("SinglePartition" in p for p in sketches)


@pytest.mark.parametrize("points", [1000, 7, 2])
def test_landmarks_equal_numpy(spark, points):
    df, values = frame(spark, 1500)
    found = landmarks(df, list(values), points)
    for name, v in values.items():
        assert found[name] == pytest.approx(list(np.quantile(v, np.linspace(0, 1, points))), rel=1e-9), name
    few = landmarks(df.limit(3), ["wide"], 1000)["wide"]
    assert len(few) == 3 and landmarks(df.limit(0), ["wide"], 5) == {}


def test_running_sums_over_ranges(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), float(v), int(n)) for g, v, n in zip(rng.integers(0, 3, 400), rng.permutation(400), rng.integers(1, 9, 400))]
    df = spark.createDataFrame(rows, "g int, v double, n long")
    found = {(r["g"], r["v"]): r["n_upto"] for r in running_sums(df, [F.desc("v")], ["n"], ["g"]).collect()}
    assert found == {(g, v): sum(n for a, b, n in rows if a == g and b >= v) for g, v, _ in rows}


def test_scores_within_a_millionth_are_spread(spark):
    """All scores in one narrow range still go to several windows, and the curve is that of all pairs."""
    rng = np.random.default_rng(9)
    score, label = 0.5 + rng.integers(0, 700, 3000) * 1e-9, rng.integers(0, 2, 3000)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(score, label)], "probability double, label int")
    pos, neg = score[label == 1], score[label == 0]
    want = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    assert ev.auc_roc(df).first()[0] == pytest.approx(want, abs=1e-12)
    order = [F.desc("score")]
    spread = running_sums(ev._by_score(df, "label", "probability"), order, ["pos"])
    assert "SinglePartition" not in plan_of(spread.select("pos_upto")).split("_range")[0]


def test_what_gives_the_columns_is_computed_once(spark):
    """Several passes narrow the ranges; the rows before them are made in one."""
    df, values = frame(spark, 600)
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    found = exact_quantiles(df.mapInArrow(counted, df.schema), ["wide", "heavy"], (0.25, 0.5), levels=8, most=40)
    assert found["wide"] == pytest.approx(list(np.quantile(values["wide"], (0.25, 0.5))), rel=1e-12)
    assert made.value == 600
    assert not spark.sparkContext._jsc.getPersistentRDDs()
