"""The plans we want: few exchanges, pushed filters, no Python, no single task."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import plan_of
from cohortline import fixtures as X
from cohortline.operators import events as ev
from cohortline.operators import profile as pf
from cohortline.operators.resample import resample_fill
from cohortline.plans import evaluation as evl
from cohortline.plans.features import FeatureSet
from cohortline.queries.derive import HOW
from cohortline.sources.readers import scan_parquet
from cohortline.streaming.serving import serve


def exchanges(plan: str) -> int:
    tree = plan.split("\n\n\n")[0]
    return sum(1 for line in tree.splitlines() if "Exchange (" in line and "Broadcast" not in line and "Reused" not in line)


def _timeline(spark, folder):
    return X.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("observation_date"), F.col("o_totalprice").alias("heart_rate"),
        F.col("o_totalprice").alias("oxygen_saturation"), F.col("o_totalprice").alias("glucose"))


def test_all_timeline_features_share_one_exchange(spark, folder):
    made = FeatureSet(max_rows=None).transform(_timeline(spark, folder))
    plan = plan_of(made)
    assert len(made.columns) > 20
    assert exchanges(plan) == 1 and "Python" not in plan


def test_subject_filter_reaches_the_scan(spark, folder):
    plan = plan_of(scan_parquet(spark, f"{folder}/events.parquet").filter("user_id = 3").select("event_id", "user_id"))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan


def test_filter_on_a_floating_column_reaches_the_scan(spark, folder):
    lines = scan_parquet(spark, f"{folder}/lineitem.parquet", nan_as_null=False).filter("l_quantity > 25")
    assert "GreaterThan(l_quantity,25.0)" in plan_of(lines)


def test_scan_reads_only_needed_columns(spark, folder):
    plan = plan_of(pf.target_distribution(X.encounters(spark, folder)))
    assert "l_comment" not in plan and "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_dedupe_keeps_one_row_before_the_shuffle(spark, folder):
    plan = plan_of(ev.dedupe_first(X.table(spark, folder, "lineitem"), ("l_orderkey", "l_linenumber"), ("l_shipdate",)))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_events_are_one_scan_of_the_wide_table(spark, folder):
    plan = plan_of(ev.to_events(X.encounters(spark, folder)))
    assert plan.count("Scan parquet") == 2 * 3  # three tables, each named in the tree and in its detail


def test_resampling_shuffles_bins_then_subjects(spark, folder):
    plan = plan_of(resample_fill(X.observations(spark, folder), HOW))
    assert exchanges(plan) == 2 and "Join" not in plan and "Python" not in plan


def test_serving_needs_no_shuffle(spark, folder):
    wide = _timeline(spark, folder).withColumn("age", F.lit(50))
    assert exchanges(plan_of(serve(wide, {"age": 0.1}))) == 0


def test_curve_windows_only_see_reduced_tables(spark, folder):
    scored = X.table(spark, folder, "orders").select(
        (F.col("o_totalprice") / 1e6).alias("probability"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    plan = plan_of(evl.auc_roc(scored))
    # Scores are counted and cut into ranges before; windows over rows have the range as their key.
    assert "Scan parquet" not in plan and plan.count("hashpartitioning(_range") >= 1
    assert all("score" not in line for line in plan.splitlines() if "SinglePartition" in line)
