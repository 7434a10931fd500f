"""Views over the given tables that stand in for the wide observation data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.defaults import RUN_METRICS
from cohortline.plans.evaluation import metric_columns


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _null_every(key: str, step: int, value):
    return F.when(F.col(key) % step != 0, value)


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    """Wide observation table: one row per order that has lines.

    Lines are reduced to one row per order before any join, with sums of whole
    numbers only, so the result does not depend on the order of addition.
    """
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_quantity").cast("bigint").alias("q"),
            F.sum(cents("l_extendedprice")).alias("ep"),
            F.sum(cents("l_discount")).alias("d"),
            F.sum(cents("l_tax")).alias("t"),
            F.max((F.col("l_returnflag") == "R").cast("int")).alias("any_r"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )
    joined = (
        table(spark, folder, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    key, cust = F.col("o_orderkey"), F.col("c_custkey")
    n = F.col("n")
    flag = lambda cond: cond.cast("int")
    ratio = lambda top, bottom: top.cast("double") / bottom
    return joined.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("patient_id"),
        key.alias("event_id"),
        F.col("o_orderdate").alias("observation_date"),
        F.col("last_ship").alias("discharge_date"),
        (18 + cust % 73).cast("int").alias("age"),
        _null_every("o_orderkey", 20, ratio(15 * n + F.col("q"), n)).alias("bmi"),
        _null_every("o_orderkey", 23, ratio(8000000 * n + F.col("ep"), 100000 * n)).alias("blood_pressure_systolic"),
        ratio(5000000 + F.round(F.col("o_totalprice") * 100).cast("bigint"), F.lit(200000)).alias("heart_rate"),
        _null_every("o_orderkey", 19, ratio(100 * n - F.col("d"), n)).alias("oxygen_saturation"),
        _null_every("o_orderkey", 17, ratio(2 * n + F.col("t"), 5 * n)).alias("creatinine"),
        _null_every("o_orderkey", 29, ratio(70 * n + 3 * F.col("q"), n)).alias("glucose"),
        (1 + key % 14).cast("int").alias("length_of_stay"),
        (cust % 6).cast("int").alias("num_prior_admissions"),
        n.cast("int").alias("num_diagnoses"),
        F.col("c_mktsegment").alias("primary_diagnosis"),
        F.col("o_orderstatus").alias("discharge_disposition"),
        _null_every("o_orderkey", 31, F.col("o_orderpriority")).alias("admission_type"),
        flag(cust % 10 < 3).alias("has_diabetes"),
        flag(cust % 20 < 9).alias("has_hypertension"),
        flag(cust % 5 == 0).alias("has_chd"),
        flag(cust % 7 == 0).alias("has_copd"),
        flag(cust % 11 == 0).alias("has_renal_disease"),
        flag(cust % 4 == 0).alias("smoker"),
        (1 - F.col("any_r")).alias("readmission_30day"),
    )


ENCOUNTERS_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n,
         CAST(sum(l_quantity) AS BIGINT) AS q,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS ep,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS d,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS t,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS any_r,
         max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
encounters AS (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS patient_id,
         o_orderkey AS event_id,
         o_orderdate AS observation_date,
         last_ship AS discharge_date,
         CAST(18 + c_custkey % 73 AS INTEGER) AS age,
         CASE WHEN o_orderkey % 20 <> 0 THEN CAST(15 * n + q AS DOUBLE) / n END AS bmi,
         CASE WHEN o_orderkey % 23 <> 0 THEN CAST(8000000 * n + ep AS DOUBLE) / (100000 * n) END AS blood_pressure_systolic,
         CAST(5000000 + CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) / 200000 AS heart_rate,
         CASE WHEN o_orderkey % 19 <> 0 THEN CAST(100 * n - d AS DOUBLE) / n END AS oxygen_saturation,
         CASE WHEN o_orderkey % 17 <> 0 THEN CAST(2 * n + t AS DOUBLE) / (5 * n) END AS creatinine,
         CASE WHEN o_orderkey % 29 <> 0 THEN CAST(70 * n + 3 * q AS DOUBLE) / n END AS glucose,
         CAST(1 + o_orderkey % 14 AS INTEGER) AS length_of_stay,
         CAST(c_custkey % 6 AS INTEGER) AS num_prior_admissions,
         CAST(n AS INTEGER) AS num_diagnoses,
         c_mktsegment AS primary_diagnosis,
         o_orderstatus AS discharge_disposition,
         CASE WHEN o_orderkey % 31 <> 0 THEN o_orderpriority END AS admission_type,
         CASE WHEN c_custkey % 10 < 3 THEN 1 ELSE 0 END AS has_diabetes,
         CASE WHEN c_custkey % 20 < 9 THEN 1 ELSE 0 END AS has_hypertension,
         CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS has_chd,
         CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS has_copd,
         CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS has_renal_disease,
         CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS smoker,
         1 - any_r AS readmission_30day
  FROM orders JOIN lines ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey)"""


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Event stream as irregular subject timelines."""
    every = F.col("event_id") % 20 != 0
    return table(spark, folder, "events").select(
        F.col("user_id").alias("patient_id"),
        "event_id",
        F.col("ts").alias("observation_date"),
        F.when(every, F.col("value")).alias("heart_rate"),
        F.get_json_object("props", "$.k").cast("int").alias("num_medications"),
        F.col("event_type").alias("admission_type"),
        (F.col("event_type") == "error").cast("int").alias("readmission_30day"),
    )


OBSERVATIONS_SQL = """
observations AS (
  SELECT user_id AS patient_id, event_id, ts AS observation_date,
         CASE WHEN event_id % 20 <> 0 THEN value END AS heart_rate,
         CAST(props ->> '$.k' AS INTEGER) AS num_medications,
         event_type AS admission_type,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS readmission_30day
  FROM events)"""


def logits(spark: SparkSession, folder: str) -> DataFrame:
    """Encounters with a derived logit, the input of scoring."""
    logit = (
        (F.col("num_diagnoses") - 4).cast("double") / 2
        + F.col("has_chd")
        - (F.col("age") - 54).cast("double") / 40
    )
    return encounters(spark, folder).select(
        "patient_id", "event_id", "num_diagnoses", "has_chd", "age",
        F.col("readmission_30day").alias("label"), logit.alias("logit"),
    ).select("patient_id", "event_id", "label", "logit")


LOGITS_SQL = ENCOUNTERS_SQL + """,
logits AS (
  SELECT patient_id, event_id, readmission_30day AS label,
         CAST(num_diagnoses - 4 AS DOUBLE) / 2 + has_chd - CAST(age - 54 AS DOUBLE) / 40 AS logit
  FROM encounters)"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Label, logit, rounded probability and the prediction at one half."""
    probability = F.round(1 / (1 + F.exp(-F.col("logit"))), 6)
    return logits(spark, folder).select(
        "patient_id", "event_id", "label", "logit", probability.alias("probability"),
    ).withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))


SCORED_SQL = LOGITS_SQL + """,
scored AS (
  SELECT patient_id, event_id, label, logit, probability,
         CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT *, round(1 / (1 + exp(-logit)), 6) AS probability FROM logits))"""


def _label_counts(spark: SparkSession, folder: str, key) -> DataFrame:
    """Confusion counts of the document labels per group: quality predicts not toxic."""
    hit, true = F.col("quality") == 1, F.col("toxic") == 0
    return table(spark, folder, "labels").groupBy(key.alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & ~true).alias("tn"), F.count_if(~hit & true).alias("fn"),
    )


def _metrics(missing_auc):
    ratios = metric_columns()
    auc = F.when(~missing_auc, ratios["balanced_accuracy"])
    return F.struct(*[(auc if m == "auc_roc" else ratios[m]).alias(m) for m in RUN_METRICS])


def _model(key):
    return F.element_at(F.array(F.lit("mlp"), F.lit("lstm"), F.lit("transformer")), (key % 3 + 1).cast("int"))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Single run records derived from the labels, one per residue of the document id."""
    k = F.col("k")
    text = k.cast("string")
    losses = (
        table(spark, folder, "labels")
        .groupBy((F.col("doc_id") % 8).alias("h"), (F.floor(F.col("doc_id") / 8) % 20).alias("epoch"))
        .agg(F.avg((F.col("doc_id") * 37 % 11).cast("double") + F.col("toxic")).alias("loss"))
        .groupBy("h").agg(F.sort_array(F.collect_list(F.struct("epoch", "loss"))).alias("curve"))
    )
    counted = _label_counts(spark, folder, F.col("doc_id") % 8)
    # Both sides have at most eight rows.
    return counted.join(F.broadcast(losses), F.col("k") == F.col("h")).select(
        F.lit(None).cast("string").alias("experiment_type"),
        F.concat(F.lit("r"), text).alias("run_id"), F.concat(F.lit("run_"), text).alias("run_name"),
        _model(k).alias("model_type"), (1000 * (k + 1) + F.col("n")).alias("parameter_count"),
        (F.col("n").cast("double") / 10).alias("training_time_seconds"),
        F.struct(F.col("curve.loss").alias("val_loss")).alias("history"),
        _metrics(k == 3).alias("metrics"),
        F.concat(F.lit("2024-01-0"), (k * 5 % 8 + 1).cast("string"), F.lit("T00:00:00")).alias("timestamp"),
    )


def sweep_results(spark: SparkSession, folder: str) -> DataFrame:
    """Sweep entries derived from the labels; two of sixteen carry an error."""
    k = F.col("k")
    failed = k % 7 == 3
    entry = _label_counts(spark, folder, F.col("doc_id") % 16)
    rate = F.element_at(F.array(F.lit("0.1"), F.lit("0.01"), F.lit("0.001"), F.lit("0.0001")), (k % 4 + 1).cast("int"))
    size = F.element_at(F.array(F.lit("16"), F.lit("32"), F.lit("64"), F.lit("128")), (F.floor(k / 4) + 1).cast("int"))
    metrics = _metrics(F.lit(False))
    return entry.select(
        (k + 1).alias("run_index"), F.concat(F.lit("sweep_run"), F.lpad((k + 1).cast("string"), 3, "0")).alias("run_name"),
        F.create_map(F.lit("training.learning_rate"), rate, F.lit("training.batch_size"), size).alias("params"),
        F.when(~failed, metrics["f1_score"]).alias("score"), F.when(~failed, metrics).alias("metrics"),
        F.when(~failed, F.col("n").cast("double") / 10).alias("training_time"),
        F.when(failed, F.lit("out of memory")).alias("error"),
    )


def ablation_scores(spark: SparkSession, folder: str) -> DataFrame:
    """F1 per left-out component, derived from the labels."""
    names = F.array(*[F.lit(n) for n in ("full_model", "no_rolling", "no_diff", "no_risk", "no_labs", "no_vitals")])
    counted = _label_counts(spark, folder, F.col("doc_id") % 6)
    return counted.select(
        F.element_at(names, (F.col("k") + 1).cast("int")).alias("component"), metric_columns()["f1_score"].alias("f1_score"))


def _counts_sql(groups: int) -> str:
    hit, true = "quality = 1", "toxic = 0"
    return f"""SELECT doc_id % {groups} AS k, count(*) AS n,
    count(*) FILTER (WHERE {hit} AND {true}) AS tp, count(*) FILTER (WHERE {hit} AND NOT ({true})) AS fp,
    count(*) FILTER (WHERE NOT ({hit}) AND NOT ({true})) AS tn, count(*) FILTER (WHERE NOT ({hit}) AND {true}) AS fn
    FROM labels GROUP BY 1"""


_RATIO = "CASE WHEN {b} = 0 THEN 0 ELSE CAST({a} AS DOUBLE) / ({b}) END"
_RATIOS_SQL = ", ".join(_RATIO.format(a=a, b=b) + f" AS {n}" for n, a, b in (
    ("accuracy", "tp + tn", "tp + tn + fp + fn"), ("precision", "tp", "tp + fp"), ("recall", "tp", "tp + fn"),
    ("f1_score", "2 * tp", "2 * tp + fp + fn"), ("specificity", "tn", "tn + fp")))

RUNS_SQL = f"""
run_counts AS (SELECT *, {_RATIOS_SQL} FROM ({_counts_sql(8)})),
runs AS (
  SELECT 'r' || k AS run_id, 'run_' || k AS run_name, (['mlp', 'lstm', 'transformer'])[k % 3 + 1] AS model_type,
         CAST(1000 * (k + 1) + n AS BIGINT) AS parameter_count, CAST(n AS DOUBLE) / 10 AS training_time_seconds,
         accuracy, precision, recall, f1_score, CASE WHEN k <> 3 THEN (recall + specificity) / 2 END AS auc_roc,
         specificity, (recall + specificity) / 2 AS balanced_accuracy,
         '2024-01-0' || (k * 5 % 8 + 1) || 'T00:00:00' AS timestamp
  FROM run_counts),
losses AS (
  SELECT 'run_' || (doc_id % 8) AS run_name, doc_id // 8 % 20 AS epoch,
         avg(CAST(doc_id * 37 % 11 AS DOUBLE) + toxic) AS loss FROM labels GROUP BY 1, 2)"""

SWEEP_SQL = f"""
sweep_counts AS (SELECT *, {_RATIOS_SQL} FROM ({_counts_sql(16)})),
sweep AS (
  SELECT k + 1 AS run_index, 'sweep_run' || lpad(CAST(k + 1 AS VARCHAR), 3, '0') AS run_name,
         (['0.1', '0.01', '0.001', '0.0001'])[k % 4 + 1] AS rate, (['16', '32', '64', '128'])[k // 4 + 1] AS size,
         CASE WHEN k % 7 <> 3 THEN f1_score END AS score, CASE WHEN k % 7 <> 3 THEN accuracy END AS accuracy,
         CASE WHEN k % 7 <> 3 THEN CAST(n AS DOUBLE) / 10 END AS training_time,
         CASE WHEN k % 7 = 3 THEN 'out of memory' END AS error
  FROM sweep_counts)"""

ABLATION_SQL = f"""
ablation AS (
  SELECT (['full_model', 'no_rolling', 'no_diff', 'no_risk', 'no_labs', 'no_vitals'])[k + 1] AS component, f1_score
  FROM (SELECT *, {_RATIOS_SQL} FROM ({_counts_sql(6)})))"""
