"""S*, K*, U*, X*, ST*: files, run records, streamed scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline import fixtures as X
from cohortline.operators import events as ev
from cohortline.plans import runs as rn
from cohortline.plans import scoring as sc
from cohortline.queries._registry import DOUBLES, INDICATORS, query, r, rounded, rs
from cohortline.queries.events import EVENTS_SQL
from cohortline.session import scratch_path
from cohortline.sources import readers as rd
from cohortline.sources import writers as wr
from cohortline.sources.arrays import write_array
from cohortline.streaming.events import event_stream
from cohortline.streaming.serving import score_stream

ENC = f"WITH {X.ENCOUNTERS_SQL} "
_SCAN_COLUMNS = ("patient_id", "event_id", "observation_date", "age", "admission_type", *DOUBLES)
_SCAN_SQL = ENC + f"""
SELECT patient_id, event_id, observation_date, age, admission_type, {rs(DOUBLES)} FROM encounters"""


def _wide(spark, sf):
    return X.encounters(spark, sf).select(*_SCAN_COLUMNS)


def _written(spark, sf, format):
    wide = _wide(spark, sf)
    path = scratch_path(spark, f"scan-{format}") + f".{format}"
    wr.write_table(wide, path, format)
    return path, wide.schema


@query("s1_scan_csv", _SCAN_SQL)
def _(spark, sf):
    path, schema = _written(spark, sf, "csv")
    return rounded(rd.scan_csv(spark, path, schema))


@query("s2_scan_json", _SCAN_SQL)
def _(spark, sf):
    wide, path = _wide(spark, sf), scratch_path(spark, "scan-array")
    write_array(wide, path)
    return rounded(rd.scan_json(spark, path, wide.schema))


@query("s3_scan_json_nested", ENC + f"""
SELECT patient_id AS "patient.id", age AS "patient.age", event_id AS "visit.event_id",
       {r('heart_rate', '"visit.vitals.heart_rate"')} FROM encounters""")
def _(spark, sf):
    nested = X.encounters(spark, sf).select(
        F.struct(F.col("patient_id").alias("id"), "age").alias("patient"),
        F.struct("event_id", F.struct("heart_rate").alias("vitals")).alias("visit"),
    )
    path = scratch_path(spark, "nested") + ".json"
    wr.write_table(nested, path, "json")
    return rounded(rd.scan_json_nested(spark, path, nested.schema, lines=True))


@query("s4_scan_parquet", """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_quantity > 25""")
def _(spark, sf):
    lines = rd.scan_parquet(spark, f"{sf}/lineitem.parquet", nan_as_null=False)
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate").filter("l_quantity > 25")


# One folder with files of three kinds: events by the remainder of their ids, some kinds without a column.
@query("s5_scan_auto", """
SELECT event_id, ts, user_id, CASE WHEN event_id % 3 <> 2 THEN event_type END AS event_type,
       CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events""")
def _(spark, sf):
    folder = scratch_path(spark, "mixed")
    rows = rd.scan_parquet(spark, f"{sf}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    part = lambda k: rows.where(F.col("event_id") % 3 == k)
    wr.write_table(part(0).drop("value"), folder, "parquet", "append")
    wr.write_table(part(1), folder, "csv", "append")
    wr.write_table(part(2).drop("event_type"), folder, "json", "append")
    return rd.scan_auto(spark, folder, rows.schema).select(rows.columns)


@query("s6_write_table", _SCAN_SQL)
def _(spark, sf):
    path, schema = _written(spark, sf, "parquet")
    return rounded(rd.scan_parquet(spark, path, schema))


@query("s7_write_events", f"""WITH {EVENTS_SQL}
SELECT subject_id, timestamp, code, {r('numeric_value')} FROM wide_events""")
def _(spark, sf):
    path = scratch_path(spark, "events")
    wr.write_events(ev.to_events(X.encounters(spark, sf)), path, buckets=8)
    return rounded(wr.read_events(spark, path))


@query("s8_event_metadata", f"""WITH {EVENTS_SQL}
SELECT '0.3' AS schema_version, count(*) AS total_events, count(DISTINCT subject_id) AS total_patients,
       count(DISTINCT code) AS unique_codes,
       strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS date_range
FROM wide_events""")
def _(spark, sf):
    return wr.event_metadata(ev.to_events(X.encounters(spark, sf)))


@query("s9_read_run_results", f"""WITH {X.RUNS_SQL}
SELECT run_name, model_type, parameter_count, {r('training_time_seconds')}, {r('f1_score')}, {r('auc_roc')}, timestamp
FROM runs""")
def _(spark, sf):
    path = scratch_path(spark, "runs")
    X.runs(spark, sf).write.json(path)
    found = rd.read_run_results(spark, path, lines=True)
    return rounded(found.select(
        "run_name", "model_type", "parameter_count", "training_time_seconds",
        "metrics.f1_score", "metrics.auc_roc", "timestamp"))


@query("s10_write_predictions", f"""WITH {X.SCORED_SQL}
SELECT event_id AS sample_index, prediction, {r('probability')},
       CASE WHEN probability < 0.3 THEN 'low' WHEN probability < 0.6 THEN 'moderate' ELSE 'high' END AS risk_level,
       patient_id, (SELECT count(*) FROM scored) AS total_samples FROM scored""")
def _(spark, sf):
    path = scratch_path(spark, "predictions")
    scored = X.scored(spark, sf)
    wr.write_predictions(scored, path)
    rows = spark.read.schema(sc.score_rows(scored).schema).json(f"{path}/predictions")
    summary = spark.read.schema("total_samples bigint").json(f"{path}/summary")
    return rounded(rows.withColumn("total_samples", summary.scalar()))


_METRICS = D.RUN_METRICS


@query("x1_comparison_table", f"""WITH {X.RUNS_SQL}
SELECT model_type, {', '.join(r(f'coalesce({m}, 0)', m) for m in _METRICS)}, parameter_count AS param_count,
       {r('training_time_seconds', 'training_time')} FROM runs""")
def _(spark, sf):
    return rounded(rn.comparison_table(X.runs(spark, sf)))


_CHOSEN = ("run_5", "run_2", "run_3", "run_7")


@query("x2_compare_runs", f"""WITH {X.RUNS_SQL},
chosen AS (SELECT * FROM runs WHERE run_name IN {_CHOSEN}),
best AS (SELECT run_name AS b FROM chosen ORDER BY f1_score DESC, list_position({list(_CHOSEN)}, run_name) LIMIT 1)
SELECT run_name, model_type, {rs(_METRICS[:5])}, parameter_count, {r('training_time_seconds')}, run_name = b AS is_best
FROM chosen, best""")
def _(spark, sf):
    return rounded(rn.compare_runs(X.runs(spark, sf), _CHOSEN))


@query("x3_ablation_impact", f"""WITH {X.ABLATION_SQL},
deltas AS (
  SELECT component, f1_score, f1_score - (SELECT f1_score FROM ablation WHERE component = 'full_model') AS delta
  FROM ablation WHERE component <> 'full_model')
SELECT component, {r('f1_score')}, round(delta, 4) AS delta_f1,
       CASE WHEN delta < -0.05 THEN 'critical' WHEN delta < -0.02 THEN 'significant'
            WHEN delta < 0 THEN 'minor' ELSE 'neutral' END AS impact FROM deltas""")
def _(spark, sf):
    impact = rn.ablation_impact(X.ablation_scores(spark, sf))
    return impact.withColumn("f1_score", F.round(F.col("f1_score") + 1.3e-7, 6))


@query("x4_report", f"""WITH {X.RUNS_SQL}
SELECT count(*) + 2 AS total_experiments, count(*) AS total_single_runs, 'lstm,mlp,transformer' AS models_tested,
       {r('max(f1_score)', 'best_f1')}, {r('min(f1_score)', 'worst_f1')}, {r('avg(f1_score)', 'mean_f1')},
       {r('max(accuracy)', 'best_accuracy')} FROM runs""")
def _(spark, sf):
    return rounded(rn.report(_all_records(spark, sf)))


def _summary_of(df, kind):
    return df.agg(F.count(F.lit(1)).alias("total_runs")).withColumn("experiment_type", F.lit(kind))


def _all_records(spark, sf):
    return rn.union_run_kinds({
        "single": X.runs(spark, sf),
        "hyperparameter_sweep": _summary_of(X.sweep_results(spark, sf), "hyperparameter_sweep"),
        "ablation_study": _summary_of(X.ablation_scores(spark, sf), "ablation_study"),
    })


@query("u2_union_run_kinds", f"""WITH {X.RUNS_SQL}, {X.SWEEP_SQL}, {X.ABLATION_SQL}
SELECT 'single' AS kind, CAST(NULL AS VARCHAR) AS experiment_type, run_name, {r('f1_score')}, CAST(NULL AS BIGINT) AS total_runs FROM runs
UNION ALL SELECT 'hyperparameter_sweep', 'hyperparameter_sweep', NULL, NULL, count(*) FROM sweep
UNION ALL SELECT 'ablation_study', 'ablation_study', NULL, NULL, count(*) FROM ablation""")
def _(spark, sf):
    return rounded(_all_records(spark, sf).select("kind", "experiment_type", "run_name", "metrics.f1_score", "total_runs"))


@query("x5_sweep_summary", f"""WITH {X.SWEEP_SQL}
SELECT count(*) AS total_runs, count(*) FILTER (WHERE error IS NULL) AS successful_runs, {r('max(score)', 'best_score')},
       (SELECT rate FROM sweep WHERE error IS NULL ORDER BY score DESC, run_index LIMIT 1) AS best_rate,
       (SELECT size FROM sweep WHERE error IS NULL ORDER BY score DESC, run_index LIMIT 1) AS best_size FROM sweep""")
def _(spark, sf):
    summary = rn.sweep_summary(X.sweep_results(spark, sf))
    config = F.col("best_config")
    return rounded(summary.select(
        "total_runs", "successful_runs", "best_score",
        config["training.learning_rate"].alias("best_rate"), config["training.batch_size"].alias("best_size")))


@query("x6_best_epoch", f"""WITH RECURSIVE {X.RUNS_SQL},
curves AS (SELECT run_name, list(loss ORDER BY epoch) AS curve FROM losses GROUP BY run_name),
steps AS (
  SELECT run_name, curve, 1 AS epoch, curve[1] AS best, 1 AS best_epoch, 0 AS waited, CAST(NULL AS INTEGER) AS stop FROM curves
  UNION ALL
  SELECT run_name, curve, epoch + 1,
         CASE WHEN best - curve[epoch + 1] > 0.0001 THEN curve[epoch + 1] ELSE best END,
         CASE WHEN best - curve[epoch + 1] > 0.0001 THEN epoch + 1 ELSE best_epoch END,
         CASE WHEN best - curve[epoch + 1] > 0.0001 THEN 0 ELSE waited + 1 END,
         CASE WHEN best - curve[epoch + 1] <= 0.0001 AND waited + 1 >= 4 THEN epoch + 1 END
  FROM steps WHERE stop IS NULL AND epoch < len(curve))
SELECT run_name, {r('arg_max(best, epoch)', 'best_score')}, CAST(arg_max(best_epoch, epoch) AS INTEGER) AS best_epoch,
       CAST(max(stop) AS INTEGER) AS stop_epoch FROM steps GROUP BY run_name""")
def _(spark, sf):
    return rounded(rn.best_epoch(X.runs(spark, sf), patience=4))


@query("k2_top_n_runs", f"""WITH {X.RUNS_SQL}
SELECT run_name, model_type, timestamp, {r('f1_score')}, {r('accuracy')} FROM runs
ORDER BY runs.f1_score DESC, run_name LIMIT 5""")
def _(spark, sf):
    return rounded(rn.top_n_runs(X.runs(spark, sf), 5))


@query("k3_top_n_sweep", f"""WITH {X.SWEEP_SQL},
top AS (SELECT *, row_number() OVER (ORDER BY score DESC, run_index) AS rank FROM sweep WHERE error IS NULL)
SELECT CAST(rank AS INTEGER) AS rank, run_index, run_name, {r('score')}, {r('accuracy')}, rank = 1 AS is_best
FROM top WHERE rank <= 10""")
def _(spark, sf):
    top = rn.top_n_sweep(X.sweep_results(spark, sf), 10)
    return rounded(top.select("rank", "run_index", "run_name", "score", "metrics.accuracy", "is_best"))


@query("k4_runs_newest_first", f"""WITH {X.RUNS_SQL}
SELECT run_name, model_type, timestamp, {r('f1_score')}, {r('accuracy')} FROM runs ORDER BY timestamp DESC, run_name""")
def _(spark, sf):
    return rounded(rn.runs_newest_first(X.runs(spark, sf)))


@query("k5_argmax_run", f"""WITH {X.RUNS_SQL}
SELECT run_name, model_type, {r('f1_score')} FROM runs ORDER BY runs.f1_score DESC, run_name LIMIT 1""")
def _(spark, sf):
    return rounded(rn.argmax_run(X.runs(spark, sf)))


WEIGHTS = {"num_diagnoses": 0.5, "has_chd": 1.0, "bmi": 0.01, "age": -0.025}
_FIELDS = [c for c in ("age", *DOUBLES, "length_of_stay", "num_prior_admissions", "num_diagnoses", *INDICATORS)]
_VALID = " AND ".join(
    f"coalesce({c} BETWEEN {D.FIELD_RULES[c][0]} AND {D.FIELD_RULES[c][1]}, {D.FIELD_RULES[c][2] is not None})"
    for c in _FIELDS)


@query("st1_score_stream", ENC + f""",
z AS (SELECT event_id, -2 + 0.5 * num_diagnoses + has_chd + 0.01 * coalesce(bmi, 26) - 0.025 * age AS logit
      FROM encounters WHERE {_VALID}),
p AS (SELECT event_id, logit, 1 / (1 + exp(-logit)) AS probability FROM z)
SELECT event_id, {r('logit')}, {r('probability')}, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction,
       CASE WHEN probability < 0.3 THEN 'low' WHEN probability < 0.6 THEN 'moderate' ELSE 'high' END AS risk_level
FROM p""")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *_FIELDS)
    base = scratch_path(spark, "stream")
    wide.write.parquet(f"{base}/in")
    running = score_stream(spark, f"{base}/in", wide.schema, f"{base}/out", f"{base}/state", WEIGHTS, intercept=-2.0)
    running.awaitTermination()
    return rounded(spark.read.parquet(f"{base}/out"))


@query("st2_event_stream", f"""WITH {EVENTS_SQL}
SELECT subject_id, timestamp, code, {r('numeric_value')} FROM wide_events
WHERE timestamp <= (SELECT max(observation_date) FROM encounters) - INTERVAL 1 DAY""")
def _(spark, sf):
    wide = X.encounters(spark, sf)
    base = scratch_path(spark, "event-stream")
    wide.write.parquet(f"{base}/in")
    event_stream(spark, f"{base}/in", wide.schema, f"{base}/out", f"{base}/state").awaitTermination()
    return rounded(spark.read.parquet(f"{base}/out"))
