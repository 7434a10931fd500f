"""L* and V*: splits, models, scores, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline import fixtures as X
from cohortline.plans import evaluation as ev
from cohortline.plans import scoring as sc
from cohortline.plans import training as tr
from cohortline.session import kept
from cohortline.queries._registry import DOUBLES, INDICATORS, query, r, rounded, rs

ENC = f"WITH {X.ENCOUNTERS_SQL} "
LOG = f"WITH {X.LOGITS_SQL} "
SCO = f"WITH {X.SCORED_SQL} "
FEATURES = ("age", *DOUBLES, "length_of_stay", "num_prior_admissions", "num_diagnoses", *INDICATORS)
RISK = "CASE WHEN probability < 0.3 THEN 'low' WHEN probability < 0.6 THEN 'moderate' ELSE 'high' END"


def _training_rows(spark, sf):
    return X.encounters(spark, sf).select("event_id", D.LABEL, *FEATURES)


@query("l1_stratified_split", ENC + """
SELECT event_id, readmission_30day,
       CASE WHEN substr(md5(CAST(event_id AS VARCHAR) || ':42'), 1, 8) < 'b3333333' THEN 'train'
            WHEN substr(md5(CAST(event_id AS VARCHAR) || ':42'), 1, 8) < 'd9999999' THEN 'validation'
            ELSE 'test' END AS split
FROM encounters""")
def _(spark, sf):
    return tr.stratified_split(X.encounters(spark, sf).select("event_id", D.LABEL))


@query("l1_stratified_split_exact", ENC + """,
ranked AS (
  SELECT event_id, readmission_30day, count(*) OVER (PARTITION BY readmission_30day) AS size,
         row_number() OVER (PARTITION BY readmission_30day
                            ORDER BY md5(CAST(event_id AS VARCHAR) || ':42'), event_id) AS pos FROM encounters)
SELECT event_id, readmission_30day,
       CASE WHEN pos <= round(size * CAST(0.7 AS DOUBLE)) THEN 'train'
            WHEN pos <= round(size * CAST(0.85 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM ranked""")
def _(spark, sf):
    return tr.stratified_split(X.encounters(spark, sf).select("event_id", D.LABEL), exact=True)


@query("l3_fit_logistic")
def _(spark, sf):
    rows = _training_rows(spark, sf)
    with kept(rows) as held:
        model = tr.fit_logistic(held, FEATURES)
    return rounded(tr.predict(model, rows, FEATURES).select("event_id", "logit", "probability", "prediction"), 4)


@query("l4_fit_mlp")
def _(spark, sf):
    rows = tr.stratified_split(_training_rows(spark, sf))
    with kept(rows.filter("split = 'train'")) as learned:
        model = tr.fit_mlp(learned, FEATURES)
    held = tr.predict(model, rows.filter("split = 'test'"), FEATURES)
    return ev.confusion(held, label=D.LABEL)


@query("l5_grid_sweep")
def _(spark, sf):
    grid = {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5], "maxIter": [10, 20]}
    return tr.grid_sweep(_training_rows(spark, sf), FEATURES, grid, metric="auc_roc").drop("training_time")


_GRID = ("training.priority", "training.status", "segment")


@query("l6_param_grid_table", """
WITH p AS (SELECT DISTINCT o_orderpriority AS v FROM orders), s AS (SELECT DISTINCT o_orderstatus AS w FROM orders),
m AS (SELECT DISTINCT c_mktsegment AS x FROM customer)
SELECT row_number() OVER (ORDER BY v, w, x) AS run_index, v AS priority, w AS status, x AS segment,
       '{"training":{"priority":"' || v || '","status":"' || w || '"},"segment":"' || x || '"}' AS overrides
FROM p, s, m""")
def _(spark, sf):
    orders, customer = X.table(spark, sf, "orders"), X.table(spark, sf, "customer")
    # Lists of category values: bounded by the vocabulary, one row each.
    lists = orders.agg(
        F.sort_array(F.collect_set("o_orderpriority")).alias(_GRID[0]),
        F.sort_array(F.collect_set("o_orderstatus")).alias(_GRID[1]),
    ).withColumn(_GRID[2], customer.agg(F.sort_array(F.collect_set("c_mktsegment"))).scalar())
    grid = tr.param_grid_table(lists, _GRID)
    return grid.select(
        "run_index", F.col("params")[_GRID[0]].alias("priority"), F.col("params")[_GRID[1]].alias("status"),
        F.col("params")[_GRID[2]].alias("segment"), "overrides",
    )


@query("l7_score_batch", LOG + f"""
SELECT event_id, {r('logit')}, {r('1 / (1 + exp(-logit))', 'probability')},
       CASE WHEN 1 / (1 + exp(-logit)) >= 0.5 THEN 1 ELSE 0 END AS prediction
FROM logits""")
def _(spark, sf):
    return rounded(sc.score(X.logits(spark, sf)).select("event_id", "logit", "probability", "prediction"))


@query("l8_risk_level", SCO + f"SELECT event_id, {RISK} AS risk_level FROM scored")
def _(spark, sf):
    return sc.with_risk(X.scored(spark, sf)).select("event_id", "risk_level")


@query("l9_score_rows", SCO + f"""
SELECT event_id AS sample_index, prediction, {r('probability')}, {RISK} AS risk_level, patient_id FROM scored""")
def _(spark, sf):
    return rounded(sc.score_rows(X.scored(spark, sf)))


@query("l10_score_summary", SCO + f"""
SELECT count(*) AS total_samples, count(*) FILTER (WHERE prediction = 1) AS predicted_positive,
       count(*) FILTER (WHERE prediction = 0) AS predicted_negative, {r('avg(prediction)', 'positive_rate')},
       {r('avg(probability)', 'mean_probability')}, {r('max(probability)', 'max_probability')},
       {r('min(probability)', 'min_probability')}, {r('0.5', 'threshold_used')} FROM scored""")
def _(spark, sf):
    return rounded(sc.score_summary(X.scored(spark, sf)))


@query("l11_risk_counts", SCO + f"""
SELECT count(*) AS total_patients, count(*) FILTER (WHERE prediction = 1) AS predicted_readmission,
       {r('avg(probability)', 'mean_probability')},
       count(*) FILTER (WHERE probability >= 0.6) AS high_risk_count,
       count(*) FILTER (WHERE probability >= 0.3 AND probability < 0.6) AS moderate_risk_count,
       count(*) FILTER (WHERE probability < 0.3) AS low_risk_count FROM scored""")
def _(spark, sf):
    return rounded(sc.risk_counts(X.scored(spark, sf)))


@query("l12_class_weight", ENC + """
SELECT event_id, CAST(CASE WHEN readmission_30day = 1 THEN 3.0 ELSE 1.0 END AS DOUBLE) AS weight FROM encounters""")
def _(spark, sf):
    wide = X.encounters(spark, sf)
    return wide.select("event_id", sc.class_weight(F.col(D.LABEL), 3.0).alias("weight"))


_COUNTS = """counts AS (
  SELECT count(*) FILTER (WHERE probability >= 0.5 AND label = 1) AS tp,
         count(*) FILTER (WHERE probability >= 0.5 AND label <> 1) AS fp,
         count(*) FILTER (WHERE probability < 0.5 AND label <> 1) AS tn,
         count(*) FILTER (WHERE probability < 0.5 AND label = 1) AS fn FROM scored)"""


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


METRICS_SQL = ", ".join([
    r(_ratio("tp + tn", "tp + tn + fp + fn"), "accuracy"), r(_ratio("tp", "tp + fp"), "precision"),
    r(_ratio("tp", "tp + fn"), "recall"), r(_ratio("2 * tp", "2 * tp + fp + fn"), "f1_score"),
    r(_ratio("tn", "tn + fp"), "specificity"),
    r(f"({_ratio('tp', 'tp + fn')} + {_ratio('tn', 'tn + fp')}) / 2", "balanced_accuracy"),
])


@query("v1_confusion", f"{SCO}, {_COUNTS} SELECT * FROM counts")
def _(spark, sf):
    return ev.confusion(X.scored(spark, sf))


@query("v2_classification_metrics", f"{SCO}, {_COUNTS} SELECT {METRICS_SQL} FROM counts")
def _(spark, sf):
    return rounded(ev.classification_metrics(X.scored(spark, sf)))


_SCORES = """by_score AS (
  SELECT probability AS score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY 1),
ahead AS (
  SELECT *, coalesce(sum(pos) OVER w, 0) AS pos_above, coalesce(sum(neg) OVER w, 0) AS neg_above FROM by_score
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query("v3_auc_roc", f"""{SCO}, {_SCORES}
SELECT {r('sum(CAST(neg AS DOUBLE) * (pos_above + CAST(pos AS DOUBLE) / 2)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))',
         'auc_roc')} FROM ahead""")
def _(spark, sf):
    return rounded(ev.auc_roc(X.scored(spark, sf)))


@query("v4_auc_pr", f"""{SCO}, {_SCORES}
SELECT {r('sum(CAST(pos_above + pos AS DOUBLE) / (pos_above + pos + neg_above + neg) * pos) / sum(pos)', 'auc_pr')}
FROM ahead""")
def _(spark, sf):
    return rounded(ev.auc_pr(X.scored(spark, sf)))


_THRESHOLDS = """grid AS (SELECT CAST(unnest(range(0, 21)) AS DOUBLE) / 20 AS threshold),
counts AS (
  SELECT threshold, count(*) FILTER (WHERE probability >= threshold AND label = 1) AS tp,
         count(*) FILTER (WHERE probability >= threshold AND label <> 1) AS fp,
         count(*) FILTER (WHERE probability < threshold AND label <> 1) AS tn,
         count(*) FILTER (WHERE probability < threshold AND label = 1) AS fn
  FROM grid, scored GROUP BY threshold)"""


@query("v5_threshold_analysis", f"""{SCO}, {_THRESHOLDS}
SELECT {r('threshold')}, tp, fp, tn, fn, {METRICS_SQL} FROM counts""")
def _(spark, sf):
    return rounded(ev.threshold_analysis(X.scored(spark, sf)))


@query("v6_optimal_threshold_by_f1", f"""{SCO}, {_THRESHOLDS}
SELECT {r('threshold')}, {r(_ratio('2 * tp', '2 * tp + fp + fn'), 'f1_score')}
FROM counts ORDER BY {_ratio('2 * tp', '2 * tp + fp + fn')} DESC, threshold LIMIT 1""")
def _(spark, sf):
    return rounded(ev.optimal_threshold_by_f1(X.scored(spark, sf)))


@query("v7_brier", SCO + f"SELECT {r('avg((probability - label) * (probability - label))', 'brier')} FROM scored")
def _(spark, sf):
    return rounded(ev.brier(X.scored(spark, sf)))


_CURVE = """curve AS (
  SELECT CAST(least(floor(probability * 10), 9) AS INTEGER) AS bin, count(*) AS n,
         avg(probability) AS mean_probability, avg(label) AS observed_rate FROM scored GROUP BY 1)"""


@query("v8_calibration_curve", f"{SCO}, {_CURVE} SELECT bin, n, {rs(('mean_probability', 'observed_rate'))} FROM curve")
def _(spark, sf):
    return rounded(ev.calibration_curve(X.scored(spark, sf)))


@query("v9_ece", f"""{SCO}, {_CURVE}
SELECT {r('sum(abs(observed_rate - mean_probability) * n) / sum(n)', 'ece')} FROM curve""")
def _(spark, sf):
    return rounded(ev.ece(X.scored(spark, sf)))


@query("v10_log_loss", LOG + f"""
SELECT {r('''avg(2.0 * label * (greatest(-logit, 0) + ln(1 + exp(-abs(logit))))
      + (1 - label) * (greatest(logit, 0) + ln(1 + exp(-abs(logit)))))''', 'log_loss')} FROM logits""")
def _(spark, sf):
    return rounded(ev.log_loss(X.logits(spark, sf), positive_weight=2.0))


@query("v12_feature_importance")
def _(spark, sf):
    with kept(_training_rows(spark, sf)) as rows:
        return rounded(tr.feature_importance(tr.fit_logistic(rows, FEATURES), FEATURES, spark), 4)
