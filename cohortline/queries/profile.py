"""A* and P*: profiles, projections, predicates."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline import fixtures as X
from cohortline.operators import impute as im
from cohortline.operators import profile as pf
from cohortline.queries._registry import CATEGORICAL, DOUBLES, INDICATORS, NUMERIC, query, r, rounded, rs

ENC = f"WITH {X.ENCOUNTERS_SQL} "
WIDE = ("patient_id", "event_id", "observation_date", "discharge_date", *NUMERIC[:7], "length_of_stay",
        "num_prior_admissions", "num_diagnoses", "primary_diagnosis", "discharge_disposition",
        "admission_type", *INDICATORS, "readmission_30day")


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


@query("a1_null_profile", ENC + _union(
    [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
     f"{r(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)', 'null_ratio')} FROM encounters" for c in WIDE]
    + ["SELECT '(total)' AS column_name, CAST(" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in WIDE)
       + " AS BIGINT) AS null_count, "
       + r("CAST(" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in WIDE)
           + f" AS DOUBLE) / (count(*) * {len(WIDE)})", "null_ratio") + " FROM encounters"]))
def _(spark, sf):
    return rounded(pf.null_profile(X.encounters(spark, sf)))


@query("a2_describe", ENC + _union(
    f"SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')}, "
    f"{r(f'min({c})', 'min')}, {r(f'quantile_cont({c}, 0.25)', 'q25')}, {r(f'quantile_cont({c}, 0.5)', 'q50')}, "
    f"{r(f'quantile_cont({c}, 0.75)', 'q75')}, {r(f'max({c})', 'max')} FROM encounters" for c in NUMERIC))
def _(spark, sf):
    return rounded(pf.describe(X.encounters(spark, sf), NUMERIC))


_DISTINCT = (*CATEGORICAL, "patient_id", "age", "creatinine")


@query("a3_distinct_count", ENC + _union(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM encounters" for c in _DISTINCT))
def _(spark, sf):
    return pf.distinct_count(X.encounters(spark, sf), _DISTINCT)


@query("a4_value_counts", ENC + f"""
SELECT admission_type AS value, count(*) AS n,
       {r('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()', 'share')}
FROM encounters WHERE admission_type IS NOT NULL GROUP BY admission_type""")
def _(spark, sf):
    return rounded(pf.value_counts(X.encounters(spark, sf), "admission_type", normalize=True))


@query("a5_group_mean", ENC + f"""
SELECT admission_type AS value, {r('avg(readmission_30day)', 'mean')}, count(readmission_30day) AS n
FROM encounters WHERE admission_type IS NOT NULL GROUP BY admission_type""")
def _(spark, sf):
    return rounded(pf.group_mean(X.encounters(spark, sf), "admission_type"))


_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


@query("a6_quantile", ENC + _union(
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS probability, {r(f'quantile_cont({c}, {p})', 'value')} "
    f"FROM encounters" for c in DOUBLES for p in _PROBS))
def _(spark, sf):
    found = pf.quantiles(X.encounters(spark, sf), DOUBLES, _PROBS)
    return rounded(found.withColumn("value", F.col("value"))).withColumn("probability", F.round("probability", 2))


@query("a8_correlation_matrix", ENC + _union(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'r')} FROM encounters"
    for a, b in combinations(NUMERIC, 2)))
def _(spark, sf):
    return rounded(pf.correlation_matrix(X.encounters(spark, sf), NUMERIC))


@query("a9_rate_with_without", ENC + _union(
    f"SELECT '{c}' AS indicator, {r(f'avg(CASE WHEN {c} = 1 THEN readmission_30day END)', 'rate_with')}, "
    f"{r(f'avg(CASE WHEN {c} = 0 THEN readmission_30day END)', 'rate_without')} FROM encounters"
    for c in INDICATORS))
def _(spark, sf):
    return rounded(pf.rate_with_without(X.encounters(spark, sf), INDICATORS))


@query("a10_histogram_by_label", ENC + f""",
span AS (SELECT readmission_30day AS label, min(heart_rate) AS lo, max(heart_rate) AS hi FROM encounters GROUP BY 1),
placed AS (
  SELECT label, lo, (hi - lo) / 30 AS w,
         CAST(least(floor((heart_rate - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin
  FROM encounters JOIN span ON readmission_30day = label)
SELECT label, bin, {r('lo + w * bin', 'bin_start')}, count(*) AS n FROM placed GROUP BY label, bin, lo, w""")
def _(spark, sf):
    return rounded(pf.histogram_by_label(X.encounters(spark, sf), "heart_rate"))


_CASE = "CASE " + " ".join(
    f"WHEN age > {lo} AND age <= {hi} THEN '{name}'"
    for lo, hi, name in zip(D.AGE_EDGES, D.AGE_EDGES[1:], D.AGE_RANGE_LABELS)) + " END"


@query("a11_rate_by_band", ENC + f""",
bands AS (SELECT unnest({list(D.AGE_RANGE_LABELS)}) AS band),
found AS (SELECT {_CASE} AS band, avg(readmission_30day) AS rate, count(*) AS n FROM encounters GROUP BY 1)
SELECT band, {r('rate')}, coalesce(n, 0) AS n FROM bands LEFT JOIN found USING (band)""")
def _(spark, sf):
    return rounded(pf.rate_by_band(X.encounters(spark, sf)))


@query("a12_target_distribution", ENC + f"""
SELECT readmission_30day AS label, count(*) AS n,
       {r('(SELECT 100 * avg(readmission_30day) FROM encounters)', 'percent_positive')}
FROM encounters GROUP BY readmission_30day""")
def _(spark, sf):
    return rounded(pf.target_distribution(X.encounters(spark, sf)))


@query("p1_drop_high_missing", ENC + f"""
SELECT patient_id, event_id, {rs(DOUBLES)} FROM encounters""")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("patient_id", "event_id", *DOUBLES)
    sparse = wide.withColumn("rarely_known", F.when(F.col("event_id") % 10 == 0, F.col("heart_rate")))
    return rounded(im.DropSparse.fit(sparse).transform(sparse))


_FLAGGED = ("bmi", "blood_pressure_systolic", "oxygen_saturation", "creatinine", "glucose", "admission_type")


@query("p2_missing_indicators", ENC + "SELECT event_id, " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing" for c in _FLAGGED) + " FROM encounters")
def _(spark, sf):
    wide = X.encounters(spark, sf)
    flagged = im.MissingIndicators.fit(wide, (*NUMERIC, *CATEGORICAL)).transform(wide)
    return flagged.select("event_id", *[c for c in flagged.columns if c.endswith("_missing")])


_FEATURES = [c for c in WIDE if c not in D.NON_FEATURES]


@query("p3_feature_columns", ENC + "SELECT " + ", ".join(
    r(c) if c in DOUBLES else c for c in _FEATURES if c != "smoker") + " FROM encounters")
def _(spark, sf):
    return rounded(pf.select_features(X.encounters(spark, sf), exclude=["smoker"]))


@query("p4_filter_subject", f"""{ENC}
SELECT patient_id, event_id, observation_date, age, {rs(DOUBLES)} FROM encounters WHERE patient_id = 'P7'""")
def _(spark, sf):
    found = pf.filter_subject(X.encounters(spark, sf), "P7")
    return rounded(found.select("patient_id", "event_id", "observation_date", "age", *DOUBLES))


@query("p5_null_to_zero", ENC + "SELECT event_id, " + ", ".join(
    r(f"coalesce({c}, 0)", c) for c in DOUBLES) + " FROM encounters")
def _(spark, sf):
    return rounded(pf.null_to_zero(X.encounters(spark, sf).select("event_id", *DOUBLES)))


def _filled(name: str, default) -> str:
    known = f"CAST({name} AS DOUBLE)" if name in WIDE else "CAST(NULL AS DOUBLE)"
    return r(known if default is None else f"coalesce({known}, {default})", name)


@query("p6_fill_defaults", ENC + "SELECT event_id, " + ", ".join(
    _filled(n, d) for n, (_, _, d) in D.FIELD_RULES.items()) + " FROM encounters")
def _(spark, sf):
    fields = ["event_id", *[c for c in WIDE if c in D.FIELD_RULES]]
    return rounded(pf.fill_defaults(X.encounters(spark, sf).select(*fields)))


_BROKEN = [f"CASE WHEN {n} < {lo} OR {n} > {hi} THEN '{n}' END"
           for n, (lo, hi, _) in D.FIELD_RULES.items() if n in WIDE]


@query("p7_range_check", ENC + f"""
SELECT event_id, coalesce(invalid_fields, '') AS invalid_fields, invalid_fields = '' AS valid FROM (
  SELECT event_id, concat_ws(',', {', '.join(_BROKEN)}) AS invalid_fields FROM encounters)""")
def _(spark, sf):
    checked = pf.range_check(X.encounters(spark, sf))
    return checked.select(
        "event_id", F.concat_ws(",", "invalid_fields").alias("invalid_fields"),
        (F.size("invalid_fields") == 0).alias("valid"),
    )
