"""M*, W7, K1: event format, first-row dedupe, ordered timelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline import fixtures as X
from cohortline.operators import events as ev
from cohortline.queries._registry import CATEGORICAL, DOUBLES, INDICATORS, query, r, rounded, settle


def _measurement_branches() -> list[str]:
    out = []
    for c, (kind, name) in D.MEASUREMENT_CODES.items():
        if c in DOUBLES:
            code = D.CODE_PREFIX[kind] + name
            out.append(
                f"SELECT patient_id AS subject_id, observation_date AS timestamp, event_id, "
                f"'{code}' AS code, {c} AS numeric_value FROM encounters WHERE {c} IS NOT NULL"
            )
    return out


def _category_branches() -> list[str]:
    return [
        f"SELECT patient_id AS subject_id, observation_date AS timestamp, event_id, "
        f"'{D.CODE_PREFIX[D.CATEGORY_KINDS[c]]}' || {c} AS code, CAST(NULL AS DOUBLE) AS numeric_value "
        f"FROM encounters WHERE {c} IS NOT NULL"
        for c in CATEGORICAL
    ]


def _indicator_branches() -> list[str]:
    return [
        f"SELECT patient_id AS subject_id, observation_date AS timestamp, event_id, "
        f"'{D.CODE_PREFIX[D.INDICATOR_CODES[c][0]] + D.INDICATOR_CODES[c][1]}' AS code, "
        f"CAST(1.0 AS DOUBLE) AS numeric_value FROM encounters WHERE {c} = 1"
        for c in INDICATORS
    ]


_ALL = _measurement_branches() + _category_branches() + _indicator_branches()


def _union(branches: list[str]) -> str:
    return " UNION ALL ".join(branches)


EVENTS_SQL = X.ENCOUNTERS_SQL + f""",
raw_events AS ({_union(_ALL)}),
wide_events AS (
  SELECT subject_id, timestamp, code, numeric_value FROM (
    SELECT *, row_number() OVER (PARTITION BY subject_id, timestamp, code
                                 ORDER BY event_id, numeric_value) AS rn FROM raw_events)
  WHERE rn = 1)"""

_OUT = f"subject_id, timestamp, code, {r('numeric_value')}"


@query("m1_measurements_to_events",
       f"WITH {X.ENCOUNTERS_SQL} SELECT {_OUT} FROM ({_union(_measurement_branches())})")
def _(spark, sf):
    return rounded(ev.measurements_to_events(X.encounters(spark, sf)))


@query("m2_categories_to_events",
       f"WITH {X.ENCOUNTERS_SQL} SELECT {_OUT} FROM ({_union(_category_branches())})")
def _(spark, sf):
    return rounded(ev.categories_to_events(X.encounters(spark, sf)))


@query("m3_indicators_to_events",
       f"WITH {X.ENCOUNTERS_SQL} SELECT {_OUT} FROM ({_union(_indicator_branches())})")
def _(spark, sf):
    return rounded(ev.indicators_to_events(X.encounters(spark, sf)))


@query("m4_to_events", f"WITH {EVENTS_SQL} SELECT {_OUT} FROM wide_events")
def _(spark, sf):
    return rounded(ev.to_events(X.encounters(spark, sf)))


@query("m5_validate_events", f"""WITH {EVENTS_SQL}
SELECT '' AS missing_columns, count(*) AS total_events,
       count(*) FILTER (WHERE subject_id IS NULL) AS null_subjects,
       count(*) FILTER (WHERE timestamp IS NULL) AS null_timestamps,
       CAST(0 AS BIGINT) AS bad_timestamps,
       count(*) FILTER (WHERE subject_id IS NULL) = 0 AS valid
FROM wide_events""")
def _(spark, sf):
    return ev.validate_events(ev.to_events(X.encounters(spark, sf)))


@query("m6_code_prefix_counts", f"""WITH {EVENTS_SQL}
SELECT split_part(code, '/', 1) AS prefix, count(*) AS events, count(DISTINCT code) AS codes
FROM wide_events GROUP BY 1""")
def flagship(spark, sf):
    return ev.code_prefix_counts(ev.to_events(X.encounters(spark, sf)))


@query("w7_dedupe_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
WHERE rn = 1""")
def _(spark, sf):
    return ev.dedupe_first(
        X.table(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber"),
        ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"),
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


@query("k1_sort_timeline", f"""WITH {X.ENCOUNTERS_SQL}
SELECT patient_id, observation_date, event_id, {r('heart_rate')}
FROM encounters ORDER BY patient_id, observation_date, event_id""")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("patient_id", "observation_date", "event_id", "heart_rate")
    return ev.sort_timeline(wide.withColumn("heart_rate", settle(F.col("heart_rate"))))
