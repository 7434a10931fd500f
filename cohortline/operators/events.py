"""Wide observation rows <-> long coded events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline import defaults as D

EVENT_COLUMNS = ("subject_id", "timestamp", "code", "numeric_value")
_EVENT = "struct<code:string,numeric_value:double>"


def _event(code: Column, value: Column, keep: Column) -> Column:
    return F.when(keep, F.struct(code.alias("code"), value.cast("double").alias("numeric_value")))


def _measurements(columns: Sequence[str], prefix: Mapping[str, str]) -> list[Column]:
    return [
        _event(F.lit(prefix[kind] + name), F.col(c), F.col(c).isNotNull())
        for c, (kind, name) in D.MEASUREMENT_CODES.items() if c in columns
    ]


def _categories(columns: Sequence[str], prefix: Mapping[str, str]) -> list[Column]:
    return [
        _event(F.concat(F.lit(prefix[kind]), F.col(c).cast("string")), F.lit(None), F.col(c).isNotNull())
        for c, kind in D.CATEGORY_KINDS.items() if c in columns
    ]


def _indicators(columns: Sequence[str], prefix: Mapping[str, str]) -> list[Column]:
    return [
        _event(F.lit(prefix[kind] + name), F.lit(1.0), F.col(c) == 1)
        for c, (kind, name) in D.INDICATOR_CODES.items() if c in columns
    ]


def _explode(df: DataFrame, events: list[Column], row_id: Sequence[str]) -> DataFrame:
    """One generator over one array of candidate events: a single scan of ``df``."""
    subject = F.col(D.SUBJECT) if D.SUBJECT in df.columns else F.lit(D.UNKNOWN_SUBJECT)
    time = F.col(D.TIME) if D.TIME in df.columns else F.lit(None).cast("timestamp")
    candidates = F.array_compact(F.array(*events)) if events else F.array().cast(f"array<{_EVENT}>")
    return df.select(
        subject.alias("subject_id"), time.alias("timestamp"),
        *row_id, F.explode(candidates).alias("event"),
    ).select("subject_id", "timestamp", *row_id, "event.code", "event.numeric_value")


def measurements_to_events(df: DataFrame, prefix: Mapping[str, str] = D.CODE_PREFIX) -> DataFrame:
    """Numeric columns become (code, value) rows; missing values give no row."""
    return _explode(df, _measurements(df.columns, prefix), ())


def categories_to_events(df: DataFrame, prefix: Mapping[str, str] = D.CODE_PREFIX) -> DataFrame:
    """Categorical values become code-only rows, the value inside the code."""
    return _explode(df, _categories(df.columns, prefix), ())


def indicators_to_events(df: DataFrame, prefix: Mapping[str, str] = D.CODE_PREFIX) -> DataFrame:
    """Indicators equal to one become rows with value 1."""
    return _explode(df, _indicators(df.columns, prefix), ())


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in a total order.

    ``row_number() = 1`` lets Spark keep one row per key already before the
    shuffle, so a key made of very many copies does not travel as such.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def event_rows(df: DataFrame, row_ids: Sequence[str], prefix: Mapping[str, str] = D.CODE_PREFIX) -> DataFrame:
    """All events of a wide table with copies, each with the ids of its row."""
    columns = df.columns
    return _explode(
        df, _measurements(columns, prefix) + _categories(columns, prefix) + _indicators(columns, prefix), row_ids)


def to_events(
    df: DataFrame,
    row_id: str | None = D.EVENT_ID,
    prefix: Mapping[str, str] = D.CODE_PREFIX,
    deduplicate: bool = True,
    names: Sequence[str] = EVENT_COLUMNS,
) -> DataFrame:
    """All events of a wide table, one row per (subject, timestamp, code).

    ``names`` are those of the four columns: subject, time, code and value.

    Of several source rows with the same key the one with the smallest
    ``row_id`` (then value) survives. The result is unordered: sort when writing.
    """
    row_ids = [row_id] if row_id and row_id in df.columns else []
    events = event_rows(df, row_ids, prefix)
    if deduplicate:
        events = dedupe_first(events, ("subject_id", "timestamp", "code"), (*row_ids, "numeric_value"))
    return events.select([F.col(c).alias(n) for c, n in zip(EVENT_COLUMNS, names, strict=True)])


def validate_events(events: DataFrame) -> DataFrame:
    """One report row: absent columns, violation counts and the verdict."""
    missing = [c for c in EVENT_COLUMNS if c not in events.columns]
    present = [c for c in ("subject_id", "timestamp") if c not in missing]
    checks = {
        "null_subjects": F.col("subject_id").isNull() if "subject_id" in present else None,
        "null_timestamps": F.col("timestamp").isNull() if "timestamp" in present else None,
        "bad_timestamps": (
            F.col("timestamp").isNotNull()
            & F.col("timestamp").cast("string").try_cast("timestamp").isNull()
        ) if "timestamp" in present else None,
    }
    report = events.agg(
        F.count(F.lit(1)).alias("total_events"),
        *[
            (F.count_if(check) if check is not None else F.lit(0).cast("bigint")).alias(name)
            for name, check in checks.items()
        ],
    )
    return report.select(
        F.lit(",".join(missing)).alias("missing_columns"),
        "*",
        (F.lit(not missing) & (F.col("null_subjects") + F.col("bad_timestamps") == 0)).alias("valid"),
    )


def code_prefix_counts(events: DataFrame) -> DataFrame:
    """Events and distinct codes per code prefix.

    Counting per code first keeps the distinct count on a reduced table.
    """
    per_code = events.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_code.groupBy(F.split_part("code", F.lit("/"), F.lit(1)).alias("prefix"))
        .agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("codes"))
    )


def sort_timeline(df: DataFrame, subject: str = D.SUBJECT, order: Sequence[str] = D.TIMELINE) -> DataFrame:
    """Global order by subject and time, ties broken by row id."""
    return df.orderBy(F.col(subject), *[F.col(c).asc_nulls_last() for c in order])
