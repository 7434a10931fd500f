"""Irregular timelines on a regular grid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline.operators.timeline import MAX_ROWS, Long, long_subjects, neighbours, over_timeline, sliding_sequences

DAY = 86_400_000_000
BLOCK = 4_096            # empty bins made from one row at a time


def _wall_micros(time: str) -> Column:
    """Microseconds since 1970 on the column's own clock, whatever the session's zone."""
    t = F.col(time)
    seconds = F.hour(t) * 3600 + F.minute(t) * 60
    return (
        F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint") * DAY + seconds.cast("bigint") * 1_000_000
        + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint"))


def _from_wall(micros: str) -> Column:
    return F.expr(
        f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(CAST({micros} DIV {DAY} AS INT), 0, 0, "
        f"CAST(({micros} % {DAY}) / 1000000 AS DECIMAL(18, 6)))")


def _aggregate(column: str, how: str, order: Column) -> Column:
    value = F.col(column)
    known = F.when(value.isNotNull(), order)
    rules = {
        "mean": lambda: F.avg(value), "max": lambda: F.max(value), "min": lambda: F.min(value),
        "last": lambda: F.max_by(value, known), "first": lambda: F.min_by(value, known),
    }
    if how not in rules:
        raise ValueError(f"unknown aggregation {how!r}")
    return rules[how]().alias(column)


def long_grids(df: DataFrame, seconds: int, subject: str, time: str, max_rows: int | Long | None) -> Long | None:
    """Subjects whose rows or bins exceed the limit, counted from two columns before any bin is made."""
    if max_rows is None or isinstance(max_rows, Long):
        return max_rows
    seen = df.filter(F.col(time).isNotNull()).select(subject, F.unix_micros(F.col(time).cast("timestamp")).alias("_at"))
    bins = ((F.max("_at") - F.min("_at")) / (seconds * 1_000_000)).cast("bigint") + 2
    counted = seen.groupBy(subject).agg(F.greatest(F.count(F.lit(1)), bins).alias("_n"))
    return long_subjects(counted, subject, max_rows)


def _bins(df: DataFrame, how: Mapping[str, str], step: int, subject: str, time: str, row_id: str) -> DataFrame:
    """One row per subject and bin that holds observations."""
    rows = df.filter(F.col(time).isNotNull()).withColumn("_at", _wall_micros(time))
    if DAY % step == 0:
        origin = F.lit(0)
    else:
        first = rows.groupBy(subject).agg(F.min("_at").alias("_first"))
        first = first.withColumnRenamed(subject, "_whose")
        rows = rows.join(first, F.col(subject).eqNullSafe(F.col("_whose"))).drop("_whose")
        origin = F.col("_first") - F.pmod(F.col("_first"), F.lit(DAY))
    rows = rows.withColumn("_bin", F.col("_at") - F.pmod(F.col("_at") - origin, F.lit(step)))
    order = F.struct("_at", row_id) if row_id in df.columns else F.col("_at")
    return rows.groupBy(subject, "_bin").agg(*[_aggregate(c, h, order) for c, h in how.items()])


def _with_slots(bins: DataFrame, step: int, max_gap_rows: int | None) -> DataFrame:
    """A row for each empty bin after ``_left`` (the bin before) and for the bin itself, as ``_slot``."""
    empty = F.coalesce((F.col("_bin") - F.col("_left")) / step, F.lit(1)).cast("bigint") - 1
    if max_gap_rows is not None:
        error = F.raise_error(F.lit(f"gap of more than {max_gap_rows} bins: check timestamps"))
        empty = F.when(empty + 1 > max_gap_rows, error.cast("bigint")).otherwise(empty)
    blocks = bins.withColumn("_empty", empty).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.expr(f"_empty DIV {BLOCK}"))))
    back = F.sequence(F.col("_block") * BLOCK, F.least(F.col("_empty"), (F.col("_block") + 1) * BLOCK - 1))
    return blocks.withColumn("_ago", F.explode(back)).withColumn("_slot", F.col("_bin") - F.col("_ago") * step)


def resample(
    df: DataFrame,
    how: Mapping[str, str],
    seconds: int = 3600,
    subject: str = D.SUBJECT,
    time: str = D.TIME,
    row_id: str = D.EVENT_ID,
    max_gap_rows: int | None = None,
    max_rows: int | Long | None = MAX_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    """One row per subject and bin from the first to the last observation.

    ``how`` maps columns to mean, last, first, max or min. Bins are left
    labelled and counted from the midnight before the subject's first row;
    bins without rows hold nulls. All is reckoned on the clock of the column, so
    the session's time zone and its changes play no part. Rows without a subject
    are a timeline of their own. ``max_gap_rows`` ends the job at longer gaps. Rows are reduced to bins before anything is
    partitioned by subject, and empty bins are generated from each bin's gap to
    the one before it, so there is no separate grid to join. Subjects of more than ``max_rows`` rows or
    bins are cut into time slices before that.
    """
    step = seconds * 1_000_000
    long = long_grids(df, seconds, subject, time, max_rows)
    bins = _bins(df, how, step, subject, time, row_id)
    bins = over_timeline(bins, lambda w: {"_left": F.lag("_bin").over(w)}, 1, subject, ("_bin",), long, slice_rows)
    grid = _with_slots(bins, step, max_gap_rows)
    observed = F.col("_slot") == F.col("_bin")
    return grid.select(
        subject, _from_wall("_slot").cast(df.schema[time].dataType).alias(time),
        *[F.when(observed, F.col(c)).alias(c) for c in how],
    )


def resample_fill(
    df: DataFrame, how: Mapping[str, str], lines: Sequence[str] | None = None, method: str = "linear",
    seconds: int = 3600, subject: str = D.SUBJECT, time: str = D.TIME, row_id: str = D.EVENT_ID,
    max_gap_rows: int | None = None, max_rows: int | Long | None = MAX_ROWS, slice_rows: int | None = None,
) -> DataFrame:
    """Resample, interpolate the ``mean``-like columns, carry the others forward then back.

    Labels and categories (``last``/``first``) are never interpolated. The last
    and next known values are found among the bins that hold rows, and empty bins are
    filled as they are made, so no window ever runs over the grid. Long
    subjects are cut into time slices that carry these values to each other.
    """
    step = seconds * 1_000_000
    drawn = set(lines if lines is not None else [c for c, h in how.items() if h in ("mean", "max", "min")])
    long = long_grids(df, seconds, subject, time, max_rows)
    bins = _bins(df, how, step, subject, time, row_id)
    points = bins.select(subject, "_bin", *[
        F.when(F.col(c).isNotNull(), F.struct(F.col("_bin").alias("bin"), F.col(c).alias("value"))).alias(c) for c in how])
    found = neighbours(points, list(how), subject, ("_bin",), long, slice_rows).select(
        subject, "_bin", *[F.col(f"_prev_{c}.value").alias(f"_prev_{c}") for c in how],
        *[F.col(f"_next_{c}.value").alias(f"_next_{c}") for c in how])
    before = lambda w: {"_left": F.lag("_bin").over(w), **{f"_lag_{c}": F.lag(f"_prev_{c}").over(w) for c in how}}
    grid = _with_slots(over_timeline(found, before, 1, subject, ("_bin",), long, slice_rows), step, max_gap_rows)
    observed = F.col("_slot") == F.col("_bin")

    def fill(c: str) -> Column:
        left = F.when(observed, F.col(f"_prev_{c}")).otherwise(F.col(f"_lag_{c}"))
        right = F.col(f"_next_{c}")
        nearest = F.coalesce(left["value"], right["value"])
        if c not in drawn or method != "linear":
            return nearest
        slope = (right["value"] - left["value"]) / ((right["bin"] - left["bin"]) / step)
        return F.when(
            left.isNull() | right.isNull() | (left["bin"] == right["bin"]), nearest
        ).otherwise(left["value"] + slope * ((F.col("_slot") - left["bin"]) / step)).cast("double")

    return grid.select(
        subject, _from_wall("_slot").cast(df.schema[time].dataType).alias(time), *[fill(c).alias(c) for c in how])


def sequence_dataset(
    df: DataFrame, how: Mapping[str, str], features: Sequence[str], label: str = D.LABEL,
    lookback: int = 48, horizon: int = 24, stride: int = 1, seconds: int = 3600,
    subject: str = D.SUBJECT, time: str = D.TIME, row_id: str = D.EVENT_ID, max_gap_rows: int | None = None,
    max_rows: int | Long | None = MAX_ROWS, slice_rows: int | None = None,
) -> DataFrame:
    """Resample, fill, then cut windows with their labels; long grids in time slices that look back."""
    long = long_grids(df, seconds, subject, time, max_rows)
    grid = resample_fill(
        df, how, seconds=seconds, subject=subject, time=time, row_id=row_id, max_gap_rows=max_gap_rows,
        max_rows=long, slice_rows=slice_rows)
    return sliding_sequences(
        grid, features, label, lookback, horizon, stride, subject=subject, order=(time,), max_rows=long,
        slice_rows=slice_rows)
