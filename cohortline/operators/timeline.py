"""Window features along subject timelines, safe for very long timelines.

A subject with more than ``max_rows`` rows is not given to one task: its rows
are range-partitioned by time into slices, and every slice receives from the
slices before it exactly the rows (or last known values) its windows reach for.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline.session import durable

MAX_ROWS = 5_000_000
BROADCAST_SUBJECTS = 100_000

Features = Callable[[WindowSpec], dict[str, Column]]


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _descending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in order]


@dataclass(frozen=True)
class Long:
    """Subjects already known to be too long for one task; none where ``names`` is None."""

    names: DataFrame | None
    rows: int
    max_rows: int


def long_subjects(counted: DataFrame, subject: str, max_rows: int) -> Long:
    """Subjects whose rows (summed over ``counted``'s column ``_n``) exceed the limit."""
    long = counted.groupBy(F.col(subject).alias("_subject")).agg(F.sum("_n").alias("_n")).filter(F.col("_n") > max_rows)
    subjects, rows = long.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not subjects:
        return Long(None, 0, max_rows)
    names = durable(long.select("_subject"))
    return Long(F.broadcast(names) if subjects <= BROADCAST_SUBJECTS else names, rows, max_rows)


def split_long(
    df: DataFrame, subject: str, max_rows: int | Long | None, slice_rows: int | None = None,
) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of ordinary subjects, rows of very long ones, and the number of slices for those."""
    if max_rows is None:
        return df, None, 0
    found = max_rows
    if not isinstance(found, Long):
        found = long_subjects(df.select(subject, F.lit(1).alias("_n")), subject, found)
    if found.names is None:
        return df, None, 0
    same = F.col(subject).eqNullSafe(F.col("_subject"))
    slices = max(2, math.ceil(found.rows / (slice_rows or found.max_rows)))
    return df.join(found.names, same, "left_anti"), df.join(found.names, same, "left_semi"), slices


def _slices(df: DataFrame, subject: str, order: Sequence[str], count: int) -> DataFrame:
    """Contiguous slices of the order (subject, time), numbered once for all uses."""
    return durable(
        df.repartitionByRange(count, F.col(subject), *_ascending(order))
        .withColumn("_slice", F.spark_partition_id())
    )


def _with_previous(cut: DataFrame, subject: str, order: Sequence[str], lookback: int) -> DataFrame:
    """Add to each slice the ``lookback`` rows before it, marked ``_before``."""
    names = [c for c in cut.columns if c != "_slice"]
    last_first = Window.partitionBy("_slice", subject).orderBy(*_descending(order))
    tails = (
        cut.withColumn("_back", F.row_number().over(last_first)).filter(F.col("_back") <= lookback)
    )
    forward = Window.partitionBy(subject).orderBy("_slice", *_ascending(order))
    ends = (
        tails.withColumn(
            "_rows", F.collect_list(F.struct(*names)).over(forward.rowsBetween(-(lookback - 1), 0))
        )
        .filter(F.col("_back") == 1)
        .withColumn("_next", F.lead("_slice").over(Window.partitionBy(subject).orderBy("_slice")))
        .filter(F.col("_next").isNotNull())
    )
    before = ends.select(F.col("_next").alias("_slice"), F.explode("_rows").alias("_row")).select(
        "_slice", "_row.*", F.lit(True).alias("_before")
    )
    return cut.withColumn("_before", F.lit(False)).unionByName(before)


def over_timeline(
    df: DataFrame,
    features: Features,
    lookback: int,
    subject: str = D.SUBJECT,
    order: Sequence[str] = D.TIMELINE,
    max_rows: int | Long | None = MAX_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add window columns that reach at most ``lookback`` rows back.

    All columns share one partitioning and order, so an ordinary table costs
    one exchange and one sort whatever the number of features.
    """
    short, long, slices = split_long(df, subject, max_rows, slice_rows)
    plain = short.withColumns(features(Window.partitionBy(subject).orderBy(*_ascending(order))))
    if long is None:
        return plain
    cut = _slices(long, subject, order, slices)
    joined = _with_previous(cut, subject, order, lookback)
    window = Window.partitionBy("_slice", subject).orderBy(*_ascending(order))
    sliced = joined.withColumns(features(window)).filter(~F.col("_before")).drop("_slice", "_before")
    return plain.unionByName(sliced)


_ROLLING = {
    "mean": lambda c, w: F.avg(c).over(w),
    "std": lambda c, w: F.coalesce(F.stddev_samp(c).over(w), F.lit(0.0)),
    "min": lambda c, w: F.min(c).over(w),
    "max": lambda c, w: F.max(c).over(w),
}


def rolling_columns(columns: Sequence[str], windows: Sequence[int], stats: Sequence[str]) -> Features:
    """Trailing statistics over the last N rows, current row included."""
    def build(window: WindowSpec) -> dict[str, Column]:
        return {
            f"{c}_rolling_{stat}_{n}": _ROLLING[stat](c, window.rowsBetween(-(n - 1), 0))
            for n in windows for c in columns for stat in stats
        }
    return build


def diff_columns(columns: Sequence[str], absolute: bool = True) -> Features:
    """Change since the previous row; first row or a missing side gives 0."""
    def build(window: WindowSpec) -> dict[str, Column]:
        out = {}
        for c in columns:
            diff = F.coalesce((F.col(c) - F.lag(c, 1).over(window)).cast("double"), F.lit(0.0))
            out[f"{c}_diff"] = diff
            if absolute:
                out[f"{c}_abs_diff"] = F.abs(diff)
        return out
    return build


def rolling_features(
    df: DataFrame, columns: Sequence[str] = D.ROLLING_COLUMNS, windows: Sequence[int] = D.ROLLING_WINDOWS,
    stats: Sequence[str] = ("mean", "std"), **timeline,
) -> DataFrame:
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    return over_timeline(df, rolling_columns(columns, windows, stats), max(1, max(windows) - 1), **timeline)


def diff_features(
    df: DataFrame, columns: Sequence[str] = D.DIFF_COLUMNS, absolute: bool = True, **timeline,
) -> DataFrame:
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    return over_timeline(df, diff_columns(columns, absolute), 1, **timeline)


def neighbours(
    df: DataFrame,
    columns: Sequence[str],
    subject: str = D.SUBJECT,
    order: Sequence[str] = D.TIMELINE,
    max_rows: int | Long | None = MAX_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add ``_pos`` and, per column, the last and next known (position, value).

    Both directions are running aggregates from the start of a (possibly
    reversed) partition: linear work, and both sorts share one exchange.
    """
    def known(window, reverse, offset):
        forward = window.rowsBetween(Window.unboundedPreceding, 0)
        backward = reverse.rowsBetween(Window.unboundedPreceding, 0)
        point = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col(c).alias("value")))
                 for c in columns}
        return (
            {"_pos": F.row_number().over(window).cast("bigint") + offset},
            {f"_prev_{c}": F.last(point[c], ignorenulls=True).over(forward) for c in columns},
            {f"_next_{c}": F.last(point[c], ignorenulls=True).over(backward) for c in columns},
        )

    def apply(frame, keys, offset=F.lit(0)):
        steps = known(
            Window.partitionBy(*keys).orderBy(*_ascending(order)),
            Window.partitionBy(*keys).orderBy(*_descending(order)), offset,
        )
        for step in filter(None, steps):
            frame = frame.withColumns(step)
        return frame

    short, long, slices = split_long(df, subject, max_rows, slice_rows)
    plain = apply(short, [subject])
    if long is None:
        return plain
    cut = _slices(long, subject, order, slices)
    # Positions in a slice start after the rows of the slices before it.
    sizes = cut.groupBy("_slice", F.col(subject).alias("_subject")).agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy("_subject").orderBy("_slice")
    earlier, later = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    same = lambda right: (F.col("s._slice") == F.col(f"{right}._slice")) & F.col(f"s.{subject}").eqNullSafe(F.col(f"{right}._subject"))
    numbered = apply(
        cut.alias("s").join(offsets.alias("o"), same("o")).select("s.*", "o._offset"),
        ["_slice", subject], F.col("_offset"),
    )
    if not columns:
        return plain.unionByName(numbered.drop("_slice", "_offset"))
    # Last and first known value per slice, carried to slices that lack one.
    point = {c: F.struct(F.col("_pos").alias("pos"), F.col(c).alias("value")) for c in columns}
    edges = numbered.groupBy("_slice", F.col(subject).alias("_subject")).agg(
        *[F.max(F.when(F.col(c).isNotNull(), point[c])).alias(f"_last_{c}") for c in columns],
        *[F.min(F.when(F.col(c).isNotNull(), point[c])).alias(f"_first_{c}") for c in columns],
    )
    backwards = Window.partitionBy("_subject").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        "_slice", "_subject",
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in columns],
        *[F.last(f"_first_{c}", ignorenulls=True).over(backwards).alias(f"_out_{c}") for c in columns],
    )
    names = df.columns
    filled = numbered.alias("s").join(carried.alias("k"), same("k")).select(
        *[F.col(f"s.{n}").alias(n) for n in names], F.col("s._pos").alias("_pos"),
        *[F.coalesce(F.col(f"s._prev_{c}"), F.col(f"k._in_{c}")).alias(f"_prev_{c}") for c in columns],
        *[F.coalesce(F.col(f"s._next_{c}"), F.col(f"k._out_{c}")).alias(f"_next_{c}") for c in columns],
    )
    return plain.unionByName(filled)


def last_known(c: str) -> Column:
    return F.col(f"_prev_{c}.value")


def next_known(c: str) -> Column:
    return F.col(f"_next_{c}.value")


def nearest_known(c: str) -> Column:
    """The last known value, or the next one before the first is known."""
    return F.coalesce(last_known(c), next_known(c))


def on_the_line(c: str) -> Column:
    """Linear by position between the neighbours; the ends take the nearest value."""
    left, right = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
    slope = (right["value"] - left["value"]) / (right["pos"] - left["pos"])
    return (
        F.when(left.isNull() | right.isNull() | (left["pos"] == right["pos"]), nearest_known(c))
        .otherwise(left["value"] + slope * (F.col("_pos") - left["pos"])).cast("double")
    )


_FILLS = {"ffill": last_known, "bfill": next_known, "both": nearest_known}


def fill_with(df: DataFrame, fills: dict[str, Callable[[str], Column]], **timeline) -> DataFrame:
    """Replace columns by functions of their neighbours, all in one pass."""
    found = neighbours(df, list(fills), **timeline)
    return found.select([fills[c](c).alias(c) if c in fills else F.col(c) for c in df.columns])


def fill_gaps(df: DataFrame, columns: Sequence[str], method: str = "both", **timeline) -> DataFrame:
    """Carry the last (``ffill``), next (``bfill``) or last-then-next value (``both``)."""
    if method not in _FILLS:
        raise ValueError(f"unknown fill method {method!r}")
    return fill_with(df, {c: _FILLS[method] for c in columns}, **timeline)


def interpolate(df: DataFrame, columns: Sequence[str], method: str = "linear", **timeline) -> DataFrame:
    """``linear`` between known neighbours, or ``pad`` with the last known value."""
    if method not in ("linear", "pad"):
        raise ValueError(f"unknown interpolation {method!r}")
    fill = on_the_line if method == "linear" else last_known
    return fill_with(df, {c: fill for c in columns}, **timeline)


def sliding_sequences(
    df: DataFrame,
    features: Sequence[str],
    label: str = D.LABEL,
    lookback: int = 48,
    horizon: int = 24,
    stride: int = 1,
    subject: str = D.SUBJECT,
    order: Sequence[str] = (D.TIME,),
    max_rows: int | Long | None = MAX_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    """Every window of ``lookback`` rows with the label ``horizon`` rows later.

    Windows are built looking back from the label row: a full frame exists
    exactly when the subject has enough rows, so no count per subject is needed.
    """
    span = lookback + horizon
    if stride != 1:
        df = neighbours(df, [], subject, order, max_rows, slice_rows)
    row = F.array(*[F.col(c).cast("float") for c in features])

    def build(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(-(span - 1), -horizon)
        return {
            "sequence": F.collect_list(row).over(frame),
            "start_time": F.first(order[0]).over(frame),
            "end_time": F.last(order[0]).over(frame),
        }

    made = over_timeline(df, build, span - 1, subject, order, max_rows, slice_rows)
    kept = made.filter(F.size("sequence") == lookback)
    if stride != 1:
        kept = kept.filter((F.col("_pos") - span) % stride == 0)
    return kept.select(
        subject, "start_time", "end_time", F.col(order[0]).alias("label_time"),
        "sequence", F.col(label).cast("float").alias("target"),
    )
