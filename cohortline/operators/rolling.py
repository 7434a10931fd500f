"""Trailing statistics over spans of time, safe for very dense timelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline.operators.timeline import _ROLLING, MAX_ROWS, Long, long_subjects

SECOND, HOUR = 1_000_000, 3_600_000_000
KEY = ["_who", "_chunk"]


def _added(names: Sequence[str], over=None) -> list[Column]:
    """Sums of counts and moments, least and greatest values, as columns of the same names."""
    rule = {"n": F.sum, "s": F.sum, "q": F.sum, "lo": F.min, "hi": F.max}
    made = [rule[name.split("_")[1]](name) for name in names]
    return [(m if over is None else m.over(over)).alias(n) for m, n in zip(made, names)]


def _none(names: Sequence[str], like: DataFrame) -> list[Column]:
    return [F.lit(None).cast(like.schema[n].dataType).alias(n) for n in names]


def _dense(rows: DataFrame, columns: Sequence[str], hours: Sequence[int], stats: Sequence[str]) -> DataFrame:
    """Statistics of each instant of the dense chunks.

    Rows are summed to instants, instants to seconds, seconds to hours. A window
    (t - W, t] is the instants of t's second up to t, the seconds of t's hour before
    it, the whole hours between, the seconds after t - W in its hour, and the instants
    after t - W in its second. Each part is a running aggregate within one
    second (at most a million instants), one hour (3,600 seconds) or one chunk of hours, and
    nothing is subtracted. W is whole hours, so t - W is marked by a row of its own at the same place of its second.
    """
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    centre = rows.agg(*[F.avg(F.when(known(c), F.col(c).cast("double"))) for c in columns]).first()
    # Moments about the mean of all, so that squares do not swallow the spread.
    far = {c: F.col(c).cast("double") - F.lit(float(m or 0.0)) for c, m in zip(columns, centre)}
    names = [f"m{i}_{part}" for i in range(len(columns)) for part in ("n", "s", "q", "lo", "hi")]
    first = []
    for i, c in enumerate(columns):
        first += [F.count(c).alias(f"m{i}_n"), F.sum(far[c]).alias(f"m{i}_s"), F.sum(far[c] * far[c]).alias(f"m{i}_q"),
                  F.min(c).alias(f"m{i}_lo"), F.max(c).alias(f"m{i}_hi")]
    step = lambda at, width: F.expr(f"({at} - pmod({at}, {width})) DIV {width}")
    instants = rows.groupBy(*KEY, "_at").agg(*first).withColumn("_second", step("_at", SECOND))
    seconds = instants.groupBy(*KEY, "_second").agg(*_added(names)).withColumn("_hour", step("_second", 3600))
    whole = seconds.groupBy(*KEY, "_hour").agg(*_added(names))
    spans = F.explode(F.array(*[F.lit(h) for h in hours])).alias("_span")

    def marks(table: DataFrame, at: str, length: int, group: str, width: int) -> DataFrame:
        """For each row and span, what lies after ``at`` minus the span in that place's group."""
        asked = table.select(*KEY, at, spans).select(
            *KEY, (F.col(at) - F.col("_span") * length).alias("_place"), F.col(at).alias("_from"), "_span", *_none(names, table))
        there = table.select(
            *KEY, F.col(at).alias("_place"), F.lit(None).cast("bigint").alias("_from"), F.lit(None).cast("int").alias("_span"), *names)
        both = there.unionByName(asked).withColumn(group, step("_place", width)).withColumn("_back", -F.col("_place"))
        # Backwards, as a frame that runs from the start costs linear work.
        later = Window.partitionBy(*KEY, group).orderBy("_back").rangeBetween(Window.unboundedPreceding, -1)
        return both.select(*KEY, "_from", "_span", *_added(names, later)).where("_span IS NOT NULL").withColumnRenamed("_from", at)

    between = Window.partitionBy(*KEY).orderBy("_hour")
    hourly = None
    if max(hours) > 1:
        spread_out = whole.select(*KEY, "_hour", *[
            F.struct(F.lit(h).alias("_span"), *_added(names, between.rangeBetween(-(h - 1), -1))).alias(f"_m{h}")
            for h in hours if h > 1])
        hourly = spread_out.select(*KEY, "_hour", F.explode(F.array(*[f"_m{h}" for h in hours if h > 1])).alias("_m"))
        hourly = hourly.select(*KEY, "_hour", "_m.*")
    earlier = Window.partitionBy(*KEY, "_hour").orderBy("_second").rangeBetween(Window.unboundedPreceding, -1)
    parts = seconds.select(*KEY, "_second", *_added(names, earlier)).select("*", spans)
    parts = parts.unionByName(marks(seconds, "_second", 3600, "_hour", 3600))
    if hourly is not None:
        parts = parts.unionByName(seconds.select(*KEY, "_second", "_hour").join(hourly, [*KEY, "_hour"]).drop("_hour"))
    by_second = parts.groupBy(*KEY, "_second", "_span").agg(*_added(names))
    upto = Window.partitionBy(*KEY, "_second").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    parts = instants.select(*KEY, "_at", *_added(names, upto)).select("*", spans)
    parts = parts.unionByName(marks(instants, "_at", HOUR, "_second", SECOND))
    parts = parts.unionByName(instants.select(*KEY, "_at", "_second").join(by_second, [*KEY, "_second"]).drop("_second"))

    one = parts.groupBy(*KEY, "_at", "_span").agg(*_added(names))
    made = []
    for i, c in enumerate(columns):
        n, s, q = (F.col(f"m{i}_{x}") for x in ("n", "s", "q"))
        spread = F.sqrt(F.greatest(q - s * s / n, F.lit(0.0)) / (n - 1))
        values = {
            "mean": F.when(n > 0, s / n + F.lit(float(centre[columns.index(c)] or 0.0))),
            "std": F.when((n > 1) & (F.col(f"m{i}_lo") < F.col(f"m{i}_hi")), spread).otherwise(0.0),
            "min": F.col(f"m{i}_lo"), "max": F.col(f"m{i}_hi"),
        }
        made += [values[stat].alias(f"{c}_{stat}") for stat in stats]
    one = one.select(*KEY, "_at", "_span", *made)
    return one.groupBy(*KEY, "_at").agg(*[
        F.max(F.when(F.col("_span") == h, F.col(f"{c}_{stat}"))).alias(f"{c}_rolling_{stat}_{h}h")
        for h in hours for c in columns for stat in stats])


def rolling_time(
    df: DataFrame, columns: Sequence[str], hours: Sequence[int], stats: Sequence[str] = ("mean", "std"),
    subject: str = D.SUBJECT, time: str = D.TIME, chunk: int = 4, max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Trailing statistics over the last N hours, left end open.

    Rows are placed in time chunks ``chunk`` times as long as the longest
    window and copied into the next chunk where it reaches back to them, so
    the partition key is (subject, chunk) and no timeline is one task's work.
    Chunks above ``max_rows`` rows are summed level by level (see ``_dense``), because a frame
    that slides over rows costs rows times the window's rows. Rows without a time are a window of their own;
    subjects that are null are one subject. NaN counts as a value, as in Spark's own windows.
    """
    micros = max(hours) * HOUR
    width = chunk * micros
    at = F.unix_micros(F.col(time).cast("timestamp"))

    def place(frame: DataFrame) -> DataFrame:
        frame = frame.withColumn("_at", at).withColumn("_home", F.expr(f"(_at - pmod(_at, {width})) DIV {width}"))
        reaches_next = F.pmod(F.col("_at"), F.lit(width)) > width - micros
        return frame.withColumn("_chunk", F.explode(
            F.when(reaches_next, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(F.array("_home"))))

    names = [f"{c}_rolling_{stat}_{h}h" for h in hours for c in columns for stat in stats]
    window = Window.partitionBy(subject, "_chunk").orderBy("_at")
    added = {
        f"{c}_rolling_{stat}_{h}h": _ROLLING[stat](c, window.rangeBetween(-h * HOUR + 1, 0))
        for h in hours for c in columns for stat in stats
    }
    home = F.col("_chunk").eqNullSafe(F.col("_home"))
    placed = place(df)
    long = Long(None, 0, 0)
    if max_rows is not None:
        counted = place(df.select(F.col(subject).alias("_s"), time)).where("_chunk IS NOT NULL").select(
            F.struct("_s", "_chunk").alias("_group"), F.lit(1).alias("_n"))
        long = long_subjects(counted, "_group", max_rows)
    if long.names is None:
        return placed.withColumns(added).filter(home).select(*df.columns, *names)
    names_of = long.names
    group = F.struct(F.col(subject).alias("_s"), F.col("_chunk"))
    same = group.eqNullSafe(F.col("_subject"))
    plain = placed.join(names_of, same, "left_anti").withColumns(added).filter(home).select(*df.columns, *names)
    # A null subject is a key like others: joins by a struct that tells it from all values.
    dense = placed.join(names_of, same, "left_semi").withColumn("_who", F.struct(F.col(subject).isNull().alias("none"), F.coalesce(
        F.col(subject).cast("string"), F.lit("")).alias("name")))
    found = _dense(dense, columns, hours, stats)
    return plain.unionByName(dense.where(home).join(found, [*KEY, "_at"]).select(*df.columns, *names))
