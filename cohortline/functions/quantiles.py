"""Quantiles and running sums of whole columns without one task seeing all values."""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import nullcontext

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.session import durable, kept

LEVELS = 512
MOST = 200_000


def running_sums(df: DataFrame, order: Sequence[str | Column], values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``{value}_upto``: the sum over the rows up to and with this one, in this order, within ``by``.

    Rows are cut into ranges of (by, order); a range adds the totals of the
    ranges before it to its own running sums, so a window sees one range only.
    ``by`` columns must not be null. Rows of equal order share a range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written, so that the ranges are the same for the totals and for the sums.
    ranged = durable(df.repartitionByRange(parts, *by, *order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(v).alias(f"_in_{v}") for v in values])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, "_range", *[F.coalesce(F.sum(f"_in_{v}").over(before), F.lit(0)).alias(f"_before_{v}") for v in values])
    inside = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.join(totals, [*by, "_range"])
    return summed.select(*df.columns, *[(F.col(f"_before_{v}") + F.sum(v).over(inside)).alias(f"{v}_upto") for v in values])


def _outline(values: DataFrame, keys: Sequence[str], columns: Sequence[str], levels: int) -> dict:
    """(key..., column) -> number of values, and a sorted array of values with the rank each has about.

    Each group of partitions has a sketch of its own and gives ``levels`` of
    its quantiles; their weighted union outlines the whole column, so sketches
    are never merged in one place.
    """
    shares = ", ".join(f"{i / levels!r}D" for i in range(levels + 1))
    groups = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = values.groupBy(*keys, F.pmod(F.spark_partition_id(), F.lit(groups)).alias("_group")).agg(
        *[F.count(c).alias(f"n:{c}") for c in columns],
        # A rank error far below the distance of two levels.
        *[F.expr(f"percentile_approx(`{c}`, array({shares}), {20 * levels})").alias(f"q:{c}") for c in columns],
    ).collect()
    parts: dict[tuple, list] = {}
    for row in rows:
        for c in columns:
            parts.setdefault((*[row[k] for k in keys], c), []).append((row[f"n:{c}"], row[f"q:{c}"]))
    found = {}
    for key, groups_ in parts.items():
        known = [(n, np.array(q, float)) for n, q in groups_ if n]
        total = sum(n for n, _ in known)
        if total:
            marks = np.concatenate([q for _, q in known])
            weight = np.concatenate([np.concatenate([[0.0], np.full(levels, n / levels)]) for n, _ in known])
            order = np.argsort(marks, kind="stable")
            found[key] = (total, marks[order], np.cumsum(weight[order]), total * 1.1 / levels + len(known))
    return found


def _enclosed(outline, first: int, last: int) -> tuple[float, float]:
    """Two values between which the ranks ``first`` to ``last`` lie, unless the outline errs more than it should."""
    _, marks, ranks, error = outline
    low = np.searchsorted(ranks, first - error, side="right") - 1
    high = np.searchsorted(ranks, last + 1 + error, side="left")
    return float(marks[max(low, 0)]), float(marks[min(high, len(marks) - 1)])


def _below(a: str, b: float) -> Column:
    return F.col(a) < F.lit(b)  # NaN is the greatest value in Spark, here as in a sort


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], levels: int = LEVELS, most: int = MOST,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, nulls ignored, per column. Exact.

    A multi-rank selection by narrowing ranges. Sketches of groups of
    partitions outline each column; a pass counts the values below and inside
    the range of each wanted rank (and so checks the outline); what is inside
    is outlined again until at most ``most`` values are left in all, which are
    counted by value. Ranges that ties keep from narrowing end in
    ``running_sums``. The driver holds levels x groups x columns numbers.
    The columns are kept while this lasts, so that what gives them is computed
    once and not in every pass, unless the caller keeps the table.
    NaN counts as the greatest value.
    """
    columns = list(columns)
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    if not columns or not len(probabilities):
        return out
    names = {f"_{i}": c for i, c in enumerate(columns)}
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(i) for i, c in names.items()])
    stored = df.storageLevel
    with nullcontext() if stored.useMemory or stored.useDisk else kept(values):
        for (i, p), value in _selected(values, names, probabilities, levels, most).items():
            out[names[i]][p] = value
    return out


def _selected(
    values: DataFrame, names: dict[str, str], probabilities: Sequence[float], levels: int, most: int,
) -> dict[tuple[str, int], float]:
    """(column, place of the probability) -> quantile."""
    outlines = {key[0]: o for key, o in _outline(values, (), list(names), levels).items()}
    slots = {}  # number -> column, place of the probability, position among the sorted values
    for i, c in names.items():
        for p, share in enumerate(probabilities if i in outlines else ()):
            slots[len(slots)] = (i, p, float(share) * (outlines[i][0] - 1))
    ranks = {s: (math.floor(at), math.ceil(at)) for s, (_, _, at) in slots.items()}
    ends = {i: (float(o[1][0]), float(o[1][-1])) for i, o in outlines.items()}
    bounds = {s: _enclosed(outlines[i], *ranks[s]) for s, (i, _, _) in slots.items()}
    at: dict[tuple[int, int], float] = {}
    inside: dict[int, int] = {}
    while bounds:
        below, size = _counted(values, slots, bounds)
        wrong = [s for s in bounds if below[s] > ranks[s][0] or below[s] + size[s] <= ranks[s][1]]
        if wrong:  # an outline may miss; the ends of the column never do
            bounds.update({s: ends[slots[s][0]] for s in wrong})
            continue
        for s in [s for s, (low, high) in bounds.items() if low == high or (math.isnan(low) and math.isnan(high))]:
            at.update({(s, rank): bounds[s][0] for rank in ranks[s]})
            del bounds[s]
        if not bounds:
            break
        stuck = {s for s in bounds if size[s] > most // max(len(bounds), 1) and size[s] > 0.7 * inside.get(s, math.inf)}
        if stuck or sum(size[s] for s in bounds) <= most:
            chosen = {s: bounds[s] for s in (stuck or bounds)}
            counts = _inside(values, slots, chosen).groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))
            if stuck:
                wanted = F.create_map(*[x for s in chosen for x in (F.lit(s), F.array(*[F.lit(r - below[s]) for r in ranks[s]]))])
                summed = running_sums(counts, ["value"], ["n"], ["slot"])
                counts = summed.where(F.exists(wanted[F.col("slot")], lambda r: (r < F.col("n_upto")) & (r >= F.col("n_upto") - F.col("n"))))
                hits = [(r["slot"], r["value"], r["n_upto"] - r["n"], r["n_upto"]) for r in counts.collect()]
            else:
                hits = _positions([(r["slot"], r["value"], r["n"]) for r in counts.collect()])
            for s, value, first, end in hits:
                at.update({(s, rank): value for rank in ranks[s] if first <= rank - below[s] < end})
            for s in chosen:
                del bounds[s]
            continue
        inside = dict(size)
        nested = _outline(_inside(values, slots, bounds), ("slot",), ["value"], levels)
        bounds = {s: _enclosed(nested[s, "value"], *[r - below[s] for r in ranks[s]]) for s in bounds}
    out = {}
    for s, (i, p, position) in slots.items():
        low, high = (at[s, rank] for rank in ranks[s])
        out[i, p] = low + (high - low) * (position - ranks[s][0]) if high != low else low
    return out


def _counted(values, slots, bounds) -> tuple[dict[int, int], dict[int, int]]:
    """Per slot the number of values below its range and inside it, in one pass."""
    row = values.agg(
        *[F.count_if(_below(slots[s][0], low)).alias(f"b{s}") for s, (low, _) in bounds.items()],
        *[F.count_if(F.col(slots[s][0]).between(F.lit(low), F.lit(high))).alias(f"i{s}") for s, (low, high) in bounds.items()],
    ).first()
    return {s: row[f"b{s}"] for s in bounds}, {s: row[f"i{s}"] for s in bounds}


def _inside(values, slots, bounds) -> DataFrame:
    """(slot, value) for each value inside a slot's range."""
    kept = {s: F.col(slots[s][0]).between(F.lit(low), F.lit(high)) for s, (low, high) in bounds.items()}
    entries = F.array_compact(F.array(*[
        F.when(k, F.struct(F.lit(s).alias("slot"), F.col(slots[s][0]).alias("value"))) for s, k in kept.items()]))
    return values.select(F.inline(entries))


def _positions(counts: list[tuple]) -> list[tuple]:
    """(slot, value, first place, end) of values counted per slot."""
    out, slot, upto = [], None, 0
    for s, value, n in sorted(counts, key=lambda x: (x[0], math.isnan(x[1]), x[1])):
        upto = 0 if s != slot else upto
        out.append((s, value, upto, upto + n))
        slot, upto = s, upto + n
    return out


def landmarks(df: DataFrame, columns: Sequence[str], points: int) -> dict[str, list[float]]:
    """Values at ``points`` evenly spaced places of each sorted column, interpolated; fewer for fewer rows.

    One pass counts by (column, value); places come from ``running_sums``, and
    only the values at wanted places reach the driver: two per point at most.
    """
    columns = list(columns)
    if not columns:
        return {}
    sizes = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(f"`{c}`").alias(f"n:{c}") for c in columns]).first()
    points = max(1, min(points, sizes["rows"]))
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("double").alias("value"), F.lit(sizes[f"n:{c}"] - 1).cast("long").alias("m"))
                      for i, c in enumerate(columns)])
    counts = df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("column", "m", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = running_sums(counts, ["value"], ["n"], ["column"]).withColumns({"first": F.col("n_upto") - F.col("n"), "last": F.col("n_upto") - 1})
    steps = max(points - 1, 1)
    # Point k lies at place k * m / steps; kept are the values at the whole places on both its sides.
    down = F.expr(f"(first * {steps} + m - 1) DIV m <= ((last + 1) * {steps} + m - 1) DIV m - 1")
    up = F.expr(f"CASE WHEN first = 0 THEN 0 ELSE ((first - 1) * {steps}) DIV m + 1 END <= (last * {steps}) DIV m")
    found: dict[int, list] = {}
    for r in rows.where((F.col("m") == 0) | down | up).select("column", "value", "first", "last").collect():
        found.setdefault(r["column"], []).append((r["first"], r["last"], r["value"]))
    out = {}
    for i, c in enumerate(columns):
        spans = sorted(found.get(i, []))
        if spans:
            first, value = np.array([s[0] for s in spans]), np.array([s[2] for s in spans])
            m = sizes[f"n:{c}"] - 1
            whole = [divmod(k * m, steps) for k in range(points)]
            at = lambda place: value[np.searchsorted(first, place, side="right") - 1]  # noqa: E731, B023
            out[c] = [float(at(q) + (at(q + (rest > 0)) - at(q)) * (rest / steps)) for q, rest in whole]
    return out
