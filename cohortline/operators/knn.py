"""Imputation from the nearest rows, exact, without comparing all pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.operators.lookup import map_lookup
from cohortline.session import durable

_BLOCK = 250_000
_CELL_ROWS = 100_000
_FRONT = 1_000_000
_AT_ONCE = 1_000


def _with_curve(
    df: DataFrame, columns: Sequence[str], low: dict[str, float | None], unit: float, bits: int,
) -> DataFrame:
    """Add ``_at``, the position on a bit-interleaving curve over steps of one width in all columns.

    One width for all columns, because distance is in raw units: a column of
    small spread hardly matters for it and is hardly cut.
    """
    steps = {}
    for i, c in enumerate(columns):
        step = F.floor((F.col(c) - F.lit(low[c] or 0.0)) / F.lit(unit))
        steps[f"_step{i}"] = F.coalesce(F.greatest(F.lit(0), F.least(step, F.lit(2**bits - 1))), F.lit(0)).cast("bigint")
    position = F.lit(0).cast("bigint")
    for i, name in enumerate(steps):
        for bit in range(bits):
            one = F.shiftright(F.col(name), bit).bitwiseAND(F.lit(1).cast("bigint"))
            position = position + F.shiftleft(one, bit * len(columns) + i)
    # The steps are used bit by bit: a stage of their own computes them once.
    return df.withColumns(steps).withColumn("_at", position).drop(*steps)


@dataclass(frozen=True)
class _Boxes:
    """Extents of the cells, and of groups of neighbouring cells above them: a tree of two levels."""

    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    always: np.ndarray  # all rows know the column
    known: np.ndarray  # rows that know it
    fan: int = 64

    @classmethod
    def of(cls, cells: DataFrame, columns: Sequence[str]) -> _Boxes:
        rows = cells.groupBy("_cell").agg(
            *[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
            *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)],
            *[F.every(F.col(c).isNotNull()).alias(f"all{i}") for i, c in enumerate(columns)],
            *[F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col("_m"))), F.lit(0)).alias(f"n{i}") for i, c in enumerate(columns)],
        ).orderBy("_cell").toPandas()

        def part(name: str, kind: type) -> np.ndarray:
            return rows[[f"{name}{i}" for i in range(len(columns))]].to_numpy(dtype=kind)

        return cls(rows["_cell"].to_numpy(dtype=np.int32), part("lo", float), part("hi", float), part("all", bool), part("n", float))

    def above(self) -> _Boxes:
        """One box around each ``fan`` cells; cells follow the curve, so these lie close together."""
        starts = np.arange(0, len(self.cell), self.fan)
        fold = lambda op, x: op.reduceat(x, starts, axis=0) if len(starts) else x
        return _Boxes(starts, fold(np.fmin, self.low), fold(np.fmax, self.high), fold(np.logical_and, self.always), fold(np.add, self.known))

    def part(self, start: int) -> _Boxes:
        s = slice(start, start + self.fan)
        return _Boxes(self.cell[s], self.low[s], self.high[s], self.always[s], self.known[s])

    def nearest_possible(self, points: np.ndarray, has: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(points x boxes) lower bound of the distance to any row inside, and whether all rows there have a distance."""
        square = np.zeros((len(points), len(self.cell)))
        for f in range(points.shape[1]):
            x = points[:, f][:, None]
            gap = np.fmax(np.fmax(self.low[:, f][None, :] - x, x - self.high[:, f][None, :]), 0.0)
            square += np.where(self.always[:, f][None, :] & has[:, f][:, None], gap * gap, 0.0)
        # A pair shares at most the columns that some row of the box knows.
        shared = has.astype(float) @ (self.known > 0).T.astype(float)
        lower = np.where(shared > 0, square * points.shape[1] / np.maximum(shared, 1), np.inf)
        return lower, has.astype(float) @ self.always.T.astype(float) > 0

    def ranks(self, points: np.ndarray, has: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(points x boxes) what orders the boxes to be tried: the kind, the least distance and the mean one."""
        near, certain = self.nearest_possible(points, has)
        full = has.astype(float) @ self.always.T.astype(float) == has.sum(axis=1)[:, None]
        kind = np.where(full, 0, np.where(certain, 1, 2)) + np.where(np.isfinite(near), 0, 3)
        return kind, near, self.from_rows(points)

    def from_rows(self, points: np.ndarray) -> np.ndarray:
        """(points x boxes) mean squared distance to rows spread evenly over the box, over the columns both know.

        Rows along a curve may leave most of a wide box empty, so wide boxes come after narrow ones around the same place.
        """
        square = np.zeros((len(points), len(self.cell)))
        for f in range(points.shape[1]):
            low, high = self.low[:, f], self.high[:, f]
            square += np.nan_to_num(np.square(points[:, f][:, None] - (low + high) / 2) + np.square(high - low) / 12)
        return square


def _first_cells(boxes: _Boxes, above: _Boxes, points: np.ndarray, k: int, least: int = 1) -> list[np.ndarray]:
    """For each point the nearest cells that together offer k rows for each of its gaps, and ``least`` cells where a group has them.

    Cells whose rows all know what the point knows come first, as only their distance is known well; of cells that
    may be equally near those come first whose rows are nearer in the mean.
    """
    has = ~np.isnan(points)
    need = np.where(has, 0.0, float(k))
    need[~has.any(1)] = 0.0  # nothing to measure by
    count = np.zeros(len(points), np.int64)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    groups = above.ranks(points, has)
    for _ in range(len(above.cell)):
        waiting = np.flatnonzero((need > 0).any(1))
        if not len(waiting):
            break
        group = _next(groups, waiting)
        for g in np.unique(group):
            rows = waiting[group == g]
            part = boxes.part(int(above.cell[g]))
            ranks = part.ranks(points[rows], has[rows])
            possible, left = np.isfinite(ranks[1]), np.arange(len(rows))
            for _ in range(len(part.cell)):
                gaps = need[rows[left]] > 0
                left, gaps = (x[gaps.any(1) | (count[rows[left]] < least)] for x in (left, gaps))
                if not len(left):
                    break
                cell, some = _next(ranks, left), rows[left]
                wanted = np.where(gaps.any(1)[:, None], gaps, ~has[some])
                taken = possible[left, cell] & ((part.known[cell] > 0) & wanted).any(1)
                out.append((some[taken], part.cell[cell[taken]]))
                need[some] -= np.where(gaps & taken[:, None], part.known[cell], 0.0)
                count[some] += taken
    return _by_point(out, len(points))


def _further_cells(boxes: _Boxes, above: _Boxes, points: np.ndarray, limits: np.ndarray, seen: list) -> list[np.ndarray]:
    """For each point the cells not yet seen that may hold a row within the distance found for one of its gaps."""
    has = ~np.isnan(points)
    limits = np.where(has | ~has.any(1)[:, None], -1.0, limits)  # only gaps count
    out: list[tuple[np.ndarray, np.ndarray]] = []
    reach = above.nearest_possible(points, has)[0] * (1 - 1e-9) <= limits.max(1, initial=-1.0)[:, None]
    for g in np.flatnonzero(reach.any(0)):
        rows = np.flatnonzero(reach[:, g])
        part = boxes.part(int(above.cell[g]))
        near = part.nearest_possible(points[rows], has[rows])[0] * (1 - 1e-9)
        wanted = np.zeros(near.shape, bool)
        for f in range(points.shape[1]):
            wanted |= (near <= limits[rows, f][:, None]) & (part.known[:, f] > 0)[None, :] & np.isfinite(near)
        row, cell = np.nonzero(wanted)
        out.append((rows[row], part.cell[cell]))
    before = _codes(np.repeat(np.arange(len(seen)), [len(cells) for cells in seen]), np.concatenate([np.empty(0, np.int32), *seen]))
    return _by_point([(row[new], cell[new]) for row, cell in out for new in [~np.isin(_codes(row, cell), before)]], len(points))


def _next(ranks: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The first box in order for each of these rows, which is then out."""
    kind, near, mean = (part[rows] for part in ranks)
    first = kind == kind.min(axis=1)[:, None]
    near = np.where(first, near, np.inf)
    first &= near == near.min(axis=1)[:, None]
    box = np.where(first, mean, np.inf).argmin(axis=1)
    ranks[0][rows, box] = 9
    return box


def _codes(rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return rows.astype(np.int64) << 32 | cells.astype(np.int64)


def _by_point(pairs: list[tuple[np.ndarray, np.ndarray]], points: int) -> list[np.ndarray]:
    """(row, cell) arrays as one array of cells for each row, in their order."""
    if not points:
        return []
    rows = np.concatenate([np.empty(0, np.int64), *[r for r, _ in pairs]])
    cells = np.concatenate([np.empty(0, np.int32), *[c for _, c in pairs]]).astype(np.int32)
    return np.split(cells[np.argsort(rows, kind="stable")], np.cumsum(np.bincount(rows, minlength=points))[:-1])


@dataclass(frozen=True)
class KnnImputer:
    """Fills gaps with the mean of the ``neighbors`` nearest fitted rows that know the value. Exact.

    Distance is Euclidean over the columns both rows know, scaled up for those
    they do not; rows that share no known column with any other take the
    column mean. Ties go to the donor that sorts first by gaps, curve and value.

    Equal rows are handled once, with their multiplicity, so copies cost
    nothing. ``fit`` cuts the distinct donors along a space-filling curve into
    cells of some 100,000 rows (sqrt(n) / 8 cells for small tables) and keeps a tree of their bounding boxes (at most
    ``max_cells``) besides the donors themselves, which are written to the
    checkpoint folder. ``transform`` searches in two phases: a row first visits
    the nearest cells that offer enough donors, then the cells that lie within
    the distance found there. Inside a cell rows of one gap pattern are halved
    into small boxes, and a visitor measures those within its distance only.
    Crowded cells serve visitors in slices. The answers of the first table are
    kept, so that its rows are not searched for again: a row's values decide its answer.
    """

    columns: tuple[str, ...]
    neighbors: int
    donors: DataFrame
    boxes: _Boxes
    means: dict[str, float | None]
    answers: list[DataFrame] = field(default_factory=list, compare=False, repr=False)

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], neighbors: int = 5, max_cells: int = 20_000) -> KnnImputer:
        columns = [c for c in columns if c in df.columns]
        vectors = durable(
            df.select([F.col(f"`{c}`").cast("double").alias(c) for c in columns]).groupBy(*columns).agg(F.count(F.lit(1)).alias("_m")))
        facts = vectors.agg(
            F.count(F.lit(1)).alias("n"),
            *[(F.sum(F.col(c) * F.col("_m")) / F.sum(F.when(F.col(c).isNotNull(), F.col("_m")))).alias(f"mean:{c}") for c in columns],
            *[F.percentile_approx(c, [0.01, 0.99]).alias(f"ends:{c}") for c in columns],
        ).first()
        ends = {c: facts[f"ends:{c}"] or [0.0, 0.0] for c in columns}
        curved = columns[:60]
        bits = max(1, min(8, 60 // max(len(curved), 1)))
        unit = max((high - low for low, high in ends.values()), default=0.0) / 2**bits or 1.0
        count = max(1, min(max_cells, math.ceil(max(min(math.sqrt(facts["n"]) / 8, 32), facts["n"] / _CELL_ROWS))))
        order = ("_gaps", "_at", *columns)
        # Row ids follow the sort order, so ties break alike whatever the cells are.
        donors = durable(
            _with_curve(vectors, curved, {c: low for c, (low, _) in ends.items()}, unit, bits).withColumn("_gaps", _gaps(columns))
            .repartitionByRange(count, *order).sortWithinPartitions(*order)
            .select(*columns, "_m", F.spark_partition_id().alias("_cell"), F.monotonically_increasing_id().alias("_from"))
        )
        return cls(tuple(columns), neighbors, donors, _Boxes.of(donors, columns), {c: facts[f"mean:{c}"] for c in columns})

    def transform(self, df: DataFrame, slice_rows: int = 100_000) -> DataFrame:
        columns = list(self.columns)
        typed = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in columns})
        complete = ~F.contains(_gaps(columns), F.lit("1"))
        whole, partial = typed.filter(complete), durable(typed.filter(~complete))
        key = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        visitors = partial.groupBy(*columns).agg(F.count(F.lit(1)).alias("_m")).withColumn("value", key)
        if self.answers:
            known = visitors.select("value", "_m").join(self.answers[0].drop("_m"), "value")
            others = durable(visitors.join(self.answers[0].select("value"), "value", "left_anti"))
            table = durable(known.unionByName(self._answered(others, slice_rows)) if others.head(1) else known)
        else:
            table = self._answered(visitors, slice_rows)
            self.answers.append(table)
        filled = map_lookup(partial.withColumn("_key", key), table, "_key", {f"_new_{c}": F.lit(None) for c in columns}, weight="_m")
        return whole.unionByName(durable(filled.select(*[
            F.coalesce(F.col(c), F.col(f"_new_{c}"), F.lit(self.means[c]).cast("double")).alias(c) if c in columns else F.col(f"`{c}`")
            for c in df.columns
        ])))

    def _answered(self, visitors: DataFrame, slice_rows: int) -> DataFrame:
        """The estimates for distinct rows with gaps, one row each by ``value``."""
        columns, k = list(self.columns), self.neighbors
        bounds = [f"_limit{i}" for i in range(len(columns))]
        kinds = ", ".join(f"`{c}` double" for c in (*columns, *bounds))
        boxes, above = self.boxes, self.boxes.above()

        def points(frame: pd.DataFrame) -> np.ndarray:
            return frame[columns].to_numpy(dtype=float, na_value=np.nan)

        def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                here = points(frame)
                parts = [_first_cells(boxes, above, here[at:at + _AT_ONCE], k) for at in range(0, len(here), _AT_ONCE)]
                yield frame.assign(_cells=[cells for part in parts for cells in part])

        def further(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                limits = frame[bounds].to_numpy(dtype=float, na_value=np.inf)
                here, seen = points(frame), list(frame["_cells"])
                parts = [_further_cells(boxes, above, *(x[at:at + _AT_ONCE] for x in (here, limits, seen))) for at in range(0, len(here), _AT_ONCE)]
                yield frame[["_id", *columns, *bounds]].assign(_cells=[cells for part in parts for cells in part])

        visitors = durable(visitors.withColumn("_id", F.monotonically_increasing_id()))
        unlimited = [F.lit(None).cast("double").alias(b) for b in bounds]
        started = durable(visitors.select("_id", *columns, *unlimited).mapInPandas(first, f"_id long, {kinds}, _cells array<int>"))
        found = durable(self._met(started, slice_rows))
        # The distance within which k donors are known so far, for each gap.
        upto = Window.partitionBy("_id", "_feature").orderBy("_d", "_from").rowsBetween(Window.unboundedPreceding, 0)
        limits = found.withColumn("_upto", F.sum("_w").over(upto)).filter(F.col("_upto") >= k).groupBy("_id").agg(
            *[F.min(F.when(F.col("_feature") == i, F.col("_d"))).alias(b) for i, b in enumerate(bounds)])
        rest = started.drop(*bounds).join(limits, "_id", "left").mapInPandas(further, f"_id long, {kinds}, _cells array<int>")
        found = found.unionByName(self._met(durable(rest), slice_rows))

        nearest_first = Window.partitionBy("_id", "_feature").orderBy("_d", "_from")
        before = F.coalesce(F.sum("_w").over(nearest_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        used = found.withColumn("_take", F.least(F.col("_w"), F.lit(k) - before)).filter(F.col("_take") > 0)
        estimate = (
            used.groupBy("_id", "_feature")
            .agg((F.sum(F.col("_value") * F.col("_take")) / F.sum("_take")).alias("_value"))
            .groupBy("_id").agg(*[F.max(F.when(F.col("_feature") == i, F.col("_value"))).alias(f"_new_{c}")
                                  for i, c in enumerate(columns)])
        )
        return durable(visitors.join(estimate, "_id").select("value", "_m", *[f"_new_{c}" for c in columns]))

    def _met(self, visitors: DataFrame, slice_rows: int) -> DataFrame:
        """Up to k nearest donors of each visitor within its limits in each of its cells, per gap and gap pattern of donors."""
        columns = list(self.columns)
        visits = visitors.select("_id", *columns, *[f"_limit{i}" for i in range(len(columns))], F.explode("_cells").alias("_cell"))
        # One row per cell: how many slices its visitors need.
        slices = visits.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("_slices"))
        slices = durable(slices)
        # Slices differ in cost: so many tasks that few of them share one.
        groups = slices.agg(F.sum("_slices")).first()[0] or 0
        tasks = max(1, min(4 * groups, 2_000))
        slices = F.broadcast(slices)
        asked = visits.join(slices, "_cell").select(
            *visits.columns, F.pmod(F.xxhash64("_id"), F.col("_slices")).cast("int").alias("_slice"))
        offered = self.donors.join(slices, "_cell").select(
            "_from", "_m", *columns, "_cell", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"))
        # Fresh column identities: both sides may come from the same rows.
        offered = offered.toDF(*offered.columns)
        asked, offered = (side.repartition(tasks, "_cell", "_slice").groupBy("_cell", "_slice") for side in (asked, offered))
        return asked.cogroup(offered).applyInPandas(
            _nearest(columns, self.neighbors), "_id long, _feature int, _d double, _from long, _value double, _w long")


def _gaps(columns: Sequence[str]) -> Column:
    return F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])


def impute_knn(df: DataFrame, columns: Sequence[str], neighbors: int = 5, max_cells: int = 20_000, slice_rows: int = 100_000) -> DataFrame:
    """Fill the gaps of a table from its own rows."""
    df = durable(df)  # read here and several times below
    return KnnImputer.fit(df, columns, neighbors, max_cells).transform(df, slice_rows)


def _nearest(columns: Sequence[str], k: int):
    """For visitors and residents of one cell slice: up to k nearest per gap."""
    def search(visitors: pd.DataFrame, residents: pd.DataFrame) -> pd.DataFrame:
        parts = [*zip(*_blocks(visitors, residents, list(columns), k))] or [()] * len(_FOUND)
        made = {name: np.concatenate([np.empty(0, kind), *part]) for (name, kind), part in zip(_FOUND.items(), parts)}
        order = np.lexsort((made["_from"], made["_d"], made["_feature"], made["_id"]))
        made = {name: part[order] for name, part in made.items()}
        new = (np.diff(made["_id"], prepend=-1) != 0) | (np.diff(made["_feature"], prepend=-1) != 0)
        first = np.flatnonzero(new)
        place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
        return pd.DataFrame({name: part[place < k] for name, part in made.items()})
    return search


_FOUND = {"_id": np.int64, "_feature": np.int32, "_d": np.float64, "_from": np.int64, "_value": np.float64, "_w": np.int64}


def _blocks(visitors: pd.DataFrame, residents: pd.DataFrame, columns: list[str], k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """What ``_FOUND`` names, as arrays, by gap and gap patterns."""
    there = residents[columns].to_numpy(dtype=float, na_value=np.nan)
    here = visitors[columns].to_numpy(dtype=float, na_value=np.nan)
    limits = visitors[[f"_limit{i}" for i in range(len(columns))]].to_numpy(dtype=float, na_value=np.nan)
    limits = np.where(np.isnan(limits), np.inf, limits)
    ids, origin, weights = visitors["_id"].to_numpy(), residents["_from"].to_numpy(), residents["_m"].to_numpy()
    mine_all = _patterns(here)
    for theirs, donors in _patterns(there):
        common = None
        for mine, rows in mine_all:
            shared, gaps = np.flatnonzero(theirs & mine), np.flatnonzero(theirs & ~mine)
            if not len(shared) or not len(gaps):
                continue
            # All these donors know the same columns, so the nearest ones serve every gap.
            reach = limits[np.ix_(rows, gaps)].max(axis=1) * (len(shared) / len(columns))
            if len(rows) * 256 > len(donors):
                tree, used = _Tree(there[np.ix_(donors, shared)], k), range(len(shared))
            else:
                common = common or _Tree(there[np.ix_(donors, np.flatnonzero(theirs))], k)
                tree, used = common, np.searchsorted(np.flatnonzero(theirs), shared)
            r, d = tree.within(here[np.ix_(rows, shared)], reach, used)
            r, d = rows[r], donors[d]
            square = np.square(here[r] - there[d])
            exact = np.nansum(square, axis=1) * len(columns) / len(shared)
            order = np.lexsort((origin[d], exact, r))
            r, d, exact = r[order], d[order], exact[order]
            near = np.arange(len(r)) - np.searchsorted(r, r) < k
            for f in gaps:
                kept = near & (exact <= limits[r, f])
                some, others = r[kept], d[kept]
                yield (ids[some], np.full(len(some), f, np.int32), exact[kept], origin[others], there[others, f], weights[others])


def _patterns(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(known columns, rows that know just these) for each pattern of gaps."""
    known = ~np.isnan(values)
    if not len(known):
        return []
    _, first, which = np.unique(np.packbits(known, axis=1), axis=0, return_index=True, return_inverse=True)
    which = which.ravel()
    order = np.argsort(which, kind="stable")
    return [(known[f], rows) for f, rows in zip(first, np.split(order, np.cumsum(np.bincount(which))[:-1]))]


def _within(x: np.ndarray, y: np.ndarray, reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of x, row of y) holding at least the k nearest of each x, with ties, of those within its squared ``reach``."""
    return _Tree(y, k).within(x, reach, range(y.shape[1]))


class _Tree:
    """Rows halved along their widest column down to leaves of one size, with the box of every node.

    Searched for many points at once, level by level, over all of its columns or some of them.
    """

    def __init__(self, y: np.ndarray, k: int, size: int = 16):
        self.k, self.rows = k, len(y)
        self.depth = max(0, math.ceil(math.log2(max(len(y), 1) / max(size, 2 * k))))
        self.each = -(-len(y) // 2**self.depth)
        # Leaves are filled up with rows that come again; these get no distance.
        self.at = np.arange(self.each << self.depth)
        values = y.T[:, self.at % max(len(y), 1)]
        self.low, self.high = [], []
        for level in range(self.depth + 1):
            nodes = values.reshape(len(values), 1 << level, -1)
            self.low.append(nodes.min(axis=2, initial=np.inf))
            self.high.append(nodes.max(axis=2, initial=-np.inf))
            if level == self.depth:
                break
            widest = (self.high[-1] - self.low[-1]).argmax(axis=0)
            key = nodes[widest, np.arange(1 << level)]
            order = np.argpartition(key, key.shape[1] // 2, axis=1) + (np.arange(1 << level) * key.shape[1])[:, None]
            values, self.at = values[:, order.ravel()], self.at[order.ravel()]
        self.values = values.reshape(len(values), 1 << self.depth, self.each)
        self.at = self.at.reshape(1 << self.depth, self.each)

    def within(self, x: np.ndarray, reach: np.ndarray, columns: Sequence[int], height: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of x, row of the tree) holding at least the k nearest of each x, with ties, of those within its squared ``reach``."""
        out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        todo = [(start, min(start + height, len(x))) for start in range(0, len(x) if self.rows else 0, height)]
        while todo:
            start, end = todo.pop()
            found = self._search(x[start:end].T.copy(), reach[start:end], list(columns))
            if found is None:
                todo += [(start, (start + end) // 2), ((start + end) // 2, end)]
            else:
                out.append((start + found[0], found[1]))
        return np.concatenate([r for r, _ in out]), np.concatenate([d for _, d in out])

    def _search(self, x: np.ndarray, reach: np.ndarray, columns: list[int], early: int = 4) -> tuple[np.ndarray, np.ndarray] | None:
        """For a few points (columns x points); nothing if they reach too many nodes to be held at once."""
        limit, size = reach.copy(), x.shape[1]
        if self.depth:
            # One leaf gives a first bound.
            node = np.zeros(size, np.int64)
            for level in range(1, self.depth + 1):
                node = 2 * node
                node += self._apart(x, level, node + 1, columns) < self._apart(x, level, node, columns)
            limit = np.minimum(limit, self._kth(self._measured(x, node, columns)))
        limit *= 1 + 1e-9  # sums may be rounded in another order
        v, node = np.arange(size), np.zeros(size, np.int64)
        lower = self._apart(x, 0, node, columns)
        v, node, lower = (part[lower <= limit] for part in (v, node, lower))
        for level in range(1, self.depth + 1):
            v, node = np.repeat(v, 2), np.repeat(2 * node, 2)
            node[1::2] += 1
            lower = self._apart(x[:, v], level, node, columns)
            kept = np.flatnonzero(lower <= limit[v])
            v, node, lower = v[kept], node[kept], lower[kept]
            if len(v) > _FRONT and size > 1:
                return None
        # A point measures its nearest leaves, which shrinks its reach, then all others within reach.
        order = np.lexsort((lower, v))
        v, node, lower = v[order], node[order], lower[order]
        turn = np.arange(len(v)) - np.searchsorted(v, v)
        first = np.flatnonzero(turn < early)
        near = np.full((size, early, self.each), np.inf)
        for some in self._slices(first):
            near[v[some], turn[some]] = self._measured(x[:, v[some]], node[some], columns)
        limit = np.minimum(limit, self._kth(near.reshape(size, -1)) * (1 + 1e-9))
        place = np.full((size, early), -1)
        place[v[first], turn[first]] = node[first]
        i, j, at = np.nonzero((near <= limit[:, None, None]) & np.isfinite(near))
        out = [(i, self.at[place[i, j], at])]
        for some in self._slices(np.flatnonzero((turn >= early) & (lower <= limit[v]))):
            apart = self._measured(x[:, v[some]], node[some], columns)
            i, at = np.nonzero((apart <= limit[v[some]][:, None]) & np.isfinite(apart))
            out.append((v[some][i], self.at[node[some][i], at]))
        return np.concatenate([r for r, _ in out]), np.concatenate([d for _, d in out])

    def _slices(self, rows: np.ndarray) -> list[np.ndarray]:
        step = max(1, _BLOCK // max(self.each, 1))
        return [rows[start:start + step] for start in range(0, len(rows), step)]

    def _apart(self, x: np.ndarray, level: int, node: np.ndarray, columns: list[int]) -> np.ndarray:
        """Squared distance of each point to the box of its node."""
        square = np.zeros(len(node))
        for at, c in zip(x, columns):
            gap = np.maximum(self.low[level][c][node] - at, at - self.high[level][c][node])
            np.maximum(gap, 0.0, out=gap)
            square += np.square(gap, out=gap)
        return square

    def _measured(self, x: np.ndarray, node: np.ndarray, columns: list[int]) -> np.ndarray:
        """(points x rows) squared distances of each point to the rows of its leaf."""
        square = np.zeros((len(node), self.each))
        for at, c in zip(x, columns):
            gap = self.values[c][node]
            gap -= at[:, None]
            square += np.square(gap, out=gap)
        square[self.at[node] >= self.rows] = np.inf
        return square

    def _kth(self, apart: np.ndarray) -> np.ndarray:
        if apart.shape[1] < self.k:
            return np.full(len(apart), np.inf)
        return np.partition(apart, self.k - 1, axis=1)[:, self.k - 1]
