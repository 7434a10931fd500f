"""Exact Jaccard join of documents on word shingles.

1. Every text becomes a set of hashed shingles. Equal sets are one class.
2. A class lists a prefix of its set, rare shingles first: two sets that are
   similar enough share a listed shingle. Rarity comes from a hashed count
   table of fixed size over all sets; any counts give right results.
3. A first pass links each class to the class it meets most often as the least
   of a shingle's classes, and verifies exactly. Most groups are joined by it.
4. Shingles that still hold several components are cut into tiles: bands of
   set sizes (only neighbouring bands can link), and blocks of bounded size in
   crowded ones. In a tile, bitmaps of hashed parities, as wide as the band
   needs, bound each overlap from above: two sets differ at least in as many
   elements as their bitmaps in bits. Of the pairs that pass and would join
   different components a tile gives a spanning forest, likelier pairs first;
   these are verified exactly on the sorted arrays and components updated, until
   no forest joins any; the pairs then left are all verified.

No pair is left out and no group is expanded into all its pairs of copies.
Null and empty texts have empty sets and link with nothing. Repeated rows are
one class. An empty table gives no rows. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import discard, in_batches, shuffle_partitions, stored
from cohortline.llm.components import components, in_turns, with_component
from cohortline.llm.wordhash import mix, shingle_sets

WIDTH = 5
PERCENT = 75
COUNT_BITS = 18
FILTER_BITS = 23
TILE = 2048
SMALL = 64
SHORT_BITS = 8
_SLICES = 64


def _class_of(values: np.ndarray) -> int:
    """A set's class: its size and the sum of its mixed elements, mixed."""
    with np.errstate(over="ignore"):
        total = mix(values).sum(dtype=np.uint64) + np.uint64(len(values)) * np.uint64(0x9E3779B97F4A7C15)
        return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, column: int, width: int):
    return shingle_sets(batch.column(column).to_pylist(), width)


def survey(docs: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """One pass over the texts. Rows of documents: (key, n, class, bits), the class
    null for empty sets. Rows of the count table: (slice, counts), for each task."""
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n", "class", "bits", "slice", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        table = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                n, ids, bits = [], [], []
                for values in _sets(part, 1, width):
                    n.append(len(values))
                    own = _class_of(values) if len(values) else None
                    ids.append(own)
                    bits.append(bitmap(values) if len(values) else None)
                    if own is not None and own not in seen:
                        seen.add(own)
                        np.add.at(table, (values >> np.uint64(64 - COUNT_BITS)).astype(np.int64), 1)
                none = pa.nulls(len(n), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), pa.array(bits, pa.binary()), none, pa.nulls(len(n), pa.binary())], names=names)
        if seen:
            parts = _sliced(table)
            none = pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(parts), batch.schema.field(0).type), none, none, pa.nulls(len(parts), pa.binary()), pa.array(range(_SLICES), pa.int32()), pa.array(parts, pa.binary())], names=names)

    return docs.select(docs[key], docs[text]).mapInArrow(run, f"`{key}` {kind}, n bigint, class bigint, bits binary, slice int, counts binary")


def _sliced(table: np.ndarray) -> list[bytes]:
    """A count table in slices, so that no row grows with the input."""
    return [x.astype("<u4").tobytes() for x in np.split(np.minimum(table, 0xFFFFFFFF), _SLICES)]


def _fresh_sets(batches: Iterator[pa.RecordBatch], width: int):
    """Sets of a task's texts, each class once."""
    seen: set[int] = set()
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            for values in _sets(batch.slice(start, 512), 0, width):
                if len(values):
                    own = _class_of(values)
                    if own not in seen:
                        seen.add(own)
                        yield own, values


def _total(slices: DataFrame) -> np.ndarray:
    """Sum of the tasks' count tables, from their slices (slice, counts)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        if sums:
            packed = [np.minimum(v, 0xFFFFFFFF).astype("<u4").tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], names=["slice", "counts"])

    rows = slices.select("slice", "counts").repartition(_SLICES, "slice").mapInArrow(add, "slice int, counts binary").collect()
    found = {r["slice"]: np.frombuffer(r["counts"], "<u4") for r in rows}
    return np.concatenate([found[k] for k in range(_SLICES)]) if found else np.zeros(0, "<u4")


def filter_of(ids: DataFrame) -> np.ndarray:
    """Packed bits of fixed number: the leading bits of the ids in the one column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << FILTER_BITS, np.uint8)
        for batch in batches:
            table[(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = 1
        if table.any():
            parts = [x.tobytes() for x in np.split(np.packbits(table), _SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "bits"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[part] = found.get(part, np.uint8(0)) | np.frombuffer(bits, np.uint8)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())], names=["slice", "bits"])

    schema = "slice int, bits binary"
    rows = ids.mapInArrow(run, schema).repartition(_SLICES, "slice").mapInArrow(join, schema).collect()
    out = np.zeros((_SLICES, (1 << FILTER_BITS) // 8 // _SLICES), np.uint8)
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def rarity(slices: DataFrame) -> np.ndarray:
    """A level for each place of the count table: 0 for usual counts, then by powers of two."""
    counts = _total(slices)
    if not len(counts):
        return np.zeros(1 << COUNT_BITS, np.uint8)
    usual = max(float(np.median(counts)), 1.0)
    return np.clip(np.floor(np.log2(np.maximum(counts / usual, 1.0))), 0, 255).astype(np.uint8)


def prefixes(docs: DataFrame, level: np.ndarray, text: str, width: int, percent: int) -> DataFrame:
    """(s, class, n): the listed shingles of each class."""
    shared = docs.sparkSession.sparkContext.broadcast(level)  # 2**COUNT_BITS bytes for any input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([h[0] for h in held]).view(np.int64)), pa.array(np.repeat([h[1] for h in held], [len(h[0]) for h in held])),
                 pa.array(np.repeat([h[2] for h in held], [len(h[0]) for h in held]).astype(np.int32))], names=["s", "class", "n"])

        for own, values in _fresh_sets(batches, width):
            n = len(values)
            size = n - -(-percent * n // 100) + 1
            rank = shared.value[(values >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
            held.append((values[np.lexsort((values, rank))[:size]], own, n))
            rows += size
            if rows > 200_000:
                yield flush()
                held, rows = [], 0
        if held:
            yield flush()

    return docs.select(docs[text]).mapInArrow(run, "s bigint, class bigint, n int")


def _shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (s, class): those of shingles with two classes at least, with the least class as hub."""
    last_s = last_c = None
    hub = (0, 0)
    waiting = False
    for batch in batches:
        s, c, n = (batch.column(i).to_numpy() for i in range(3))
        if not len(s):
            continue
        before_s = np.concatenate([[last_s if last_s is not None else ~s[0]], s[:-1]])
        before_c = np.concatenate([[last_c if last_c is not None else 0], c[:-1]])
        keep = (s != before_s) | (c != before_c)
        if not keep.any():
            continue
        first = last_s if last_s is not None else ~s[0]
        s, c, n = s[keep], c[keep], n[keep]
        start = s != np.concatenate([[first], s[:-1]])
        at = np.flatnonzero(start)
        group = np.cumsum(start)
        hub_c, hub_n = np.concatenate([[hub[0]], c[at]]), np.concatenate([[hub[1]], n[at]])
        follow = np.flatnonzero(~start)
        crowded = np.zeros(len(at) + 1, bool)
        crowded[group[follow]] = True
        heads = at[crowded[1:]]
        rows = np.concatenate([follow, heads])
        out_s, out_c, out_n, out_g = s[rows], c[rows], n[rows], group[rows]
        if waiting and crowded[0]:
            out_s, out_c = np.append(out_s, last_s), np.append(out_c, hub[0])
            out_n, out_g = np.append(out_n, hub[1]), np.append(out_g, 0)
        if len(at):
            hub, waiting = (c[at[-1]], n[at[-1]]), not crowded[-1]
        else:
            waiting = waiting and not crowded[0]
        last_s, last_c = s[-1], c[-1]
        if len(out_s):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_s), pa.array(out_c), pa.array(out_n.astype(np.int32)), pa.array(hub_c[out_g]), pa.array(hub_n[out_g].astype(np.int32))],
                names=["s", "class", "n", "hub", "hub_n"])


def wanted_sets(docs: DataFrame, wanted: DataFrame, text: str, width: int) -> DataFrame:
    """(class, items): sets of the wanted classes (the one column of ``wanted``) and, by
    chance, some others; a filter of fixed size keeps most others from being shuffled."""

    shared = docs.sparkSession.sparkContext.broadcast(filter_of(wanted))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.binary())], names=["class", "items"])

        for own, values in _fresh_sets(batches, width):
            place = (own & (2**64 - 1)) >> (64 - FILTER_BITS)
            if shared.value[place >> 3] >> (7 - (place & 7)) & 1:
                held.append((own, values.tobytes()))
                size += 8 * len(values)
                if size > 4_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    found = docs.select(docs[text]).mapInArrow(sets, "class bigint, items binary")
    return found.dropDuplicates(["class"])


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough, by exact intersection."""
    left, right = (sets.select(F.col("class").alias(k), F.col("items").alias(f"{k}_items")) for k in "ab")
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "a_items", "b_items")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            common = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * common >= percent * (len(p) + len(q) - common))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return in_batches(both, "a bigint, b bigint", work, 256)


def _bits(n: int) -> int:
    """Bits of a set's bitmap: twice its size, as a power of two."""
    return 1 << max(SHORT_BITS, min(20, (2 * n - 1).bit_length()))


def bitmap(values: np.ndarray) -> bytes:
    """Parities of the elements hashed to each place."""
    size = _bits(len(values))
    return np.packbits((np.bincount((mix(values) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)).tobytes()


class _Maps:
    """Bitmaps of a tile's rows in their own widths, and all of them in the shortest."""

    def __init__(self, maps: list[bytes]):
        self.width = np.fromiter(map(len, maps), np.int64, len(maps))
        self.place = np.zeros(len(maps), np.int64)
        self.short = np.zeros((len(maps), (1 << SHORT_BITS) // 8), np.uint8)
        self.rows = {}
        for width in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == width)
            self.place[at] = np.arange(len(at))
            self.rows[width] = np.frombuffer(b"".join(maps[i] for i in at), np.uint8).reshape(len(at), width)
            self.short[at] = self._folded(self.rows[width], self.short.shape[1])

    @staticmethod
    def _folded(rows: np.ndarray, width: int) -> np.ndarray:
        return np.bitwise_xor.reduce(rows.reshape(len(rows), -1, width), axis=1)

    def apart(self, i: np.ndarray, j: np.ndarray, most: int = 32_000_000) -> np.ndarray:
        """Differing bits of pairs of rows, in the narrower of their two widths."""
        out = np.zeros(len(i), np.int64)
        for a in np.unique(self.width[i]).tolist():
            for b in np.unique(self.width[j[self.width[i] == a]]).tolist():
                both = np.flatnonzero((self.width[i] == a) & (self.width[j] == b))
                step = max(1, most // max(a, b))
                for start in range(0, len(both), step):
                    at = both[start:start + step]
                    x, y = self.rows[a][self.place[i[at]]], self.rows[b][self.place[j[at]]]
                    out[at] = np.bitwise_count(self._folded(x, min(a, b)) ^ self._folded(y, min(a, b))).sum(axis=1, dtype=np.int64)
        return out


def _forest(i: np.ndarray, j: np.ndarray, likely: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Which pairs make a spanning forest of their components, likelier pairs first."""
    order = np.argsort(-likely, kind="stable")
    _, ends = np.unique(np.concatenate([comp[i[order]], comp[j[order]]]), return_inverse=True)
    a, b = ends[:len(order)], ends[len(order):]
    label, chosen = np.arange(ends.max(initial=-1) + 1), []
    while True:
        x, y = label[a], label[b]
        live = np.flatnonzero(x != y)
        if not len(live):
            return order[np.array(sorted(chosen), np.int64)]
        # Each tree takes its likeliest pair; taken in order, they close no ring.
        _, first = np.unique(np.stack([x[live], y[live]], axis=1).ravel(), return_index=True)
        for k in sorted(set((live[first // 2]).tolist())):
            p, q = label[a[k]], label[b[k]]
            if p != q:
                label[label == max(p, q)] = min(p, q)
                chosen.append(k)


def _tile_pairs(tile, low, cls, n, comp, band, wide: _Maps, percent: int, forest: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by tile, whole tiles only: pairs of different components whose sizes
    fit and whose bitmaps leave room, first the short ones, then the wide ones. ``low``
    is the lower band that a tile compares with itself and the next one, or -1 where it
    holds all of a shingle's rows. With ``forest`` each tile gives a spanning forest of
    such pairs only, likelier ones first, and (c, c) for each class c that is in any."""
    start = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    size = np.diff(np.append(start, len(tile)))
    left_over = np.repeat(size, size) - (np.arange(len(tile)) - np.repeat(start, size))  # rows from here to the tile's end
    short = wide.short.view(np.uint64)
    found, rows = [], np.arange(len(tile))
    for d in range(1, int(size.max(initial=1))):
        rows = rows[left_over[rows] > d]
        other = rows + d
        ok = (comp[rows] != comp[other]) & ((low[rows] < 0) | (band[rows] == low[rows]) | (band[other] == low[rows]))
        ok &= 100 * np.minimum(n[rows], n[other]) >= percent * np.maximum(n[rows], n[other])
        i, j = rows[ok], other[ok]
        # overlap <= (total - apart) / 2 and similar means (100 + p) * overlap >= p * total
        for apart in (lambda i, j: np.bitwise_count(short[i] ^ short[j]).sum(axis=1, dtype=np.int64), wide.apart):
            common = n[i] + n[j] - apart(i, j)
            room = (100 + percent) * common >= 2 * percent * (n[i] + n[j])
            i, j, common = i[room], j[room], common[room]
        found.append((i, j, common / (n[i] + n[j])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j, likely = (np.concatenate(x) for x in zip(*found))
    alone = np.zeros(0, np.int64)
    if forest and len(i):
        alone = np.unique(cls[np.concatenate([i, j])])
        # Components are told apart by tile, so one call makes the forests of all tiles.
        _, own = np.unique(np.stack([np.cumsum(np.isin(np.arange(len(tile)), start)), comp], axis=1), axis=0, return_inverse=True)
        kept = _forest(i, j, likely, own.ravel())
        i, j = i[kept], j[kept]
    pairs = np.unique(np.stack([np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])]), axis=1)
    return np.concatenate([pairs[0], alone]), np.concatenate([pairs[1], alone])


def tiles(runs: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """(s, low, i, j, class, n, band): rows of the shingles that still hold several components."""
    rows = with_component(runs.select("s", "class", "n"), label)
    lists = [F.bit_xor(F.xxhash64("class", F.lit(k))).alias(f"list{k}") for k in (1, 2)]
    mixed = rows.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), *lists).where("lo != hi")
    # The shingles of a shared passage have the same classes: one of them is enough.
    once = mixed.groupBy("size", "list1", "list2").agg(F.min("s").alias("s"))
    rows = rows.join(once.select("s", "size"), "s")
    # Few rows are one tile; more are cut by size band, and a crowded shingle also into blocks.
    rows = rows.withColumn("band", F.floor(F.log("n") / F.log(F.lit(101.0 / percent))).cast("int"))
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / TILE).cast("int")).withColumn("block", F.pmod("class", "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    few = F.col("size") <= SMALL
    rows = rows.withColumn("low", F.explode(F.when(few, F.array(F.lit(-1))).otherwise(F.array(F.col("band"), F.greatest(F.col("band") - 1, F.lit(0))))))
    rows = rows.select("s", "low", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "class", "n", "band").distinct()
    return stored(rows, "tiles")


def _once(rows: DataFrame) -> DataFrame:
    """Of tiles with the same classes and the same lower band one."""
    tile = ["s", "low", "i", "j"]
    lists = [F.bit_xor(F.xxhash64("class", F.lit(k))).alias(f"list{k}") for k in (1, 2)]
    same = rows.groupBy(*tile).agg(F.count("*").alias("size"), *lists).groupBy("low", "size", "list1", "list2")
    return rows.join(same.agg(F.min(F.struct(*tile)).alias("tile")).where("size > 1").select("tile.*"), tile, "left_semi")


def tile_candidates(rows: DataFrame, label: DataFrame, maps: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs (a, b) of tiles' classes in different components that pass the bitmap bounds. maps: (class, n, bits)."""
    spark = rows.sparkSession
    known = maps.join(rows.select("class").distinct(), "class", "left_semi").dropDuplicates(["class"])
    signed = with_component(rows, label).join(known.select("class", "bits"), "class")
    signed = signed.repartition(shuffle_partitions(spark), "s", "low", "i", "j").sortWithinPartitions("s", "low", "i", "j")
    columns = ["s", "low", "i", "j", "class", "n", "comp", "band", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close(table: pa.Table):
            keys = [table.column(k).to_numpy() for k in range(4)]
            change = np.zeros(table.num_rows, bool)
            for k in keys:
                change[1:] |= k[1:] != k[:-1]
            cls, n, comp, band = (table.column(k).to_numpy().astype(np.int64) for k in ("class", "n", "comp", "band"))
            wide = _Maps(table.column("bits").to_pylist())
            a, b = _tile_pairs(np.cumsum(change), keys[1], cls, n, comp, band, wide, percent, forest)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            last = np.ones(batch.num_rows, bool)
            for k in range(4):
                last &= batch.column(k).to_numpy() == batch.column(k)[batch.num_rows - 1].as_py()
            cut = int(batch.num_rows - last[::-1].argmin()) if not last.all() else 0
            if cut:  # the last tile may go on in the next batch
                yield close(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif held and any(held[-1].column(k)[held[-1].num_rows - 1] != batch.column(k)[0] for k in range(4)):
                yield close(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield close(pa.Table.from_batches(held))

    return stored(signed.select(*columns).mapInArrow(run, "a bigint, b bigint").distinct(), "candidates")


def further_links(runs: DataFrame, label: DataFrame, maps: DataFrame, docs: DataFrame, text: str, width: int, percent: int) -> DataFrame:
    """The components after all links that the first pass left.

    Forests of likely pairs are verified first, as long as they join
    components, so a group costs its members and not their pairs. The last
    turn takes all pairs that are left between different components.
    """
    rows = tiles(runs, label, percent)
    discard(runs)
    found = tile_candidates(rows, label, maps, percent, forest=True)
    members = found.where("a = b").select(F.col("a").alias("class"))
    if found.isEmpty():
        return label
    sets = stored(wanted_sets(docs, members, text, width), "candidate-sets")
    rest = stored(_once(rows.join(members, "class", "left_semi")), "tiles")
    discard(rows)
    return in_turns(
        label, found, lambda pairs: verify(pairs, sets, percent),
        lambda now, forest: tile_candidates(rest, now, maps, percent, forest))


def link(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id): the least key reachable by links, for every row."""
    spark = docs.sparkSession
    docs = docs.select(docs[key], docs[text])
    seen = stored(survey(docs, text, key, width), "sets")
    own = seen.where("slice IS NULL").select(key, "n", "class")
    level = rarity(seen.where("slice IS NOT NULL"))
    listed = prefixes(docs, level, text, width, percent)
    listed = listed.repartition(shuffle_partitions(spark), "s").sortWithinPartitions("s", "class")
    runs = stored(listed.mapInArrow(_shared_only, "s bigint, class bigint, n int, hub bigint, hub_n int"), "runs")

    # First pass: only pairs that share half of the shorter list at least; all others are left to the tiles.
    near = (F.col("class") != F.col("hub")) & (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
    met = runs.where(near).groupBy("class", "hub").agg(F.count("*").alias("times"), F.min(F.least("n", "hub_n")).alias("n"))
    met = met.where(200 * F.col("times") >= (100 - percent) * F.col("n"))
    first = met.groupBy("class").agg(F.max_by("hub", F.struct("times", "hub")).alias("hub"))
    first = stored(first.select(F.col("hub").alias("a"), F.col("class").alias("b")), "first")
    wanted = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("class"))
    edges = stored(verify(first, wanted_sets(docs, wanted(first), text, width), percent), "edges")
    label = components(edges)
    maps = seen.where("class IS NOT NULL").select("class", "n", "bits")
    label = further_links(runs, label, maps, docs, text, width, percent)

    own_least = own.where("class IS NOT NULL").groupBy("class").agg(F.min(key).alias("least"), F.count("*").alias("copies"))
    joined = own_least.join(label, F.col("class") == F.col("node"), "left").select(
        "class", "least", "copies", F.coalesce("component", "class").alias("comp"), F.col("component").isNotNull().alias("linked"))
    reach = joined.where("linked").groupBy("comp").agg(F.min("least").alias("reach"))
    labels = joined.where("linked OR copies > 1").join(reach, "comp", "left").select("class", F.coalesce("reach", "least").alias("component_id"))
    return own.join(labels, "class", "left").select(
        F.col(f"`{key}`"), F.col("n").alias("n_shingles"), F.coalesce("component_id", F.col(f"`{key}`")).alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents, of each component only the row with the least key; of rows
    with equal key and text one. A null key stays where nothing with a key is linked."""
    found = link(docs, text, key, width, percent)
    least = found.where(F.col(f"`{key}`").eqNullSafe(F.col("component_id"))).select(F.col(f"`{key}`").alias("_least")).distinct()
    rows = docs.join(least, F.col(f"`{key}`").eqNullSafe(F.col("_least")), "left_semi")
    return rows.withColumn("_same", F.xxhash64(F.col(f"`{text}`"))).dropDuplicates([key, "_same"]).select(docs.columns)
