"""Near-duplicate lines: an edit join on segments, and texts without later copies.

Lines take part with at least ``least`` characters (without blanks at the ends).
Two lines within ``edits`` edits share one of ``edits + 1`` even segments of the
shorter one at a place near its own; each line lists its segments and probes,
for every length it may meet, the few places where such a segment can lie
(substrings by length and place, as hashes). A shared key is a candidate:

With ``per`` given, lines are also near copies where they are few word edits
apart, and the limit grows with the shorter line: at least one edit from
``per / 2`` words on, then one for each ``per`` words at the start of its length
class (classes grow by a quarter). Words are runs of letters and digits, cut
after 16; other signs, and those of scripts without blanks, are words of their
own. The first ``limit + 1`` stretches of words of the class's one size are the
segments. If segment k is the first before which k edits lie, it stands at most k
places off in the other line; long lines list all their places instead.

1. Every line is compared with the first line of the key it shares most often.
2. Keys that still hold several components are cut into tiles of bounded size;
   in a tile, pairs of different components whose lengths and counts of signs
   or words leave room make a spanning forest, likelier pairs first, which is
   compared. Then each tile compares the pairs that are left, likelier ones
   first, except those that its links have joined meanwhile.

A comparison follows the diagonals from edit to edit, over many pairs at once.
Components of all links found are the line classes; no
link is left out. ``dedup`` drops a line where its class has an earlier one, by
(document id, place), and keeps everything else of the text as it is.

Null text stays null, an empty one empty. Lines below ``least`` are left alone,
or with ``short`` are copies where they are equal (blank lines always stay). Rows with equal id and text are one document. Only id and text are used,
so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import BLANKS, aside, discard, in_batches, shuffle_partitions, stored
from cohortline.llm.components import components, merged, with_component
from cohortline.llm.jaccard import FILTER_BITS, _forest, _shared_only, filter_of
from cohortline.llm.wordhash import _power, mix

EDITS = 2
LEAST_CHARS = 40
WORDS_PER_EDIT = 20
LONGEST_WORD = 16
TILE = 1024
BLOCK_CHARS = 1_000_000
BUCKETS = 8  # for each shuffle partition
HELD_KEYS = 1_000_000
COMPARED = 1024


class Stretches:
    """Several sequences of values as one array with running hash sums."""

    def __init__(self, points: np.ndarray, size: np.ndarray, mixed: np.ndarray):
        self.points, self.size = points, size
        self.first = np.concatenate([[0], np.cumsum(size)])[:-1]
        with np.errstate(over="ignore"):
            value = mixed * _power(len(points) + 1, False)[: len(points)]
            self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        self.back = _power(len(points) + 1, True)

    def part(self, start: np.ndarray, size: np.ndarray, salt: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Hashes of one substring of each line, or of each line in rows."""
        a = self.first[rows] + start
        with np.errstate(over="ignore"):
            body = (self.total[a + size] - self.total[a]) * self.back[a]
            return mix(body + (size.astype(np.uint64) << np.uint64(32)) + mix(salt.astype(np.uint64) + np.uint64(77))).view(np.int64)


class Lines(Stretches):
    """Lines of several texts by their code points."""

    def __init__(self, lines: list[str]):
        points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
        super().__init__(points, np.fromiter(map(len, lines), np.int64, len(lines)), _mixed()[points])


def line_ids(lines: list[str]) -> np.ndarray:
    """A digest of 64 bits for each line."""
    digests = b"".join([blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest() for line in lines])
    return np.frombuffer(digests, "<i8").astype(np.int64)


@cache
def _mixed() -> np.ndarray:
    """The mixed value of each code point."""
    return mix(np.arange(1, 0x110001, dtype=np.uint64))


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 0 for blanks, 1 inside words, 2 for a word of its own."""
    kind = np.full(0x110000, 2, np.uint8)
    kind[:0x2E80] = [0 if chr(c).isspace() else 1 if chr(c).isalnum() else 2 for c in range(0x2E80)]
    kind[0x3000] = 0
    return kind


class Words(Stretches):
    """Lines by hashes of their words."""

    def __init__(self, lines: Lines):
        kind = _kinds()[lines.points]
        inside, apart = kind == 1, np.ones(len(kind) + 1, bool)
        apart[1:-1] = ~inside[1:]
        apart[lines.first[lines.size > 0]] = True
        last = inside & apart[1:]
        apart[1:-1] |= ~inside[:-1]
        start = inside & apart[:-1]
        at, end = np.flatnonzero(start), np.flatnonzero(last) + 1
        for begin, stop in zip(*(x[end - at > LONGEST_WORD].tolist() for x in (at, end))):
            start[begin + LONGEST_WORD:stop:LONGEST_WORD] = True
            last[begin + LONGEST_WORD - 1:stop - 1:LONGEST_WORD] = True
        alone = kind == 2
        at, end = np.flatnonzero(start | alone), np.flatnonzero(last | alone) + 1
        with np.errstate(over="ignore"):
            body = (lines.total[end] - lines.total[at]) * lines.back[at]
            points = mix(body + ((end - at).astype(np.uint64) << np.uint64(32))) >> np.uint64(1)
        first = np.searchsorted(at, lines.first)
        super().__init__(points, np.diff(np.append(first, len(at))), mix(points + np.uint64(1)))

    def of(self, row: int) -> np.ndarray:
        return self.points[self.first[row]: self.first[row] + self.size[row]].astype(np.int64)


def length_classes(longest: int, per: int) -> tuple[np.ndarray, np.ndarray]:
    """Least numbers of words of the length classes, one beyond the longest line, and their limits; below the first the limit is 0."""
    starts = [max(per // 2, 2), per]
    while starts[-1] <= longest:
        starts.append(max(starts[-1] + per, starts[-1] * 5 // 4 // per * per))
    starts = np.array(starts)
    return starts, np.maximum(starts // per, 1)


def limits_of(size: np.ndarray, per: int) -> np.ndarray:
    starts, limits = length_classes(int(size.max(initial=0)), per)
    return np.concatenate([[0], limits])[np.searchsorted(starts, size, "right")]


def segment(size: np.ndarray, number: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of a segment; the last ones are the longer ones."""
    parts = edits + 1
    base, longer = size // parts, size % parts
    extra = np.maximum(number - (parts - longer), 0)
    return base * number + extra, base + (number >= parts - longer)


def keys_of(lines: Lines, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, keys, kind): segments of each line (0), and probes for lines as long or shorter (1)."""
    every = np.arange(len(lines.size))
    for number in range(edits + 1):
        start, size = segment(lines.size, number, edits)
        yield every, lines.part(start, size, lines.size * 16 + number), 0
        for less in range(edits + 1):
            length = lines.size - less
            start, size = segment(length, number, edits)
            low = max(-number, less - (edits - number))
            high = min(number, less + (edits - number))
            for shift in range(low, high + 1):
                if less == 0 and shift == 0:
                    continue  # its own segment
                at = start + shift
                rows = np.flatnonzero((at >= 0) & (at + size <= lines.size) & (length > 0))
                yield rows, lines.part(np.clip(at, 0, np.maximum(lines.size - size, 0)), size, length * 16 + number)[rows], 1


def word_keys_of(words: Words, per: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, keys, kind) like keys_of, over words and with the limit of each length class."""
    starts, limits = length_classes(int(words.size.max(initial=0)), per)
    for number, (low, high, edits) in enumerate(zip(starts.tolist(), starts[1:].tolist(), limits.tolist())):
        size = low // (edits + 1)
        own = np.flatnonzero((words.size >= low) & (words.size < high))
        longer = np.flatnonzero((words.size >= low) & (words.size < high + edits))
        shifts = [range(max(-k, k - edits), k + 1) for k in range(edits + 1)]
        anywhere = sum(map(len, shifts)) > low

        def keys(rows, at, k):
            return rows, words.part(at, np.full(len(rows), size, np.int64), k * (not anywhere) + (1 << 40) + (number << 20), rows)  # noqa: B023

        parts = np.arange(edits + 1)
        if len(own):
            yield *keys(np.repeat(own, len(parts)), np.tile(parts * size, len(own)), np.tile(parts, len(own))), 0
        if not anywhere and len(longer):
            places = np.concatenate([np.array(s) for s in shifts])
            part = np.repeat(parts, [len(s) for s in shifts])
            at = part * size + places
            count = words.size[longer][:, None]
            rows, column = np.nonzero((count >= at + size) & ((places != 0) | (count >= high)))
            if len(rows):
                yield *keys(longer[rows], at[column], part[column]), 1
        if anywhere and len(longer):
            count = words.size[longer] - size + 1
            rows = np.repeat(longer, count)
            at = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            probe = (words.size[rows] >= high) | (at % size != 0) | (at // size > edits)
            yield *keys(rows[probe], at[probe], np.zeros(int(probe.sum()), np.int64)), 1


def _blocks(texts: list[str | None], least: int):
    """(row, place, line) of the lines that take part, in blocks of bounded size."""
    rows, places, lines, size = [], [], [], 0
    for row, text in enumerate(texts):
        for place, line in enumerate((text or "").split("\n")):
            line = line.strip(BLANKS)
            if len(line) >= least:
                rows.append(row)
                places.append(place)
                lines.append(line)
                size += len(line)
                if size > BLOCK_CHARS:
                    yield rows, places, lines
                    rows, places, lines, size = [], [], [], 0
    if lines:
        yield rows, places, lines


def occurrences(docs: DataFrame, least: int) -> DataFrame:
    """(doc, row, place, line) of the columns doc, row and text."""
    kind = docs.schema["doc"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = [(np.array(r), np.array(p, np.int32), line_ids(x)) for r, p, x in _blocks(batch.column(2).to_pylist(), least)]
        if not found:
            return None
        rows, places, ids = (np.concatenate(x) for x in zip(*found))
        rows = pa.array(rows)
        return pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(places), pa.array(ids)], names=["doc", "row", "place", "line"])

    return in_batches(docs.select("doc", "row", "text"), f"doc {kind}, row bigint, place int, line bigint", work)


def _fresh_lines(batches: Iterator[pa.RecordBatch], least: int):
    """(ids, lines): blocks of a task's distinct lines."""
    seen: set[int] = set()
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            for _, _, lines in _blocks(batch.column(0).slice(start, 512).to_pylist(), least):
                own = {}
                for key, line in zip(line_ids(lines).tolist(), lines):
                    if key not in seen:
                        seen.add(key)
                        own[key] = line
                if own:
                    yield np.fromiter(own, np.int64, len(own)), list(own.values())


def _packed(keys: np.ndarray, ids: np.ndarray, kinds: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row for each bucket, a range of keys: the low 40 bits of its keys and their lines, segments first."""
    keys = keys.view(np.uint64)
    bucket = ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    place = bucket * 2 + kinds
    order = np.argsort(place.astype(np.min_scalar_type(2 * buckets)), kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    ends = np.append(first[1:], len(order))
    part = keys[order]
    columns = [part.astype("<u4"), (part >> np.uint64(32)).astype(np.uint8), ids[order]]
    segments = np.add.reduceat(kinds[order] == 0, first, dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(found), pa.array(segments), *[pa.array([x[i:j].tobytes() for i, j in zip(first.tolist(), ends.tolist())], pa.binary()) for x in columns]],
        names=["bucket", "segments", "low", "high", "lines"])


def _shared_in_bucket(rows: pa.Table) -> pa.Table:
    """The shared keys of one bucket."""
    low, high, ids = (np.frombuffer(b"".join(rows.column(k).to_pylist()), kind) for k, kind in (("low", "<u4"), ("high", np.uint8), ("lines", np.int64)))
    keys = (np.int64(rows.column("bucket")[0].as_py()) << 40) | (high.astype(np.int64) << 32) | low.astype(np.int64)
    counts = np.array([len(x) for x in rows.column("high").to_pylist()])
    place = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
    kinds = (place >= np.repeat(rows.column("segments").to_numpy(), counts)).astype(np.int32)
    order = np.argsort(keys)
    again = keys[order[1:]] == keys[order[:-1]]
    at = order[np.concatenate([again, [False]]) | np.concatenate([[False], again])]
    at = at[np.lexsort((ids[at], kinds[at], keys[at]))]
    many = pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(ids[at]), pa.array(kinds[at])], names=["s", "class", "n"])
    schema = pa.schema([("s", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("hub", pa.int64()), ("hub_n", pa.int32())])
    return pa.Table.from_batches([x.cast(schema) for x in _shared_only(iter([many]))], schema)


def shared_keys(docs: DataFrame, edits: int, least: int, per: int | None = None) -> DataFrame:
    """(s, class, n, hub, hub_n): lines of keys that several share; n is 0 for a segment and 1 for a probe.
    Keys travel packed, by ranges of bounded size, and are sorted as arrays."""
    buckets = BUCKETS * shuffle_partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for ids, block in _fresh_lines(batches, least):
            lines = Lines(block)
            for rows, keys, kind in chain(keys_of(lines, edits), word_keys_of(Words(lines), per) if per else ()):
                held.append((keys, ids[rows], np.full(len(rows), kind, np.int8)))
                many += len(rows)
            if many > HELD_KEYS:
                yield _packed(*(np.concatenate(x) for x in zip(*held)), buckets)
                held, many = [], 0
        if many:
            yield _packed(*(np.concatenate(x) for x in zip(*held)), buckets)

    rows = docs.select("text").mapInArrow(run, "bucket bigint, segments int, low binary, high binary, lines binary")
    shared = rows.groupBy("bucket").applyInArrow(_shared_in_bucket, "s bigint, class bigint, n int, hub bigint, hub_n int")
    return shared.where("hub_n = 0")


def wanted_lines(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """(class, line) of the wanted lines."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_of(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _fresh_lines(batches, least):
            place = (ids.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            hit = np.flatnonzero(shared.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1)
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array([block[i] for i in hit], pa.string())], names=["class", "line"])

    found = docs.select("text").mapInArrow(run, "class bigint, line string").dropDuplicates(["class"])
    return found.join(wanted, "class", "left_semi")


def _common(points: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How far the points from a and from b on are equal, up to room."""
    out, live, width = np.zeros(len(a), np.int64), np.flatnonzero(room > 0), 4
    while len(live):
        rest = []
        step = np.arange(width)
        for start in range(0, len(live), max(1, 1 << 20 >> width.bit_length())):
            part = live[start:start + max(1, 1 << 20 >> width.bit_length())]
            done = out[part]
            left = np.minimum(room[part] - done, width)
            at = np.minimum(step, left[:, None] - 1)
            off = points[(a[part] + done)[:, None] + at] != points[(b[part] + done)[:, None] + at]
            ends = off.any(axis=1)
            out[part] += np.where(ends, off.argmax(axis=1), left)
            rest.append(part[~ends & (out[part] < room[part])])
        live, width = np.concatenate(rest), min(2 * width, 1024)
    return out


def _reached(points: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray, n: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Which stretches of m and n points, from a and b on, are at most ``limit`` edits apart. After each
    edit, ``far`` holds for each diagonal the furthest place of the first stretch that is reached."""
    close, most = np.zeros(len(a), bool), int(limit.max(initial=0))
    live = np.flatnonzero(np.abs(n - m) <= limit)
    none = -(1 << 40)
    far = np.full((len(live), 2 * most + 3), none, np.int64)
    diagonal = np.arange(-most, most + 1)
    for edit in range(most + 1):
        if not len(live):
            break
        if edit:
            place = np.maximum(np.maximum(far[:, 1:-1] + 1, far[:, 2:] + 1), far[:, :-2])
        else:
            place = np.where(diagonal == 0, 0, np.full((len(live), 1), none))
        goal, left = (n - m)[live], limit[live] - edit
        place = np.minimum(place, np.minimum(m[live][:, None], n[live][:, None] - diagonal))
        place[(place < 0) | (place + diagonal < 0) | (np.abs(goal[:, None] - diagonal) > left[:, None])] = none
        row, column = np.nonzero(place >= 0)
        x, who = place[row, column], live[row]
        y = x + diagonal[column]
        far = np.full((len(live), 2 * most + 3), none, np.int64)
        far[:, 1:-1] = place
        far[row, column + 1] = x + _common(points, a[who] + x, b[who] + y, np.minimum(m[who] - x, n[who] - y))
        done = far[np.arange(len(live)), goal + most + 1] >= m[live]
        close[live[done]] = True
        on = ~done & (left > 0)
        live, far = live[on], far[on]
    return close


def _apart(lines: Stretches, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Which pairs of rows are at most ``limit`` edits apart."""
    close = np.zeros(len(left), bool)
    able = np.abs(lines.size[left] - lines.size[right]) <= limit
    group = np.ceil(np.log2(np.maximum(limit, 1))).astype(np.int64)
    for kind in np.unique(group[able]).tolist():
        at = np.flatnonzero(able & (group == kind))
        size = max(16, COMPARED * 8 >> kind)
        for start in range(0, len(at), size):
            part = at[start:start + size]
            x, y = left[part], right[part]
            close[part] = _reached(lines.points, lines.first[x], lines.size[x], lines.first[y], lines.size[y], limit[part])
    return close


def within(pairs: list[tuple[str, str]], edits: int) -> np.ndarray:
    """Which pairs are at most ``edits`` edits apart."""
    lines = Lines([x for pair in pairs for x in pair])
    return _apart(lines, np.arange(0, 2 * len(pairs), 2), np.arange(1, 2 * len(pairs), 2), np.full(len(pairs), edits))


def words_within(words: Words, left: np.ndarray, right: np.ndarray, per: int) -> np.ndarray:
    """Which pairs of rows are at most the limit of the shorter one apart, in words."""
    limits = limits_of(np.minimum(words.size[left], words.size[right]), per)
    close = np.zeros(len(left), bool)
    at = np.flatnonzero(limits > 0)
    close[at] = _apart(words, left[at], right[at], limits[at])
    return close


def near(texts: list[str], left: np.ndarray, right: np.ndarray, edits: int, per: int | None = None) -> np.ndarray:
    """Which pairs of texts are near copies, in blocks of bounded size."""
    close = np.zeros(len(left), bool)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    block = np.cumsum(size[left] + size[right]) // BLOCK_CHARS
    for start, end in zip(first := np.flatnonzero(np.diff(block, prepend=-1)), [*first[1:], len(left)]):
        used, place = np.unique(np.concatenate([left[start:end], right[start:end]]), return_inverse=True)
        lines = Lines([texts[i] for i in used])
        x, y = np.split(place.ravel(), 2)
        found = _apart(lines, x, y, np.full(len(x), edits))
        if per and not found.all():
            rest = np.flatnonzero(~found)
            found[rest] = words_within(Words(lines), x[rest], y[rest], per)
        close[start:end] = found
    return close


def verify(pairs: DataFrame, texts: DataFrame, edits: int, per: int | None = None) -> DataFrame:
    left, right = (texts.select(F.col("class").alias(k), F.col("line").alias(f"{k}_line")) for k in "ab")
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "a_line", "b_line")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2).to_pylist() + batch.column(3).to_pylist()
        keep = near(texts, np.arange(batch.num_rows), np.arange(batch.num_rows) + batch.num_rows, edits, per)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return in_batches(both, "a bigint, b bigint", work, 4096)


def _counts(points: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Counts of values in 64 bins for each stretch, cut off at 255: their differences are no greater than the whole counts' ones."""
    owner = np.repeat(np.arange(len(size)), size)
    bins = np.bincount(owner * 64 + (points & np.uint64(63)).astype(np.int64), minlength=64 * len(size))
    return [x.tobytes() for x in np.minimum(bins, 255).astype(np.uint8).reshape(-1, 64)]


def line_signs(lines: DataFrame) -> DataFrame:
    """(class, size, words, bag, word_bag) of the lines."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = Lines(batch.column(1).to_pylist())
        words = Words(lines)
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(lines.size.astype(np.int32)), pa.array(words.size.astype(np.int32)),
            pa.array(_counts(lines.points, lines.first, lines.size), pa.binary()),
            pa.array(_counts(words.points, words.first, words.size), pa.binary())], names=["class", "size", "words", "bag", "word_bag"])

    return in_batches(lines.select("class", "line"), "class bigint, size int, words int, bag binary, word_bag binary", work)


def _tile_pairs(tile, cls, kind, comp, size, words, bags, word_bags, edits: int, per: int | None, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by tile, whole tiles only: pairs of different components, one of them by its own segment,
    whose lengths and counts of signs or words leave room for the limit, likelier ones first. With ``forest``
    a spanning forest of them and (c, c) for each class c that is in any."""
    start = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    many = np.diff(np.append(start, len(tile)))
    left_over = np.repeat(many, many) - (np.arange(len(tile)) - np.repeat(start, many))
    limits = limits_of(words, per) if per else np.zeros(len(tile), np.int64)
    found, rows = [], np.arange(len(tile))
    apart = lambda bag, i, j: np.abs(bag[i].astype(np.int16) - bag[j]).sum(axis=1, dtype=np.int64)
    for d in range(1, int(many.max(initial=1))):
        rows = rows[left_over[rows] > d]
        other = rows + d
        ok = (comp[rows] != comp[other]) & (cls[rows] != cls[other]) & ((kind[rows] == 0) | (kind[other] == 0))
        i, j = rows[ok], other[ok]
        limit = np.minimum(limits[i], limits[j])
        by_words = (limit > 0) & (np.abs(words[i] - words[j]) <= limit)
        by_signs = np.abs(size[i] - size[j]) <= edits
        likely = np.full(len(i), -np.inf)
        for able, bag, most in ((by_signs, bags, np.full(len(i), edits)), (by_words, word_bags, limit)):
            at = np.flatnonzero(able)
            off = apart(bag, i[at], j[at])
            near_ = off <= 2 * most[at]
            likely[at[near_]] = np.maximum(likely[at[near_]], -off[near_] / np.maximum(words[i[at[near_]]], 1))
        room = np.isfinite(likely)
        found.append((i[room], j[room], likely[room]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j, likely = (np.concatenate(x) for x in zip(*found))
    alone = np.zeros(0, np.int64)
    if forest and len(i):
        alone = np.unique(cls[np.concatenate([i, j])])
        _, own = np.unique(np.stack([np.repeat(np.arange(len(start)), many), comp], axis=1), axis=0, return_inverse=True)
        kept = _forest(i, j, likely, own.ravel())
        i, j, likely = i[kept], j[kept], likely[kept]
    order = np.argsort(-likely, kind="stable")
    pairs = np.stack([np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])])[:, order]
    _, at = np.unique(pairs, axis=1, return_index=True)
    pairs = pairs[:, np.sort(at)]
    return np.concatenate([pairs[0], alone]), np.concatenate([pairs[1], alone])


def _links(a: np.ndarray, b: np.ndarray, cls: np.ndarray, comp: np.ndarray, texts: list[str], edits: int, per: int | None) -> np.ndarray:
    """Which of the pairs (a, b) of classes join components: all are compared, in their order, but those that earlier links have joined."""
    node, first = np.unique(cls, return_index=True)
    x, y = first[np.searchsorted(node, a)], first[np.searchsorted(node, b)]
    _, label = np.unique(comp, return_inverse=True)
    label = label.ravel()
    p, q, root = label[x], label[y], np.arange(label.max(initial=-1) + 1)
    links = []
    for start in range(0, len(a), COMPARED):
        part = np.arange(start, min(start + COMPARED, len(a)))
        part = part[root[p[part]] != root[q[part]]]
        for k in part[near(texts, x[part], y[part], edits, per)].tolist() if len(part) else ():
            one, two = root[p[k]], root[q[k]]
            if one != two:
                root[root == one] = two
                links.append(k)
    return np.array(links, np.int64)


def tiles(runs: DataFrame, label: DataFrame) -> DataFrame:
    """(s, i, j, class, n): rows of the keys that still hold several components, in blocks of bounded size."""
    rows = with_component(runs.select("s", "class", "n"), label)
    lists = [F.bit_xor(F.xxhash64("class", "n", F.lit(k))).alias(f"list{k}") for k in (1, 2)]
    mixed = rows.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), *lists).where("lo != hi")
    # Keys of a shared passage have the same lines: one of them is enough.
    once = mixed.groupBy("size", "list1", "list2").agg(F.min("s").alias("s"))
    rows = rows.join(once.select("s", "size"), "s").withColumn("blocks", F.ceil(F.col("size") / TILE).cast("int"))
    rows = rows.withColumn("block", F.pmod("class", "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return stored(rows.select("s", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "class", "n"), "line-tiles")


def tile_candidates(
    rows: DataFrame, label: DataFrame, signs: DataFrame, edits: int, per: int | None, forest: bool, lines: DataFrame | None = None,
) -> DataFrame:
    """Pairs (a, b) of tiles' lines in different components that may be near. With
    ``lines`` they are compared in the tile and only near ones leave it, so rows
    out are links and do not grow with the pairs of a tile."""
    rows = with_component(rows, label).join(signs, "class")
    if lines is not None:
        rows = rows.join(lines, "class")
    rows = rows.repartition(shuffle_partitions(rows.sparkSession), "s", "i", "j").sortWithinPartitions("s", "i", "j")
    compare = lines is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close(table: pa.Table):
            change = np.zeros(table.num_rows, bool)
            for k in range(3):
                key = table.column(k).to_numpy()
                change[1:] |= key[1:] != key[:-1]
            numbers = [table.column(k).to_numpy().astype(np.int64) for k in ("class", "n", "comp", "size", "words")]
            bags = [np.frombuffer(b"".join(table.column(k).to_pylist()), np.uint8).reshape(-1, 64) for k in ("bag", "word_bag")]
            a, b = _tile_pairs(np.cumsum(change), *numbers, *bags, edits, per, forest)
            if compare and len(a):
                keep = _links(a, b, numbers[0], numbers[2], table.column("line").to_pylist(), edits, per)
                a, b = a[keep], b[keep]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            last = np.ones(batch.num_rows, bool)
            for k in range(3):
                last &= batch.column(k).to_numpy() == batch.column(k)[batch.num_rows - 1].as_py()
            cut = int(batch.num_rows - last[::-1].argmin()) if not last.all() else 0
            if cut:  # the last tile may go on in the next batch
                yield close(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif held and any(held[-1].column(k)[held[-1].num_rows - 1] != batch.column(k)[0] for k in range(3)):
                yield close(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield close(pa.Table.from_batches(held))

    columns = ["s", "i", "j", "class", "n", "comp", "size", "words", "bag", "word_bag"] + ["line"] * compare
    return stored(rows.select(*columns).mapInArrow(run, "a bigint, b bigint").distinct(), "line-candidates")


def further_links(runs: DataFrame, label: DataFrame, lines: DataFrame, edits: int, per: int | None) -> DataFrame:
    """The components after all links that the first pass left."""
    rows = tiles(runs, label)
    discard(runs)
    signs = stored(line_signs(lines.join(rows, "class", "left_semi")), "line-signs")
    found = tile_candidates(rows, label, signs, edits, per, forest=True)
    if found.isEmpty():
        return label
    members = found.where("a = b").select(F.col("a").alias("class"))
    lines = stored(lines.join(members, "class", "left_semi"), "candidate-lines")
    rest = stored(rows.join(members, "class", "left_semi"), "line-tiles")
    discard(rows)
    links = stored(verify(found.where("a != b"), lines, edits, per), "links")
    if not links.isEmpty():
        label = merged(label, links)
    links = tile_candidates(rest, label, signs, edits, per, False, lines)
    return label if links.isEmpty() else merged(label, links)


def line_classes(docs: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS, per: int | None = None) -> DataFrame:
    """(node, component) of lines, by hash, that have a near copy; of the column text."""
    runs = stored(shared_keys(docs, edits, least, per), "line-runs")
    met = runs.where("class != hub").groupBy("class", "hub").agg(F.count("*").alias("times"))
    first = met.groupBy("class").agg(F.max_by("hub", F.struct("times", "hub")).alias("hub"))
    first = stored(first.select(F.col("hub").alias("a"), F.col("class").alias("b")), "line-first")
    lines = stored(wanted_lines(docs, runs.select("class"), least), "key-lines")
    edges = stored(verify(first, lines, edits, per), "line-edges")
    label = components(edges)
    return further_links(runs, label, lines, edits, per)


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", edits: int = EDITS, least: int = LEAST_CHARS, per: int | None = None, short: bool = False) -> DataFrame:
    """The documents with the text lacking later copies of lines, and n_lines and n_dropped."""
    row = F.xxhash64(F.col(f"`{text}`"))
    plain = docs.select(F.col(f"`{key}`").alias("doc"), row.alias("row"), F.col(f"`{text}`").alias("text"))
    label = line_classes(plain, edits, least, per)
    seen = stored(occurrences(plain, 1 if short else least), "lines")
    place = F.struct("doc", "row", "place")
    lines = seen.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    lines = lines.join(label, F.col("line") == F.col("node"), "left").where("component IS NOT NULL OR n > 1")
    lines = stored(lines.select("line", "first", "component"), "line-copies")
    first = lines.where("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("reach"))
    again = lines.join(first, "component", "left").select("line", F.coalesce("reach", "first").alias("first"))
    drop = seen.join(again, "line").where(place != F.col("first")).groupBy("doc", "row").agg(F.collect_set("place").alias("_drop"))
    made = ("n_lines", "n_dropped")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    rows = docs.select(*rest, row.alias("_row")).join(
        drop.withColumnsRenamed({"doc": "_doc", "row": "_same"}), F.col(f"`{key}`").eqNullSafe(F.col("_doc")) & (F.col("_row") == F.col("_same")), "left")
    parts = F.split(F.col(f"`{text}`"), "\n", -1)
    kept = F.filter(parts, lambda x, i: ~F.array_contains("_drop", i))
    lines_left = F.when(F.col("_drop").isNull(), F.col(f"`{text}`")).otherwise(F.array_join(kept, "\n"))
    return rows.select(
        *[lines_left.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in made],
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"))


def without_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", edits: int = EDITS, least: int = LEAST_CHARS, per: int | None = None, short: bool = False) -> DataFrame:
    """The documents without later copies of lines, in the columns they had. A
    document of which nothing but blanks is left goes: all of it is elsewhere."""
    own, back = aside(docs, "n_lines", "n_dropped", "_row")
    kept = dedup(own, text, key, edits, least, per, short)
    gone = (F.col("n_dropped") > 0) & (F.length(F.trim(F.col(f"`{text}`"), F.lit(BLANKS))) == 0)
    return back(kept.where(~gone))
