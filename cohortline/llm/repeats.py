"""Remove word sequences that occur more than once, found by fixed-block anchors.

A window of ``width`` words holds, wherever it lies, one whole block of
(width + 1) // 2 words that begins at a multiple of that length. So:

1. The non-overlapping blocks of every document are the index, and every rolling
   block of every document is a probe. Documents are packed in batches; a batch
   sends the distinct hashes of its probes, as short binary strings, to hash
   ranges, and gets back one bit each: is the block in the index, and does it
   start in more than one place?
2. A block found is extended to both sides: the windows around it, one for each
   place the block can have in a window, are looked up in the same way by longer
   hashes. Windows that start in two places or more overlap to the maximal exact
   repeats that reach ``width`` words, and the words they cover go.

A hash that many documents share is sent once per batch, so a frequent passage
costs its batches, not its occurrences or their pairs. Ranges are sized by the
data. Texts move once, compressed, and documents without a found block leave
after the first step. Results are exact up to collisions of window hashes (64
bits and the range's bits, from an independent hash).

Defined results. Words are runs of characters other than the six blanks; null,
empty and blank texts have none. Windows of one document count like those of
two, overlapping ones as well; repeated rows are documents of their own. Kept
words are joined by one space, also in untouched documents. An empty table gives
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import discard, shuffle_partitions, spread, stored
from cohortline.llm.wordhash import hash_words, rolling

WIDTH = 35
BATCH_BYTES, BATCH_ROWS = 1_000_000, 512
RANGE_BYTES = 24_000_000  # text per hash range: some four million probes
_SECOND = 0x5851F42D4C957F2D  # seed of the hash that deals windows to ranges


# --- batches of documents -----------------------------------------------------------------------

def _pack(texts: list[bytes]) -> bytes:
    sizes = np.array([len(texts), *map(len, texts)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(texts))


def _unpack(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(raw, np.int64, n, 8))
    return [raw[end - size:end] for end, size in zip(ends, np.frombuffer(raw, np.int64, n, 8))]


def _batched(key: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size = [], [], 0
        number = TaskContext.get().partitionId() << 33

        def out() -> pa.RecordBatch:
            return pa.record_batch({
                "batch": pa.array([number], pa.int64()), "keys": pa.array([keys], pa.list_(key)),
                "texts": pa.array([_pack(texts)], pa.binary()), "size": pa.array([size], pa.int64())})

        for batch in batches:
            for own, text in zip(batch.column(0), batch.column(1)):
                data = (text.as_py() or "").encode("utf-8", "replace")
                if texts and (size + len(data) > BATCH_BYTES or len(texts) == BATCH_ROWS):
                    yield out()
                    keys, texts, size, number = [], [], 0, number + 1
                keys.append(own.as_py())
                texts.append(data)
                size += len(data)
        if texts:
            yield out()

    return run


class _Places:
    """The words of a batch: hashes, place in the document, words from there to the document's end."""

    def __init__(self, texts: list[bytes], width: int):
        words = hash_words(texts, lower=False)
        self.hashes, self.counts, self.starts = words.hashes, np.diff(words.starts), words.starts
        self.place = np.arange(len(self.hashes)) - np.repeat(words.starts[:-1], self.counts)
        self.left = np.repeat(self.counts, self.counts) - self.place
        self.width, self.block = width, (width + 1) // 2

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the rolling blocks of documents of at least one window begin, and their hashes."""
        at = np.flatnonzero((self.left >= self.block) & (self.place + self.left >= self.width))
        return at, rolling(self.hashes, self.block)[at]

    def aligned(self, at: np.ndarray) -> np.ndarray:
        return self.place[at] % self.block == 0

    def windows(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the windows around the found blocks (a flag for each word) begin, and two independent hashes."""
        at = np.flatnonzero(self.left >= self.width)
        first = at + (-self.place[at]) % self.block  # the aligned block in this window
        at = at[found[first]]
        return at, rolling(self.hashes, self.width)[at], rolling(self.hashes, self.width, _SECOND)[at]


# --- questions to hash ranges and their answers -------------------------------------------------

_QUESTION = "batch long, part int, hashes binary, listed binary, often binary"
_ANSWER = "batch long, part int, found binary"


class _Question:
    """Distinct hashes of a batch in order of their ranges."""

    def __init__(self, dealt: np.ndarray, hashes: np.ndarray, listed: np.ndarray, parts: int):
        """``dealt`` has the range in its upper bits; ``listed`` marks what belongs to the index."""
        part = ((dealt >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.lexsort((hashes, part))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (part[order][1:] != part[order][:-1])
        first = np.flatnonzero(fresh)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(fresh) - 1
        self.hashes, self.part = hashes[order][first], part[order][first]
        self.often = np.diff(np.append(first, len(order))) > 1
        self.listed = np.logical_or.reduceat(listed[order], first) if len(first) else np.zeros(0, bool)
        self.cuts = np.append(np.flatnonzero(np.diff(self.part, prepend=-1)), len(self.part)) if len(first) else np.zeros(1, np.int64)

    def rows(self, batch: int, kind: str) -> pa.RecordBatch:
        spans = list(zip(self.cuts, self.cuts[1:]))
        packed = lambda flags: [np.packbits(flags[a:b]).tobytes() for a, b in spans]
        return pa.record_batch({
            "batch": pa.array([batch] * len(spans), pa.int64()),
            "part": pa.array([self.part[a] for a, _ in spans], pa.int32()),
            "hashes": pa.array([self.hashes[a:b].astype(kind).tobytes() for a, b in spans], pa.binary()),
            "listed": pa.array(packed(self.listed), pa.binary()), "often": pa.array(packed(self.often), pa.binary()),
        })

    def answer(self, part: np.ndarray, found: list[bytes]) -> np.ndarray:
        """The answer for each hash asked, from one string of bits per range."""
        bits = dict(zip(part.tolist(), found))
        spans = list(zip(self.cuts, self.cuts[1:]))
        known = [np.unpackbits(np.frombuffer(bits[int(self.part[a])], np.uint8), count=b - a) for a, b in spans]
        return (np.concatenate(known).astype(bool) if known else np.zeros(0, bool))[self.which]


def _answered(kind: str):
    """A hash is found if some batch lists it and it occurs twice or more."""

    def run(table: pa.Table) -> pa.Table:
        blobs = table["hashes"].to_pylist()
        sizes = [len(b) // np.dtype(kind).itemsize for b in blobs]
        flags = lambda name: np.concatenate([
            np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(table[name].to_pylist(), sizes)]).astype(bool)
        hashes = np.frombuffer(b"".join(blobs), kind)
        order = np.argsort(hashes, kind="stable")
        fresh = np.ones(len(order), bool)
        fresh[1:] = hashes[order][1:] != hashes[order][:-1]
        first = np.flatnonzero(fresh)
        twice = (np.diff(np.append(first, len(order))) > 1) | np.logical_or.reduceat(flags("often")[order], first)
        twice &= np.logical_or.reduceat(flags("listed")[order], first)
        found = np.empty(len(order), bool)
        found[order] = twice[np.cumsum(fresh) - 1]
        cuts = np.cumsum([0, *sizes])
        return pa.table({
            "batch": table["batch"], "part": table["part"],
            "found": pa.array([np.packbits(found[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    return run


def _asked(rows: DataFrame, question, parts: int, kind: str) -> DataFrame:
    """The answers to the questions of all batches."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield question(row)[1].rows(row["batch"], kind)

    asked = spread(rows.mapInArrow(ask, _QUESTION), "part")
    return asked.groupBy("part").applyInArrow(_answered(kind), _ANSWER)


def _bits(answers: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    return answers["part"].to_numpy(), answers["found"].to_pylist()


# --- the operator -------------------------------------------------------------------------------

def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, n_words, n_removed, text): each document without the words that repeated windows cover."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    named = docs.schema["key"].dataType.simpleString()
    arrow = spark.createDataFrame([], docs.select("key").schema).toArrow().schema.field(0).type
    packed = f"batch long, keys array<{named}>, texts binary, size long"
    batches = stored(docs.mapInArrow(_batched(arrow), packed), "batches")
    size = batches.agg(F.sum("size")).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // RANGE_BYTES))

    def first(row) -> tuple[_Places, _Question, np.ndarray, list[bytes]]:
        texts = _unpack(row["texts"])
        places = _Places(texts, width)
        at, hashes = places.probes()
        # Ranges take the upper bits, so 32 bits remain to tell; what is found by chance fails in the second step.
        return places, _Question(hashes, hashes & np.uint64(0xFFFFFFFF), places.aligned(at), parts), at, texts

    def parted(key_, left: pa.Table, answers: pa.Table) -> pa.Table:
        """Documents without a found block, and the rest with a bit for each aligned block."""
        row = left.to_pylist()[0]
        places, question, at, texts = first(row)
        found = np.zeros(len(places.hashes), bool)
        found[at] = question.answer(*_bits(answers)) & places.aligned(at)
        owner = np.repeat(np.arange(len(texts)), places.counts)
        open_ = np.zeros(len(texts), bool)
        open_[owner[found]] = True
        side = lambda flag: ([k for k, o in zip(row["keys"], open_) if o == flag], _pack([t for t, o in zip(texts, open_) if o == flag]))
        (done_keys, done), (keys, rest) = side(False), side(True)
        # Blocks of documents that stay open, in order: their words are the words of the packed rest.
        kept = found[open_[owner]]
        return pa.table({
            "batch": pa.array([row["batch"]], pa.int64()),
            "done_keys": pa.array([done_keys], pa.list_(arrow)), "done": pa.array([done], pa.binary()),
            "keys": pa.array([keys], pa.list_(arrow)), "texts": pa.array([rest], pa.binary()),
            "found": pa.array([np.packbits(kept).tobytes()], pa.binary())})

    answers = _asked(batches.select("batch", "texts"), lambda row: first(row)[:2], parts, "<u4")
    both = batches.groupBy("batch").cogroup(answers.groupBy("batch"))
    opened = stored(both.applyInArrow(
        parted, f"batch long, done_keys array<{named}>, done binary, keys array<{named}>, texts binary, found binary"), "opened")
    discard(batches)

    def second(row) -> tuple[_Places, _Question, np.ndarray, list[bytes]]:
        texts = _unpack(row["texts"])
        places = _Places(texts, width)
        found = np.unpackbits(np.frombuffer(row["found"], np.uint8), count=len(places.hashes)).astype(bool)
        at, hashes, dealt = places.windows(found)
        return places, _Question(dealt, hashes, np.ones(len(at), bool), parts), at, texts

    schema = f"key {named}, n_words long, n_removed long, text string"

    def shown(keys: list, words: list[int], removed: list[int], texts: list[bytes]) -> dict:
        return {"key": pa.array(keys, arrow), "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "text": pa.array(texts, pa.binary()).cast(pa.string())}

    def whole(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            for row in batch.to_pylist():
                words = [t.split() for t in _unpack(row["done"])]
                yield pa.record_batch(shown(row["done_keys"], list(map(len, words)), [0] * len(words), [b" ".join(w) for w in words]))

    def cut(key_, left: pa.Table, answers_: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        places, question, at, texts = second(row)
        at = at[question.answer(*_bits(answers_))]
        edges = np.zeros(len(places.hashes) + 1, np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + width, -1)
        covered = np.cumsum(edges)[:-1] > 0
        removed, kept = [], []
        for text, start, count in zip(texts, places.starts, places.counts):
            gone = covered[start:start + count]
            removed.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(text.split(), gone.tolist()) if not g))
        return pa.table(shown(row["keys"], places.counts.tolist(), removed, kept))

    rest = opened.select("batch", "keys", "texts", "found").where("size(keys) > 0")
    answers = _asked(rest.select("batch", "texts", "found"), lambda row: second(row)[:2], parts, "<u8")
    ends = rest.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(cut, schema)
    rows = opened.select("done_keys", "done").mapInArrow(whole, schema).unionByName(ends)
    return rows.withColumnRenamed("key", key)
