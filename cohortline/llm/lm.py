"""Interpolated modified Kneser-Ney model of word pairs, and scores by it.

Counting: a task turns its texts into distinct pairs with counts and sends them
as packed runs to shards by pair hash, so no word owns a shard. A shard adds
the runs, writes its pairs as one sorted array into the shared folder (56 bits
of hash and 8 of count in each place) and passes on what contexts and
continuations need, summed, to shards by word, which write sorted word arrays.
All counts cover all training texts; none is pruned. The driver sees sums and
file names only.

Scoring: workers map the arrays into memory and search them for the distinct
words and pairs of a block of texts. Where the shared folder is no local path,
each worker fetches the files once and removes them when its task ends.

P(v | u) = max(c(uv) - D(c(uv)), 0) / c(u) + g(u) P(v), with P(v) from the number
of words seen before v, discounted the same way and mixed with a uniform share
over the vocabulary and one unknown word. After an unseen u it is P(v).

Null texts are empty: the end token alone. Nothing to learn from gives every
token the unknown word's probability, which is 1. Word hashes have 52 bits.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import stored
from cohortline.llm.warc import opened
from cohortline.llm.wordhash import blocks, hash_words, mix
from cohortline.session import scratch_path

SHARD_BYTES = 8_000_000
BLOCK_BYTES = 4_000_000
FLUSH_PAIRS = 3_000_000
END, START = np.uint64(1), np.uint64(2)
_WORD_BITS = 52
_MANY = 255  # this count or more is kept beside the array


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, u, v) of all pairs: each token v, the end token last, with the token before it."""
    words = hash_words(texts)
    h = words.hashes >> np.uint64(64 - _WORD_BITS)
    h = np.where(h < 8, h + np.uint64(8), h)
    counts = np.diff(words.starts)
    total = len(h) + len(texts)
    ends = np.cumsum(counts + 1) - 1
    v = np.full(total, END, np.uint64)
    inner = np.ones(total, bool)
    inner[ends] = False
    v[inner] = h
    u = np.empty(total, np.uint64)
    u[1:] = v[:-1]
    begins = ends - counts
    u[begins] = START
    return np.repeat(np.arange(len(texts)), counts + 1), u, v


def pair_key(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(u + np.uint64(0x9E3779B97F4A7C15)) + v * np.uint64(0xD6E8FEB86659FD93))


def shard_of(values: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Ranges of equal width over values of so many bits."""
    return ((values >> np.uint64(bits - 32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def squeeze(columns: list[np.ndarray]) -> bytes:
    """Whole numbers as bytes: the first column sorted, as differences; bytes of equal rank side by side."""
    parts = []
    for k, column in enumerate(columns):
        column = column.astype("<u8")
        if k == 0:
            column = np.diff(column, prepend=np.uint64(0))
        parts.append(column.view(np.uint8).reshape(-1, 8).T.tobytes())
    data = b"".join(parts)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueeze(data: bytes, columns: int) -> list[np.ndarray]:
    size = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8).reshape(columns, 8, -1)
    out = [np.ascontiguousarray(raw[k].T).view("<u8").ravel() for k in range(columns)]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _sum_by(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return [key[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)]


def _counted(u: np.ndarray, v: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs, sorted by key: (key, u, v, count)."""
    key = pair_key(u, v)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(count[order], first) if len(first) else count[:0]
    return key[first], u[order][first], v[order][first], total


def _put(folder: str, name: str, arrays: list[np.ndarray]) -> str:
    """Write arrays one after the other under a name that no other attempt uses."""
    system, base = opened(folder)
    system.create_dir(base, recursive=True)
    own = f"{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{base}/{own}") as out:
        for array in arrays:
            out.write(np.ascontiguousarray(array).tobytes())
    return own


@dataclass
class Discounts:
    """Of a level: what is taken from counts of one, two, and three or more."""

    cut: tuple[float, float, float]

    @classmethod
    def of(cls, t: list[int]) -> Discounts:
        """From how many entries have a count of 1, 2, 3 and 4; one half where they don't tell."""
        if not t[0] or not t[1]:
            return cls((0.5, 0.5, 0.5))
        y = t[0] / (t[0] + 2 * t[1])
        found = [k + 1 - (k + 2) * y * t[k + 1] / t[k] if t[k] else 0.5 for k in range(3)]
        return cls(tuple(min(max(d, 0.01), k + 0.99) for k, d in enumerate(found)))

    def less(self, count: np.ndarray) -> np.ndarray:
        d = np.array([0.0, *self.cut])
        return np.maximum(count - d[np.minimum(count, 3).astype(np.int64)], 0)


@dataclass
class Model:
    folder: str
    pair_files: list[tuple[str, int, int]]   # by shard: name, pairs, of these with many
    word_files: list[tuple[str, int]]        # by shard: name, words
    texts: int
    tokens: int
    words: int                               # distinct tokens, the end token among them
    pairs: int
    cut: Discounts
    below: Discounts
    spread: float                            # share of the lowest level that is uniform
    opened: dict = field(default_factory=dict)

    def attach(self) -> None:
        """Map all arrays; fetch them first where the folder is not a local path."""
        system, base = opened(self.folder)
        if type(system).__name__ != "LocalFileSystem":
            local = tempfile.mkdtemp(prefix="ngrams-")
            self.opened["local"] = local
            for name in [f[0] for f in self.pair_files + self.word_files if f[0]]:
                with system.open_input_stream(f"{base}/{name}") as source, open(os.path.join(local, name), "wb") as target:
                    shutil.copyfileobj(source, target, 1 << 20)
            base = local
        at = lambda name, n: np.memmap(os.path.join(base, name), "<u8", "r", shape=(n,))
        self.opened["pairs"] = [at(name, n + 2 * m) if n else None for name, n, m in self.pair_files]
        self.opened["words"] = [at(name, 6 * n).reshape(6, n) if n else None for name, n in self.word_files]

    def detach(self) -> None:
        local = self.opened.pop("local", None)
        self.opened.clear()
        if local:
            shutil.rmtree(local, ignore_errors=True)

    def find_words(self, wanted: np.ndarray) -> np.ndarray:
        """Rows (count, ones, twos, more, before) of sorted words; zeros for unseen ones."""
        out = np.zeros((5, len(wanted)), np.uint64)
        cuts = np.searchsorted(shard_of(wanted, _WORD_BITS, len(self.word_files)), np.arange(len(self.word_files) + 1))
        for shard, table in enumerate(self.opened["words"]):
            own = wanted[cuts[shard]:cuts[shard + 1]]
            if table is not None and len(own):
                place = np.minimum(np.searchsorted(table[0], own), table.shape[1] - 1)
                hit = table[0][place] == own
                out[:, cuts[shard]:cuts[shard + 1]] = table[1:, place] * hit
        return out

    def find_pairs(self, wanted: np.ndarray) -> np.ndarray:
        """Counts of sorted pair keys."""
        out = np.zeros(len(wanted), np.uint64)
        cuts = np.searchsorted(shard_of(wanted, 64, len(self.pair_files)), np.arange(len(self.pair_files) + 1))
        for shard, (table, (_, n, many)) in enumerate(zip(self.opened["pairs"], self.pair_files)):
            own = wanted[cuts[shard]:cuts[shard + 1]] & ~np.uint64(255)
            if table is None or not len(own):
                continue
            found = table[np.minimum(np.searchsorted(table[:n], own), n - 1)]
            count = np.where(found & ~np.uint64(255) == own, found & np.uint64(255), np.uint64(0))
            if many and (count == _MANY).any():
                large = np.flatnonzero(count == _MANY)
                count[large] = table[n + many:][np.searchsorted(table[n:n + many], own[large])]
            out[cuts[shard]:cuts[shard + 1]] = count
        return out

    def score(self, texts: list[bytes]) -> list[np.ndarray]:
        """n_tokens, n_known, base_score and score of each text."""
        row, u, v = tokens(texts)
        words, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        facts = self.find_words(words).astype(np.float64)
        facts[0][words == END] = self.texts
        at_u, at_v = place[: len(u)], place[len(u):]
        count, ones, twos, more, before = facts
        known = count[at_v]
        lowest = np.full(len(words), 1.0) if not self.pairs else self.below.less(before) / self.pairs + self.spread / (self.words + 1)
        key = pair_key(u, v)
        keys, back = np.unique(key, return_inverse=True)
        pair = self.find_pairs(keys).astype(np.float64)[back]
        context = np.where(words == START, self.texts, count)
        left = np.where(context > 0, (self.cut.cut[0] * ones + self.cut.cut[1] * twos + self.cut.cut[2] * more) / np.maximum(context, 1), 1.0)
        p = self.cut.less(pair) / np.maximum(context[at_u], 1) + left[at_u] * lowest[at_v]
        n = len(texts)
        base = np.log10((known + 1) / (self.tokens + (self.words + 1)))
        return [np.bincount(row, minlength=n), np.bincount(row, known > 0, n).astype(np.int64), np.bincount(row, base, n), np.bincount(row, np.log10(p), n)]


_PART = "kind int, shard int, data binary, name string, n bigint, many bigint, t1 bigint, t2 bigint, t3 bigint, t4 bigint, total bigint, starts bigint"


def _rows(rows: list[dict]) -> pa.RecordBatch:
    names = ["kind", "shard", "data", "name", "n", "many", "t1", "t2", "t3", "t4", "total", "starts"]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.string(), *[pa.int64()] * 8]
    return pa.Table.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in zip(names, kinds)], names=names)


def _of_counts(count: np.ndarray) -> dict:
    return {f"t{k}": int((count == k).sum()) for k in range(1, 5)}


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count and store a model of all given texts."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{text}`").alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    word_shards = max(1, shards // 8)
    folder = scratch_path(spark, "ngrams")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            u, v = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            key, u, v, c = _counted(u, v, np.ones(len(u), np.uint64))
            cuts = np.searchsorted(shard_of(key, 64, shards), np.arange(shards + 1))
            for shard, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    order = np.argsort(u[a:b], kind="stable")
                    data = squeeze([u[a:b][order], v[a:b][order], c[a:b][order]])
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([data], pa.binary())], names=["shard", "data"])

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                for block in blocks(batch.column(0).slice(start, 512).to_pylist(), BLOCK_BYTES):
                    held.append(tokens(block)[1:])
                    n += len(held[-1][0])
                    if n >= FLUSH_PAIRS:
                        yield from flush()
                        held, n = [], 0
        if held:
            yield from flush()

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        held = [unsqueeze(x.as_py(), 3) for x in table.column("data")]
        key, u, v, c = _counted(*(np.concatenate([h[k] for h in held]) for k in range(3)))
        del held
        body = key & ~np.uint64(255)
        large = c >= _MANY
        name = _put(folder, f"pairs-{shard:06d}", [body | np.minimum(c, np.uint64(_MANY)), body[large], c[large]])
        rows = [{"kind": 0, "shard": shard, "name": name, "n": len(key), "many": int(large.sum()), "starts": int(c[u == START].sum()), **_of_counts(c)}]
        one = np.uint64(1)
        for kind, columns in (
            (1, _sum_by(u, c, (c == one).astype(np.uint64), (c == 2).astype(np.uint64), (c > 2).astype(np.uint64))),
            (2, _sum_by(v, np.ones(len(v), np.uint64))),
        ):
            cuts = np.searchsorted(shard_of(columns[0], _WORD_BITS, word_shards), np.arange(word_shards + 1))
            rows += [{"kind": kind, "shard": k, "data": squeeze([x[a:b] for x in columns])} for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        return _rows(rows)

    def words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        by_kind = {1: [], 2: []}
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data")):
            by_kind[kind].append(unsqueeze(data.as_py(), 5 if kind == 1 else 2))
        none = np.zeros(0, np.uint64)
        left = _sum_by(*(np.concatenate([none, *(h[k] for h in by_kind[1])]) for k in range(5)))
        right = _sum_by(*(np.concatenate([none, *(h[k] for h in by_kind[2])]) for k in range(2)))
        every = np.union1d(left[0], right[0])
        out = np.zeros((6, len(every)), np.uint64)
        out[0] = every
        out[1:5, np.searchsorted(every, left[0])] = left[1:]
        out[5, np.searchsorted(every, right[0])] = right[1]
        name = _put(folder, f"words-{shard:06d}", list(out))
        real = left[0] != START
        return _rows([{"kind": 3, "shard": shard, "name": name, "n": len(every), "many": int(real.sum()), "total": int(left[1][real].sum()), **_of_counts(right[1])}])

    runs = docs.mapInArrow(count, "shard int, data binary")
    parts = stored(runs.groupBy("shard").applyInArrow(merge, _PART), "pair-index")
    table = stored(parts.where("kind IN (1, 2)").groupBy("shard").applyInArrow(words, _PART), "word-index")
    pair_rows = parts.where("kind = 0").drop("data").collect()   # one small row a shard
    word_rows = table.drop("data").collect()
    pair_files, word_files = [("", 0, 0)] * shards, [("", 0)] * word_shards
    for r in pair_rows:
        pair_files[r["shard"]] = (r["name"], r["n"], r["many"])
    for r in word_rows:
        word_files[r["shard"]] = (r["name"], r["n"])
    total = lambda rows, k: sum(r[k] or 0 for r in rows)
    texts, pairs = total(pair_rows, "starts"), total(pair_rows, "n")
    cut = Discounts.of([total(pair_rows, f"t{k}") for k in range(1, 5)])
    t = [total(word_rows, f"t{k}") for k in range(1, 5)]
    below = Discounts.of(t)
    seen = total(word_rows, "many") + (1 if texts else 0)
    taken = below.cut[0] * t[0] + below.cut[1] * t[1] + below.cut[2] * (seen - t[0] - t[1])
    return Model(folder, pair_files, word_files, texts, total(word_rows, "total") + texts, seen, pairs, cut, below, taken / pairs if pairs else 1.0)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents' columns but the text, with n_tokens, n_known, base_score and score (log10)."""
    made = ("n_tokens", "n_known", "base_score", "score")
    rest = [c for c in docs.columns if c != text and c not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.attach()
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    found = [np.concatenate(x) for x in zip(*(model.score(b) for b in blocks(part.column(0).to_pylist(), BLOCK_BYTES)))]
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(i + 1) for i in range(len(rest))), *(pa.array(x) for x in found)], names=[*rest, *made])
        finally:
            model.detach()

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest]
    schema = ", ".join([*fields, "n_tokens bigint, n_known bigint, base_score double, score double"])
    return docs.select(F.col(f"`{text}`"), *[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def learned(key: str = "doc_id", parts: int = 7, held: int = 2) -> Column:
    """Rows to learn from: CRC-32 of the key as text leaves another remainder. A null key is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")), F.lit(parts)) != held, F.lit(True))
