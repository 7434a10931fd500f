"""Pack documents into token sequences by the sum-of-squares rule.

A document is its token ids and one end token. Longer ones than a sequence are
cut so that only the first piece is shorter; full pieces fill a sequence each.
The rest is bin packing: a piece goes where the sum over all gaps of (number
of open sequences with this gap) squared becomes smallest. A choice depends on
the piece's length only, so only lengths are looked at and no text
need be moved. Shards of bounded size pack their own pieces: long ones come
first, in coarse steps, and the shortest tenth last, longest first, to close
what is open. Measured, a shard then ends within a sequence or two of the lower
bound, so more shards cost one sequence in ten thousand.

Null text: a document of the end token alone. Repeated ids: each row is packed
as a document of its own.
"""

from __future__ import annotations

import json
import os
import struct
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import in_batches
from cohortline.llm.segments import SegmentMemory

SEQUENCE = 2048
SHARD_PIECES = 30_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use, by their rule:
    printable bytes stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Ids by the vocabulary file. Segments not seen yet are merged by rank where
    the file's merges are in the order of their ids (the same result in a
    third of the time), else by the tokenizer itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.ranked = self._by_rank(path)
        self.memory = SegmentMemory(self.pack)

    @staticmethod
    def _by_rank(path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, before = data["model"], data.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
        made = [model["vocab"].get(m.replace(" ", "")) for m in merges]
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if not plain or data.get("normalizer") or None in made or any(a >= b for a, b in zip(made, made[1:])):
            return None
        import public_tokenizers
        import tiktoken

        alphabet, special = byte_alphabet(), {t["content"] for t in data.get("added_tokens", [])}
        ranks = {bytes(alphabet[c] for c in token): rank for token, rank in model["vocab"].items() if token not in special}
        return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def pack(self, text: str) -> bytes:
        if self.ranked is not None:
            ids = self.ranked.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def documents(self, texts: list[str | None]) -> list[bytes]:
        return [(self.memory.pack(t) if t else b"") + b"\0\0\0\0" for t in texts]


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def tokenize(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", most: int = SEQUENCE) -> DataFrame:
    """(key, piece, start, length, ids): pieces of each document, ids as little-endian 32-bit integers."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, piece, start, length, ids = [], [], [], [], []
        for row, packed in enumerate(tokens(path).documents(batch.column(1).to_pylist())):
            total = len(packed) // 4
            first = total % most or most
            cuts = [0, *range(first, total + 1, most)]
            for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                owner.append(row)
                piece.append(number)
                start.append(a)
                length.append(b - a)
                ids.append(packed[4 * a:4 * b])
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=[key, "piece", "start", "length", "ids"])

    return in_batches(docs.select(docs[key], docs[text]), f"`{key}` {kind}, piece int, start bigint, length bigint, ids binary", work, 256)


class OpenSequences:
    """Open sequences by gap, and the rule for the next piece."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece."""
        count, size = self.count, self.size
        # Filling gap g turns it into g - length: the squares change by
        # 2 (count[g - length] - count[g]) + 2, or by 1 - 2 count[g] if nothing stays open.
        gaps = count[length:]
        change = np.where(gaps > 0, 2 * (count[:size + 1 - length] - gaps) + 2, np.iinfo(np.int64).max)
        if gaps[0]:
            change[0] = 1 - 2 * gaps[0]
        best = int(change.argmin()) if len(change) else 0
        fresh = 2 * int(count[size - length]) + 1 if length < size else 0
        if len(change) and change[best] <= fresh:
            gap = best + length
            number = self.open[gap].pop()
            count[gap] -= 1
        else:
            gap, number = size, self.made
            self.made += 1
        if gap > length:
            count[gap - length] += 1
            self.open[gap - length].append(number)
        return number, size - gap


def order_of(lengths: np.ndarray, step: int = 256, last: float = 0.1) -> np.ndarray:
    """Long pieces first in coarse steps; the shortest part last, longest first."""
    if not len(lengths):
        return np.arange(0)
    short = lengths <= np.quantile(lengths, last)
    rank = np.where(short, lengths, (lengths // step + 1) * step + lengths.max())
    return np.argsort(-rank, kind="stable")


def sum_of_squares(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; pieces that fill a sequence get their own."""
    bins, order = OpenSequences(size), order_of(lengths)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for row in order:
        number[row], offset[row] = bins.place(int(lengths[row]))
    return number, offset


def pack(pieces: DataFrame, key: str = "doc_id", size: int = SEQUENCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The given rows with sequence_id and offset; other columns come along.

    ``pieces`` is read twice (a count, then the packing): hand in stored rows.
    """
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.col(f"`{key}`"), F.col("piece"), F.col("start"), F.lit("shard")), F.lit(shards)))

    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([key, "piece"], kind="stable")
        number, offset = sum_of_squares(group["length"].to_numpy(), size)
        return group.assign(sequence_id=(group["shard"].to_numpy() << 32) + number, offset=offset).drop(columns="shard")

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return dealt.groupBy("shard").applyInPandas(work, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences themselves, from packed rows that kept their ids."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda whole, part: F.concat(whole, part))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
