"""Byte-level BPE by a transducer that is determinised as texts ask for it.

Merges by rank have one valid result for each text, and a token sequence is
that result exactly when each neighbouring pair is the encoding of its own
bytes. So the automaton keeps, for the bytes read so far, every place where a
longer token may still begin, with the token that ends just before it. One more
byte extends these places and yields the token that ends at it. Tokens that all
open places share are emitted; the look-ahead is bounded by the longest token.
States and transitions are built when first needed and kept in a table.

Decoding looks up bytes and hands out whole characters only, holding back the
one to three bytes of an unfinished UTF-8 sequence until the rest arrives.

Nulls are empty texts. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cohortline.llm.common import in_batches
from cohortline.llm.segments import SegmentMemory


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merge_by_rank(data: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[bytes]:
    """Plain merging, used to judge single tokens and pairs of tokens."""
    parts = [data[i:i + 1] for i in range(len(data))]
    top = len(ranks) + 1 if below is None else below
    while len(parts) > 1:
        best, at = top, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1], top)
            if rank < best:
                best, at = rank, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Bytes in, token ids out; one state table for all inputs."""

    START = 0

    def __init__(self, ranks: dict[bytes, int], most_states: int = 160_000):
        self.ranks, self.most_states = ranks, most_states
        self.token = {rank: data for data, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for data, rank in ranks.items():
            node = 0
            for byte in data:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = self.children[node][byte]
            self.ends[node] = rank
        self.alone: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.hopes: dict[tuple[int, int], bool] = {}
        self.width = {rank: len(data) for data, rank in ranks.items()}
        self.window = 4 * max(self.width.values(), default=1)
        self.below = self._small_branches(16)
        self.never = max(ranks.values(), default=0) + 1
        self.parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.edges: dict[bool, dict[int, list[tuple[bytes, int]]]] = {False: {}, True: {}}
        self._reset()

    def _small_branches(self, most: int) -> list[list[int] | None]:
        """The tokens below each trie node, or none where there are more than ``most``."""
        below: list[list[int] | None] = [[] for _ in self.children]
        self.depth = [0] * len(self.children)
        for node in range(len(self.children)):  # children have larger numbers
            for child in self.children[node].values():
                self.depth[child] = self.depth[node] + 1
        for node in range(len(self.children) - 1, -1, -1):
            for child in self.children[node].values():
                own, more = below[node], below[child]
                if own is not None and more is not None:
                    own = own + more + ([self.ends[child]] if self.ends[child] >= 0 else [])
                below[node] = own if own is not None and more is not None and len(own) <= most else None
        return below

    def _reset(self) -> None:
        start = ((0, -1),)
        self.states, self.ids, self.moves = [start], {start: 0}, [{}]

    def reachable(self, token: int) -> bool:
        if token not in self.alone:
            self.alone[token] = len(merge_by_rank(self.token[token], self.ranks)) == 1
        return self.alone[token]

    def halves(self, data: bytes) -> tuple[bytes, bytes] | None:
        """The two parts from which merging makes this token."""
        if data not in self.parts:
            parts = merge_by_rank(data, self.ranks, self.ranks[data]) if len(data) > 1 else []
            self.parts[data] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.parts[data]

    def edge(self, token: int, right: bool) -> list[tuple[bytes, int]]:
        """What stands at a token's edge while it is merged: from a byte to the
        whole, each with the rank of the merge that ends it."""
        found = self.edges[right].get(token)
        if found is None:
            data, ends, found = self.token[token], self.never, []
            while True:
                found.append((data, ends))
                parts = self.halves(data)
                if parts is None:
                    break
                ends, data = self.ranks[data], parts[right]
            found.reverse()
            self.edges[right][token] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between two tokens: at each moment
        the crossing pair would have to come after the next merge beside it."""
        found = self.pairs.get((left, right))
        if found is None:
            a, b, i, j = self.edge(left, True), self.edge(right, False), 0, 0
            while True:
                (x, x_ends), (y, y_ends) = a[i], b[j]
                crossing = self.ranks.get(x + y, self.never)
                if crossing < x_ends and crossing <= y_ends and crossing < self.never:
                    found = False
                    break
                if x_ends == y_ends == self.never:
                    found = True
                    break
                if x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) > 3 * self.most_states:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def hopeful(self, left: int, node: int) -> bool:
        """Whether a token below this trie node may follow ``left``. Only small
        branches are looked through; large ones count as hopeful."""
        below = self.below[node]
        if below is None:
            return True
        found = self.hopes.get((left, node))
        if found is None:
            found = any(self.reachable(token) and (left < 0 or self.fits(left, token)) for token in below)
            if len(self.hopes) > 2 * self.most_states:
                self.hopes.clear()
            self.hopes[left, node] = found
        return found

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """Build one transition: the next state, and the token that ends here."""
        alive, ending = [], -1
        for node, left in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.ends[child]
            if ending < 0 <= token and self.reachable(token) and (left < 0 or self.fits(left, token)):
                ending = token
            if self.children[child] and self.hopeful(left, child):
                alive.append((child, left))
        if ending < 0:
            raise ValueError(f"no token of the vocabulary covers byte {byte}")
        alive.append((0, ending))
        key = tuple(alive)
        target = self.ids.get(key)
        if target is None:
            target = self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        self.moves[state][byte] = target, ending
        return target, ending

    def _sure(self, state: int, ends: list[int]) -> int:
        """How many leading bytes of the pending ones have tokens that no further byte can change."""
        places = sorted(len(ends) - self.depth[node] for node, _ in self.states[state])
        chains = []
        for place in places:
            cuts = {0}
            while place > 0:
                cuts.add(place)
                place -= len(self.token[ends[place - 1]])
            chains.append(cuts)
        return max(set.intersection(*chains))

    def _walk_back(self, ends: list[int], upto: int) -> list[int]:
        out = []
        while upto > 0:
            out.append(ends[upto - 1])
            upto -= self.width[ends[upto - 1]]
        out.reverse()
        return out

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(self.states) > self.most_states:
            self._reset()
        state, out, ends, moves = self.START, [], [], self.moves
        for byte in data:
            step = moves[state].get(byte)
            state, token = step if step is not None else self._move(state, byte)
            ends.append(token)
            if len(ends) >= self.window:
                sure = self._sure(state, ends)
                out += self._walk_back(ends, sure)
                del ends[:sure]
        return out + self._walk_back(ends, len(ends))


class Decoder:
    """Bytes of tokens in, whole characters out."""

    def __init__(self, token: dict[int, bytes]):
        self.token, self.held = token, b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end belong to a character that is not complete."""
        for back in range(1, min(4, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            return back if need > back else 0
        return 0

    def feed(self, ids: Iterable[int]) -> bytes:
        data = self.held + b"".join(map(self.token.__getitem__, ids))
        cut = len(data) - self.unfinished(data)
        self.held = data[cut:]
        return data[:cut]

    def close(self) -> bytes:
        """The rest, as it is: bytes of a sequence that never ended."""
        rest, self.held = self.held, b""
        return rest


def decode_stream(token: dict[int, bytes], ids: np.ndarray, step: int = 8192) -> Iterator[bytes]:
    decoder = Decoder(token)
    for start in range(0, len(ids), step):
        yield decoder.feed(ids[start:start + step].tolist())
    yield decoder.close()


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    def __init__(self, path: str, pattern: str):
        self.transducer = Transducer(load_ranks(path))
        self.cut = regex.compile(pattern).findall
        self.memory = SegmentMemory(self._pack)

    def _pack(self, segment: str) -> bytes:
        ids: list[int] = []
        for piece in self.cut(segment):
            ids += self.transducer.encode(piece.encode("utf-8", "replace"))
        return pack_ids(ids)

    def pack(self, text: str | None) -> bytes:
        return self.memory.pack(text) if text else b""

    def unpack(self, ids: bytes | None) -> bytes:
        return b"".join(decode_stream(self.transducer.token, np.frombuffer(ids or b"", "<u4")))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One per Python worker, kept between tasks."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id", decoded: bool = False) -> DataFrame:
    """(key, ids): ids of each whole text as little-endian unsigned 32-bit integers.
    With ``decoded`` also data, what ``decode`` makes of the ids: one Python pass
    and one worker instead of two."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path, pattern)
        packed = [own.pack(x) for x in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array(packed, pa.binary())]
        if decoded:
            columns.append(pa.array([own.unpack(x) for x in packed], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=[key, "ids", "data"][: len(columns)])

    schema = f"`{key}` {kind}, ids binary" + (", data binary" if decoded else "")
    return in_batches(docs.select(docs[key], docs[text]), schema, work, 128)


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, data): the bytes that the ids stand for, beside the ids. Null ids are none."""
    kind = encoded.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path, pattern)
        data = pa.array([own.unpack(x) for x in batch.column(1).to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data], names=[key, "ids", "data"])

    return in_batches(encoded.select(encoded[key], encoded["ids"]), f"`{key}` {kind}, ids binary, data binary", work, 128)
