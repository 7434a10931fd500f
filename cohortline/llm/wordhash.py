"""Hash all words of a batch of texts at once, with numpy.

Words are runs of bytes other than the six blanks. A word's hash is a
polynomial over its bytes modulo 2**64, taken from running sums over the whole
batch and mixed at the end; it depends on the word alone, on any machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finishing steps of a common 64-bit hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def _power(n: int, back: bool) -> np.ndarray:
    sign = -1 if back else 1
    if len(_powers[sign]) < n:
        with np.errstate(over="ignore"):
            _powers[sign] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n + n // 4, _BACK if back else _ODD)]), dtype=np.uint64)
    return _powers[sign][:n]


@dataclass
class Words:
    """Hashes of all words in text order; words of text i are hashes[starts[i]:starts[i + 1]]."""

    hashes: np.ndarray
    starts: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def hash_words(texts: list[bytes], lower: bool = True) -> Words:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends_of_text = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) if texts else np.zeros(0, np.int64)
    blank = _BLANK[data]
    edge = np.diff(blank.view(np.int8), prepend=np.int8(1))
    first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    with np.errstate(over="ignore"):
        value = _BYTE[_LOWER[data] if lower else data] * _power(len(data), False)
        value[blank] = 0
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        hashes = mix((total[end] - total[first]) * _power(len(data), True)[first] + (end - first).astype(np.uint64))
    starts = np.concatenate([np.zeros(1, np.int64), np.searchsorted(first, ends_of_text)])
    return Words(hashes, starts)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of each text's shingles; a text with fewer words has one of all its words."""
    h, starts = words.hashes, words.starts
    counts = np.diff(starts)
    with np.errstate(over="ignore"):
        factor = np.cumprod(np.full(width + 1, np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64)
        sums = np.zeros(max(len(h) - width + 1, 0), np.uint64)
        for k in range(width):
            sums += h[k:len(h) - width + 1 + k] * factor[k]
        full = mix(sums)
        owner = words.owner
        same = owner[: len(sums)] == owner[width - 1:] if len(sums) else np.zeros(0, bool)
        owners, values = [owner[: len(sums)][same]], [full[same]]
        for text in np.flatnonzero((counts > 0) & (counts < width)):
            own = h[starts[text]:starts[text + 1]]
            owners.append(np.array([text]))
            values.append(mix(np.array([(own * factor[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))], np.uint64)))
    return np.concatenate(owners), np.concatenate(values)


def rolling(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """The hash of each run of ``width`` neighbouring hashes; another seed gives an independent hash."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        own = mix(hashes + np.uint64(seed)) if seed else hashes
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * _power(len(own), False), dtype=np.uint64)])
        return mix((total[width:] - total[:n]) * _power(n, True))


def shingle_sets(texts: list[str | None], width: int = 5, most_bytes: int = 4_000_000) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; null has none."""
    for block in blocks(texts, most_bytes):
        owner, value = shingles(hash_words(block), width)
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        fresh = np.ones(len(value), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        owner, value = owner[fresh], value[fresh]
        yield from np.split(value, np.searchsorted(owner, np.arange(1, len(block))))[: len(block)]


def blocks(texts: list[str | None], most_bytes: int) -> Iterator[list[bytes]]:
    block, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "replace") if text else b""
        if block and size + len(data) > most_bytes:
            yield block
            block, size = [], 0
        block.append(data)
        size += len(data) + 1
    if block:
        yield block
