"""Cut texts at spaces where no pre-token of a byte-level tokenizer can cross.

A space whose neighbours are both no white space always starts a new match of
the pattern, and nothing before it can reach over it. The pieces between such
spaces repeat often (mostly they are words), so their ids can be remembered.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_BESIDE_BLANK = re.compile(r" \s|\s ")
_SAFE_SPACE = re.compile(r"(?<!\s) (?!\s)")
LONGEST_KEPT = 48


def segments(text: str) -> list[str]:
    parts = _SAFE_SPACE.split(text) if _BESIDE_BLANK.search(text) else text.split(" ")
    out = [" " + p for p in parts]
    out[0] = parts[0]
    return out


class SegmentMemory(dict):
    """Remembers the packed ids of short segments, in two generations: when the
    young one is full it becomes the old one, and the former old one goes."""

    def __init__(self, encode: Callable[[str], bytes], most: int = 200_000):
        super().__init__()
        self.encode, self.most, self.old = encode, most, {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.old.get(segment)
        if ids is None:
            ids = self.encode(segment)
        if len(segment) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[segment] = ids
        return ids

    def pack(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, segments(text)))
