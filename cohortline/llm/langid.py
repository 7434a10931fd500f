"""Language identification with a string kernel.

The kernel counts the n-grams of letters (one to three, blended) that two texts
both contain, over a dictionary, divided by the root of both counts. A bounded
sample of labelled rows (SAMPLE_ROWS in all, shared evenly by the labels; more
labels than that: the most frequent) gives the dictionary, landmark texts and the
training set. A sampled text above SAMPLE_CHARS gives an excerpt at a place drawn
by hash. Nystroem features of the landmarks feed one ridge regression for each
language against the rest. All texts are then scored in batches: presence
matrix times landmark matrix times coefficients.

A text without a letter (or null) is ``und`` with score 0. Letters are lower-cased,
everything between them counts as one blank. Whole texts are read. Without any
labelled row every text is ``und``. Ties go to the language that sorts first.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.common import aside, in_batches

UNKNOWN = "und"
SAMPLE_ROWS = 2_000       # bound of the training sample over all languages
SAMPLE_CHARS = 20_000     # of longer texts the sample takes an excerpt of this length
DICTIONARY = 8_192
LANDMARKS = 128
LONGEST = 3
RIDGE = 1e-2
_SLOTS = 20

_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letter


def grams(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Owner of each position, and for n = 1.. the packed n-gram that begins there (0: none)."""
    points = np.frombuffer("\0".join(t.lower() for t in texts).encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    owner = np.cumsum(points == 0)
    letter = _letters()[points]
    points = np.where(letter, points, np.where(points == 0, 0, 32))
    keep = letter.copy()
    keep[1:] |= (points[1:] == 0) | letter[:-1]  # of a run between letters the first stays
    keep[:1] |= points[:1] == 0
    points, owner = points[keep], owner[keep]
    out = [np.where(points > 32, points, 0)]
    for n in range(2, LONGEST + 1):
        code, whole = points.copy(), points > 0
        for k in range(1, n):
            code[: len(code) - k] = (code[: len(code) - k] << 21) | points[k:]
            whole[: len(code) - k] &= points[k:] > 0
            whole[len(code) - k:] = False
        out.append(np.where(whole, code, 0))
    return owner, out


def _slot(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray      # the dictionary's n-grams
    slots: np.ndarray      # slot -> place in the dictionary, or -1
    landmarks: np.ndarray  # (n-grams, landmarks), columns scaled by the root of their counts
    weights: np.ndarray    # (landmarks, languages)

    def presence(self, texts: list[str]) -> np.ndarray:
        found = np.zeros((len(texts), len(self.codes)), np.float32)
        owner, coded = grams(texts)
        for codes in coded:
            place = self.slots[_slot(codes)]
            hit = (place >= 0) & (codes > 0)
            place, code, row = place[hit], codes[hit], owner[hit]
            same = self.codes[place] == code
            found[row[same], place[same]] = 1
        return found

    def kernel(self, texts: list[str]) -> np.ndarray:
        found = self.presence(texts)
        return (found @ self.landmarks) / np.sqrt(np.maximum(found.sum(axis=1, keepdims=True), 1))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best language and its share, from 0 to 1."""
        margins = self.kernel(texts) @ self.weights
        shares = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)))
        shares /= shares.sum(axis=1, keepdims=True)
        best = margins.argmax(axis=1)
        return best, np.clip(shares[np.arange(len(texts)), best], 0, 1).astype(np.float64)


def _portions(texts: list[str], most: int = 500_000) -> list[list[str]]:
    """Texts in portions of bounded size."""
    out, size = [], most
    for text in texts:
        if size + len(text) > most:
            out.append([])
            size = 0
        out[-1].append(text)
        size += len(text)
    return out


def _dictionary(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for portion in _portions(texts):
        owner, coded = grams(portion)
        cuts = np.searchsorted(owner, np.arange(1, len(portion)))
        seen = [np.unique(part) for one in coded for part in np.split(one, cuts)]
        new, times = np.unique(np.concatenate(seen), return_counts=True)
        every = np.union1d(codes, new)
        total = np.zeros(len(every), np.int64)
        total[np.searchsorted(every, codes)] += count
        total[np.searchsorted(every, new)] += times
        codes, count = every, total
    codes, count = codes[codes > 0], count[codes > 0]
    order = np.lexsort((codes, -count))
    codes = codes[order][: 2 * DICTIONARY]
    slots = np.full(1 << _SLOTS, -1, np.int32)
    kept = []
    for code, slot in zip(codes, _slot(codes)):
        if slots[slot] < 0 and len(kept) < DICTIONARY:  # of n-grams that meet in a slot the more frequent stays
            slots[slot] = len(kept)
            kept.append(code)
    return np.array(kept, np.int64), slots


def fit(texts: list[str], labels: list[str]) -> Model | None:
    """Rows in a given order; landmarks are taken in turn from the languages."""
    languages = sorted(set(labels))
    if not languages:
        return None
    codes, slots = _dictionary(texts)
    model = Model(languages, codes, slots, np.zeros((len(codes), 1), np.float32), np.zeros((1, len(languages))))
    found = np.concatenate([model.presence(p) for p in _portions(texts)])
    target = np.array([languages.index(x) for x in labels])
    place = np.zeros(len(texts), np.int64)
    for k in range(len(languages)):
        own = np.flatnonzero(target == k)
        place[own] = np.arange(len(own))
    chosen = np.lexsort((target, place))[: min(LANDMARKS, len(texts))]
    scale = lambda m: np.sqrt(np.maximum(m.sum(axis=1), 1))
    model.landmarks = np.ascontiguousarray((found[chosen] / scale(found[chosen])[:, None]).T)
    between = ((found[chosen] @ model.landmarks) / scale(found[chosen])[:, None]).astype(np.float64)
    values, vectors = np.linalg.eigh(between)
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = ((found @ model.landmarks) / scale(found)[:, None]) @ root
    balance = 1 / np.bincount(target, minlength=len(languages))[target]
    sides = np.where(target[:, None] == np.arange(len(languages)), 1.0, -1.0)
    gram = features.T @ (features * balance[:, None]) + RIDGE * balance.sum() / len(texts) * np.eye(features.shape[1])
    model.weights = (root @ np.linalg.solve(gram, features.T @ (sides * balance[:, None]))).astype(np.float32)
    return model


def sample(docs: DataFrame, learn: Column, text: str, lang: str, key: str) -> tuple[list[str], list[str]]:
    """Bounded sample of labelled rows, equal for all languages where they have enough, by hash of the key."""
    whole = F.col(f"`{text}`")
    rows = docs.where(learn & whole.rlike(r"\p{L}")).select(
        whole.alias("t"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{key}`").cast("string").alias("key")).where("lang IS NOT NULL")
    labels = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE_ROWS).collect()
    if not labels:
        return [], []
    each = SAMPLE_ROWS // len(labels)
    # Twice the share is wanted, so that enough rows remain to be ranked.
    limits = [(r["lang"], int(min(1.0, 2 * each / r["count"] + 1e-4) * (1 << 30))) for r in labels]
    most = docs.sparkSession.createDataFrame(limits, "lang string, most bigint")
    few = rows.withColumn("draw", F.pmod(F.xxhash64("key", F.lit("language")), F.lit(1 << 30)))
    few = few.join(F.broadcast(most), "lang").where("draw < most")  # at most SAMPLE_ROWS labels
    room = F.greatest(F.length("t") - SAMPLE_CHARS, F.lit(0)) + 1
    excerpt = F.substring(F.col("t"), 1 + F.pmod(F.xxhash64("key", F.lit("excerpt")), room).cast("int"), F.lit(SAMPLE_CHARS))
    order = Window.partitionBy("lang").orderBy("draw", "t")
    ranked = few.select("lang", "draw", excerpt.alias("t")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    ranked = ranked.orderBy("place", "lang").collect()
    return [r["t"] for r in ranked], [r["lang"] for r in ranked]


def identify(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", keep_text: bool = False) -> DataFrame:
    """The documents' columns (the text only on demand) with lang_pred and score.
    ``learn`` says which rows may be learned from."""
    model = fit(*sample(docs, learn, text, lang, key))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the constants above
    rest = [c for c in docs.columns if c not in ("lang_pred", "score") and (keep_text or c != text)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(0).to_pylist()
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        block, size = [], 0

        def flush():
            best, share = shared.value.score([texts[i] for i in block])
            for i, k, s in zip(block, best, share):
                labels[i], scores[i] = shared.value.languages[k], float(s)

        for i, t in enumerate(texts):
            if t and shared.value is not None and (t.isalpha() or any(map(str.isalpha, t))):
                if block and size + len(t) > 1_000_000:
                    flush()
                    block, size = [], 0
                block.append(i)
                size += len(t)
        if block:
            flush()
        return pa.RecordBatch.from_arrays(
            [*(batch.column(i + 1) for i in range(len(rest))), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[*rest, "lang_pred", "score"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest]
    return in_batches(docs.select(F.col(f"`{text}`").alias("_read"), *[F.col(f"`{c}`") for c in rest]), ", ".join([*fields, "lang_pred string, score double"]), work, 256)


def known_language(docs: DataFrame, learn: Column, least: float = 0.3, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """The documents in a learned language, with the columns they had."""
    own, back = aside(docs, "lang_pred", "score")
    found = identify(own, learn, text, lang, key, keep_text=True)
    return back(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)))
