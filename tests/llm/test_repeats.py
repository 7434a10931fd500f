"""Repeated word sequences against plain Python: overlaps, nulls, repeated rows, long and odd texts, empty tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.llm import repeats
from cohortline.llm.wordhash import hash_words, rolling

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(rows, width):
    words = [WORD.findall(text or "") for _, text in rows]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((str(key), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def texts(width: int) -> list[str | None]:
    rng = random.Random(width)
    word = lambda: rng.choice(["a", "B", "é", "漢字", " x", "y\x1fz", "don't", "--"]) + str(rng.randrange(4000))
    run = lambda n: [word() for _ in range(n)]
    out = [None, "", " \t\r\n\x0b\x0c", "one", " ".join(run(width - 1)), " ".join(run(width)), " ".join(run(width + 1))]
    shared = [run(n) for n in (width - 1, width, width + 1, 2 * width, 3 * width + 5)]
    for k in range(60):  # passages at all phases, of lengths around the window, with changed words and separators
        parts = run(rng.randrange(3 * width))
        for _ in range(rng.randrange(1, 4)):
            piece = list(rng.choice(shared))
            piece = piece[rng.randrange(3):len(piece) - rng.randrange(3)]
            if rng.random() < 0.3:
                piece[rng.randrange(len(piece))] = word()
            parts += piece + run(rng.randrange(40))
        out.append(rng.choice([" ", "\n", "  \t"]).join(parts))
    out += ["same " * (width + 1), "same " * (width - 1), "x y " * (2 * width)]  # overlaps in one document
    out += [" ".join(run(30_000)) + " " + " ".join(shared[4]), out[5], out[6], out[6], out[9]]
    out += [out[6].upper(), out[6].replace(" ", "\u00a0")]  # other case; a blank that is part of words
    return out


@pytest.mark.parametrize("width", [35, 8, 5])
def test_equals_plain_python(spark, width):
    rows = [(i, t) for i, t in enumerate(texts(width))]
    rows += [(None, rows[7][1]), rows[8], rows[8]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(11)
    df = df.withColumns({c: F.lit(1) for c in ("key", "batch", "n_words", "n_removed", "texts")})
    found = repeats.remove(df, width=width)
    assert found.columns == ["doc_id", "n_words", "n_removed", "text"]
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == expected(rows, width)


def test_a_passage_in_very_many_documents(spark):
    """Every batch sends a shared hash once: answers stay as many as batches and ranges."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(f"d{i}", " ".join(f"w{i}x{j}" for j in range(i % 50)) + " " + passage) for i in range(3000)]
    found = repeats.remove(spark.createDataFrame(rows, "doc_id string, text string"))
    assert found.where("n_removed != 60 OR n_words != n_removed + size(filter(split(text, ' '), x -> x != ''))").count() == 0
    assert found.count() == 3000 and found.where("doc_id = 'd7' AND text LIKE '%w7x6'").count() == 1


def test_empty_table(spark):
    assert repeats.remove(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_rolling_hashes_depend_on_the_words_alone():
    a = hash_words([b"q r s t u v w", b"s t u"], lower=False).hashes
    three = rolling(a, 3)
    assert three[2] == three[7] and len(set(three.tolist())) == 7 and rolling(a, 3, 9)[2] == rolling(a, 3, 9)[7] != three[2]
    assert len(rolling(a, 10)) == 1 and len(rolling(a, 11)) == 0


def test_batches_round_trip():
    data = [b"", "é".encode(), b"x" * 100_000]
    assert repeats._unpack(repeats._pack(data)) == data and repeats._unpack(repeats._pack([])) == []
    assert np.frombuffer(repeats._pack([]), np.uint8).size
