"""Rows that the line dedup makes for groups of lines that share a key and are not near."""

from __future__ import annotations

import random

import pytest

from cohortline.llm import linededup


@pytest.mark.parametrize("size", [240])
def test_rows_of_a_group_do_not_grow_with_its_pairs(spark, monkeypatch, size):
    """Lines with the same head and the same signs in other orders pass every count of signs and are still far apart."""
    draw = random.Random(size)
    signs = list("abcdefghijklmnopqrstuvwxyz0123456789ABCD")
    texts = []
    for _ in range(size):
        draw.shuffle(signs)
        texts.append("the same head of every line it is " + "".join(signs))
    near = texts[0][:-1] + "#"
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, near])], "doc_id long, text string")
    made, stored = [], linededup.stored

    def counted(df, name):
        out = stored(df, name)
        if name == "line-candidates":  # one for each turn
            made.append(out.count())
        return out

    monkeypatch.setattr(linededup, "stored", counted)
    kept = linededup.dedup(docs, per=20)
    dropped = [r["doc_id"] for r in kept.where("n_dropped > 0").collect()]
    assert dropped == [size]
    assert made and max(made) <= 3 * size


def test_chains_of_near_lines_take_two_turns(spark, monkeypatch):
    """Lines that differ in their own places are chained by others; each tile joins what it can at once."""
    draw = random.Random(5)
    texts = []
    for _ in range(8):
        line = "".join(draw.choice("abcdefgh ") for _ in range(60)).strip().ljust(50, "z")
        for _ in range(40):
            signs = list(line)
            for _ in range(draw.randrange(1, 5)):
                signs[draw.randrange(len(signs))] = draw.choice("XY")
            texts.append("".join(signs))
    texts = sorted(set(texts))
    draw.shuffle(texts)
    root = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j in range(i):
            if len(a) == len(texts[j]) and linededup.within([(a, texts[j])], 2)[0] and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    turns, stored = [], linededup.stored

    def counted(df, name):
        turns.append(name)
        return stored(df, name)

    monkeypatch.setattr(linededup, "stored", counted)
    kept = linededup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.where("n_dropped = 0").collect()} == {root.index(r) for r in root}
    assert turns.count("line-candidates") <= 2
