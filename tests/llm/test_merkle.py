"""The Merkle manifest against plain Python: several tiers, nulls, repeated rows, ties, clashing names, empty tables."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortline.llm import merkle

FIELDS = ["doc_id", "source", "text"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """The last node, and for each leaf its siblings, left to right and level by level."""
    proofs, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            run = at // 16 * 16
            proofs[i] += [*nodes[run:at], *nodes[at + 1:run + 16]]
        nodes = [sha("".join(nodes[k:k + 16])) for k in range(0, len(nodes), 16)]
        places = [at // 16 for at in places]
    return nodes[0], proofs


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(((row[0] is not None, row[0] or 0), leaf_of(*row), row))
    tops = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        members = sorted(groups[source], key=lambda m: m[:2])
        subroot, proofs = tree([m[1] for m in members])
        tops.append((subroot, members, proofs))
    root, above = tree([t[0] for t in tops])
    return sorted(
        (str(row[0]), leaf, subroot, root, sha("".join(own + upper)))
        for (subroot, members, proofs), upper in zip(tops, above) for (_, leaf, row), own in zip(members, proofs))


def built(df):
    return merkle.build(df, [F.col(c) for c in FIELDS], F.col("doc_id"), F.col("source"), {"doc_id": F.col("doc_id")}).proofs()


def compare(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(7)
    found = built(df.withColumns({c: F.lit("x") for c in ("g", "pos", "node", "own", "path", "leaf", "root")}))
    got = found.select(F.col("own.doc_id").cast("string"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path"))).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == expected(rows)
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    altered = merkle.fold(F.sha2(F.lit(b"other"), 256), F.col("path"))
    assert found.where(altered == F.col("root")).count() == 0


def test_trees_of_several_tiers(spark):
    """5,000 leaves need two tiers, 300 sources two tiers above them; sizes around runs and blocks."""
    rows = [(k * 3 % 5003, "hot", f"text {k}") for k in range(5000)]
    for name, size in (("one", 1), ("run", 16), ("over", 17), ("block", 256), ("more", 257)):
        rows += [(k, name, "é" * (k % 9)) for k in range(size)]
    rows += [(9, f"source {k}", "漢字") for k in range(300)]
    compare(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None), (None, None, "a"), (1, None, ""), (1, "", None), (1, "", None), (1, "", "b"), (None, "z", "-"), (2, "é", "x" * 300_000)]
    compare(spark, rows)
    compare(spark, rows[:1])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert built(empty).count() == 0


def test_fields_cannot_be_shifted_into_each_other(spark):
    rows = spark.createDataFrame([("a", "b1:c"), ("ab", "c"), (None, "-"), ("-", None)], "x string, y string")
    assert rows.select(merkle.leaf(F.col("x"), F.col("y")).alias("h")).distinct().count() == 4


@pytest.mark.parametrize("size", [2, 15, 16, 33])
def test_no_block_outgrows_its_bound(spark, size):
    df = spark.range(size * 300).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("t").alias("text"))
    manifest = merkle.build(df, [F.col("doc_id")], F.col("doc_id"), F.col("source"))
    widest = manifest.groups[0].agg(F.max(F.length("level0"))).first()[0]
    assert widest == min(size * 300, merkle.BLOCK) * merkle.WIDE
