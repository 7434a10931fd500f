"""The source divergence audit against plain Python: nulls, ties, repeated rows, long texts, many sources, empty tables."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, n int, term string, value string"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, k):
    groups, docs, whole = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang, source].update(terms)
        docs[lang].update(set(terms))
        whole[lang].update(terms)
    out = []
    for (lang, source), n in groups.items():
        kept = sorted((t for t, d in docs[lang].items() if d >= 3), key=str.encode)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        p, q = share(n), share(whole[lang])
        f = lambda a, b: (a - b) ** 2 // b
        pairs = []
        for (other_lang, other), m in groups.items():
            if other_lang == lang and other != source:
                r = share(m)
                pairs.append((other, sum(f(p[t], r[t]) for t in kept)))
        terms = [(t, f(p[t], q[t])) for t in kept if n[t] and p[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, t, v, i) for i, (t, v) in enumerate(items, 1) if part == "pair" or i <= k]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)] + ["Été", "ÉTÉ", "éte", "漢字", "Zz", "zz", "\U0001f600x"]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = []
    for i in range(240):
        source = rng.choice(["hot"] * 6 + [f"s{j}" for j in range(7)] + ["", None])
        text = rng.choice([" ", "-", "_", "7"]).join(rng.choices(words, weights, k=rng.randrange(40)))
        out.append((i, text, rng.choice(["en", "en", "de", None]), source, 0, "x", "y"))
    out += [(None, None, "en", "null text", 0, None, None), (1, "", "fr", "a", 0, None, None), (2, "1 2 3", "fr", "b", 0, None, None)]
    out += [(3, "only twice", "it", "a", 0, None, None)] * 2 + [(4, " ".join(words) * 3000, "en", "long", 0, None, None)] + [out[5]] * 4
    return out


@pytest.mark.parametrize("k", [200, 5])
def test_equals_plain_python(spark, rows, k):
    found = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(6), k=k)
    assert sorted(map(tuple, found.collect())) == expected(rows, k)


def test_distances_in_small_tiles_and_chunks(spark, rows):
    kept, groups = divergence.counts(spark.createDataFrame(rows, SCHEMA))
    found = divergence.distances(kept, groups, chunk=7, tile=2).select("lang", "source", F.lit("pair"), "item", "value", "rank")
    assert sorted(map(tuple, found.collect())) == [r for r in expected(rows, 1) if r[2] == "pair"]


def test_skyband_keeps_what_fewer_than_k_dominate(spark):
    rng = random.Random(8)
    rows = [("en", "s", rng.randrange(1, 9), rng.randrange(1, 60), f"t{i:04d}", i) for i in range(2500)]
    k = 12
    df = spark.createDataFrame(rows, "lang string, source string, n long, whole long, term string, value long").repartition(5)
    kept = {r["term"] for r in divergence.skyband(df, k).collect()}
    n, whole, term = np.array([r[2] for r in rows]), np.array([r[3] for r in rows]), np.arange(len(rows))
    beaten = sum(((n[None, a:a + 100] >= n[:, None]) & (whole[None, a:a + 100] <= whole[:, None]) & (term[None, a:a + 100] < term[:, None])).sum(1)
                 for a in range(0, len(rows), 100))
    assert kept == {rows[i][4] for i in np.flatnonzero(beaten < k)} and len(kept) < 1500


def test_shares_of_great_counts_do_not_overflow(spark):
    row = spark.sql("SELECT 5000000000000L AS n, 9000000000000L AS total, 40L AS size").select(divergence.share("n", "total")).first()[0]
    assert row == 1 + 10**9 * (5 * 10**12 + 1) // (9 * 10**12 + 40)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
