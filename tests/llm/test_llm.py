"""Training-data operators against plain Python, with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from cohortline.llm import bpe, hnsw, jaccard, langid, licenses, linededup, lm, packing, quality, warc
from cohortline.llm.components import components
from cohortline.llm.wordhash import shingle_sets
from cohortline.session import scratch_path

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id bigint, text string, lang string, source string, n_words int, score string"


def prose(rng: random.Random, n: int, vocabulary=("the", "of", "erinth", "onha", "blesh", "tion,", "reand", "wher.", "édoi")) -> str:
    return " ".join(rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    base = [prose(rng, n) for n in (0, 1, 3, 5, 40, 80, 200, 2500)]
    near = []
    for k in range(30):  # a group of near copies: each replaces some words of the same text
        words = base[6].split()
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
        near.append(" ".join(words))
    lines = ["A line that stands in many documents, again and again and again.", "Short line."]
    texts = [None, "", " \t\n", "!!! ???", *base, *base[3:6], *near]
    texts += ["\n".join([prose(rng, 12), lines[0], lines[1], prose(rng, 30)]) for _ in range(12)]
    texts += [lines[0][:20] + "x" + lines[0][20:] + "\n" + prose(rng, 60), lines[0].replace("many", "mony") + "\n" + lines[0]]
    texts += [f"{prose(rng, 60)}\nReleased under the MIT License.", f"{prose(rng, 20)}\nThe restaurant lost its liquor license.\n"]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), 7, "x") for i, t in enumerate(texts)]
    rows += [(None, base[5], "en", None, None, None), rows[20], rows[20]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
    return row[-1]


class Groups:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


# --- byte-level BPE -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_bpe_equals_library_and_round_trips(corpus, empty, encoding):
    rows = bpe.decode(bpe.encode(corpus, RANKS, PATTERN), RANKS, PATTERN).collect()
    want = Counter((i, struct.pack(f"<{len(e)}I", *e), (t or "").encode()) for i, t in texts_of(corpus) for e in [encoding.encode_ordinary(t or "")])
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["data"])) for r in rows) == want
    assert bpe.encode(empty, RANKS, PATTERN, decoded=True).count() == 0


def test_transducer_on_random_text(encoding):
    rng, codec = random.Random(1), bpe.codec(RANKS, PATTERN)
    alphabet = "abcdehinorst  \n\t'sABÉé漢字😀0123!?.,-_=  \x1c<|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(90))) for _ in range(1500)]
    for text in [*texts, "a" * 3000, " " * 2000, "=-" * 900, "\n" * 60 + " x", "<|endoftext|>"]:
        assert np.frombuffer(codec.pack(text), "<u4").tolist() == encoding.encode_ordinary(text)


def test_transducer_with_a_tiny_table(encoding):
    small = bpe.Transducer(bpe.load_ranks(RANKS), most_states=3)
    for word in [" tokenization", "antidisestablishmentarianism", "  x", "a" * 600]:
        want = tiktoken.Encoding("one", pat_str=r"[\s\S]+", mergeable_ranks=small.ranks, special_tokens={}).encode_ordinary(word)
        assert small.encode(word.encode()) == want


def test_decoder_hands_out_whole_characters():
    data = "aé漢😀z".encode()
    for cuts in itertools.combinations(range(1, len(data)), 3):
        parts = [data[a:b] for a, b in zip((0, *cuts), (*cuts, len(data)))]
        decoder = bpe.Decoder(dict(enumerate(parts)))
        out = [decoder.feed([k]) for k in range(len(parts))]
        assert all(o.decode() is not None for o in out) and b"".join(out) + decoder.close() == data
    broken = bpe.Decoder({0: b"a\xe6\xbc"})
    assert broken.feed([0]) == b"a" and broken.close() == b"\xe6\xbc"


# --- packing ------------------------------------------------------------------------------------

def check_packing(rows, size):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def test_packing_keeps_every_token(corpus, empty, encoding):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.tokenize(corpus, path, most=256).cache()
    packed = packing.pack(pieces, size=256, shard_pieces=40).collect()
    assert check_packing(packed, 256) <= 1.1 * sum(r["length"] for r in packed) / 256 + 3
    want = Counter()
    for i, t in texts_of(corpus):
        ids = encoding.encode_ordinary(t or "") + [0]
        cuts = [0, *range(len(ids) % 256 or 256, len(ids) + 1, 256)]
        want.update((i, k, a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], zlib.crc32(r["ids"])) for r in packed) == want
    whole = packing.assemble(packing.pack(pieces, size=256))
    assert whole.agg(F.sum("n_tokens")).first()[0] == sum(r["length"] for r in packed)
    assert whole.where(F.octet_length("ids") != 4 * F.col("n_tokens")).count() == 0
    assert packing.pack(packing.tokenize(empty, path)).count() == 0


def test_ids_equal_the_tokenizers_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, rng = Tokenizer.from_file(path), random.Random(3)
    library.encode_special_tokens = True  # as the tokenizer files' notes set it
    own = packing.Tokens(path)
    parts = ["<|endoftext|>", "the ", "Ünïcode", "漢字", "\n\n", " 123", "'s", "\t", "😀", " x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(500)]
    want = [struct.pack(f"<{len(e.ids) + 1}I", *e.ids, 0) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.documents(texts) == want


def test_sum_of_squares_rule():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 65, 400)
    bins, counts = packing.OpenSequences(64), Counter()
    for n in lengths.tolist():
        def total(gap):
            after = counts.copy()
            if gap < 64:
                after[gap] -= 1
            if gap > n:
                after[gap - n] += 1
            return sum(v * v for v in after.values())
        options = [total(g) for g, c in counts.items() if c and g >= n] + [total(64)]
        before = 64 - bins.place(n)[1]
        assert total(before) == min(options)
        if before < 64:
            counts[before] -= 1
        if before > n:
            counts[before - n] += 1
    number, _ = packing.sum_of_squares(np.tile(lengths, 20))
    assert number.max() + 1 <= 1.01 * lengths.sum() * 20 / 64 + 1


# --- joins --------------------------------------------------------------------------------------

@pytest.mark.parametrize("tile", [jaccard.TILE, 3])
def test_jaccard_links(corpus, empty, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "SMALL", 64 if tile > 3 else 2)
    texts = texts_of(corpus)
    sets = []
    for _, t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    groups = Groups(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]):
            groups.join(a, b)
    least = {}
    for k, (i, _) in enumerate(texts):
        if i is not None:
            least[groups.root(k)] = min(least.get(groups.root(k), i), i)
    want = Counter((i, len(sets[k]), least.get(groups.root(k))) for k, (i, _) in enumerate(texts))
    assert Counter(tuple(r) for r in jaccard.link(corpus).collect()) == want
    assert jaccard.link(empty).count() == 0
    kept = jaccard.one_of_each(corpus)
    assert kept.columns == corpus.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in want}


def test_tiles_find_what_the_first_pass_leaves(spark):
    rng = np.random.default_rng(2)
    core = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([core[: 300 - 3 * k], rng.integers(0, 2**63, 40).astype(np.uint64)])) for k in range(20)]
    n = np.array([len(s) for s in sets])
    band = np.floor(np.log(n) / np.log(101 / 75)).astype(int)
    bits = [jaccard.bitmap(s) for s in sets]
    wide = jaccard._Maps(bits)
    tiles = [(low, k) for low in range(band.min(), band.max() + 1) for k in range(20) if band[k] in (low, low + 1)]
    low, at = (np.array(x) for x in zip(*tiles))
    a, b = jaccard._tile_pairs(low, low, at, n[at], at, band[at], jaccard._Maps([bits[k] for k in at]), 75)
    found = set(zip(a.tolist(), b.tolist()))
    one = jaccard._tile_pairs(np.zeros(20), np.full(20, -1), np.arange(20), n, np.arange(20), band, wide, 75)
    assert found <= set(zip(*(x.tolist() for x in one)))
    for a, b in itertools.combinations(range(20), 2):
        common = len(np.intersect1d(sets[a], sets[b]))
        if 100 * common >= 75 * (n[a] + n[b] - common):
            assert (a, b) in found
    # A forest has one pair less than the classes it joins, and names all classes of any pair.
    a, b = jaccard._tile_pairs(np.zeros(20), np.full(20, -1), np.arange(20), n, np.arange(20), band, wide, 75, True)
    pairs, alone = [(x, y) for x, y in zip(a.tolist(), b.tolist()) if x != y], {x for x, y in zip(a.tolist(), b.tolist()) if x == y}
    groups, every = Groups(range(20)), Groups(range(20))
    for x, y in pairs:
        assert groups.root(x) != groups.root(y)
        groups.join(x, y)
    for x, y in zip(*(x.tolist() for x in one)):
        every.join(x, y)
    assert alone == {x for p in zip(*(x.tolist() for x in one)) for x in p}
    assert [groups.root(x) for x in range(20)] == [every.root(x) for x in range(20)]


def test_star_of_near_copies(spark):
    """Copies each near their base only, whose base sorts anywhere: a group costs its members."""
    rng = random.Random(4)
    base = [f"b{k}" for k in range(200)]
    texts = [" ".join(base)]
    for k in range(60):
        words = base[:]
        for at in rng.sample(range(0, 195, 10), 5):
            words[at] = f"x{k}q{at}"
        texts.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate(texts[::-1])]
    sets = [{tuple(t.split()[k:k + 5]) for k in range(196)} for _, t in rows]
    groups = Groups(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            groups.join(a, b)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.link(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {i: groups.root(i) for i, _ in rows}


def test_components_of_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 301)]
    rows = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in rows} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_shingle_sets():
    sets = list(shingle_sets(["a b", "A  b", None, "", "a b c d e f", "a b c d e a b c d e"]))
    assert [len(s) for s in sets] == [1, 1, 0, 0, 2, 5] and (sets[0] == sets[1]).all()


@pytest.mark.parametrize("limit", [0, 1, 2, 4])
def test_banded_edit_distance(limit):
    rng = random.Random(limit)
    pairs = []
    for _ in range(600):
        a = [rng.choice("ab漢") for _ in range(rng.choice([0, 1, 2, 5, 12, 40]))]
        b = a[:]
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(b) + 1)
            b[k:k + rng.randrange(2)] = rng.choice(["", "a", "c"])
        pairs.append(("".join(a), "".join(b)))
    assert linededup.within(pairs, limit).tolist() == [edits(a, b) <= limit for a, b in pairs]


@pytest.mark.parametrize("tile", [linededup.TILE, 3])
def test_line_dedup(spark, empty, monkeypatch, tile):
    monkeypatch.setattr(linededup, "TILE", tile)
    rng = random.Random(9)
    base = ["".join(rng.choice("abcde ") for _ in range(rng.choice([45, 60, 90]))).strip().ljust(42, "z") for _ in range(6)]
    texts = [None, "", "short", "short\nshort"]
    for k in range(60):
        lines = []
        for _ in range(3):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(line))
                line[at:at + rng.randrange(2)] = rng.choice(["", "x", "y"])
            lines.append("".join(line))
        texts.append("\n".join([*lines, f"own {k}", "  "]))
    texts.append(base[0] + "\n" + base[0])
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id bigint, text string, n_lines string")
    place = {}
    for i, t in enumerate(texts):
        for p, line in enumerate((t or "").split("\n")):
            if len(line.strip()) >= 40:
                place.setdefault(line.strip(), []).append((i, p))
    unique = sorted(place)
    groups = Groups(range(len(unique)))
    for a, b in itertools.combinations(range(len(unique)), 2):
        if abs(len(unique[a]) - len(unique[b])) <= 2 and edits(unique[a], unique[b]) <= 2:
            groups.join(a, b)
    first = {}
    for k, line in enumerate(unique):
        root = groups.root(k)
        first[root] = min(first.get(root, (9**9, 0)), min(place[line]))
    drop = {o for k, line in enumerate(unique) for o in place[line] if o != first[groups.root(k)]}
    want = {i: t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in drop) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["text"] for r in linededup.dedup(docs).collect()} == want
    kept = linededup.without_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in want.items() if t is None or t.strip() or t == texts[i]}
    assert linededup.dedup(empty).count() == 0


def test_word_limits_grow_with_the_line():
    rng = random.Random(3)
    lines = []
    for n in (9, 10, 25, 50, 90, 300, 900):
        line = [f"w{rng.randrange(30)}" for _ in range(n)]
        for _ in range(8 if n < 300 else 3):
            other = line[:]
            for _ in range(rng.randrange(0, max(2, n // 12))):
                k = rng.randrange(len(other) + 1)
                other[k:k + rng.randrange(2)] = rng.choice([[], ["new"], ["w1"]])
            lines.append(" ".join(other))
    words = linededup.Words(linededup.Lines(lines))
    assert words.size.tolist() == [len(x.split()) for x in lines]
    shared = [set() for _ in lines]
    kinds = [set() for _ in lines]
    for rows, keys, kind in linededup.word_keys_of(words, 20):
        for r, k in zip(rows.tolist(), keys.tolist()):
            (kinds if kind else shared)[r].add(k)
    pairs = list(itertools.combinations(range(len(lines)), 2))
    limits = linededup.limits_of(np.array([min(words.size[a], words.size[b]) for a, b in pairs]), 20)
    want = []
    for (a, b), limit in zip(pairs, limits.tolist()):
        close = limit and abs(int(words.size[a] - words.size[b])) <= limit and edits(lines[a].split(), lines[b].split()) <= limit
        want.append(bool(close))
        if close:  # no pair within the limit lacks a common key
            assert shared[a] & (shared[b] | kinds[b]) or shared[b] & kinds[a]
    assert linededup.words_within(words, *np.array(pairs).T, 20).tolist() == want and 10 < sum(want) < len(want) - 10


def test_near_lines_of_one_changed_word(spark):
    rng = random.Random(2)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(50))
    assert 295 <= len(long) <= 305
    changed = long.split()
    changed[20] = "replacement"
    many = [w if i % 3 else "other" for i, w in enumerate(long.split())]
    docs = spark.createDataFrame([(0, long), (1, " ".join(changed)), (2, " ".join(many))], "doc_id bigint, text string")
    kept = linededup.without_copies(docs, per=linededup.WORDS_PER_EDIT)
    assert {r["doc_id"] for r in kept.collect()} == {0, 2}


def test_equal_short_lines_go(spark):
    text = "Released under MIT.\n\n  A line of forty characters and some more.\nend"
    docs = spark.createDataFrame([(0, text), (1, text), (2, "end\nown\n"), (3, None), (4, ""), (5, "End")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(docs, short=True).collect()}
    assert got == {0: text, 1: "", 2: "own\n", 3: None, 4: "", 5: "End"}
    assert {r["doc_id"] for r in linededup.without_copies(docs, short=True).collect()} == {0, 2, 3, 4, 5}


# --- language model -----------------------------------------------------------------------------

def test_language_model_equals_plain_python(corpus, empty):
    docs = corpus.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text")
    texts = {i: (t or "").encode().lower().split() + [1] for i, t in texts_of(docs)}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    model = lm.train(docs.where(lm.learned()))
    pairs = Counter((u, v) for i in texts if i not in held for u, v in zip([2] + texts[i], texts[i]))
    count, context, kinds, before = Counter(), Counter(), {}, Counter()
    for (u, v), n in pairs.items():
        count[v] += n
        context[u] += n
        kinds.setdefault(u, [0, 0, 0])[min(n, 3) - 1] += 1
        before[v] += 1
    cuts = [lm.Discounts.of([sum(x == k for x in c.values()) for k in range(1, 5)]).cut for c in (pairs, before)]
    less = lambda n, cut: max(n - (0, *cut)[min(n, 3)], 0)
    spread = sum(n - less(n, cuts[1]) for n in before.values()) / len(pairs)

    def chance(u, v):
        lowest = less(before[v], cuts[1]) / len(pairs) + spread / (len(count) + 1)
        if not context[u]:
            return lowest
        return less(pairs[u, v], cuts[0]) / context[u] + sum(d * n for d, n in zip(cuts[0], kinds[u])) / context[u] * lowest

    total = sum(count.values())
    for u in (2, texts[6][0], b"never"):
        assert abs(sum(chance(u, v) for v in count) + chance(u, b"unseen") - 1) < 1e-9
    for r in lm.score(docs, model).collect():
        own = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"]) == (len(own), sum(count[w] > 0 for w in own))
        assert r["base_score"] == pytest.approx(sum(np.log10((count[w] + 1) / (total + len(count) + 1)) for w in own))
        assert r["score"] == pytest.approx(sum(np.log10(chance(u, v)) for u, v in zip([2] + own, own)))
    nothing = lm.train(empty)
    assert nothing.tokens == 0 and {r["score"] for r in lm.score(docs, nothing).collect()} == {0.0}
    assert lm.score(empty, model).count() == 0


def test_packed_runs_round_trip():
    u = np.sort(np.random.default_rng(1).integers(0, 2**52, 500).astype(np.uint64))
    back = lm.unsqueeze(lm.squeeze([u, u[::-1], np.arange(500, dtype=np.uint64)]), 3)
    assert (back[0] == u).all() and (back[1] == u[::-1]).all() and (back[2] == np.arange(500)).all()


# --- WARC ---------------------------------------------------------------------------------------

def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    big, other = "é" * 60, "x" * 100
    rows = [(5, "http://a/\r\nEvil: 1", big), (3, None, big), (9, "http://b", big), (1, "u", "tiny"), (2, "u", "tiny"), (4, "u", None), (6, "u", ""),
            (7, "u", other), (8, "u", other + "\r\n\r\n"), (None, "u", big), (3, "u", big), (7, "u", "y" * 150), (10, "u", "z\r\n" * 9000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = scratch_path(spark, "warc-test")
    files = warc.write(pages, folder).cache()
    assert files.agg(F.sum("records")).first()[0] == len(rows)
    back = warc.resolve(warc.read(files, folder, with_payload=True)).collect()
    first = {}
    for key, _, html in rows:
        data = (html or "").encode()
        if key is not None and len(data) >= 100:
            first[data] = min(first.get(data, key), key)
    want = Counter()
    for key, _, html in rows:
        data = (html or "").encode()
        again = first.get(data) if key is not None and first.get(data, key) != key else None
        want[key, "revisit" if again is not None else "response", hashlib.sha256(data).hexdigest(), len(data), again, data] += 1
    assert Counter((r["page_id"], r["record_type"], r["payload_digest"], r["payload_bytes"], r["refers_to"], bytes(r["payload"])) for r in back) == want
    assert "\n" not in next(r["target"] for r in back if r["page_id"] == 5)
    assert warc.read(warc.write(pages.limit(0), folder), folder).count() == 0


# --- quality rules ------------------------------------------------------------------------------

def test_quality_counts(corpus, empty):
    rows = quality.measure(corpus).select("doc_id", "text", *quality.COUNTS).collect()
    for r in rows:
        text = r["text"] or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        times = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    assert quality.kept_documents(corpus).columns == corpus.columns
    assert quality.kept_documents(empty).count() == 0


def test_fences_follow_their_group(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    plain = [(" ".join(word() for _ in range(80)), "prose") for _ in range(260)]
    code = [(" ".join(word() + rng.choice(["#", "##"]) for _ in range(80)), "code") for _ in range(260)]
    odd = [(" ".join(word() + "#" for _ in range(80)), "prose")]
    rows = [(i, t, "en", s) for i, (t, s) in enumerate(plain + code + odd)]
    kept = {r["doc_id"] for r in quality.kept_documents(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert kept == set(range(520))  # many symbols are usual in one source and not in the other


def test_fences_shrink_towards_the_language(spark):
    """Fences of groups of any size equal a plain computation from all documents."""
    rng = random.Random(7)
    rows = []
    for lang, source, n, size in [("en", "a", 300, 4), ("en", "b", 3, 9), ("en", None, 40, 6), (None, "a", 25, 5), ("de", "c", 1, 12)]:
        word = lambda: "".join(rng.choice("abcdefgh") for _ in range(max(1, int(rng.gauss(size, 0.6)))))  # noqa: E731, B023
        rows += [(lang, source, " ".join(word() for _ in range(60)) + " $" * rng.randrange(size)) for _ in range(n)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, source string, text string")
    measured = quality.measure(docs).cache()
    got = {(r["lang"], r["source"]): r for r in quality.fences(quality.sketches(measured, "lang", "source")).collect()}
    values = {}
    for r in measured.where(~quality.base_failed()).collect():
        for name, (a, b, _, _) in quality.MEASURES.items():
            v = 1000 * r[a] // r[b]
            shift = max(v.bit_length() - 7, 0)
            values.setdefault(name, []).append((r["lang"], r["source"], v >> shift << shift))
    assert len(got) == 5
    for name, (_, _, tolerance, below) in quality.MEASURES.items():
        bins = sorted({v for _, _, v in values[name]})
        for (lang, source), fence in got.items():
            share = {b: 0 for b in bins}
            for k, own in enumerate([lambda x: True, lambda x: x[0] == lang, lambda x: x[:2] == (lang, source)]):
                inside = [x[2] for x in values[name] if own(x)]
                weight = quality.WEIGHT if k else 0
                share = {b: (1000000 * sum(v <= b for v in inside) + weight * share[b]) // (len(inside) + weight) for b in bins}
            low, mid, high = (min(b for b in bins if share[b] >= q) for q in (1_000_000 - quality.OUTER, 500_000, quality.OUTER))
            assert fence[f"_{name}_above"] == high + quality.SPREAD * (high - mid) + tolerance
            assert not below or fence[f"_{name}_below"] == low - quality.SPREAD * (mid - low) - tolerance


# --- language ID --------------------------------------------------------------------------------

def test_language_id(spark, empty):
    rng = random.Random(8)
    parts = {"xx": "ka ro ti mu sel".split(), "yy": "ö bri tschu ange kla".split(), "zz": "ción que dad osto ar".split()}
    make = lambda k: " ".join("".join(rng.choice(parts[k]) for _ in range(rng.randrange(1, 4))) for _ in range(60))
    rows = [(i, make(k), k) for i, k in enumerate(rng.choice(sorted(parts)) for _ in range(200))]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "123 !?", "zz"), (903, make("yy") * 40, None), (None, make("zz"), "zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify(docs, F.col("doc_id") % 5 != 0).collect()}
    held = [(i, k) for i, _, k in rows[:200] if i % 5 == 0]
    assert sum(got[i]["lang_pred"] == k for i, k in held) >= 0.95 * len(held)
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "yy", "zz"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in langid.identify(docs, F.lit(False)).collect()} == {"und"}
    assert langid.identify(empty, F.lit(True)).count() == 0
    assert langid.known_language(docs, F.col("doc_id") % 5 != 0).columns == docs.columns


def test_language_of_long_texts_and_many_labels(spark, monkeypatch):
    rng = random.Random(5)
    make = lambda syllables, n: " ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(n))
    rows = [(i, make(["ka", "ro", "ti"], 60), "xx") for i in range(40)] + [(i, make(["ö", "bri", "ang"], 6000), "yy") for i in range(40, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert min(len(t) for i, t, k in rows if k == "yy") > langid.SAMPLE_CHARS
    texts, labels = langid.sample(docs, F.lit(True), "text", "lang", "doc_id")
    assert Counter(labels) == {"xx": 40, "yy": 20} and max(map(len, texts)) == langid.SAMPLE_CHARS
    got = langid.identify(docs, F.col("doc_id") % 5 != 0).collect()
    assert all(r["lang_pred"] == ("xx" if r["doc_id"] < 40 else "yy") for r in got)
    spread = docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 6))
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 8)
    assert Counter(langid.sample(spread, F.lit(True), "text", "lang", "doc_id")[1]) == {f"l{k}": 1 for k in range(6)}


def test_language_model_by_plain_computation():
    """The fitted weights equal a ridge on explicit kernel values."""
    rng = random.Random(6)
    parts = {"a": ["ka", "ro", "ti"], "b": ["que", "dad", "os"]}
    labels = [rng.choice("ab") for _ in range(60)]
    texts = [" ".join(rng.choice(parts[k]) + rng.choice("xyzw") for _ in range(rng.randrange(3, 20))) for k in labels]
    model = langid.fit(texts, labels)

    def grams(text):
        return {text.lower()[k:k + n] for n in (1, 2, 3) for k in range(len(text) - n + 1)} - {" "}

    # Landmarks: the first of each language in turn; all texts here, as there are fewer than LANDMARKS.
    at = sorted(range(60), key=lambda i: (labels[:i].count(labels[i]), labels[i]))
    known = set().union(*map(grams, texts))
    kernel = lambda x, y: len(grams(x) & grams(y) & known) / np.sqrt(max(1, len(grams(x) & known)) * max(1, len(grams(y) & known)))
    other = ["karo tix", "quedad osw", "new words"]
    got = model.kernel(other)
    want = np.array([[kernel(x, texts[i]) for i in at] for x in other])
    assert np.allclose(got, want, atol=1e-5)
    whole = np.array([[kernel(texts[i], texts[j]) for j in at] for i in range(60)])
    between = whole[at]
    values, vectors = np.linalg.eigh(between)
    root = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    z, sides = whole @ root, np.array([[1.0 if k == m else -1.0 for m in "ab"] for k in labels])
    weight = np.diag([1 / labels.count(k) for k in labels])
    ridge = langid.RIDGE * np.trace(weight) / 60
    beta = np.linalg.solve(z.T @ weight @ z + ridge * np.eye(60), z.T @ weight @ sides)
    assert np.allclose(want @ root @ beta, got @ model.weights, atol=2e-2)


# --- nearest neighbours -------------------------------------------------------------------------

def test_nearest_neighbours(spark):
    rng = np.random.default_rng(6)
    data = rng.normal(size=(600, 12)) * rng.uniform(0.5, 2, (600, 1))
    data[100:140] = data[0]  # a crowd of copies
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(1000, None), (1001, [0.0] * 12), (1020, [float("nan")] * 12), (1003, [1.0] * 3), (1004, [None] * 12), (None, [1.0] * 12)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("id", F.lit("clash"))
    vectors = hnsw.vectors_of(table, "vec_id", "embedding")
    found = {}
    for r in hnsw.search(vectors, F.col("id") % 20 == 0, k=20, shard_vectors=200).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert set(found) == set(range(0, 600, 20))
    hits = 0
    for q, got in found.items():
        got.sort()
        score = data @ data[q]
        want = [i for i in np.lexsort((np.arange(600), -np.round(score, 12))) if i != q][:20]
        assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
        assert all(s == pytest.approx(score[i], abs=1e-12) for _, i, s in got)
        assert [g[1:] for g in got] == sorted([g[1:] for g in got], key=lambda x: (-x[1], x[0]))
        hits += len(set(want) & {g[1] for g in got})
    assert hits >= 0.95 * 20 * len(found)
    few = hnsw.search(vectors.where("id < 5"), F.col("id") == 0).collect()
    assert {r["id"] for r in few} == {1, 2, 3, 4}
    assert hnsw.search(vectors.where("id < 0"), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("size", [1e-200, 1e-25, 1e25, 1e200])
def test_neighbours_of_any_magnitude(spark, size):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(40, 6))
    vectors = spark.createDataFrame([(i, [float(x) for x in v * size]) for i, v in enumerate(data)], "id bigint, v array<double>")
    found = {}
    for r in hnsw.search(vectors, F.col("id") % 20 == 0, shard_vectors=15).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert {q: len(rows) for q, rows in found.items()} == {0: 20, 20: 20}
    for q, rows in found.items():
        with np.errstate(over="ignore", invalid="ignore"):
            score = (data * size * (data[q] * size)).sum(axis=1)
        score[np.isnan(score)] = -np.inf  # terms that overflow both ways, as documented
        want = sorted((i for i in range(40) if i != q), key=lambda i: (-score[i], i))[:20]
        assert [r[1] for r in sorted(rows)] == want
        assert [r[2] for r in sorted(rows)] == pytest.approx(score[want].tolist(), rel=1e-9)


# --- licences -----------------------------------------------------------------------------------

def test_every_notice_has_a_mark():
    assert all(any(m in t.lower() for m in licenses.MARKS) for texts in licenses.TEMPLATES.values() for t in texts)


def test_licence_scan(spark, corpus, empty):
    scanner = licenses.train(corpus)
    notes = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    rows = [(i, f"Some words before.\n{t}\nand after.") for i, (_, t) in enumerate(notes)] + [(900 + i, t) for i, t in enumerate(licenses.OTHERS)]
    rows += [(800, None), (801, ""), (802, "Nothing to see."), (803, "A permission slip was signed by the common people of the city."), (0, rows[0][1])]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("line", F.lit(1)), scanner).collect()
    found = {r["doc_id"]: r["family"] for r in got}
    assert [found[i] for i in range(len(notes))] == [f for f, _ in notes]
    assert {found[900 + i] for i in range(len(licenses.OTHERS))} == {"unknown"} and found[803] == "unknown"
    assert not {800, 801, 802} & set(found)
    assert licenses.scan(empty, scanner).count() == 0


def test_wrapped_notices(spark, corpus):
    import textwrap

    scanner = licenses.train(corpus)
    notes = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    rows = []
    for k, width in enumerate((72, 40)):
        for i, (_, t) in enumerate(notes):
            rows.append((100 * k + i, "int main() {}\n\n" + "\n".join(" * " + x for x in textwrap.wrap(t, width, break_on_hyphens=False)) + "\n\nSome words after."))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), scanner).collect()
    for k in range(2):
        for i, (family, _) in enumerate(notes):
            assert {r["family"] for r in got if r["doc_id"] == 100 * k + i} == {family}
