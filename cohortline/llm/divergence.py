"""Which terms set a source apart from its language, and how far sources of a language are apart.

A term is a run of ASCII letters and non-ASCII characters, with A-Z lowered. A
language keeps the terms that stand in at least ``least`` of its documents. A
group (language, source), and each language as a whole, gives every kept term a
smoothed share p in whole billionths; the divergence of p from q is
floor((p - q)**2 / q). All arithmetic is on whole numbers.

Top terms come from a dominance skyband. At equal language a term ranks before
another if its group count is not lower, its language count not higher and its
UTF-8 bytes earlier; so a term that k others dominate in this way cannot be
among the first k. Partitions keep the terms with fewer than k dominators,
reading them in an order in which dominators come first; the bands of a group's
partitions are merged by the same function, and what is left is ranked exactly.

Distances between sources add one divergence for each kept term. Terms that two
groups both lack share one value, so only counted terms are laid out: chunks of
terms by tiles of sources, as matrices of bounded size.

Defined results. Null text, language and source are read as empty; an empty text
has no terms, its group still occurs. Repeated rows count as often as they occur,
as documents too. Ties go to the smaller item by UTF-8 bytes. A language without
kept terms gives distances of 0 and no terms. An empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.common import spread, stored

UNIT = 1_000_000_000
SALTS = 16  # parts of a group's terms, each with a skyband of its own
CHUNK, TILE = 2048, 64  # terms by sources in one matrix
_HELD = 200_000  # distinct (group, term) that a task counts before it hands them on

# Letters stay, in lower case, as do the bytes of non-ASCII characters; the rest parts terms.
_LETTERS = bytes(b if b >= 128 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_LETTERS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each task: (lang, source, term, n, docs); a row without a term for each group seen."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            for terms in ([None], list(n)):
                yield pa.record_batch({
                    "lang": pa.array([lang] * len(terms), pa.string()),
                    "source": pa.array([source] * len(terms), pa.string()),
                    "term": pa.array(terms, pa.binary()).cast(pa.string()),
                    "n": pa.array([n[t] for t in terms], pa.int64()),
                    "docs": pa.array([docs[t] for t in terms], pa.int64()),
                })
        groups.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3))):
            n, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            words, before = terms_of(text.as_py()), len(n)
            n.update(words)
            docs.update(set(words))
            held += len(n) - before
            if held > _HELD:
                yield from out()
                held = 0
    yield from out()


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 3) -> tuple[DataFrame, DataFrame]:
    """Kept terms (lang, source, term, n, whole: n over the language) and groups (lang, source, total, whole_total, size)."""
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    rows = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    rows = stored(rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    over = Window.partitionBy("lang", "term")
    kept = rows.where("term IS NOT NULL").withColumns({
        "whole": F.sum("n").over(over),
        "found": F.sum("docs").over(over),
        "first": F.row_number().over(over.orderBy("source")) == 1,
    }).where(F.col("found") >= least)
    kept = stored(kept.select("lang", "source", "term", "n", "whole", "first"), "kept-terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
    groups = rows.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").fillna(0)
    of_lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", "total", F.sum("total").over(of_lang).alias("whole_total"), F.sum("firsts").over(of_lang).alias("size"),
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("place"), F.count("*").over(of_lang).alias("sources"))
    return kept.drop("first"), stored(groups, "term-groups")


def share(n: str, total: str) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + size)), in decimals, so that no product overflows."""
    return F.expr(f"1 + (CAST({UNIT} AS DECIMAL(10, 0)) * CAST({n} + 1 AS DECIMAL(20, 0))) DIV CAST({total} + size AS DECIMAL(20, 0))").cast("long")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) DIV ({q})")


# --- the skyband --------------------------------------------------------------------------------

class _Band:
    """The terms of one group kept so far; terms arrive by falling count, then rising language count, then UTF-8."""

    def __init__(self, k: int):
        self.k = k
        self.whole = np.zeros(0, np.int64)
        self.terms = pa.array([], pa.binary())

    def add(self, whole: np.ndarray, terms: pa.Array) -> np.ndarray:
        """Which of the new terms have fewer than k dominators; these join the band."""
        both = pa.concat_arrays([self.terms, terms])
        order = pc.rank(both, tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)
        held, new = order[:len(self.whole)], order[len(self.whole):]
        beaten = _pairs_below(self.whole, held, whole, new)
        left = np.flatnonzero(beaten < self.k)
        # Earlier ones among the new terms: the band's own dominators suffice, as dominance is transitive.
        w, t = whole[left], new[left]
        within = (w[None, :] <= w[:, None]) & (t[None, :] < t[:, None]) & np.tri(len(left), k=-1, dtype=bool)
        left = left[beaten[left] + within.sum(1) < self.k]
        self.whole = np.concatenate([self.whole, whole[left]])
        self.terms = pa.concat_arrays([self.terms, terms.take(pa.array(left))])
        return left


def _pairs_below(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, cell: int = 256) -> np.ndarray:
    """For each (a, b) the number of (x, y) with x <= a and y < b: cells of x in order, each with its y sorted."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    upto = np.searchsorted(x, a, side="right")
    found = np.zeros(len(a), np.int64)
    for start in range(0, len(x), cell):
        ys = y[start:start + cell]
        whole = upto >= start + len(ys)
        found[whole] += np.searchsorted(np.sort(ys), b[whole])
        part = np.flatnonzero(~whole & (upto > start))
        inside = (np.arange(len(ys))[None, :] < (upto[part] - start)[:, None]) & (ys[None, :] < b[part][:, None])
        found[part] += inside.sum(1)
    return found


def _banded(k: int, rows: int = 1024):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, band = None, None
        for batch in batches:
            langs, sources = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
            code = langs.indices.to_numpy().astype(np.int64) * max(len(sources.dictionary), 1) + sources.indices.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(code)) + 1), batch.num_rows]
            for first, end in zip(cuts, cuts[1:]):
                for start in range(first, end, rows):
                    part = batch.slice(start, min(rows, end - start))
                    own = (part.column("lang")[0].as_py(), part.column("source")[0].as_py())
                    if own != key:
                        key, band = own, _Band(k)
                    left = band.add(part.column("whole").to_numpy(), part.column("term").cast(pa.binary()))
                    if len(left):
                        yield part.take(pa.array(left))

    return run


def skyband(terms: DataFrame, k: int, *salt: Column) -> DataFrame:
    """The rows of each (lang, source), or of each salt of it, that fewer than k rows of theirs dominate."""
    dealt = spread(terms, "lang", "source", *salt).sortWithinPartitions("lang", "source", F.desc("n"), "whole", "term")
    return dealt.mapInArrow(_banded(k), terms.schema)


def top_terms(kept: DataFrame, groups: DataFrame, k: int = 200) -> DataFrame:
    """(lang, source, item, value, rank) of the k terms by which each group exceeds its language most."""
    rows = kept.join(groups, ["lang", "source"]).withColumns({"p": share("n", "total"), "q": share("whole", "whole_total")})
    rows = rows.where("p > q").select("lang", "source", "term", "n", "whole", divergence("p", "q").alias("value"))
    # The parts of a group are sorted apart: a salt is part of the key they are sorted by.
    salted = F.concat("source", F.lit("\x00"), F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("string"))
    bands = skyband(rows.withColumns({"own": F.col("source"), "source": salted}), k)
    bands = skyband(bands.withColumn("source", F.col("own")).drop("own"), k)
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = bands.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


# --- distances between sources ------------------------------------------------------------------

_SUMS = "lang string, g int, q int, part long"


def _tile(table: pa.Table) -> pa.Table:
    """Sums, over a chunk's counted terms, of divergence less that of two groups that lack the term."""
    place, block = table["place"].to_numpy(), table["block"].to_numpy()
    p, bare = table["p"].to_numpy(), table["bare"].to_numpy()
    term = pc.dictionary_encode(table["term"].combine_chunks())
    known = pc.is_valid(term.indices).to_numpy(zero_copy_only=False)
    sources, first, column = np.unique(place, return_index=True, return_inverse=True)
    base = bare[first]
    shares = np.repeat(base[None, :], len(term.dictionary), axis=0)
    shares[term.indices.fill_null(0).to_numpy()[known], column[known]] = p[known]
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    blocks = block[first]
    g, q, part = [], [], []
    for mine, other in {(low, high), (high, low)}:
        rows = np.flatnonzero(blocks == mine)
        for j in np.flatnonzero(blocks == other):
            apart = shares[:, rows] - shares[:, j][:, None]
            value = (apart * apart // shares[:, j][:, None]).sum(0)
            lacking = base[rows] - base[j]
            g.append(sources[rows])
            q.append(np.full(len(rows), sources[j]))
            part.append(value - len(shares) * (lacking * lacking // base[j]))
    g, q, part = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (g, q, part))
    use = g != q
    return pa.table({
        "lang": pa.array([table["lang"][0].as_py()] * int(use.sum()), pa.string()),
        "g": pa.array(g[use], pa.int32()), "q": pa.array(q[use], pa.int32()), "part": pa.array(part[use], pa.int64()),
    })


def distances(kept: DataFrame, groups: DataFrame, chunk: int = CHUNK, tile: int = TILE) -> DataFrame:
    """(lang, source, item, value, rank): the other sources of the language, farthest first."""
    # A language without kept terms has shares that no one reads: 1 keeps the divisions defined.
    bare = F.when(F.col("size") > 0, share("0", "total")).otherwise(F.lit(1).cast("long"))
    groups = groups.withColumns({"bare": bare, "chunks": F.expr(f"CAST(size DIV {chunk} + 1 AS INT)"), "block": F.expr(f"CAST(place DIV {tile} AS INT)")})
    cells = kept.join(groups, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk"), "term", share("n", "total").alias("p"),
        "place", "block", "bare", "sources")
    # Each chunk knows all sources, also those that have none of its terms.
    every = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("long").alias("p"), "place", "block", "bare", "sources")
    cells = cells.unionByName(every).withColumn("other", F.explode(F.expr(f"sequence(0, CAST((sources - 1) DIV {tile} AS INT))")))
    cells = cells.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "sources")
    sums = cells.groupBy("lang", "chunk", "low", "high").applyInArrow(_tile, _SUMS).groupBy("lang", "g", "q").agg(F.sum("part").alias("part"))
    one = groups.select("lang", F.col("place").alias("g"), "source", F.col("bare").alias("p"), "size")
    two = groups.select("lang", F.col("place").alias("q"), F.col("source").alias("item"), F.col("bare").alias("q_bare"))
    value = F.col("part") + F.col("size") * divergence("p", "q_bare")
    rows = sums.join(one, ["lang", "g"]).join(two, ["lang", "q"]).select("lang", "source", "item", value.alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(by))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 3, k: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): all ``pair`` rows, and ``term`` rows up to rank k."""
    kept, groups = counts(docs, text, lang, source, least)
    pairs = distances(kept, groups).withColumn("part", F.lit("pair"))
    terms = top_terms(kept, groups, k).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
