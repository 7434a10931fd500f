"""One query for each operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import bpe, divergence, hnsw, jaccard, langid, licenses, linededup, lm, merkle, packing, quality, repeats, warc
from cohortline.llm.common import crc32_text, stored, table
from cohortline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op3_best_fit_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.tokenize(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op8_byte_bpe")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.encode(table(spark, folder, "documents"), path, pattern, decoded=True)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


_OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (
  SELECT doc_id, CAST(sum(least(3, coalesce(nxt - i, 3))) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
m AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS (
  SELECT lang, source, unnest(['symbols', 'repeats', 'same_lines', 'word_size']) AS measure,
         unnest([1000 * n_symbols // n_words, 1000 * n_repeat_words // n_words,
                 1000 * n_dup_lines // n_lines, 1000 * word_chars // n_words]) AS value
  FROM b WHERE NOT base_failed),
s AS (
  SELECT lang, source, measure, (value >> sh) << sh AS bin, count(*) AS n
  FROM (SELECT *, CAST(greatest(CASE WHEN value > 0 THEN length(bin(value)) ELSE 1 END - 7, 0) AS BIGINT) AS sh FROM v)
  GROUP BY ALL),
e AS (
  SELECT measure, bin, CAST(1000000 * sum(n) OVER (PARTITION BY measure ORDER BY bin) // sum(n) OVER (PARTITION BY measure) AS BIGINT) AS share
  FROM (SELECT measure, bin, sum(n) AS n FROM s GROUP BY ALL)),
byl AS (
  SELECT lang, measure, bin, CAST((1000000 * sum(n) OVER (PARTITION BY lang, measure ORDER BY bin) + 20 * share)
         // (sum(n) OVER (PARTITION BY lang, measure) + 20) AS BIGINT) AS share
  FROM (SELECT k.lang, e.measure, e.bin, e.share, coalesce(c.n, 0) AS n
        FROM (SELECT DISTINCT lang, measure FROM s) k JOIN e ON e.measure = k.measure
        LEFT JOIN (SELECT lang, measure, bin, sum(n) AS n FROM s GROUP BY ALL) c
          ON c.lang IS NOT DISTINCT FROM k.lang AND c.measure = e.measure AND c.bin = e.bin)),
own AS (
  SELECT lang, source, measure, bin, CAST((1000000 * sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bin) + 20 * share)
         // (sum(n) OVER (PARTITION BY lang, source, measure) + 20) AS BIGINT) AS share
  FROM (SELECT k.lang, k.source, e.measure, e.bin, e.share, coalesce(c.n, 0) AS n
        FROM (SELECT DISTINCT lang, source, measure FROM s) k
        JOIN byl e ON e.measure = k.measure AND e.lang IS NOT DISTINCT FROM k.lang
        LEFT JOIN s c ON c.lang IS NOT DISTINCT FROM k.lang AND c.source IS NOT DISTINCT FROM k.source
          AND c.measure = e.measure AND c.bin = e.bin)),
f AS (
  SELECT lang, source, measure, min(bin) FILTER (share >= 150000) AS low, min(bin) FILTER (share >= 500000) AS mid,
         min(bin) FILTER (share >= 850000) AS high
  FROM own GROUP BY lang, source, measure),
l AS (
  SELECT lang, source,
         max(CASE WHEN measure = 'symbols' THEN 40 + 7 * high - 6 * mid END) AS a1,
         max(CASE WHEN measure = 'repeats' THEN 180 + 7 * high - 6 * mid END) AS a2,
         max(CASE WHEN measure = 'same_lines' THEN 250 + 7 * high - 6 * mid END) AS a3,
         max(CASE WHEN measure = 'word_size' THEN 250 + 7 * high - 6 * mid END) AS a4,
         max(CASE WHEN measure = 'word_size' THEN 7 * low - 6 * mid - 250 END) AS b4
  FROM f GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(CASE WHEN base_failed THEN FALSE ELSE
         1000 * n_symbols // n_words <= a1 AND 1000 * n_repeat_words // n_words <= a2
         AND 1000 * n_dup_lines // n_lines <= a3 AND 1000 * word_chars // n_words BETWEEN b4 AND a4 END, FALSE) AS kept
FROM b LEFT JOIN l ON b.lang IS NOT DISTINCT FROM l.lang AND b.source IS NOT DISTINCT FROM l.source
"""


@query("op7_quality_rules", _OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    measured = stored(quality.measure(table(spark, folder, "documents")).drop("text"), "measured")
    judged = quality.judge(measured, quality.fences(quality.sketches(measured, "lang", "source")))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


@query("op4_ngram_jaccard_join")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link(table(spark, folder, "documents"))


@query("op6_warc_revisits", """
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM (SELECT page_id, h, CASE WHEN octet_length(encode(h)) >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    files = stored(warc.write(table(spark, folder, "pages"), archives), "warc-index")
    records = stored(warc.read(files, archives), "warc-headers")
    return warc.resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_language_id")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    rest = F.pmod(crc32_text("doc_id"), F.lit(5))
    found = langid.identify(docs, rest != 0)
    return found.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op5_lm_scoring")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = lm.train(docs.where(lm.learned()))
    rows = lm.score(docs.withColumn("held_out", ~lm.learned()), model)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query("op9_nearest_neighbours")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    vectors = hnsw.vectors_of(table(spark, folder, "embeddings"), "vec_id", "embedding")
    found = hnsw.search(vectors, F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op2_line_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    kept = linededup.dedup(table(spark, folder, "documents"), per=linededup.WORDS_PER_EDIT, short=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query("op1_license_scan")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return licenses.scan(docs, licenses.train(docs))


def _leaf_sql(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(concat(" + ", ".join(
        f"coalesce(concat(octet_length(encode(CAST({c} AS VARCHAR))), ':', CAST({c} AS VARCHAR)), '-')" for c in fields) + "))"


# CRC-32 of the decimal doc_id, bit by bit.
_CRC_SQL = """xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op13_merkle_manifest", f"""
WITH RECURSIVE l AS (
  SELECT row_number() OVER () AS id, doc_id, source, {_leaf_sql('text')} AS leaf, {_leaf_sql(_LOWER_SQL)} AS lowered
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n FROM l),
up(source, lvl, pos, node, n) AS (
  SELECT source, 0, pos, leaf, n FROM p
  UNION ALL
  SELECT source, lvl + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (max(n) + 15) // 16
  FROM up WHERE n > 1 GROUP BY source, lvl, pos // 16),
subs AS (SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top(lvl, pos, node, n) AS (
  SELECT 0, pos, node, n FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (max(n) + 15) // 16
  FROM top WHERE n > 1 GROUP BY lvl, pos // 16),
nodes AS (
  SELECT 0 AS tree, source, lvl, pos, node, n FROM up UNION ALL SELECT 1, NULL, lvl, pos, node, n FROM top),
sides AS (
  SELECT a.tree, a.source, a.lvl, a.pos,
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 16 = b.pos // 16
  WHERE a.n > 1 GROUP BY ALL),
steps AS (
  SELECT id, tree, lvl, l, r FROM p JOIN sides s ON s.tree = 0 AND s.source IS NOT DISTINCT FROM p.source AND s.pos = p.pos // CAST(pow(16, lvl) AS BIGINT)
  UNION ALL
  SELECT id, tree, lvl, l, r FROM p JOIN subs g ON g.source IS NOT DISTINCT FROM p.source
  JOIN sides s ON s.tree = 1 AND s.pos = g.pos // CAST(pow(16, lvl) AS BIGINT)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tree, lvl) AS step FROM steps),
proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256 FROM numbered GROUP BY id),
folded(id, step, node) AS (
  SELECT id, CAST(0 AS BIGINT), CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END
  FROM (SELECT *, {_CRC_SQL} AS crc FROM p)
  UNION ALL
  SELECT f.id, s.step, sha256(s.l || f.node || s.r) FROM folded f JOIN numbered s ON s.id = f.id AND s.step = f.step + 1),
last AS (SELECT id, node AS folded_root FROM folded QUALIFY row_number() OVER (PARTITION BY id ORDER BY step DESC) = 1)
SELECT p.doc_id, p.leaf, g.node AS subroot, t.node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = t.node AS verified
FROM p JOIN subs g ON g.source IS NOT DISTINCT FROM p.source JOIN (SELECT node FROM top WHERE n = 1) t ON true
JOIN last USING (id) LEFT JOIN proofs USING (id)""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    column = lambda text: [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(crc32_text("doc_id") % 5 == 0, merkle.leaf(*column(lowered)))
    built = merkle.build(docs, column(F.col("text")), F.col("doc_id"), F.col("source"), {"doc_id": F.col("doc_id"), "tampered": tampered})
    rows = built.proofs().withColumn("folded_root", merkle.fold(F.coalesce("own.tampered", "leaf"), F.col("path")))
    return rows.select(
        "own.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_source_divergence", r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
tok AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS whole FROM tok GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(whole) AS whole_total FROM k GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(whole_total, 0) AS whole_total, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN l USING (lang)),
s AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         CAST(1 + 1000000000 * (coalesce(n, 0) + 1) // (total + v) AS BIGINT) AS p,
         CAST(1 + 1000000000 * (whole + 1) // (whole_total + v) AS BIGINT) AS q
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


@query("op11_substring_dedup", r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
w AS (SELECT id, i, array_to_string(words[i:i + 34], ' ') AS seq FROM (SELECT id, words, unnest(range(1, len(words) - 33)) AS i FROM d)),
r AS (SELECT id, i FROM w QUALIFY count(*) OVER (PARTITION BY seq) > 1),
gone AS (SELECT DISTINCT id, unnest(range(i, i + 35)) AS i FROM r),
k AS (
  SELECT a.id, string_agg(word, ' ' ORDER BY a.i) FILTER (g.i IS NULL) AS kept, count(g.i) AS n_removed
  FROM (SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d) a LEFT JOIN gone g ON a.id = g.id AND a.i = g.i
  GROUP BY a.id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (id)""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeats.remove(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
