"""Quality rules whose thresholds follow each language and source.

Each document gives four whole-number measures in thousandths. A sketch of a
measure is its histogram over bins of at most 1/64 relative width: adding the
counts of two sketches gives the sketch of both, so one set of rows
(language, source, measure, bin, count) serves all levels. A group's sketch is
shrunk towards its language's, and that towards all documents', as if ``weight``
documents of the wider level had been added: small groups follow their language
and large ones themselves, without a step. A fence lies SPREAD times the
distance from the median to an outer quantile beyond that quantile, and a
tolerance further, which is what a text of the least length shows by
chance (two symbols, a phrase of four words said twice, one line of four); it keeps
groups without any spread from rejecting clean documents. No cutoff is fixed.

Built-in functions only. Null text has no words and fails the base rule. Null
language or source is a group of its own. Repeated rows count as often as they
occur. An empty table gives no rows. Columns of the same names as the measures
are replaced in ``judge``; ``kept_documents`` returns the input's columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import BLANKS, WORD_BREAK, aside, stored

LEAST_WORDS = 50
WEIGHT = 20
OUTER = 850_000  # the outer quantile, in millionths
SPREAD = 6
# measure -> (numerator, denominator, tolerance in thousandths, whether there is a lower fence too)
MEASURES = {
    "symbols": ("n_symbols", "n_words", 40, False),
    "repeats": ("n_repeat_words", "n_words", 180, False),
    "same_lines": ("n_dup_lines", "n_lines", 250, False),
    "word_size": ("word_chars", "n_words", 250, True),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _bare(column: Column) -> Column:
    return F.trim(column, F.lit(BLANKS))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with counts of words, word characters, symbols, lines, repeated lines and repeated words."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.withColumn("_text", whole).withColumn("_bare", _bare(F.col("_text")))
    rows = rows.withColumn("_words", F.when(F.length("_bare") > 0, F.split("_bare", WORD_BREAK)).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda line: F.length(_bare(line)) > 0))
    rows = rows.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in (*COUNTS, "n_lines")],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("_words") > 2,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - 3),
                lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        ).alias("_windows"),
    )
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn("_sorted", F.when(repeated, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = F.expr("filter(_sorted, (x, k) -> (k > 0 AND get(_sorted, k - 1).h <=> x.h) OR get(_sorted, k + 1).h <=> x.h)")
    rows = rows.withColumn("_at", F.sort_array(F.transform(twin, lambda x: x["i"])))
    covered = F.expr("aggregate(transform(_at, (x, k) -> least(3, coalesce(get(_at, k + 1) - x, 3))), 0L, (a, b) -> a + b)")
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_windows", "_sorted", "_at")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _thousandths(top: str, bottom: str) -> Column:
    return F.expr(f"CASE WHEN {bottom} > 0 THEN (1000 * {top}) DIV {bottom} END")


def bin_of(value: Column) -> Column:
    """Lower end of the value's bin: below 128 itself, above with its seven leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, measure, bin, n) of documents that pass the base rule."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), _thousandths(a, b).alias("value")) for m, (a, b, _, _) in MEASURES.items()])
    rows = measured.where(~base_failed()).select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"), F.explode(pairs).alias("m"))
    rows = rows.select("lang", "source", F.col("m.measure").alias("measure"), bin_of(F.col("m.value")).alias("bin"))
    return rows.groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


_BINS = "SELECT {keys}measure, bin, sum(n) AS n FROM {rows} GROUP BY {keys}measure, bin"
_EVERY = f"""
SELECT measure, bin, (1000000 * sum(n) OVER (PARTITION BY measure ORDER BY bin)) DIV sum(n) OVER (PARTITION BY measure) AS share
FROM ({_BINS.format(keys="", rows="{rows}")})"""
# One level: the wider level's bins for each group, with the group's own counts where it has any.
_LEVEL = """
SELECT {keys}, measure, bin,
       (1000000 * sum(n) OVER (PARTITION BY {keys}, measure ORDER BY bin) + {weight} * share)
       DIV (sum(n) OVER (PARTITION BY {keys}, measure) + {weight}) AS share
FROM (SELECT {own}, w.measure, w.bin, w.share, coalesce(c.n, 0) AS n
      FROM (SELECT DISTINCT {keys}, measure FROM {{rows}}) k
      JOIN {{wider}} w ON w.measure = k.measure{inside}
      LEFT JOIN ({bins}) c ON {same} AND c.measure = w.measure AND c.bin = w.bin)"""


def _level(rows: DataFrame, wider: DataFrame, keys: list[str], weight: int) -> DataFrame:
    """Cumulative shares in millionths by bin of each group, shrunk towards the wider level."""
    text = _LEVEL.format(
        keys=", ".join(keys), own=", ".join(f"k.{c}" for c in keys), weight=weight,
        inside="".join(f" AND w.{c} <=> k.{c}" for c in keys[:-1]), same=" AND ".join(f"c.{c} <=> k.{c}" for c in keys),
        bins=_BINS.format(keys="".join(f"{c}, " for c in keys), rows="{rows}"))
    return rows.sparkSession.sql(text, rows=rows, wider=wider)


def fences(sketch: DataFrame, weight: int = WEIGHT) -> DataFrame:
    """(lang, source) with the upper and lower fence of each measure, in thousandths."""
    every = sketch.sparkSession.sql(_EVERY, rows=sketch)
    own = _level(sketch, _level(sketch, every, ["lang"], weight), ["lang", "source"], weight)
    at = lambda share: F.min(F.when(F.col("share") >= share, F.col("bin")))
    marks = own.groupBy("lang", "source", "measure").agg(at(1_000_000 - OUTER).alias("low"), at(500_000).alias("mid"), at(OUTER).alias("high"))
    wide = []
    for name, (_, _, tolerance, below) in MEASURES.items():
        mine = lambda c: F.max(F.when(F.col("measure") == name, c))  # noqa: E731, B023
        wide.append(mine(F.col("high") + SPREAD * (F.col("high") - F.col("mid")) + tolerance).alias(f"_{name}_above"))
        if below:
            wide.append(mine(F.col("low") - SPREAD * (F.col("mid") - F.col("low")) - tolerance).alias(f"_{name}_below"))
    return marks.groupBy("lang", "source").agg(*wide)


def judge(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Measured rows with base_failed and kept. A group without any passing document has no fence and keeps none."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    rows = measured.join(
        limits, F.col(f"`{lang}`").eqNullSafe(F.col("_lang")) & F.col(f"`{source}`").eqNullSafe(F.col("_source")), "left")
    ok = ~base_failed()
    for name, (top, bottom, _, below) in MEASURES.items():
        ok &= _thousandths(top, bottom) <= F.col(f"_{name}_above")
        if below:
            ok &= _thousandths(top, bottom) >= F.col(f"_{name}_below")
    rows = rows.withColumns({"base_failed": base_failed(), "kept": F.coalesce(ok, F.lit(False))})
    return rows.drop(*limits.columns)


def kept_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that the rules keep, with the columns they had."""
    own, back = aside(docs, *COUNTS, "n_lines", "base_failed", "kept")
    measured = stored(measure(own, text), "measured")  # else filters would be pushed below and repeat the measures
    return back(judge(measured, fences(sketches(measured, lang, source)), lang, source).where("kept"))
