"""A corpus cleaned and packed in five stages; each stage's rows are written and read again.

1. quality rules: documents that fail the base rule or their group's fences go
2. language ID: documents in no learned language go
3. line dedup: later copies of lines go, and documents of which nothing is left
4. n-gram Jaccard join: of linked documents the one with the least id stays
5. best-fit packing: one row for each piece with its place in a sequence
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import jaccard, langid, linededup, packing, quality
from cohortline.llm.common import crc32_text, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.known_language(docs, F.pmod(crc32_text("doc_id"), F.lit(5)) != 0)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_copies(docs, per=linededup.WORDS_PER_EDIT, short=True)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("best_fit_packing", best_fit_packing),
]

# Language ID, the packing rule and the tokenizer are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
