"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.session import scratch_path

# The six characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them again: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files behind a frame from ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, *keys) -> DataFrame:
    """Hash rows over the session's shuffle partitions."""
    return df.repartition(shuffle_partitions(df.sparkSession), *keys)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_batches(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int = 512,
) -> DataFrame:
    """Run ``work`` on slices of Arrow batches of at most ``rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = work(batch.slice(start, rows))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def crc32_text(column) -> F.Column:
    """CRC-32 of a value written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows with columns of these names renamed, and a function that returns
    the former columns of any frame made from them."""
    columns = docs.columns
    moved = {c: f"_own_{c}" for c in columns if c in names}
    back = lambda df: df.select([F.col(f"`{moved.get(c, c)}`").alias(c) for c in columns])
    return docs.withColumnsRenamed(moved), back
