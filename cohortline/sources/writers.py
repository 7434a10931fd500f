"""Writing tables, events and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline.plans.scoring import score_rows, score_summary
from cohortline.session import kept
from cohortline.sources.arrays import WHOLE_TIMES


def write_table(df: DataFrame, path: str, format: str = "csv", mode: str = "overwrite") -> None:
    """CSV with a header, JSON records (one per line) or Parquet; parents are created. Times keep their microseconds."""
    writer = df.write.mode(mode).options(**WHOLE_TIMES)
    if format == "csv":
        writer.option("header", True).csv(path)
    elif format == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported output format: {format}")


def subject_bucket(subject, buckets: int):
    return F.pmod(F.hash(subject), F.lit(buckets))


def write_events(events: DataFrame, path: str, buckets: int = 64, files: int | None = None) -> None:
    """Events in folders by subject bucket, each file a sorted range of subjects.

    The shuffle is by range of (bucket, subject, time): a subject with very
    many events spreads over many files, and small subjects share one.
    """
    keyed = events.withColumn("bucket", subject_bucket(F.col("subject_id"), buckets))
    order = ("bucket", "subject_id", "timestamp", "code")
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/events")
    # The number of buckets belongs to the data: readers of single subjects need it.
    events.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").json(f"{path}/layout")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/events").drop("bucket")


def read_subject_events(spark: SparkSession, path: str, subject: str) -> DataFrame:
    """One subject's events: one folder is listed, row groups are pruned by id."""
    buckets = spark.read.schema("buckets int").json(f"{path}/layout").first()["buckets"]
    rows = spark.read.parquet(f"{path}/events")
    wanted = rows.filter((F.col("bucket") == subject_bucket(F.lit(subject), buckets)) & (F.col("subject_id") == subject))
    return wanted.drop("bucket")


def event_metadata(events: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: counts of events, subjects and codes, first and last timestamp.

    Exact distinct counts come from one grouping by (subject, code), which
    collapses repeated pairs before the shuffle.
    """
    first, last = F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    if approximate:
        row = events.agg(
            F.count(F.lit(1)).alias("total_events"), F.approx_count_distinct("subject_id").alias("total_patients"),
            F.approx_count_distinct("code").alias("unique_codes"), first, last)
    else:
        pairs = events.groupBy("subject_id", "code").agg(F.count(F.lit(1)).alias("_n"), first, last)
        row = pairs.agg(
            F.sum("_n").alias("total_events"), F.count_distinct("subject_id").alias("total_patients"),
            F.count_distinct("code").alias("unique_codes"), F.min("first").alias("first"), F.max("last").alias("last"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return row.select(
        F.lit(D.EVENT_SCHEMA_VERSION).alias("schema_version"), F.coalesce("total_events", F.lit(0)).alias("total_events"),
        "total_patients", "unique_codes", F.concat(day("first"), F.lit(" to "), day("last")).alias("date_range"),
    )


def write_metadata(events: DataFrame, path: str, approximate: bool = False) -> None:
    event_metadata(events, approximate).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def write_predictions(scored: DataFrame, path: str, threshold: float = 0.5, row_id: str = D.EVENT_ID) -> None:
    """Scored rows and their one-row summary as two JSON tables from one computed result."""
    with kept(scored) as rows:
        score_rows(rows, row_id=row_id).write.mode("overwrite").json(f"{path}/predictions")
        score_summary(rows, threshold).coalesce(1).write.mode("overwrite").json(f"{path}/summary")
