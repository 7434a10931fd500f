"""The scoring contract of one row, for batches and streams alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cohortline import defaults as D
from cohortline.operators.profile import fill_defaults, split_valid
from cohortline.plans.scoring import score, with_risk


def serve(
    rows: DataFrame, weights: Mapping[str, float], intercept: float = 0.0, threshold: float = 0.5,
    keep: tuple[str, ...] = (D.EVENT_ID,),
) -> DataFrame:
    """Valid rows -> defaults -> logit -> probability, prediction, risk level.

    Stateless projections and one filter, so the same plan runs on a stream.
    """
    valid, _ = split_valid(rows)
    ready = fill_defaults(valid)
    logit = F.lit(float(intercept))
    for name, weight in weights.items():
        logit = logit + F.lit(float(weight)) * F.col(name)
    scored = with_risk(score(ready.withColumn("logit", logit), threshold=threshold))
    return scored.select(*keep, "logit", "probability", "prediction", "risk_level")


def score_stream(
    spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str,
    weights: Mapping[str, float], intercept: float = 0.0, threshold: float = 0.5,
    keep: tuple[str, ...] = (D.EVENT_ID,), files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Score the Parquet files arriving in ``source``; ends when all present ones are done."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    scored = serve(reader.parquet(source), weights, intercept, threshold, keep)
    return (
        scored.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", target)
        .trigger(availableNow=True).start()
    )
