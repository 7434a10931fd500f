"""From logits to scored rows, summaries and risk counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline.functions.scalar import risk_level, sigmoid


def score(df: DataFrame, logit: str = "logit", threshold: float = 0.5) -> DataFrame:
    """Add probability and prediction to rows that carry a logit."""
    scored = df.withColumn("probability", sigmoid(F.col(logit)))
    return scored.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))


def with_risk(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_level", risk_level(F.col("probability")))


def score_rows(df: DataFrame, subject: str = D.SUBJECT, row_id: str = D.EVENT_ID) -> DataFrame:
    """One record per scored row, identified by its own id instead of a position."""
    owner = F.col(subject).cast("string") if subject in df.columns else F.lit("")
    return df.select(
        F.col(row_id).alias("sample_index"), "prediction", "probability",
        risk_level(F.col("probability")).alias("risk_level"), owner.alias("patient_id"),
    )


def score_summary(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    p, y = F.col("probability"), F.col("prediction")
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(y == 1).alias("predicted_positive"),
        F.count_if(y == 0).alias("predicted_negative"),
        F.avg(y).alias("positive_rate"),
        F.avg(p).alias("mean_probability"),
        F.max(p).alias("max_probability"),
        F.min(p).alias("min_probability"),
    ).withColumn("threshold_used", F.lit(float(threshold)))


def risk_counts(df: DataFrame) -> DataFrame:
    p = F.col("probability")
    level = risk_level(p)
    return df.agg(
        F.count(F.lit(1)).alias("total_patients"),
        F.count_if(F.col("prediction") == 1).alias("predicted_readmission"),
        F.avg(p).alias("mean_probability"),
        *[F.count_if(level == name).alias(f"{name}_risk_count") for name in ("high", "moderate", "low")],
    )


def class_weight(label: Column, positive: float) -> Column:
    """Weight column for imbalanced labels."""
    return F.when(label == 1, F.lit(float(positive))).otherwise(F.lit(1.0))
