"""Binary classification metrics as aggregates over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions.quantiles import running_sums
from cohortline.operators.profile import unpivot_one


def confusion(df: DataFrame, label: str = "label", probability: str = "probability", threshold: float = 0.5) -> DataFrame:
    """tp, fp, tn, fn at a threshold: one aggregate."""
    hit, true = F.col(probability) >= threshold, F.col(label) == 1
    return df.agg(
        F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & ~true).alias("tn"), F.count_if(~hit & true).alias("fn"),
    )


def metric_columns() -> dict[str, Column]:
    """The metrics as expressions over tp, fp, tn, fn; undefined ratios are 0."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    recall, specificity = ratio(tp, tp + fn), ratio(tn, tn + fp)
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn), "precision": ratio(tp, tp + fp), "recall": recall,
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn), "specificity": specificity,
        "balanced_accuracy": (recall + specificity) / 2,
    }


def classification_metrics(df: DataFrame, **columns) -> DataFrame:
    counts = confusion(df, **columns)
    return counts.select([c.alias(n) for n, c in metric_columns().items()])


def _by_score(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    p = F.col(probability)
    return (
        df.filter(p.isNotNull() & F.col(label).isNotNull())
        .groupBy(p.alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )


def _ahead(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Per distinct score the positives and negatives with a strictly higher score, by ranges of scores."""
    summed = running_sums(_by_score(df, label, probability), [F.desc("score")], ["pos", "neg"])
    return summed.select(
        "score", "pos", "neg",
        (F.col("pos_upto") - F.col("pos")).alias("pos_above"), (F.col("neg_upto") - F.col("neg")).alias("neg_above"))


def auc_roc(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half. Exact."""
    table = _ahead(df, label, probability)
    wins = F.sum(F.col("neg").cast("double") * (F.col("pos_above") + F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return table.agg(F.try_divide(wins, pairs).alias("auc_roc"))


def auc_pr(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Average precision: precision at each distinct score, weighted by recall gained. Exact."""
    table = _ahead(df, label, probability)
    hits = (F.col("pos_above") + F.col("pos")).cast("double")
    precision = hits / (hits + F.col("neg_above") + F.col("neg"))
    return table.agg(F.try_divide(F.sum(precision * F.col("pos")), F.sum("pos")).alias("auc_pr"))


def threshold_analysis(
    df: DataFrame, label: str = "label", probability: str = "probability", steps: int = 20,
) -> DataFrame:
    """Metrics at thresholds 0, 1/steps, ..., 1 from one grouping by threshold bin.

    A row counts as positive at all thresholds up to its own bin, so suffix
    sums over at most ``steps + 2`` bins replace a row x threshold product.
    """
    grid = F.sequence(F.lit(0), F.lit(steps))
    spot = F.floor(F.col(probability) * steps).cast("int")
    # Guard against the last bit: the bin's own threshold must not exceed the score.
    spot = F.when(spot / F.lit(float(steps)) > F.col(probability), spot - 1).when(
        (spot + 1) / F.lit(float(steps)) <= F.col(probability), spot + 1).otherwise(spot)
    known = df.filter(F.col(probability).isNotNull() & F.col(label).isNotNull())
    bins = known.groupBy(spot.alias("_i")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    filled = df.sparkSession.range(1).select(F.explode(grid).alias("_i")).join(bins, "_i", "left").select(
        "_i", F.coalesce("_pos", F.lit(0)).alias("_pos"), F.coalesce("_neg", F.lit(0)).alias("_neg"))
    upwards = Window.orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = filled.select(
        (F.col("_i") / F.lit(float(steps))).alias("threshold"),
        F.sum("_pos").over(upwards).alias("tp"), F.sum("_neg").over(upwards).alias("fp"),
        F.sum("_pos").over(whole).alias("_p"), F.sum("_neg").over(whole).alias("_n"),
    ).select("threshold", "tp", "fp", (F.col("_n") - F.col("fp")).alias("tn"), (F.col("_p") - F.col("tp")).alias("fn"))
    return counts.select("*", *[c.alias(n) for n, c in metric_columns().items()])


def optimal_threshold_by_f1(df: DataFrame, **options) -> DataFrame:
    """The lowest threshold with the best F1."""
    table = threshold_analysis(df, **options)
    best = F.max_by(F.struct("threshold", "f1_score"), F.struct("f1_score", -F.col("threshold")))
    return table.agg(best.alias("_b")).select("_b.threshold", "_b.f1_score")


def brier(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    gap = F.col(probability) - F.col(label)
    return df.agg(F.avg(gap * gap).alias("brier"))


def calibration_curve(
    df: DataFrame, label: str = "label", probability: str = "probability", bins: int = 10,
) -> DataFrame:
    """Rows, mean probability and observed rate per equal-width probability bin."""
    place = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(probability).alias("mean_probability"),
        F.avg(label).alias("observed_rate"),
    )


def ece(df: DataFrame, **options) -> DataFrame:
    """Expected calibration error over the calibration bins."""
    curve = calibration_curve(df, **options)
    gap = F.abs(F.col("observed_rate") - F.col("mean_probability"))
    return curve.agg((F.sum(gap * F.col("n")) / F.sum("n")).alias("ece"))


def log_loss(df: DataFrame, label: str = "label", logit: str = "logit", positive_weight: float = 1.0) -> DataFrame:
    """Mean binary cross entropy from logits in the form that cannot overflow."""
    x, y = F.col(logit), F.col(label)
    tail = F.log1p(F.exp(-F.abs(x)))
    weighted = F.lit(float(positive_weight)) * y * (F.greatest(-x, F.lit(0.0)) + tail)
    return df.agg(F.avg(weighted + (1 - y) * (F.greatest(x, F.lit(0.0)) + tail)).alias("log_loss"))


def metrics_table(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """The threshold metrics as (metric, value) rows, as stored in run records."""
    row = classification_metrics(df, label=label, probability=probability)
    named = row.select([F.col(c).alias(f"v:{c}") for c in row.columns])
    return unpivot_one(named, row.columns, {"value": "v"}, key="metric")
