"""Analytics over stored run records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline.functions.scalar import buckets


def _metric(name: str) -> Column:
    return F.col(f"metrics.{name}")


def comparison_table(runs: DataFrame) -> DataFrame:
    """Metrics, size and time per run; missing values count as 0."""
    return runs.select(
        "model_type", *[F.coalesce(_metric(m), F.lit(0.0)).alias(m) for m in D.RUN_METRICS],
        F.coalesce("parameter_count", F.lit(0)).alias("param_count"),
        F.coalesce("training_time_seconds", F.lit(0.0)).alias("training_time"),
    )


def argmax_run(runs: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """The run with the best F1; on a tie the first by ``names``, else by name."""
    score = F.coalesce(_metric("f1_score"), F.lit(0.0))
    if names is not None:
        runs = runs.filter(F.col("run_name").isin(*names))
        place = F.array_position(F.array(*map(F.lit, names)), F.col("run_name"))
    else:
        place = F.col("run_name")
    best = F.min_by(F.struct("run_name", "model_type", score.alias("f1_score")), F.struct(-score, place))
    return runs.agg(best.alias("_b")).filter(F.col("_b").isNotNull()).select("_b.*")


def compare_runs(runs: DataFrame, names: Sequence[str]) -> DataFrame:
    """Chosen runs side by side, the best one flagged."""
    chosen = runs.filter(F.col("run_name").isin(*names))
    best = argmax_run(chosen, names).select(F.col("run_name").alias("_best"))
    table = chosen.select(
        "run_name", "model_type",
        *[F.coalesce(_metric(m), F.lit(0.0)).alias(m) for m in ("accuracy", "precision", "recall", "f1_score")],
        _metric("auc_roc").alias("auc_roc"), F.coalesce("parameter_count", F.lit(0)).alias("parameter_count"),
        F.coalesce("training_time_seconds", F.lit(0.0)).alias("training_time_seconds"),
    )
    # The other side is the one best run.
    joined = table.join(F.broadcast(best), F.col("run_name") == F.col("_best"), "left")
    return joined.withColumn("is_best", F.col("_best").isNotNull()).drop("_best")


def _listing(runs: DataFrame) -> DataFrame:
    unknown = F.lit("unknown")
    return runs.select(
        "run_name", F.coalesce("model_type", unknown).alias("model_type"),
        F.coalesce("timestamp", unknown).alias("timestamp"),
        _metric("f1_score").alias("f1_score"), _metric("accuracy").alias("accuracy"),
    )


def top_n_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    return _listing(runs).orderBy(F.coalesce("f1_score", F.lit(0.0)).desc(), "run_name").limit(n)


def runs_newest_first(runs: DataFrame) -> DataFrame:
    return _listing(runs).orderBy(F.desc("timestamp"), "run_name")


def sweep_rows(summaries: DataFrame) -> DataFrame:
    """One row per run inside sweep summaries."""
    return summaries.filter(F.col("all_results").isNotNull()).select(
        F.col("model_type").alias("sweep_model"), F.inline("all_results"))


def ablation_rows(summaries: DataFrame) -> DataFrame:
    """One row per component inside ablation summaries."""
    return summaries.filter(F.col("ablation_results").isNotNull()).select(
        F.explode("ablation_results").alias("component", "_r")
    ).select("component", F.col("_r.metrics.f1_score").alias("f1_score"))


def top_n_sweep(results: DataFrame, n: int = 10) -> DataFrame:
    """Successful runs by score, best first, numbered after the cut to ``n``."""
    top = (
        results.filter(F.col("error").isNull())
        .orderBy(F.coalesce("score", F.lit(0.0)).desc(), "run_index").limit(n)
    )
    # At most n rows reach this window.
    place = Window.orderBy(F.coalesce("score", F.lit(0.0)).desc(), "run_index")
    ranked = top.withColumn("rank", F.row_number().over(place))
    return ranked.withColumn("is_best", F.col("rank") == 1)


def sweep_summary(results: DataFrame) -> DataFrame:
    """Runs tried and done, the best score and its parameters (first one on a tie)."""
    done = F.col("error").isNull() & F.col("score").isNotNull()
    order = F.when(done, F.struct(-F.col("score"), F.col("run_index")))
    return results.agg(
        F.count(F.lit(1)).alias("total_runs"), F.count_if(F.col("error").isNull()).alias("successful_runs"),
        F.max(F.when(done, F.col("score"))).alias("best_score"), F.min_by("params", order).alias("best_config"),
    )


def ablation_impact(components: DataFrame, full: str = "full_model") -> DataFrame:
    """F1 change of each component against the full model, worst first."""
    base = components.filter(F.col("component") == full).agg(F.max("f1_score")).scalar()
    delta = F.col("f1_score") - F.col("_full")
    return (
        components.filter(F.col("component") != full)
        .withColumn("_full", F.coalesce(base, F.lit(0.0)))
        .select("component", "f1_score", F.round(delta, 4).alias("delta_f1"),
                buckets(delta, D.IMPACT_BOUNDS, D.IMPACT_TOP).alias("impact"))
        .orderBy("delta_f1", "component")
    )


def union_run_kinds(kinds: Mapping[str, DataFrame]) -> DataFrame:
    """Single runs and summaries in one table, tagged by kind."""
    parts = [
        (df if "experiment_type" in df.columns else df.withColumn("experiment_type", F.lit(kind)))
        .withColumn("kind", F.lit(kind)) for kind, df in kinds.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def report(records: DataFrame) -> DataFrame:
    """Totals, models tried, best / worst / mean F1 and best accuracy; one aggregate."""
    single = F.col("model_type").isNotNull() & F.col("metrics").isNotNull()
    f1, accuracy = F.when(single, _metric("f1_score")), F.when(single, _metric("accuracy"))
    return records.agg(
        F.count(F.lit(1)).alias("total_experiments"), F.count_if(single).alias("total_single_runs"),
        F.array_join(F.sort_array(F.collect_set(F.when(single, F.col("model_type")))), ",").alias("models_tested"),
        F.max(f1).alias("best_f1"), F.min(f1).alias("worst_f1"), F.avg(f1).alias("mean_f1"),
        F.max(accuracy).alias("best_accuracy"),
    )


def best_epoch(
    runs: DataFrame, scores: str = "history.val_loss", patience: int = 10, min_delta: float = 1e-4, mode: str = "min",
) -> DataFrame:
    """Best score, its epoch and the epoch at which waiting ends, per run.

    One fold over each run's own history array; runs are independent.
    """
    if mode not in ("min", "max"):
        raise ValueError(f"unknown mode {mode!r}")
    start = F.struct(
        F.lit(None).cast("double").alias("best"), F.lit(0).alias("best_epoch"), F.lit(0).alias("epoch"),
        F.lit(0).alias("waited"), F.lit(None).cast("int").alias("stop_epoch"),
    )

    def step(state: Column, score: Column) -> Column:
        epoch = state["epoch"] + 1
        gain = state["best"] - score if mode == "min" else score - state["best"]
        better = state["best"].isNull() | (gain > min_delta)
        waited = F.when(better, F.lit(0)).otherwise(state["waited"] + 1)
        after = F.struct(
            F.when(better, score).otherwise(state["best"]).alias("best"),
            F.when(better, epoch).otherwise(state["best_epoch"]).alias("best_epoch"), epoch.alias("epoch"),
            waited.alias("waited"), F.when(waited >= patience, epoch).alias("stop_epoch"),
        )
        return F.when(state["stop_epoch"].isNotNull(), state).otherwise(after)

    fold = F.aggregate(F.col(scores).cast("array<double>"), start, step)
    return runs.withColumn("_f", fold).select(
        "run_name", F.col("_f.best").alias("best_score"), F.col("_f.best_epoch").alias("best_epoch"),
        F.col("_f.stop_epoch").alias("stop_epoch"),
    )
