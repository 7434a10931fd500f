"""Categorical encodings with fitted state tables, and age bands."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline.functions.scalar import band
from cohortline.operators.lookup import map_lookup
from cohortline.operators.profile import category_counts
from cohortline.operators.timeline import neighbours
from cohortline.session import durable


@dataclass(frozen=True)
class OneHot:
    """0/1 column per sorted category; columns with too many stay strings."""

    categories: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], max_categories: int = 20) -> OneHot:
        columns = [c for c in columns if c in df.columns]
        if not columns:
            return cls()
        counts = category_counts(df, columns)
        rank = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
        found: dict[str, list[str]] = {c: [] for c in columns}
        # At most max_categories + 1 values per column come back.
        for row in counts.withColumn("_rank", rank).filter(F.col("_rank") <= max_categories + 1).collect():
            found[row["column_name"]].append(row["value"])
        return cls({c: tuple(sorted(v)) for c, v in found.items() if len(v) <= max_categories})

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [F.col(c) for c in df.columns if c not in self.categories]
        made = [
            F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
            for c, values in self.categories.items() if c in df.columns for v in values
        ]
        return df.select(*kept, *made)


@dataclass(frozen=True)
class TableEncoder:
    """Categories replaced by a number from a state table (column_name, value, code, n).

    ``misses`` holds the number for values not seen at fit and for nulls.
    """

    table: DataFrame
    misses: dict[str, float | int]
    sizes: dict[str, int]
    integer: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        for c, miss in self.misses.items():
            if c not in df.columns:
                continue
            state = self.table.filter(F.col("column_name") == c)
            found = map_lookup(df, state, c, {"code": miss}, weight="n", rows=self.sizes[c])
            kind = "int" if self.integer else "double"
            df = found.withColumn(c, F.col("code").cast(kind)).drop("code")
        return df


def _counted(df: DataFrame, columns: Sequence[str], label: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Materialized category counts and the number of categories per column."""
    counts = durable(category_counts(df, columns, label))
    sizes = {r["column_name"]: r["count"] for r in counts.groupBy("column_name").count().collect()}
    return counts, {c: sizes.get(c, 0) for c in columns}


def fit_label(df: DataFrame, columns: Sequence[str]) -> TableEncoder:
    """Alphabetical index from 0; values not seen at fit give -1."""
    columns = [c for c in columns if c in df.columns]
    counts, sizes = _counted(df, columns)
    # Positions of a huge vocabulary come from value ranges, not one task.
    placed = neighbours(counts, [], subject="column_name", order=("value",))
    table = durable(placed.select("column_name", "value", "n", (F.col("_pos") - 1).alias("code")))
    return TableEncoder(table, {c: -1 for c in columns}, sizes, integer=True)


def fit_frequency(df: DataFrame, columns: Sequence[str]) -> TableEncoder:
    """Share of the non-null rows; unseen and null give 0."""
    columns = [c for c in columns if c in df.columns]
    counts, sizes = _counted(df, columns)
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("_total"))
    table = counts.join(F.broadcast(totals), "column_name").withColumn("code", F.col("n") / F.col("_total"))
    return TableEncoder(table, {c: 0.0 for c in columns}, sizes)


def fit_target(df: DataFrame, columns: Sequence[str], label: str = D.LABEL) -> TableEncoder:
    """Mean label per category; unseen and null give the mean of all rows."""
    if label not in df.columns:
        return fit_frequency(df, columns)
    columns = [c for c in columns if c in df.columns]
    counts, sizes = _counted(df, columns, label)
    overall = df.agg(F.avg(label)).first()[0]
    table = counts.withColumn("code", F.try_divide(F.col("label_sum"), F.col("label_n")))
    return TableEncoder(table, {c: overall for c in columns}, sizes)


def encode_target_oof(
    df: DataFrame, column: str, label: str = D.LABEL, row_id: str = D.EVENT_ID, folds: int = 5, seed: int = 42,
) -> DataFrame:
    """Category mean computed without the row's own fold.

    The fold is a hash of the row id. Sums per (category, fold) are reduced
    before the lookup; a category seen only in the own fold gets the mean of
    all rows outside that fold.
    """
    digest = F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{seed}")))
    fold = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(folds)).cast("int")
    rows = df.withColumn("_fold", fold)
    sums = durable(rows.groupBy(F.col(column).cast("string").alias("value"), "_fold").agg(
        F.sum(F.col(label).cast("double")).alias("s"), F.count(label).alias("n")
    ))
    totals = {r["_fold"]: (r["s"] or 0.0, r["n"]) for r in
              sums.groupBy("_fold").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    all_s, all_n = sum(s for s, _ in totals.values()), sum(n for _, n in totals.values())
    prior = {f: (all_s - s) / (all_n - n) if all_n > n else None for f, (s, n) in totals.items()}
    default = None
    for f, p in sorted(prior.items()):
        default = F.when(F.col("_fold") == f, F.lit(p)) if default is None else default.when(F.col("_fold") == f, F.lit(p))
    # One row per category: total and, per fold, the part to leave out.
    parts = sums.filter(F.col("value").isNotNull()).groupBy("value").agg(
        F.sum("s").alias("_s"), F.sum("n").alias("_n"),
        F.map_from_entries(F.collect_list(F.struct("_fold", F.struct("s", "n")))).alias("_own"),
    )
    none = F.lit(None)
    joined = map_lookup(rows, parts, column, {"_s": none, "_n": none, "_own": none}, weight="_n")
    own = F.col("_own")[F.col("_fold")]
    left_n = F.col("_n") - F.coalesce(own["n"], F.lit(0))
    left_s = F.col("_s") - F.coalesce(own["s"], F.lit(0.0))
    encoded = F.when(left_n > 0, left_s / left_n).otherwise(default) if default is not None else F.lit(None)
    return joined.withColumn(f"{column}_oof", encoded).drop("_fold", "_s", "_n", "_own")


def age_band(
    df: DataFrame, column: str = "age", edges: Sequence[float] = D.AGE_EDGES, labels: Sequence[str] = D.AGE_LABELS,
) -> DataFrame:
    """Left-closed bands; out of range gives null."""
    if column not in df.columns:
        return df
    return df.withColumn("age_group", band(F.col(column), edges, labels))


def age_band_onehot(
    df: DataFrame, column: str = "age", edges: Sequence[float] = D.AGE_EDGES, labels: Sequence[str] = D.AGE_LABELS,
) -> DataFrame:
    """``age_grp_{label}`` 0/1 for every label, also the empty ones."""
    if column not in df.columns:
        return df
    group = band(F.col(column), edges, labels)
    return df.withColumns({
        f"age_grp_{name}": F.coalesce((group == name).cast("int"), F.lit(0)) for name in labels
    })
