"""Missing values: column dropping, indicators and imputation as fit/transform."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from cohortline.functions.quantiles import exact_quantiles
from cohortline.operators.profile import category_counts

STRATEGIES = ("mean", "median", "mode")


def null_ratios(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    columns = list(columns or df.columns)
    if not columns:
        return {}
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns]).first()
    return {c: row[c] or 0.0 for c in columns}


@dataclass(frozen=True)
class DropSparse:
    """Columns whose null share at fit time was above the limit."""

    dropped: tuple[str, ...]

    @classmethod
    def fit(cls, df: DataFrame, max_missing_ratio: float = 0.8, ratios: dict[str, float] | None = None) -> DropSparse:
        ratios = ratios if ratios is not None else null_ratios(df)
        return cls(tuple(c for c in df.columns if ratios[c] > max_missing_ratio))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.dropped)


@dataclass(frozen=True)
class MissingIndicators:
    """``{col}_missing`` flags for the columns that had nulls at fit time."""

    columns: tuple[str, ...]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], ratios: dict[str, float] | None = None) -> MissingIndicators:
        columns = [c for c in columns if c in df.columns]
        ratios = ratios if ratios is not None else null_ratios(df, columns)
        return cls(tuple(c for c in columns if ratios[c] > 0))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in self.columns})


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per numeric column, the smallest one on a tie.

    One job counts by (column, value); ``mode`` as an aggregate would hold
    every distinct value in one task.
    """
    if not columns:
        return {}
    integral = {c: isinstance(df.schema[c].dataType, IntegralType) for c in columns}
    pairs = F.array(*[
        F.struct(F.lit(i).alias("column"), *[
            (F.col(f"`{c}`") if integral[c] == whole else F.lit(None)).cast(kind).alias(kind)
            for whole, kind in ((True, "long"), (False, "double"))])
        for i, c in enumerate(columns)])
    counts = df.select(F.inline(pairs)).where("long IS NOT NULL OR double IS NOT NULL")
    counts = counts.groupBy("column", "long", "double").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), "long", "double")).alias("top")).collect()
    found = {columns[r["column"]]: r["top"]["long"] if integral[columns[r["column"]]] else r["top"]["double"] for r in best}
    return {c: found.get(c) for c in columns}


@dataclass(frozen=True)
class Imputer:
    """One value per column, learned once and used for all later data."""

    values: dict[str, object] = field(default_factory=dict)

    @classmethod
    def fit(
        cls, df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
        strategy: str = "median",
    ) -> Imputer:
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {strategy!r}")
        numeric = [c for c in numeric if c in df.columns]
        categorical = [c for c in categorical if c in df.columns]
        values: dict[str, object] = {}
        if strategy == "mean" and numeric:
            row = df.agg(*[F.avg(c).alias(c) for c in numeric]).first()
            values.update({c: row[c] for c in numeric})
        elif strategy == "median":
            values.update({c: v[0] for c, v in exact_quantiles(df, numeric, (0.5,)).items()})
        elif numeric:
            values.update(modes(df, numeric))
        if categorical:
            values.update(_category_modes(df, categorical))
        return cls(values)

    def transform(self, df: DataFrame) -> DataFrame:
        def filled(c: str):
            value = self.values.get(c)
            if value is None:
                return F.col(c)
            # An integer column takes the fraction of a mean or median.
            kind = "double" if isinstance(value, float) else df.schema[c].dataType
            return F.coalesce(F.col(c).cast(kind), F.lit(value).cast(kind)).alias(c)
        return df.select([filled(c) for c in df.columns])


def _category_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Modes of all string columns from one counting job."""
    counts = category_counts(df, columns)
    best = counts.groupBy("column_name").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
    )
    found = {r["column_name"]: r["value"] for r in best.collect()}
    return {c: found.get(c) for c in columns}
