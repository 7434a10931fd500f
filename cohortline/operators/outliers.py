"""Outlier bounds and what to do with rows beyond them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.quantiles import exact_quantiles

Bounds = dict[str, tuple[float | None, float | None]]


def bounds_iqr(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> Bounds:
    out: Bounds = {}
    for c, (q1, q3) in exact_quantiles(df, columns, (0.25, 0.75)).items():
        out[c] = (None, None) if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out


def bounds_zscore(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> Bounds:
    columns = list(columns)
    if not columns:
        return {}
    row = df.agg(*[F.avg(c).alias(f"m:{c}") for c in columns],
                 *[F.stddev_samp(c).alias(f"s:{c}") for c in columns]).first()
    out: Bounds = {}
    for c in columns:
        mean, std = row[f"m:{c}"], row[f"s:{c}"]
        out[c] = (None, None) if mean is None or std is None else (mean - threshold * std, mean + threshold * std)
    return out


def bounds_winsorize(df: DataFrame, columns: Sequence[str], limits: Sequence[float] = (0.01, 0.99)) -> Bounds:
    return {c: tuple(v) for c, v in exact_quantiles(df, columns, limits).items()}


_METHODS = {"iqr": bounds_iqr, "zscore": bounds_zscore, "winsorize": bounds_winsorize}


def outside(column: str, low: float | None, high: float | None) -> Column:
    if low is None or high is None:
        return F.lit(False)
    return F.coalesce((F.col(column) < low) | (F.col(column) > high), F.lit(False))


@dataclass(frozen=True)
class Outliers:
    """Fitted bounds with an action: ``clip``, ``flag`` or ``remove``."""

    bounds: Bounds
    action: str = "clip"

    @classmethod
    def fit(
        cls, df: DataFrame, columns: Sequence[str], method: str = "iqr", action: str = "clip",
        sequential: bool = False, **options,
    ) -> Outliers:
        """With ``sequential`` removal each column's bounds see the rows the
        columns before it left over: one pass per column instead of one in all."""
        if method not in _METHODS:
            raise ValueError(f"unknown outlier method {method!r}")
        if action not in ("clip", "flag", "remove"):
            raise ValueError(f"unknown outlier action {action!r}")
        columns = [c for c in columns if c in df.columns]
        if not (sequential and action == "remove"):
            return cls(_METHODS[method](df, columns, **options), action)
        bounds: Bounds = {}
        for c in columns:
            found = _METHODS[method](df, [c], **options)
            bounds.update(found)
            df = df.filter(~outside(c, *found[c]))
        return cls(bounds, action)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.action == "flag":
            return df.withColumns({f"{c}_outlier": outside(c, *b).cast("int") for c, b in self.bounds.items()})
        if self.action == "remove":
            for c, b in self.bounds.items():
                df = df.filter(~outside(c, *b))
            return df

        def clipped(c: str) -> Column:
            low, high = self.bounds[c]
            value = F.col(c).cast("double")
            # A null must stay null, so no greatest/least here.
            return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value).alias(c)
        return df.select([
            clipped(c) if c in self.bounds and None not in self.bounds[c] else F.col(c) for c in df.columns
        ])
