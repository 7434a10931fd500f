"""Numeric scaling with fitted centers and widths."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.quantiles import exact_quantiles, landmarks


@dataclass(frozen=True)
class Scaler:
    """(x - center) / width per column; a column without spread has width 1."""

    parameters: dict[str, tuple[float, float]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], method: str = "standard") -> Scaler:
        columns = [c for c in columns if c in df.columns]
        if not columns:
            return cls()
        if method == "robust":
            found = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
            pairs = {c: (q2, None if q1 is None else q3 - q1) for c, (q1, q2, q3) in found.items()}
        elif method in ("standard", "minmax"):
            center, width = {
                "standard": (F.avg, F.stddev_pop),
                "minmax": (F.min, lambda c: F.max(c) - F.min(c)),
            }[method]
            row = df.agg(*[center(c).cast("double").alias(f"c:{c}") for c in columns],
                         *[width(c).cast("double").alias(f"w:{c}") for c in columns]).first()
            pairs = {c: (row[f"c:{c}"], row[f"w:{c}"]) for c in columns}
        else:
            raise ValueError(f"unknown scaling method {method!r}")
        return cls({c: (a if a is not None else 0.0, w if w else 1.0) for c, (a, w) in pairs.items()})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select([
            ((F.col(c) - F.lit(self.parameters[c][0])) / F.lit(self.parameters[c][1])).alias(c)
            if c in self.parameters else F.col(c)
            for c in df.columns
        ])


# Coefficients of the published rational approximation of the
# inverse normal distribution function (P. J. Acklam), relative error < 1.2e-9.
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00, 1.0)
_TAIL = 0.02425


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def inverse_normal(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add standard normal quantiles of probabilities in (0, 1) as column arithmetic.

    Terms used many times are columns of their own stage, so they are computed once.
    """
    df = df.withColumns({f"_p_{c}": p for c, p in columns.items()})
    df = df.withColumns({
        f"_u_{c}": F.sqrt(-2 * F.log(F.least(F.col(f"_p_{c}"), 1 - F.col(f"_p_{c}")))) for c in columns
    } | {f"_m_{c}": (F.col(f"_p_{c}") - 0.5) * (F.col(f"_p_{c}") - 0.5) for c in columns})

    def quantile(c: str) -> Column:
        p, u, square = F.col(f"_p_{c}"), F.col(f"_u_{c}"), F.col(f"_m_{c}")
        tail = _polynomial(u, _C) / _polynomial(u, _D)
        return (
            F.when((p >= _TAIL) & (p <= 1 - _TAIL), (p - 0.5) * _polynomial(square, _A) / _polynomial(square, _B))
            .otherwise(F.when(p < 0.5, tail).otherwise(-tail))
        )
    made = df.withColumns({c: quantile(c) for c in columns})
    return made.drop(*[f"_{x}_{c}" for x in "pum" for c in columns])


@dataclass(frozen=True)
class QuantileNormal:
    """Empirical distribution function at up to 1000 points, then the normal quantile."""

    landmarks: dict[str, tuple[float, ...]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], points: int = 1000) -> QuantileNormal:
        """Exact landmarks: interpolated quantiles at ``points`` evenly spaced shares, or one per row if rows are fewer."""
        found = landmarks(df, [c for c in columns if c in df.columns], points)
        return cls({c: tuple(marks) for c, marks in found.items()})

    def cdf(self, column: str) -> Column:
        """Mean of the interpolations from below and from above, as ties need."""
        marks = np.array(self.landmarks[column], dtype=float)
        levels = np.linspace(0.0, 1.0, len(marks))

        @F.pandas_udf("double")
        def lookup(values: pd.Series) -> pd.Series:
            x = values.to_numpy(dtype=float, na_value=np.nan)
            share = 0.5 * (np.interp(x, marks, levels) - np.interp(-x, -marks[::-1], -levels[::-1]))
            share[x <= marks[0]] = 0.0
            share[x >= marks[-1]] = 1.0
            return pd.Series(np.where(np.isnan(x), None, share), dtype="object").astype("Float64")

        return lookup(F.col(column).cast("double"))

    def transform(self, df: DataFrame) -> DataFrame:
        edge = F.lit(1e-7)
        columns = [c for c in self.landmarks if c in df.columns]
        staged = df.withColumns({f"_cdf_{c}": self.cdf(c) for c in columns})
        clipped = {
            c: F.when(F.col(f"_cdf_{c}").isNotNull(), F.greatest(edge, F.least(F.col(f"_cdf_{c}"), 1 - edge)))
            for c in columns
        }
        return inverse_normal(staged, clipped).select(*df.columns)
