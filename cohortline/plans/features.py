"""Derived features in a fixed order behind on/off switches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortline import defaults as D
from cohortline.functions.scalar import charlson_index, elixhauser_score, interactions, polynomials
from cohortline.operators.encode import age_band_onehot
from cohortline.operators.timeline import MAX_ROWS, diff_columns, over_timeline, rolling_columns


def risk_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "charlson_index": charlson_index(df.columns), "elixhauser_score": elixhauser_score(df.columns),
    })


def interaction_features(df: DataFrame) -> DataFrame:
    made = interactions(df.columns)
    return df.withColumns(made) if made else df


def polynomial_features(
    df: DataFrame, columns: Sequence[str] = D.POLYNOMIAL_COLUMNS, degree: int = 2,
) -> DataFrame:
    made = polynomials(df.columns, columns, degree)
    return df.withColumns(made) if made else df


@dataclass(frozen=True)
class FeatureSet:
    """Switches and sizes of the derived features."""

    age_groups: bool = True
    risk_scores: bool = True
    interactions: bool = True
    rolling: bool = True
    diffs: bool = True
    polynomial: bool = False
    rolling_windows: tuple[int, ...] = D.ROLLING_WINDOWS
    rolling_stats: tuple[str, ...] = ("mean", "std")
    degree: int = 2
    age_edges: tuple[float, ...] = D.AGE_EDGES
    age_labels: tuple[str, ...] = D.AGE_LABELS
    subject: str = D.SUBJECT
    order: tuple[str, ...] = D.TIMELINE
    max_rows: int | None = MAX_ROWS

    def transform(self, df: DataFrame) -> DataFrame:
        """Row features are projections; all timeline features share one window."""
        if self.age_groups:
            df = age_band_onehot(df, edges=self.age_edges, labels=self.age_labels)
        if self.risk_scores:
            df = df.transform(risk_scores)
        if self.interactions:
            df = df.transform(interaction_features)
        df = self._timeline(df)
        if self.polynomial:
            df = polynomial_features(df, degree=self.degree)
        return df

    def _timeline(self, df: DataFrame) -> DataFrame:
        if self.subject not in df.columns:
            return df
        parts, lookback = [], 1
        rolled = [c for c in D.ROLLING_COLUMNS if c in df.columns]
        if self.rolling and rolled:
            parts.append(rolling_columns(rolled, self.rolling_windows, self.rolling_stats))
            lookback = max(lookback, max(self.rolling_windows) - 1)
        changed = [c for c in D.DIFF_COLUMNS if c in df.columns]
        if self.diffs and changed:
            parts.append(diff_columns(changed))
        if not parts:
            return df
        order = [c for c in self.order if c in df.columns]

        def together(window):
            return {name: column for part in parts for name, column in part(window).items()}
        return over_timeline(df, together, lookback, self.subject, order, self.max_rows)

