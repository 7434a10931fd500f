"""Chained regressions that fill gaps, fitted from co-moments of each gap pattern."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.operators.knn import _gaps
from cohortline.session import durable

# Moments the driver holds: beyond these, patterns stay distributed and each regression is a job.
MOST_MOMENTS = 20_000_000
_PRIOR, _INNER, _SETTLED = 1e-6, 300, 1e-3


def bayesian_ridge(gram: np.ndarray, target: int) -> tuple[np.ndarray, float]:
    """Weights (0 for the target itself) and intercept of a Bayesian ridge regression.

    ``gram`` holds the products of (1, columns...) over the rows. Noise and
    weight precision are re-estimated by the usual evidence updates.
    """
    n = gram[0, 0]
    others = np.array([c for c in range(1, len(gram)) if c != target])
    weights = np.zeros(len(gram) - 1)
    if n == 0:
        return weights, 0.0
    mean = gram[0] / n
    centred = gram - np.outer(mean, mean) * n
    xx, xy, yy = centred[np.ix_(others, others)], centred[others, target], max(centred[target, target], 0.0)
    spectrum, basis = np.linalg.eigh(xx)
    spectrum = np.maximum(spectrum, 0.0)
    along = basis.T @ xy
    alpha, lam, before = 1.0 / (yy / n + np.finfo(float).eps), 1.0, None
    solve = lambda: basis @ (along / (spectrum + lam / alpha))
    for _ in range(_INNER):
        found = solve()
        error = max(yy - 2 * found @ xy + found @ xx @ found, 0.0)
        gamma = (alpha * spectrum / (lam + alpha * spectrum)).sum()
        lam = (gamma + 2 * _PRIOR) / (found @ found + 2 * _PRIOR)
        alpha = (n - gamma + 2 * _PRIOR) / (error + 2 * _PRIOR)
        if before is not None and np.abs(before - found).sum() < _SETTLED:
            break
        before = found
    weights[others - 1] = solve()
    return weights, float(mean[target] - weights @ mean[1:])


class _Patterns:
    """Rows summed by gap pattern. Within a pattern every filled value is a linear function of the known ones."""

    def __init__(self, known: np.ndarray, moments: np.ndarray):
        """known: patterns x columns; moments: patterns x (1 + columns)^2, zero where a column is a gap."""
        self.known, self.moments = known, moments
        self.maps = np.zeros_like(moments)
        self.maps[:, 0, 0] = 1.0
        for c in range(known.shape[1]):
            self.maps[:, c + 1, c + 1] = known[:, c]  # gaps start at the mean, which is 0 here

    def gram(self, column: int) -> np.ndarray:
        """Products over the rows that know the column, gaps of the others filled as they are now."""
        rows = self.known[:, column]
        return np.einsum("pij,pjk,plk->il", self.maps[rows], self.moments[rows], self.maps[rows], optimize=True)

    def fill(self, column: int, weights: np.ndarray, intercept: float) -> None:
        rows = ~self.known[:, column]
        new = np.einsum("c,pcj->pj", weights, self.maps[rows][:, 1:])
        new[:, 0] += intercept
        self.maps[rows, column + 1] = new


def _apply(steps: Sequence[tuple[int, np.ndarray, float]], values: np.ndarray, gaps: np.ndarray) -> None:
    for column, weights, intercept in steps:
        rows = gaps[:, column]
        values[rows, column] = values[rows] @ weights + intercept


@dataclass(frozen=True)
class IterativeImputer:
    """Every column predicted from the others by Bayesian ridge regression, in turns.

    Columns with few gaps go first and start at their mean; a round predicts
    each column once; rounds end when no filled value moves by more than
    ``tolerance`` times the largest known value, or after ``rounds``. New rows
    go through the same regressions. Columns without any value stay as they are.

    A filled value is a linear function of the row's known ones, so products of
    known columns summed by gap pattern carry all regressions of all rounds:
    fitting reads the data three times (means, moments, movement per round),
    however many rounds there are. At most 2**columns patterns exist; where
    they are too many for the driver they stay distributed.
    """

    columns: tuple[str, ...]
    means: np.ndarray
    steps: tuple[tuple[tuple[int, np.ndarray, float], ...], ...]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], rounds: int = 10, tolerance: float = 1e-3, most_moments: int = MOST_MOMENTS) -> IterativeImputer:
        columns = [c for c in columns if c in df.columns]
        if not columns:
            return cls((), np.zeros(0), ())
        facts = df.agg(*[F.avg(f"`{c}`").cast("double").alias(f"m:{c}") for c in columns],
                       *[F.max(F.abs(f"`{c}`")).cast("double").alias(f"x:{c}") for c in columns],
                       *[F.count(f"`{c}`").alias(f"n:{c}") for c in columns]).first()
        columns = [c for c in columns if facts[f"n:{c}"]]
        means = np.array([facts[f"m:{c}"] for c in columns], float)
        limit = tolerance * max((facts[f"x:{c}"] for c in columns), default=0.0)
        centred = df.select(*[(F.col(f"`{c}`").cast("double") - F.lit(float(m))).alias(f"_{i}") for i, (c, m) in enumerate(zip(columns, means))])
        names = centred.columns
        if len(columns) < 2:
            return cls(tuple(columns), means, ())
        pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
        patterns = durable(centred.groupBy(_gaps(names).alias("gaps")).agg(
            F.count(F.lit(1)).cast("double").alias("n"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"s{c}") for c in names],
            *[F.coalesce(F.sum(F.col(names[i]) * F.col(names[j])), F.lit(0.0)).alias(f"p{i}_{j}") for i, j in pairs]))

        def block(rows: pd.DataFrame) -> _Patterns:
            known = np.array([[g == "0" for g in gaps] for gaps in rows["gaps"]], bool).reshape(len(rows), len(names))
            moments = np.zeros((len(rows), len(names) + 1, len(names) + 1))
            moments[:, 0, 0] = rows["n"]
            for i, c in enumerate(names):
                moments[:, 0, i + 1] = moments[:, i + 1, 0] = rows[f"s{c}"]
            for i, j in pairs:
                moments[:, i + 1, j + 1] = moments[:, j + 1, i + 1] = rows[f"p{i}_{j}"]
            return _Patterns(known, moments)

        # Fewest gaps first; ties in the order given.
        order = sorted(range(len(columns)), key=lambda i: -facts[f"n:{columns[i]}"])
        side = len(names) + 1
        local = block(patterns.toPandas()) if patterns.count() * side * side <= most_moments else None

        def distributed(column: int, done: list) -> np.ndarray:
            def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for frame in frames:
                    part = block(frame)
                    for step in done:
                        part.fill(*step)
                    yield pd.DataFrame({"cell": np.arange(side * side), "value": part.gram(column).ravel()})

            rows = patterns.mapInPandas(sums, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
            out = np.zeros(side * side)
            for row in rows:
                out[row["cell"]] = row["value"]
            return out.reshape(side, side)

        steps: list[tuple] = []
        done: list[tuple] = []
        for _ in range(rounds):
            current = []
            for column in order:
                weights, intercept = bayesian_ridge(local.gram(column) if local else distributed(column, done), column + 1)
                current.append((column, weights, intercept))
                done.append(current[-1])
                if local:
                    local.fill(*current[-1])
            steps.append(tuple(current))

        def moved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            most = np.zeros(len(steps))
            for frame in frames:
                values = frame.to_numpy(dtype=float, na_value=np.nan)
                gaps = np.isnan(values)
                values[gaps] = 0.0
                for r, turn in enumerate(steps):
                    before = values.copy()
                    _apply(turn, values, gaps)
                    most[r] = max(most[r], np.abs(values - before).max(initial=0.0))
            yield pd.DataFrame({"turn": np.arange(len(steps)), "most": most})

        rows = centred.where(F.contains(_gaps(names), F.lit("1"))).mapInPandas(moved, "turn int, most double")
        shifts = {r["turn"]: r["most"] for r in rows.groupBy("turn").agg(F.max("most").alias("most")).collect()}
        last = next((r for r in range(len(steps)) if shifts.get(r, 0.0) < limit), len(steps) - 1)
        return cls(tuple(columns), means, tuple(steps[:last + 1]))

    def transform(self, df: DataFrame) -> DataFrame:
        columns, means = list(self.columns), self.means
        if not columns:
            return df
        steps = [step for turn in self.steps for step in turn]

        @F.pandas_udf(", ".join(f"_{i} double" for i in range(len(columns))))
        def filled(*series: pd.Series) -> pd.DataFrame:
            values = np.column_stack([s.to_numpy(dtype=float, na_value=np.nan) for s in series]) - means
            gaps = np.isnan(values)
            values[gaps] = 0.0
            _apply(steps, values, gaps)
            return pd.DataFrame(values + means, columns=[f"_{i}" for i in range(len(columns))])

        typed = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in columns})
        open_ = F.contains(_gaps(columns), F.lit("1"))
        partial = typed.where(open_).withColumn("_filled", filled(*[F.col(f"`{c}`") for c in columns]))
        return typed.where(~open_).unionByName(partial.select(*[
            F.coalesce(F.col(f"`{c}`"), F.col(f"_filled._{columns.index(c)}")).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]))


def impute_iterative(df: DataFrame, columns: Sequence[str], rounds: int = 10, tolerance: float = 1e-3) -> DataFrame:
    """Fill the gaps of a table by regressions learned from it."""
    return IterativeImputer.fit(df, columns, rounds, tolerance).transform(df)
