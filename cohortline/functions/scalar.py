"""Column expressions for bands, scores, interactions and risk levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortline import defaults as D


def band(
    value: Column, edges: Sequence[float] = D.AGE_EDGES, labels: Sequence[str] = D.AGE_LABELS,
    right: bool = False,
) -> Column:
    """Label of the bin holding ``value``: ``[lo, hi)`` or, with ``right``, ``(lo, hi]``."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > low) & (value <= high) if right else (value >= low) & (value < high)
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def buckets(value: Column, bounds: Sequence[tuple[float, str]], top: str) -> Column:
    """First label whose bound exceeds the value; null stays null."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in bounds:
        out = out.when(value < bound, F.lit(label))
    return out.otherwise(F.lit(top))


def risk_level(probability: Column) -> Column:
    return buckets(probability, D.RISK_BOUNDS, D.RISK_TOP)


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _present(columns: Sequence[str], *needed: str) -> bool:
    return all(c in columns for c in needed)


def charlson_index(columns: Sequence[str], weights: Mapping[str, int] = D.CHARLSON_WEIGHTS) -> Column:
    """Weighted indicators plus one point per full decade of age over 40."""
    terms = [F.coalesce(F.col(c), F.lit(0)) * w for c, w in weights.items() if c in columns]
    if "age" in columns:
        decades = F.when(F.col("age") > 40, F.floor((F.col("age") - 40) / 10)).otherwise(F.lit(0))
        terms.append(decades)
    return sum(terms[1:], terms[0]).cast("int") if terms else F.lit(0)


def elixhauser_score(columns: Sequence[str], indicators: Sequence[str] = D.ELIXHAUSER_INDICATORS) -> Column:
    terms = [F.coalesce(F.col(c), F.lit(0)) for c in indicators if c in columns]
    return sum(terms[1:], terms[0]).cast("int") if terms else F.lit(0)


def interactions(columns: Sequence[str]) -> dict[str, Column]:
    """Products of clinical columns, each only where its inputs exist."""
    col = F.col
    rules = {
        "age_charlson_interaction": (("age", "charlson_index"), lambda: col("age") * col("charlson_index")),
        "bmi_diabetes_interaction": (("bmi", "has_diabetes"), lambda: col("bmi") * col("has_diabetes")),
        "rate_pressure_product": (
            ("heart_rate", "blood_pressure_systolic"),
            lambda: col("heart_rate") * col("blood_pressure_systolic") / 1000,
        ),
        "utilization_burden": (
            ("length_of_stay", "num_prior_admissions"),
            lambda: col("length_of_stay") * (1 + col("num_prior_admissions")),
        ),
        "metabolic_stress_index": (("creatinine", "glucose"), lambda: col("creatinine") * col("glucose") / 100),
    }
    return {name: make() for name, (needed, make) in rules.items() if _present(columns, *needed)}


def polynomials(
    columns: Sequence[str], names: Sequence[str] = D.POLYNOMIAL_COLUMNS, degree: int = 2,
) -> dict[str, Column]:
    return {
        f"{c}_pow{d}": F.pow(F.col(c), F.lit(d))
        for c in names if c in columns for d in range(2, degree + 1)
    }
