"""Profiles, rates, histograms and correlations of wide tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline import defaults as D
from cohortline.functions.quantiles import exact_quantiles
from cohortline.functions.scalar import band


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """All columns but identifiers, dates, the label and ``exclude``."""
    skip = {*D.NON_FEATURES, *exclude}
    return [c for c in df.columns if c not in skip]


def select_features(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*feature_columns(df, exclude))


def unpivot_one(row: DataFrame, names: Sequence[str], fields: dict[str, str], key: str = "column_name") -> DataFrame:
    """Turn a one-row aggregate with columns ``prefix:name`` into one row per name."""
    entries = [
        F.struct(F.lit(n).alias(key), *[F.col(f"`{prefix}:{n}`").alias(out) for out, prefix in fields.items()])
        for n in names
    ]
    return row.select(F.inline(F.array(*entries)))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and ratio per column, plus the total; one pass over the table."""
    names = df.columns
    missing = lambda c: F.count_if(F.col(c).isNull())
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[missing(c).alias(f"n:{c}") for c in names])
    total = sum((F.col(f"`n:{c}`") for c in names[1:]), F.col(f"`n:{names[0]}`"))
    row = row.withColumn("n:(total)", total).withColumns({
        **{f"r:{c}": F.try_divide(F.col(f"`n:{c}`").cast("double"), F.col("_rows")) for c in names},
        "r:(total)": F.try_divide(total.cast("double"), F.col("_rows") * len(names)),
    })
    return unpivot_one(row, [*names, "(total)"], {"null_count": "n", "null_ratio": "r"})


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    aggregates = []
    for c in columns:
        v = F.col(c).cast("double")
        aggregates += [
            F.count(v).alias(f"count:{c}"), F.avg(v).alias(f"mean:{c}"), F.stddev_samp(v).alias(f"std:{c}"),
            F.min(v).alias(f"min:{c}"), F.max(v).alias(f"max:{c}"),
        ]
    row = df.agg(*aggregates).withColumns({
        f"{name}:{c}": F.lit(quartiles[c][i]).cast("double")
        for c in columns for i, name in enumerate(("q25", "q50", "q75"))
    })
    fields = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")
    return unpivot_one(row, columns, {f: f for f in fields})


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    found = exact_quantiles(df, columns, probabilities)
    rows = [(c, float(p), v) for c in columns for p, v in zip(probabilities, found[c])]
    return df.sparkSession.createDataFrame(rows, "column_name string, probability double, value double")


def distinct_count(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact counts group (column, value) pairs first: duplicates collapse before
    the shuffle and a heavy value is one row afterwards.
    """
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"n:{c}") for c in columns])
        return unpivot_one(row, columns, {"distinct_count": "n"})
    counts = category_counts(df, columns).groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(counts, "column_name", "left").select(
        "column_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("distinct_count")
    )


def category_counts(df: DataFrame, columns: Sequence[str], label: str | None = None) -> DataFrame:
    """Rows (and label sums) per (column, value), nulls excluded, in one scan."""
    extra = [F.col(label).cast("double").alias("_label")] if label else []
    pairs = df.select(
        F.explode(F.array_compact(F.array(*[
            F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
            for c in columns
        ]))).alias("pair"), *extra,
    )
    aggregates = [F.count(F.lit(1)).alias("n")]
    if label:
        aggregates += [F.sum("_label").alias("label_sum"), F.count("_label").alias("label_n")]
    return pairs.groupBy("pair.column_name", "pair.value").agg(*aggregates)


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if not normalize:
        return counts
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def group_mean(df: DataFrame, column: str, label: str = D.LABEL) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.avg(label).alias("mean"), F.count(label).alias("n"))
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of each pair (lower triangle); each pair uses its complete rows.

    One ``corr`` aggregate per pair outgrows generated code at a dozen columns,
    so Arrow batches are reduced to sums of centered products by matrix
    products, a few rows per batch, and Spark adds those up.
    """
    columns = list(columns or numeric_columns(df))
    numbers = df.select([F.col(c).cast("double").alias(c) for c in columns])
    center = numbers.agg(*[F.avg(c).alias(c) for c in columns]).first()
    middle = np.array([center[c] if center[c] is not None else 0.0 for c in columns])
    upper = np.triu_indices(len(columns), 1)

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((6, len(columns), len(columns)))
        for batch in batches:
            values = batch.to_numpy(dtype=float, na_value=np.nan) - middle
            known = ~np.isnan(values)
            x, m = np.where(known, values, 0.0), known.astype(float)
            squares = x * x
            sums += [m.T @ m, x.T @ m, m.T @ x, squares.T @ m, m.T @ squares, x.T @ x]
        yield pd.DataFrame({
            "i": upper[0].astype("int32"), "j": upper[1].astype("int32"),
            **{name: part[upper] for name, part in zip(("n", "sa", "sb", "saa", "sbb", "sab"), sums)},
        })

    parts = numbers.mapInPandas(reduce, "i int, j int, n double, sa double, sb double, saa double, sbb double, sab double")
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n = F.col("n")
    covariance = n * F.col("sab") - F.col("sa") * F.col("sb")
    spread = F.sqrt(n * F.col("saa") - F.col("sa") ** 2) * F.sqrt(n * F.col("sbb") - F.col("sb") ** 2)
    names = F.array(*map(F.lit, columns))
    return total.select(
        F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"),
        F.try_divide(covariance, spread).alias("r"),
    )


def rate_with_without(df: DataFrame, indicators: Sequence[str], label: str = D.LABEL) -> DataFrame:
    """Label mean among rows with and without each indicator; one pass."""
    row = df.agg(*[
        F.avg(F.when(F.col(c) == v, F.col(label))).alias(f"{name}:{c}")
        for c in indicators for v, name in ((1, "with"), (0, "without"))
    ])
    return unpivot_one(row, indicators, {"rate_with": "with", "rate_without": "without"}, key="indicator")


def histogram_by_label(df: DataFrame, column: str, label: str = D.LABEL, bins: int = 30) -> DataFrame:
    """Equal-width bins between each label's own extremes, last bin closed.

    A label without spread gets the interval half a unit around its value.
    """
    rows = df.select(F.col(label).alias("label"), F.col(column).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & F.col("label").isNotNull()
    )
    span = rows.groupBy("label").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    span = span.select("label", (F.col("lo") - flat).alias("_lo"), ((F.col("hi") + flat - (F.col("lo") - flat)) / bins).alias("_width"))
    position = F.least(F.floor((F.col("v") - F.col("_lo")) / F.col("_width")), F.lit(bins - 1)).cast("int")
    return (
        rows.join(span, "label")
        .groupBy("label", position.alias("bin"), (F.col("_lo") + F.col("_width") * position).alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rate_by_band(
    df: DataFrame, column: str = "age", label: str = D.LABEL,
    edges: Sequence[float] = D.AGE_EDGES, labels: Sequence[str] = D.AGE_RANGE_LABELS,
) -> DataFrame:
    """Label mean per right-closed band; empty bands stay with a null rate."""
    found = (
        df.groupBy(band(F.col(column), edges, labels, right=True).alias("band"))
        .agg(F.avg(label).alias("rate"), F.count(label).alias("n"))
    )
    bands = df.sparkSession.createDataFrame([(b,) for b in labels], "band string")
    return bands.join(found, "band", "left").select("band", "rate", F.coalesce("n", F.lit(0)).alias("n"))


def target_distribution(df: DataFrame, label: str = D.LABEL) -> DataFrame:
    """Rows per label and the overall percentage of positives, in one grouping."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    share = counts.agg(100.0 * F.sum(F.col("label") * F.col("n")) / F.sum("n")).scalar()
    return counts.withColumn("percent_positive", share)


def null_to_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null and NaN become 0 in the numeric feature columns."""
    columns = set(columns or numeric_columns(df))
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def zero(c: str) -> Column:
        value = F.nanvl(F.col(c), F.lit(0.0)) if c in floating else F.col(c)
        return F.coalesce(value, F.lit(0)).cast(df.schema[c].dataType).alias(c)
    return df.select([zero(c) if c in columns else F.col(c) for c in df.columns])


def filter_subject(df: DataFrame, value, subject: str = D.SUBJECT) -> DataFrame:
    """Rows of one subject; no row is an error, as asking for an unknown id is."""
    found = df.filter(F.col(subject) == F.lit(value))
    if found.isEmpty():
        raise ValueError(f"subject {value!r} not found")
    return found


def fill_defaults(df: DataFrame, rules: dict = D.FIELD_RULES) -> DataFrame:
    """Serving vector: fixed column order, missing fields at their usual value.

    Columns that are not features (ids, label) pass through in front.
    """
    required = [n for n, (_, _, default) in rules.items() if default is None]
    absent = [n for n in required if n not in df.columns]
    if absent:
        raise ValueError(f"required fields absent: {absent}")

    def field(name: str, default) -> Column:
        value = F.col(name).cast("double") if name in df.columns else F.lit(None).cast("double")
        if default is None:
            return value.alias(name)
        return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(float(default))).alias(name)

    others = [c for c in df.columns if c not in rules]
    return df.select(*others, *[field(n, default) for n, (_, _, default) in rules.items()])


def range_check(df: DataFrame, rules: dict = D.FIELD_RULES) -> DataFrame:
    """Add ``invalid_fields``: names outside their closed interval, or required and null."""
    def broken(name: str, low, high, default) -> Column:
        if name not in df.columns:
            return F.lit(default is None)
        value = F.col(name).cast("double")
        return F.coalesce((value < low) | (value > high) | F.isnan(value), F.lit(default is None))

    names = F.array_compact(F.array(*[
        F.when(broken(n, low, high, default), F.lit(n)) for n, (low, high, default) in rules.items()
    ]))
    return df.withColumn("invalid_fields", names)


def split_valid(df: DataFrame, rules: dict = D.FIELD_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the check column, rejected rows with it)."""
    checked = range_check(df, rules)
    good = F.size("invalid_fields") == 0
    return checked.filter(good).drop("invalid_fields"), checked.filter(~good)
