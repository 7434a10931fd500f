"""Category -> statistic lookups that stay safe for large or skewed vocabularies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def map_lookup(
    df: DataFrame,
    table: DataFrame,
    column: str,
    values: Mapping[str, object],
    key: str = "value",
    broadcast_rows: int = BROADCAST_ROWS,
    weight: str | None = None,
    heavy: int = 1_000,
    rows: int | None = None,
) -> DataFrame:
    """Add columns of ``table`` looked up by ``column``, with a default on a miss.

    ``values`` maps table columns to defaults. A table of at most
    ``broadcast_rows`` rows (counted here unless ``rows`` is known from fitting)
    is broadcast. A larger one is joined
    by shuffle, except that its ``heavy`` most frequent keys (by ``weight``)
    are looked up through a small broadcast, so no frequent key is shuffled.
    Null keys never reach a shuffle.
    """
    right = table.select(F.col(key).alias("_lookup_key"), *values, *([weight] if weight and weight not in values else []))

    def finish(joined: DataFrame) -> DataFrame:
        return joined.select(*df.columns, *[F.coalesce(F.col(f"_r.{c}"), F.lit(d)).alias(c) for c, d in values.items()])

    def left_join(left: DataFrame, side: DataFrame) -> DataFrame:
        return left.join(side.alias("_r"), F.col(column).cast("string") == F.col("_r._lookup_key"), "left")

    if rows is None:
        rows = right.limit(broadcast_rows + 1).count()
    if rows <= broadcast_rows:
        return finish(left_join(df, F.broadcast(right)))
    if weight is None:
        keyed = df.filter(F.col(column).isNotNull())
        return finish(left_join(keyed, right)).unionByName(_defaults(df, column, values))
    top = F.broadcast(right.orderBy(F.desc(weight), "_lookup_key").limit(heavy))
    is_top = F.col(column).cast("string") == F.col("_lookup_key")
    frequent = finish(df.join(top.alias("_r"), F.col(column).cast("string") == F.col("_r._lookup_key")))
    others = df.filter(F.col(column).isNotNull()).join(top.select("_lookup_key"), is_top, "left_anti")
    return frequent.unionByName(finish(left_join(others, right))).unionByName(_defaults(df, column, values))


def _defaults(df: DataFrame, column: str, values: Mapping[str, object]) -> DataFrame:
    return df.filter(F.col(column).isNull()).select(*df.columns, *[F.lit(d).alias(c) for c, d in values.items()])
