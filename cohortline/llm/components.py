"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import discard, stored

SALTS = 8


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and its neighbours. A hub's edges are dealt over several keys."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = least.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # By shuffle: one broadcast per round would fill the driver.
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(least.hint("merge"), ["u", "salt"]).drop("salt")


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component): the least node reachable, for every node with an edge to another node."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = _with_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        old, edges = edges, stored(small.where("u != v").distinct(), "stars")
        discard(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def with_component(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Rows of the column class with comp, the class's component or itself."""
    return rows.join(label, F.col("class") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "class")).drop("node", "component")


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links: they join whole components, so only those are worked on."""
    ends = with_component(links.select("a", "b", F.explode(F.array("a", "b")).alias("class")), label)
    ends = ends.groupBy("a", "b").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    joined = components(ends.select(F.col("low").alias("a"), F.col("high").alias("b"))).withColumnsRenamed({"node": "comp", "component": "least"})
    old = label.join(joined, label["component"] == joined["comp"], "left").select("node", F.coalesce("least", "component").alias("component"))
    # Classes that had no link so far are their own components.
    new = joined.join(label, joined["comp"] == label["node"], "left_anti").select(F.col("comp").alias("node"), F.col("least").alias("component"))
    return stored(old.unionByName(new), "labels")


def in_turns(
    label: DataFrame, found: DataFrame, verified: Callable[[DataFrame], DataFrame], candidates: Callable[[DataFrame, bool], DataFrame],
) -> DataFrame:
    """The components after all links among candidates.

    ``found`` are forests of likely pairs (a, b); ``candidates`` gives those of
    the components now, as forests or all of them. Forests are verified as long
    as they join anything, so a group costs its members and not their pairs;
    then all pairs left between different components are.
    """
    last = False
    while True:
        links = stored(verified(found.where("a != b")), "links")
        none = links.isEmpty()
        if not none:
            label = merged(label, links)
        if last:
            return label
        last = none
        found = candidates(label, not last)
        if found.isEmpty():
            return label
