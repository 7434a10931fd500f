"""Merkle manifest of a table: one hash per row, a tree per group, a tree over the groups.

Levels are text. The nodes of a tree are cut into aligned blocks of ``BLOCK``
(16 x 16); a block keeps each of its levels as one string of 64 signs a node.
Parents are the hashes of substrings of 16 x 64 signs, and the siblings of a
node are the two substrings that flank it in its run. A tree with more nodes
than a block holds recurses: the last nodes of its blocks are the nodes of the
next tier. The groups' last nodes are the leaves of the tree over the groups,
built by the same functions, so no group and no list of groups ever stands in
one task: a task sees blocks of at most 256 nodes.

Places within a group come from a range partitioning by (group, key, leaf) and
the row counts of its partitions.

Defined results. Null values are written ``-`` and so differ from empty texts.
A null group is a group of its own, before all others; a null key comes first in
its group. Rows of the same key are ordered by their leaf, repeated rows are
leaves of their own. A tree of one node is that node. An empty table gives no
rows. Columns not named as fields are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.common import shuffle_partitions, stored

RUN = 16
BLOCK = RUN * RUN
WIDE = 64  # signs of a digest


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def written(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[written(v) for v in values])


def fold(node: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings, level by level."""
    return F.aggregate(path, node, lambda below, side: F.sha2(F.concat(side["l"], below, side["r"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, in its order."""
    return F.sha2(F.array_join(F.transform(path, lambda side: F.concat(side["l"], side["r"])), "").cast("binary"), 256)


def _placed(nodes: DataFrame, name: str, *order: str) -> DataFrame:
    """Nodes (g, node, own, ...) with pos, their place in g from 0, and n, the size of g. The given columns order a group."""
    by = ["g", *order]
    ranged = nodes.repartitionByRange(shuffle_partitions(nodes.sparkSession), *by).sortWithinPartitions(*by)
    rows = stored(ranged.withColumn("at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("part", F.shiftright("at", 33))  # the id counts rows in its lower 33 bits
    parts = rows.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    upto, every = Window.partitionBy("g").orderBy("part"), Window.partitionBy("g")
    parts = parts.withColumns({
        "before": F.sum("size").over(upto) - F.col("size") - F.col("first"),
        "n": F.sum("size").over(every),
    })
    rows = rows.join(parts.drop("size", "first"), ["g", "part"])
    return rows.select("g", (F.col("at") + F.col("before")).alias("pos"), "n", "node", "own")


def _parents(level: str) -> str:
    run = RUN * WIDE
    return (f"array_join(transform(sequence(1, length({level}), {run}), "
            f"at -> sha2(CAST(substring({level}, at, {run}) AS BINARY), 256)), '')")


def _tier(nodes: DataFrame, name: str) -> DataFrame:
    """One row per block: its levels as strings, what its nodes carry, and its last node."""
    blocks = nodes.groupBy("g", F.expr(f"pos DIV {BLOCK}").alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "node", "own"))).alias("nodes"))
    blocks = blocks.withColumn("level0", F.expr("array_join(transform(nodes, x -> x.node), '')"))
    blocks = blocks.withColumn("level1", F.expr(f"CASE WHEN n > 1 THEN {_parents('level0')} END"))
    blocks = blocks.withColumn("level2", F.expr(f"CASE WHEN n > {RUN} THEN {_parents('level1')} END"))
    return stored(blocks.select(
        "g", "block", "n", F.expr("transform(nodes, x -> x.own)").alias("owns"), "level0", "level1", "level2",
        F.coalesce("level2", "level1", "level0").alias("node")), name)


def _tree(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The tiers from the leaves up; in the last one each group has one block."""
    tiers = [_tier(nodes, name)]
    while (tiers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = tiers[-1].select(
            "g", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) DIV {BLOCK}").alias("n"), "node", F.lit(0).alias("own"))
        tiers.append(_tier(above, name))
    return tiers


def _sides(level: str, at: str) -> str:
    """The two substrings that flank node ``at`` of a level in its run."""
    left = f"substring({level}, ({at} - {at} % {RUN}) * {WIDE} + 1, ({at} % {RUN}) * {WIDE})"
    right = f"substring({level}, ({at} + 1) * {WIDE} + 1, ({RUN - 1} - {at} % {RUN}) * {WIDE})"
    return f"struct({left} AS l, {right} AS r)"


def _opened(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """(g, pos, node, own, path, ...) of the leaves; ``top`` has for each g the path above its tree and further columns."""
    more = [c for c in top.columns if c not in ("g", "path")]
    above = top.withColumn("pos", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        rows = tier.drop("node").join(above.withColumnRenamed("pos", "block"), ["g", "block"])
        own = f"""transform(owns, (own, at) -> struct(
            block * {BLOCK} + at AS pos, substring(level0, at * {WIDE} + 1, {WIDE}) AS node, own,
            concat(CASE WHEN level2 IS NOT NULL THEN array({_sides('level0', 'at')}, {_sides('level1', f'(at DIV {RUN})')})
                        WHEN level1 IS NOT NULL THEN array({_sides('level0', 'at')})
                        ELSE CAST(array() AS ARRAY<STRUCT<l: STRING, r: STRING>>) END, path) AS path))"""
        above = rows.select("g", *more, F.expr(f"inline({own})")).select("g", "pos", "node", "own", "path", *more)
        if tier is not tiers[0]:
            above = above.drop("node", "own")
    return above


@dataclass
class Manifest:
    """The written levels of the trees of all groups and of the tree over them."""

    groups: list[DataFrame]
    over: list[DataFrame]

    def proofs(self) -> DataFrame:
        """One row per leaf: own (the carried columns), leaf, path (siblings by level: left, right), subroot, root."""
        root = self.over[-1].select("g", F.col("node").alias("root"), F.expr("CAST(array() AS ARRAY<STRUCT<l: STRING, r: STRING>>)").alias("path"))
        groups = _opened(self.over, root).select(F.col("own").alias("g"), F.col("node").alias("subroot"), "path", "root")
        return _opened(self.groups, groups).select("own", F.col("node").alias("leaf"), "path", "subroot", "root")


def build(
    docs: DataFrame, fields: Sequence[Column], key: Column, group: Column, carry: dict[str, Column] | None = None,
) -> Manifest:
    """Hash and arrange all rows. ``fields`` make a leaf; ``carry`` names columns to keep beside it."""
    carried = F.struct(*[c.alias(n) for n, c in (carry or {"key": key}).items()])
    # A key that is never null and keeps the order: null first, then by UTF-8 bytes.
    g = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    leaves = stored(docs.select(g.alias("g"), key.alias("key"), leaf(*fields).alias("node"), carried.alias("own")), "leaves")
    groups = _tree(_placed(leaves, "placed-leaves", "key", "node"), "tree")
    tops = groups[-1].select(F.lit("").alias("g"), "node", F.col("g").alias("own"))
    return Manifest(groups, _tree(_placed(tops, "placed-groups", "own"), "tree-over"))
