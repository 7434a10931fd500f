"""Approximate nearest neighbours by largest inner product: one navigable
small-world graph per shard, results merged.

Equal vectors are one node with a list of their ids, so a crowd of copies costs
one place. Inner products become distances by one more component (the root of
what a vector's squared length lacks to the longest one's), so the usual graph
search applies. The graph holds vectors divided by the largest component and
the longest length, so that values of any size fit its single precision. A shard's graph is two kinds of flat arrays: neighbours of each
node in the ground layer, and of the few nodes in each upper layer. Nodes are
inserted in growing batches: a batch is searched in the graph so far, all of it
at once, and also sees itself. Shards are rows of a table (arrays as binaries);
the stated queries visit every shard in blocks, and a query's best per shard
are merged by window. Reported scores are exact, in double precision, from the
original vectors; equal scores go to the smaller id.

Inner products beyond double precision are infinite and tie; one whose terms
overflow both ways counts as minus infinity. Vectors that are null, zero, of another length than the most frequent one, or
hold null or non-finite components take no part. Repeated ids: one of the rows
takes part (the smallest vector). Fewer candidates than asked for: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.common import stored

SHARD_VECTORS = 8_000
LINKS = 16
BUILD_WIDTH = 64
SEARCH_WIDTH = 128
BLOCK = 256


def vectors_of(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): usable vectors as doubles, one row for each id."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    rows = rows.select(F.col(f"`{key}`").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (size["n"] if size else -1)).groupBy("id").agg(F.min("v").alias("v"))


class Graph:
    """Flat arrays: points, levels, ground neighbours, and the upper layers."""

    def __init__(self, points: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 7):
        self.points = points.astype(np.float32)
        self.square = (self.points * self.points).sum(axis=1)
        n = len(points)
        level = np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(links)).astype(np.int64)
        if n:
            level[0] = level.max()
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []  # members in order of insertion, their neighbours
        for layer in range(int(level.max()) + 1 if n else 0):
            members = np.flatnonzero(level >= layer)
            self.layers.append((members, self._build(members, 2 * links if layer == 0 else links, width)))

    def _near(self, a: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distances (squared, less the query's own length) from each query to its own list of points."""
        return self.square[rows] - 2 * np.matmul(self.points[rows], a[:, :, None])[:, :, 0]

    def _build(self, members: np.ndarray, links: int, width: int) -> np.ndarray:
        n = len(members)
        around = np.full((n, links), -1, np.int32)
        done = min(n, max(2 * links, 64))
        if n > 1:
            self._tie(members, around, np.arange(done), *self._brute(members, np.arange(done), np.arange(done), links))
        while done < n:
            new = np.arange(done, min(n, done + max(32, min(done // 2, 2048))))
            for start in range(0, len(new), BLOCK):
                part = new[start:start + BLOCK]
                old, far = self._walk(members, around, self.points[members[part]], np.zeros((len(part), 1), np.int64), width)
                far[old >= done] = np.inf  # the batch's own rows come from the direct comparison
                own, own_far = self._brute(members, part, new, min(links, len(new)))
                ids, dist = np.concatenate([old, own], axis=1), np.concatenate([far, own_far], axis=1)
                order = np.argsort(dist, axis=1, kind="stable")[:, :width]
                self._tie(members, around, part, np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1))
            done = int(new[-1]) + 1
        return around

    def _brute(self, members, rows, among, k):
        a, b = self.points[members[rows]], self.points[members[among]]
        dist = self.square[members[among]][None, :] - 2 * a @ b.T
        dist[rows[:, None] == among[None, :]] = np.inf
        k = min(k, len(among))
        best = np.argpartition(dist, k - 1, axis=1)[:, :k]
        return np.where(np.isinf(np.take_along_axis(dist, best, 1)), -1, among[best]), np.take_along_axis(dist, best, 1)

    def _choose(self, members, rows: np.ndarray, ids: np.ndarray, links: int) -> np.ndarray:
        """For each row, of its candidates (-1: none): first those nearer to the row
        than to any chosen one, then the nearest of the rest."""
        points = self.points[members[np.maximum(ids, 0)]]
        square = self.square[members[np.maximum(ids, 0)]]
        own = self.square[members[rows]][:, None] + square - 2 * np.matmul(points, self.points[members[rows]][:, :, None])[:, :, 0]
        own[ids < 0] = np.inf
        order = np.argsort(own, axis=1, kind="stable")[:, : 3 * links]
        ids, own, square = (np.take_along_axis(x, order, 1) for x in (ids, own, square))
        points = np.take_along_axis(points, order[:, :, None], 1)
        between = square[:, :, None] + square[:, None, :] - 2 * np.matmul(points, points.transpose(0, 2, 1))
        free, chosen = ids >= 0, np.zeros(ids.shape, bool)
        count = np.zeros(len(ids), np.int64)
        for i in range(ids.shape[1]):
            take = free[:, i] & (count < links)
            chosen[:, i] = take
            count += take
            free &= ~(take[:, None] & (between[:, i] < own))
        turn = np.where(chosen, 0, ids.shape[1]) + np.arange(ids.shape[1]) + np.where(ids < 0, 4 * ids.shape[1], 0)
        out = np.take_along_axis(ids, np.argsort(turn, axis=1)[:, :links], 1)
        return np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)

    def _tie(self, members, around, rows, ids, dist) -> None:
        """Link new rows with what was found, both ways; a full list keeps a spread choice."""
        links = around.shape[1]
        ids = np.where(np.isfinite(dist), ids, -1)
        held = around[rows].astype(np.int64)  # links from rows of the same batch
        held = np.where((held[:, :, None] == ids[:, None, :]).any(axis=2), -1, held)
        around[rows] = self._choose(members, rows, np.concatenate([ids, held], axis=1), links)
        other, row = around[rows].ravel().astype(np.int64), np.repeat(rows, links)
        row, other = row[other >= 0], other[other >= 0]
        far = self.square[members[row]] - 2 * np.einsum("ij,ij->i", self.points[members[row]], self.points[members[other]])
        order = np.lexsort((far, other))
        row, other = row[order], other[order]
        targets, first, count = np.unique(other, return_index=True, return_counts=True)
        place = np.arange(len(other)) - np.repeat(first, count)
        incoming = np.full((len(targets), min(int(count.max(initial=0)), 2 * links)), -1, np.int64)
        kept = place < incoming.shape[1]
        incoming[np.repeat(np.arange(len(targets)), count)[kept], place[kept]] = row[kept]
        for start in range(0, len(targets), BLOCK):
            part, new = targets[start:start + BLOCK], incoming[start:start + BLOCK]
            held = around[part].astype(np.int64)
            new = np.where((new[:, :, None] == held[:, None, :]).any(axis=2), -1, new)
            around[part] = self._choose(members, part, np.concatenate([held, new], axis=1), links)

    def _walk(self, members, around, queries, entry, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search for a block of queries at once: (places, distances) of the nearest ``width``."""
        count, n = len(queries), len(members)
        width = min(width, n)
        queries = queries.astype(np.float32)
        seen = np.zeros((count, n), bool)
        ids = np.full((count, width), -1, np.int64)
        dist = np.full((count, width), np.inf, np.float32)
        open_ = np.zeros((count, width), bool)
        take = min(entry.shape[1], width)
        ids[:, :take] = entry[:, :take]
        dist[:, :take] = self._near(queries, members[entry[:, :take]])
        open_[:, :take] = True
        np.put_along_axis(seen, entry[:, :take], True, 1)
        active = np.arange(count)
        while len(active):
            waiting = np.where(open_[active], dist[active], np.inf)
            step = waiting.argmin(axis=1)
            alive = np.isfinite(waiting[np.arange(len(active)), step])
            active, step = active[alive], step[alive]
            if not len(active):
                break
            open_[active, step] = False
            near = around[ids[active, step]].astype(np.int64)
            fresh = (near >= 0) & ~seen[active[:, None], near]
            q, k = np.nonzero(fresh)
            seen[active[q], near[q, k]] = True
            far = np.full(near.shape, np.inf, np.float32)
            rows = members[near[q, k]]
            far[q, k] = self.square[rows] - 2 * np.einsum("ij,ij->i", self.points[rows], queries[active[q]])
            all_dist = np.concatenate([dist[active], far], axis=1)
            best = np.argpartition(all_dist, width - 1, axis=1)[:, :width]
            dist[active] = np.take_along_axis(all_dist, best, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1), best, 1)
            open_[active] = np.take_along_axis(np.concatenate([open_[active], fresh], axis=1), best, 1)
        return ids, dist

    def search(self, queries: np.ndarray, width: int = SEARCH_WIDTH) -> np.ndarray:
        """Nodes near each query, -1 where there are fewer than ``width``."""
        if not self.layers:
            return np.full((len(queries), 0), -1, np.int64)
        entry = np.zeros((len(queries), 1), np.int64)
        for layer in range(len(self.layers) - 1, -1, -1):
            members, around = self.layers[layer]
            found, dist = self._walk(members, around, queries, entry, width if layer == 0 else 8)
            nodes = np.where(found >= 0, members[np.maximum(found, 0)], -1)
            if layer:
                top = nodes[np.arange(len(queries)), dist.argmin(axis=1)]
                entry = np.searchsorted(self.layers[layer - 1][0], top)[:, None]
        return nodes

    def pack(self) -> bytes:
        out = [np.array([len(self.points), self.points.shape[1], len(self.layers)], "<i4").tobytes(), self.points.astype("<f4").tobytes()]
        for members, around in self.layers:
            out += [np.array(around.shape, "<i4").tobytes(), members.astype("<i4").tobytes(), around.astype("<i4").tobytes()]
        return b"".join(out)

    @classmethod
    def unpack(cls, data: bytes) -> Graph:
        self = cls.__new__(cls)
        n, size, layers = np.frombuffer(data, "<i4", 3).tolist()
        at = 12
        self.points = np.frombuffer(data, "<f4", n * size, at).reshape(n, size)
        at += 4 * n * size
        self.square = (self.points * self.points).sum(axis=1)
        self.layers = []
        for _ in range(layers):
            rows, links = np.frombuffer(data, "<i4", 2, at).tolist()
            members = np.frombuffer(data, "<i4", rows, at + 8).astype(np.int64)
            around = np.frombuffer(data, "<i4", rows * links, at + 8 + 4 * rows).reshape(rows, links)
            at += 8 + 4 * rows + 4 * rows * links
            self.layers.append((members, around))
        return self


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Points whose distances from (q, 0) order vectors of length 1 at most by inner product with q."""
    rest = np.sqrt(np.maximum(1 - (vectors * vectors).sum(axis=1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def shards_of(vectors: DataFrame, shard_vectors: int) -> int:
    return max(1, -(-vectors.count() // shard_vectors))


def index(vectors: DataFrame, shards: int) -> DataFrame:
    """(shard, graph, vectors): one graph for each shard of distinct vectors, with the vectors as doubles."""
    largest = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x))))).first()[0] or 1.0
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / largest) * (x / largest))
    longest = vectors.agg(F.sqrt(F.max(length))).first()[0] or 1.0
    rows = vectors.select("v").distinct().withColumn("shard", F.pmod(F.xxhash64("v", F.lit("shard")), F.lit(shards)).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        data = np.stack(group["v"].to_numpy())
        data = data[np.lexsort(data.T[::-1])]
        data = data[np.random.default_rng(1).permutation(len(data))]
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "graph": [Graph(lifted(data / largest / longest)).pack()], "vectors": [data.astype("<f8").tobytes()]})

    return rows.groupBy("shard").applyInPandas(build, "shard int, graph binary, vectors binary")


def least_ids(vectors: DataFrame, k: int, salts: int = 64) -> DataFrame:
    """(v, ids): each distinct vector with its k smallest ids. Copies are first ranked in salted parts."""
    def few(rows: DataFrame, *keys) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy("id")
        return rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")

    rows = few(vectors.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts))), "v", "salt")
    return few(rows, "v").groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k ids at most


def _visit(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """A shard's best distinct vectors for each query of a block. One more is kept
    than asked for: the query's own vector may be among them."""
    last, graph, exact = None, None, None
    for batch in batches:
        for shard, packed, data, ids, asked in zip(*(batch.column(i) for i in range(5))):
            if shard.as_py() != last:
                last, graph = shard.as_py(), Graph.unpack(packed.as_py())
                exact = np.frombuffer(data.as_py(), "<f8").reshape(len(graph.points), -1)
            ids, asked = np.array(ids.as_py()), np.array(asked.as_py(), np.float64)
            for start in range(0, len(ids), BLOCK):
                q = asked[start:start + BLOCK]
                unit = q / np.abs(q).max(axis=1, keepdims=True)
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                found = graph.search(np.concatenate([unit, np.zeros((len(q), 1))], axis=1), width)
                with np.errstate(over="ignore", invalid="ignore"):
                    score = np.einsum("ijk,ik->ij", exact[np.maximum(found, 0)], q)
                score[(found < 0) | np.isnan(score)] = -np.inf
                # equal scores at the edge all stay: ids decide between them later
                edge = np.sort(score, axis=1)[:, ::-1][:, min(k, score.shape[1] - 1)]
                row, col = np.nonzero((score >= edge[:, None]) & (found >= 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[start:start + BLOCK][row]), pa.array([exact[n] for n in found[row, col]], pa.list_(pa.float64())), pa.array(score[row, col])],
                    names=["query_id", "v", "score"])


def search(vectors: DataFrame, queries: Column, k: int = 20, shard_vectors: int = SHARD_VECTORS, width: int = SEARCH_WIDTH, asked_block: int = 1024) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found for each row of (id, v) that ``queries`` names."""
    vectors = stored(vectors, "vectors")
    shards = shards_of(vectors, shard_vectors)
    graphs = stored(index(vectors, shards), "graphs")
    asked = vectors.where(queries)
    blocks = max(1, -(-asked.count() // asked_block))
    asked = asked.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).agg(F.collect_list("id").alias("ids"), F.collect_list("v").alias("asked"))
    visits = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    pairs = graphs.join(visits, "shard").select("shard", "graph", "vectors", "ids", "asked")
    found = pairs.mapInArrow(lambda b: _visit(b, k, width), "query_id bigint, v array<double>, score double")
    # Distinct vectors first (a crowd of copies is one row), then the ids that share each vector.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    found = stored(found.withColumn("place", F.rank().over(best)).where(F.col("place") <= k + 1).drop("place"), "nearest")
    copies = least_ids(vectors, k + 1)
    rows = found.join(copies, "v").select("query_id", F.explode("ids").alias("id"), "score").where("id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
