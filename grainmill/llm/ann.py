"""Approximate nearest neighbours by inner product: a hierarchical small-world graph per shard.

Distinct vectors are dealt to shards by hash; a task builds the graph of a shard, kept as flat
neighbour arrays, one row per node and level, streams the queries through it and gives each
query's best; the shards' results are merged by score. Every valid row is indexed.

A task holds the graphs of a few shards, so a query is sent once to a task and not once to a shard.
Graphs are small because recall falls with their size: of random directions in 64 dimensions, the
hardest case, a graph of 8,000 finds 0.97 of the two nearest at the beam below, one of 16,000 finds
0.92, and the twenty nearest of a table are spread over its shards.

Vectors of a shard get one more coordinate that brings them all to the same length, so that the
largest inner product is the nearest neighbour of an ordinary metric, on which the graph is built.
Scores are computed in double precision from the original vectors. Of rows with one and the same
vector, however many, only the first k + 1 ids can be among the k nearest, so no more leave their
task.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

#: Neighbours of a node on upper levels (twice as many on the lowest), and beams for building and searching.
LINKS, BUILD_BEAM, SEARCH_BEAM = 14, 72, 128
#: Vectors that a shard holds at most on average, the shards of a task, and the fewest tasks.
SHARD_ROWS, SHARDS_A_TASK, LEAST_TASKS = 8_000, 4, 12


class Graph:
    """Hierarchical navigable small world over the rows of a matrix, nearness being their inner product."""

    def __init__(self, rows: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.original = rows
        wide = rows.astype(np.float64)
        square = (wide * wide).sum(axis=1)
        level = np.minimum((-np.log(1 - rng.random(len(rows))) / math.log(links)).astype(int), 12)
        # Highest levels first: the nodes of a level are the first rows of every array.
        self.order = np.argsort(-level, kind="stable")
        self.points = np.ascontiguousarray(np.column_stack([wide, np.sqrt(np.maximum(square.max() - square, 0))])[self.order], np.float32)
        level = level[self.order]
        self.size = [int((level >= n).sum()) for n in range(int(level[0]) + 1)]
        self.room = [links * 2 if n == 0 else links for n in range(len(self.size))]
        self.near = [np.full((size, room), -1, np.int32) for size, room in zip(self.size, self.room)]
        self.used = [np.zeros(size, np.int32) for size in self.size]
        self.seen = np.zeros(len(rows), np.int32)
        self.stamp = 0
        self.links, self.beam = links, beam
        for node in range(1, len(rows)):
            self._insert(node, int(level[node]))

    def _search(self, point: np.ndarray, level: int, entry: list[tuple[float, int]], beam: int) -> list[tuple[float, int]]:
        """Best nodes of a level as (nearness, node), best first."""
        self.stamp += 1
        seen, stamp, near, used, points = self.seen, self.stamp, self.near[level], self.used[level], self.points
        for _, node in entry:
            seen[node] = stamp
        todo = [(-s, node) for s, node in entry]
        heapq.heapify(todo)
        best = list(entry)
        heapq.heapify(best)
        while todo:
            score, node = heapq.heappop(todo)
            if -score < best[0][0] and len(best) >= beam:
                break
            others = near[node, : used[node]]
            others = others[seen[others] != stamp]
            if not len(others):
                continue
            seen[others] = stamp
            scores = points[others] @ point
            if len(best) >= beam:
                better = scores > best[0][0]
                others, scores = others[better], scores[better]
            for s, other in zip(scores.tolist(), others.tolist()):
                if len(best) < beam:
                    heapq.heappush(best, (s, other))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, other))
                else:
                    continue
                heapq.heappush(todo, (-s, other))
        return sorted(best, reverse=True)

    def _spread(self, scores: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Of nodes, best first, those nearer to the point than to one chosen before; the rest fill up."""
        if len(nodes) <= most:
            return nodes
        points = self.points[nodes]
        apart = points @ points.T > scores[:, None]
        free, chosen = np.ones(len(nodes), bool), []
        at = 0
        while len(chosen) < most:
            chosen.append(at)
            free &= ~apart[:, at]
            free[: at + 1] = False
            at = int(free.argmax())
            if not free[at]:
                break
        if len(chosen) < most:
            rest = np.ones(len(nodes), bool)
            rest[chosen] = False
            chosen += np.flatnonzero(rest)[: most - len(chosen)].tolist()
        return nodes[chosen]

    def _insert(self, node: int, level: int) -> None:
        point = self.points[node]
        entry = [(float(self.points[0] @ point), 0)]
        top = max(n for n, size in enumerate(self.size) if size) if node else 0
        for n in range(top, level, -1):
            entry = self._search(point, n, entry, 1)
        for n in range(level, -1, -1):
            found = self._search(point, n, entry, self.beam)
            scores, nodes = np.array([s for s, _ in found], np.float32), np.array([x for _, x in found], np.int32)
            chosen = self._spread(scores, nodes, self.links)
            near, used, room = self.near[n], self.used[n], self.room[n]
            near[node, : len(chosen)] = chosen
            used[node] = len(chosen)
            for other in chosen.tolist():
                count = used[other]
                if count < room:
                    near[other, count] = node
                    used[other] = count + 1
                    continue
                all_ = np.append(near[other, :count], np.int32(node))
                s = self.points[all_] @ self.points[other]
                order = np.argsort(-s, kind="stable")
                kept = self._spread(s[order], all_[order], room)
                near[other, : len(kept)] = kept
                used[other] = len(kept)
            entry = found

    def search(self, query: np.ndarray, beam: int) -> np.ndarray:
        """Rows found for a query, in no order."""
        point = np.append(query.astype(np.float32), np.float32(0))
        entry = [(float(self.points[0] @ point), 0)]
        for n in range(len(self.size) - 1, 0, -1):
            entry = self._search(point, n, entry, 1)
        return self.order[[node for _, node in self._search(point, 0, entry, beam)]]


def inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed by itself."""
    return (rows.astype(np.float64) * query.astype(np.float64)).sum(axis=1)


def valid(vec: str) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _search_tasks(k: int, beam: int):
    def run(batches):
        task, held, graphs = None, {}, {}
        for batch in batches:
            names = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if names[a] != task:
                    task, held, graphs = names[a], {}, {}
                part = batch.slice(a, b - a)
                vec = part.column(4)
                flat, bounds = vec.flatten().to_numpy(), np.append(0, np.cumsum(vec.value_lengths().to_numpy()))
                out: list[tuple] = []
                for n, (shard, query, own) in enumerate(zip(*(part.column(c).to_pylist() for c in (1, 2, 3)))):
                    v = flat[bounds[n] : bounds[n + 1]]
                    if query is None:
                        ids, rows = held.setdefault(len(v), {}).setdefault(shard, ([], []))
                        ids.append(own)
                        rows.append(v)
                        continue
                    if len(v) not in graphs:
                        graphs[len(v)] = [(ids, Graph(np.array(rows), seed=shard)) for shard, (ids, rows) in held.pop(len(v), {}).items()]
                    near: list[tuple[float, int]] = []
                    for ids, graph in graphs[len(v)]:
                        found = graph.search(v, max(beam, k + 1))
                        scores = inner(graph.original[found], v)
                        near += ((-s, i) for s, x in zip(scores.tolist(), found.tolist()) for i in ids[x] if i != query)
                    out += [(query, i, -s) for s, i in heapq.nsmallest(k, near)]
                if out:
                    q, i, s = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])

    return run


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k rows of ``df`` found with the largest inner product to each row of ``queries``, rows with the query's own id left out.

    One row per neighbour: query_id, rank (from 1), vec_id, score; nearest first, ties to the
    smaller id. Vectors that are null, zero or hold null or non-finite components take no part, nor
    do rows without an id; vectors of another dimension than the query's are no candidates. Rows
    with equal id and vector count once; an empty table gives an empty result; other columns are
    ignored.
    """
    rows = df.where(F.col(id_col).isNotNull() & valid(vec_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    first = rows.withColumn("rank", F.expr("dense_rank() over (partition by vec order by id)")).where(F.col("rank") <= k + 1)
    distinct = checkpoint(first.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids")))
    shards = max(LEAST_TASKS, -(-distinct.count() // shard_rows))
    tasks = max(LEAST_TASKS, -(-shards // SHARDS_A_TASK))
    asked = queries.where(F.col(id_col).isNotNull() & valid(vec_col)).select(F.col(id_col).cast("long").alias("query"), F.col(vec_col).alias("vec")).distinct()
    shard = F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int")
    here = distinct.select((shard % tasks).alias("task"), shard.alias("shard"), F.lit(None).cast("long").alias("query"), "ids", "vec")
    every = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))
    there = asked.select(every.alias("task"), F.lit(None).cast("int").alias("shard"), "query", F.lit(None).cast("array<long>").alias("ids"), "vec")
    dealt = here.unionByName(there).repartitionById(tasks, "task").sortWithinPartitions("task", F.col("query").asc_nulls_first(), "shard", F.get("ids", F.lit(0)))
    found = dealt.mapInArrow(_search_tasks(k, beam), "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
