"""Exact top-k by inner product with M-trees.

Vectors are rounded down to integers and given one more component, sqrt(M^2 - |x|^2), that a query has as 0; M is the
largest norm in a shard. Distance then falls as the inner product rises, and it is a metric.

1. A sample of at most ``sample`` rows (by the smallest hash) and ``SAMPLE_NUMBERS`` numbers goes to all tasks; some of it
   are the shards' pivots, as many as there are times ``shard_rows`` rows. A row goes to the shard of its nearest pivot;
   a shard is a ball with a covering radius, and one with too many rows is dealt over several by a hash.
2. A query's tenth best score in the sample is a bound for its answer. It goes only to the shards whose balls can hold a
   score as good, and takes the bound along.
3. Each shard's task builds a tree of pages: a node has a pivot, a covering radius and its distance to its parent's pivot.
   A query goes best first through the nodes by the least distance that their balls allow, and what the triangle inequality
   rules out by stored distances is not computed. Scores are computed in integers.
4. A query's best from its shards are ranked at the end.

The sample bears on the work only: every row is in a shard, and no shard is left out that can have an answer.

Defined cases: vectors that are null or have null or non-finite components, and rows without an id, take no part. Vectors
are compared with vectors of their length only. Rows that repeat an id are candidates each, except for the query of that
id; of queries that repeat an id one is taken. A query without candidates has no rows. Ties go to the smaller id. An empty
table gives an empty result; other columns are ignored.
Components must be small enough for scores to be exact in a double (|x| below 2**20 for 64 components).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import table, tidy

PAGE = 128


class Node:
    """A page. ``to_parent`` is the pivot's distance to the parent's pivot; a leaf has rows and their distances."""

    __slots__ = ("pivot", "radius", "to_parent", "children", "rows", "distances", "pivots", "radii", "to_pivot")

    def __init__(self, pivot: np.ndarray, to_parent: float):
        self.pivot, self.to_parent, self.radius = pivot, to_parent, 0.0
        self.children: list[Node] = []
        self.rows = self.distances = self.pivots = self.radii = self.to_pivot = None


class MTree:
    """Bulk-loaded tree over integer vectors (as doubles) with ids; ``distances_computed`` counts the work."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, page: int = PAGE, fanout: int = 16):
        order = np.argsort(ids, kind="stable")
        self.vectors, self.ids, self.page, self.fanout = vectors[order], ids[order], page, fanout
        norms = (self.vectors**2).sum(axis=1)
        self.top = float(norms.max()) if len(norms) else 0.0
        self.points = np.hstack([self.vectors, np.sqrt(self.top - norms)[:, None]])
        self.distances_computed = 0
        self.rng = np.random.default_rng(11)
        self.root = self._build(np.arange(len(ids)), self.points[0], 0.0) if len(ids) else None

    def _build(self, rows: np.ndarray, pivot: np.ndarray, to_parent: float) -> Node:
        node = Node(pivot, to_parent)
        distances = np.sqrt(((self.points[rows] - pivot) ** 2).sum(axis=1))
        node.radius = float(distances.max())
        parts = self._split(rows) if len(rows) > self.page else None
        if parts is None:
            order = np.argsort(distances, kind="stable")
            node.rows, node.distances = rows[order], distances[order]
            return node
        for part, center in parts:
            node.children.append(self._build(part, center, float(np.sqrt(((center - pivot) ** 2).sum()))))
        node.pivots = np.array([c.pivot for c in node.children])
        node.radii = np.array([c.radius for c in node.children])
        node.to_pivot = np.array([c.to_parent for c in node.children])
        return node

    def _split(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows by their nearest of some pivots; rows that are all alike are cut by number."""
        count = min(self.fanout, -(-len(rows) // self.page) + 1)
        chosen = self.points[np.sort(self.rng.choice(rows, size=count, replace=False))]
        points = self.points[rows]
        near = ((points**2).sum(axis=1)[:, None] - 2 * points @ chosen.T + (chosen**2).sum(axis=1)).argmin(axis=1)
        parts = [(rows[near == i], chosen[i]) for i in range(count) if (near == i).any()]
        if len(parts) == 1:
            return [(rows[i : i + self.page], self.points[rows[i]]) for i in range(0, len(rows), self.page)]
        return parts

    def search(self, query: np.ndarray, own: int, k: int, worst: float = -math.inf) -> list[tuple[int, int]]:
        """(score, id) of the best k of at least ``worst``, without rows of id ``own``."""
        if self.root is None:
            return []
        size = float((query**2).sum())
        point = np.append(query, 0.0)
        # distance^2 = size + top - 2 * score; the margin covers rounding of stored distances
        margin = 1e-6 * (1.0 + math.sqrt(size + self.top))
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        limit = math.inf if worst == -math.inf else math.sqrt(max(0.0, size + self.top - 2.0 * worst))
        first = float(np.sqrt(((self.root.pivot - point) ** 2).sum()))
        heap = [(max(0.0, first - self.root.radius), 0, first, self.root)]
        number = 0
        while heap:
            bound, _, distance, node = heapq.heappop(heap)
            if bound > limit + margin:
                break
            if node.rows is not None:
                low, high = np.searchsorted(node.distances, [distance - limit - margin, distance + limit + margin]) if limit < math.inf else (0, len(node.rows))
                rows = node.rows[low:high]
                if not len(rows):
                    continue
                self.distances_computed += len(rows)
                scores = self.vectors[rows] @ query
                ids = self.ids[rows]
                least = best[0][0] if len(best) == k else worst
                for i in np.flatnonzero((scores >= least) & (ids != own)).tolist():
                    entry = (int(scores[i]), -int(ids[i]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    limit = math.sqrt(max(0.0, size + self.top - 2.0 * best[0][0]))
                continue
            ahead = np.abs(distance - node.to_pivot) - node.radii <= limit + margin
            which = np.flatnonzero(ahead)
            self.distances_computed += len(which)
            there = np.sqrt(((node.pivots[which] - point) ** 2).sum(axis=1))
            for i, d, b in zip(which.tolist(), there.tolist(), np.maximum(there - node.radii[which], 0.0).tolist(), strict=True):
                if b <= limit + margin:
                    number += 1
                    heapq.heappush(heap, (b, number, d, node.children[i]))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
#: The sample has at most so many numbers.
SAMPLE_NUMBERS = 2_000_000


def _vectors(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    lists = batch.column(column)
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return [flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _far_apart(vectors: np.ndarray, most: int) -> list[int]:
    """Rows of which each is as far as can be from those before it; no two are alike."""
    chosen, distances = [0], ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(chosen) < most and distances.max() > 0:
        chosen.append(int(distances.argmax()))
        distances = np.minimum(distances, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
    return chosen


class Sample:
    """Vectors of some rows by their length; up to ``pivots`` of each length, far apart, name shards."""

    def __init__(self, rows: list[tuple[int, list[int]]], pivots: int):
        self.ids: dict[int, np.ndarray] = {}
        self.vectors: dict[int, np.ndarray] = {}
        self.pivots: dict[int, np.ndarray] = {}
        for n in {len(v) for _, v in rows}:
            mine = [(i, v) for i, v in rows if len(v) == n]
            self.ids[n] = np.array([i for i, _ in mine], dtype=np.int64)
            self.vectors[n] = np.array([v for _, v in mine], dtype=np.float64).reshape(len(mine), n)
            self.pivots[n] = self.vectors[n][_far_apart(self.vectors[n], pivots)]

    def nearest(self, v: np.ndarray) -> tuple[int, float]:
        """The pivot that a vector belongs to and its distance; -1 where the sample has no vector of this length."""
        if len(v) not in self.pivots:
            return -1, 0.0
        distances = ((self.pivots[len(v)] - v) ** 2).sum(axis=1)
        i = int(distances.argmin())
        return i, math.sqrt(float(distances[i]))

    def bound(self, v: np.ndarray, own: int, k: int) -> float:
        """A score that the k-th best row has at least."""
        if len(v) not in self.vectors:
            return -math.inf
        scores = np.sort((self.vectors[len(v)] @ v)[self.ids[len(v)] != own])
        return float(scores[-k]) if len(scores) >= k else -math.inf


DEALT = pa.schema([("n", pa.int32()), ("pivot", pa.int32()), ("id", pa.int64()), ("v", pa.list_(pa.int64())), ("distance", pa.float64())])


def _deal(sample: Sample):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch, 1)
            found = [sample.nearest(v) for v in vectors]
            made = [pa.array([len(v) for v in vectors], pa.int32()), pa.array([p for p, _ in found], pa.int32()), batch.column(0), batch.column(1), pa.array([d for _, d in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(made, names=DEALT.names)

    return run


ASKED = pa.schema([("shard", pa.string()), ("id", pa.int64()), ("v", pa.list_(pa.int64())), ("bound", pa.float64())])


def _ask(sample: Sample, balls: dict[int, list[tuple[int, float, int]]], k: int):
    """Queries -> a row for each shard that may hold one of the best k; balls: (pivot, radius, parts) by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows, bounds = [], [], []
            for row, (own, v) in enumerate(zip(batch.column(0).to_pylist(), _vectors(batch, 1), strict=True)):
                bound, size = sample.bound(v, own, k), float(np.sqrt((v**2).sum()))
                for pivot, radius, parts in balls.get(len(v), []):
                    if bound > -math.inf and pivot >= 0:
                        best = float(sample.pivots[len(v)][pivot] @ v) + size * radius
                        if best + 1e-6 * (1.0 + abs(best)) < bound:
                            continue
                    names += [f"{len(v)}:{pivot}:{part}" for part in range(parts)]
                    rows += [row] * parts
                    bounds += [bound] * parts
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column(0).take(at), batch.column(1).take(at), pa.array(bounds, pa.float64())], names=ASKED.names)

    return run


def _answers(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, kind, id, v, bound) come by shard, candidates before queries."""
        key, held, tree = None, [], None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for name, kind, i, vector, bound in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), _vectors(batch, 3), batch.column(4).to_pylist(), strict=True):
                if name != key:
                    key, held, tree = name, [], None
                if kind == 0:
                    held.append((i, vector))
                    continue
                if tree is None:
                    tree = MTree(np.array([v for _, v in held]).reshape(len(held), len(vector)), np.array([j for j, _ in held], dtype=np.int64))
                    held = []
                out.extend((i, j, s) for s, j in tree.search(vector, i, k, bound))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], type=pa.int64()) for i in range(3)], schema=FOUND)

    return run


def integers(vector: Column, factor: int = 1024) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def routes(vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int, sample: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows (shard, id, v), queries (shard, id, v, bound), and the number of shards."""
    rows, longest = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    taken = max(1, min(sample, SAMPLE_NUMBERS // max(1, longest)))
    chosen = vectors.select("id", "v").orderBy(F.xxhash64("id", "v"), "id").limit(taken).collect()
    seen = Sample([(r["id"], r["v"]) for r in chosen], -(-rows // shard_rows))
    dealt = vectors.select("id", "v").mapInArrow(tidy(_deal(seen)), "n int, pivot int, id long, v array<long>, distance double")
    # At most one row for each pivot, and one for each length that the sample has not.
    balls: dict[int, list[tuple[int, float, int]]] = {}
    for r in dealt.groupBy("n", "pivot").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("rows")).collect():
        balls.setdefault(r["n"], []).append((r["pivot"], r["radius"] * (1 + 1e-9), -(-r["rows"] // shard_rows)))
    shards = sum(parts for v in balls.values() for _, _, parts in v)
    sizes = vectors.sparkSession.createDataFrame([(n, p, parts) for n, v in balls.items() for p, _, parts in v if parts > 1], "_n int, _p int, parts int")
    dealt = dealt.join(F.broadcast(sizes), (F.col("n") == F.col("_n")) & (F.col("pivot") == F.col("_p")), "left")
    part = F.pmod(F.xxhash64("id", "v"), F.coalesce("parts", F.lit(1)))
    asked = queries.groupBy("id").agg(F.min("v").alias("v")).mapInArrow(tidy(_ask(seen, balls, k)), "shard string, id long, v array<long>, bound double")
    return dealt.select(F.concat_ws(":", "n", "pivot", part).alias("shard"), "id", "v"), asked, shards


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 8192, sample: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's best ``k`` of ``vectors``; both have ``id`` and an integer ``v``."""
    rows, asked, shards = routes(vectors, queries, k, shard_rows, sample)
    both = rows.select("shard", F.lit(0).alias("kind"), "id", "v", F.lit(None).cast("double").alias("bound")).unionByName(asked.withColumn("kind", F.lit(1)))
    # one shard to a partition as far as can be, so that tasks are alike
    found = both.repartition(max(1, shards), "shard").sortWithinPartitions("shard", "kind", "id").mapInArrow(tidy(_answers(k)), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part."""
    rows = vectors.select(vectors[id_column].cast("long").alias("id"), vectors[vector_column].alias("e")).filter("id IS NOT NULL AND e IS NOT NULL")
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return rows.filter(sound).select("id", integers(F.col("e")).alias("v"))


def op3_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of every hundredth embedding among all others."""
    rows = usable(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.filter("id % 100 = 0"), 10)


SQL = """
WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.id AS query_id, c.id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.id % 100 = 0 AND q.id <> c.id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
