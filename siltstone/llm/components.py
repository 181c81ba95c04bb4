"""Connected components of links.

Up to ``at_once`` links, counted before, are solved in the memory of one task; more by rounds of large and small stars, all
of them joins and aggregates. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Labels of nodes 0 .. n - 1 under links (a, b): the least node of each node's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            shorter = new[new]
            if (shorter == new).all():
                break
            new = shorter
        if (new == label).all():
            break
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
    if not parts:
        return
    ends = np.concatenate([np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])])
    nodes, where = np.unique(ends, return_inverse=True)
    label = forest(where[: len(where) // 2], where[len(where) // 2 :], len(nodes))
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], names=["node", "root"])


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Each node's larger (or, if small, smaller) neighbours are linked with the least of it and its neighbours."""
    both = links if small else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
    joined = both.join(least, both["a"] == least["of"])
    if small:
        out = joined.select(F.col("b").alias("x"), "m").union(joined.select(F.col("a").alias("x"), "m"))
    else:
        out = joined.filter("b > a").select(F.col("b").alias("x"), "m")
    return out.filter("x != m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def components(links: DataFrame, at_once: int = 1_000_000) -> DataFrame:
    """(node, root) of all nodes of ``links`` (a, b) but roots; the root is the least node that can be reached."""
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b"))
    if links.count() <= at_once:
        return cut(links.coalesce(1).mapInArrow(_solve, "node long, root long"))
    links = cut(links.distinct())
    state = None
    while True:  # the stars settle after some log(n) ** 2 rounds at most
        mark = links.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if mark == state or mark[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = mark
        links = cut(_star(_star(links, small=False), small=True))
