"""Connected components of an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import group_count, written

#: Edges that a task contracts by itself.
TASK_EDGES = 250_000
#: Edges a file of a round has about, so that a few edges are not spread over all shuffle partitions.
FILE_EDGES = 20_000


class Union:
    """Union-find over numbers; the root of a set is its smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        low, high = min(a, b), max(a, b)
        self.parent[high] = low
        self.parent.setdefault(low, low)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's own edges as stars around its smallest nodes."""
    union = Union()
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            union.join(u, v)
    nodes = [n for n in union.parent if union.find(n) != n]
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([union.find(n) for n in nodes], pa.int64())], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component: smallest node of it) for every node of ``edges`` (u, v: long).

    Tasks first contract ``TASK_EDGES`` edges each, however many partitions those came in; then rounds of two joins by node go on until
    every component is a star. Each round is written to the shared folder, in few files where it is small (``FILE_EDGES``).
    """
    edges = written(edges.where("u <> v").select("u", "v"))
    count = edges.count()
    files = group_count(count, FILE_EDGES)
    edges = edges.coalesce(group_count(count, TASK_EDGES)).mapInArrow(_stars, "u long, v long")
    edges, before = written(edges.distinct()), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        edges = written(
            small.select("u", F.col("low").alias("v"))
            .unionByName(small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")))
            .distinct()
            .coalesce(files)
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
