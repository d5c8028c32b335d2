"""Connected components of an edge table, with every step a bounded Spark job.

Edges are first contracted inside each partition, and those left again, up to ``TOGETHER`` at a
time; then large-star and small-star steps alternate until all that is left are stars. A step takes each node's smallest neighbour (combined before the shuffle)
and joins it back to the edges; both sides are stored, so that adaptive execution can split the
edges of a node that very many share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortum.llm.common import blocks
from cohortum.sources.tables import materialise

EDGES, TOGETHER = "a bigint, b bigint", 1 << 17


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars in place of the edges of a partition."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        path = []
        while (up := root.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            root[y] = x
        return x

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["a", "b"]
    )


def joined_to_smallest(pairs: DataFrame, smallest: DataFrame) -> DataFrame:
    return pairs.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def star_steps(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step; edges go from the larger to the smaller node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nearest = lambda e: materialise(e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    large = materialise(joined_to_smallest(both.where("b > a"), nearest(both)).distinct())
    smallest = nearest(large)
    small = joined_to_smallest(large, smallest).unionByName(
        smallest.where("m <> a").select("a", F.col("m").alias("b"))
    )
    return materialise(small.distinct())


def only_stars(edges: DataFrame) -> bool:
    """Whether each larger node has one edge, to a node that is no larger node itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    times = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return times.where("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that it is linked to, for every node but roots."""
    edges = materialise(edges.select("a", "b").where("a <> b").mapInArrow(contracted, EDGES))
    if left := edges.count():
        edges = materialise(edges.coalesce(blocks(left, TOGETHER)).mapInArrow(contracted, EDGES))
    while not only_stars(edges):
        edges = star_steps(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
