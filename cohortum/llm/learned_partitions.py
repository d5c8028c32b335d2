"""Approximate nearest neighbours by learned partitions.

A bounded sample of the distinct vectors is joined into a neighbour graph, the graph is cut into
balanced parts (recursive halving at the median of its leading non-trivial eigenvector), and a
small classifier learns the parts, each sample vector with the shares of its neighbours' parts as
soft label. The classifier then puts every vector into a part and sends each query to its most
probable parts; how many is the smallest number that reaches the wanted recall on sample vectors
that the classifier did not learn from. There all vectors are ranked by the exact inner product.

Equal vectors are one entry of the index with the ``k + 1`` smallest identifiers, which are all
that any query can need, so a vector that a third of the rows share makes no large part. Parts are
dealt into cells of bounded size, which only says where the work is done.

Defined cases: rows without identifier, and vectors that are null, zero or hold a null or
non-finite component, take no part; shorter vectors end in zeros; a query's own identifier is no
candidate of it; repeated identical query rows are one query; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortum.llm.common import best, blocks, matrix, usable_vectors
from cohortum.sources.tables import materialise

SAMPLE, PARTS, NEIGHBOURS, HIDDEN, ROUNDS, RECALL = 6144, 32, 16, 96, 40, 0.97
CELL, QUERIES, TOGETHER = 8192, 2048, 256
FOUND = "query_id bigint, query_key bigint, vec_id bigint, score double"


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer from a vector to the probabilities of the parts."""

    mean: np.ndarray
    spread: float
    weights: tuple[np.ndarray, ...]
    probes: int

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return softmax(np.tanh((rows - self.mean) / self.spread @ w1 + b1) @ w2 + b2)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def neighbour_graph(rows: np.ndarray, degree: int) -> np.ndarray:
    """For each row the places of its nearest others by inner product."""
    found = []
    for start in range(0, len(rows), 512):
        scores = rows[start : start + 512] @ rows.T
        scores[np.arange(len(scores)), start + np.arange(len(scores))] = -np.inf
        found.append(np.argpartition(-scores, degree - 1, axis=1)[:, :degree])
    return np.concatenate(found)


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """Cut the graph into ``parts`` (a power of two) equal parts along few edges."""
    size = len(graph)
    links = np.zeros((size, size), dtype=np.float32)
    links[np.repeat(np.arange(size), graph.shape[1]), graph.ravel()] = 1
    links = np.maximum(links, links.T)
    label = np.zeros(size, dtype=np.int64)
    noise = np.random.default_rng(7)
    for _ in range(parts.bit_length() - 1):
        cut = np.zeros(size, dtype=np.int64)
        for part in np.unique(label):
            own = np.flatnonzero(label == part)
            inner = links[np.ix_(own, own)]
            root = np.sqrt(inner.sum(axis=1) + 1)
            even = root / np.linalg.norm(root)
            x = noise.standard_normal(len(own)).astype(np.float32)
            for _ in range(60):
                x -= even * (even @ x)
                x = (inner @ (x / root) + x / root) / root + x
                x /= np.linalg.norm(x) or 1
            cut[own[np.argsort(x, kind="stable")[len(own) // 2 :]]] = 1
        label = 2 * label + cut
    return label


def fit_router(rows: np.ndarray, parts: int = PARTS, recall: float = RECALL) -> Router:
    """Learn the parts of the sample's neighbour graph."""
    rows = rows.astype(np.float32)
    width = rows.shape[1]
    while parts > 1 and len(rows) < 16 * parts:
        parts //= 2
    mean, spread = rows.mean(axis=0), float(rows.std()) or 1.0
    noise = np.random.default_rng(11)
    weights = [
        (noise.standard_normal((width, HIDDEN)) / np.sqrt(width)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        (noise.standard_normal((HIDDEN, parts)) / np.sqrt(HIDDEN)).astype(np.float32),
        np.zeros(parts, np.float32),
    ]
    if parts == 1:
        return Router(mean, spread, tuple(weights), 1)
    graph = neighbour_graph(rows, NEIGHBOURS)
    label = balanced_parts(graph, parts)
    target = np.zeros((len(rows), parts), np.float32)
    for column in graph.T:
        target[np.arange(len(rows)), label[column]] += 1 / (graph.shape[1] + 4)
    target[np.arange(len(rows)), label] += 4 / (graph.shape[1] + 4)
    learn = noise.permutation(len(rows))
    tested, learn = learn[: len(rows) // 6], learn[len(rows) // 6 :]
    scaled = (rows - mean) / spread
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(ROUNDS):
        noise.shuffle(learn)
        for start in range(0, len(learn), 256):
            batch = learn[start : start + 256]
            hidden = np.tanh(scaled[batch] @ weights[0] + weights[1])
            error = (softmax(hidden @ weights[2] + weights[3]) - target[batch]) / len(batch)
            back = (error @ weights[2].T) * (1 - hidden**2)
            step += 1
            slopes = (scaled[batch].T @ back, back.sum(0), hidden.T @ error, error.sum(0))
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[i] -= rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    router = Router(mean, spread, tuple(weights), parts)
    chances = router.probabilities(rows)
    placed = chances.argmax(axis=1)
    order = np.argsort(-chances[tested], axis=1)
    rank_of_part = np.argsort(order, axis=1)
    needed = np.take_along_axis(rank_of_part, placed[graph[tested]], axis=1)
    shares = [(needed < probes).mean() for probes in range(1, parts + 1)]
    probes = next(i for i, share in enumerate(shares, 1) if share >= recall or i == parts)
    return Router(mean, spread, tuple(weights), probes)


def routed(batches: Iterator[pa.RecordBatch], router: Router, probes: int) -> Iterator[pa.RecordBatch]:
    """Add to each row its ``probes`` most probable parts."""
    for batch in batches:
        chances = router.probabilities(matrix(batch["embedding"], len(router.mean)))
        top = np.argsort(-chances, axis=1, kind="stable")[:, :probes].astype(np.int32)
        parts = pa.FixedSizeListArray.from_arrays(pa.array(top.ravel()), top.shape[1])
        lists = parts.cast(pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "parts"])


def search_cell(cell: pa.Table, k: int, width: int) -> pa.Table:
    """The best ``k`` candidates of a cell for each of its queries."""
    is_query = cell["is_query"].to_numpy(zero_copy_only=False).astype(bool)
    asked, offered = cell.filter(pa.array(is_query)), cell.filter(pa.array(~is_query))
    offered = offered.take(pa.array(np.argsort(offered["vec_id"].to_numpy(), kind="stable")))
    same = [np.array(x) for x in offered["same"].to_pylist()]
    rows, queries = matrix(offered["embedding"], width), matrix(asked["embedding"], width)
    query_ids, keys = asked["vec_id"].to_numpy(), asked["query_key"].to_numpy()
    out: list[tuple] = []
    for start in range(0, len(queries) if len(rows) else 0, TOGETHER):
        for at, scores in enumerate(queries[start : start + TOGETHER] @ rows.T, start):
            chosen = best(scores, k + 1)
            ids = np.concatenate([same[i] for i in chosen])
            values = np.repeat(scores[chosen], [len(same[i]) for i in chosen])
            others = ids != query_ids[at]
            ids, values = ids[others], values[others]
            kept = np.lexsort((ids, -values))[:k]
            size = len(kept)
            out.append((np.full(size, query_ids[at]), np.full(size, keys[at]), ids[kept], values[kept]))
    columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 4
    kinds = [pa.int64()] * 3 + [pa.float64()]
    return pa.table(
        [pa.array(x.astype(kind.to_pandas_dtype())) for x, kind in zip(columns, kinds)],
        ["query_id", "query_key", "vec_id", "score"],
    )


def nearest_by_learned_partitions(
    vectors: DataFrame, is_query: Column, k: int, sample: int = SAMPLE
) -> DataFrame:
    """The ``k`` nearest found of every query row among all other rows.

    ``sample`` bounds the distinct vectors from which the partition is learned, chosen by a hash.
    """
    rows = usable_vectors(vectors).where(F.exists("embedding", lambda x: x != 0))
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    index = materialise(
        rows.dropDuplicates(["vec_id", "embedding"])
        .withColumn("place", F.row_number().over(smallest))
        .where(F.col("place") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("same"))
        .withColumn("vec_id", F.col("same")[0])
    )
    learned = index.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()
    width = index.agg(F.max(F.size("embedding"))).first()[0] or 1
    router = fit_router(matrix(learned["embedding"], width)) if learned.num_rows else None
    if router is None:
        return index.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    def add_parts(frame: DataFrame, probes: int) -> DataFrame:
        kinds = ", ".join(f"{name} {kind}" for name, kind in frame.dtypes)
        return frame.mapInArrow(lambda it: routed(it, router, probes), f"{kinds}, parts array<int>")

    offered = materialise(
        add_parts(index, 1).select("vec_id", "same", "embedding", F.col("parts")[0].alias("part"))
    )
    asked = materialise(
        add_parts(
            rows.where(is_query)
            .dropDuplicates(["vec_id", "embedding"])
            .withColumn("query_key", F.xxhash64("embedding")),
            router.probes,
        ).withColumn("part", F.explode("parts")).drop("parts")
    )
    # One row for each part, of which there is a fixed number.
    sizes = {r["part"]: r["count"] for r in offered.groupBy("part").count().collect()}
    calls = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}
    numbers = lambda counts, most: F.array(
        *[F.lit(blocks(counts.get(part, 0), most)) for part in range(PARTS)]
    )[F.col("part")]
    down, across = numbers(sizes, CELL), numbers(calls, QUERIES)
    place = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cells = offered.select(
        "part", place(down).alias("down"), every(across).alias("across"),
        F.lit(False).alias("is_query"), F.lit(0).cast("bigint").alias("query_key"),
        "vec_id", "same", "embedding",
    ).unionByName(
        asked.select(
            "part", every(down).alias("down"), place(across).alias("across"),
            F.lit(True).alias("is_query"), "query_key",
            "vec_id", F.array().cast("array<bigint>").alias("same"), "embedding",
        )
    )
    found = cells.groupBy("part", "down", "across").applyInArrow(
        lambda cell: search_cell(cell, k, width), FOUND
    )
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
