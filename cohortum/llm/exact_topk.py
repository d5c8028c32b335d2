"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors become whole numbers, ``floor(256 * x)``, and each component is a term. Queries and
candidates are dealt into blocks of bounded size; for each pair of a query block and a candidate
block one task turns the candidates into posting lists, and the sparse query rows scatter their
weighted postings, term after term, into dense score arrays. Partition selection keeps the best of
a block, and the blocks' lists are merged by query.

Defined cases: rows without an identifier, or whose vector is null or holds a null or non-finite
component, take no part; shorter vectors have zeros where others have components; an empty vector
scores 0 everywhere; repeated candidate rows are candidates each; a query's own identifier is no
candidate of it; repeated identical query rows are one query; an empty table gives no rows. A
score that no long can hold stops the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortum.llm.common import best, blocks, matrix, usable_vectors

SCALE = 256
CANDIDATES, QUERIES, TOGETHER = 8192, 2048, 64
FOUND = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


def postings(weights: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Term, rows that hold it and their weights, for each term that any row holds."""
    for term in range(weights.shape[1]):
        rows = np.flatnonzero(weights[:, term])
        if len(rows):
            yield term, rows, weights[rows, term]


def accumulate(queries: np.ndarray, lists: list, candidates: int) -> np.ndarray:
    """Scores of all candidates for a few query rows."""
    scores = np.zeros((len(queries), candidates), dtype=np.int64)
    for term, rows, weights in lists:
        if term >= queries.shape[1]:
            continue
        active = np.flatnonzero(queries[:, term])
        added = np.multiply.outer(queries[active, term], weights)
        if len(active) == len(queries) and len(rows) == candidates:
            scores += added
        else:
            scores[np.ix_(active, rows)] += added
    return scores


def whole_numbers(column: pa.ChunkedArray) -> np.ndarray:
    scaled = np.floor(SCALE * matrix(column))
    if np.abs(scaled).max(initial=0) >= 2.0**62:
        raise ArithmeticError("a component times 256 exceeds a long")
    return scaled.astype(np.int64)


def search_cell(cell: pa.Table, k: int) -> pa.Table:
    """The best ``k`` candidates of a block for each query of a block."""
    is_query = cell["is_query"].to_numpy(zero_copy_only=False).astype(bool)
    asked, offered = cell.filter(pa.array(is_query)), cell.filter(pa.array(~is_query))
    offered = offered.take(pa.array(np.argsort(offered["vec_id"].to_numpy(), kind="stable")))
    ids, keys = offered["vec_id"].to_numpy(), asked["query_key"].to_numpy()
    query_ids = asked["vec_id"].to_numpy()
    weights, queries = whole_numbers(offered["embedding"]), whole_numbers(asked["embedding"])
    top = float(np.abs(weights).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if top * max(1, weights.shape[1]) >= 2.0**62:
        raise ArithmeticError("a score may exceed a long")
    lists = list(postings(weights))
    own = np.iinfo(np.int64).min
    out: list[tuple] = []
    for start in range(0, len(queries), TOGETHER):
        scores = accumulate(queries[start : start + TOGETHER], lists, len(ids))
        for row, mine in enumerate(scores):
            at = start + row
            low, high = np.searchsorted(ids, [query_ids[at], query_ids[at] + 1])
            mine[low:high] = own
            chosen = best(mine, k)
            chosen = chosen[mine[chosen] != own]
            size = len(chosen)
            out.append((np.full(size, query_ids[at]), np.full(size, keys[at]), ids[chosen], mine[chosen]))
    columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
    return pa.table([pa.array(x, pa.int64()) for x in columns], ["query_id", "query_key", "vec_id", "score"])


def exact_topk(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The ``k`` highest integer inner products of every query row among all other rows."""
    rows = usable_vectors(vectors)
    asked = rows.where(is_query).dropDuplicates().withColumn("query_key", F.xxhash64("embedding"))
    down = blocks(rows.count(), CANDIDATES)
    across = blocks(rows.where(is_query).count(), QUERIES)
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    offered = rows.select(
        every(across).alias("across"), place(down).alias("down"), F.lit(False).alias("is_query"),
        F.lit(0).cast("bigint").alias("query_key"), "vec_id", "embedding",
    )
    asked = asked.select(
        place(across).alias("across"), every(down).alias("down"), F.lit(True).alias("is_query"),
        "query_key", "vec_id", "embedding",
    )
    found = (
        offered.unionByName(asked)
        .groupBy("across", "down")
        .applyInArrow(lambda cell: search_cell(cell, k), FOUND)
    )
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
