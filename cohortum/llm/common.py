"""What several operators of this folder share: tables, Arrow columns, ranked selection."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortum.llm.wordcache import give_back


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Identifier and text alone, so that no other column can clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: remainder 1 of the identifier's checksum by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows, in order, with about ``most`` bytes of text at most, so that what a step makes
    of them does not grow with a batch, which may hold a whole partition."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end
    give_back()


def blocks(rows: int, most: int) -> int:
    """Number of blocks of about ``most`` rows."""
    return max(1, -(-rows // most))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """Rows with an identifier and a vector whose components are all present and finite."""
    bad = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad
    )


def matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    width = width or int(sizes.max(initial=0))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, places] = flat
    return out


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores of one row, ties to the smaller place."""
    if len(scores) <= k:
        chosen = np.arange(len(scores))
    else:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > limit)
        chosen = np.concatenate([above, np.flatnonzero(scores == limit)[: k - len(above)]])
    return chosen[np.lexsort((chosen, -scores[chosen]))]


def share_code(spark: SparkSession) -> None:
    """Let Python workers on this machine find this package where it is not installed."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
