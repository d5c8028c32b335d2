"""Token ids in files: frequency-ranked ids, byte-aligned codes of variable length.

An id is replaced by its place among all ids ordered by how often the corpus holds them, so that
frequent ids are small numbers. A number takes the fewest whole bytes that hold it, one to four;
how many is kept apart, in control bytes of two bits for each of four numbers. Decoding looks each
control byte up in a table of four lengths, and needs no loop over the numbers.

The files are Parquet tables in ascending order of ``doc_id`` (rows of one by how their texts begin,
null first): a row is a
block of whole documents with their identifiers, numbers of ids, control bytes and data bytes; the
ranked vocabulary is a table beside them. Spark writes and reads both, so lost executors do no
harm. Texts are tokenised once: the first pass stores plain 16- or 32-bit ids with the counts of
ids of each block, the second recodes them.

Defined cases: a null or empty text has only the end id; repeated rows are written each; a null
``doc_id`` comes first; an empty table gives empty files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortum.llm.common import texts
from cohortum.llm.tokens import encoder
from cohortum.llm.wordcache import groups
from cohortum.sources.tables import shared_folder

BLOCK_CHARACTERS, HEAD = 4 << 20, 64
PLAIN = "shard int, block int, doc_ids array<bigint>, sizes array<bigint>, ids binary, seen array<int>, times array<bigint>"
CODED = "shard int, block int, n_ids bigint, doc_ids array<bigint>, sizes array<bigint>, control binary, data binary"
LENGTHS = np.stack([np.arange(256) >> shift & 3 for shift in (0, 2, 4, 6)], axis=1).astype(np.uint8) + 1
LOW_BYTES = np.array([2 ** (8 * n) - 1 for n in range(5)], dtype=np.uint32)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    codes = np.zeros(-(-len(numbers) // 4) * 4, dtype=np.uint8)
    for byte in (1, 2, 3):
        codes[: len(numbers)] += numbers >= 1 << 8 * byte
    ends = np.cumsum(codes[: len(numbers)], dtype=np.int64) + np.arange(1, len(numbers) + 1)
    starts = ends - codes[: len(numbers)] - 1
    # A byte that a number does not have is overwritten by those of the numbers after it.
    data = np.zeros((int(ends[-1]) if len(ends) else 0) + 3, dtype=np.uint8)
    for byte in range(int(codes.max(initial=0)), -1, -1):
        data[starts + byte] = (numbers >> np.uint32(8 * byte)).astype(np.uint8)
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.tobytes(), data[:-3].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers of ``pack``."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    # The four bytes from each place on, of which those that follow a number go.
    four = np.ndarray((len(data) + 1,), "<u4", data + bytes(4), strides=(1,))
    return four[starts] & LOW_BYTES[sizes]


def tokenised(batches: Iterator[pa.RecordBatch], path: str, spaced: bool, end_id: int) -> Iterator[pa.RecordBatch]:
    """Blocks of plain ids with the counts of their ids."""
    tokens, block = encoder(path, spaced), 0
    width = "<u2" if max(tokens.size, end_id + 1) <= 1 << 16 else "<u4"
    shard = TaskContext.get().partitionId()
    end = np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        doc_ids, found = batch["doc_id"], batch["text"].to_pylist()
        for start, some in groups(found, BLOCK_CHARACTERS):
            rows = [ids + end for ids in tokens.encode(some)]
            ids = np.frombuffer(b"".join(rows), dtype="<u4")
            counts = np.bincount(ids)
            seen = np.flatnonzero(counts)
            times = counts[seen]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "doc_ids": pa.array([doc_ids.slice(start, len(some)).to_pylist()], pa.list_(pa.int64())),
                    "sizes": pa.array([[len(x) // 4 for x in rows]], pa.list_(pa.int64())),
                    "ids": pa.array([ids.astype(width).tobytes()], pa.binary()),
                    "seen": pa.array([seen.astype(np.int32)], pa.list_(pa.int32())),
                    "times": pa.array([times.astype(np.int64)], pa.list_(pa.int64())),
                }
            )
            block += 1


def recoded(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of coded ranks."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            count = sum(one["sizes"][0].as_py())
            raw = one["ids"][0].as_py()
            ids = np.frombuffer(raw, dtype=f"<u{len(raw) // max(1, count)}") if count else np.zeros(0, np.uint32)
            control, data = pack(rank[ids])
            columns = [
                one["shard"], one["block"], pa.array([count], pa.int64()), one["doc_ids"], one["sizes"],
                pa.array([control], pa.binary()), pa.array([data], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [x.split(" ")[0] for x in CODED.split(", ")])


def dealt(docs: DataFrame) -> DataFrame:
    """Texts in ascending order of ``doc_id``, by ranges that split the rows of a frequent one: by
    how their texts begin and, where that is equal too, by where they come from."""
    keys = {"head": F.substring("text", 1, HEAD), "place": F.monotonically_increasing_id()}
    return (
        texts(docs).withColumns(keys).repartitionByRange("doc_id", *keys)
        .sortWithinPartitions("doc_id", "head", "text").drop(*keys)
    )


def write_token_files(docs: DataFrame, path: str, end_id: int, folder: str, spaced: bool = False) -> None:
    """Write the ids of all texts, each followed by ``end_id``, and the ranked vocabulary."""
    plain = f"{folder}/plain"
    rows = dealt(docs)
    # Not the files themselves: a compression that takes little time.
    rows.mapInArrow(lambda it: tokenised(it, path, spaced, end_id), PLAIN).write.option(
        "compression", "snappy"
    ).parquet(plain)
    spark = docs.sparkSession
    blocks = spark.read.schema(PLAIN).parquet(plain)
    counts = (
        blocks.select(F.explode(F.arrays_zip("seen", "times")).alias("x"))
        .groupBy(F.col("x.seen").alias("id"))
        .agg(F.sum("x.times").alias("times"))
    )
    # At most a row for each entry of the vocabulary.
    ranked = counts.orderBy(F.desc("times"), "id").toPandas()
    ids = ranked["id"].to_numpy(dtype=np.uint32)
    spark.createDataFrame(
        [(bytearray(ids.astype("<u4").tobytes()),)], "ids binary"
    ).coalesce(1).write.parquet(f"{folder}/vocabulary")
    rank = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    blocks.select("shard", "block", "doc_ids", "sizes", "ids").mapInArrow(
        lambda it: recoded(it, rank), CODED
    ).write.option("compression", "zstd").parquet(f"{folder}/ids")


def decoded(batches: Iterator[pa.RecordBatch], ids_by_rank: np.ndarray) -> Iterator[tuple]:
    """Shard, block, identifiers, numbers of ids and the ids of each block."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = {name: batch[name][row].as_py() for name in batch.schema.names}
            ranks = unpack(one["control"], one["data"], one["n_ids"])
            yield one["shard"], one["block"], one["doc_ids"], one["sizes"], ids_by_rank[ranks]


def digests(batches: Iterator[pa.RecordBatch], ids_by_rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    for shard, block, doc_ids, sizes, ids in decoded(batches, ids_by_rank):
        raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes, dtype=np.int64)
        starts = ends - np.array(sizes, dtype=np.int64)
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(sizes), pa.int32()), pa.array([block] * len(sizes), pa.int32()),
                pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes, pa.int64()),
                pa.array(sums, pa.int64()),
            ],
            ["shard", "block", "doc_id", "before", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Place, number and checksum of every document's ids, from the files."""
    blocks = spark.read.schema(CODED).parquet(f"{folder}/ids")
    stored = spark.read.schema("ids binary").parquet(f"{folder}/vocabulary").first()
    ids_by_rank = np.frombuffer(bytes(stored["ids"]), dtype="<u4")
    rows = blocks.mapInArrow(
        lambda it: digests(it, ids_by_rank),
        "shard int, block int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint",
    )
    sizes = blocks.select("shard", "block", "n_ids")
    earlier = Window.partitionBy("shard").orderBy("block")
    # One row for each file.
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("total")).withColumn(
        "shard_start", F.sum("total").over(Window.orderBy("shard")) - F.col("total")
    )
    starts = (
        sizes.withColumn("block_start", F.sum("n_ids").over(earlier) - F.col("n_ids"))
        .join(shards, "shard")
        .select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("first"))
    )
    return rows.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_file_digests(docs: DataFrame, path: str, end_id: int, spaced: bool = False) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    folder = shared_folder(docs.sparkSession)
    write_token_files(docs, path, end_id, folder, spaced)
    return read_digests(docs.sparkSession, folder)
