"""Substring deduplication of bytes by longest-previous-factor arrays.

Windows of 50 bytes that may have an earlier copy are found by ``anchors``. A shard holds all
segments of its anchors; the suffixes that start there are sorted by their first 50 bytes. Going
through the suffix order, the nearest suffixes before and after it that come from an earlier
document (previous and next smaller values) hold a suffix's longest previous factor. Where that
reaches 50 bytes the window has an earlier copy; following these references leads to the first.
Every byte of a later copy is removed, the first stays.

Defined cases: null texts are empty; documents shorter than 50 bytes keep all; rows with the same
``doc_id`` are no earlier copies of each other; rows without ``doc_id`` keep all and remove
nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum.llm.anchors import WINDOW, later_copies_removed
from cohortum.llm.wordcache import release

DIGESTS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def byte_symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    release()  # words that earlier steps of a pipeline remember here
    raw = [(text or "").encode() for text in texts]
    return np.frombuffer(b"".join(raw), np.uint8) , np.cumsum([len(x) for x in raw], dtype=np.int64)


def smaller(values: np.ndarray, step: int) -> np.ndarray:
    """Place of the nearest smaller value before (step -1) or after (1) each; -1 or n if none."""
    n = len(values)
    padded = np.append(values, np.iinfo(np.int64).min)  # place n, and -1, end every search
    at = np.arange(n) + step
    while True:
        open_ = np.flatnonzero(padded[at] >= values)
        if not len(open_):
            return at
        reach = at[open_]
        at[open_] = at[reach]


def previous_factors(content: np.ndarray, starts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each window the smallest document that has it, by its longest previous factors."""
    windows = np.lib.stride_tricks.sliding_window_view(content, WINDOW)[starts]
    order = np.argsort(np.ascontiguousarray(windows).view(f"S{WINDOW}").ravel(), kind="stable")
    windows, values = windows[order], docs[order]
    n, source = len(order), np.arange(len(order))
    for step in (1, -1):
        near = smaller(values, step)
        inside = np.flatnonzero((near >= 0) & (near < n))
        # The factor is as long as the common prefix; only whole windows count here.
        length = np.where((windows[inside] == windows[near[inside]]).all(axis=1), WINDOW, 0)
        whole = inside[length >= WINDOW]
        source[whole] = near[whole]
    while True:
        further = source[source]
        if (further == source).all():
            break
        source = further
    out = np.empty(n, dtype=np.int64)
    out[order] = values[source]
    return out


def core(content: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The smallest document of every window of the segments."""
    release()
    counts, begins = sizes - WINDOW + 1, np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return previous_factors(content, begins[owner] + place, docs[owner])


def kept_bytes(text: str | None, removal: tuple[np.ndarray, np.ndarray]) -> bytes:
    raw, out, at = (text or "").encode(), [], 0
    for low, high in zip(*(x.tolist() for x in removal)):
        out.append(raw[at:low])
        at = high
    return b"".join([*out, raw[at:]])


def digests(batch: pa.Table, texts: list[str | None], removals: list) -> pa.RecordBatch:
    sizes = [len((t or "").encode()) for t in texts]
    kept = [kept_bytes(t, r) for t, r in zip(texts, removals)]
    return pa.RecordBatch.from_arrays(
        [
            batch["doc_id"].combine_chunks(), pa.array(sizes, pa.int64()), pa.array([n - len(k) for n, k in zip(sizes, kept)], pa.int64()),
            pa.array([len(r[0]) for r in removals], pa.int64()),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ],
        [x.split(" ")[0] for x in DIGESTS.split(", ")],
    )


def without_later_copies(docs: DataFrame, finish=digests, schema: str = DIGESTS) -> DataFrame:
    """``finish`` over all documents and the bytes to remove from each; by default digests."""
    return later_copies_removed(docs, byte_symbols, np.uint8, core, finish, schema)


def cut_texts(batch: pa.Table, texts: list[str | None], removals: list) -> pa.RecordBatch:
    """Texts without later copies, and which of them changed, beside what was carried along; a
    character that loses some of its bytes goes whole."""
    cut = [len(removal[0]) > 0 for removal in removals]
    kept = [kept_bytes(t, r).decode(errors="ignore") if c else t for t, r, c in zip(texts, removals, cut)]
    return pa.RecordBatch.from_arrays(
        [pa.array(kept, batch.schema.field("text").type), pa.array(cut, pa.bool_()), batch["row"].combine_chunks()],
        ["text", "cut", "row"],
    )


def with_texts_cut(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, texts without later copies; ``n_chars`` follows them.

    The other columns go with the texts into their batches, so that rows are shuffled only once.
    """
    row = F.struct(*(name for name in docs.columns if name != "text")).alias("row")
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema if f.name != "text"])
    schema = T.StructType().add("text", "string").add("cut", "boolean").add("row", kind)
    rows = later_copies_removed(docs, byte_symbols, np.uint8, core, cut_texts, schema, row)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("cut"), length).otherwise(F.col("row.n_chars"))
    return rows.select(*[new.get(name, F.col("row")[name]).alias(name) for name in docs.columns])
