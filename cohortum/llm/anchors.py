"""Exact substring matches between documents, found by shared anchors.

A window is ``WINDOW`` consecutive symbols (bytes or word hashes) of one document. Its anchor is
the gram of ``GRAM`` symbols in it with the smallest hash, so equal windows have equal anchors, and
neighbouring windows mostly share theirs: a run of windows with the same anchor is a segment.

Documents are dealt once into batches of bounded size. A batch sends its distinct anchors, as
packed hashes, to buckets; a bucket answers whether a second document has an anchor, and whether
it is crowded. Only segments with a shared anchor go on, each once per batch, to the shard of their
anchor. That loses nothing: a window whose anchor no other document has occurs in no other
document. A shard says for runs of a segment's windows which smallest document has them, and the
batches take out what an earlier document has. All three steps read the same exchange of texts.

An anchor with more than ``CROWDED`` different segments in all batches would make a large group;
each window of those is a segment of its own instead, and goes where its whole content says.

Documents without identifier are compared with nothing and keep all they have.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum.llm.common import blocks
from cohortum.llm.wordcache import give_back

WINDOW, GRAM, PIECE, LONGEST = 50, 16, 1 << 17, 64
BATCH_BYTES, CROWDED, SHARDS_PER_BATCH = 6 << 20, 2000, 3
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
SENT = "bucket int, batch int, hashes binary, counts binary"
ANSWER = "batch int, bucket int, shared binary, crowded binary"
SEGMENTS = "part int, batch int, single boolean, packed binary"
FIRSTS = "batch int, anchor bigint, segment bigint, single boolean, low int, high int, first bigint"
# Symbols of a batch: all of them in order, and where each document ends.
Symbols = Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]


@cache
def powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(base))]), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def segments_of(symbols: np.ndarray, ends: np.ndarray, usable: np.ndarray) -> dict[str, np.ndarray]:
    """All segments of a batch: document, start, number of windows, anchor, content hash."""
    total, starts = len(symbols), np.concatenate([[0], ends[:-1]]).astype(np.int64)
    valid = np.zeros(total + 1, dtype=bool)
    for a, b in zip(starts[usable].tolist(), ends[usable].tolist()):
        if b - a >= WINDOW:
            valid[a : b - WINDOW + 1] = True
    up, down = powers(int(BASE), PIECE + 256), powers(int(INVERSE), PIECE + 256)
    out: list[tuple[np.ndarray, ...]] = []
    for first in range(0, total - WINDOW + 1, PIECE):
        part = symbols[first : first + PIECE + WINDOW - 1].astype(np.uint64)
        windows = len(part) - WINDOW + 1
        here = valid[first : first + windows]
        if not here.any():
            continue
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part * down[: len(part)], dtype=np.uint64)])
        low = mixed((sums[GRAM:] - sums[:-GRAM]) * up[: len(part) - GRAM + 1])
        width, reach = WINDOW - GRAM + 1, 1
        while 2 * reach <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        low = np.minimum(low[: windows], low[width - reach : width - reach + windows])
        fresh = np.empty(windows, dtype=bool)
        fresh[0], fresh[1:] = True, (low[1:] != low[:-1]) | ~here[:-1]
        begins = np.flatnonzero(fresh & here)
        stops = np.minimum(np.append(begins[1:], windows), windows)
        lost = np.flatnonzero(~here)
        if len(lost):
            at = np.searchsorted(lost, begins)
            stops = np.minimum(stops, np.append(lost, windows)[at])
        counts = stops - begins
        pieces = -(-counts // LONGEST)
        if (pieces > 1).any():
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begins = np.repeat(begins, pieces) + nth * LONGEST
            counts = np.minimum(np.repeat(stops, pieces) - begins, LONGEST)
        to = begins + counts + WINDOW - 1
        content = mixed((sums[to] - sums[begins]) * up[begins] + counts.astype(np.uint64))
        out.append((begins + first, counts, low[begins], content))
    names = ("start", "windows", "anchor", "segment")
    if not out:
        empty = {n: np.zeros(0, np.uint64 if n in ("anchor", "segment") else np.int64) for n in names}
        return empty | {"document": np.zeros(0, np.int64)}
    found = dict(zip(names, map(np.concatenate, zip(*out))))
    return found | {"document": np.searchsorted(ends, found["start"], side="right")}


def distinct_anchors(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct anchors, the place of each segment's, and a count for each: twice the
    number of different segments, and one more if two documents have it."""
    anchors, place = np.unique(found["anchor"], return_inverse=True)
    least, most = np.full(len(anchors), 2**62), np.full(len(anchors), -1)
    np.minimum.at(least, place, found["document"])
    np.maximum.at(most, place, found["document"])
    _, once = np.unique(found["segment"], return_index=True)
    different = np.bincount(place[once], minlength=len(anchors))
    return anchors, place, (2 * np.minimum(different, 2**14) + (most > least)).astype("<u2")


def bucket_of(anchors: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchors >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values that occur in a sorted array, and where each begins and ends."""
    begins = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])[: len(sorted_)])
    return sorted_[begins], begins, np.append(begins[1:], len(sorted_))[: len(begins)]


def in_order(batch: pa.Table) -> pa.Table:
    return batch.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()


def send(batch: pa.Table, symbols: Symbols, buckets: int) -> pa.Table:
    """The distinct anchors of a batch, by bucket, six bytes each."""
    batch = in_order(batch)
    usable = batch["doc_id"].is_valid().to_numpy()
    found = segments_of(*symbols(batch["text"].to_pylist()), usable)
    anchors, _, counts = distinct_anchors(found)
    held, begins, ends = runs(bucket_of(anchors, buckets))
    packed = np.ascontiguousarray(anchors.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
    number = batch["batch"][0].as_py()
    return pa.table(
        [
            pa.array(held, pa.int32()), pa.array([number] * len(held), pa.int32()),
            pa.array([packed[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
        ],
        ["bucket", "batch", "hashes", "counts"],
    )


def answer(bucket: pa.Table) -> pa.Table:
    """Which of each batch's anchors a second document has, and which are crowded."""
    lists = []
    for raw in bucket["hashes"].to_pylist():
        six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
        eight = np.zeros((len(six), 8), np.uint8)
        eight[:, :6] = six
        lists.append(eight.view("<u8").ravel())
    counts = np.concatenate([np.frombuffer(raw, "<u2") for raw in bucket["counts"].to_pylist()])
    values, place, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = times > 1
    shared[place[(counts & 1).astype(bool)]] = True
    crowded = np.bincount(place, counts >> 1, minlength=len(values)) > CROWDED
    ends = np.cumsum([len(x) for x in lists])
    bits = lambda flags: [np.packbits(flags[p]).tobytes() for p in np.split(place, ends[:-1])]
    return pa.table(
        [
            bucket["batch"].cast(pa.int32()), bucket["bucket"].cast(pa.int32()),
            pa.array(bits(shared), pa.binary()), pa.array(bits(crowded), pa.binary()),
        ],
        ["batch", "bucket", "shared", "crowded"],
    )


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def windows_of(found: dict[str, np.ndarray], symbols: np.ndarray) -> dict[str, np.ndarray]:
    """Each window of the segments as a segment of its own, named by its content."""
    counts = found["windows"]
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start, names = found["start"][owner] + place, []
    factors = powers(int(BASE), WINDOW)[1:]
    for low in range(0, len(start), 1 << 14):
        some = symbols[start[low : low + (1 << 14), None] + np.arange(WINDOW)].astype(np.uint64)
        names.append(mixed((some * factors).sum(axis=1, dtype=np.uint64)))
    return {
        "start": start, "windows": np.ones(len(start), dtype=np.int64), "anchor": found["anchor"][owner],
        "segment": np.concatenate(names) if names else np.zeros(0, np.uint64), "document": found["document"][owner],
    }


def gathered(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Pieces of a sequence, one after the other."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return symbols[np.arange(sizes.sum()) + np.repeat(shift, sizes)]


def told(
    found: dict[str, np.ndarray], symbols: np.ndarray, docs: np.ndarray, batch: int, single: bool, parts: int
) -> pa.Table:
    """The different segments of a batch, with the smallest and largest document that has each.

    A row holds all segments for a part of the shards: lengths, documents and contents, packed.
    """
    _, first, place = np.unique(found["segment"], return_index=True, return_inverse=True)
    least, most = np.full(len(first), 2**63 - 1), np.full(len(first), -(2**63))
    np.minimum.at(least, place, docs[found["document"]])
    np.maximum.at(most, place, docs[found["document"]])
    part = bucket_of(mixed(found["segment" if single else "anchor"][first]), parts)
    order = np.argsort(part, kind="stable")
    first, least, most = first[order], least[order], most[order]
    held, begins, ends = runs(part[order])
    out = []
    press = zstandard.ZstdCompressor(level=1)
    for a, b in zip(begins, ends):
        own = slice(a, b)
        counts = found["windows"][first[own]]
        content = gathered(symbols, found["start"][first[own]], counts + WINDOW - 1)
        anchors = found["anchor"][first[own]] if single else np.zeros(0, np.uint64)
        fields = [
            np.array([len(counts)], "<u4"), counts.astype(np.uint8), least[own], most[own] - least[own], anchors,
            np.ascontiguousarray(content),
        ]
        out.append(press.compress(b"".join(x.tobytes() for x in fields)))
    return pa.table(
        [
            pa.array(held, pa.int32()), pa.array([batch] * len(held), pa.int32()),
            pa.array([single] * len(held), pa.bool_()), pa.array(out, pa.binary()),
        ],
        [x.split(" ")[0] for x in SEGMENTS.split(", ")],
    )


def unpacked(row: dict, kind: type) -> dict[str, np.ndarray]:
    """The segments of a row of ``told``."""
    raw, at = zstandard.ZstdDecompressor().decompress(row["packed"]), 4
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    out = {}
    for name, dtype, size in (
        ("windows", np.uint8, n), ("first", np.int64, n), ("last", np.int64, n),
        ("anchor", np.uint64, n if row["single"] else 0),
    ):
        out[name] = np.frombuffer(raw, dtype, size, at)
        at += size * np.dtype(dtype).itemsize
    out["content"] = np.frombuffer(raw, kind, offset=at)
    out["last"] = out["last"] + out["first"]
    out["anchor"] = out["anchor"] if row["single"] else np.zeros(n, np.uint64)
    return out | {"batch": np.full(n, row["batch"]), "single": np.full(n, row["single"])}


def document_numbers(batch: pa.Table) -> np.ndarray:
    return batch["doc_id"].fill_null(0).to_numpy()


def find(batch: pa.Table, answers: pa.Table, symbols: Symbols, buckets: int) -> pa.Table:
    """The different segments of a batch whose anchor is shared."""
    if not batch.num_rows:
        names = [x.split(" ")[0] for x in SEGMENTS.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        return pa.schema(list(zip(names, kinds))).empty_table()
    batch = in_order(batch)
    all_symbols, ends = symbols(batch["text"].to_pylist())
    found = segments_of(all_symbols, ends, batch["doc_id"].is_valid().to_numpy())
    anchors, place, _ = distinct_anchors(found)
    held, begins, stops = runs(bucket_of(anchors, buckets))
    at = np.searchsorted(held, answers["bucket"].to_numpy())
    shared, crowded = np.zeros(len(anchors), dtype=bool), np.zeros(len(anchors), dtype=bool)
    for low, high, *bits in zip(begins[at], stops[at], *(answers[c].to_pylist() for c in ("shared", "crowded"))):
        for flags, raw in zip((shared, crowded), bits):
            flags[low:high] = np.unpackbits(np.frombuffer(raw, np.uint8), count=high - low)
    pick = lambda flags: {name: values[flags[place]] for name, values in found.items()}
    docs, number = document_numbers(batch), batch["batch"][0].as_py()
    parts = SHARDS_PER_BATCH * buckets
    usual = told(pick(shared & ~crowded), all_symbols, docs, number, False, parts)
    single = told(windows_of(pick(shared & crowded), all_symbols), all_symbols, docs, number, True, parts)
    return pa.concat_tables([usual, single])


def names_of(content: np.ndarray, windows: np.ndarray, single: np.ndarray) -> np.ndarray:
    """The hashes of segments, as their batches name them."""
    sizes = windows.astype(np.int64) + WINDOW - 1
    starts = np.cumsum(sizes) - sizes
    place, symbols = np.arange(len(content)) - np.repeat(starts, sizes), content.astype(np.uint64)
    down, up = powers(int(INVERSE), WINDOW + LONGEST), powers(int(BASE), WINDOW + LONGEST)
    usual = np.add.reduceat(symbols * down[place], starts) + windows.astype(np.uint64)
    return mixed(np.where(single, np.add.reduceat(symbols * up[place + 1], starts), usual))


def runs_of_equal(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, first place, end and value of runs of windows with the same value.

    ``counts``: how many windows each owner has.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    fresh = np.concatenate([[True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(fresh)
    return owner[at], place[at], place[at] + np.diff(np.append(at, len(values))), values[at]


def earliest(shard: pa.Table, kind: type, core: Callable) -> pa.Table:
    """Runs of windows with an earlier document, for each batch that has a later one."""
    rows = [unpacked(row, kind) for row in shard.to_pylist()]
    told_ = {name: np.concatenate([row[name] for row in rows]) for name in rows[0]}
    names = names_of(told_["content"], told_["windows"], told_["single"])
    # Each segment once, with its smallest document.
    segments, once, place = np.unique(names, return_index=True, return_inverse=True)
    docs = np.full(len(once), 2**63 - 1)
    np.minimum.at(docs, place, told_["first"])
    sizes = told_["windows"].astype(np.int64) + WINDOW - 1
    content = gathered(told_["content"], (np.cumsum(sizes) - sizes)[once], sizes[once])
    counts = told_["windows"][once].astype(np.int64)
    owner, low, high, first = runs_of_equal(core(content, sizes[once], docs), counts)
    begins = np.searchsorted(owner, np.arange(len(once) + 1))
    many = begins[place + 1] - begins[place]
    row = np.repeat(np.arange(len(place)), many)
    run = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + begins[place][row]
    later = first[run] < told_["last"][row]
    row, run = row[later], run[later]
    return pa.table(
        [
            pa.array(told_["batch"][row], pa.int32()), pa.array(signed(told_["anchor"][row])),
            pa.array(signed(names[row])), pa.array(told_["single"][row]), pa.array(low[run].astype(np.int32)),
            pa.array(high[run].astype(np.int32)), pa.array(first[run]),
        ],
        [x.split(" ")[0] for x in FIRSTS.split(", ")],
    )


def merged(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching intervals."""
    if not len(lows):
        return lows, highs
    order = np.argsort(lows, kind="stable")
    lows, reach = lows[order], np.maximum.accumulate(highs[order])
    fresh = np.concatenate([[True], lows[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(lows) - 1)
    return lows[fresh], reach[last]


def removed(found: dict[str, np.ndarray], firsts: pa.Table, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, first and end symbol of what an earlier document has."""
    names = firsts["segment"].to_numpy().view(np.uint64)
    order = np.argsort(names, kind="stable")
    names = names[order]
    low, high, first = (firsts[c].to_numpy()[order] for c in ("low", "high", "first"))
    begins, ends = (np.searchsorted(names, found["segment"], side=side) for side in ("left", "right"))
    counts = ends - begins
    at = np.repeat(np.arange(len(counts)), counts)
    run = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[at]
    earlier = first[run] < docs[found["document"][at]]
    at, run = at[earlier], run[earlier]
    return found["document"][at], found["start"][at] + low[run], found["start"][at] + high[run] + WINDOW - 1


def take_out(batch: pa.Table, firsts: pa.Table, symbols: Symbols, finish: Callable) -> pa.Table:
    """``finish`` over the documents of a batch and what to remove from each."""
    if not batch.num_rows:
        return pa.Table.from_batches([finish(batch.drop_columns(["batch"]), [], [])])
    batch = in_order(batch)
    texts = batch["text"].to_pylist()
    all_symbols, ends = symbols(texts)
    found, docs = segments_of(all_symbols, ends, batch["doc_id"].is_valid().to_numpy()), document_numbers(batch)
    single = firsts["single"].to_numpy(zero_copy_only=False).astype(bool)
    crowded = np.isin(found["anchor"], firsts.filter(pa.array(single))["anchor"].to_numpy().view(np.uint64))
    parts = [removed({k: v[~crowded] for k, v in found.items()}, firsts.filter(pa.array(~single)), docs)]
    if crowded.any():
        apart = windows_of({k: v[crowded] for k, v in found.items()}, all_symbols)
        parts.append(removed(apart, firsts.filter(pa.array(single)), docs))
    document, low, high = map(np.concatenate, zip(*parts))
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    low, high = low - begins[document], high - begins[document]
    order = np.argsort(document, kind="stable")
    cuts = np.searchsorted(document[order], np.arange(batch.num_rows + 1))
    removals = [merged(low[order[a:b]], high[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.Table.from_batches([finish(batch.drop_columns(["batch"]), texts, removals)])


def later_copies_removed(
    docs: DataFrame, symbols: Symbols, kind: type, core: Callable, finish: Callable, schema: str | T.StructType,
    *carried: Column,
) -> DataFrame:
    """``finish(batch, texts, removals)`` over all documents; a removal is lows and highs.

    A batch has the columns ``doc_id``, ``text`` and those ``carried`` along from ``docs``.
    ``kind`` is the type of symbols. ``core`` gets the contents of a shard's different segments one
    after the other, their sizes and smallest documents, and returns the smallest document that has
    each window, for all windows of all segments in order.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *carried)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = blocks(size, BATCH_BYTES)
    # Rows are dealt one by one, so that no batch gets all copies of a row that is there very often.
    place = F.xxhash64("doc_id", F.length("text"), F.monotonically_increasing_id())
    rows = rows.withColumn("batch", F.pmod(place, F.lit(count)).cast("int"))
    answers = (
        rows.groupBy("batch").applyInArrow(lambda t: give_back(send(t, symbols, count)), SENT)
        .groupBy("bucket").applyInArrow(lambda t: give_back(answer(t)), ANSWER)
    )
    segments = rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        lambda t, a: give_back(find(t, a, symbols, count)), SEGMENTS
    )
    # An anchor's segments are all in one part.
    firsts = segments.groupBy("part").applyInArrow(lambda t: give_back(earliest(t, kind, core)), FIRSTS)
    return rows.groupBy("batch").cogroup(firsts.groupBy("batch")).applyInArrow(
        lambda t, f: give_back(take_out(t, f, symbols, finish)), schema
    )
