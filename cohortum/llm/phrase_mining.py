"""Collocations by dynamic itemset counting.

The documents are dealt into ``SHARDS`` shards that are scanned in a circle. Words are counted from
the first scan on. A longer phrase is counted as soon as both its subphrases, without its last and
without its first word, have reached the threshold so far, from the next scan on until it has seen
every shard once; so scans count phrases of several lengths at a time, and few of the phrases that
cannot reach the threshold.

What a scan must know is which phrases have reached the threshold, and when: a table of ``SLOTS``
bytes for each length, by the phrase's hash, whatever the corpus holds. Phrases that share a slot
can only activate more of them, and every phrase's cycle follows from its subphrases' slots. The
counters themselves (48 bits of the hash, first scan, count up to 255) stay in a table of packed
buckets, which own ranges of the hash; those that end their cycle below the threshold are dropped.

Counters of equal hash count together, so a last pass counts the phrases that are left exactly, as
strings. Scores, cuts and covering phrases are joins of those counts.

Defined cases: a null or empty text has no words; a null language is ``und``; null and repeated
``doc_id`` are rows like any other; other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortum.llm.common import blocks, share_code
from cohortum.llm.wordcache import groups
from cohortum.sources.tables import materialise

SHARDS, SLOT_BITS, BUCKET_BYTES, HELD = 3, 23, 32 << 20, 4_000_000
SLOTS, NEVER, MOST = 1 << SLOT_BITS, 255, 255
LEAST, LONGEST, COVERED, SCALE = 10, 3, 50, 1_000_000
COUNTERS = "n int, bucket int, old boolean, hashes binary, starts binary, counts binary, fresh binary"
PHRASES = "lang string, n int, phrase string, f bigint"
# Bytes at which pieces end, and those between words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
BYTES = bytes(
    10 if c in ENDS else 32 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


class Tokens:
    """Words of texts of one language: a hash and a place in ``words`` each; none at a piece's end."""

    def __init__(self, texts: list[str], lang: str):
        data = "\n".join(texts).encode().translate(BYTES).replace(b"\n", b" \n ")
        cut = pc.split_pattern(pa.array([data], pa.large_binary()), b" ").flatten().dictionary_encode()
        self.words = cut.dictionary.to_pylist()
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashes = [xxhash.xxh3_64_intdigest(word, seed) for word in self.words]
        place = cut.indices.to_numpy()
        where = {word: n for n, word in enumerate(self.words)}
        self.place = place[place != where.get(b"", -1)]
        self.inside = self.place != where.get(b"\n", -1)
        self.hashes = np.array(hashes, dtype=np.uint64)[self.place]

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: the hash of the phrase at each place, and whether there is one."""
        hashes, real = self.hashes, self.inside
        yield 1, hashes, real
        for n in range(2, longest + 1):
            last = self.hashes[n - 1 :]
            hashes = mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + last)
            real = real[:-1] & self.inside[n - 1 :]
            yield n, hashes, real


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return slot(hashes) * buckets >> SLOT_BITS


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Tokens]]:
    for batch in batches:
        langs = batch["lang"].to_pylist()
        for start, some in groups(batch["text"].to_pylist()):
            own: dict[str, list[str]] = {}
            for lang, text in zip(langs[start:], some):
                own.setdefault(lang, []).append(text)
            for lang, found in own.items():
                yield lang, Tokens(found, lang)


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts up to ``MOST``."""
    together = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    order = np.argsort(together, kind="stable")
    together, amounts = together[order], np.concatenate(counts or [np.zeros(0, np.int64)])[order]
    first = np.flatnonzero(np.append(True, together[1:] != together[:-1])[: len(together)])
    return together[first], np.minimum(np.add.reduceat(amounts, first), MOST) if len(first) else amounts


class Reached:
    """The scan in which a phrase of each length reached the threshold, by slot."""

    def __init__(self, lengths: int):
        self.scans = [np.full(SLOTS, NEVER, dtype=np.uint8) for _ in range(lengths)]

    def packed(self) -> list[bytes]:
        return [zlib.compress(scan.tobytes(), 1) for scan in self.scans]

    @staticmethod
    def unpacked(packed: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(zlib.decompress(x), np.uint8) for x in packed]


def counted(
    batches: Iterator[pa.RecordBatch], scan: int, shards: int, known: Broadcast, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Counters of the phrases that are active in this scan."""
    reached = Reached.unpacked(known.value)
    held: dict[tuple[int, int], tuple[list, list]] = {}
    size = 0

    def release() -> Iterator[pa.RecordBatch]:
        for (n, start), (keys, counts) in held.items():
            hashes, amounts = added(keys, counts)
            yield rows_of(n, hashes, np.full(len(hashes), start, np.uint8), amounts, buckets)
        held.clear()

    for _, tokens in by_language(batches):
        starts = np.zeros(len(tokens.hashes), dtype=np.int16)  # the first scan of each phrase
        before = None
        for n, hashes, real in tokens.phrases(len(reached)):
            if n > 1:
                seen = reached[n - 2][slot(before)].astype(np.int16)
                late = np.maximum(seen[:-1], seen[1:])
                starts = np.where(late == NEVER, np.int16(SLOTS >> 10), late + 1)
            before = hashes
            active = real & (starts <= scan) & (scan < starts + shards)
            if not active.any():
                continue
            for start in np.unique(starts[active]).tolist():
                chosen, times = np.unique(hashes[active & (starts == start)] >> np.uint64(16), return_counts=True)
                keys, counts = held.setdefault((n, start), ([], []))
                keys.append(chosen)
                counts.append(times)
                size += len(chosen)
        if size > HELD:
            yield from release()
            size = 0
    yield from release()


def rows_of(n: int, hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Sorted counters by bucket, packed."""
    bucket = bucket_of(hashes << np.uint64(16), buckets)
    begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    ends = np.append(begins[1:], len(bucket)).astype(np.int64)
    six = np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
    small = counts.astype(np.uint8)
    cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([n] * len(begins), pa.int32()), pa.array(bucket[begins].astype(np.int32)),
            pa.array([False] * len(begins)), cut(six), cut(starts), cut(small),
            pa.array([b""] * len(begins), pa.binary()),
        ],
        [x.split(" ")[0] for x in COUNTERS.split(", ")],
    )


def merged(rows: pa.Table, scan: int, shards: int, least: int) -> pa.Table:
    """One bucket's counters after a scan, and the slots of those that reached the threshold in it."""

    def read(of: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        six = np.frombuffer(b"".join(of["hashes"].to_pylist()), np.uint8).reshape(-1, 6)
        eight = np.zeros((len(six), 8), np.uint8)
        eight[:, :6] = six
        starts = np.frombuffer(b"".join(of["starts"].to_pylist()), np.uint8)
        counts = np.frombuffer(b"".join(of["counts"].to_pylist()), np.uint8)
        return eight.view("<u8").ravel() << np.uint64(8) | starts, counts.astype(np.int64)

    old = read(rows.filter(rows["old"]))
    new = read(rows.filter(pc.invert(rows["old"])))
    # Equal hashes with different cycles are counters of their own.
    keys, counts = added([old[0], new[0]], [old[1], new[1]])
    hashes, starts = keys >> np.uint64(8), (keys & np.uint64(255)).astype(np.uint8)
    had = np.zeros(len(keys), dtype=np.int64)
    had[np.searchsorted(keys, old[0])] = old[1]
    fresh = slot(hashes[(counts >= least) & (had < least)] << np.uint64(16))
    # A counter that ended its cycle below the threshold is of no more use.
    kept = (counts >= least) | (starts.astype(np.int64) + shards > scan + 1)
    six = np.ascontiguousarray(hashes[kept].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
    return pa.table(
        [
            rows["n"][:1], rows["bucket"][:1], pa.array([True]), pa.array([six.tobytes()], pa.binary()),
            pa.array([starts[kept].tobytes()], pa.binary()),
            pa.array([counts[kept].astype(np.uint8).tobytes()], pa.binary()),
            pa.array([np.unique(fresh).astype("<u4").tobytes()], pa.binary()),
        ],
        [x.split(" ")[0] for x in COUNTERS.split(", ")],
    )


def merging(scan: int, shards: int, least: int) -> Callable[[pa.Table], pa.Table]:
    return lambda rows: merged(rows, scan, shards, least)


def scanned(rows: DataFrame, shards: int, longest: int, least: int) -> Reached:
    """All scans; the slots of the phrases that reached the threshold."""
    spark, reached = rows.sparkSession, Reached(longest)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(blocks(size, BUCKET_BYTES), SLOTS)
    state, scan, last = None, 0, 0
    while scan < shards or scan < last + 1 + shards:
        shard = rows.where(F.col("shard") == scan % shards).select("lang", "text")
        known = spark.sparkContext.broadcast(reached.packed())
        counters = shard.mapInArrow(partial(counted, scan=scan, shards=shards, known=known, buckets=buckets), COUNTERS)
        state = materialise(
            (counters if state is None else counters.unionByName(state))
            .groupBy("n", "bucket")
            .applyInArrow(merging(scan, shards, least), COUNTERS)
        )
        # At most a number for each slot and length.
        for found in state.select("n", "fresh").where(F.octet_length("fresh") > 0).toLocalIterator():
            slots = np.frombuffer(found["fresh"], "<u4")
            scans = reached.scans[found["n"] - 1]
            scans[slots] = np.minimum(scans[slots], scan)
            if found["n"] < longest:
                last = scan
        known.unpersist()
        scan += 1
    return reached


def spelt(batches: Iterator[pa.RecordBatch], longest: int, packed: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Phrases whose slots reached the threshold, with their counts; all words of a language as length 0."""
    reached = Reached.unpacked(packed)
    for lang, tokens in by_language(batches):
        # Places of phrases are told apart by numbers for the phrase without its last word.
        number, texts = tokens.place.astype(np.int64), pa.array(tokens.words, pa.binary())
        out = [(0, pa.array([b""], pa.binary()), np.array([int(tokens.inside.sum())]))]
        for n, hashes, real in tokens.phrases(longest):
            wanted = real & (reached[n - 1][slot(hashes)] != NEVER)
            if n > 1:
                # Numbers of the phrases one word shorter, and the last word.
                _, number = np.unique(number[: len(hashes)] * len(tokens.words) + tokens.place[n - 1 :], return_inverse=True)
            chosen = np.flatnonzero(wanted)
            _, first, times = np.unique(number[chosen], return_index=True, return_counts=True)
            parts = [texts.take(pa.array(tokens.place[chosen[first] + i])) for i in range(n)]
            out.append((n, pc.binary_join_element_wise(*parts, b" "), times))
        for n, phrases, times in out:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(times), pa.string()), pa.array([n] * len(times), pa.int32()),
                    phrases.cast(pa.string()), pa.array(times, pa.int64()),
                ],
                ["lang", "n", "phrase", "f"],
            )


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, shards: int = SHARDS
) -> DataFrame:
    """Exact counts of all phrases that occur often enough, per language; length 0: all words."""
    share_code(docs.sparkSession)
    rows = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard"),
    )
    reached = scanned(rows, shards, longest, least)
    known = docs.sparkSession.sparkContext.broadcast(reached.packed())
    counts = rows.select("lang", "text").mapInArrow(lambda it: spelt(it, longest, known.value), PHRASES)
    return (
        counts.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
        .where((F.col("f") >= least) | (F.col("n") == 0))
    )


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED,
    most: int = 2000, shards: int = SHARDS,
) -> DataFrame:
    """The best phrases of each language by the score of their weakest cut."""
    counts = materialise(frequent_phrases(docs, longest, least, shards))
    totals = counts.where("n = 0").select("lang", F.col("f").alias("total"))
    known = counts.where("n > 0").select("lang", "phrase", "f")
    phrases = counts.where("n > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    words = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = phrases.select(
        "lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        words(F.lit(1), F.col("k")).alias("first"), words(F.col("k") + 1, F.size("w")).alias("rest"),
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = lambda name: F.col(name).cast("decimal(38,0)")
    scored = (
        cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
        .withColumns({name: exact(name) for name in ("l", "r")})
        .withColumn("score", F.expr(f"{SCALE} * cast(a as decimal(16,0)) * cast(a as decimal(16,0)) div (l * r)"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", F.col("l").cast("bigint").alias("l"), F.col("r").cast("bigint").alias("r"))).alias("cut"))
    )
    inner = (
        phrases.where(F.size("w") > 2)
        .select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("size"))
        .select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at"))
        .groupBy("lang", words(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    )
    left_over = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    flat = left_over.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # The best of each of 64 parts first, so that no task ranks all of a language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = flat.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (
        first.where(F.col("place") <= most).withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= most)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    )
