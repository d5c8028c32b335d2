"""Alignment of two tokenizers' tokens over the same bytes, by galloping intersection.

Both tokenizers split a text into pieces whose byte ends are ascending numbers. The shorter list of
ends drives: each of its ends is sought in the longer list from the place of the one before, in
steps that double until they pass it, then by halving the last step. Ends that both lists hold cut
the tokens into groups; the differences of neighbouring places are the ranges of tokens that
overlap. Many lists are searched in step with each other, in pieces of ``LANE`` ends.

Neither vocabulary has a token across the space between two other characters, so texts are cut
there, the distinct units of a block of documents are aligned once, and documents are put together
from their units. Blocks are stored with their units' links; the links' counts over the corpus are
sums over the blocks' distinct pairs of ids, which meet each block again, one block at a time.

Defined cases: a null or empty text, or one whose tokens do not give back its bytes after a space,
has no tokens: zeros and an empty digest. Null and repeated ``doc_id`` are rows like any other;
other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortum.llm.byte_pairs import Strings
from cohortum.llm.common import share_code, texts
from cohortum.llm.tokens import Encoder
from cohortum.llm.wordcache import BETWEEN, groups, one_model, release
from cohortum.sources.tables import materialise

LANE, BLOCK_CHARACTERS, BLOCK_ROWS, STEP = 64, 2 << 20, 1000, 1 << 16
BESIDE_BLANK = re.compile(r"\s | \s|\A | \Z")  # a space at which no cut is safe
BLOCKS = (
    "block bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "groups_sha256 array<string>, pairs array<bigint>, times array<bigint>, "
    "units binary, unit_ends binary, links binary, link_sizes binary"
)
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def gallop(short: np.ndarray, long: np.ndarray, lane: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place in ``long`` of the first end that is not before each end of ``short``.

    A lane starts at ``lane`` in ``short``, has ``size`` ends, and is sought in ``long`` from
    ``low`` to ``high``, whose last end is no smaller than the lane's. Longest lanes come first.
    """
    place = np.zeros(len(short), dtype=np.int64)
    cursor = low.copy()
    for nth in range(int(size.max(initial=0))):
        many = int(np.searchsorted(-size, -nth, side="left"))  # lanes with more than nth ends
        at, last = cursor[:many], high[:many] - 1
        wanted = short[lane[:many] + nth]
        reach, step = at.copy(), 1
        while len(behind := np.flatnonzero(long[reach] < wanted)):
            at[behind] = reach[behind] + 1
            reach[behind] = np.minimum(reach[behind] + step, last[behind])
            step *= 2
        while len(unsure := np.flatnonzero(at < reach)):
            middle = (at[unsure] + reach[unsure]) // 2
            before = long[middle] < wanted[unsure]
            at[unsure[before]] = middle[before] + 1
            reach[unsure[~before]] = middle[~before]
        place[lane[:many] + nth] = at
        cursor[:many] = at
    return place


def overlaps(short: np.ndarray, long: np.ndarray, short_ends: np.ndarray, long_ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of lists one after another: first and last place in ``long`` that overlaps each token of
    ``short``, and whether their ends agree."""
    sizes = np.diff(short_ends, prepend=0)
    begins = np.append(0, long_ends[:-1])
    pieces = -(-sizes // LANE)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    lane = (short_ends - sizes)[owner] + nth * LANE
    size = np.minimum(sizes[owner] - nth * LANE, LANE)
    order = np.argsort(-size, kind="stable")
    last = gallop(short, long, lane[order], size[order], begins[owner][order], long_ends[owner][order])
    common = long[last] == short if len(short) else np.zeros(0, dtype=bool)
    first = np.append(0, last + common)[: len(last)]
    heads = (short_ends - sizes)[sizes > 0]
    first[heads] = begins[sizes > 0]
    return first, last, common


class Aligned:
    """Groups and links of units: tokens of all units one after another, with the units' ends."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, a_bytes: np.ndarray, b_bytes: np.ndarray):
        """``a_bytes``, ``b_bytes``: lengths of the tokens; every unit's have the same sum."""
        a_sizes, b_sizes = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
        a_at, b_at = np.cumsum(a_bytes), np.cumsum(b_bytes)
        found = []
        for driver, other, chosen, swapped in (
            ((a_at, a_sizes, a_ends), (b_at, b_sizes, b_ends), a_sizes <= b_sizes, False),
            ((b_at, b_sizes, b_ends), (a_at, a_sizes, a_ends), a_sizes > b_sizes, True),
        ):
            (short, short_place), (long, long_place) = (picked(x, chosen) for x in (driver, other))
            ends = [np.cumsum(x[1][chosen]) for x in (driver, other)]
            first, last, common = overlaps(short, long, *ends)
            many = last - first + 1
            mine = np.repeat(np.arange(len(short)), many)
            theirs = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
            sides = [short_place[mine], long_place[theirs]]
            cuts = [short_place[common], long_place[last[common]]]
            found.append((sides[::-1], cuts[::-1]) if swapped else (sides, cuts))
        self.link_a, self.link_b = (np.concatenate([f[0][i] for f in found]) for i in (0, 1))
        order = np.argsort(self.link_a, kind="stable")
        self.link_a, self.link_b = self.link_a[order], self.link_b[order]
        self.cut_a, self.cut_b = (np.sort(np.concatenate([f[1][i] for f in found])) for i in (0, 1))
        self.link_ends = np.searchsorted(self.link_a, a_ends)
        self.group_ends = np.searchsorted(self.cut_a, a_ends)
        self.a, self.b, self.a_sizes, self.b_sizes = a, b, a_sizes, b_sizes

    def names(self, size: int) -> np.ndarray:
        """Numbers of strings that write all groups: an id with the sign before it (see ``signed``)."""
        own_a = np.searchsorted(self.cut_a, np.arange(len(self.a)))
        own_b = np.searchsorted(self.cut_b, np.arange(len(self.b)))
        before_a = np.append(-1, self.cut_a)  # last token of the group before
        before_b = np.append(-1, self.cut_b)
        out = np.zeros(len(self.a) + len(self.b), dtype=np.int64)
        a_first = np.arange(len(self.a)) == before_a[own_a] + 1
        b_first = np.arange(len(self.b)) == before_b[own_b] + 1
        out[np.arange(len(self.a)) + before_b[own_a] + 1] = self.a + size * np.where(a_first, 2, 0)
        out[np.arange(len(self.b)) + before_a[own_b + 1] + 1] = self.b + size * np.where(b_first, 1, 0)
        return out


def picked(side: tuple[np.ndarray, ...], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends and places of the tokens of the chosen units."""
    at, sizes, _ = side
    places = np.flatnonzero(np.repeat(chosen, sizes))
    return at[places], places


def byte_of_symbol() -> dict[str, int]:
    """The byte for which each symbol of a byte-level vocabulary stands: printable bytes stand for
    themselves, the others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Pair:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = Encoder(a_path, True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbols, vocabulary = byte_of_symbol(), self.a.tokenizer.get_vocab()
        pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            pieces[number] = bytes(map(symbols.__getitem__, token)) if set(token) <= symbols.keys() else b""
        self.a_pieces = Strings(pieces)
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.b_pieces = Strings(
            [
                bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()
                for i, name in enumerate(names)
            ]
        )
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("a token crosses the space between two words")
        self.size = max(len(pieces), size)
        self.signed = Strings([b"%s%d" % (sign, i) for sign in (b",", b"|", b";") for i in range(self.size)])

    def encoded(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of both tokenizers and ends per unit; units whose bytes are not given back have none."""
        raw = self.a.encoded([" " + unit for unit in units])
        lists = self.b.encode(units, num_threads=1)
        a, a_sizes = np.frombuffer(b"".join(raw), "<u4").astype(np.int64), np.array([len(x) // 4 for x in raw], dtype=np.int64)
        b_sizes = np.array(list(map(len, lists)), dtype=np.int64)
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(b_sizes.sum()))
        wanted = [b" " + unit.encode() for unit in units]
        whole = b"".join(wanted)
        good = np.ones(len(units), dtype=bool)
        for pieces, ids, sizes in ((self.a_pieces, a, a_sizes), (self.b_pieces, b, b_sizes)):
            data = joined(pieces, ids)
            ends = np.append(0, np.cumsum(pieces.sizes[ids]))[np.cumsum(sizes)].tolist()
            if data != whole or ends != np.cumsum(list(map(len, wanted))).tolist():
                starts = [0, *ends[:-1]]
                good &= np.array([data[x:y] == z for x, y, z in zip(starts, ends, wanted)], dtype=bool)
        if not good.all():
            a, b = a[np.repeat(good, a_sizes)], b[np.repeat(good, b_sizes)]
            a_sizes, b_sizes = a_sizes * good, b_sizes * good
        return a, b, np.cumsum(a_sizes), np.cumsum(b_sizes), good

    def align(self, units: list[str]) -> tuple[Aligned, np.ndarray]:
        a, b, a_ends, b_ends, good = self.encoded(units)
        return Aligned(a, b, a_ends, b_ends, self.a_pieces.sizes[a], self.b_pieces.sizes[b]), good


@one_model
def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    """One per Python worker, until the blocks are put together."""
    return Pair(a_path, b_path)


def forget() -> None:
    """Drop the tokenizers and what else a worker keeps for other steps."""
    if tokenizer_pair.cache_info().currsize:
        release()
        gc.collect()
        pa.default_memory_pool().release_unused()


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of each run of values."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[ends] - total[np.append(0, ends[:-1])[: len(ends)]]


def units_of(text: str) -> list[str]:
    return BETWEEN.split(text) if BESIDE_BLANK.search(text) else text.split(" ")


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that no more texts than about a block are Python strings."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)


def joined(strings: Strings, numbers: np.ndarray) -> bytes:
    """``Strings.join`` in steps, which bounds its index."""
    return b"".join(strings.join(numbers[i : i + STEP]) for i in range(0, len(numbers), STEP))


def aligned_blocks(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """A row per block of documents: their figures, and their units with the links of each."""
    both, number = tokenizer_pair(a_path, b_path), TaskContext.get().partitionId() << 32
    for batch in slices(batches):
        doc_ids = batch["doc_id"]
        for start, some in groups(batch["text"].to_pylist(), BLOCK_CHARACTERS):
            rows = [units_of(text) if text else [] for text in some]
            units = pa.array(list(chain.from_iterable(rows)), pa.large_string()).dictionary_encode()
            code, ends = units.indices.to_numpy(), np.cumsum(list(map(len, rows)))
            found, good = both.align(units.dictionary.to_pylist())
            # Documents with a unit that is not given back have no tokens at all.
            lost = sums(~good[code], ends) > 0
            if lost.any():
                sizes = np.diff(ends, prepend=0)
                code, ends = code[~np.repeat(lost, sizes)], np.cumsum(sizes * ~lost)
            written = joined(both.signed, names := found.names(both.size))
            n_a, n_b = found.a_sizes, found.b_sizes
            letters = np.append(0, np.cumsum(both.signed.sizes[names]))[np.append(0, np.cumsum(n_a + n_b))].tolist()
            strings = [written[x:y] for x, y in zip(letters, letters[1:])]
            spelled = code.tolist()
            digests = [
                hashlib.sha256(b"".join(map(strings.__getitem__, spelled[x:y]))[1:]).hexdigest() if y > x else ""
                for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())
            ]
            groups_of = np.diff(found.group_ends, prepend=0)
            key = found.a[found.link_a] << 32 | found.b[found.link_b]
            pairs, place = np.unique(key, return_inverse=True)
            link_ends = found.link_ends
            used = np.bincount(code, minlength=len(good))  # occurrences of each unit
            times = np.bincount(place, np.repeat(used, np.diff(link_ends, prepend=0)), len(pairs))
            long = lambda x: pa.array([x], pa.list_(pa.int64()))
            raw = lambda x: pa.array([zstandard.compress(x.astype("<i4").tobytes(), 1)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.array([doc_ids.slice(start, len(some)).to_pylist()], pa.list_(pa.int64())),
                    long(sums(n_a[code], ends)), long(sums(n_b[code], ends)), long(sums(groups_of[code], ends)),
                    pa.array([digests], pa.list_(pa.string())), long(pairs), long(times.astype(np.int64)),
                    raw(code), raw(ends), raw(place), raw(np.diff(link_ends, prepend=0)),
                ],
                [x.split(" ")[0] for x in BLOCKS.split(", ")],
            )
            number += 1


def finished(block: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block of what the corpus holds of their pairs."""
    import pyarrow

    names = [x.split(" ")[0] for x in RESULT.split(", ")]
    forget()
    if not block.num_rows:
        return pyarrow.table([pa.array([], pa.string() if x == "groups_sha256" else pa.int64()) for x in names], names)
    numbers = lambda name: np.frombuffer(zstandard.decompress(block[name][0].as_py()), "<i4").astype(np.int64)
    lists = lambda name: block[name][0].values
    units, ends, links, sizes = map(numbers, ("units", "unit_ends", "links", "link_sizes"))
    link_ends, place = np.cumsum(sizes), answers["place"].to_numpy()
    of_unit = []
    for name in ("best", "n"):
        values = np.zeros(len(place), dtype=np.int64)
        values[place] = answers[name].to_numpy()
        of_unit.append(sums(values[links], link_ends) if len(links) else np.zeros(len(link_ends), np.int64))
    n_a, n_b, n_groups = (lists(name).to_numpy() for name in ("n_a", "n_b", "n_groups"))
    n_best, count_sum = (sums(values[units], ends) for values in of_unit)
    return pyarrow.table(
        [
            lists("doc_ids"), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_a + n_b - n_groups),
            pa.array(n_best), pa.array(count_sum), lists("groups_sha256"),
        ],
        names,
    )


def aligned_tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Numbers of tokens, groups and links of every text, and how usual its links are."""
    share_code(docs.sparkSession)
    stored = materialise(texts(docs).mapInArrow(lambda it: aligned_blocks(it, a_path, b_path), BLOCKS))
    each = stored.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x")).select(
        "block", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")
    )
    totals = each.groupBy("pair").agg(F.sum("times").alias("n")).withColumn("b", F.col("pair").bitwiseAND(2**32 - 1))
    totals = materialise(totals)
    # A row for each entry of the second vocabulary at most.
    highest = totals.groupBy("b").agg(F.max("n").alias("highest"))
    known = totals.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("highest")).cast("bigint").alias("best"))
    answers = each.select("block", "place", "pair").join(known, "pair").select(F.col("block").alias("of"), "place", "n", "best")
    return stored.drop("pairs", "times").groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(finished, RESULT)
