"""Byte-level BPE: encoding by ranked merges, and decoding.

There are two forms with equal results. ``encoded_chunks`` folds the merges in Spark's higher-order
functions. ``round_trip_digests`` folds them in Python, once per distinct word and worker; it needs
a small part of the time and memory (figures in the README), and the query uses it.

In the first form texts are cut into the matches of a pattern; the merges run once per distinct match of a chunk of
documents, as a fold over its array of bytes. The fold's state is the current pieces and the rank
of each neighbouring pair; a step joins the leftmost pair of the lowest rank and looks up the two
pairs around the new piece. Ranks come from a literal map, kept as an array of small maps by
checksum since a lookup in one large map would walk through it. Bytes are characters of Latin 1
there. A chunk's encoded matches are then put together to the documents' ids. Decoding
concatenates the binary pieces of the ids.

No shuffle is needed, chunks have bounded size, and a lost executor costs its tasks alone.

Defined cases: a null or empty text has no ids; repeated rows and null identifiers are kept; an
empty table gives no rows; texts with names of special tokens are ordinary texts.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortum.llm.common import texts
from cohortum.llm.tokens import WordwiseEncoder
from cohortum.llm.wordcache import BETWEEN, groups

BUCKETS, NONE = 1 << 16, 2**31 - 1
CHUNK_CHARACTERS = 6 << 20
CHUNK = (
    "doc_ids array<bigint>, units binary, codes binary, matches binary, places binary, "
    "words array<binary>"
)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The literal rank map: an array of maps, by the low bits of the key's checksum."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.decode("latin-1")
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def rank_of(table: Column, piece: Column) -> Column:
    bucket = F.crc32(piece.cast("binary")).bitwiseAND(BUCKETS - 1).cast("int")
    return F.coalesce(F.try_element_at(F.get(table, bucket), piece), F.lit(NONE))


def pair_ranks(table: Column, pieces: Column, count: Column) -> Column:
    """Rank of each pair of neighbours among ``count`` pieces."""
    pairs = F.zip_with(
        F.slice(pieces, F.lit(1), count - 1), F.slice(pieces, F.lit(2), count - 1), lambda a, b: F.concat(a, b)
    )
    return F.transform(pairs, lambda pair: rank_of(table, pair))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def merged(table: Column, state: Column) -> Column:
    """One merge: the leftmost of the pairs of the lowest rank becomes a piece."""
    pieces, ranks = state["pieces"], state["ranks"]

    def at(place: Column) -> Column:
        after = F.concat(
            F.slice(pieces, F.lit(1), place - 1),
            F.array(F.concat(F.element_at(pieces, place), F.element_at(pieces, place + 1))),
            F.slice(pieces, place + 2, F.size(pieces)),
        )
        return bound(after, lambda new: F.struct(new.alias("pieces"), near(place, new).alias("ranks")))

    def near(place: Column, new: Column) -> Column:
        around = F.slice(new, F.greatest(place - 1, F.lit(1)), F.when(place > 1, 3).otherwise(2))
        changed = bound(around, lambda few: pair_ranks(table, few, F.size(few)))
        return F.concat(
            F.slice(ranks, F.lit(1), F.greatest(place - 2, F.lit(0))),
            changed,
            F.slice(ranks, place + 2, F.size(ranks)),
        )

    return bound(F.array_position(ranks, F.array_min(ranks)).cast("int"), at)


def encoded_word(table: Column, word: Column) -> Column:
    """Ids of a word of Latin-1 characters."""
    pieces = F.split(word, "")
    start = F.struct(pieces.alias("pieces"), pair_ranks(table, pieces, F.length(word)).alias("ranks"))
    fold = F.aggregate(
        F.sequence(F.lit(2), F.length(word)),
        start,
        lambda state, _: F.when(
            F.coalesce(F.array_min(state["ranks"]), F.lit(NONE)) < NONE, merged(table, state)
        ).otherwise(state),
        lambda state: F.transform(state["pieces"], lambda piece: rank_of(table, piece)),
    )
    whole = rank_of(table, word)
    return F.when(whole < NONE, F.array(whole)).otherwise(fold)


@cache
def splitter(pattern: str):
    import regex

    return regex.compile(pattern).findall


def units_of(text: str) -> list[str]:
    """The text cut where a match of the pattern always starts, one unit per word."""
    parts = text.split(" ")
    if all(p and not p[0].isspace() and not p[-1].isspace() for p in parts):
        return parts
    return BETWEEN.split(text)


def packed(values, kind: str = "<i4") -> pa.Array:
    return pa.array([np.fromiter(values, dtype=kind).tobytes()], pa.binary())


def chunks(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[pa.RecordBatch]:
    """A row per chunk of documents: distinct matches, and the documents as numbers of them."""
    find = splitter(pattern)
    for batch in batches:
        doc_ids, found = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
        for start, some in groups(found, CHUNK_CHARACTERS):
            rows = [units_of(text) for text in some]
            heads = [row[0] for row in rows]
            # Units are told apart by whether a space stands before them.
            later = list(set().union(*(row[1:] for row in rows)))
            first = list(set(heads))
            code = {unit: n for n, unit in enumerate(later)}
            head_code = {unit: n for n, unit in enumerate(first, len(later))}
            matches = [find(" " + unit) for unit in later] + [find(unit) for unit in first]
            words = list(set().union(*matches))
            place = {word: n for n, word in enumerate(words)}
            codes = (
                np.fromiter(chain((head_code[row[0]],), map(code.__getitem__, row[1:])), np.int32, len(row))
                for row in rows
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[start : start + len(some)]], pa.list_(pa.int64())),
                    packed(map(len, rows)),
                    pa.array([np.concatenate(list(codes)).astype("<i4").tobytes()], pa.binary()),
                    packed(map(len, matches)),
                    packed(map(place.__getitem__, chain.from_iterable(matches))),
                    pa.array([[word.encode() for word in words]], pa.list_(pa.binary())),
                ],
                [x.split(" ")[0] for x in CHUNK.split(", ")],
            )


def encoded_chunks(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Chunks of documents with the ids of their distinct matches in ``ids``."""
    table = rank_map(read_ranks(path))
    rows = texts(docs).mapInArrow(lambda it: chunks(it, pattern), CHUNK)
    ids = F.transform("words", lambda word: encoded_word(table, F.decode(word, "ISO-8859-1")))
    return rows.withColumn("ids", ids).drop("words")


def ids_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents' ids, put together from those of their matches."""
    for batch in batches:
        for row in range(batch.num_rows):
            read = lambda name: np.frombuffer(batch[name][row].as_py(), dtype="<i4")  # noqa: E731, B023
            of_word = batch["ids"][row].as_py()
            unit_ends = [0, *np.cumsum(read("matches")).tolist()]
            places = read("places").tolist()
            of_unit = [
                list(chain.from_iterable([of_word[p] for p in places[a:b]]))
                for a, b in zip(unit_ends, unit_ends[1:])
            ]
            doc_ends, codes = [0, *np.cumsum(read("units")).tolist()], read("codes").tolist()
            ids = [
                list(chain.from_iterable([of_unit[c] for c in codes[a:b]]))
                for a, b in zip(doc_ends, doc_ends[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch["doc_ids"][row].as_py(), pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                ["doc_id", "ids"],
            )


def encoded_by_functions(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Ids of every text, the merges in Spark's higher-order functions."""
    return encoded_chunks(docs, path, pattern).mapInArrow(ids_of_chunks, "doc_id bigint, ids array<int>")


def merged_ids(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The fold of ranked merges: the leftmost of the pairs of the lowest rank is joined."""
    if word in ranks:
        return [ranks[word]]
    get, pieces = ranks.get, [word[i : i + 1] for i in range(len(word))]
    pairs = [get(a + b, NONE) for a, b in zip(pieces, pieces[1:])]
    while pairs and (lowest := min(pairs)) < NONE:
        at = pairs.index(lowest)
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = get(pieces[at - 1] + pieces[at], NONE)
        if at < len(pairs):
            pairs[at] = get(pieces[at] + pieces[at + 1], NONE)
    return [ranks[piece] for piece in pieces]


class BytePairs(WordwiseEncoder):
    """Encodes texts, and decodes ids."""

    def __init__(self, path: str, pattern: str):
        super().__init__(leading_space=True)
        self.ranks, self.find = read_ranks(path), splitter(pattern)
        size = max(self.ranks.values()) + 1
        pieces = [b""] * size
        for piece, rank in self.ranks.items():
            pieces[rank] = piece
        self.pieces, self.names = Strings(pieces), Strings([b",%d" % i for i in range(size)])

    def encoded(self, words: list[str]) -> list[bytes]:
        return [
            np.array(
                [i for match in self.find(word) for i in merged_ids(match.encode(), self.ranks)], dtype="<u4"
            ).tobytes()
            for word in words
        ]


class Strings:
    """Byte strings by number, put together without a loop over the numbers."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(x) for x in strings], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, numbers: np.ndarray) -> bytes:
        sizes = self.sizes[numbers]
        shift = self.starts[numbers] - (np.cumsum(sizes) - sizes)
        return self.data[np.arange(sizes.sum()) + np.repeat(shift, sizes)].tobytes()


@cache
def byte_pairs(path: str, pattern: str) -> BytePairs:
    """One per Python worker."""
    return BytePairs(path, pattern)


def digests(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Numbers and digests of the ids and of the decoded bytes, per document."""
    coder = byte_pairs(path, pattern)
    for batch in batches:
        counts, ids_sha, decoded_sha = [], [], []
        for _, some in groups(batch["text"].to_pylist()):
            for raw in coder.encode(some):
                ids = np.frombuffer(raw, "<u4")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(coder.names.join(ids)[1:]).hexdigest())
                decoded_sha.append(hashlib.sha256(coder.pieces.join(ids)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every text; digests of the ids and of the decoded bytes."""
    return texts(docs).mapInArrow(
        lambda it: digests(it, path, pattern),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
