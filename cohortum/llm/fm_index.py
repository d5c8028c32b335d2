"""Substring deduplication of words by compressed FM-indexes.

Windows of 50 words that may have an earlier copy are found by ``anchors``. A shard indexes the
different segments of its anchors: their concatenation's Burrows-Wheeler transform is kept as a
wavelet tree of bit vectors with counts per machine word, and nothing else of the text is needed
to search. Each segment is streamed through the index from its end: backward search matches its
last 50 words, then every further word is one backward step, after which the match is cut back to
50 words at the borders of equal prefixes. So the matching statistics reach the threshold for all
windows in turn, and the suffix range of each names the documents that hold it. All segments of a
shard advance together, a step at a time.

Words are compared as 64-bit hashes. Defined cases: null texts have no words; documents of fewer
than 50 words keep all; rows with the same ``doc_id`` are no earlier copies of each other; rows
without ``doc_id`` keep all and remove nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from cohortum.llm.anchors import BASE, WINDOW, later_copies_removed, mixed
from cohortum.llm.wordcache import groups

LONG, HALF = 64, 32  # HALF: a power of two, from half of WINDOW on
ONE_SPACE = bytes(32 if 9 <= c <= 13 else c for c in range(256))
LOW_BYTES = np.array([2 ** (8 * n) - 1 for n in range(9)], dtype="<u8")
DIGESTS = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


class Cut:
    """The words of texts, as places in the bytes of all texts with a space around each."""

    def __init__(self, texts: list[str]):
        raw = [text.encode() for text in texts]
        joined = b" ".join([b"", *raw, b""]).translate(ONE_SPACE)
        self.data = np.frombuffer(joined, np.uint8)
        self.white = self.data == 32
        edges = np.flatnonzero(self.white[1:] != self.white[:-1]) + 1
        self.starts, self.ends = edges[::2], edges[1::2]
        after = np.cumsum([len(x) + 1 for x in raw], dtype=np.int64)
        self.words = np.searchsorted(self.starts, after)  # of all texts up to each

    def hashes(self) -> np.ndarray:
        """Of each word, eight bytes at a time; the rest of long words at once."""
        sizes = self.ends - self.starts
        out, padded = sizes.astype(np.uint64) * BASE, np.append(self.data, np.zeros(8, np.uint8))
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        left, at = np.arange(len(sizes)), 0
        while len(left) and at < LONG:
            some = eight[self.starts[left] + at] & LOW_BYTES[np.minimum(sizes[left] - at, 8)]
            out[left] = mixed(mixed(out[left] ^ some))
            at += 8
            left = left[sizes[left] > at]
        places = zip((self.starts[left] + at).tolist(), self.ends[left].tolist())
        rest = [xxhash.xxh3_64_intdigest(self.data[a:b]) for a, b in places]
        out[left] = mixed(out[left] ^ np.array(rest, dtype=np.uint64))
        return out


def word_symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, some in groups(texts):
        cut = Cut(some)
        parts.append(cut.hashes())
        sizes.append(np.diff(cut.words, prepend=0))
    return np.concatenate(parts), np.cumsum(np.concatenate(sizes), dtype=np.int64)


def in_order(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys of twice ``bits``, as many as fit into ``bits``, ties by place; and the sorted keys.

    Sorted together with their places where both fit into a number, which is faster.
    """
    if 3 * bits > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = key << bits | np.arange(len(key))
    both.sort()
    return both & (1 << bits) - 1, both >> bits


def suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes, by doubling the length that is sorted; and numbers that are equal for
    suffixes that agree in the first ``HALF`` symbols."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    n, length, agree = len(rank), 1, rank
    order, bits = np.arange(n), n.bit_length()
    while length < n:
        second = np.zeros(n, dtype=np.int64)
        second[:-length] = rank[length:] + 1
        order, key = in_order(rank << bits | second, bits)
        fresh = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        length *= 2
        agree = rank if length <= HALF else agree
        if fresh[-1] == n - 1:
            break
    return order, agree


class WaveletTree:
    """Ranks of symbols in a sequence, from one bit vector for each bit of a symbol."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.size, self.depth = len(sequence), max(1, int(symbols - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.depth - 1, -1, -1):
            bits = (sequence >> level & 1).astype(bool)
            padded = np.zeros(-(-(len(bits) + 1) // 64) * 8, dtype=np.uint8)
            packed = np.packbits(bits, bitorder="little")
            padded[: len(packed)] = packed
            words = padded.view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.counts.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(int(len(bits) - bits.sum()))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])

    def descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where ``places`` lie after the last level, along the symbols' own bits."""
        at = places.astype(np.int64)
        for level, words, counts, zeros in zip(
            range(self.depth - 1, -1, -1), self.words, self.counts, self.zeros
        ):
            block = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = counts[block] + np.bitwise_count(words[block] & below)
            at = np.where(symbols >> level & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """Backward search over segments, each ended by a separator smaller than all symbols."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """``symbols`` from 1 on; segments lie one after the other."""
        count = len(sizes)
        owner = np.repeat(np.arange(count), sizes)
        text = np.zeros(len(symbols) + count, dtype=np.int64)
        self.starts = starts + np.arange(count)
        text[np.arange(len(symbols)) + owner] = symbols
        # For sorting, separators differ, so that no order depends on what follows a segment.
        apart = text + count
        apart[self.starts + sizes] = np.arange(count)
        order, agree = suffixes(apart)
        self.text, kinds = text, int(symbols.max()) + 1
        self.tree = WaveletTree(text[order - 1], kinds)
        smaller = np.cumsum(np.bincount(text, minlength=kinds)) - np.bincount(text, minlength=kinds)
        every = np.arange(kinds)
        self.shift = smaller - self.tree.descend(every, np.zeros(kinds, np.int64))
        self.total = np.append(smaller[1:], len(text)) - smaller
        self.smaller = smaller
        segment_of = np.repeat(np.arange(count), sizes + 1)
        self.segment = segment_of[order]
        # Borders of suffixes that agree in the first WINDOW symbols.
        reach = np.repeat(self.starts + sizes, sizes + 1)
        whole = reach - np.arange(len(text)) >= WINDOW
        deep = np.zeros(len(text), dtype=bool)
        both = np.flatnonzero(whole[order[1:]] & whole[order[:-1]])
        one, two, rest = order[both], order[both + 1], WINDOW - HALF
        deep[both + 1] = (agree[one] == agree[two]) & (agree[one + rest] == agree[two + rest])
        places = np.arange(len(text))
        self.low = np.maximum.accumulate(np.where(deep, 0, places))
        ends = np.append(np.flatnonzero(~deep)[1:], len(text))
        self.high = ends[np.cumsum(~deep) - 1]

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges after putting a symbol before each match."""
        return tuple(self.tree.descend(symbols, x) + self.shift[symbols] for x in (low, high))

    def ranges(self, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Segment, place, and suffix range of every window, by streaming all segments."""
        lanes = np.argsort(-sizes, kind="stable")
        sizes = sizes[lanes]
        at = self.starts[lanes] + sizes - 1
        symbols = self.text[at]
        low, high = self.smaller[symbols], self.smaller[symbols] + self.total[symbols]
        out = []
        for done in range(1, int(sizes.max(initial=0)) + 1):
            if done >= WINDOW:
                low, high = self.low[low], self.high[low]
                out.append((lanes[: len(low)], at - self.starts[lanes[: len(low)]], low, high))
            active = int(np.searchsorted(-sizes, -done, side="left"))  # longer than what is done
            at, low, high = at[:active] - 1, low[:active], high[:active]
            if not active:
                break
            low, high = self.step(self.text[at], low, high)
        return tuple(map(np.concatenate, zip(*out)))


def core(content: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The smallest document of every window of the segments."""
    symbols = np.unique(content, return_inverse=True)[1].astype(np.int64) + 1
    index = FMIndex(symbols, np.cumsum(sizes) - sizes, sizes)
    owner, place, low, high = index.ranges(sizes)
    docs = docs[index.segment]
    # Ranges are equal or apart: the smallest document of each, once.
    begins, which = np.unique(low, return_inverse=True)
    ends = np.zeros(len(begins), dtype=np.int64)
    ends[which] = high
    cuts = np.stack([begins, ends], axis=1).ravel()
    least = np.minimum.reduceat(np.append(docs, docs.max()), cuts)[::2]
    return least[which][np.lexsort((place, owner))]


def digests(batch: pa.Table, texts: list[str | None], removals: list) -> pa.RecordBatch:
    counts, removed, hashes = [], [], []
    for text, (lows, highs) in zip(texts, removals):
        words = (text or "").encode().split()
        kept, at = [], 0
        for low, high in zip(lows.tolist(), highs.tolist()):
            kept.extend(words[at:low])
            at = high
        kept.extend(words[at:])
        counts.append(len(words))
        removed.append(len(words) - len(kept))
        hashes.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"].combine_chunks(), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes, pa.string())],
        [x.split(" ")[0] for x in DIGESTS.split(", ")],
    )


def without_later_copies(docs: DataFrame, finish=digests, schema: str = DIGESTS) -> DataFrame:
    """``finish`` over all documents and the words to remove from each; by default digests."""
    return later_copies_removed(docs, word_symbols, np.uint64, core, finish, schema)
