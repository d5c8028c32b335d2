"""Toxicity of texts after noisy-channel restoration of disguised words.

A character trigram model is counted over all documents. A word with digits or signs, also at
its ends or alone, one that repeats a letter, or one spelt out in single characters becomes a
lattice: a sign may stand for letters, be dropped, or be itself; a repeated letter may be dropped; a space
between single characters may be dropped. Viterbi decoding finds the cheapest path under channel
costs and the character model. Where that choice cannot be sure, a word has several readings, and
the features of all: signs at the ends as letters or as punctuation, doubled letters as written or
restored. Other words have one path and stay as they are.

Restored texts are scored by logistic regression on words and word beginnings: whether one occurs
at all, and at least once, twice or four times for every ``STRETCH`` words of the text.
Which ones matter, and their weights, are learned from a bounded sample of ``LABELLED`` labelled
rows outside the held-out third, chosen by hash.

Defined cases: null and empty texts get the score of a text without any sign of toxicity; labels
of null identifiers or null value are not used, of several labels of a document the largest counts;
repeated rows are scored each; without labels, or with labels of one kind only, all scores are the
share of toxic labels; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortum.llm.common import held_out, pieces, texts
from cohortum.llm.wordcache import FEWER, SMALLER, Words, groups, one_model

LABELLED, FEATURES, LEAST_DOCS, LEAST_GAIN = 12_000, 512, 3, 12.0
STRETCH, DENSITIES, HEAD = 150, (0, 1, 2, 4), 4
SYMBOLS, OTHER_LETTER, OTHER = 64, 60, 61
LIMIT = 0.7

# What signs often stand for, and costs of the channel in nats.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
SUBSTITUTED, DROPPED, REPEATED = 1.0, 1.5, 1.0
EDGE = ".,;:!?\"'()[]{}<>#%&*$|+-_=~/\\"
SIGNS = EDGE + "".join(STANDS_FOR)
PUNCTUATION = "".join(c for c in EDGE if c not in STANDS_FOR)  # stands for no letter
SPELT_OUT = re.compile(r"(?<!\S)(?:\S[ ._\-]){2,}\S(?!\S)")
TRIPLE = re.compile(r"([^\W\d_])\1\1")
DOUBLE = re.compile(r"([^\W\d_])\1")


def symbol_table() -> np.ndarray:
    """Symbol of each code point: letters a to z, accented Latin letters, other letters, the rest."""
    out = np.full(1 << 16, OTHER, dtype=np.int64)
    for code in range(1 << 16):
        if chr(code).isalpha():
            out[code] = OTHER_LETTER
    out[ord("a") : ord("z") + 1] = np.arange(1, 27)
    out[0xE0:0x100] = np.arange(27, 59)
    out[ord(" ")] = 0
    return out


SYMBOL = symbol_table()
SYMBOL_LIST = SYMBOL.tolist()


def symbol_of(char: str) -> int:
    return SYMBOL_LIST[min(ord(char), (1 << 16) - 1)]


def symbols(text: str) -> np.ndarray:
    return SYMBOL[np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), (1 << 16) - 1)]


def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of character trigrams over all words of a task."""
    total = np.zeros(SYMBOLS**3)
    for batch in pieces(batches, SMALLER):
        for _, some in groups(batch["text"].to_pylist(), SMALLER):
            counts: Counter[str] = Counter()
            for text in some:
                counts.update(text.split())
            words = [w.lower() for w in counts]
            s = symbols("".join(f" {w} " for w in words))
            times = np.repeat(
                np.fromiter(counts.values(), float, len(words)), [len(w) + 2 for w in words]
            )
            if len(s) > 2:
                total += np.bincount(
                    s[:-2] * SYMBOLS**2 + s[1:-1] * SYMBOLS + s[2:], times[2:], minlength=SYMBOLS**3
                )
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(total[seen].astype(np.int64))], ["gram", "times"]
    )


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a symbol after two others, from the whole corpus."""
    counts = (
        texts(docs).select("text").mapInArrow(trigrams, "gram int, times bigint")
        .groupBy("gram").agg(F.sum("times").alias("times"))
        .toArrow()  # at most one row for each trigram of 64 symbols
    )
    n = np.zeros(SYMBOLS**3)
    n[counts["gram"].to_numpy()] = counts["times"].to_numpy()
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = (n.sum(axis=(0, 1)) + 1) / (n.sum() + SYMBOLS)
    two = (n.sum(axis=0) + 20 * one) / (n.sum(axis=(0, 2))[:, None] + 20)
    three = (n + 5 * two[None]) / (n.sum(axis=2, keepdims=True) + 5)
    return np.log(three).astype(np.float32)


def arcs(text: str, at: int, spelt: bool = False) -> list[tuple[str, float]]:
    """What a character of a disguised word may have been, and at what cost; empty: nothing.

    ``spelt``: a sign that may stand for letters is one.
    """
    char = text[at]
    if char.isalpha():
        out = [(char, 0.0)]
        if at and text[at - 1] == char:
            out.append(("", REPEATED))
        return out
    out = [(letter, SUBSTITUTED) for letter in STANDS_FOR.get(char, "")]
    return out if out and spelt else [*out, ("", DROPPED), (char, 0.0)]


class Costs:
    """What a symbol costs after two others, by one number for the three, of the last model used."""

    model: np.ndarray | None = None
    of: list[float] = []

    @classmethod
    def under(cls, model: np.ndarray) -> list[float]:
        if cls.model is not model:
            cls.model, cls.of = model, (-model).ravel().tolist()
        return cls.of


def restore(word: str, model: np.ndarray, start: int = 0, end: int | None = None) -> str:
    """Viterbi decoding of a word's lattice; states are the last two symbols, as one number.

    Signs before ``start`` and from ``end`` on are letters where they can be.
    """
    costs, end = Costs.under(model), len(word) if end is None else end
    best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    for at in range(len(word)):
        choices = [(c, cost, symbol_of(c) if c else 0) for c, cost in arcs(word, at, not start <= at < end)]
        after: dict[int, tuple[float, tuple]] = {}
        for state, (cost, path) in best.items():
            for char, extra, symbol in choices:
                if char:
                    step = state * SYMBOLS + symbol
                    key, total, way = step % SYMBOLS**2, cost + extra + costs[step], (path, char)
                else:
                    key, total, way = state, cost + extra, path
                if key not in after or total < after[key][0]:
                    after[key] = (total, way)
        best = after
    ends = [(cost + costs[state * SYMBOLS], path) for state, (cost, path) in best.items()]
    path = min(ends, key=lambda x: x[0])[1]
    out = []
    while path:
        path, char = path
        out.append(char)
    return "".join(reversed(out))


def undoubled(word: str, model: np.ndarray) -> str:
    """``restore`` of a word of letters, none of them three times in a row.

    Its lattice has two paths around each doubled letter, which meet again one letter later, so the
    cheapest path takes the cheaper of the two at each.
    """
    costs, symbol = Costs.under(model), [0, *map(symbol_of, word), 0]
    out = [word[0]]
    for at in range(1, len(word)):
        if word[at] == word[at - 1]:
            before, letter, after = symbol[at - 1], symbol[at], symbol[at + 2]
            once, twice = ((before * SYMBOLS + letter) * SYMBOLS + x for x in (after, letter))
            if REPEATED + costs[once] < costs[twice] + costs[(letter * SYMBOLS + letter) * SYMBOLS + after]:
                continue
        out.append(word[at])
    return "".join(out)


def restored_words(word: str, model: np.ndarray) -> list[str]:
    """Lower-case words that a word of a text stands for."""
    disguised = word.lower().strip(PUNCTUATION)
    if disguised.isalpha():
        if not DOUBLE.search(disguised):
            return [disguised]
        if not TRIPLE.search(disguised):
            return list(dict.fromkeys([disguised, undoubled(disguised, model)]))
    letters = re.compile(r"[^\W\d_]+").findall
    inner = disguised.strip(SIGNS)
    if not letters(inner):
        whole = [x for x in (disguised, disguised.rstrip("!")) if x and all(c in STANDS_FOR for c in x)]
        return list(dict.fromkeys(x for run in whole for x in letters(restore(run, model, len(run)))))
    first = disguised.index(inner)
    lead, trail = disguised[:first], disguised[first + len(inner) :]
    as_written = [inner] if inner.isalpha() and not TRIPLE.search(inner) else []
    readings = as_written + (letters(restore(inner, model)) if not as_written or DOUBLE.search(inner) else [])
    for before in {lead, lead.lstrip("(*" + PUNCTUATION), ""}:
        for after in {trail, trail.rstrip("!*" + PUNCTUATION), ""}:
            if before or after:
                run = before + inner + after
                readings += letters(restore(run, model, len(before), len(before) + len(inner)))
    return list(dict.fromkeys(readings))


def features(words: list[str]) -> list[str]:
    """Words, and beginnings of four to eight letters, of one word's readings: each once."""
    out = []
    for word in words:
        if word:
            out.append(word + "$")
            out.extend(word[:n] for n in range(HEAD, min(8, len(word)) + 1))
    return list(dict.fromkeys(out))


def dense(counts: np.ndarray, words: int) -> np.ndarray:
    """How many of the densities each count reaches in a text of so many words."""
    return sum((counts >= max(1, times * words / STRETCH)).astype(np.int64) for times in DENSITIES)


class Reader:
    """Features of whole texts; ``wanted`` numbers those that count, else all are returned."""

    def __init__(self, model: np.ndarray, wanted: dict[str, int]):
        self.model, self.wanted = model, wanted
        # All features of a word begin with its first letters, which few wanted ones have.
        self.heads = {name[:HEAD] for name in wanted}
        self.words = Words(self.numbers, FEWER)

    def numbers(self, words: list[str]) -> list[bytes]:
        get, heads = self.wanted.get, self.heads
        out = []
        for word in words:
            able = [x for x in restored_words(word, self.model) if (x + "$")[:HEAD] in heads]
            found = [get(x) for x in features(able)] if able else []
            out.append(np.array([x for x in found if x is not None], dtype=np.int32).tobytes() if found else b"")
        return out

    def spelt_out(self, text: str) -> list[str]:
        return [w for run in SPELT_OUT.findall(text) for w in re.findall(r"[^\W\d_]+", restore(run.lower(), self.model))]

    def present(self, texts_: list[str]) -> Iterator[np.ndarray]:
        """Numbers of the features that each text has: a feature's place, and its density."""
        rows = [text.split() for text in texts_]
        known = self.words.learn(rows)
        for text, row in zip(texts_, rows):
            found = np.frombuffer(b"".join(map(known, row)), np.int32)
            if apart := self.spelt_out(text):
                more = [self.wanted[x] for word in apart for x in features([word]) if x in self.wanted]
                found = np.concatenate([found, np.array(more, dtype=np.int32)])
            if not len(found):
                yield found
                continue
            places, counts = np.unique(found, return_counts=True)
            levels = dense(counts, len(row))
            yield np.concatenate(
                [places[levels > n] * len(DENSITIES) + n for n in range(len(DENSITIES))]
            ).astype(np.int32)

    def all_features(self, text: str, memory: dict[str, list[str]]) -> list[tuple[str, int]]:
        """Features with the highest density that they reach."""
        row = text.split()
        counts = Counter(x for word in self.spelt_out(text) for x in features([word]))
        for word, times in Counter(row).items():
            if word not in memory:
                memory[word] = features(restored_words(word, self.model))
            for name in memory[word]:
                counts[name] += times
        levels = dense(np.fromiter(counts.values(), np.int64, len(counts)), len(row))
        return list(zip(counts, levels.tolist()))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of at most ``LABELLED`` documents that may be learned from."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
    )
    chosen = (
        usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    )
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def feature_counts(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    reader = Reader(model, {})
    for batch in batches:
        toxic = batch["toxic"].to_pylist()
        for start, some in groups(batch["text"].to_pylist(), SMALLER):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            memory: dict[str, list[str]] = {}
            for text, label in zip(some, toxic[start:]):
                counts[int(label > 0)].update(reader.all_features(text, memory))
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.int32()),
                    pa.array([counts[1][x] for x in names], pa.int64()),
                    pa.array([counts[0][x] for x in names], pa.int64()),
                ],
                ["feature", "level", "toxic", "clean"],
            )


def found_features(batches: Iterator[pa.RecordBatch], model: np.ndarray, wanted: dict[str, int]) -> Iterator[pa.RecordBatch]:
    reader = Reader(model, wanted)
    for batch in batches:
        toxic = batch["toxic"].to_pylist()
        for start, some in groups(batch["text"].to_pylist(), SMALLER):
            rows = [x.tolist() for x in reader.present(some)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic[start : start + len(some)], pa.int32()), pa.array(rows, pa.list_(pa.int32()))],
                ["toxic", "found"],
            )


def logistic(rows: list[list[int]], label: np.ndarray, count: int) -> tuple[np.ndarray, float]:
    """Weights and bias, with a penalty on the squared weights."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.array([x for r in rows for x in r], dtype=np.int64)
    weight, bias = np.zeros(count), float(np.log((label.mean() + 1e-6) / (1 - label.mean() + 1e-6)))
    speed, speed_bias, penalty = np.zeros(count), 0.0, 0.5 / len(rows)
    for _ in range(500):
        logit = bias + np.bincount(at, weight[what], minlength=len(rows))
        error = (1 / (1 + np.exp(-logit)) - label) / len(rows)
        slope = np.bincount(what, error[at], minlength=count) + penalty * weight
        speed, speed_bias = 0.9 * speed - 2.0 * slope, 0.9 * speed_bias - 0.5 * error.sum()
        weight, bias = weight + speed, bias + speed_bias
    return weight, bias


def fit(docs: DataFrame, labels: DataFrame) -> bytes:
    """Character model, features and weights, as bytes."""
    model = character_model(docs)
    sample = labelled(docs, labels)
    n = {r["toxic"] > 0: r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(True, 0), n.get(False, 0)
    if not bad or not good:
        share = min(max((bad + 0.5) / (bad + good + 1), 1e-3), 1 - 1e-3)
        return pickle.dumps((model, {}, np.zeros(0), float(np.log(share / (1 - share)))))
    # Documents that reach each density: sums over the densities from there on.
    reached = [
        F.sum(F.when(F.col("level") >= n, F.col(kind))).alias(f"{kind}{n}")
        for kind in ("toxic", "clean")
        for n in range(1, len(DENSITIES) + 1)
    ]
    counts = (
        sample.mapInArrow(
            lambda it: feature_counts(it, model), "feature string, level int, toxic bigint, clean bigint"
        )
        .groupBy("feature").agg(*reached)
        .where(F.col("toxic1") >= LEAST_DOCS)
    )
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    share = bad / (bad + good)

    def gain(n: int) -> Column:
        toxic, clean = (F.coalesce(F.col(f"{kind}{n}"), F.lit(0)) for kind in ("toxic", "clean"))
        ratio = part(toxic, (toxic + clean) * share) + part(clean, (toxic + clean) * (1 - share))
        return F.when(toxic / bad > 2 * clean / good, 2 * ratio).otherwise(0.0)

    chosen = (
        counts.withColumn("gain", F.greatest(*[gain(n) for n in range(1, len(DENSITIES) + 1)]))
        .where(F.col("gain") >= LEAST_GAIN)
        .orderBy(F.desc("gain"), "feature").limit(FEATURES).collect()
    )
    wanted = {r["feature"]: i for i, r in enumerate(chosen)}
    rows = sample.mapInArrow(lambda it: found_features(it, model, wanted), "toxic int, found array<int>").toArrow()
    label = (rows["toxic"].to_numpy() > 0).astype(float)
    weight, bias = logistic(rows["found"].to_pylist(), label, max(1, len(wanted) * len(DENSITIES)))
    return pickle.dumps((model, wanted, weight, bias))


class Scorer:
    def __init__(self, trained: bytes):
        model, wanted, self.weight, self.bias = pickle.loads(trained)
        self.reader = Reader(model, wanted)

    def score(self, texts_: list[str | None]) -> np.ndarray:
        logits = [
            self.bias + float(self.weight[found].sum())
            for _, some in groups(texts_, SMALLER)
            for found in self.reader.present(some)
        ]
        return 1 / (1 + np.exp(-np.array(logits, dtype=np.float64)))


@one_model
def scorer(trained: bytes) -> Scorer:
    """One per Python worker and model."""
    return Scorer(trained)


def scored(batches: Iterator[pa.RecordBatch], trained: bytes) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, SMALLER):
        scores = scorer(trained).score(batch["text"].to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], pa.array(scores), pa.array((scores >= LIMIT).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )


def toxicity_scores(docs: DataFrame, trained: bytes) -> DataFrame:
    """Score and decision for every text."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return rows.mapInArrow(
        lambda it: scored(it, trained), "doc_id bigint, held_out boolean, score double, predicted int"
    )


def without_toxic(docs: DataFrame, trained: bytes) -> DataFrame:
    """The rows, unchanged, whose text is not predicted to be toxic."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, SMALLER):
            yield batch.filter(pa.array(scorer(trained).score(batch["text"].to_pylist()) < LIMIT))

    return docs.mapInArrow(kept, docs.schema)
