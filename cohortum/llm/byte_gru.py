"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes from both sides, gives every byte position probabilities of the
languages, and a document's are pooled over all its positions: the language with the largest sum
of log probabilities is predicted, its mean probability is the score. The state starts anew at
white space, so a word is worked out once per worker however often it occurs; a word of more than
``WINDOW`` bytes is read in overlapping windows. Training is backpropagation through time in numpy,
with Adam, on a bounded sample: ``DOCS`` documents and ``WORDS`` words of each language, fewer of
each beyond ``LANGUAGES`` languages, chosen by hash among the rows that may be learned from.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text
if nothing could be learned; rows without a language are not learned from; repeated rows and null
identifiers are kept; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortum.llm.common import held_out, pieces
from cohortum.llm.wordcache import FEWER, SMALLER, Words, groups, one_model

HIDDEN, WINDOW, CONTEXT, DOCS, WORDS, LANGUAGES = 16, 24, 6, 400, 12_000, 64
STEPS, BATCH, UNKNOWN = 700, 256, "und"
Weights = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    out = 0.5 * x
    np.tanh(out, out=out)
    out *= 0.5
    out += 0.5
    return out


def start_weights(labels: int, seed: int = 5) -> Weights:
    noise = np.random.default_rng(seed)
    draw = lambda *shape: (noise.standard_normal(shape) * 0.3).astype(np.float32)
    out = {"v": draw(2 * HIDDEN, labels), "v0": np.zeros(labels, np.float32)}
    for side in "fb":
        out |= {f"w{side}": draw(256, 3 * HIDDEN), f"u{side}": draw(HIDDEN, 3 * HIDDEN)}
    return out


def read_side(bytes_: np.ndarray, w: np.ndarray, u: np.ndarray, keep: bool = False):
    """States after each byte, shape (time, rows, HIDDEN), and what going back needs."""
    rows, time = bytes_.shape
    state, kept = np.zeros((rows, HIDDEN), np.float32), []
    states = np.empty((time, rows, HIDDEN), np.result_type(np.float32, w, u))
    gates, other = u[:, : 2 * HIDDEN], u[:, 2 * HIDDEN :]
    for t in range(time):
        x = w[bytes_[:, t]]
        zr = sigmoid(x[:, : 2 * HIDDEN] + state @ gates)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN :] + (r * state) @ other)
        if keep:
            kept.append((state, z, r, c))
        state = state + z * (c - state)
        states[t] = state
    return states, kept


def back_through_time(bytes_: np.ndarray, slopes: np.ndarray, kept: list, u: np.ndarray):
    """Gradients of one side's weights from the slopes of its states."""
    dw, du = np.zeros((256, 3 * HIDDEN), np.float32), np.zeros_like(u)
    gates, other = u[:, : 2 * HIDDEN], u[:, 2 * HIDDEN :]
    after = np.zeros_like(slopes[0])
    for t in range(len(kept) - 1, -1, -1):
        state, z, r, c = kept[t]
        d = slopes[t] + after
        dc = d * z * (1 - c * c)
        through = dc @ other.T
        dz, dr = d * (c - state) * z * (1 - z), through * state * r * (1 - r)
        dzr = np.concatenate([dz, dr], axis=1)
        du[:, : 2 * HIDDEN] += state.T @ dzr
        du[:, 2 * HIDDEN :] += (r * state).T @ dc
        np.add.at(dw, bytes_[:, t], np.concatenate([dzr, dc], axis=1))
        after = d * (1 - z) + through * r + dzr @ gates.T
    return dw, du


def log_probabilities(bytes_: np.ndarray, weights: Weights) -> np.ndarray:
    """Log probabilities of the labels at each position, shape (time, rows, labels)."""
    ahead, _ = read_side(bytes_, weights["wf"], weights["uf"])
    behind, _ = read_side(bytes_[:, ::-1], weights["wb"], weights["ub"])
    return log_softmax(np.concatenate([ahead, behind[::-1]], axis=2) @ weights["v"] + weights["v0"])


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def gradients(bytes_: np.ndarray, label: np.ndarray, weights: Weights) -> Weights:
    """Gradients of the mean cross entropy over all positions."""
    ahead, kept_f = read_side(bytes_, weights["wf"], weights["uf"], keep=True)
    behind, kept_b = read_side(bytes_[:, ::-1], weights["wb"], weights["ub"], keep=True)
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    error = np.exp(log_softmax(both @ weights["v"] + weights["v0"]))
    error[:, np.arange(len(label)), label] -= 1
    error /= error.shape[0] * error.shape[1]
    slopes = error @ weights["v"].T
    out = {"v": np.einsum("tbh,tbl->hl", both, error), "v0": error.sum(axis=(0, 1))}
    out["wf"], out["uf"] = back_through_time(bytes_, slopes[..., :HIDDEN], kept_f, weights["uf"])
    out["wb"], out["ub"] = back_through_time(
        bytes_[:, ::-1], slopes[::-1, :, HIDDEN:], kept_b, weights["ub"]
    )
    return out


def spans(word: bytes) -> list[tuple[int, int, int, int]]:
    """Windows of a word, and which of its positions each stands for.

    A word of up to ``WINDOW`` bytes is one window. A longer one, such as a text without spaces, is
    cut into steps at character borders; each is read with ``CONTEXT`` bytes more on either side.
    """
    size = len(word)
    if size <= WINDOW:
        return [(0, size, 0, size)]

    def border(at: int) -> int:
        while 0 < at < size and word[at] & 0xC0 == 0x80:
            at -= 1
        return min(max(at, 0), size)

    step = WINDOW - 2 * CONTEXT
    cuts = sorted({*(border(at) for at in range(0, size, step)), size})
    return [(border(a - CONTEXT), border(b + CONTEXT), a, b) for a, b in zip(cuts, cuts[1:])]


def windows(words: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: the bytes of all windows, the numbers of their words, and a mark for each
    position that the window stands for."""
    if not words:
        return {}
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    content, begins = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
    # Most words are one window; only the others are looked at one by one.
    several = np.flatnonzero(sizes > WINDOW)
    cuts = [spans(words[i]) for i in several.tolist()]
    counts = np.ones(len(words), np.int64)
    counts[several] = [len(x) for x in cuts]
    number = np.repeat(np.arange(len(words)), counts)
    end = sizes[number]
    start, low, high = np.zeros_like(end), np.zeros_like(end), end.copy()
    if cuts:
        part = end > WINDOW
        start[part], end[part], low[part], high[part] = np.array([x for one in cuts for x in one]).T
    lengths, first, held = np.unique(end - start, return_index=True, return_counts=True)
    rows_of = np.split(np.argsort(end - start, kind="stable"), np.cumsum(held)[:-1])
    out = {}
    for i in np.argsort(first).tolist():
        rows, at = rows_of[i], np.arange(lengths[i])
        out[int(lengths[i])] = (
            content[(begins[number[rows]] + start[rows])[:, None] + at], number[rows],
            (at[:, None] >= (low - start)[rows]) & (at[:, None] < (high - start)[rows]),
        )
    return out


def train(words: list[bytes], labels: list[int], count: int, steps: int = STEPS) -> Weights:
    weights, noise = start_weights(count), np.random.default_rng(9)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    label = np.array(labels)
    parts = list(windows(words).values())
    share = np.array([bytes_.size for bytes_, _, _ in parts], dtype=float)
    for step in range(1, steps + 1):
        bytes_, numbers, _ = parts[noise.choice(len(parts), p=share / share.sum())]
        rows = noise.integers(len(bytes_), size=min(BATCH, len(bytes_)))
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, slope in gradients(bytes_[rows], label[numbers[rows]], weights).items():
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope**2
            scale = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            weights[k] -= rate * scale * first[k] / (np.sqrt(second[k]) + 1e-7)
    return weights


def quota(most: int, least: int, languages: int) -> int:
    """What each language may have of a sample: ``most``, or less if there are very many."""
    return max(least, min(most, LANGUAGES * most // max(1, languages)))


def fit(docs: DataFrame) -> bytes:
    """A network for the languages of the documents that may be learned from, as bytes.

    Every language is learned: up to ``LANGUAGES`` of them with the whole sample of each, more of
    them with smaller ones, of 4 documents and 50 words at least.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang").where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    # A row for each language.
    found = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    docs_each, words_each = quota(DOCS, 4, len(found)), quota(WORDS, 50, len(found))
    # The documents of least hash; few have a hash below what about twice as many would have.
    highest = [int(-(2**63) + 2**64 * min(1.0, (2 * docs_each + 50) / max(1, n))) - 1 for n in found.values()]
    # From Arrow: rows of Python objects would start Python workers of their own kind beside the others.
    limits = rows.sparkSession.createDataFrame(
        pa.table([pa.array(list(found), pa.string()), pa.array(highest, pa.int64())], ["lang", "highest"])
    )
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # Chosen by identifier and language alone; no more rows to broadcast than the quotas allow.
    chosen = (
        rows.select("doc_id", "lang").join(F.broadcast(limits), "lang")
        .where(F.xxhash64("doc_id") <= F.col("highest")).select("doc_id", "lang").distinct()
        .withColumn("place", F.row_number().over(by_hash))
        .where(F.col("place") <= docs_each)
        .select("doc_id", "lang")
    )
    # One text of each, however many rows an identifier has.
    texts = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    sample = texts.select("lang", F.explode(F.split("text", r"\s+")).alias("word")).where("word <> ''")
    by_word = Window.partitionBy("lang").orderBy(F.xxhash64("word"), "word")
    sample = (
        sample.withColumn("place", F.row_number().over(by_word))
        .where(F.col("place") <= words_each)
        .select("lang", F.encode("word", "UTF-8").alias("word"))
        .orderBy("lang", "place")
        .toArrow()
    )
    langs = sorted(set(sample["lang"].to_pylist()))
    if not langs:
        return pickle.dumps(([], {}))
    labels = [langs.index(x) for x in sample["lang"].to_pylist()]
    return pickle.dumps((langs, train(sample["word"].to_pylist(), labels, len(langs))))


class Labeller:
    """Pools the position labels of whole texts."""

    def __init__(self, model: bytes):
        import regex

        self.langs, self.weights = pickle.loads(model)
        self.letter = regex.compile(r"\p{L}").search
        self.words = Words(self.sums, FEWER)

    def sums(self, words: list[str]) -> list[bytes]:
        """For each word the sums over its bytes: log probabilities, probabilities, one."""
        labels = len(self.langs)
        out = np.zeros((len(words), 2 * labels + 1), dtype=np.float32)
        for bytes_, numbers, own in windows([w.encode() for w in words]).values():
            for start in range(0, len(bytes_), 4096):
                some, mine = bytes_[start : start + 4096], own[:, start : start + 4096, None]
                logs = log_probabilities(some, self.weights)
                parts = [(x if mine.all() else x * mine).sum(axis=0) for x in (logs, np.exp(logs))]
                sums = np.concatenate([*parts, mine.sum(axis=0)], axis=1)
                own_rows = numbers[start : start + 4096]
                if (own_rows[1:] > own_rows[:-1]).all():
                    out[own_rows] += sums
                else:
                    np.add.at(out, own_rows, sums)
        whole, size = out.tobytes(), 4 * out.shape[1]
        return [whole[i : i + size] for i in range(0, len(whole), size)]

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores, labels = [], [], len(self.langs)
        for _, some in groups(texts, SMALLER):
            rows = [text.split() for text in some]
            known = self.words.learn(rows) if labels else None
            for text, row in zip(some, rows):
                if not labels or not self.letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                pooled = np.frombuffer(b"".join(map(known, row)), np.float32)
                pooled = pooled.reshape(len(row), -1).sum(axis=0, dtype=np.float64)
                best = int(pooled[:labels].argmax())
                names.append(self.langs[best])
                scores.append(float(min(1.0, pooled[labels + best] / pooled[-1])))
        return names, scores


@one_model
def labeller(model: bytes) -> Labeller:
    """One per Python worker and model."""
    return Labeller(model)


def predicted(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, SMALLER):
        names, scores = labeller(model).label(batch["text"].to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def language_predictions(docs: DataFrame, model: bytes) -> DataFrame:
    """Predicted language and score of every text."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return rows.mapInArrow(
        lambda it: predicted(it, model), "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def with_language(docs: DataFrame, model: bytes, least: float) -> DataFrame:
    """The rows, unchanged, whose text has a language with a score of at least ``least``."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, SMALLER):
            names, scores = labeller(model).label(batch["text"].to_pylist())
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
