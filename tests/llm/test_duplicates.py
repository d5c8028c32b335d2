from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortum.llm import anchors, fm_index, lsh_forest, suffix_dedup
from cohortum.llm.components import components
from cohortum.llm.wordcache import Words
from tests.llm.helpers import WORD, documents, odd_texts, prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def corpus() -> tuple[list[str | None], list[int | None]]:
    """Odd texts, shared passages, near copies with few and many changes, exact copies."""
    draw, texts = random.Random(4), odd_texts()
    passage = prose(90, 70)
    for i in range(6):
        texts.append(f"{prose(100 + i, 40)} {passage} {prose(200 + i, 40)}")
    for group in range(4):
        words = prose(300 + group, 150, 5000).split()
        for copy in range(12):
            changed = list(words)
            for _ in range(copy % 5 * 2):
                changed[draw.randrange(len(changed))] = f"z{draw.randrange(9999)}"
            texts.append(" ".join(changed))
    ids: list[int | None] = list(range(1000, 1000 + len(texts)))
    draw.shuffle(ids)
    ids[5] = ids[6]
    ids[8] = None
    return texts, ids


def removed(sequences: list, ids: list[int | None]) -> list[bytearray]:
    first: dict = {}
    for doc_id, sequence in zip(ids, sequences):
        for at in range(len(sequence) - 49 if doc_id is not None else 0):
            window = tuple(sequence[at : at + 50])
            first[window] = min(doc_id, first.get(window, doc_id))
    out = []
    for doc_id, sequence in zip(ids, sequences):
        marks = bytearray(len(sequence))
        for at in range(len(sequence) - 49 if doc_id is not None else 0):
            if first[tuple(sequence[at : at + 50])] < doc_id:
                marks[at : at + 50] = b"\1" * 50
        out.append(marks)
    return out


@pytest.mark.parametrize("crowded", [2, 2000])
def test_bytes_of_later_copies(spark, monkeypatch, crowded):
    monkeypatch.setattr(anchors, "CROWDED", crowded)
    monkeypatch.setattr(anchors, "BATCH_BYTES", 15_000)
    texts, ids = corpus()
    raw = [(t or "").encode() for t in texts]
    expected = []
    for doc_id, text, marks in zip(ids, raw, removed(raw, ids)):
        kept = bytes(c for c, gone in zip(text, marks) if not gone)
        spans = (b"\0" + bytes(marks)).count(b"\0\1")
        expected.append((doc_id, len(text), sum(marks), spans, hashlib.sha256(kept).hexdigest()))
    found = suffix_dedup.without_later_copies(documents(spark, texts, ids))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("crowded", [2, 2000])
def test_words_of_later_copies(spark, monkeypatch, crowded):
    monkeypatch.setattr(anchors, "CROWDED", crowded)
    monkeypatch.setattr(anchors, "BATCH_BYTES", 15_000)
    texts, ids = corpus()
    words = [WORD.findall(t or "") for t in texts]
    expected = []
    for doc_id, own, marks in zip(ids, words, removed(words, ids)):
        kept = " ".join(w for w, gone in zip(own, marks) if not gone)
        expected.append((doc_id, len(own), sum(marks), hashlib.sha256(kept.encode()).hexdigest()))
    found = fm_index.without_later_copies(documents(spark, texts, ids))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_texts_are_cut_and_other_columns_kept(spark):
    passage = prose(7, 60)
    docs = documents(spark, [passage, "new " + passage + " more", None])
    found = {r["doc_id"]: r for r in suffix_dedup.with_texts_cut(docs).collect()}
    assert (found[1]["text"], found[2]["text"], found[3]["text"]) == (passage, "new more", None) or (
        found[2]["text"].startswith("new") and found[2]["text"].endswith("more")
    )
    assert found[2]["n_chars"] == len(found[2]["text"]) and found[2]["batch"] == "b"


def test_rows_are_shuffled_once_to_cut_their_texts(spark):
    texts, ids = corpus()
    docs = documents(spark, texts, ids)
    found = suffix_dedup.with_texts_cut(docs)
    assert found.dtypes == docs.dtypes and found.count() == len(texts)
    assert " Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    left = found.where("doc_id IS NULL OR length(text) >= n_chars").count()
    assert left == len([t for t in texts if t is not None]) + found.where("doc_id IS NULL AND text IS NULL").count()


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


@pytest.mark.parametrize("window", [6, 256])
def test_near_duplicates(spark, monkeypatch, window):
    monkeypatch.setattr(lsh_forest, "WINDOW", window)
    texts, ids = corpus()
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))
    for i, one in enumerate(sets):
        for j in range(i):
            if one and 100 * len(one & sets[j]) >= 75 * len(one | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    expected = []
    for i, own in enumerate(sets):
        members = [ids[j] for j in range(len(texts)) if group[j] == group[i] and ids[j] is not None]
        smallest = min(members, default=None) if own else ids[i]
        expected.append((ids[i], len(own), smallest, ids[i] == smallest))
    found = lsh_forest.near_duplicates(documents(spark, texts, ids)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("most", [600, 2048])
def test_pairs_in_a_dense_region(spark, monkeypatch, most):
    """A template just under the threshold, with pairs and a chain just above it."""
    monkeypatch.setattr(lsh_forest, "BLOCK", most)
    monkeypatch.setattr(lsh_forest, "SET_BYTES", most * 1600)
    template, texts = prose(11, 150, 5000), []
    for i in range(2000):
        shared = prose(20_000 + i // 2 if i < 200 else 30_000 + i, 6, 90_000)
        texts.append(f"{template} {shared} {prose(40_000 + i, 24, 90_000)}")
    ends = [prose(50_000 + i, 10, 90_000) for i in range(21)]
    texts += [f"{template} {ends[i]} {prose(60_000 + i, 10, 90_000)} {ends[i + 1]}" for i in range(20)]
    random.Random(5).shuffle(texts)
    sets = [shingles(t) for t in texts]
    times = Counter(x for one in sets for x in one)
    number = {x: i for i, x in enumerate(x for x in times if times[x] > 1)}
    has = np.zeros((len(sets), len(number)), dtype=np.float32)
    for row, one in zip(has, sets):
        row[[number[x] for x in one if x in number]] = 1
    common, size = has @ has.T, np.array([len(one) for one in sets])
    group = np.arange(len(sets))
    for i, j in np.argwhere(np.triu(100 * common >= 75 * (size[:, None] + size - common), 1)).tolist():
        group[group == max(group[i], group[j])] = min(group[i], group[j])
    assert len(np.unique(group)) == 1901  # 100 pairs and a chain of 20
    found = lsh_forest.near_duplicates(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i + 1: int(g) + 1 for i, g in enumerate(group)}


def test_one_of_each_group_stays(spark):
    text = prose(5, 40).replace("é", "e")
    kept = lsh_forest.without_near_duplicates(documents(spark, [text, text, "other", None, text.upper()], [4, 2, 3, 7, 9]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 7] and len(kept.columns) == 11


@pytest.mark.parametrize("operator", [suffix_dedup.without_later_copies, fm_index.without_later_copies, lsh_forest.near_duplicates, suffix_dedup.with_texts_cut, lsh_forest.without_near_duplicates])
def test_empty_tables_and_tables_without_text(spark, operator):
    assert operator(documents(spark, [])).collect() == []
    assert operator(documents(spark, [None, None])).count() == 2


def test_components_of_chains_and_stars(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(300, 300), (402, 401)]
    draw.shuffle(edges)
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    expected = {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 160)} | {402: 401}
    assert found == expected


def test_fm_index_counts_like_a_scan():
    import numpy as np

    draw = np.random.default_rng(2)
    sizes = np.array([60, 75, 50, 90])
    symbols = draw.integers(1, 4, sizes.sum())
    index = fm_index.FMIndex(symbols, np.cumsum(sizes) - sizes, sizes)
    low, high = np.array([index.smaller[2]]), np.array([index.smaller[2] + index.total[2]])
    low, high = index.step(np.array([1]), low, high)
    starts = np.cumsum(sizes) - sizes
    parts = [symbols[a : a + n].tolist() for a, n in zip(starts, sizes)]
    assert int(high[0] - low[0]) == sum(p[i : i + 2] == [1, 2] for p in parts for i in range(len(p) - 1))


def test_few_edges_need_no_star_steps(spark, monkeypatch):
    from cohortum.llm import components as module

    steps, written = [], []
    star_steps, materialise = module.star_steps, module.materialise
    monkeypatch.setattr(module, "star_steps", lambda e: steps.append(1) or star_steps(e))
    monkeypatch.setattr(module, "materialise", lambda df: written.append(1) or materialise(df))
    frame = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint").repartition(5)
    expected = {i: 0 for i in range(1, 41)}
    assert {r["node"]: r["root"] for r in components(frame).collect()} == expected
    assert (len(steps), len(written)) == (0, 2)
    monkeypatch.setattr(module, "TOGETHER", 8)  # several partitions: steps until only stars are left
    assert {r["node"]: r["root"] for r in components(frame).collect()} == expected
    assert steps


@pytest.mark.parametrize("texts", [[], [None], ["", " \t"], odd_texts(), ["a" * n + " " for n in range(200)]])
def test_words_are_cut_and_hashed_alike(texts):
    symbols, ends = fm_index.word_symbols(texts)
    words = [WORD.findall(t or "") for t in texts]
    assert np.diff(ends, prepend=0).tolist() == list(map(len, words))
    numbers: dict = {}
    for word, symbol in zip([w for row in words for w in row], symbols.tolist()):
        assert numbers.setdefault(word, symbol) == symbol
    assert len(set(numbers.values())) == len(numbers)


@pytest.mark.parametrize("bits", [4, 40])
def test_suffixes_in_order_and_their_first_symbols(monkeypatch, bits):
    in_order = fm_index.in_order
    monkeypatch.setattr(fm_index, "in_order", lambda key, own: in_order(key, max(own, bits)) if bits > 21 else in_order(key, own))
    draw = np.random.default_rng(bits)
    block = draw.integers(0, 3, 80)
    symbols = np.concatenate([block, [7], block, [8], draw.integers(0, 2, 100), [9]])
    order, agree = fm_index.suffixes(symbols)
    rows = symbols.tolist()
    assert order.tolist() == sorted(range(len(rows)), key=lambda i: rows[i:])
    first = [rows[i : i + fm_index.HALF] for i in range(len(rows))]
    same = agree[:, None] == agree
    assert all(same[i, j] == (first[i] == first[j]) for i in range(len(rows)) for j in range(len(rows)))


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_shingles_are_those_of_each_text_alone(kind):
    texts = [*odd_texts(), "A b\tC\nd\x0be\x0cF\rg", "end", "start", None, " lead", "trail ", "É\x1cÉ a\0b"]
    expected = []
    for text in texts[2:]:
        words = [int.from_bytes(xxhash.xxh3_64_digest(x), "little") for x in (text or "").encode().lower().split()]
        size, sets = min(len(words), lsh_forest.SHINGLE), set()
        for at in range(len(words) - size + 1 if words else 0):
            mixed = (size + sum(x * y for x, y in zip(words[at : at + size], lsh_forest.PLACES.tolist()))) % 2**64
            sets.add((mixed ^ mixed >> 31) * 0x9E3779B97F4A7C15 % 2**64)
        expected.append(sorted(sets))
    assert [x.tolist() for x in lsh_forest.shingle_sets(pa.array(texts, kind).slice(2))] == expected
    assert list(lsh_forest.shingle_sets(pa.array([], kind))) == []


def test_signing_holds_few_words_and_remembers_none():
    before = Words(lambda new: [w.encode() for w in new])
    before.learn([["a", "word", "of", "an", "earlier", "step"]])
    texts = pa.array([" ".join(f"{doc:04d}{i:04d}" for i in range(2500)) for doc in range(400)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), texts], ["doc_id", "text"])
    tracemalloc.start()
    try:
        rows = sum(some.num_rows for some in lsh_forest.signed(iter([batch])))
        left, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert rows == 400 and not before.known
    assert most < 64 << 20 and left < 4 << 20  # a million different words in nine megabytes


def test_windows_are_sorted_without_an_index_for_each_of_their_bytes():
    content = np.random.default_rng(8).integers(0, 4, 40_000).astype(np.uint8)
    starts = np.arange(len(content) - anchors.WINDOW + 1)
    tracemalloc.start()
    found = suffix_dedup.previous_factors(content, starts, starts // 1000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found <= starts // 1000).all() and peak < 350 * len(starts)


def test_memory_goes_back_after_the_last_piece(monkeypatch):
    from cohortum.llm import common

    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10] * 5})
    assert [x.num_rows for x in common.pieces(iter([batch, batch]), 30)] == [3, 2, 3, 2] and given == [1]
