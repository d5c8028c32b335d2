from __future__ import annotations

import hashlib
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortum.llm import byte_pairs, grouped_packing, token_files, tokens
from cohortum.llm.grouped_packing import CAPACITY, best_fit, make_plan, packed, places
from cohortum.llm.token_files import pack, token_file_digests, unpack
from cohortum.llm.tokens import encoder
from tests.llm.helpers import documents, odd_texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library(name: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer


def ids_of(tokenizer: Tokenizer, text: str | None) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_word_by_word_is_the_whole_text(name, spaced):
    coder, plain = encoder(public_tokenizers.path(name), spaced), library(name)
    alphabet = st.sampled_from(list("ab'tsZ,. \n\t\r \x1c\x01é1½日!Σİ") + ["  ", " the", "'s"])

    @settings(max_examples=150, deadline=None)
    @given(st.lists(alphabet, max_size=25).map("".join))
    def check(text):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == ids_of(plain, text)

    check()


def expected_pairs(text: str | None) -> tuple:
    coder = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pairs.read_ranks(RANKS), special_tokens={}
    )
    return coder.encode_ordinary(text or "")


def test_byte_pairs_both_ways(spark):
    texts = odd_texts()
    docs = documents(spark, texts)
    expected = {i: expected_pairs(text) for i, text in enumerate(texts, 1)}
    native = byte_pairs.encoded_by_functions(docs, RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"]: r["ids"] for r in native.collect()} == expected
    for r in byte_pairs.round_trip_digests(docs, RANKS, public_tokenizers.PATTERN).collect():
        ids = expected[r["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"] - 1] or "").encode()).hexdigest()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=40))
def test_codes_round_trip(numbers):
    values = np.array(numbers, dtype=np.uint32)
    control, data = pack(values)
    assert len(control) == -(-len(values) // 4)
    assert unpack(control, data, len(values)).tolist() == numbers


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_CHARACTERS", 500)
    texts = odd_texts()
    ids = [5, 3, 3, *range(10, 10 + len(texts) - 4), None]
    plain = library("word_bpe_49k.json")
    found = token_file_digests(documents(spark, texts, ids), public_tokenizers.path("word_bpe_49k.json"), 1)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")
    start, expected = 0, []
    for doc_id, text in sorted(zip(ids, texts), key=key):
        tokens = [*ids_of(plain, text), 1]
        expected.append((doc_id, start, len(tokens), crc(tokens)))
        start += len(tokens)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("doc_id", [7, None])
def test_rows_of_one_identifier_are_dealt_over_tasks(spark, doc_id):
    others = spark.range(0, 2000, 1, 4).selectExpr("id AS doc_id", "'x ' || id AS text")
    same = spark.range(0, 4000, 1, 4).select(F.lit(doc_id).cast("bigint").alias("doc_id"), F.lit("the same").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as for large partitions
    try:
        rows = token_files.dealt(others.unionByName(same))
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 6000 and max(sizes) < 2000
    ids = [r["doc_id"] for r in rows.collect()]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_token_files_of_an_empty_table(spark):
    found = token_file_digests(documents(spark, []), public_tokenizers.path("word_bpe_49k.json"), 1)
    assert found.collect() == []


def test_packing(spark):
    texts, plain = odd_texts() + ["y z " * 3000], library("byte_bpe_50k.json")
    found = packed(documents(spark, texts), public_tokenizers.path("byte_bpe_50k.json"), 0).collect()
    total, by_sequence = 0, {}
    for i, text in enumerate(texts, 1):
        tokens, at = [*ids_of(plain, text), 0], 0
        total += len(tokens)
        own = sorted((r for r in found if r["doc_id"] == i), key=lambda r: r["piece"])
        for piece, r in enumerate(own):
            assert (r["piece"], r["start"]) == (piece, at)
            assert r["ids_crc32"] == crc(tokens[at : at + r["length"]])
            assert r["length"] == CAPACITY or piece == 0
            at += r["length"]
        assert at == len(tokens)
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by_sequence.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)]).tolist()]
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= CAPACITY
    assert len(by_sequence) <= -(-total // CAPACITY) + 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 300), max_size=30))
def test_plans_place_every_length_once(counts):
    plan = make_plan(counts, 100)
    placed = {}
    for times, lengths in plan:
        assert times > 0 and sum(lengths) <= 100
        for length in lengths:
            placed[length] = placed.get(length, 0) + times
    assert placed == counts
    # Never worse than a best fit of all lengths from the longest on, by more than a sequence.
    full = [(counts[100], (100,))] if 100 in counts else []
    alone = best_fit({x: n for x, n in counts.items() if x < 100}, full, 100)
    assert sum(times for times, _ in plan) <= sum(times for times, _ in alone) + 1
    lengths, firsts, _, _ = places(plan)
    assert all(firsts[lengths == x].min() == 0 for x in counts)


def test_sequences_are_as_few_as_the_tokens_allow():
    """Lengths like those of documents; the bound is the sum of all tokens."""
    draw = np.random.default_rng(5)
    lengths = np.minimum(draw.lognormal(6, 1.1, 20_000).astype(int) + 2, CAPACITY)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    bound = -(-int(lengths.sum()) // CAPACITY)
    assert sum(times for times, _ in make_plan(counts)) <= 1.002 * bound + 1


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@pytest.mark.parametrize("most, most_bytes, hashed", [(40, 1 << 20, True), (10**6, 400, True), (200, 1 << 20, False)])
def test_ids_depend_on_no_memory(monkeypatch, name, spaced, most, most_bytes, hashed):
    """A memory that is full again and again, and units that all have one hash."""
    if not hashed:
        monkeypatch.setattr(tokens, "hashes", lambda units: np.zeros(len(units), dtype=np.uint64))
    coder, plain = tokens.Encoder(public_tokenizers.path(name), spaced), library(name)
    coder.units = tokens.Units(most, most_bytes)
    rows = [text or "" for text in odd_texts()] + ["a\nÉté, ×÷ µ\nb.", "long" * 40 + "\n" + "long" * 41, "common " * 9 + "é"]
    for some in [rows, rows[::-1], rows[:9], *([text] for text in rows), [f"w{i} common" for i in range(300)], rows]:
        found = [np.frombuffer(ids, "<u4").tolist() for ids in coder.encode(some)]
        assert found == [ids_of(plain, text) for text in some]


def test_a_full_memory_of_units_stays_small():
    coder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    coder.encode(["one " * 10])
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for block in range(20):
        coder.encode([" ".join(f"u{block}x{i}" for i in range(20_000)) + " again and again"])
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(coder.units.known) > 400_000 and held < 110 * len(coder.units.known)


def test_pieces_are_encoded_a_few_megabytes_at_a_time(spark, monkeypatch):
    """A batch with a whole partition is not encoded at once."""
    seen = []

    class Coder:
        def encode(self, some):
            seen.append(sum(map(len, some)))
            return [b"" for _ in some]

    monkeypatch.setattr(grouped_packing, "encoder", lambda path, spaced: Coder())
    monkeypatch.setattr(grouped_packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(12)), "text": ["x" * (1 << 20)] * 11 + [None]})
    out = list(grouped_packing.pieces_of(iter([batch]), "", True, 0, 100))
    assert sum(x.num_rows for x in out) == 12 and max(seen) <= 4 << 20


def test_packing_of_an_empty_table(spark):
    assert packed(documents(spark, []), public_tokenizers.path("byte_bpe_50k.json"), 0).collect() == []


def test_packed_bytes_are_those_of_the_format():
    from cohortum.llm import token_files

    draw = np.random.default_rng(3)
    for bits in ([8], [8, 16], [8, 16, 24, 32], [32], []):
        many = 1003 if bits else 0
        tops = draw.choice(bits, many) if bits else np.zeros(0, dtype=np.int64)
        numbers = np.array([draw.integers(0, 2**b) for b in tops], dtype=np.uint32)
        numbers[: len(numbers) // 50 * 10] = np.resize([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 1, 0], len(numbers) // 50 * 10)
        sizes = [max(1, -(-int(x).bit_length() // 8)) for x in numbers]
        padded = [*sizes, *[1] * (-len(sizes) % 4)]
        control = bytes(sum((padded[i + k] - 1) << 2 * k for k in range(4)) for i in range(0, len(padded), 4))
        data = b"".join(int(x).to_bytes(n, "little") for x, n in zip(numbers, sizes))
        assert token_files.pack(numbers) == (control, data)
        assert token_files.unpack(control, data, len(numbers)).tolist() == numbers.tolist()
