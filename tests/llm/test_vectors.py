from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortum.llm import exact_topk as exact
from cohortum.llm import learned_partitions as learned

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, part string"


def vectors(spark, rows: list[tuple]):
    return spark.createDataFrame([(i, v, 0, "s", "p") for i, v in rows], SCHEMA)


def random_rows(count: int, width: int = 8) -> list[tuple]:
    noise = np.random.default_rng(count).standard_normal((count, width)).astype(np.float32)
    return [(i, row.tolist()) for i, row in enumerate(noise)]


ODD = [
    (1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [float("inf")] + [1.0] * 7),
    (1005, [None, 1.0]), (None, [1.0] * 8), (1010, [0.5, 0.5]), (1020, [-0.0] * 8), (1040, [2.0] * 8),
]


def usable(rows: list[tuple], zeros: bool) -> list[tuple[int, np.ndarray]]:
    out = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            padded = np.zeros(8)
            padded[: len(v)] = v
            if zeros or padded.any():
                out.append((i, padded))
    return out


def brute(rows, every: int, k: int, whole: bool) -> dict[int, list[tuple]]:
    kept = usable(rows, zeros=whole)
    change = (lambda v: np.floor(256 * v).astype(np.int64)) if whole else (lambda v: v)
    ids, matrix = np.array([i for i, _ in kept]), np.array([change(v) for _, v in kept])
    out = {}
    for i, v in zip(ids, matrix):
        if i % every == 0:
            scores = matrix @ v
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), scores[j]) for j in order]
    return out


def found_of(frame) -> dict[int, list[tuple]]:
    out: dict[int, list] = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_exact_search_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact, "CANDIDATES", 40)
    monkeypatch.setattr(exact, "QUERIES", 5)
    rows = random_rows(300) + ODD + [(i, [1.0] * 8) for i in range(2000, 2050)]
    found = found_of(exact.exact_topk(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5))
    assert found == brute(rows, 50, 5, whole=True)


def test_scores_beyond_a_long_stop_the_job(spark):
    with pytest.raises(PySparkException):
        exact.exact_topk(vectors(spark, [(0, [1e30]), (1, [1e30])]), F.col("vec_id") % 50 == 0, 5).collect()


@pytest.mark.parametrize("operator", [exact.exact_topk, learned.nearest_by_learned_partitions])
def test_empty_tables_and_single_vectors(spark, operator):
    assert operator(vectors(spark, []), F.col("vec_id") % 50 == 0, 5).collect() == []
    assert operator(vectors(spark, [(0, [1.0])]), F.col("vec_id") % 50 == 0, 5).collect() == []


def test_few_vectors_are_searched_whole(spark):
    rows = random_rows(60) + ODD
    found = found_of(learned.nearest_by_learned_partitions(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20))
    expected = brute(rows, 20, 20, whole=False)
    assert found.keys() == expected.keys()
    for query, own in expected.items():
        assert [i for i, _ in found[query]] == [i for i, _ in own]
        assert [s for _, s in found[query]] == pytest.approx([s for _, s in own])


def test_recall_and_a_vector_that_a_third_shares(spark, monkeypatch):
    monkeypatch.setattr(learned, "CELL", 500)
    rows = random_rows(1600) + [(i, [0.25] * 8) for i in range(5000, 5800)]
    found = found_of(
        learned.nearest_by_learned_partitions(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20, sample=800)
    )
    expected = brute(rows, 20, 20, whole=False)
    assert found.keys() == expected.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_parts_are_balanced():
    graph = learned.neighbour_graph(np.array([v for _, v in random_rows(512)]), 8)
    assert np.bincount(learned.balanced_parts(graph, 8)).tolist() == [64] * 8
