from __future__ import annotations

import corpus_pipeline
from cohortum.llm.common import table
from cohortum.llm.queries import ORACLES, QUERIES
from cohortum.sources.tables import materialise
from tests.llm.helpers import documents, odd_texts

FOLDER = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_keep_columns_and_pack_what_is_left(spark):
    docs = table(spark, FOLDER, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialise(stage(spark, docs, FOLDER))
        assert after.columns == docs.columns, name
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        docs = after
    assert 0.5 * before < docs.count() < before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_odd_rows_pass_through_all_stages(spark):
    docs = documents(spark, odd_texts(), [None, *range(2, len(odd_texts()) + 1)])
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, FOLDER))
    assert docs.count() > 0


def test_an_empty_table_passes_through_all_stages(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, FOLDER))
    assert docs.count() == 0
