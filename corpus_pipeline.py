"""A training-data pipeline over ``documents``, one stage per operator of ``cohortum.llm``.

Toxic documents go, then documents in no recognised language; of near-duplicates the first stays;
passages that an earlier document has are cut out; what is left is packed into sequences. Every
stage works on all that its predecessor kept. Null or empty texts are in no language and go there;
rows without ``doc_id`` pass all filters that their text passes and are packed; other columns are
carried along; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortum.llm import byte_gru, lsh_forest, suffix_dedup, toxicity
from cohortum.llm.common import share_code, table
from cohortum.llm.grouped_packing import packed
from cohortum.sources.tables import materialise

# A text stays if its own language has this share of its positions' probability.
LEAST_LANGUAGE_SCORE = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    return byte_gru.with_language(docs, byte_gru.fit(docs), LEAST_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    return lsh_forest.without_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    return suffix_dedup.with_texts_cut(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack),
]

# The stages learn models, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialise(docs)
    return docs
