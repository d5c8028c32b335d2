"""The registered queries of this folder and the SQL that states them, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortum.llm import byte_gru, fm_index, suffix_dedup, toxicity
from cohortum.llm.byte_pairs import round_trip_digests
from cohortum.llm.common import table
from cohortum.llm.exact_topk import exact_topk
from cohortum.llm.grouped_packing import packed
from cohortum.llm.learned_partitions import nearest_by_learned_partitions
from cohortum.llm.lsh_forest import near_duplicates
from cohortum.llm.phrase_mining import collocations
from cohortum.llm.secret_scan import secret_spans
from cohortum.llm.token_alignment import aligned_tokens
from cohortum.llm.token_files import token_file_digests


def op1_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_by_learned_partitions(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op2_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip_digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.toxicity_scores(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op4_byte_gru(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return byte_gru.language_predictions(docs, byte_gru.fit(docs))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_file_digests(table(spark, folder, "documents"), path, end_id=1)


def op6_grouped_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packed(table(spark, folder, "documents"), path, end_id=0)


def op7_fm_index(spark: SparkSession, folder: str) -> DataFrame:
    return fm_index.without_later_copies(table(spark, folder, "documents"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.without_later_copies(table(spark, folder, "documents"))


def op9_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op10_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return exact_topk(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_spans(table(spark, folder, "documents"))


def op12_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return aligned_tokens(table(spark, folder, "documents"), a, b)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_learned_partitions": op1_learned_partitions,
    "op2_byte_pairs": op2_byte_pairs,
    "op3_toxicity": op3_toxicity,
    "op4_byte_gru": op4_byte_gru,
    "op5_token_files": op5_token_files,
    "op6_grouped_packing": op6_grouped_packing,
    "op7_fm_index": op7_fm_index,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_lsh_forest": op9_lsh_forest,
    "op10_exact_topk": op10_exact_topk,
    "op11_secret_scan": op11_secret_scan,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op10_exact_topk": """
        WITH whole AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
          WHERE q.vec_id % 50 = 0
        )
        SELECT query_id,
          CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
          vec_id, score
        FROM scored
        QUALIFY rank <= 5
    """,
    "op11_secret_scan": """
        WITH rules(kind, place, base, pattern, part, least) AS (VALUES
          ('assign', 0, true, '((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
          ('access', 1, true, 'AKIA[A-Z0-9]+', 0, 20),
          ('hex', 2, true, '[0-9a-f]+', 0, 24),
          ('github', 3, false, 'gh[oprsu]_[A-Za-z0-9]{36,}', 0, 1),
          ('slack', 4, false, 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 1),
          ('private_key', 5, false, '-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----', 0, 1)
        ), docs AS (
          SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
        ), parts AS (
          SELECT row_id, kind, place, base, least,
            unnest(string_split_regex(text, pattern)) AS gap,
            unnest(regexp_extract_all(text, pattern, 0)) AS hit,
            unnest(CASE part WHEN 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern, 0) END) AS judged,
            generate_subscripts(string_split_regex(text, pattern), 1) AS nth
          FROM docs, rules WHERE regexp_matches(text, pattern)
        ), placed AS (
          SELECT *, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY row_id, kind ORDER BY nth) AS finish
          FROM parts
        ), spans AS (
          SELECT row_id, kind, place, base, finish - length(hit) AS start,
            kind || ':' || (finish - length(hit))::BIGINT || ':' || finish::BIGINT AS span
          FROM placed WHERE hit IS NOT NULL AND length(judged) >= least
        )
        SELECT doc_id,
          count(*) FILTER (kind = 'assign') AS n_assign,
          count(*) FILTER (kind = 'access') AS n_access,
          count(*) FILTER (kind = 'hex') AS n_hex,
          sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (base), '')) AS base_sha256,
          coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
        FROM docs LEFT JOIN spans USING (row_id)
        GROUP BY row_id, doc_id
    """,
    "op12_phrase_mining": """
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\\x0A-\\x0D]')) AS piece
          FROM documents
        ), words AS (
          SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
        ), totals AS (
          SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
        ), places AS (
          SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, range(1, 4) AS sizes(size)
        ), counts AS (
          SELECT lang, w[i:i + size - 1] AS p, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 10
        ), candidates AS (
          SELECT lang, p, f AS a FROM counts WHERE len(p) > 1
        ), cuts AS (
          SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r,
            CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
          FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
          JOIN counts l ON l.lang = c.lang AND l.p = c.p[1:k]
          JOIN counts r ON r.lang = c.lang AND r.p = c.p[k + 1:]
        ), weakest AS (
          SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
        ), covers AS (
          SELECT lang, q, max(a) AS longer
          FROM (SELECT lang, a, unnest([p[1:2], p[2:3]]) AS q FROM candidates WHERE len(p) = 3)
          GROUP BY lang, q
        )
        SELECT w.lang, row_number() OVER (
            PARTITION BY w.lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
          array_to_string(p, ' ') AS phrase, a, l, r, n, score
        FROM weakest w JOIN totals USING (lang)
        LEFT JOIN covers ON covers.lang = w.lang AND covers.q = w.p
        WHERE longer IS NULL OR 100 * longer < 50 * a
        QUALIFY rank <= 2000
    """,
}
