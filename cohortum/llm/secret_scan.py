"""Secrets in texts, found through an inverted index of trigrams.

Each rule is a regular expression. From it a Boolean query over trigrams is derived: alternatives of
trigrams that every match holds. The index has a posting for each trigram that a rule asks for and
each different text that holds it, in lower case and named by the text's hash. Postings meet at
their text, where the queries are decided; texts that satisfy a rule's query are its candidates,
and the regular expression verifies them. A rule without mandatory trigrams scans every text.

Only DataFrame functions run on the executors. A hash collision adds a candidate, which the
verification refuses, and a repeated text has its postings once. Candidates are joined back as a
stored table of known size: Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles the texts once beyond that, split by adaptive execution at a frequent text.

Matches of a rule are leftmost and do not overlap; one that fails the rule's length is dropped, and
what it covers stays covered. Places are code points, ends exclusive.

Defined cases: a null or empty text has no spans; null and repeated ``doc_id`` are rows like any
other; texts of any length are scanned whole; other columns are left out; an empty table gives no
rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortum.llm.common import texts
from cohortum.llm.trigrams import Clauses, clauses
from cohortum.sources.tables import materialise

MASK_BITS = 62


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long a group of a match must be at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The basic rules, in the order in which spans of equal start are listed.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Shorter runs would be matched and dropped, so the length may stand in the pattern.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Published forms of other keys.
MORE = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)


def grams_of(rules: tuple[Rule, ...]) -> tuple[dict[str, Clauses | None], list[str]]:
    """The query of each rule (none: scan fully), and all trigrams that they ask for."""
    queries = {rule.kind: clauses(rule.pattern) for rule in rules}
    asked = {gram for query in queries.values() if query for clause in query for gram in clause}
    return queries, sorted(asked)


def keyed(docs: DataFrame) -> DataFrame:
    """Identifier, text and the text's name in the index."""
    rows = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("key", F.xxhash64("text"))


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """A row for each of the trigrams and each different text that holds it."""
    lowered = keyed(docs).select("key", F.lower("text").alias("low"))
    held = F.array_compact(
        F.array(*(F.when(F.contains("low", F.lit(gram)), F.lit(n)) for n, gram in enumerate(grams)))
    )
    return lowered.select("key", F.explode(held).alias("gram")).dropDuplicates(["gram", "key"])


def candidates(index: DataFrame, queries: dict[str, Clauses | None], grams: list[str]) -> DataFrame:
    """The texts, by key, that satisfy the query of at least one rule, and of which."""
    number = {gram: n for n, gram in enumerate(grams)}
    words = -(-len(grams) // MASK_BITS)

    def bits(wanted: list[int], word: int) -> int:
        return sum(1 << n % MASK_BITS for n in wanted if n // MASK_BITS == word)

    def satisfied(query: Clauses) -> Column:
        def all_of(clause: frozenset[str]) -> Column:
            needs = [(w, bits([number[gram] for gram in clause], w)) for w in range(words)]
            return reduce(and_, (F.col(f"mask{w}").bitwiseAND(F.lit(x)) == x for w, x in needs if x))

        return reduce(or_, map(all_of, sorted(query, key=sorted)))

    place = F.expr(f"shiftleft(1L, gram % {MASK_BITS})")
    masks = [
        F.bit_or(F.when(F.expr(f"gram div {MASK_BITS}") == w, place).otherwise(F.lit(0).cast("bigint"))).alias(f"mask{w}")
        for w in range(words)
    ]
    flags = {kind: satisfied(query) for kind, query in queries.items() if query}
    return (
        index.groupBy("key").agg(*masks)
        .where(reduce(or_, flags.values()))
        .select("key", *(flag.alias(kind) for kind, flag in flags.items()))
    )


def spans_of(rule: Rule, order: int) -> Column:
    """Start, place of the rule and end of each match of a text, as an array."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    sizes = F.zip_with(
        F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda gap, hit: F.struct(
            F.length(gap).alias("gap"), F.length(hit).alias("hit")
        )),
        judged,
        lambda size, value: F.struct(size["gap"].alias("gap"), size["hit"].alias("hit"), F.length(value).alias("value")),
    )
    start = F.struct(F.lit(0).alias("at"), empty_spans().alias("spans"))

    def step(state: Column, size: Column) -> Column:
        begin = state["at"] + size["gap"]
        span = F.struct(begin.alias("start"), F.lit(order).alias("kind"), (begin + size["hit"]).alias("end"))
        spans = F.when(size["value"] >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((begin + size["hit"]).alias("at"), spans.alias("spans"))

    return F.when(text.rlike(rule.pattern), F.aggregate(sizes, start, step, lambda state: state["spans"])).otherwise(
        empty_spans()
    )


def empty_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def found_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """A row per document with an array of spans for each rule, named by its kind."""
    queries, grams = grams_of(rules)
    rows = keyed(docs)
    if grams:
        index = materialise(postings(docs, grams))
        rows = rows.join(materialise(candidates(index, queries, grams)), "key", "left")
    spans = [
        spans_of(rule, n).alias(rule.kind)
        if queries[rule.kind] is None
        else F.when(F.col(rule.kind), spans_of(rule, n)).otherwise(empty_spans()).alias(rule.kind)
        for n, rule in enumerate(rules)
    ]
    return rows.select("doc_id", *spans)


def written(spans: Column, kinds: list[str]) -> Column:
    """Spans as kind:start:end, by start and then kind, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secret_spans(docs: DataFrame, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """Numbers of the basic rules' spans, a digest of them, and all spans, per document."""
    rules = base + more
    kinds = [rule.kind for rule in rules]
    found = found_secrets(docs, rules)
    together = lambda some: F.concat(*(F.col(rule.kind) for rule in some))
    return found.select(
        "doc_id",
        *(F.size(rule.kind).cast("bigint").alias(f"n_{rule.kind}") for rule in base),
        F.sha2(written(together(base), kinds).cast("binary"), 256).alias("base_sha256"),
        written(together(rules), kinds).alias("spans"),
    )
