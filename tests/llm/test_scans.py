"""Secret scans, phrase mining and token alignment against plain definitions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortum.llm import phrase_mining, token_alignment
from cohortum.llm.phrase_mining import collocations, frequent_phrases
from cohortum.llm.secret_scan import BASE, MORE, Rule, found_secrets, grams_of, secret_spans
from cohortum.llm.token_alignment import aligned_tokens, gallop, overlaps, tokenizer_pair, units_of
from cohortum.llm.trigrams import clauses
from tests.llm.helpers import documents, odd_texts, prose

PLAIN = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "github": (r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 1),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    "private_key": (r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
}
SECRETS = [
    "password=abcdef", "PassWord : 'abc'", "secret=token: abcdefgh", "token=token=abcdef", 'API_KEY" = "x.y/z+==',
    "apikey:12345 apikey:123456", "pass word=abcdef", "AKIA" + "A1" * 8, "AKIA" + "A1" * 7, "xAKIAKIA" + "Z" * 20,
    "0123456789abcdef01234567", "0123456789abcdef0123456", "日本 😀 passwd= " + "ab" * 20 + " ende", "ghp_" + "a" * 36,
    "xoxb-1234567890", "-----BEGIN RSA PRIVATE KEY-----", "pas ass ssw swo wor ord", "\x00token=\x00abcdef", "ſecret=abcdef",
    "token=" + "q" * 50_000, "A" * 30_000 + " 😀 secret:zzzzzz",
]


def spans_of(text: str | None) -> list[tuple[int, int, int]]:
    found = []
    for place, (pattern, group, least) in enumerate(PLAIN.values()):
        for match in re.compile(pattern, re.ASCII).finditer(text or ""):
            if len(match.group(group)) >= least:
                found.append((match.start(), place, match.end()))
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{list(PLAIN)[place]}:{start}:{end}" for start, place, end in spans)


def test_secrets(spark):
    texts = [*SECRETS, " . ".join(SECRETS), *odd_texts(), SECRETS[0]]
    ids = [None, 5, 5, *range(3, len(texts))]
    for docs in (documents(spark, texts, ids), documents(spark, texts, ids).repartition(5)):
        found = sorted((tuple(r) for r in secret_spans(docs).collect()), key=repr)
        expected = []
        for doc_id, text in zip(ids, texts):
            spans = spans_of(text)
            counts = [sum(place == n for _, place, _ in spans) for n in range(3)]
            base = hashlib.sha256(written([s for s in spans if s[1] < 3]).encode()).hexdigest()
            expected.append((doc_id, *counts, base, written(spans)))
        assert found == sorted(expected, key=repr)
    assert secret_spans(documents(spark, [])).collect() == []


def test_queries_of_trigrams():
    queries, grams = grams_of(BASE + MORE)
    assert queries["hex"] is None and frozenset(["aki", "kia"]) in queries["access"]
    assert frozenset(["tok", "oke", "ken"]) in queries["assign"] and len(queries["assign"]) == 6
    assert all(len(gram) == 3 for gram in grams)
    assert clauses("a*") is None and clauses("abc|x") is None
    assert clauses("(?:abc|abd)e[0-9]+fgh") == {
        frozenset(["abc", "bce", "fgh"]), frozenset(["abd", "bde", "fgh"])
    }
    assert clauses("[^a]bcd{2}") == {frozenset(["bcd", "cdd"])}


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([p for p, _, _ in PLAIN.values()] + ["ab?c?defg|x[yz]w{1,2}abc", "(foo|ba+r)(baz)+q"]), st.data())
def test_every_match_satisfies_its_query(pattern, data):
    text = data.draw(st.from_regex(re.compile(pattern, re.ASCII)))
    query = clauses(pattern)
    assert query is None or any(all(gram in text.lower() for gram in clause) for clause in query)


def test_a_rule_of_ones_own_and_none_indexed(spark):
    docs = documents(spark, ["id:42 id:4711", "id:12345"])
    mine = (Rule("ident", r"id:([0-9]+)", 1, 4),)
    assert [[tuple(s) for s in r["ident"]] for r in found_secrets(docs, mine).orderBy("doc_id").collect()] == [[(6, 0, 13)], [(0, 0, 8)]]
    assert [len(r["digits"]) for r in found_secrets(docs, (Rule("digits", "[0-9]+"),)).orderBy("doc_id").collect()] == [2, 1]


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows: list[tuple[str | None, str | None]], longest: int) -> dict[str, Counter]:
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            own[()] += len(words)
            for n in range(1, longest + 1):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return counts


def plain_collocations(rows, longest: int, least: int, most: int) -> list[tuple]:
    out = []
    for lang, counts in plain_counts(rows, longest).items():
        chosen = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in chosen.items():
            inside = [b for q, b in chosen.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= 50 * a for b in inside):
                score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        ranked.sort()
        out += [(lang, n, p.decode(), -a, l, r, counts[()], -s) for n, (s, a, p, l, r) in enumerate(ranked[:most], 1)]
    return sorted(out)


def mixed_documents(spark):
    texts = [*odd_texts(), *[prose(i, 90, 12) for i in range(30)], "A b, a B. A\tb  a b! \x1c x a\x0bb", "\x00 the end" * 40]
    docs = documents(spark, texts, [None, 7, 7, *range(4, len(texts) + 1)])
    return docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.element_at(F.array(F.lit("en"), F.lit("de")), (F.coalesce("doc_id", F.lit(0)) % 2 + 1).cast("int"))))


@pytest.mark.parametrize("shards, longest", [(1, 3), (3, 3), (4, 4)])
def test_collocations(spark, monkeypatch, shards, longest):
    monkeypatch.setattr(phrase_mining, "HELD", 50)
    docs = mixed_documents(spark)
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    found = collocations(docs, longest=longest, most=60, shards=shards)
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, longest, 10, 60)


def test_counts_are_exact_whatever_shares_a_slot(spark, monkeypatch):
    docs = mixed_documents(spark)
    expected = {
        (lang, " ".join(p)): f
        for lang, own in plain_counts([tuple(r) for r in docs.select("lang", "text").collect()], 3).items()
        for p, f in own.items() if p and f >= 10
    }
    found = frequent_phrases(docs).where("n > 0").collect()
    assert {(r["lang"], r["phrase"]): r["f"] for r in found} == expected and len(found) == len(expected)


def test_phrases_of_nothing(spark):
    assert collocations(documents(spark, [])).collect() == []
    assert collocations(documents(spark, [None, "", " . "])).collect() == []


A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_alignment(text: str | None) -> tuple[list[int], list[int], list[str], list[tuple[int, int]]]:
    both = tokenizer_pair(A, B)
    a, b = both.a.tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids, both.b.encode(text or "")
    sizes = [[len(side.join(np.array([i]))) for i in ids] for side, ids in ((both.a_pieces, a), (both.b_pieces, b))]
    whole = (" " + (text or "")).encode()
    if not text or both.a_pieces.join(np.array(a)) != whole or both.b_pieces.join(np.array(b)) != whole:
        return [], [], [], []
    ends = [np.cumsum(x).tolist() for x in sizes]
    cuts, groups, last = sorted(set(ends[0]) & set(ends[1])), [], 0
    for cut in cuts:
        own = [",".join(str(i) for i, e in zip(ids, at) if last < e <= cut) for ids, at in zip((a, b), ends)]
        groups.append("|".join(own))
        last = cut
    starts = [[0, *at[:-1]] for at in ends]
    links = [
        (a[i], b[j]) for i in range(len(a)) for j in range(len(b))
        if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]
    ]
    return a, b, groups, links


def test_token_alignment(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_CHARACTERS", 900)
    texts = [*odd_texts(), "a▁b is lost", " lead", "trail ", "x y\x00z <s> </s> <0x41>", "naïve façade " * 9, "ﬁ " * 40]
    ids = [None, 9, 9, *range(10, len(texts) + 7)]
    plain = list(map(plain_alignment, texts))
    count = Counter(link for _, _, _, links in plain for link in links)
    highest: dict[int, int] = {}
    for (_, b), n in count.items():
        highest[b] = max(highest.get(b, 0), n)
    expected = [
        (
            i, len(a), len(b), len(groups), len(links), sum(count[x] == highest[x[1]] for x in links),
            sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for i, (a, b, groups, links) in zip(ids, plain)
    ]
    found = aligned_tokens(documents(spark, texts, ids).repartition(3), A, B)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert aligned_tokens(documents(spark, []), A, B).collect() == []


def test_alignment_puts_one_block_together_at_a_time(spark):
    found = aligned_tokens(documents(spark, ["a b", "b c"]), A, B)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" in plan and "collect_list" not in plan


def test_tokenizers_go_before_blocks_are_put_together():
    tokenizer_pair(A, B)
    token_alignment.forget()
    assert tokenizer_pair.cache_info().currsize == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400))), max_size=6))
def test_galloping_finds_all_places(lists):
    short, long, short_ends, long_ends, base = [], [], [], [], 0
    for one, other in lists:
        total = max([*one, *other, 1])
        few, many = sorted((sorted(one | {total}), sorted(other | {total})), key=len)
        short += [x + base for x in few]
        long += [x + base for x in many]
        short_ends.append(len(short))
        long_ends.append(len(long))
        base += total
    arrays = [np.array(x, dtype=np.int64) for x in (short, long, short_ends, long_ends)]
    first, last, common = overlaps(*arrays)
    assert last.tolist() == np.searchsorted(arrays[1], arrays[0]).tolist()
    assert common.tolist() == [x in set(long) for x in short]
    starts = np.append(0, arrays[0])[: len(short)]
    assert first.tolist() == np.searchsorted(arrays[1], starts, side="right").tolist()


def test_units_are_cut_where_no_token_crosses():
    assert units_of("a b  c") == ["a", "b  c"] and units_of("a b c") == ["a", "b", "c"] and units_of(" a ") == [" a "]
    assert units_of("a\n b c") == ["a\n b", "c"]
    assert gallop(*(np.zeros(0, dtype=np.int64) for _ in range(6))).tolist() == []
