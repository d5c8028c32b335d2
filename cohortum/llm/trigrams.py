"""Boolean trigram queries from regular expressions.

A query is a set of clauses; a text can match only if it holds all trigrams of at least one clause.
Runs of a pattern's elements that stand for a few literal strings give the clauses; anything else
ends a run and asks for nothing. All is in lower case, since the index is.
"""

from __future__ import annotations

import re._parser as syntax
from itertools import product
from re._constants import BRANCH, IN, LITERAL, MAX_REPEAT, MIN_REPEAT, RANGE, SUBPATTERN

Clauses = frozenset[frozenset[str]]
MOST_STRINGS, MOST_CLAUSES = 8, 64
ANYTHING: Clauses = frozenset([frozenset()])


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def strings_of(element: tuple) -> list[str] | None:
    """All strings that an element of a pattern can match, if they are few."""
    kind, value = element
    if kind is LITERAL:
        return [chr(value).lower()]
    if kind is IN:
        out: set[str] = set()
        for part, what in value:
            if part is LITERAL:
                out.add(chr(what).lower())
            elif part is RANGE and what[1] - what[0] < MOST_STRINGS:
                out.update(chr(c).lower() for c in range(what[0], what[1] + 1))
            else:
                return None
        return sorted(out) if len(out) <= MOST_STRINGS else None
    if kind is SUBPATTERN:
        return joined(list(value[3]))
    if kind is BRANCH:
        options = [joined(list(option)) for option in value[1]]
        return few([x for option in options for x in option]) if None not in options else None
    if kind in (MAX_REPEAT, MIN_REPEAT):
        low, high, inner = value
        once = joined(list(inner))
        if once is None or high > 3:
            return None
        return few(["".join(p) for n in range(low, high + 1) for p in product(once, repeat=n)])
    return None


def few(strings: list[str]) -> list[str] | None:
    distinct = sorted(set(strings))
    return distinct if len(distinct) <= MOST_STRINGS else None


def joined(elements: list[tuple]) -> list[str] | None:
    """All strings of elements in a row, if they are few."""
    out: list[str] | None = [""]
    for element in elements:
        own = strings_of(element)
        out = few([a + b for a in out for b in own]) if own is not None else None
        if out is None:
            return None
    return out


def both(one: Clauses, other: Clauses) -> Clauses:
    """Texts must satisfy both; too many clauses are left at the first."""
    merged = simplified(frozenset(a | b for a in one for b in other))
    return merged if len(merged) <= MOST_CLAUSES else one


def simplified(query: Clauses) -> Clauses:
    """Without clauses that another, weaker one makes needless."""
    return frozenset(c for c in query if not any(other < c for other in query))


def within(element: tuple) -> Clauses:
    """What an element that is no short list of strings asks for."""
    kind, value = element
    if kind is SUBPATTERN:
        return asked(list(value[3]))
    if kind is BRANCH:
        return simplified(frozenset(c for option in value[1] for c in asked(list(option))))
    if kind in (MAX_REPEAT, MIN_REPEAT) and value[0] > 0:
        return asked(list(value[2]))
    return ANYTHING


def asked(elements: list[tuple]) -> Clauses:
    """The query of elements in a row."""
    query, run = ANYTHING, [""]

    def close() -> Clauses:
        return simplified(frozenset(map(trigrams, run)))

    for element in elements:
        own = strings_of(element)
        longer = few([a + b for a in run for b in own]) if own is not None else None
        if longer is not None:
            run = longer
            continue
        query, run = both(query, close()), own or [""]
        if own is None:
            query = both(query, within(element))
    return both(query, close())


def clauses(pattern: str) -> Clauses | None:
    """The query of a pattern; none where a match needs no trigram at all."""
    query = asked(list(syntax.parse(pattern)))
    return None if frozenset() in query else query
