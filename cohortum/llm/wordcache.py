"""Texts cut at single spaces into words, and a bounded memory of what was worked out for a word.

Words repeat far more often than texts do, so what depends on a word alone is worked out once per
word and Python worker, for a whole batch of new words together. When the memory would hold more
than ``most`` words, it keeps those that the batch has too; results never depend on it.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import TypeVar
from weakref import WeakSet

import pyarrow as pa

# Between two characters that are no white space a space always starts a new piece of text.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
TOGETHER = 8 << 20
# For steps that keep a model in the worker beside the words: half of what others hold.
FEWER, SMALLER = 300_000, 4 << 20


class Words:
    """Bytes per word, from a function that works them out for a list of words.

    Memories of one ``family`` serve the same step. When another step uses a worker, what earlier
    steps remembered there is dropped.
    """

    alive: WeakSet[Words] = WeakSet()
    in_use: object = None

    def __init__(
        self,
        compute: Callable[[list[str]], list[bytes | None]],
        most: int = 600_000,
        family: object = None,
    ):
        self.compute, self.most, self.family = compute, most, family or self.__class__.__name__ + str(id(self))
        self.known: dict[str, bytes | None] = {}
        Words.alive.add(self)

    def learn(self, rows: list[list[str]]) -> Callable[[str], bytes | None]:
        """Make all words of ``rows`` known and return the lookup."""
        if Words.in_use != self.family:
            Words.in_use = self.family
            for other in Words.alive:
                if other.family != self.family:
                    other.forget()
        new = set().union(*rows)
        if len(self.known) + len(new) > self.most:
            self.known = {word: self.known[word] for word in new & self.known.keys()}
        new = [word for word in new if word not in self.known]
        self.known.update(zip(new, self.compute(new)))
        return self.known.__getitem__

    def forget(self) -> None:
        self.known = {}


# Forget the models that steps keep in a worker.
MODELS: list[Callable[[], None]] = []


def one_model(build: Callable) -> Callable:
    """Keep what ``build`` made last, per worker, until another is asked for or ``release``."""
    kept = lru_cache(maxsize=1)(build)
    MODELS.append(kept.cache_clear)
    return kept


def release() -> None:
    """Drop what earlier steps keep in this worker; for steps that remember no words themselves."""
    Words.in_use = None
    for words in Words.alive:
        words.forget()
    for forget in MODELS:
        forget()
    give_back()


Any = TypeVar("Any")
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library


def give_back(made: Any = None) -> Any:
    """Return to the system what Arrow and the C library hold free. A worker may idle, or serve a
    step of another kind, after what it worked on last; ``made`` is passed on."""
    pa.default_memory_pool().release_unused()
    if TRIM:
        TRIM(0)
    return made


def groups(texts: list[str | None], most: int = TOGETHER) -> Iterator[tuple[int, list[str]]]:
    """Start and texts of runs of rows with about ``most`` characters at most; null is empty."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text or "") + 1
        if size > most and at > start:
            yield start, [t or "" for t in texts[start:at]]
            start, size = at, len(text or "") + 1
    if start < len(texts):
        yield start, [t or "" for t in texts[start:]]
