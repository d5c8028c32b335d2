"""Small tables and plain definitions to compare the operators with."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names an operator might use itself.
CLASHING = "row bigint, batch string, node string, kind string, ids string, score string"


def documents(spark: SparkSession, texts: list[str | None], ids: list[int | None] | None = None) -> DataFrame:
    rows = [
        (i, text, "en", "s", len(text or ""), 7, "b", "n", "k", "i", "s")
        for i, text in zip(ids or range(1, len(texts) + 1), texts)
    ]
    return spark.createDataFrame(rows, f"{DOCS}, {CLASHING}")


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}é" for _ in range(words))


def odd_texts() -> list[str | None]:
    """Null, empty and blank texts, odd white space, marks, a long word, repeats, equal rows."""
    base = prose(1, 120)
    return [
        None, "", " ", "\n", "a", base, base, base + " end", prose(2, 60) + " " + base[:400],
        "  two  spaces \t tab nbsp em \x1c fs", "don't they'll, it's: <|endoftext|> \x01 1234 ½ 日本語 😀",
        "x" * 3000, "ab " * 900, "\r\n\r\n line\n\n\nbreaks \n", base.upper(), "Ünïcode ÄÖÜ İ ſ ß",
    ]
