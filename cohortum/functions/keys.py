"""One spelling for identifiers that arrive as numbers or as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What surrounds an identifier without being part of it, and what a number looks like.
BLANKS = " \t\n\r\x0b\x0c"
DIGITS = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Marks a column of which every value has been spelled by :func:`harmonise_key`.
MARK = "harmonised"


def harmonise_key(key: Column) -> Column:
    """Spell a whole number as a plain integer and leave other identifiers as stripped text.

    ``"12.0"``, ``" 12 "`` and ``"0012"`` become ``"12"``, ``"1e3"`` becomes ``"1000"``; ``"abc"``,
    ``"12d"`` and ``"inf"`` stay. Missing stays missing, and integers of up to 64 bits keep every
    digit. Applying it twice changes nothing.
    """
    text = F.btrim(key.cast("string"), F.lit(BLANKS))
    number = text.try_cast("double")
    whole = F.when(text.rlike(DIGITS), text.try_cast("bigint")).when(
        text.rlike(DECIMAL) & (number == F.rint(number)), number.try_cast("bigint")
    )
    return F.coalesce(whole.cast("string"), text)


def coerced_number(value: Column) -> Column:
    """Read a number, or missing where there is none."""
    return value.try_cast("double")


def is_whole_number(df: DataFrame, column: str) -> bool:
    """True if the column's type already has only one spelling per identifier."""
    return isinstance(df.schema[column].dataType, T.IntegralType)


def is_harmonised(df: DataFrame, column: str) -> bool:
    """True if the column is known to have one spelling per identifier.

    That is a whole-number column, or text that :func:`with_harmonised_key` has rewritten: the
    mark goes with the column, also into Parquet files and out of them.
    """
    return is_whole_number(df, column) or bool(df.schema[column].metadata.get(MARK))


def with_harmonised_key(df: DataFrame, column: str) -> DataFrame:
    """Rewrite text identifiers to one spelling, once; tables keep that spelling and the mark."""
    if is_harmonised(df, column):
        return df
    return df.withColumn(column, harmonise_key(F.col(column)).alias(column, metadata={MARK: True}))


def same_key(df: DataFrame, column: str, text: Column) -> Column:
    """Match the stored column against a searched identifier.

    The stored side stays bare if its spelling is known, so that the match is pushed into the
    Parquet scan; only text that was never harmonised is rewritten row by row.
    """
    wanted = harmonise_key(text)
    if is_whole_number(df, column):
        return F.col(column) == wanted.try_cast(df.schema[column].dataType)
    return (F.col(column) if is_harmonised(df, column) else harmonise_key(F.col(column))) == wanted


def with_joinable_keys(column: str, *frames: DataFrame) -> tuple[DataFrame, ...]:
    """Give all frames one spelling of ``column``; whole-number columns need no change."""
    if all(is_whole_number(df, column) for df in frames):
        return frames
    return tuple(
        df.withColumn(column, F.col(column).cast("string")) if is_whole_number(df, column)
        else with_harmonised_key(df, column)
        for df in frames
    )
