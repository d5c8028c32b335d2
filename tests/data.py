"""Hand-made learner tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortum.sources import schemas


def engagement(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows of (student, clicks, days); the index follows from the defaults."""
    full = [(key, clicks, days, clicks, clicks * 0.4 + days * 0.6) for key, clicks, days in rows]
    return spark.createDataFrame(full, schemas.ENGAGEMENT)


def risk(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows of (student, probability)."""
    full = [(key, None if p is None else float(p > 0.5), p) for key, p in rows]
    return spark.createDataFrame(full, schemas.RISK)


def grades(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows of (student, raw grade)."""
    full = []
    for key, raw in rows:
        note = "capped_to_0" if raw < 0 else "capped_to_100" if raw > 100 else "within_range"
        full.append((key, min(max(raw, 0.0), 100.0), raw, note))
    return spark.createDataFrame(full, schemas.GRADES)


def info(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows of (student, region, education, outcome)."""
    return spark.createDataFrame(
        rows, "id_student long, region string, highest_education string, final_result string"
    )


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def as_set(df: DataFrame) -> list[tuple]:
    return sorted(rows(df), key=repr)
