"""Statistics per cohort over students with several rows on every side.

The plain definition joins enrolments with scores and engagement on the student and averages the
joined rows. A student with k enrolments and k scores makes k * k of them. All of these rows are
products of one enrolment row and one row of each measured table, so their number and sums follow
from the counts and sums per student. That is how they are computed here: every table is summed up
per student first, a student contributes one row per cohort, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Name of an average, and the table and column it is taken from.
Measures = Mapping[str, tuple[DataFrame, str]]


def cohort_sums(
    info: DataFrame,
    by: Sequence[str],
    measures: Measures,
    student: str = "id_student",
    once_per_student: bool = False,
) -> DataFrame:
    """Row counts and sums per combination of cohort columns, ready for :func:`roll_up`.

    ``once_per_student`` counts a student once per cohort, with the mean of the student's values,
    instead of once per joined row.
    """
    tables = _by_table(measures)
    people = info.groupBy(student, *by).agg(F.count(F.lit(1)).alias("_people"))
    per_student = [
        table.groupBy(student).agg(
            F.count(F.lit(1)).alias(f"_rows_{position}"),
            *(
                summed
                for name, column in columns.items()
                for summed in (
                    F.count(column).alias(f"_filled_{name}"),
                    F.sum(F.col(column).cast("double")).alias(f"_total_{name}"),
                )
            ),
        )
        for position, (table, columns) in enumerate(tables)
    ]
    joined = reduce(lambda left, right: left.join(right, student), per_student, people)
    sizes = ["_people", *(f"_rows_{position}" for position in range(len(tables)))]

    totals = [_count(sizes, once_per_student).alias("rows")]
    for position, (_, columns) in enumerate(tables):
        others = [size for size in sizes if size != f"_rows_{position}"]
        for name in columns:
            filled, total = F.col(f"_filled_{name}"), F.col(f"_total_{name}")
            if once_per_student:
                filled, total = F.least(filled, F.lit(1)), F.try_divide(total, filled)
            else:
                filled, total = (_product(others) * part for part in (filled, total))
            totals += [
                F.sum(filled.cast("double")).alias(f"filled_{name}"),
                F.sum(total).alias(f"total_{name}"),
            ]
    return joined.groupBy(*by).agg(*totals)


def roll_up(
    sums: DataFrame, by: str, averages: Sequence[str], count_as: str | None = None
) -> DataFrame:
    """Averages, and on request the row count, per value of one cohort column.

    Products of large counts are added up as decimals; a row count beyond 64 bits stops the job.
    """
    wanted = [
        F.try_divide(F.sum(f"total_{name}"), F.sum(f"filled_{name}")).alias(name)
        for name in averages
    ]
    if count_as:
        wanted.append(F.sum("rows").cast("bigint").alias(count_as))
    return sums.groupBy(by).agg(*wanted)


def cohort_stats(
    info: DataFrame,
    by: str,
    measures: Measures,
    count_as: str | None = None,
    student: str = "id_student",
    once_per_student: bool = False,
) -> DataFrame:
    """Averages per cohort in one call, for a single cohort column."""
    sums = cohort_sums(info, [by], measures, student, once_per_student)
    return roll_up(sums, by, list(measures), count_as)


def ranked(
    stats: DataFrame, by: str, average: str = "avg_predicted_gpa", place_as: str | None = None
) -> DataFrame:
    """Cohorts from the highest average to the lowest; those without one come last.

    ``place_as`` names a column for a cohort's place in that order, from 1. There is a row per
    cohort by then, so one task numbers them.
    """
    order = [F.desc_nulls_last(average), F.asc(by)]
    placed = stats.withColumn(place_as, F.row_number().over(Window.orderBy(*order))) if place_as else stats
    return placed.orderBy(*order)


def risk_measures(predictions: DataFrame, engagement: DataFrame) -> Measures:
    return {
        "avg_risk": (predictions, "risk_probability"),
        "avg_engagement": (engagement, "engagement_index"),
    }


def grade_measures(grades: DataFrame) -> Measures:
    return {"avg_predicted_gpa": (grades, "predicted_gpa")}


def _by_table(measures: Measures) -> list[tuple[DataFrame, dict[str, str]]]:
    tables: list[tuple[DataFrame, dict[str, str]]] = []
    for name, (table, column) in measures.items():
        known = next((columns for seen, columns in tables if seen is table), None)
        if known is None:
            tables.append((table, {name: column}))
        else:
            known[name] = column
    return tables


def _product(sizes: Sequence[str]) -> Column:
    return reduce(lambda left, right: left * right, (F.col(s).cast("double") for s in sizes))


def _count(sizes: Sequence[str], once_per_student: bool) -> Column:
    if once_per_student:
        return F.count(F.lit(1))
    wide = (F.col(size).cast("decimal(19,0)") for size in sizes)
    return F.sum(reduce(lambda left, right: left * right, wide))
