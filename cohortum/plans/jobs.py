"""The jobs: each reads tables by name, runs the operators and writes tables by name.

Parquet tables are the contract between jobs, so each can be run again on its own. Jobs take the
caller's session and change none of its settings.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum import fixed_values as fixed
from cohortum.fixed_values import GoodHistory
from cohortum.functions.keys import is_whole_number, with_harmonised_key, with_joinable_keys
from cohortum.operators import cohorts, models, overview, profile
from cohortum.operators.cleaning import clean
from cohortum.operators.engagement import engagement_features
from cohortum.operators.grades import capped_count, grade_rows, weighted_grades
from cohortum.operators.outcomes import outcome_rows
from cohortum.operators.students import student_rows, with_copies
from cohortum.sources.schemas import INGEST_REPORT, REJECTED_LINES
from cohortum.sources.tables import (
    LINE,
    REJECTED,
    Layout,
    intermediate_folder,
    materialise,
    raw_types,
    read_grades,
    read_optional,
    read_raw_table,
    read_raw_with_rejects,
    read_risk,
    read_table,
    write_table,
)
from cohortum.sources.versions import Rewrite, rewriting

KEY_ORDER = ("id_student",)


def students_of(
    spark: SparkSession, layout: Layout, *names: str, rewrite: Rewrite | None = None
) -> list[DataFrame]:
    """Tables by name, with one spelling of the student's key across them."""
    frames = [read_table(spark, layout, name, rewrite) for name in names]
    return list(with_joinable_keys("id_student", *frames))


def store_by_student(
    df: DataFrame, layout: Layout, name: str, order: Iterable[str] = KEY_ORDER, **options
) -> str:
    """Write a table that lookups by student read.

    Rows are dealt into files by ranges of the key. A text key is stored in its one spelling, with
    a Bloom filter, so that a lookup of any spelling is an equality that the scan can use.
    """
    rows = with_harmonised_key(df, "id_student")
    bloom = () if is_whole_number(rows, "id_student") else KEY_ORDER
    return write_table(rows, layout, name, ranged_by=order, bloom=bloom, **options)


class GradeReport(NamedTuple):
    """Quality on the held-out rows, and how many predictions were capped."""

    rmse: float
    n_capped: int


class Overview(NamedTuple):
    """The frames behind the overview."""

    figures: DataFrame
    distribution: DataFrame
    high_risk: DataFrame
    low_risk: DataFrame
    good_history: DataFrame
    good_history_count: DataFrame


class Profile(NamedTuple):
    """The frames behind the page of one student."""

    profile: DataFrame
    comparison: DataFrame
    inputs: DataFrame


class Institution(NamedTuple):
    """The cohort tables; ``None`` where one has not been written."""

    region: DataFrame | None
    education: DataFrame | None
    region_grades: DataFrame | None
    education_grades: DataFrame | None


class TooManyRejects(ValueError):
    """A raw table has more bad lines than allowed."""


def ingest(
    spark: SparkSession,
    layout: Layout,
    tables: Iterable[str] = fixed.RAW_TABLES,
    types: Mapping[str, Mapping[str, T.DataType | str]] | None = None,
    infer: bool = False,
    most_rejected: int | None = None,
) -> dict[str, str]:
    """Read, clean and write the raw tables; returns the path of each.

    ``types`` overrides column types per table, for example a calendar date for the activity day.
    Text keys of students are stored in one spelling.

    The first bad line stops the job, unless ``most_rejected`` says how many lines of a table may
    be bad. Those are then left out of it and listed, with their reasons, in ``rejected_lines``;
    ``ingest_report`` has the number of bad texts per column. The lists are of the tables of the
    last such run. Whether it fails or not, the tables are published together.
    """
    if infer and most_rejected is not None:
        raise ValueError("a type that Spark finds fits every line, so there is nothing to reject")
    stated = types or {}
    with rewriting(spark) as rewrite:
        if most_rejected is not None:
            return _ingest_tolerant(spark, layout, list(tables), stated, most_rejected, rewrite)
        return {
            name: _write_clean(
                name, read_raw_table(spark, layout, name, stated.get(name), infer), layout, rewrite
            )
            for name in tables
        }


def _write_clean(name: str, raw: DataFrame, layout: Layout, rewrite: Rewrite) -> str:
    cleaned = clean(name, raw)
    if "id_student" in cleaned.columns:
        cleaned = with_harmonised_key(cleaned, "id_student")
    return write_table(cleaned, layout, name, rewrite=rewrite)


def _ingest_tolerant(
    spark: SparkSession,
    layout: Layout,
    names: list[str],
    types: Mapping[str, Mapping[str, T.DataType | str]],
    most: int,
    rewrite: Rewrite,
) -> dict[str, str]:
    paths, report, bad = {}, [], []
    with intermediate_folder(spark) as folder:
        for name in names:
            # Parsed once; the rows, the counts and the list are taken from the stored form.
            raw = materialise(
                read_raw_with_rejects(spark, layout.raw(name), raw_types(name, types.get(name))), f"{folder}/{name}"
            )
            columns = [*(c for c in raw.columns if c != REJECTED), LINE]
            reasons = F.col(REJECTED)["column"]
            counts = [F.count_if(F.array_contains(reasons, c)).alias(f"c{n}") for n, c in enumerate(columns)]
            found = raw.agg(
                F.count(F.lit(1)).alias("lines"), F.count_if(F.size(REJECTED) > 0).alias("bad"), *counts
            ).first()
            if found["bad"] > most:
                raise TooManyRejects(f"{name}: {found['bad']} of {found['lines']} lines are bad, {most} may be")
            paths[name] = _write_clean(name, raw.where(F.size(REJECTED) == 0).drop(REJECTED), layout, rewrite)
            report += [(name, c, found[f"c{n}"], found["lines"]) for n, c in enumerate(columns)]
            bad.append(raw.select(F.lit(name).alias("raw_table"), F.inline(REJECTED)))
        lines = reduce(DataFrame.unionByName, bad, spark.createDataFrame([], REJECTED_LINES))
        write_table(lines, layout, fixed.REJECTED_TABLE, rewrite=rewrite)
    write_table(spark.createDataFrame(report, INGEST_REPORT).coalesce(1), layout, fixed.REPORT_TABLE, rewrite=rewrite)
    return paths


def build_engagement(spark: SparkSession, layout: Layout) -> str:
    """Features per student; spellings of one key are one student."""
    (activity,) = students_of(spark, layout, "studentVle")
    return store_by_student(engagement_features(activity), layout, fixed.ENGAGEMENT_TABLE)


def build_risk(spark: SparkSession, layout: Layout, how: str = "key", **options) -> float:
    """Fit the risk model, score every enrolment, and return the exact area under ROC.

    The scores and the averages that lookups compare with are published together.
    """
    engagement, info = students_of(spark, layout, fixed.ENGAGEMENT_TABLE, "studentInfo")
    fitted = models.fit_risk(outcome_rows(engagement, info), how, **options)
    scores = models.risk_scores(fitted.model, engagement, info)
    with rewriting(spark) as rewrite:
        order = (*KEY_ORDER, "risk_probability")
        store_by_student(scores, layout, fixed.RISK_TABLE, order, rewrite=rewrite)
        build_averages(spark, layout, rewrite)
    return fitted.quality


def build_averages(spark: SparkSession, layout: Layout, rewrite: Rewrite | None = None) -> str:
    """Write the means that lookups compare with, so that no lookup reads whole tables."""
    engagement = read_table(spark, layout, fixed.ENGAGEMENT_TABLE, rewrite)
    risk = read_risk(spark, layout, fixed.RISK_TABLE, rewrite)
    means = profile.averages(with_copies(engagement, risk), "copies")
    return write_table(means.coalesce(1), layout, fixed.AVERAGES_TABLE, rewrite=rewrite)


def build_grades(spark: SparkSession, layout: Layout, how: str = "key", **options) -> GradeReport:
    """Fit the grade model, predict for every student with a grade, and report its quality.

    Only active students have grade rows, so submissions of others are left out before they are
    dealt and sorted by assessment.

    Capped predictions are counted in the written table, of which that reads one short column. An
    observation of the write would save that, but a session that has used one can no longer ship
    forest models to its tasks (Spark 4.1).
    """
    submissions, engagement = students_of(spark, layout, "studentAssessment", fixed.ENGAGEMENT_TABLE)
    submissions = submissions.join(engagement.select("id_student"), "id_student", "left_semi")
    assessments = read_table(spark, layout, "assessments")
    with intermediate_folder(spark) as folder:
        rows = materialise(
            grade_rows(weighted_grades(submissions, assessments), engagement), f"{folder}/rows"
        )
        fitted = models.fit_grades(rows, how, **options)
        predictions = models.grade_predictions(fitted.model, rows)
        store_by_student(predictions, layout, fixed.GRADE_TABLE)
    capped = capped_count(read_table(spark, layout, fixed.GRADE_TABLE)).first()["n_capped"]
    return GradeReport(fitted.quality, capped)


def build_cohorts(
    spark: SparkSession, layout: Layout, once_per_student: bool = False
) -> dict[str, str]:
    """Write the four cohort tables and publish them together.

    The joins are done once per pair of measures, down to a table with a row per region and
    education level, from which the statistics of either are added up. Counting a student once
    per cohort is not additive in that way and runs per cohort column.
    """
    info, scores, engagement, predicted = students_of(
        spark, layout, "studentInfo", fixed.RISK_TABLE, fixed.ENGAGEMENT_TABLE, fixed.GRADE_TABLE
    )
    risk = cohorts.risk_measures(scores, engagement)
    grades = cohorts.grade_measures(predicted)
    both = ["region", "highest_education"]

    def statistics(measures: cohorts.Measures, counts: tuple[str | None, str | None], path: str):
        if once_per_student:
            return [
                cohorts.cohort_stats(info, by, measures, count_as, once_per_student=True)
                for by, count_as in zip(both, counts)
            ]
        sums = materialise(cohorts.cohort_sums(info, both, measures), path)
        return [
            cohorts.roll_up(sums, by, list(measures), count_as)
            for by, count_as in zip(both, counts)
        ]

    with intermediate_folder(spark) as folder:
        frames = [
            *statistics(risk, ("student_count", None), f"{folder}/risk"),
            *statistics(grades, ("student_count", "student_count"), f"{folder}/grades"),
        ]
        with rewriting(spark) as rewrite:
            return {
                name: write_table(frame, layout, name, rewrite=rewrite)
                for name, frame in zip(fixed.COHORT_TABLES, frames)
            }


def overview_view(
    spark: SparkSession,
    layout: Layout,
    high_risk_from: float = fixed.HIGH_RISK_FROM,
    low_risk_upto: float = fixed.LOW_RISK_UPTO,
    list_length: int = fixed.LIST_LENGTH,
    limits: GoodHistory = fixed.GOOD_HISTORY,
) -> Overview:
    engagement = read_table(spark, layout, fixed.ENGAGEMENT_TABLE)
    risk = read_risk(spark, layout, fixed.RISK_TABLE)
    grades = read_grades(spark, layout, fixed.GRADE_TABLE)
    return Overview(
        overview.key_figures(engagement, risk),
        overview.histogram(with_copies(engagement, risk), "engagement_index", copies="copies"),
        overview.high_risk_list(engagement, risk, high_risk_from, list_length),
        overview.low_risk_list(engagement, risk, low_risk_upto, list_length),
        overview.good_history_list(engagement, risk, grades, limits),
        overview.good_history_count(engagement, risk, grades, limits),
    )


def student_view(spark: SparkSession, layout: Layout) -> DataFrame:
    """Engagement with risk, a row per score."""
    return student_rows(
        read_table(spark, layout, fixed.ENGAGEMENT_TABLE),
        read_risk(spark, layout, fixed.RISK_TABLE),
    )


def profile_view(spark: SparkSession, layout: Layout, search: str) -> Profile:
    engagement = read_table(spark, layout, fixed.ENGAGEMENT_TABLE)
    risk = read_risk(spark, layout, fixed.RISK_TABLE)
    grades = read_grades(spark, layout, fixed.GRADE_TABLE)
    found = profile.student_lookup(search, engagement, risk, grades)
    known = found.where("lookup_status = 'found'")
    means = read_optional(spark, layout, fixed.AVERAGES_TABLE)
    if means is None:
        means = profile.averages(with_copies(engagement, risk), "copies")
    return Profile(
        found,
        profile.compared_with_average(known, means),
        profile.model_inputs(found),
    )


def institution_view(spark: SparkSession, layout: Layout) -> Institution:
    """The cohort tables, those with grades from the best average down."""
    region, education, region_grades, education_grades = (
        read_optional(spark, layout, name) for name in fixed.COHORT_TABLES
    )
    return Institution(
        region,
        education,
        None if region_grades is None else cohorts.ranked(region_grades, "region"),
        None
        if education_grades is None
        else cohorts.ranked(education_grades, "highest_education"),
    )
