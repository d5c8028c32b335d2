from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortum.operators.engagement import engagement_features, most_engaged
from cohortum.operators.grades import (
    bounded_grades,
    capped_count,
    grade_rows,
    weighted_grades,
)
from cohortum.operators.joins import left_join
from cohortum.operators.outcomes import outcome_rows
from tests import data
from tests.data import as_set, rows

ACTIVITY = "id_student long, id_site long, date int, sum_click long"


def test_engagement_counts_distinct_days_and_filled_items(spark):
    log = spark.createDataFrame(
        [(1, 10, 1, 5), (1, 10, 1, 5), (1, None, 2, 0), (1, 11, None, 3), (2, 10, 9, 1)], ACTIVITY
    )
    assert as_set(engagement_features(log)) == [
        (1, 13, 2, 3, pytest.approx(13 * 0.4 + 2 * 0.6)),
        (2, 1, 1, 1, pytest.approx(1.0)),
    ]


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint", "date", "string", "double"])
def test_days_of_any_type_are_counted_alike(spark, kind):
    number = (F.col("id") * 37 % 251 - 120) % 128
    day = F.date_from_unix_date(number.cast("int")) if kind == "date" else number.cast(kind)
    log = spark.range(3000).select(
        (F.col("id") % 7).alias("id_student"),
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("id_site"),
        F.when((F.col("id") % 11 > 0) & (F.col("id") % 7 > 0), day).alias("date"),
        F.when(F.col("id") % 7 != 1, F.col("id")).alias("sum_click"),
    )
    plain = log.groupBy("id_student").agg(
        F.sum("sum_click"), F.countDistinct("date"), F.count("id_site")
    )
    assert as_set(engagement_features(log).drop("engagement_index")) == as_set(plain)


def test_engagement_takes_calendar_days_and_other_names(spark):
    log = spark.createDataFrame(
        [(1, "a", date(2024, 1, 1), 2), (1, "b", date(2024, 1, 2), 2)],
        "who long, what string, day date, n long",
    )
    result = engagement_features(log, "who", "n", "day", "what", 1.0, 10.0)
    assert rows(result) == [(1, 4, 2, 2, 24.0)]


def test_engagement_of_nothing(spark):
    assert rows(engagement_features(spark.createDataFrame([], ACTIVITY))) == []


def test_most_engaged_breaks_ties_by_key(spark):
    table = data.engagement(spark, (3, 10, 1), (1, 10, 1), (2, 99, 1))
    assert [r["id_student"] for r in most_engaged(table, 2).collect()] == [2, 1]


SUBMISSIONS = "id_student long, id_assessment long, score double"


def grade_tables(spark):
    submissions = spark.createDataFrame(
        [
            (1, 10, 80.0),
            (1, 10, 80.0),
            (1, 11, None),
            (1, 12, 50.0),
            (2, 11, None),
            (3, 10, 100.0),
            (3, 11, 100.0),
            (4, 99, 70.0),
            (5, 13, 60.0),
        ],
        SUBMISSIONS,
    )
    assessments = spark.createDataFrame(
        [(10, 60.0), (10, 10.0), (11, 50.0), (12, 0.0), (13, None)],
        "id_assessment long, weight double",
    )
    return submissions, assessments


@pytest.mark.parametrize("hint", ["broadcast", "merge"])
def test_weighted_grades_either_way(spark, hint):
    submissions, assessments = grade_tables(spark)
    plain = (
        submissions.join(assessments, "id_assessment")
        .groupBy("id_student")
        .agg(F.sum(F.col("score") * F.col("weight") / 100))
    )
    result = weighted_grades(submissions, assessments.hint(hint))
    assert dict(rows(result)) == pytest.approx(dict(rows(plain)))
    assert dict(rows(result)) == pytest.approx({1: 112.0, 2: None, 3: 120.0, 5: None})


def test_grade_rows_drop_missing_grades_and_fill_features(spark):
    grades = spark.createDataFrame(
        [(1, 50.0), (2, None), (3, 70.0)], "id_student long, current_gpa double"
    )
    engagement = data.engagement(spark, (1, 10, 2), (2, 10, 2)).unionByName(
        spark.createDataFrame([(3,)], "id_student long"), allowMissingColumns=True
    )
    result = grade_rows(grades, engagement)
    assert as_set(result) == [
        (1, 50.0, 10.0, 2.0, pytest.approx(5.2)),
        (3, 70.0, 0.0, 0.0, 0.0),
    ]
    assert {kind for _, kind in result.dtypes[1:]} == {"double"}


def test_bounded_grades_and_their_count(spark):
    raw = spark.createDataFrame(
        [(1, -0.1), (2, 55.0), (3, 100.1)], "id_student long, prediction double"
    )
    bounded = bounded_grades(raw)
    assert as_set(bounded) == [
        (1, 0.0, -0.1, "capped_to_0"),
        (2, 55.0, 55.0, "within_range"),
        (3, 100.0, 100.1, "capped_to_100"),
    ]
    assert rows(capped_count(bounded)) == [(2,)]


def test_outcome_rows_repeat_features_per_enrolment(spark):
    engagement = data.engagement(spark, (1, 10, 2), (2, 0, 1), (9, 1, 1))
    info = data.info(
        spark, (1, "N", "A", "Pass"), (1, "N", "A", "Fail"), (2, "S", "A", None), (3, "S", "A", "x")
    )
    result = outcome_rows(engagement, info).select("id_student", "total_clicks", "label")
    assert as_set(result) == [(1, 10, 0), (1, 10, 1), (2, 0, 0)]


def test_left_join_is_the_plain_left_join(spark):
    one = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40), (None, 50)], "k int, a int")
    many = spark.createDataFrame(
        [(1, i) for i in range(20)] + [(2, 1), (2, 1), (3, 0), (7, 0), (None, 5)], "k int, b int"
    )
    assert as_set(left_join(one, many, "k")) == as_set(one.join(many, "k", "left"))
