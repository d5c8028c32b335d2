from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortum.operators import cohorts
from tests import data
from tests.data import as_set, rows


@pytest.fixture(scope="module")
def tables(spark):
    info = data.info(
        spark,
        (1, "N", "A", "Pass"),
        (1, "N", "B", "Fail"),
        (2, "N", "A", "Pass"),
        (3, None, "A", "Pass"),
        (4, "S", "B", "Pass"),
        (5, "W", "B", "Pass"),
    )
    risk = data.risk(spark, (1, 0.25), (1, 0.75), (2, 0.5), (3, 0.125), (4, 1.0), (5, None))
    engagement = data.engagement(spark, (1, 10, 1), (2, 20, 2), (3, 0, 0), (5, 7, 7), (6, 9, 9))
    grades = data.grades(spark, (1, 120.0), (2, 40.0), (4, 55.0))
    return info, risk, engagement, grades


def plain(info, risk, engagement, by):
    joined = info.join(risk, "id_student").join(engagement, "id_student")
    return joined.groupBy(by).agg(
        F.avg("risk_probability"), F.avg("engagement_index"), F.count("id_student")
    )


@pytest.mark.parametrize("by", ["region", "highest_education"])
def test_risk_statistics_are_those_of_the_joined_rows(tables, by):
    info, risk, engagement, _ = tables
    result = cohorts.cohort_stats(info, by, cohorts.risk_measures(risk, engagement), "n")
    found = {r[0]: tuple(r)[1:] for r in result.collect()}
    expected = {r[0]: tuple(r)[1:] for r in plain(info, risk, engagement, by).collect()}
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values)


def test_two_enrolments_and_scores_make_four_rows(tables):
    info, risk, engagement, _ = tables
    result = cohorts.cohort_stats(info, "region", cohorts.risk_measures(risk, engagement), "n")
    assert {r["region"]: r["n"] for r in result.collect()} == {"N": 5, None: 1, "W": 1}


def test_cells_roll_up_to_either_cohort(tables):
    info, risk, engagement, _ = tables
    measures = cohorts.risk_measures(risk, engagement)
    cells = cohorts.cohort_sums(info, ["region", "highest_education"], measures)
    for by in ("region", "highest_education"):
        rolled = cohorts.roll_up(cells, by, list(measures), "n")
        direct = cohorts.cohort_stats(info, by, measures, "n")
        assert as_set(rolled) == as_set(direct)


def test_once_per_student(tables):
    info, risk, engagement, _ = tables
    result = cohorts.cohort_stats(
        info, "region", cohorts.risk_measures(risk, engagement), "n", once_per_student=True
    )
    north = result.where("region = 'N'").first()
    assert (north["n"], north["avg_risk"]) == (2, 0.5)
    assert north["avg_engagement"] == pytest.approx((4.6 + 9.2) / 2)
    assert result.where("region = 'W'").first()["avg_risk"] is None


def test_education_statistics_carry_no_count(tables):
    info, risk, engagement, _ = tables
    result = cohorts.cohort_stats(
        info, "highest_education", cohorts.risk_measures(risk, engagement)
    )
    assert result.columns == ["highest_education", "avg_risk", "avg_engagement"]


def test_grade_statistics_ranked_with_missing_last(spark, tables):
    info, _, _, grades = tables
    stats = cohorts.cohort_stats(info, "region", cohorts.grade_measures(grades), "student_count")
    with_gap = stats.unionByName(
        spark.createDataFrame([("X", None, 0)], stats.schema)
    )
    assert rows(cohorts.ranked(with_gap, "region")) == [
        ("N", 80.0, 3),
        ("S", 55.0, 1),
        ("X", None, 0),
    ]


def test_large_counts_do_not_build_rows(spark):
    """A million enrolments times a million scores of one student: 10**12 joined rows."""
    million = spark.range(1_000_000).select(F.lit(1).cast("long").alias("id_student"))
    info = million.withColumn("region", F.lit("N"))
    risk = million.withColumn("risk_probability", F.lit(0.5).cast("float"))
    engagement = data.engagement(spark, (1, 10, 1))
    result = cohorts.cohort_stats(info, "region", cohorts.risk_measures(risk, engagement), "n")
    assert rows(result) == [("N", 0.5, pytest.approx(4.6), 10**12)]


def test_counts_beyond_64_bits_stop_the_job(spark):
    """Four tables with 10**5 rows of a student each make 10**20 joined rows, which have averages."""
    rows_of_one = spark.range(100_000).select(F.lit(1).cast("long").alias("id_student"))
    info = rows_of_one.withColumn("region", F.lit("N"))
    measures = {
        f"m{i}": (rows_of_one.withColumn("v", F.lit(float(i))), "v") for i in range(3)
    }
    assert rows(cohorts.cohort_stats(info, "region", measures)) == [("N", 0.0, 1.0, 2.0)]
    with pytest.raises(PySparkException):
        cohorts.cohort_stats(info, "region", measures, "n").collect()
