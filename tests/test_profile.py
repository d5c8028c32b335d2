from __future__ import annotations

import pytest

from cohortum.operators import profile, students
from tests import data
from tests.data import rows


@pytest.fixture(scope="module")
def tables(spark):
    engagement = data.engagement(spark, (1, 10, 6), (2, 20, 7), (3, 30, 8))
    risk = data.risk(spark, (1, 0.2), (1, 0.9), (1, 0.5), (2, 0.3))
    grades = data.grades(spark, (1, 120.0), (3, 49.0))
    return engagement, risk, grades


def test_lookup_takes_the_highest_risk_and_any_spelling(tables):
    for search in ("1", " 1.0 ", "001", "1e0"):
        found = profile.student_lookup(search, *tables).first()
        assert (found["searched"], found["lookup_status"]) == ("1", "found")
        assert found["risk_probability"] == pytest.approx(0.9)
        assert (found["prediction"], found["grade_band"]) == (1.0, "excellent")
        assert (found["predicted_gpa"], found["predicted_gpa_raw"]) == (100.0, 120.0)
        assert found["gpa_bounds_note"] == "capped_to_100"
        assert (found["engagement_shown"], found["clicks_shown"]) == (7.6, 10)


def test_lookup_statuses(tables):
    engagement, risk, grades = tables
    status = ("lookup_status", "grade_status", "grade_band")
    found = {
        search: tuple(profile.student_lookup(search, *tables).select(*status).first())
        for search in ("1", "2", "8", "x")
    }
    assert found == {
        "1": ("found", "graded", "excellent"),
        "2": ("found", "no_grade_for_student", "no_prediction"),
        "8": ("no_such_student", None, None),
        "x": ("no_such_student", None, None),
    }
    without = profile.student_lookup("1", engagement, risk, None).select(*status).first()
    assert tuple(without) == ("found", "grades_not_available", "no_prediction")


def test_blank_search_finds_nothing(tables):
    assert rows(profile.student_lookup("  ", *tables)) == []


def test_lookup_without_risk_table(tables):
    engagement, _, grades = tables
    found = profile.student_lookup("1", engagement, None, grades).first()
    assert (found["risk_probability"], found["prediction"]) == (0.0, 0)


def test_lookup_reaches_the_scan(spark, tables, tmp_path):
    stored = []
    for number, table in enumerate(tables):
        table.write.parquet(f"{tmp_path}/{number}")
        stored.append(spark.read.parquet(f"{tmp_path}/{number}"))
    plan = profile.student_lookup(" 1.0", *stored)._jdf.queryExecution().toString()
    assert plan.count("EqualTo(id_student,1)") >= 3
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_profiles_of_requests(spark, tables):
    requests = spark.createDataFrame(
        [("1",), ("01",), ("7",), ("",), (None,)], "search string"
    )
    found = profile.student_profiles(requests, *tables).select("searched", "lookup_status")
    assert sorted(rows(found)) == [("1", "found"), ("1", "found"), ("7", "no_such_student")]


def test_profiles_with_text_keys(spark, tables):
    engagement, risk, grades = tables
    texts = engagement.withColumn("id_student", engagement["id_student"].cast("string"))
    requests = spark.createDataFrame([("2.0",)], "search string")
    found = profile.student_profiles(requests, texts, risk, grades).first()
    assert (found["lookup_status"], found["total_clicks"]) == ("found", 20)


def test_grade_table_with_few_columns(tables):
    engagement, risk, grades = tables
    found = profile.student_lookup(
        "3", engagement, risk, grades.select("id_student", "predicted_gpa")
    ).first()
    assert (found["predicted_gpa_raw"], found["gpa_bounds_note"]) == (49.0, "within_range")
    assert found["grade_band"] == "critical"


def test_comparison_counts_copies_in_the_average(tables):
    engagement, risk, _ = tables
    found = profile.student_lookup("2", *tables)
    population = students.with_copies(engagement, risk)
    compared = profile.compared_with_average(found, profile.averages(population, "copies"))
    assert {r["metric"]: (r["student"], r["average"]) for r in compared.collect()} == {
        "Engagement": (pytest.approx(12.2), pytest.approx((3 * 7.6 + 12.2 + 16.8) / 5)),
        "Total Clicks": (20.0, pytest.approx(16.0)),
        "Days Active": (7.0, pytest.approx(6.6)),
    }


def test_model_inputs(tables):
    graded = profile.model_inputs(profile.student_lookup("3", *tables))
    assert {r["term"]: r["value"] for r in graded.collect()} == {
        "total_clicks": 30.0,
        "days_active": 8.0,
        "engagement_index": pytest.approx(16.8),
        "risk_probability": 0.0,
        "predicted_gpa": 49.0,
        "predicted_gpa_raw": 49.0,
    }
    ungraded = profile.model_inputs(profile.student_lookup("2", *tables))
    assert ungraded.count() == 4
    assert profile.model_inputs(profile.student_lookup("8", *tables)).count() == 0
