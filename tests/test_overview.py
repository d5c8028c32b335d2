from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed
from cohortum.operators import overview, students
from tests import data
from tests.data import as_set, rows


@pytest.fixture(scope="module")
def tables(spark):
    engagement = data.engagement(
        spark, (1, 10, 6), (2, 20, 7), (3, 30, 8), (4, 40, 9), (5, 50, 2), (6, 60, 9)
    )
    risk = data.risk(
        spark, (1, 0.7), (1, 0.7), (2, 0.3), (2, 0.1), (3, 0.9), (5, 0.2), (6, None), (99, 0.95)
    )
    grades = data.grades(spark, (1, 90.0), (2, 75.0), (3, 99.0), (4, 80.0), (5, 80.0))
    return engagement, risk, grades


def plain(engagement, risk):
    return engagement.join(risk, "id_student", "left")


def test_student_rows(tables):
    engagement, risk, _ = tables
    result = students.student_rows(engagement, risk)
    assert as_set(result.select(plain(engagement, risk).columns)) == as_set(plain(engagement, risk))


def test_student_rows_without_risk(tables):
    result = students.student_rows(tables[0], None)
    assert result.count() == 6
    assert set(rows(result.select("risk_probability", "prediction"))) == {(0.0, 0)}


def test_student_rows_with_text_keys(spark, tables):
    engagement, _, _ = tables
    texts = spark.createDataFrame(
        [("1.0", 0.4), ("02", 0.5), ("z", 0.6)], "id_student string, risk_probability double"
    )
    found = students.student_rows(engagement, texts).where("risk_probability is not null")
    assert as_set(found.select("id_student", "risk_probability")) == [("1", 0.4), ("2", 0.5)]


def test_key_figures(tables):
    engagement, risk, _ = tables
    found = overview.key_figures(engagement, risk).first().asDict()
    view = plain(engagement, risk)
    expected = view.agg(
        F.count(F.lit(1)), F.countDistinct("id_student"),
        F.avg("risk_probability") * 100, F.avg("engagement_index"),
    ).first()
    assert list(found.values())[:4] == pytest.approx(list(expected))
    assert found["high_risk_count"] == 1
    assert found["avg_engagement_rounded"] == pytest.approx(expected[3], abs=0.005)


def test_key_figures_without_risk_or_rows(spark, tables):
    figures = overview.key_figures(tables[0], None).first()
    assert (figures["row_count"], figures["avg_risk_percent"]) == (6, 0.0)
    empty = overview.key_figures(tables[0].limit(0), tables[1]).first()
    assert (empty["row_count"], empty["avg_risk_percent"], empty["high_risk_count"]) == (0, None, 0)


def test_histogram_counts_copies(tables):
    engagement, risk, _ = tables
    weighted = students.with_copies(engagement, risk)
    bins = overview.histogram(weighted, "engagement_index", 30, "copies")
    assert bins.agg(F.sum("row_count")).first()[0] == plain(engagement, risk).count()
    low, high = bins.agg(F.min("bin"), F.max("bin")).first()
    assert (low, high) == (0, 29)


def test_histogram_of_equal_values_and_of_nothing(spark):
    same = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    assert rows(overview.histogram(same, "x")) == [(0, 2.0, 2.0, 2)]
    assert rows(overview.histogram(same.limit(0), "x")) == []


def test_high_risk_list_keeps_ties_and_copies(tables):
    engagement, risk, _ = tables
    ids = [r["id_student"] for r in overview.high_risk_list(engagement, risk).collect()]
    assert ids == [3, 1, 1]
    assert [r[0] for r in overview.high_risk_list(engagement, risk, length=2).collect()] == [3, 1]


def test_low_risk_list(tables):
    engagement, risk, _ = tables
    found = [(r[0], round(r[2], 2)) for r in overview.low_risk_list(engagement, risk).collect()]
    assert found == [(2, 0.1), (5, 0.2), (2, 0.3)]


def test_lists_with_more_copies_than_places(spark, tables):
    engagement, _, _ = tables
    many = data.risk(spark, *[(1, 0.8)] * 50, *[(2, 0.9)] * 5)
    ids = [r[0] for r in overview.high_risk_list(engagement, many, length=8).collect()]
    assert ids == [2] * 5 + [1] * 3


def test_good_history(tables):
    engagement, risk, grades = tables
    result = overview.good_history(engagement, risk, grades, ordered=True).collect()
    assert [(r[0], round(r[1], 2)) for r in result] == [(2, 0.1), (2, 0.3)]
    assert result[0].asDict().keys() == set(overview.GOOD_LIST)


def test_good_history_list_count_and_presets(tables):
    engagement, risk, grades = tables
    assert rows(overview.good_history_count(engagement, risk, grades)) == [(2,)]
    excellent = overview.good_history_count(engagement, risk, grades, fixed.EXCELLENT_HISTORY)
    assert rows(excellent) == [(1,)]
    listed = overview.good_history_list(engagement, risk, grades, length=1).collect()
    assert [r["id_student"] for r in listed] == [2]


def test_good_history_orders_by_risk_then_best_grade_then_key(spark):
    engagement = data.engagement(spark, *[(k, 10, 9) for k in (1, 2, 3, 4)])
    risk = data.risk(spark, (1, 0.2), (2, 0.1), (3, 0.2), (4, 0.2))
    grades = data.grades(spark, (1, 80.0), (2, 71.0), (3, 95.0), (4, 80.0))
    for result in (
        overview.good_history(engagement, risk, grades, ordered=True),
        overview.good_history_list(engagement, risk, grades),
    ):
        assert [r["id_student"] for r in result.collect()] == [2, 3, 1, 4]


def test_good_history_without_grades(tables):
    engagement, risk, _ = tables
    assert rows(overview.good_history(engagement, risk, None)) == []
    assert rows(overview.good_history_list(engagement, risk, None)) == []
    assert rows(overview.good_history_count(engagement, risk, None)) == [(0,)]
