"""What must hold for the plans of all registered queries."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cohortum import fixed_values as fixed
from cohortum.operators import overview
from cohortum.operators.engagement import engagement_features
from cohortum.operators.grades import weighted_grades
from cohortum.operators.outcomes import outcome_rows
from cohortum.operators.students import student_rows
from cohortum.plans.catalogue import QUERIES
from cohortum.plans.roles import Roles
from tests import data

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_product(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for node in ("EvalPython", "InPandas", "InArrow", "Cartesian", "NestedLoop", "Window"):
        assert node not in plan


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 15
    assert result.columns == [
        "id_student", "total_clicks", "days_active", "total_interactions", "engagement_index",
    ]


def test_engagement_reads_four_columns_and_sums_before_each_shuffle(spark):
    plan = plan_of(engagement_features(Roles(spark, FOLDER).activity))
    assert plan.count("Exchange") == 2
    assert sum("partial_" in line for line in plan.splitlines()) == 2
    assert "props" not in plan and "event_id" not in plan


def test_grades_shuffle_the_submissions_once(spark, tmp_path):
    """Assessments that are small by their measured size are broadcast."""
    spark.range(50).selectExpr("id AS id_student", "id AS id_assessment", "1.0D AS score").write.parquet(f"{tmp_path}/s")
    spark.range(50).selectExpr("id AS id_assessment", "1.0D AS weight").write.parquet(f"{tmp_path}/a")
    plan = plan_of(weighted_grades(*(spark.read.parquet(f"{tmp_path}/{name}") for name in "sa")))
    facts = plan.split("BroadcastExchange")[0]
    assert facts.count("Exchange") == 1 and "partial_sum" in facts


def test_limits_reach_the_scans(spark, tmp_path):
    stored = []
    for name, frame in {
        "e": data.engagement(spark, (1, 10, 6)),
        "r": data.risk(spark, (1, 0.2)),
        "g": data.grades(spark, (1, 80.0)),
    }.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        stored.append(spark.read.parquet(f"{tmp_path}/{name}"))
    plan = plan_of(overview.good_history_list(*stored, fixed.GOOD_HISTORY))
    for pushed in (
        "LessThanOrEqual(risk_probability,0.3)",
        "GreaterThanOrEqual(predicted_gpa,70.0)",
        "GreaterThanOrEqual(days_active,5)",
    ):
        assert pushed in plan


def test_lists_are_taken_as_top_rows(spark):
    plan = plan_of(overview.high_risk_list(data.engagement(spark, (1, 1, 1)), data.risk(spark, (1, 0.9))))
    assert plan.count("TakeOrderedAndProject") == 2


@pytest.fixture
def small_partitions(spark):
    """Settings under which small data is shuffled and split like large data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def frequent(spark, key: str, *columns: str) -> DataFrame:
    """Rows of which half have the key 5."""
    rows = spark.range(0, 60_000, 1, 8)
    value = F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 1000)
    return rows.select(value.alias(key), *(F.expr(column) for column in columns))


def active(spark) -> DataFrame:
    return spark.range(1000).selectExpr(
        "id AS id_student", "10L AS total_clicks", "9L AS days_active", "1L AS total_interactions",
        "CAST(id AS DOUBLE) AS engagement_index",
    )


def test_a_frequent_assessment_is_split(spark, small_partitions):
    submissions = frequent(spark, "id_assessment", "id AS id_student", "rand(1) AS score")
    assessments = spark.range(1000).select(F.col("id").alias("id_assessment"), F.lit(1.0).alias("weight"))
    result = weighted_grades(submissions, assessments)
    assert len(result.collect()) == 60_000
    assert "skew=true" in plan_of(result)


def test_a_student_with_very_many_rows_is_split(spark, small_partitions):
    info = frequent(spark, "id_student", "IF(rand(1) < 0.5, 'Fail', 'Pass') AS final_result")
    risk = frequent(spark, "id_student", "CAST(rand(2) / 10 AS FLOAT) AS risk_probability", "rand(3) AS prediction")
    grades = spark.range(1000).selectExpr("id AS id_student", "80.0D AS predicted_gpa")
    for result in (
        outcome_rows(active(spark), info),
        student_rows(active(spark), risk),
        overview.good_history(active(spark), risk, grades),
    ):
        assert len(result.collect()) >= 60_000
        assert "skew=true" in plan_of(result)


def test_risk_scores_gives_the_scores_and_their_checks(spark):
    roles = Roles(spark, FOLDER)
    found = QUERIES["risk_scores"](spark, FOLDER)
    assert found.columns == ["id_student", "prediction", "risk_probability", "in_range", "class_agrees"]
    assert found.count() == outcome_rows(roles.engagement, roles.enrolments).count()
    scores = "prediction IN (0, 1) AND risk_probability BETWEEN 0 AND 1 AND in_range AND class_agrees"
    assert found.where(scores).count() == found.count()
