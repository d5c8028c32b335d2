"""Weighted grades per student, and the rows the grade model learns from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed
from cohortum.functions.columns import bounds_note, clamp


def weighted_grades(
    submissions: DataFrame,
    assessments: DataFrame,
    student: str = "id_student",
    assessment: str = "id_assessment",
    score: str = "score",
    weight: str = "weight",
) -> DataFrame:
    """Sum of score times weight / 100 over all submissions of a student, as ``current_gpa``.

    Missing scores and weights add nothing; a student without any product gets a missing grade.
    The sum is not divided by the total weight, so it may pass 100.

    Spark broadcasts the assessments if their measured size is small; otherwise both sides are
    shuffled as they are, so that adaptive execution can split a very frequent assessment.
    """
    weights = assessments.select(assessment, F.col(weight).alias("_weight"))
    return (
        submissions.select(
            F.col(student).alias("id_student"), assessment, F.col(score).alias("_score")
        )
        .join(weights, assessment)
        .groupBy("id_student")
        .agg(F.sum(F.col("_score") * F.col("_weight") / 100).alias("current_gpa"))
    )


def grade_rows(grades: DataFrame, engagement: DataFrame) -> DataFrame:
    """Grades beside engagement features as doubles: gaps in features are 0, rows without a grade
    are left out. Both sides hold one row per student, so the join cannot grow or skew."""
    features = [F.col(name).cast("double") for name in fixed.FEATURES]
    return (
        grades.dropna(subset=["current_gpa"])
        .join(engagement, "id_student")
        .select("id_student", F.col("current_gpa").cast("double"), *features)
        .fillna(0.0, subset=list(fixed.FEATURES))
    )


def bounded_grades(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Predicted grade in [0, 100], the raw prediction, and a note on which bound applied."""
    raw = F.col(prediction)
    return predictions.select(
        "id_student",
        clamp(raw).alias("predicted_gpa"),
        raw.alias("predicted_gpa_raw"),
        bounds_note(raw).alias("gpa_bounds_note"),
    )


def capped_count(grades: DataFrame) -> DataFrame:
    """How many predictions a bound was applied to, as a one-row frame."""
    return grades.agg(
        F.count_if(F.col("gpa_bounds_note") != fixed.WITHIN).alias("n_capped")
    )
