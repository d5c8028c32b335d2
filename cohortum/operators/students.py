"""The student view: engagement with the risk scores of every enrolment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortum.functions.keys import with_joinable_keys
from cohortum.operators.joins import left_join


def with_default_risk(students: DataFrame) -> DataFrame:
    return students.withColumns({"prediction": F.lit(0), "risk_probability": F.lit(0.0)})


def risk_or_default(engagement: DataFrame, risk: DataFrame | None) -> DataFrame:
    """The risk table or, as long as there is none, no risk for every student."""
    if risk is not None:
        return risk
    return with_default_risk(engagement.select("id_student"))


def student_rows(engagement: DataFrame, risk: DataFrame | None) -> DataFrame:
    """Engagement with risk: a row per risk score, and one for a student that has none.

    Missing risk is null and therefore in no list and above no threshold.
    """
    if risk is None:
        return with_default_risk(engagement)
    one, many = with_joinable_keys("id_student", engagement, risk)
    return left_join(one, many, "id_student")


def with_copies(engagement: DataFrame, risk: DataFrame | None) -> DataFrame:
    """Engagement with the number of rows, ``copies``, that a student has in the student view.

    Figures over the view need only this number, so its rows are not built for them.
    """
    if risk is None:
        return engagement.withColumn("copies", F.lit(1).cast("bigint"))
    one, many = with_joinable_keys("id_student", engagement, risk)
    counts = many.groupBy("id_student").agg(F.count(F.lit(1)).alias("_scores"))
    return one.join(counts, "id_student", "left").select(
        *one.columns, F.coalesce("_scores", F.lit(1).cast("bigint")).alias("copies")
    )
