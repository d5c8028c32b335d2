"""Enrolments beside engagement, with the at-risk label."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed
from cohortum.functions.columns import at_risk_label


def outcome_rows(
    engagement: DataFrame,
    info: DataFrame,
    outcome: str = "final_result",
    positive: Iterable[str] = fixed.AT_RISK_OUTCOMES,
) -> DataFrame:
    """One row per enrolment of an active student: features and label.

    A student with several enrolments gives several rows with the same features, each with the
    label of its own outcome.
    """
    labels = info.select(
        "id_student", at_risk_label(F.col(outcome), positive).alias("label")
    )
    features = engagement.select("id_student", *fixed.FEATURES)
    return features.join(labels, "id_student")
