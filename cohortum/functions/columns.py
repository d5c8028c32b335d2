"""Repairs, labels and bands as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum import fixed_values as fixed


def clamp(value: Column, low: float = fixed.SCORE_MIN, high: float = fixed.SCORE_MAX) -> Column:
    """Bring a number into ``[low, high]`` as double.

    Missing stays missing, also for text that is no number; NaN sorts above every number in
    Spark and therefore becomes ``high``.
    """
    number = value.try_cast("double")
    return F.when(number < low, F.lit(low)).when(number > high, F.lit(high)).otherwise(number)


def bounds_note(value: Column, low: float = fixed.SCORE_MIN, high: float = fixed.SCORE_MAX) -> Column:
    """Say which bound :func:`clamp` applied, if any."""
    return (
        F.when(value < low, F.lit(fixed.CAPPED_LOW))
        .when(value > high, F.lit(fixed.CAPPED_HIGH))
        .otherwise(F.lit(fixed.WITHIN))
    )


def non_negative(value: Column) -> Column:
    """Keep numbers from 0 up; missing and negative ones become 0. The type is kept."""
    return F.when(value >= 0, value).otherwise(F.lit(0))


def tidy(value: Column) -> Column:
    """Strip the spaces around a category. Tabs are part of the value and stay."""
    return F.trim(value)


def tidy_lower(value: Column) -> Column:
    return F.lower(F.trim(value))


def engagement_index(
    clicks: Column,
    days: Column,
    click_weight: float = fixed.CLICK_WEIGHT,
    day_weight: float = fixed.DAY_WEIGHT,
) -> Column:
    return clicks * F.lit(click_weight) + days * F.lit(day_weight)


def at_risk_label(outcome: Column, positive: Iterable[str] = fixed.AT_RISK_OUTCOMES) -> Column:
    """1 for the outcomes in ``positive``, 0 for every other one, missing outcomes included."""
    return F.coalesce(outcome.isin(*positive), F.lit(False)).cast("int")


def grade_band(grade: Column) -> Column:
    """Place a predicted grade in its band."""
    return (
        F.when(grade.isNull(), "no_prediction")
        .when(grade < fixed.CRITICAL_BELOW, "critical")
        .when(grade < fixed.BORDERLINE_BELOW, "borderline")
        .otherwise("excellent")
    )


def limit_for(df: DataFrame, column: str, limit: float) -> Column:
    """A threshold in the type of the column it is compared with.

    A 32-bit 0.7 widened to double is a little below the double 0.7, so comparing a float
    column with a double literal would lose exact ties.
    """
    kind = df.schema[column].dataType
    return F.lit(limit).cast(kind) if isinstance(kind, T.FractionalType) else F.lit(limit)
