"""Engagement features per student from the activity log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum import fixed_values as fixed
from cohortum.functions.columns import engagement_index


def engagement_features(
    activity: DataFrame,
    student: str = "id_student",
    clicks: str = "sum_click",
    day: str = "date",
    item: str = "id_site",
    click_weight: float = fixed.CLICK_WEIGHT,
    day_weight: float = fixed.DAY_WEIGHT,
) -> DataFrame:
    """Total clicks, distinct active days, interactions and the engagement index per student.

    ``day`` may have any type that can be grouped. Numbered and calendar days are collected as
    bits, 64 days to a row, so that what is shuffled after the partial sums in the map tasks is a
    row per student and 64 days and not one per day. In either form no task sees more of a very
    active student than these partial rows.
    """
    number = _day_number(activity, day)
    key = F.col(student).alias("id_student")
    if number is None:
        totals = activity.groupBy(key).agg(
            F.sum(clicks).alias("total_clicks"),
            F.count_distinct(F.col(day)).alias("days_active"),
            F.count(item).alias("total_interactions"),
        )
    else:
        one_day = F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(64)).cast("int")
        )
        blocks = activity.groupBy(key, F.shiftright(number, 6).alias("_block")).agg(
            F.sum(clicks).alias("_clicks"),
            F.bit_or(one_day).alias("_days"),
            F.count(item).alias("_items"),
        )
        totals = blocks.groupBy("id_student").agg(
            F.sum("_clicks").alias("total_clicks"),
            F.coalesce(F.sum(F.bit_count("_days")), F.lit(0)).alias("days_active"),
            F.sum("_items").alias("total_interactions"),
        )
    index = engagement_index(
        F.col("total_clicks"), F.col("days_active"), click_weight, day_weight
    )
    return totals.withColumn("engagement_index", index)


def _day_number(df: DataFrame, day: str) -> Column | None:
    """The day as a whole number, if its type has one."""
    kind = df.schema[day].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(day)
    return F.col(day) if isinstance(kind, T.IntegralType) else None


def most_engaged(engagement: DataFrame, length: int) -> DataFrame:
    """The students with the highest engagement index; equal ones in order of their key."""
    return engagement.orderBy(F.desc("engagement_index"), "id_student").limit(length)
