"""Overview queries: key figures, distribution, risk lists and the good-history filter.

A student with k risk scores counts k times in all of them, as in the student view. The figures
and lists work on one row per student, or per student and score, with the number of copies; only
:func:`good_history` returns every copy as a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed
from cohortum.fixed_values import GOOD_LIST, RISK_LIST, GoodHistory
from cohortum.functions.columns import limit_for
from cohortum.functions.keys import coerced_number, with_joinable_keys
from cohortum.operators.students import risk_or_default
from cohortum.sources.tables import materialise


def key_figures(
    engagement: DataFrame, risk: DataFrame | None, alert_above: float = fixed.ALERT_ABOVE
) -> DataFrame:
    """One row: rows and students in the view, mean risk in percent, mean engagement (raw and
    rounded half to even), and the number of rows with risk strictly above ``alert_above``."""
    one, many = with_joinable_keys(
        "id_student", engagement, risk_or_default(engagement, risk)
    )
    score = F.col("risk_probability")
    per_student = many.groupBy("id_student").agg(
        F.count(F.lit(1)).alias("_scores"),
        F.count(score).alias("_filled"),
        F.sum(score.cast("double")).alias("_total"),
        F.count_if(score > limit_for(many, "risk_probability", alert_above)).alias("_alerts"),
    )
    index = F.col("engagement_index")
    copies = F.coalesce("_scores", F.lit(1))
    mean_engagement = F.try_divide(
        F.sum(index * copies), F.sum(F.when(index.isNotNull(), copies))
    )
    return one.join(per_student, "id_student", "left").agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("row_count"),
        F.count_distinct("id_student").alias("distinct_students"),
        (F.try_divide(F.sum("_total"), F.sum("_filled")) * 100).alias("avg_risk_percent"),
        mean_engagement.alias("avg_engagement"),
        F.bround(mean_engagement, 2).alias("avg_engagement_rounded"),
        F.coalesce(F.sum("_alerts"), F.lit(0)).alias("high_risk_count"),
    )


def histogram(
    df: DataFrame, column: str, bins: int = fixed.HISTOGRAM_BINS, copies: str | None = None
) -> DataFrame:
    """Equal-width bins between the smallest and the largest value, empty ones with count 0.

    The last bin includes the maximum. ``copies`` names a column that says how often a row counts.
    If all values are equal there is one bin, without any value there is none.
    """
    ends = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    value, weight = F.col("_value"), F.col("_weight")
    low, width = F.col("_ends.low"), (F.col("_ends.high") - F.col("_ends.low")) / F.lit(bins)
    bin_number = (
        F.when(width > 0, F.least(F.floor((value - low) / width), F.lit(bins - 1)))
        .otherwise(0)
        .cast("int")
    )
    counts = (
        df.select(
            F.col(column).cast("double").alias("_value"),
            (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("_weight"),
            ends.alias("_ends"),
        )
        .where(value.isNotNull())
        .select(bin_number.alias("bin"), weight)
        .groupBy("bin")
        .agg(F.sum("_weight").alias("row_count"))
    )
    wide = (F.col("_ends.high") > F.col("_ends.low")).cast("int")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(bins - 1) * wide)).alias("bin")
    return (
        df.sparkSession.range(1).select(ends.alias("_ends"))
        .where(F.col("_ends.low").isNotNull())
        .select(numbers, low.alias("_low"), width.alias("_width"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
            (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
        )
    )


def high_risk_list(
    engagement: DataFrame,
    risk: DataFrame | None,
    threshold: float = fixed.HIGH_RISK_FROM,
    length: int = fixed.LIST_LENGTH,
) -> DataFrame:
    """The rows with the highest risk among those at or above the threshold."""
    scores = risk_or_default(engagement, risk)
    chosen = scores.where(
        F.col("risk_probability") >= limit_for(scores, "risk_probability", threshold)
    )
    return _risk_list(engagement, chosen, F.desc, length)


def low_risk_list(
    engagement: DataFrame,
    risk: DataFrame | None,
    threshold: float = fixed.LOW_RISK_UPTO,
    length: int = fixed.LIST_LENGTH,
) -> DataFrame:
    """The rows with the lowest risk among those at or below the threshold."""
    scores = risk_or_default(engagement, risk)
    chosen = scores.where(
        F.col("risk_probability") <= limit_for(scores, "risk_probability", threshold)
    )
    return _risk_list(engagement, chosen, F.asc, length)


def _risk_list(
    engagement: DataFrame, chosen: DataFrame, order: Callable[[str], Column], length: int
) -> DataFrame:
    one, many = with_joinable_keys("id_student", engagement, chosen)
    rows = _score_copies(many).join(one.select("id_student", "engagement_index"), "id_student")
    return _first_rows(rows, [order("risk_probability"), F.asc("id_student")], length).select(
        *RISK_LIST
    )


def good_history(
    engagement: DataFrame,
    risk: DataFrame | None,
    grades: DataFrame | None,
    limits: GoodHistory = fixed.GOOD_HISTORY,
    ordered: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Every row of students with low risk, a good predicted grade and enough active days.

    ``ordered`` sorts by risk, then by grade from the best, then by key. Equal rows are told apart
    by their partition only to keep the copies of one student from sorting in a single task.
    The students that meet the limits are stored first, so that a frequent one can be split in
    the join with the scores. ``folder`` says where, for a caller that removes it after the rows
    have been read (see ``intermediate_folder``); else they stay until :func:`remove_intermediate`.
    """
    chosen, scores = _good_parts(engagement, risk, grades, limits)
    rows = materialise(chosen, folder).join(scores, "id_student").select(*GOOD_LIST)
    return rows.orderBy(*_good_order(), F.spark_partition_id()) if ordered else rows


def good_history_list(
    engagement: DataFrame,
    risk: DataFrame | None,
    grades: DataFrame | None,
    limits: GoodHistory = fixed.GOOD_HISTORY,
    length: int = fixed.GOOD_LIST_LENGTH,
) -> DataFrame:
    """The first rows of the ordered good-history view."""
    chosen, scores = _good_parts(engagement, risk, grades, limits)
    rows = _score_copies(scores).join(chosen, "id_student")
    return _first_rows(rows, _good_order(), length).select(*GOOD_LIST)


def good_history_count(
    engagement: DataFrame,
    risk: DataFrame | None,
    grades: DataFrame | None,
    limits: GoodHistory = fixed.GOOD_HISTORY,
) -> DataFrame:
    """The number of rows in the good-history view, as a one-row frame."""
    chosen, scores = _good_parts(engagement, risk, grades, limits)
    matches = _score_copies(scores).join(chosen.select("id_student"), "id_student")
    return matches.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("matching_rows"))


def _good_order() -> list[Column]:
    return [F.asc("risk_probability"), F.desc("predicted_gpa"), F.asc("id_student")]


def _good_parts(
    engagement: DataFrame, risk: DataFrame | None, grades: DataFrame | None, limits: GoodHistory
) -> tuple[DataFrame, DataFrame]:
    """Students that meet the limits on days and grade, and the scores that meet the one on risk.

    All three limits reject missing values, so inner joins replace the left joins of the view and
    each limit filters its own table before the join.
    """
    scores = risk_or_default(engagement, risk)
    low = scores.where(
        F.col("risk_probability") <= limit_for(scores, "risk_probability", limits.max_risk)
    ).select("id_student", "risk_probability")
    active = engagement.where(F.col("days_active") >= limits.min_days)
    if grades is None:
        nobody = active.withColumn("predicted_gpa", F.lit(None).cast("double")).where(F.lit(False))
        return with_joinable_keys("id_student", nobody, low)
    good = grades.select(
        "id_student", coerced_number(F.col("predicted_gpa")).alias("predicted_gpa")
    ).where(F.col("predicted_gpa") >= limits.min_grade)
    active, good, low = with_joinable_keys("id_student", active, good, low)
    return active.join(good, "id_student"), low


def _score_copies(scores: DataFrame) -> DataFrame:
    """One row per student and score, with the number of times it occurs."""
    return scores.groupBy("id_student", "risk_probability").agg(
        F.count(F.lit(1)).alias("copies")
    )


def _first_rows(rows: DataFrame, order: list[Column], length: int) -> DataFrame:
    """The first rows in order when every row stands for ``copies`` equal ones.

    The first ``length`` rows are enough to choose from, and no row can fill more than ``length``
    places, so what is repeated is at most ``length`` squared rows.
    """
    places = F.least(F.col("copies"), F.lit(length)).cast("int")
    repeated = rows.orderBy(*order).limit(length).withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(True), places))
    )
    return repeated.orderBy(*order).limit(length)
