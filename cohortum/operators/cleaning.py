"""Cleaning rules per table. Each is one projection, so cleaning never shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum import fixed_values as fixed
from cohortum.functions.columns import clamp, non_negative, tidy, tidy_lower

Rule = Callable[[DataFrame, str], Column]


def score_rule(df: DataFrame, name: str) -> Column:
    return clamp(F.col(name))


def count_rule(df: DataFrame, name: str) -> Column:
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    return non_negative(F.col(name).try_cast("double") if is_text else F.col(name))


def day_rule(df: DataFrame, name: str) -> Column:
    marker = F.lit(fixed.MISSING_DAY).cast(df.schema[name].dataType)
    return F.coalesce(F.col(name), marker)


def category_rule(df: DataFrame, name: str) -> Column:
    return tidy(F.col(name))


def lower_category_rule(df: DataFrame, name: str) -> Column:
    return tidy_lower(F.col(name))


RULES: dict[str, dict[str, Rule]] = {
    "studentInfo": {
        "final_result": category_rule,
        "region": category_rule,
        "highest_education": category_rule,
        "gender": lower_category_rule,
        "studied_credits": count_rule,
    },
    "studentAssessment": {"score": score_rule, "date_submitted": day_rule},
    "assessments": {"weight": score_rule},
    "studentVle": {"sum_click": count_rule},
}


def apply_rules(df: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """Apply the rules whose column exists; all other columns pass through."""
    present = {name: rule(df, name) for name, rule in rules.items() if name in df.columns}
    return df.withColumns(present) if present else df


def clean(name: str, df: DataFrame) -> DataFrame:
    """Clean the table called ``name``; a table without rules is returned as it is."""
    return apply_rules(df, RULES.get(name, {}))
