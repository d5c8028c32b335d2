from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed
from cohortum.functions.columns import (
    at_risk_label,
    bounds_note,
    clamp,
    grade_band,
    limit_for,
    non_negative,
)
from cohortum.functions.keys import harmonise_key, same_key, with_joinable_keys
from cohortum.operators.cleaning import clean
from tests.data import rows


def apply(spark, kind, values, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    result = frame.select("i", column(F.col("v")).alias("r"))
    return [row["r"] for row in sorted(result.collect(), key=lambda row: row["i"])]


def test_clamp_keeps_missing_and_sends_nan_to_the_top(spark):
    values = [-1.0, 0.0, 50.0, 100.0, 101.0, None, math.nan]
    assert apply(spark, "double", values, clamp) == [0.0, 0.0, 50.0, 100.0, 100.0, None, 100.0]


def test_clamp_reads_text_without_an_error(spark):
    assert apply(spark, "string", ["5", "?", "-1", "150"], clamp) == [5.0, None, 0.0, 100.0]


def test_clamp_turns_integers_into_doubles(spark):
    frame = spark.createDataFrame([(7,)], "v int").select(clamp(F.col("v")).alias("r"))
    assert frame.dtypes == [("r", "double")]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats()), min_size=1, max_size=30))
def test_clamp_is_bounded_and_idempotent(spark, values):
    once = apply(spark, "double", values, clamp)
    assert all(v is None or 0 <= v <= 100 for v in once)
    assert apply(spark, "double", once, clamp) == once


def test_non_negative_keeps_the_type(spark):
    assert apply(spark, "long", [-3, 0, 7, None], non_negative) == [0, 0, 7, 0]
    frame = spark.createDataFrame([(7,)], "v long").select(non_negative(F.col("v")).alias("r"))
    assert frame.dtypes == [("r", "bigint")]


def test_notes_of_bounded_predictions(spark):
    assert apply(spark, "double", [-0.1, 0.0, 55.0, 100.0, 100.1], bounds_note) == [
        fixed.CAPPED_LOW,
        fixed.WITHIN,
        fixed.WITHIN,
        fixed.WITHIN,
        fixed.CAPPED_HIGH,
    ]


def test_label_is_case_sensitive_and_safe_when_unknown(spark):
    outcomes = ["Pass", "Distinction", "Fail", "Withdrawn", "fail", None]
    assert apply(spark, "string", outcomes, at_risk_label) == [0, 0, 1, 1, 0, 0]


def test_grade_bands(spark):
    assert apply(spark, "double", [49.9, 50.0, 69.9, 70.0, None], grade_band) == [
        "critical",
        "borderline",
        "borderline",
        "excellent",
        "no_prediction",
    ]


def test_thresholds_keep_float_ties(spark):
    frame = spark.createDataFrame([(0.3,), (0.7,), (None,)], "r float")
    at_least = frame.where(F.col("r") >= limit_for(frame, "r", 0.7))
    above = frame.where(F.col("r") > limit_for(frame, "r", 0.7))
    at_most = frame.where(F.col("r") <= limit_for(frame, "r", 0.3))
    assert (at_least.count(), above.count(), at_most.count()) == (1, 0, 1)


SPELLINGS = {
    "12": "12",
    " 12 ": "12",
    "\t12\n": "12",
    "12.0": "12",
    "12.": "12",
    "1e3": "1000",
    "007": "7",
    "+7": "7",
    "-5": "-5",
    "-0": "0",
    "12.5": "12.5",
    "abc": "abc",
    "a b ": "a b",
    "inf": "inf",
    "nan": "nan",
    "12d": "12d",
    "0x10": "0x10",
    "1_000": "1_000",
    "9007199254740993": "9007199254740993",
    "9223372036854775807": "9223372036854775807",
    "1e30": "1e30",
    "": "",
    None: None,
}


def test_keys_have_one_spelling(spark):
    assert apply(spark, "string", list(SPELLINGS), harmonise_key) == list(SPELLINGS.values())


def test_harmonising_twice_changes_nothing(spark):
    once = apply(spark, "string", list(SPELLINGS), harmonise_key)
    assert apply(spark, "string", once, harmonise_key) == once


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.eE+-dx \t", max_size=8), min_size=1, max_size=30))
def test_harmonising_arbitrary_text_is_idempotent(spark, texts):
    once = apply(spark, "string", texts, harmonise_key)
    assert apply(spark, "string", once, harmonise_key) == once


def test_number_columns_are_matched_bare_and_text_is_harmonised(spark):
    numbers = spark.createDataFrame([(12,), (13,)], "id_student long")
    texts = spark.createDataFrame([("012",), (" 12.0",), ("x",)], "id_student string")
    for search, found in {"12.0": (1, 2), "x": (0, 1), "1e1000": (0, 0)}.items():
        counts = tuple(
            df.where(same_key(df, "id_student", F.lit(search))).count() for df in (numbers, texts)
        )
        assert counts == found


def test_mixed_key_types_join(spark):
    numbers = spark.createDataFrame([(12,)], "id_student long")
    texts = spark.createDataFrame([("12.0",), ("y",)], "id_student string")
    left, right = with_joinable_keys("id_student", numbers, texts)
    assert rows(left.join(right, "id_student")) == [("12",)]


def test_clean_info(spark):
    raw = spark.createDataFrame(
        [(" M ", " North ", "\tHE ", "Fail ", -3, "x"), (None, None, None, None, None, None)],
        "gender string, region string, highest_education string, final_result string, "
        "studied_credits int, extra string",
    )
    assert rows(clean("studentInfo", raw)) == [
        ("m", "North", "\tHE", "Fail", 0, "x"),
        (None, None, None, None, 0, None),
    ]


def test_clean_skips_absent_columns_and_unknown_tables(spark):
    frame = spark.createDataFrame([(" a ",)], "region string")
    assert rows(clean("studentInfo", frame)) == [("a",)]
    assert clean("vle", frame) is frame
    assert rows(clean("studentVle", frame)) == [(" a ",)]


def test_clean_submissions(spark):
    raw = spark.createDataFrame([(101.0, None), (None, 12)], "score double, date_submitted int")
    assert rows(clean("studentAssessment", raw)) == [(100.0, -1), (None, 12)]


@pytest.mark.parametrize("kind, value", [("long", 5), ("string", "5")])
def test_clean_clicks_of_any_type(spark, kind, value):
    raw = spark.createDataFrame([(value,), (None,)], f"sum_click {kind}")
    assert rows(clean("studentVle", raw)) == [(5,), (0,)]


def test_clean_text_counts_that_are_no_numbers(spark):
    raw = spark.createDataFrame([("?",), ("-2",), ("7",)], "sum_click string")
    assert rows(clean("studentVle", raw)) == [(0,), (0,), (7,)]
