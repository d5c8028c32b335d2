"""Column types of the raw tables, by column name, and the schemas of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw texts that mean a missing value, and columns where any other text does too.
MISSING = ("", "?")
LENIENT = ("score", "weight")

RAW_TYPES: dict[str, dict[str, T.DataType]] = {
    "studentVle": {
        "id_student": T.LongType(),
        "id_site": T.LongType(),
        "date": T.IntegerType(),
        "sum_click": T.LongType(),
    },
    "studentInfo": {
        "id_student": T.LongType(),
        "gender": T.StringType(),
        "region": T.StringType(),
        "highest_education": T.StringType(),
        "studied_credits": T.IntegerType(),
        "final_result": T.StringType(),
    },
    "studentAssessment": {
        "id_assessment": T.LongType(),
        "id_student": T.LongType(),
        "date_submitted": T.IntegerType(),
        "score": T.DoubleType(),
    },
    "assessments": {"id_assessment": T.LongType(), "weight": T.DoubleType()},
    "vle": {"id_site": T.LongType()},
}

ENGAGEMENT = T.StructType(
    [
        T.StructField("id_student", T.LongType()),
        T.StructField("total_clicks", T.LongType()),
        T.StructField("days_active", T.LongType()),
        T.StructField("total_interactions", T.LongType()),
        T.StructField("engagement_index", T.DoubleType()),
    ]
)

RISK = T.StructType(
    [
        T.StructField("id_student", T.LongType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("risk_probability", T.FloatType()),
    ]
)

GRADES = T.StructType(
    [
        T.StructField("id_student", T.LongType()),
        T.StructField("predicted_gpa", T.DoubleType()),
        T.StructField("predicted_gpa_raw", T.DoubleType()),
        T.StructField("gpa_bounds_note", T.StringType()),
    ]
)

REJECTED_LINES = "raw_table string, column string, text string, line string"
INGEST_REPORT = "raw_table string, column string, rejected bigint, lines bigint"
