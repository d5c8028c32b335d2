"""Constants that results depend on, and that must keep exactly this form."""

from __future__ import annotations

from typing import NamedTuple

# Table names.
RAW_TABLES = ("studentVle", "studentInfo", "vle", "studentAssessment", "assessments")
ENGAGEMENT_TABLE = "engagement_features"
AVERAGES_TABLE = "student_averages"
REJECTED_TABLE = "rejected_lines"
REPORT_TABLE = "ingest_report"
RISK_TABLE = "predictions"
GRADE_TABLE = "gpa_predictions"
COHORT_TABLES = ("region_stats", "education_stats", "region_gpa_stats", "education_gpa_stats")

# Cleaning.
SCORE_MIN = 0.0
SCORE_MAX = 100.0
MISSING_DAY = -1

# Engagement index.
CLICK_WEIGHT = 0.4
DAY_WEIGHT = 0.6

# Outcomes that count as at risk.
AT_RISK_OUTCOMES = ("Fail", "Withdrawn")

# Learning.
FEATURES = ("total_clicks", "days_active", "engagement_index")
TRAIN_SHARE = 0.8
SPLIT_SEED = 42
FOREST_TREES = 100
FOREST_PARTS = 16
RIDGE_PENALTY = 0.1

# Notes on bounded predictions.
CAPPED_LOW = "capped_to_0"
CAPPED_HIGH = "capped_to_100"
WITHIN = "within_range"

# Figures and lists of the overview.
ALERT_ABOVE = 0.7
HIGH_RISK_FROM = 0.70
LOW_RISK_UPTO = 0.30
LIST_LENGTH = 8
GOOD_LIST_LENGTH = 100
HISTOGRAM_BINS = 30


class GoodHistory(NamedTuple):
    """Limits of the good-history filter: all three must hold."""

    max_risk: float
    min_grade: float
    min_days: int


# The default and the strict good-history limits.
GOOD_HISTORY = GoodHistory(0.30, 70, 5)
EXCELLENT_HISTORY = GoodHistory(0.20, 75, 7)

# Grade bands, each up to but not including its limit.
CRITICAL_BELOW = 50
BORDERLINE_BELOW = 70

# Labels of the comparison with the average, and the columns they show.
COMPARED = {
    "Engagement": "engagement_index",
    "Total Clicks": "total_clicks",
    "Days Active": "days_active",
}

# Columns of the result lists.
RISK_LIST = ("id_student", "engagement_index", "risk_probability")
GOOD_LIST = (
    "id_student",
    "risk_probability",
    "predicted_gpa",
    "engagement_index",
    "days_active",
    "total_clicks",
)
