"""The registered queries as SQL for an independent engine.

Each text states the plain definition, joins and all, and not the way Spark is led to the result.
"""

from __future__ import annotations

# Common tables, each with the tables it needs before it.
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "activity": (
        (),
        """SELECT user_id AS id_student, event_type AS id_site, CAST(ts AS DATE) AS date,
                  CAST(ROUND(value * 100) AS BIGINT) AS sum_click FROM events""",
    ),
    "engagement": (
        ("activity",),
        """SELECT id_student, CAST(SUM(sum_click) AS BIGINT) AS total_clicks,
                  COUNT(DISTINCT date) AS days_active, COUNT(id_site) AS total_interactions,
                  SUM(sum_click) * CAST(0.4 AS DOUBLE) + COUNT(DISTINCT date) * CAST(0.6 AS DOUBLE)
                      AS engagement_index
           FROM activity GROUP BY id_student""",
    ),
    "info": (
        (),
        """SELECT o_custkey AS id_student, LOWER(TRIM(o_orderpriority)) AS gender,
                  r_name AS region, c_mktsegment AS highest_education,
                  GREATEST(c_acctbal, 0) AS studied_credits, o_orderstatus AS final_result
           FROM orders JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey""",
    ),
    "enrolments": (
        (),
        "SELECT o_custkey AS id_student, o_orderstatus AS final_result FROM orders",
    ),
    "graded": (
        (),
        """SELECT o_custkey AS id_student,
                  SUM(CASE WHEN o_custkey % 13 <> 0
                           THEN LEAST(GREATEST(l_extendedprice / 1000, 0), 100) * p_size / 100 END)
                      AS current_gpa
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN part ON l_partkey = p_partkey
           GROUP BY o_custkey""",
    ),
    "feature_rows": (
        ("graded", "engagement"),
        """SELECT id_student, current_gpa, CAST(total_clicks AS DOUBLE) AS total_clicks,
                  CAST(days_active AS DOUBLE) AS days_active, engagement_index
           FROM graded JOIN engagement USING (id_student)
           WHERE current_gpa IS NOT NULL""",
    ),
    "risk": (
        ("enrolments", "engagement"),
        """SELECT id_student, CAST(risk > CAST(0.5 AS FLOAT) AS INTEGER)::DOUBLE AS prediction,
                  risk AS risk_probability
           FROM (SELECT enrolments.id_student,
                        CASE WHEN enrolments.id_student % 5 = 1 AND final_result = 'O' THEN NULL
                             ELSE CAST(share * CASE final_result WHEN 'F' THEN 1.0::DOUBLE
                                               WHEN 'O' THEN 0.75::DOUBLE ELSE 0.5::DOUBLE END AS FLOAT)
                        END AS risk
                 FROM enrolments
                      JOIN (SELECT id_student,
                                   CAST(AVG(CASE WHEN final_result = 'F' THEN 1 ELSE 0 END) AS FLOAT)
                                       AS share
                            FROM enrolments GROUP BY id_student) AS shares USING (id_student)
                      JOIN engagement USING (id_student)
                 WHERE enrolments.id_student % 7 <> 0) AS scored""",
    ),
    "grades": (
        (),
        """SELECT c_custkey AS id_student, LEAST(GREATEST(c_acctbal / 80, 0), 100) AS predicted_gpa,
                  c_acctbal / 80 AS predicted_gpa_raw,
                  CASE WHEN c_acctbal / 80 < 0 THEN 'capped_to_0'
                       WHEN c_acctbal / 80 > 100 THEN 'capped_to_100'
                       ELSE 'within_range' END AS gpa_bounds_note
           FROM customer""",
    ),
    "main": (
        ("engagement", "risk"),
        """SELECT id_student, total_clicks, days_active, total_interactions, engagement_index,
                  prediction, risk_probability
           FROM engagement LEFT JOIN risk USING (id_student)""",
    ),
    "good": (
        ("main", "grades"),
        """SELECT id_student, risk_probability, predicted_gpa, engagement_index, days_active,
                  total_clicks
           FROM main LEFT JOIN grades USING (id_student)
           WHERE risk_probability <= CAST({max_risk} AS FLOAT) AND predicted_gpa >= {min_grade}
                 AND days_active >= {min_days}""",
    ),
    "profiles": (
        ("engagement", "risk", "grades"),
        """SELECT CAST(c_custkey AS VARCHAR) AS searched,
                  CASE WHEN e.id_student IS NULL THEN 'no_such_student' ELSE 'found' END
                      AS lookup_status,
                  r.risk_probability, r.prediction, e.engagement_index,
                  round_even(e.engagement_index, 2) AS engagement_shown, e.total_clicks,
                  e.total_clicks AS clicks_shown, e.days_active,
                  CASE WHEN e.id_student IS NOT NULL THEN g.predicted_gpa END AS predicted_gpa,
                  CASE WHEN e.id_student IS NOT NULL THEN g.predicted_gpa_raw END
                      AS predicted_gpa_raw,
                  CASE WHEN e.id_student IS NOT NULL THEN g.gpa_bounds_note END AS gpa_bounds_note,
                  CASE WHEN e.id_student IS NULL THEN NULL
                       WHEN g.predicted_gpa IS NULL THEN 'no_prediction'
                       WHEN g.predicted_gpa < 50 THEN 'critical'
                       WHEN g.predicted_gpa < 70 THEN 'borderline'
                       ELSE 'excellent' END AS grade_band,
                  CASE WHEN e.id_student IS NULL THEN NULL
                       WHEN g.id_student IS NULL THEN 'no_grade_for_student'
                       ELSE 'graded' END AS grade_status
           FROM customer LEFT JOIN engagement e ON e.id_student = c_custkey
                LEFT JOIN (SELECT * FROM risk
                           QUALIFY ROW_NUMBER() OVER (PARTITION BY id_student
                                                      ORDER BY risk_probability DESC NULLS LAST,
                                                               prediction DESC NULLS LAST) = 1) r
                       ON r.id_student = c_custkey
                LEFT JOIN grades g ON g.id_student = c_custkey""",
    ),
    "compared": (
        ("profiles", "main"),
        """SELECT searched, metric, student, ROUND(average, 6) AS average
           FROM profiles, (SELECT AVG(engagement_index) AS a, AVG(total_clicks) AS b,
                                  AVG(days_active) AS c FROM main) means,
                LATERAL (VALUES ('Engagement', engagement_index, a),
                                ('Total Clicks', CAST(total_clicks AS DOUBLE), b),
                                ('Days Active', CAST(days_active AS DOUBLE), c))
                    AS rows(metric, student, average)""",
    ),
    "labelled": (
        ("enrolments", "engagement"),
        """SELECT id_student, total_clicks, days_active, engagement_index,
                  CASE WHEN final_result = 'F' THEN 1 ELSE 0 END AS label
           FROM engagement JOIN enrolments USING (id_student)""",
    ),
    "sided": (
        ("feature_rows",),
        """SELECT *, ('0x' || MD5('42:' || id_student)[1:7])::BIGINT / 268435456 < 0.8 AS train
           FROM feature_rows""",
    ),
    # Ridge regression on standardised columns: (correlations + penalty on the diagonal) * weights =
    # correlations with the label, solved by determinants.
    "moments": (
        ("sided",),
        """SELECT AVG(total_clicks) AS m1, AVG(days_active) AS m2, AVG(engagement_index) AS m3,
                  AVG(current_gpa) AS my,
                  STDDEV_POP(total_clicks) AS s1, STDDEV_POP(days_active) AS s2,
                  STDDEV_POP(engagement_index) AS s3, STDDEV_POP(current_gpa) AS sy,
                  CORR(total_clicks, days_active) AS r12,
                  CORR(total_clicks, engagement_index) AS r13,
                  CORR(days_active, engagement_index) AS r23,
                  CORR(total_clicks, current_gpa) AS c1, CORR(days_active, current_gpa) AS c2,
                  CORR(engagement_index, current_gpa) AS c3,
                  1 + CAST(0.1 AS DOUBLE) / STDDEV_POP(current_gpa) AS d
           FROM sided WHERE train""",
    ),
    "weights": (
        ("moments",),
        """SELECT *, (c1 * (d * d - r23 * r23) - r12 * (c2 * d - r23 * c3)
                      + r13 * (c2 * r23 - d * c3)) / det * sy / s1 AS w1,
                  (d * (c2 * d - r23 * c3) - c1 * (r12 * d - r23 * r13)
                      + r13 * (r12 * c3 - c2 * r13)) / det * sy / s2 AS w2,
                  (d * (d * c3 - c2 * r23) - r12 * (r12 * c3 - c2 * r13)
                      + c1 * (r12 * r23 - d * r13)) / det * sy / s3 AS w3
           FROM (SELECT *, d * (d * d - r23 * r23) - r12 * (r12 * d - r23 * r13)
                           + r13 * (r12 * r23 - d * r13) AS det FROM moments)""",
    ),
    "predicted": (
        ("weights", "sided"),
        """SELECT id_student, train, current_gpa,
                  my + w1 * (total_clicks - m1) + w2 * (days_active - m2)
                     + w3 * (engagement_index - m3) AS raw
           FROM sided, weights""",
    ),
}

GOOD_LIMITS = {"max_risk": "0.30", "min_grade": "70", "min_days": "5"}
EXCELLENT_LIMITS = {"max_risk": "0.20", "min_grade": "75", "min_days": "7"}


def _needed(name: str, done: list[str]) -> None:
    for before in TABLES[name][0]:
        _needed(before, done)
    if name not in done:
        done.append(name)


def over(tables: tuple[str, ...], body: str, limits: dict[str, str] = GOOD_LIMITS) -> str:
    """A query over common tables, which are put in front of it in order of need."""
    names: list[str] = []
    for name in tables:
        _needed(name, names)
    parts = ", ".join(f"{name} AS ({TABLES[name][1]})" for name in names)
    text = f"WITH {parts} {body}" if parts else body
    for place, value in limits.items():
        text = text.replace("{" + place + "}", value)
    return text


def _rank_sum(tables: tuple[str, ...], score: str) -> str:
    return over(
        tables,
        f"""SELECT ROUND(SUM(pos * (below + neg / 2)) / (SUM(pos) * SUM(neg)), 6) AS auc
            FROM (SELECT CAST(SUM(label) AS DOUBLE) AS pos,
                         CAST(SUM(1 - label) AS DOUBLE) AS neg,
                         CAST(COALESCE(SUM(SUM(1 - label)) OVER (
                             ORDER BY {score} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
                         ), 0) AS DOUBLE) AS below
                  FROM {tables[-1]} GROUP BY {score})""",
    )


def _cohort(by: str, columns: str, table: str) -> str:
    return f"SELECT {by}, {columns} FROM {table} GROUP BY {by}"


RISK_AVERAGES = """ROUND(AVG(CAST(risk_probability AS DOUBLE)), 6) AS avg_risk,
                   ROUND(AVG(engagement_index), 6) AS avg_engagement"""
GRADE_AVERAGES = """ROUND(AVG(predicted_gpa), 6) AS avg_predicted_gpa, COUNT(*) AS student_count"""
RISK_JOIN = "info JOIN risk USING (id_student) JOIN engagement USING (id_student)"
GRADE_JOIN = "info JOIN grades USING (id_student)"
RISK_TABLES = ("info", "risk", "engagement")
GRADE_TABLES = ("info", "grades")

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _harmonised(text: str) -> str:
    """The spelling rule for the spellings in the query, none of which is beyond 64 bits."""
    t = f"TRIM({text}, {BLANKS})"
    return f"""CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+')
                    THEN CAST(TRY_CAST({t} AS BIGINT) AS VARCHAR)
                    WHEN regexp_full_match({t}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
                         AND TRY_CAST({t} AS DOUBLE) = FLOOR(TRY_CAST({t} AS DOUBLE))
                    THEN CAST(CAST(TRY_CAST({t} AS DOUBLE) AS BIGINT) AS VARCHAR)
                    ELSE {t} END"""


def _clamped(value: str) -> str:
    return f"""CASE WHEN {value} < 0 THEN 0 WHEN {value} > 100 THEN 100
                    ELSE CAST({value} AS DOUBLE) END"""


SPELLINGS = {
    "from_number": "CAST(c_custkey AS VARCHAR)",
    "from_double": "CAST(CAST(c_custkey AS DOUBLE) AS VARCHAR)",
    "from_blanks": "' ' || chr(9) || c_custkey || ' ' || chr(10)",
    "from_decimal": "c_custkey || '.0'",
    "from_zeros": "'+000' || c_custkey",
    "from_exponent": "c_custkey || 'e2'",
    "from_long": "'900000000000' || c_custkey",
    "from_fraction": "c_custkey || '.5'",
    "from_suffix": "c_custkey || 'd'",
    "from_name": "' ' || c_name",
    "from_missing": "CAST(NULL AS VARCHAR)",
}

LIST_COLUMNS = "id_student, engagement_index, risk_probability"
GOOD_COLUMNS = """id_student, risk_probability, predicted_gpa, engagement_index, days_active,
                  total_clicks"""

KEY_FIGURES = over(
    ("main",),
    """SELECT COUNT(*) AS row_count, COUNT(DISTINCT id_student) AS distinct_students,
              ROUND(AVG(CAST(risk_probability AS DOUBLE)) * 100, 6) AS avg_risk_percent,
              ROUND(AVG(engagement_index), 6) AS avg_engagement,
              round_even(AVG(engagement_index), 2) AS avg_engagement_rounded,
              COUNT(*) FILTER (risk_probability > CAST(0.7 AS FLOAT)) AS high_risk_count
       FROM main""",
)

ORACLES: dict[str, str] = {
    "engagement_features": over(("engagement",), "SELECT * FROM engagement"),
    "engagement_top_users": over(
        ("engagement",),
        "SELECT * FROM engagement ORDER BY engagement_index DESC, id_student LIMIT 8",
    ),
    "clean_info": """
        SELECT o_orderkey, LOWER(o_orderpriority) AS gender, r_name AS region,
               chr(9) || c_mktsegment AS highest_education,
               COALESCE(GREATEST(NULLIF(CAST(ROUND(c_acctbal) AS INTEGER), c_nationkey * 100), 0), 0)
                   AS studied_credits,
               NULLIF(o_orderstatus, 'P') AS final_result
        FROM orders JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "clean_scores": f"""
        SELECT l_orderkey, l_linenumber, CAST({_clamped('score')} AS DOUBLE) AS score,
               COALESCE(NULLIF(CAST(l_quantity AS INTEGER), 1), -1) AS date_submitted
        FROM (SELECT *, NULLIF((l_extendedprice - 5000) / 900, 0) AS score FROM lineitem)""",
    "clean_text_scores": f"""
        SELECT l_orderkey, l_linenumber, CAST({_clamped('score')} AS DOUBLE) AS score
        FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN NULL
                             ELSE CAST(l_quantity * 3 - 20 AS INTEGER) END AS score FROM lineitem)""",
    "clean_weights": f"""
        SELECT p_partkey AS id_assessment, CAST({_clamped('p_size * 3 - 20')} AS DOUBLE) AS weight
        FROM part""",
    "clean_clicks": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN 0
                              ELSE GREATEST(CAST(ROUND(value * 100) AS BIGINT) - 500, 0) END
                         AS sum_click
        FROM events""",
    "harmonised_keys": "SELECT c_custkey, "
    + ", ".join(f"{_harmonised(text)} AS {name}" for name, text in SPELLINGS.items())
    + """, CAST(c_custkey AS DOUBLE) AS number_of_key, TRY_CAST(c_name AS DOUBLE) AS number_of_name
         FROM customer""",
    "outcome_labels": over(("labelled",), "SELECT * FROM labelled"),
    "weighted_grades": over(
        ("graded",), "SELECT id_student, ROUND(current_gpa, 8) AS current_gpa FROM graded"
    ),
    "weighted_grades_shuffled": over(
        ("graded",), "SELECT id_student, ROUND(current_gpa, 8) AS current_gpa FROM graded"
    ),
    "grade_features": over(
        ("feature_rows",),
        "SELECT * REPLACE (ROUND(current_gpa, 8) AS current_gpa) FROM feature_rows",
    ),
    "bounded_grades": over(("grades",), "SELECT * FROM grades"),
    "capped_count": over(
        ("grades",),
        "SELECT COUNT(*) FILTER (gpa_bounds_note <> 'within_range') AS n_capped FROM grades",
    ),
    "grade_bands": over(
        ("grades",),
        """SELECT id_student, CASE WHEN predicted_gpa < 50 THEN 'critical'
                                   WHEN predicted_gpa < 70 THEN 'borderline'
                                   ELSE 'excellent' END AS grade_band FROM grades""",
    ),
    "region_stats": over(
        RISK_TABLES, _cohort("region", RISK_AVERAGES + ", COUNT(*) AS student_count", RISK_JOIN)
    ),
    "education_stats": over(
        RISK_TABLES, _cohort("highest_education", RISK_AVERAGES, RISK_JOIN)
    ),
    "region_stats_once": over(
        RISK_TABLES,
        _cohort(
            "region",
            RISK_AVERAGES + ", COUNT(*) AS student_count",
            "(SELECT id_student, region, AVG(risk_probability) AS risk_probability, "
            "AVG(engagement_index) AS engagement_index FROM "
            + RISK_JOIN
            + " GROUP BY id_student, region)",
        ),
    ),
    "region_gpa_stats": over(
        GRADE_TABLES,
        _cohort("region", GRADE_AVERAGES, GRADE_JOIN) + " ORDER BY avg_predicted_gpa DESC",
    ),
    "education_gpa_stats": over(
        GRADE_TABLES,
        _cohort("highest_education", GRADE_AVERAGES, GRADE_JOIN)
        + " ORDER BY avg_predicted_gpa DESC",
    ),
    "student_main": over(("main",), "SELECT * FROM main"),
    "student_main_without_risk": over(
        ("engagement",),
        "SELECT *, 0 AS prediction, CAST(0 AS DOUBLE) AS risk_probability FROM engagement",
    ),
    "good_history_without_grades": over(
        ("main",), "SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS matching_rows FROM main"
    ),
    "risk_scores_separable": over(
        ("engagement", "enrolments"),
        """SELECT id_student, CASE WHEN total_interactions % 8 >= 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                      AS prediction,
                  CASE WHEN total_interactions % 8 >= 4 THEN 1.0::FLOAT ELSE 0.0::FLOAT END
                      AS risk_probability
           FROM engagement JOIN enrolments USING (id_student)""",
    ),
    "risk_auc_separable": "SELECT 1.0::DOUBLE AS auc FROM events LIMIT 1",
    "risk_scores": over(
        ("engagement", "enrolments"),
        """SELECT id_student, CASE WHEN total_interactions % 8 >= 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                      AS prediction,
                  CASE WHEN total_interactions % 8 >= 4 THEN 1.0::FLOAT ELSE 0.0::FLOAT END
                      AS risk_probability,
                  TRUE AS in_range, TRUE AS class_agrees
           FROM engagement JOIN enrolments USING (id_student)""",
    ),
    "risk_layouts": over(
        ("labelled",),
        """SELECT id_student, COUNT(*) AS scores_4, COUNT(*) AS scores_7, TRUE AS same_risk
           FROM labelled GROUP BY id_student""",
    ),
    "risk_auc": over(
        ("labelled",),
        """SELECT COUNT(*) AS held_out, CAST(SUM(label) AS BIGINT) AS positive, TRUE AS auc_in_range
           FROM labelled
           WHERE ('0x' || MD5('42:' || id_student)[1:7])::BIGINT / 268435456 >= 0.8""",
    ),
    "engagement_of_spellings": over(
        ("engagement",),
        "SELECT * REPLACE (CAST(id_student AS VARCHAR) AS id_student) FROM engagement",
    ),
    "student_lookup_text": over(
        ("profiles",), "SELECT * REPLACE ('S-12' AS searched) FROM profiles WHERE searched = '12'"
    ),
    "student_profiles_repeated": over(
        ("profiles",), "SELECT profiles.* FROM events JOIN profiles ON searched = CAST(user_id AS VARCHAR)"
    ),
    "rewritten_table": over(("engagement",), "SELECT * FROM engagement"),
    "written_codecs": """
        SELECT codec, COUNT(*) AS row_count, CAST(SUM(o_orderkey) AS BIGINT) AS key_sum
        FROM orders, (VALUES ('snappy'), ('zstd'), ('gz')) AS codecs(codec) GROUP BY codec""",
    "ranked_cohorts": over(
        GRADE_TABLES,
        f"""SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY avg_predicted_gpa DESC NULLS LAST, region)
                           AS INTEGER) AS place
            FROM ({_cohort("region", GRADE_AVERAGES, GRADE_JOIN)})""",
    ),
    "ingested_with_rejects": """
        SELECT l_partkey AS id_assessment, o_custkey AS id_student, 9 AS date_submitted,
               CAST(NULL AS DOUBLE) AS score
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_quantity % 10 <> 0 AND l_linenumber <> 3""",
    "ingest_report": """
        SELECT 'studentAssessment' AS raw_table, "column", rejected, lines, rejected AS listed
        FROM (SELECT COUNT(*) AS lines, COUNT(*) FILTER (l_quantity % 10 = 0) AS keys,
                     COUNT(*) FILTER (l_linenumber = 3) AS days
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
             LATERAL (VALUES ('id_assessment', 0), ('id_student', keys), ('date_submitted', days),
                             ('score', 0), ('_line', 0)) AS rows("column", rejected)""",
    "job_risk": over(
        ("engagement",),
        """SELECT id_student, CASE WHEN total_interactions % 8 >= 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                      AS prediction,
                  CASE WHEN total_interactions % 8 >= 4 THEN 1.0::FLOAT ELSE 0.0::FLOAT END
                      AS risk_probability
           FROM engagement""",
    ),
    "ingested_activity_text": over(
        ("activity",), "SELECT 'S-' || id_student AS id_student, id_site, date, sum_click FROM activity"
    ),
    "ingested_activity_inferred": over(
        ("activity",), "SELECT 'S-' || id_student AS id_student, id_site, date, sum_click FROM activity"
    ),
    "kpi_summary": KEY_FIGURES,
    "engagement_histogram": over(
        ("main",),
        """SELECT CAST(number AS INTEGER) AS bin, ROUND(low + number * width, 6) AS bin_start,
                  ROUND(low + (number + 1) * width, 6) AS bin_end, COUNT(bin) AS row_count
           FROM range(30) AS numbers(number)
                CROSS JOIN (SELECT MIN(engagement_index) AS low,
                                   (MAX(engagement_index) - MIN(engagement_index)) / 30 AS width
                            FROM main) AS ends
                LEFT JOIN (SELECT CAST(LEAST(FLOOR((engagement_index - first) / step), 29) AS INTEGER) AS bin
                           FROM main, (SELECT MIN(engagement_index) AS first,
                                              (MAX(engagement_index) - MIN(engagement_index)) / 30 AS step
                                       FROM main)) AS filled ON bin = number
           GROUP BY number, low, width""",
    ),
    "high_risk_list": over(
        ("main",),
        f"""SELECT {LIST_COLUMNS} FROM main WHERE risk_probability >= CAST(0.7 AS FLOAT)
            ORDER BY risk_probability DESC, id_student LIMIT 8""",
    ),
    "low_risk_list": over(
        ("main",),
        f"""SELECT {LIST_COLUMNS} FROM main WHERE risk_probability <= CAST(0.3 AS FLOAT)
            ORDER BY risk_probability, id_student LIMIT 8""",
    ),
    "good_history": over(("good",), f"SELECT {GOOD_COLUMNS} FROM good"),
    "good_history_excellent": over(
        ("good",), f"SELECT {GOOD_COLUMNS} FROM good", EXCELLENT_LIMITS
    ),
    "good_history_list": over(
        ("good",),
        f"""SELECT {GOOD_COLUMNS} FROM good
            ORDER BY risk_probability, predicted_gpa DESC, id_student LIMIT 100""",
    ),
    "good_history_count": over(("good",), "SELECT COUNT(*) AS matching_rows FROM good"),
    "student_profiles": over(("profiles",), "SELECT * FROM profiles"),
    "student_profiles_without_grades": over(
        ("profiles",),
        """SELECT * EXCLUDE (predicted_gpa, predicted_gpa_raw, gpa_bounds_note)
                  REPLACE (CASE WHEN lookup_status = 'found' THEN 'no_prediction' END AS grade_band,
                           CASE WHEN lookup_status = 'found' THEN 'grades_not_available' END
                               AS grade_status)
           FROM profiles""",
    ),
    "student_lookup": over(("profiles",), "SELECT * FROM profiles WHERE searched = '12'"),
    "student_vs_average": over(("compared",), "SELECT * FROM compared"),
    "job_overview": KEY_FIGURES,
    "job_profile": over(("compared",), "SELECT * FROM compared WHERE searched = '12'"),
    "student_inputs_long": over(
        ("profiles",),
        """SELECT searched, term, COALESCE(value, 0) AS value
           FROM profiles, LATERAL (VALUES
                    ('total_clicks', CAST(total_clicks AS DOUBLE), TRUE),
                    ('days_active', CAST(days_active AS DOUBLE), TRUE),
                    ('engagement_index', engagement_index, TRUE),
                    ('risk_probability', CAST(risk_probability AS DOUBLE), TRUE),
                    ('predicted_gpa', predicted_gpa, grade_status = 'graded'),
                    ('predicted_gpa_raw', predicted_gpa_raw, grade_status = 'graded'))
                AS rows(term, value, shown)
           WHERE lookup_status = 'found' AND shown""",
    ),
    "split_sides": over(
        ("info",),
        """SELECT id_student, final_result,
                  CASE WHEN ('0x' || MD5('42:' || id_student)[1:7])::BIGINT / 268435456 < 0.8
                       THEN 'train' ELSE 'held_out' END AS side FROM info""",
    ),
    "outcome_auc": _rank_sum(("labelled",), "engagement_index"),
    "risk_score_checks": over(
        ("labelled",),
        """SELECT COUNT(*) AS score_count, COUNT(DISTINCT id_student) AS students_with_one_risk,
                  CAST(0 AS BIGINT) AS outside_range, CAST(0 AS BIGINT) AS against_class
           FROM labelled""",
    ),
    "gpa_predictions": over(
        ("predicted",),
        """SELECT id_student, ROUND(LEAST(GREATEST(raw, 0), 100), 6) AS predicted_gpa,
                  ROUND(raw, 6) AS predicted_gpa_raw,
                  CASE WHEN raw < 0 THEN 'capped_to_0' WHEN raw > 100 THEN 'capped_to_100'
                       ELSE 'within_range' END AS gpa_bounds_note FROM predicted""",
    ),
    "gpa_rmse": over(
        ("predicted",),
        """SELECT ROUND(SQRT(AVG((current_gpa - raw) * (current_gpa - raw))), 6) AS rmse
           FROM predicted WHERE NOT train""",
    ),
    "ingested_info": over(
        ("info",),
        """SELECT id_student, gender, region, highest_education,
                  GREATEST(CAST(ROUND(studied_credits) AS INTEGER) - 1000, 0) AS studied_credits,
                  CASE WHEN final_result = 'F' THEN 'Fail' ELSE 'Pass' END AS final_result
           FROM info""",
    ),
    "ingested_submissions": """
        SELECT o_custkey AS id_student, l_partkey AS id_assessment,
               CASE WHEN o_custkey % 13 <> 0 THEN LEAST(l_extendedprice / 1000, 100) END AS score,
               -1 AS date_submitted
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "job_engagement": over(("engagement",), "SELECT * FROM engagement"),
    "job_cohorts": over(
        ("info", "risk", "engagement", "grades"),
        " UNION ALL ".join(
            f"""SELECT {by} AS cohort, measure, value
                FROM ({_cohort(by, averages, joined)}), LATERAL (VALUES {values})
                     AS rows(measure, value)"""
            for by in ("region", "highest_education")
            for averages, joined, values in (
                (
                    RISK_AVERAGES,
                    RISK_JOIN,
                    "('avg_risk', avg_risk), ('avg_engagement', avg_engagement)",
                ),
                (
                    GRADE_AVERAGES,
                    GRADE_JOIN,
                    "('avg_predicted_gpa', avg_predicted_gpa), "
                    "('student_count', CAST(student_count AS DOUBLE))",
                ),
            )
        ),
    ),
    "job_chain_gpa": over(
        ("info", "predicted"),
        """SELECT region, ROUND(AVG(LEAST(GREATEST(raw, 0), 100)), 6) AS avg_predicted_gpa,
                  COUNT(*) AS student_count
           FROM info JOIN predicted USING (id_student) GROUP BY region
           ORDER BY avg_predicted_gpa DESC""",
    ),
}
