"""Queries on single students: lookup, comparison with the average, model inputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed
from cohortum.functions.columns import grade_band
from cohortum.functions.keys import (
    coerced_number,
    harmonise_key,
    is_whole_number,
    same_key,
    with_joinable_keys,
)
from cohortum.operators.students import risk_or_default


def first_score(risk: DataFrame) -> DataFrame:
    """One row per student: the score with the highest risk, of equal ones that with the class 1.

    The maximum is found in the map tasks first, so a student with very many scores is never
    sorted or gathered in one place.
    """
    best = F.max(F.struct("risk_probability", "prediction"))
    return risk.groupBy("id_student").agg(best.alias("_score")).select(
        "id_student", "_score.risk_probability", "_score.prediction"
    )


def first_grade(grades: DataFrame) -> DataFrame:
    """One row per student: the predicted grade, with defaults for columns the table lacks."""
    bounded = coerced_number(F.col("predicted_gpa"))
    raw = F.col("predicted_gpa_raw") if "predicted_gpa_raw" in grades.columns else bounded
    note = (
        F.col("gpa_bounds_note") if "gpa_bounds_note" in grades.columns else F.lit(fixed.WITHIN)
    )
    best = F.max(
        F.struct(
            bounded.alias("predicted_gpa"),
            coerced_number(raw).alias("predicted_gpa_raw"),
            note.alias("gpa_bounds_note"),
        )
    )
    return (
        grades.groupBy("id_student")
        .agg(best.alias("_best"))
        .select("id_student", F.lit(True).alias("_graded"), "_best.*")
    )


def known_students(
    engagement: DataFrame, risk: DataFrame | None, grades: DataFrame | None
) -> DataFrame:
    """One row per student with activity: engagement, first score, first grade and its status.

    ``grade_status`` is ``graded``, ``no_grade_for_student`` or ``grades_not_available``.
    """
    tables = [engagement, risk_or_default(engagement, risk)]
    tables += [grades] if grades is not None else []
    tables = list(with_joinable_keys("id_student", *tables))
    scored = tables[0].join(first_score(tables[1]), "id_student", "left")
    if grades is None:
        return scored.withColumns(
            {
                "predicted_gpa": F.lit(None).cast("double"),
                "predicted_gpa_raw": F.lit(None).cast("double"),
                "gpa_bounds_note": F.lit(None).cast("string"),
                "grade_status": F.lit("grades_not_available"),
            }
        )
    status = F.when(F.col("_graded"), "graded").otherwise("no_grade_for_student")
    return scored.join(first_grade(tables[2]), "id_student", "left").withColumn(
        "grade_status", status
    )


def _shown(students: DataFrame) -> DataFrame:
    """What is shown of students that may be unknown, in which case ``grade_status`` is null."""
    known = F.col("grade_status").isNotNull()
    return students.select(
        "searched",
        F.when(known, "found").otherwise("no_such_student").alias("lookup_status"),
        "risk_probability",
        "prediction",
        "engagement_index",
        F.bround("engagement_index", 2).alias("engagement_shown"),
        "total_clicks",
        F.col("total_clicks").cast("bigint").alias("clicks_shown"),
        "days_active",
        "predicted_gpa",
        "predicted_gpa_raw",
        "gpa_bounds_note",
        F.when(known, grade_band(F.col("predicted_gpa"))).alias("grade_band"),
        "grade_status",
    )


def student_profiles(
    requests: DataFrame,
    engagement: DataFrame,
    risk: DataFrame | None,
    grades: DataFrame | None,
    search: str = "search",
) -> DataFrame:
    """One row per request in the text column ``search``; blank requests give none.

    ``lookup_status`` is ``found`` or ``no_such_student``.
    """
    students = known_students(engagement, risk, grades)
    text = harmonise_key(F.col(search))
    whole = is_whole_number(students, "id_student")
    key = text.try_cast(students.schema["id_student"].dataType) if whole else text
    asked = requests.where(text != "").groupBy(text.alias("searched"), key.alias("id_student"))
    # A request made very often is joined once and repeated afterwards.
    found = asked.agg(F.count(F.lit(1)).alias("_times")).join(students, "id_student", "left")
    return _shown(repeated(found, "_times"))


def repeated(rows: DataFrame, times: str, most: int = 10_000) -> DataFrame:
    """Every row as often as its column ``times`` says, which may be far beyond an array's size.

    Copies are made in two steps of up to ``most``, after a first one that is 1 up to ``most``
    squared copies. What the second step makes is dealt over all partitions before the last, so
    that the copies of one row neither need a large array nor come out of a single task.
    """
    def blocks(of: Column, size: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((of - 1) / F.lit(size)).cast("bigint")))

    def left(of: str, block: str, size: int) -> Column:
        return F.least(F.lit(size).cast("bigint"), F.col(of) - F.col(block) * size)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = rows.where(F.col(times) > 0).withColumn("_large", blocks(F.col(times), most * most))
    large = large.withColumn("_in_large", left(times, "_large", most * most))
    small = large.withColumn("_small", blocks(F.col("_in_large"), most))
    # A stated number of partitions is not merged by adaptive execution.
    dealt = small.repartition(parts, F.xxhash64(*rows.columns), "_large", "_small")
    return dealt.withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(True), left("_in_large", "_small", most).cast("int")))
    ).select(*rows.columns)


def student_lookup(
    search: str,
    engagement: DataFrame,
    risk: DataFrame | None,
    grades: DataFrame | None,
) -> DataFrame:
    """The profile of one student, searched by any spelling of the key.

    The key is compared with the stored column of each table, so the scans skip what cannot match.
    """

    def only(table: DataFrame | None) -> DataFrame | None:
        if table is None:
            return None
        return table.where(same_key(table, "id_student", F.lit(search)))

    students = known_students(only(engagement), only(risk), only(grades))
    # An aggregate without grouping gives a row even where nothing was found.
    first = students.agg(F.max(F.struct(*students.columns)).alias("_first"))
    searched = harmonise_key(F.lit(search)).alias("searched")
    return _shown(first.where(harmonise_key(F.lit(search)) != "").select(searched, "_first.*"))


def averages(
    population: DataFrame, copies: str | None = None, compared: Mapping[str, str] = fixed.COMPARED
) -> DataFrame:
    """The overall means of the compared columns, as one row.

    ``copies`` names the column of ``population`` that says how often a row counts.
    """
    weight = F.col(copies) if copies else F.lit(1)

    def mean(column: str) -> Column:
        value = F.col(column).cast("double")
        return F.try_divide(
            F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight))
        ).alias(column)

    return population.agg(*map(mean, compared.values()))


def compared_with_average(
    profiles: DataFrame,
    means: DataFrame,
    compared: Mapping[str, str] = fixed.COMPARED,
    key: str = "searched",
) -> DataFrame:
    """Per student one row for each compared metric: the student's value and the overall mean.

    ``means`` is one row, made by :func:`averages`, and put in as constants.
    """
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(column).cast("double").alias("student"),
            F.col("_means").getField(column).alias("average"),
        )
        for metric, column in compared.items()
    ]
    return profiles.withColumn("_means", means.select(F.struct(*compared.values())).scalar()).select(key, F.inline(F.array(*rows)))


def model_inputs(profiles: DataFrame, key: str = "searched") -> DataFrame:
    """What the models knew about each student found, as rows of term and value.

    Missing values are 0. The two grade terms appear only for a student with a predicted grade;
    without a raw prediction the bounded one is shown for it.
    """
    always = [*fixed.FEATURES, "risk_probability"]
    bounded = F.col("predicted_gpa")

    def term(name: str, value: Column) -> Column:
        number = F.coalesce(value.cast("double"), F.lit(0.0))
        return F.struct(F.lit(name).alias("term"), number.alias("value"))

    first = F.array(*(term(name, F.col(name)) for name in always))
    then = F.array(
        term("predicted_gpa", bounded),
        term("predicted_gpa_raw", F.coalesce("predicted_gpa_raw", bounded)),
    )
    terms = F.when(F.col("grade_status") == "graded", F.concat(first, then)).otherwise(first)
    return profiles.where(F.col("lookup_status") == "found").select(key, F.inline(terms))
