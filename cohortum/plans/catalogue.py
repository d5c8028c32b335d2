"""Registered queries: every operator run over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum import fixed_values as fixed
from cohortum.functions.columns import grade_band
from cohortum.functions.keys import coerced_number, harmonise_key
from cohortum.operators import cohorts, engagement, grades, models, overview, profile, students
from cohortum.operators.cleaning import clean
from cohortum.operators.outcomes import outcome_rows
from cohortum.operators.split import in_training
from cohortum.plans import jobs
from cohortum.plans.roles import POSITIVE, Roles
from cohortum.sources.tables import (
    Layout,
    materialise,
    read_grades,
    read_risk,
    read_table,
    shared_folder,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def registered(query: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    """Enter the query in the catalogue under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(Roles(spark, folder))

    QUERIES[query.__name__] = run
    return query


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


# Features and cleaning.


@registered
def engagement_features(roles: Roles) -> DataFrame:
    return roles.engagement


@registered
def engagement_top_users(roles: Roles) -> DataFrame:
    return engagement.most_engaged(roles.engagement, fixed.LIST_LENGTH)


@registered
def engagement_of_spellings(roles: Roles) -> DataFrame:
    """The engagement job over an activity table with several spellings of every key."""
    layout = _layout(roles)
    write_table(_spelled(roles.activity, ""), layout, "studentVle")
    jobs.build_engagement(roles.spark, layout)
    return read_table(roles.spark, layout, fixed.ENGAGEMENT_TABLE)


@registered
def clean_info(roles: Roles) -> DataFrame:
    raw = (
        roles.table("orders")
        .join(roles.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(roles.places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("gender"),
            F.concat(F.lit(" "), "r_name", F.lit("   ")).alias("region"),
            F.concat(F.lit("\t"), "c_mktsegment", F.lit(" ")).alias("highest_education"),
            F.nullif(F.round("c_acctbal").cast("int"), F.col("c_nationkey") * 100).alias(
                "studied_credits"
            ),
            F.nullif("o_orderstatus", F.lit("P")).alias("final_result"),
        )
    )
    return clean("studentInfo", raw)


@registered
def clean_scores(roles: Roles) -> DataFrame:
    raw = roles.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif((F.col("l_extendedprice") - 5000) / 900, F.lit(0.0)).alias("score"),
        F.nullif(F.col("l_quantity").cast("int"), F.lit(1)).alias("date_submitted"),
    )
    return clean("studentAssessment", raw)


@registered
def clean_text_scores(roles: Roles) -> DataFrame:
    text = F.when(F.col("l_returnflag") == "R", F.lit("?")).otherwise(
        (F.col("l_quantity") * 3 - 20).cast("int").cast("string")
    )
    raw = roles.table("lineitem").select("l_orderkey", "l_linenumber", text.alias("score"))
    return clean("studentAssessment", raw)


@registered
def clean_weights(roles: Roles) -> DataFrame:
    raw = roles.table("part").select(
        F.col("p_partkey").alias("id_assessment"), (F.col("p_size") * 3 - 20).alias("weight")
    )
    return clean("assessments", raw)


@registered
def clean_clicks(roles: Roles) -> DataFrame:
    shifted = F.round(F.col("value") * 100).cast("bigint") - 500
    raw = roles.table("events").select(
        "event_id",
        F.when(F.col("event_type") != "error", shifted).alias("sum_click"),
    )
    return clean("studentVle", raw)


@registered
def harmonised_keys(roles: Roles) -> DataFrame:
    plain = F.col("c_custkey").cast("string")
    spellings = {
        "from_number": F.col("c_custkey"),
        "from_double": F.col("c_custkey").cast("double"),
        "from_blanks": F.concat(F.lit(" \t"), plain, F.lit(" \n")),
        "from_decimal": F.concat(plain, F.lit(".0")),
        "from_zeros": F.concat(F.lit("+000"), plain),
        "from_exponent": F.concat(plain, F.lit("e2")),
        "from_long": F.concat(F.lit("900000000000"), plain),
        "from_fraction": F.concat(plain, F.lit(".5")),
        "from_suffix": F.concat(plain, F.lit("d")),
        "from_name": F.concat(F.lit(" "), "c_name"),
        "from_missing": F.nullif(plain, plain),
    }
    numbers = {
        "number_of_key": coerced_number(plain),
        "number_of_name": coerced_number(F.col("c_name")),
    }
    return roles.table("customer").select(
        "c_custkey",
        *(harmonise_key(value).alias(name) for name, value in spellings.items()),
        *(value.alias(name) for name, value in numbers.items()),
    )


# Labels and grades.


@registered
def outcome_labels(roles: Roles) -> DataFrame:
    return outcome_rows(roles.stored_engagement, roles.enrolments, positive=POSITIVE)


@registered
def weighted_grades(roles: Roles) -> DataFrame:
    return rounded(
        grades.weighted_grades(roles.submissions, roles.assessments), 8, "current_gpa"
    )


@registered
def weighted_grades_shuffled(roles: Roles) -> DataFrame:
    """The join that Spark takes for assessments too many to broadcast."""
    wide = grades.weighted_grades(roles.submissions, roles.assessments.hint("merge"))
    return rounded(wide, 8, "current_gpa")


@registered
def grade_features(roles: Roles) -> DataFrame:
    rows = grades.grade_rows(
        grades.weighted_grades(roles.submissions, roles.assessments), roles.engagement
    )
    return rounded(rows, 8, "current_gpa")


@registered
def bounded_grades(roles: Roles) -> DataFrame:
    return roles.grades


@registered
def capped_count(roles: Roles) -> DataFrame:
    return grades.capped_count(roles.grades)


@registered
def grade_bands(roles: Roles) -> DataFrame:
    return roles.grades.select(
        "id_student", grade_band(F.col("predicted_gpa")).alias("grade_band")
    )


# Cohorts.


def _risk_stats(roles: Roles, by: str, count_as: str | None, once: bool = False) -> DataFrame:
    stats = cohorts.cohort_stats(
        roles.info,
        by,
        cohorts.risk_measures(roles.risk, roles.stored_engagement),
        count_as,
        once_per_student=once,
    )
    return rounded(stats, 6, "avg_risk", "avg_engagement")


def _grade_stats(roles: Roles, by: str) -> DataFrame:
    stats = cohorts.cohort_stats(
        roles.info, by, cohorts.grade_measures(roles.grades), "student_count"
    )
    return rounded(cohorts.ranked(stats, by), 6, "avg_predicted_gpa")


@registered
def region_stats(roles: Roles) -> DataFrame:
    return _risk_stats(roles, "region", "student_count")


@registered
def education_stats(roles: Roles) -> DataFrame:
    return _risk_stats(roles, "highest_education", None)


@registered
def region_stats_once(roles: Roles) -> DataFrame:
    return _risk_stats(roles, "region", "student_count", once=True)


@registered
def region_gpa_stats(roles: Roles) -> DataFrame:
    return _grade_stats(roles, "region")


@registered
def education_gpa_stats(roles: Roles) -> DataFrame:
    return _grade_stats(roles, "highest_education")


# Overview.


@registered
def student_main(roles: Roles) -> DataFrame:
    return students.student_rows(roles.stored_engagement, roles.risk)


@registered
def student_main_without_risk(roles: Roles) -> DataFrame:
    """No risk table has been written beside the test tables, so the default is used."""
    layout = Layout(roles.folder, roles.folder)
    return students.student_rows(
        roles.engagement, read_risk(roles.spark, layout, fixed.RISK_TABLE)
    )


@registered
def good_history_without_grades(roles: Roles) -> DataFrame:
    """Without a grade table no row meets the limits, out of all rows of the view."""
    layout = Layout(roles.folder, roles.folder)
    absent = read_grades(roles.spark, layout, fixed.GRADE_TABLE)
    matches = overview.good_history_count(roles.stored_engagement, roles.risk, absent)
    figures = overview.key_figures(roles.stored_engagement, roles.risk)
    return figures.select("row_count", matches.scalar().alias("matching_rows"))


@registered
def kpi_summary(roles: Roles) -> DataFrame:
    figures = overview.key_figures(roles.stored_engagement, roles.risk)
    return rounded(figures, 6, "avg_risk_percent", "avg_engagement")


@registered
def engagement_histogram(roles: Roles) -> DataFrame:
    rows = students.with_copies(roles.stored_engagement, roles.risk)
    bins = overview.histogram(rows, "engagement_index", copies="copies")
    return rounded(bins, 6, "bin_start", "bin_end")


@registered
def high_risk_list(roles: Roles) -> DataFrame:
    return overview.high_risk_list(roles.stored_engagement, roles.risk)


@registered
def low_risk_list(roles: Roles) -> DataFrame:
    return overview.low_risk_list(roles.stored_engagement, roles.risk)


@registered
def good_history(roles: Roles) -> DataFrame:
    return overview.good_history(roles.stored_engagement, roles.risk, roles.grades, ordered=True)


@registered
def good_history_excellent(roles: Roles) -> DataFrame:
    return overview.good_history(
        roles.stored_engagement, roles.risk, roles.grades, fixed.EXCELLENT_HISTORY
    )


@registered
def good_history_list(roles: Roles) -> DataFrame:
    return overview.good_history_list(roles.stored_engagement, roles.risk, roles.grades)


@registered
def good_history_count(roles: Roles) -> DataFrame:
    return overview.good_history_count(roles.stored_engagement, roles.risk, roles.grades)


# Single students.


def _profiles(roles: Roles) -> DataFrame:
    """A request for every customer, spelled with zeros in front and a decimal behind."""
    key = F.col("c_custkey").cast("string")
    requests = roles.table("customer").select(
        F.concat(F.lit(" 00"), key, F.lit(".0 ")).alias("search")
    )
    return profile.student_profiles(requests, roles.stored_engagement, roles.risk, roles.grades)


@registered
def student_profiles(roles: Roles) -> DataFrame:
    return _profiles(roles)


@registered
def student_profiles_without_grades(roles: Roles) -> DataFrame:
    """The grade table has not been written beside the test tables."""
    layout = Layout(roles.folder, roles.folder)
    absent = read_grades(roles.spark, layout, fixed.GRADE_TABLE)
    requests = roles.table("customer").select(F.col("c_custkey").cast("string").alias("search"))
    return profile.student_profiles(
        requests, roles.stored_engagement, roles.risk, absent
    ).drop("predicted_gpa", "predicted_gpa_raw", "gpa_bounds_note")


@registered
def student_lookup(roles: Roles) -> DataFrame:
    return profile.student_lookup(" 012.0 ", roles.stored_engagement, roles.risk, roles.grades)


@registered
def student_lookup_text(roles: Roles) -> DataFrame:
    """The lookup job over tables whose keys are text in many spellings, stored in one."""
    layout = _layout(roles)
    for name, frame in _student_tables(roles).items():
        jobs.store_by_student(_spelled(frame, "S-"), layout, name)
    jobs.build_averages(roles.spark, layout)
    return jobs.profile_view(roles.spark, layout, " S-12\t").profile


@registered
def student_profiles_repeated(roles: Roles) -> DataFrame:
    """A request for every event, so that students are asked for very often."""
    requests = roles.table("events").select(F.col("user_id").cast("string").alias("search"))
    return profile.student_profiles(requests, roles.stored_engagement, roles.risk, roles.grades)


@registered
def student_vs_average(roles: Roles) -> DataFrame:
    rows = profile.compared_with_average(
        _profiles(roles),
        profile.averages(students.with_copies(roles.stored_engagement, roles.risk), "copies"),
    )
    return rounded(rows, 6, "average")


@registered
def student_inputs_long(roles: Roles) -> DataFrame:
    return profile.model_inputs(_profiles(roles))


# Learning.


@registered
def split_sides(roles: Roles) -> DataFrame:
    side = F.when(in_training("id_student"), "train").otherwise("held_out")
    return roles.info.select("id_student", "final_result", side.alias("side"))


@registered
def outcome_auc(roles: Roles) -> DataFrame:
    """How well engagement alone ranks the outcomes: the evaluation step on an exact score."""
    rows = outcome_rows(roles.stored_engagement, roles.enrolments, positive=POSITIVE)
    area = models.area_under_roc(rows, "engagement_index")
    return _one_row(roles, auc=area)


def _separable(roles: Roles) -> DataFrame:
    """Features of which each alone decides the label: any forest that learns gets all right."""
    eighth = F.pmod("total_interactions", F.lit(8))
    kinds = dict(roles.engagement.dtypes)
    return materialise(
        roles.engagement.select("id_student", *(eighth.cast(kinds[name]).alias(name) for name in fixed.FEATURES))
    )


def _separable_model(features: DataFrame) -> models.Fitted:
    return models.fit_risk(features.withColumn("label", (F.col("days_active") >= 4).cast("int")))


@registered
def risk_scores_separable(roles: Roles) -> DataFrame:
    features = _separable(roles)
    return models.risk_scores(_separable_model(features).model, features, roles.enrolments)


@registered
def risk_auc_separable(roles: Roles) -> DataFrame:
    return _one_row(roles, auc=_separable_model(_separable(roles)).quality)


def _outcomes(roles: Roles) -> DataFrame:
    return outcome_rows(roles.stored_engagement, roles.enrolments, positive=POSITIVE)


@registered
def risk_scores(roles: Roles) -> DataFrame:
    """Scores of every enrolment by two forests: of one fitted to a label that the features decide,
    the scores themselves; of one fitted to the outcomes, what holds for any of them."""
    features = _separable(roles)
    decided = models.risk_scores(
        _separable_model(features).model, features, features.select("id_student")
    )
    model = models.fit_risk(_outcomes(roles)).model
    risk = F.col("risk_probability")
    checked = models.risk_scores(model, roles.stored_engagement, roles.enrolments).select(
        "id_student",
        risk.between(0, 1).alias("in_range"),
        ((risk > 0.5) == (F.col("prediction") == 1)).alias("class_agrees"),
    )
    # A row for each student on one side.
    return decided.join(checked, "id_student")


@registered
def risk_layouts(roles: Roles) -> DataFrame:
    """Forests fitted to the same outcomes in 4 and in 7 partitions: whether they score alike."""
    one, other = (
        models.risk_scores(
            models.fit_risk(_outcomes(roles).repartition(parts), trees=20).model,
            roles.stored_engagement, roles.enrolments,
        )
        .groupBy("id_student")
        .agg(F.count(F.lit(1)).alias(f"scores_{parts}"), F.max("risk_probability").alias(f"risk_{parts}"))
        for parts in (4, 7)
    )
    return one.join(other, "id_student").select(
        "id_student", "scores_4", "scores_7", (F.col("risk_4") == F.col("risk_7")).alias("same_risk")
    )


@registered
def risk_auc(roles: Roles) -> DataFrame:
    """The area over the held-out outcomes of a forest fitted to the others, and over how many."""
    rows = _outcomes(roles)
    area = models.fit_risk(rows, trees=20).quality
    held_out = rows.where(~in_training("id_student"))
    return held_out.agg(
        F.count(F.lit(1)).alias("held_out"),
        F.sum(F.col("label").cast("bigint")).alias("positive"),
        F.lit(0 <= area <= 1).alias("auc_in_range"),
    )


@registered
def risk_score_checks(roles: Roles) -> DataFrame:
    """What holds for the scores of any forest: their number, their range, one per student, and a
    class that agrees with the risk."""
    engagement, info = roles.stored_engagement, roles.enrolments
    fitted = models.fit_risk(outcome_rows(engagement, info, positive=POSITIVE))
    risk = F.col("risk_probability")
    per_student = (
        models.risk_scores(fitted.model, engagement, info)
        .groupBy("id_student")
        .agg(
            F.count(F.lit(1)).alias("scores"),
            (F.min(risk) == F.max(risk)).alias("one_risk"),
            F.count_if((risk < 0) | (risk > 1)).alias("outside"),
            F.count_if((risk > 0.5) != (F.col("prediction") == 1)).alias("against"),
        )
    )
    return per_student.agg(
        F.sum("scores").alias("score_count"),
        F.count_if("one_risk").alias("students_with_one_risk"),
        F.sum("outside").alias("outside_range"),
        F.sum("against").alias("against_class"),
    )


def _grade_rows(roles: Roles) -> DataFrame:
    return grades.grade_rows(
        grades.weighted_grades(roles.submissions, roles.assessments), roles.engagement
    )


@registered
def gpa_predictions(roles: Roles) -> DataFrame:
    rows = materialise(_grade_rows(roles))
    predictions = models.grade_predictions(models.fit_grades(rows).model, rows)
    return rounded(predictions, 6, "predicted_gpa", "predicted_gpa_raw")


@registered
def gpa_rmse(roles: Roles) -> DataFrame:
    return _one_row(roles, rmse=models.fit_grades(_grade_rows(roles)).quality)


# Sources, sinks and jobs.


def _layout(roles: Roles) -> Layout:
    root = shared_folder(roles.spark)
    return Layout(f"{root}/raw", f"{root}/processed")


def _spelled(frame: DataFrame, before: str) -> DataFrame:
    """The same rows with keys as text, in three spellings of each key."""
    key = F.concat(F.lit(before), F.col("id_student").cast("string"))
    other = F.when(F.lit(bool(before)), F.concat(key, F.lit("\n"))).otherwise(F.concat(F.lit("0"), key, F.lit(".0")))
    spelling = F.pmod(F.xxhash64(*frame.columns), F.lit(3))
    text = F.when(spelling == 0, key).when(spelling == 1, F.concat(F.lit(" "), key, F.lit(" "))).otherwise(other)
    return frame.withColumn("id_student", text)


def _student_tables(roles: Roles) -> dict[str, DataFrame]:
    return {
        fixed.ENGAGEMENT_TABLE: roles.stored_engagement,
        fixed.RISK_TABLE: roles.risk,
        fixed.GRADE_TABLE: roles.grades,
    }


def _bad_submissions(roles: Roles) -> Layout:
    """A raw table in which some keys and days are no numbers."""
    layout = _layout(roles)
    lines = roles.table("lineitem").join(roles.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines.select(
        F.col("l_partkey").alias("id_assessment"),
        F.when(F.col("l_quantity") % 10 == 0, F.concat(F.lit("x"), "o_custkey")).otherwise(
            F.col("o_custkey").cast("string")
        ).alias("id_student"),
        F.when(F.col("l_linenumber") == 3, F.lit("soon")).otherwise(F.lit("9")).alias("date_submitted"),
        F.lit("?").alias("score"),
    ).write.csv(layout.raw("studentAssessment"), header=True)
    return layout


@registered
def ingested_with_rejects(roles: Roles) -> DataFrame:
    """The good rows of a raw table with bad ones."""
    layout = _bad_submissions(roles)
    jobs.ingest(roles.spark, layout, ["studentAssessment"], most_rejected=1 << 40)
    return read_table(roles.spark, layout, "studentAssessment")


@registered
def ingest_report(roles: Roles) -> DataFrame:
    """How many texts of each column were rejected, in the report and in the list of lines."""
    layout = _bad_submissions(roles)
    jobs.ingest(roles.spark, layout, ["studentAssessment"], most_rejected=1 << 40)
    listed = read_table(roles.spark, layout, fixed.REJECTED_TABLE).groupBy("raw_table", "column").agg(
        F.count(F.lit(1)).alias("listed")
    )
    return (
        read_table(roles.spark, layout, fixed.REPORT_TABLE)
        .join(F.broadcast(listed), ["raw_table", "column"], "left")
        .select("raw_table", "column", "rejected", "lines", F.coalesce("listed", F.lit(0)).alias("listed"))
    )


@registered
def rewritten_table(roles: Roles) -> DataFrame:
    """A table after one rewrite that was published and one that failed half-way."""
    layout = _layout(roles)
    write_table(roles.table("region"), layout, fixed.ENGAGEMENT_TABLE)
    write_table(roles.stored_engagement, layout, fixed.ENGAGEMENT_TABLE)
    failing = roles.activity.withColumn("total_clicks", F.when(F.col("sum_click") > 0, F.raise_error(F.lit("stop"))))
    try:
        write_table(failing, layout, fixed.ENGAGEMENT_TABLE)
    except (Py4JJavaError, PySparkException):
        return read_table(roles.spark, layout, fixed.ENGAGEMENT_TABLE)
    raise AssertionError("the rewrite did not fail")


@registered
def written_codecs(roles: Roles) -> DataFrame:
    """Tables written with each codec and read back: the codec their files name, and their rows."""
    layout, parts = _layout(roles), []
    for codec in ("snappy", "zstd", "gzip"):
        write_table(roles.table("orders"), layout, codec, compression=codec)
        name = F.regexp_extract(F.input_file_name(), r"\.([a-z0-9]+)\.parquet$", 1)
        parts.append(
            read_table(roles.spark, layout, codec).groupBy(name.alias("codec")).agg(
                F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
            )
        )
    return reduce(DataFrame.unionByName, parts)


@registered
def ranked_cohorts(roles: Roles) -> DataFrame:
    """The places of the regions by grade, as the institutional view lists them."""
    stats = cohorts.cohort_stats(roles.info, "region", cohorts.grade_measures(roles.grades), "student_count")
    placed = cohorts.ranked(stats, "region", place_as="place")
    return materialise(rounded(placed, 6, "avg_predicted_gpa"))


def _raw_files(roles: Roles, *names: str) -> Layout:
    """Write the named learner tables as raw CSV files to the shared folder."""
    root = shared_folder(roles.spark)
    layout = Layout(f"{root}/raw", f"{root}/processed")
    frames = {
        "studentVle": roles.activity.withColumn("id_site", F.length("id_site")),
        "studentInfo": roles.info.withColumns(
            {
                "region": F.concat(F.lit("  "), "region"),
                "studied_credits": F.round("studied_credits").cast("int") - 1000,
                "final_result": F.when(F.col("final_result") == "F", "Fail").otherwise("Pass"),
            }
        ),
        "vle": roles.table("events").select(F.col("event_type").alias("id_site")).distinct(),
        "studentAssessment": roles.submissions.withColumn(
            "date_submitted", F.lit(None).cast("int")
        ),
        "assessments": roles.assessments,
    }
    for name in names:
        # Leading blanks are the point of the cleaning step, so the writer must not drop them.
        frames[name].write.csv(layout.raw(name), header=True, ignoreLeadingWhiteSpace=False)
    return layout


DAY_TYPES = {"studentVle": {"date": T.DateType()}, "vle": {"id_site": T.StringType()}}


@registered
def ingested_info(roles: Roles) -> DataFrame:
    layout = _raw_files(roles, "studentInfo")
    jobs.ingest(roles.spark, layout, ["studentInfo"])
    return read_table(roles.spark, layout, "studentInfo")


@registered
def ingested_submissions(roles: Roles) -> DataFrame:
    layout = _raw_files(roles, "studentAssessment")
    jobs.ingest(roles.spark, layout, ["studentAssessment"])
    return read_table(roles.spark, layout, "studentAssessment")


@registered
def ingested_activity_text(roles: Roles) -> DataFrame:
    """Identifiers that are text and calendar days, kept through ingest by stated types."""
    layout = _raw_files(roles)
    roles.activity.withColumn("id_student", F.concat(F.lit("S-"), "id_student")).write.csv(
        layout.raw("studentVle"), header=True
    )
    types = {"id_student": "string", "id_site": "string", "date": "date"}
    jobs.ingest(roles.spark, layout, ["studentVle"], {"studentVle": types})
    return read_table(roles.spark, layout, "studentVle")


@registered
def ingested_activity_inferred(roles: Roles) -> DataFrame:
    """The same table with the types that Spark finds."""
    layout = _raw_files(roles)
    roles.activity.withColumn("id_student", F.concat(F.lit("S-"), "id_student")).write.csv(
        layout.raw("studentVle"), header=True
    )
    jobs.ingest(roles.spark, layout, ["studentVle"], infer=True)
    stored = read_table(roles.spark, layout, "studentVle")
    return stored.withColumn("sum_click", F.col("sum_click").cast("bigint"))


@registered
def job_risk(roles: Roles) -> DataFrame:
    """The risk job on written tables whose features decide the outcome: the table it writes."""
    layout = Layout(*[f"{shared_folder(roles.spark)}/{part}" for part in ("raw", "processed")])
    features = _separable(roles)
    outcome = F.when(F.pmod("total_interactions", F.lit(8)) >= 4, "Fail").otherwise("Pass")
    write_table(features.withColumn("total_interactions", F.lit(0)), layout, fixed.ENGAGEMENT_TABLE)
    write_table(roles.engagement.select("id_student", outcome.alias("final_result")), layout, "studentInfo")
    jobs.build_risk(roles.spark, layout)
    return read_table(roles.spark, layout, fixed.RISK_TABLE)


@registered
def job_engagement(roles: Roles) -> DataFrame:
    layout = _raw_files(roles, "studentVle")
    jobs.ingest(roles.spark, layout, ["studentVle"], DAY_TYPES)
    jobs.build_engagement(roles.spark, layout)
    return read_table(roles.spark, layout, fixed.ENGAGEMENT_TABLE)


def _written(roles: Roles) -> Layout:
    """Write the tables that the later jobs start from."""
    root = shared_folder(roles.spark)
    layout = Layout(f"{root}/raw", f"{root}/processed")
    for name, frame in {
        "studentInfo": roles.info,
        fixed.ENGAGEMENT_TABLE: roles.stored_engagement,
        fixed.RISK_TABLE: roles.risk,
        fixed.GRADE_TABLE: roles.grades,
    }.items():
        write_table(frame, layout, name)
    return layout


@registered
def job_cohorts(roles: Roles) -> DataFrame:
    """All four cohort tables of the job, one below the other."""
    layout = _written(roles)
    jobs.build_cohorts(roles.spark, layout)
    names = {"region": "region", "education": "highest_education"}
    parts = []
    for kind, by in names.items():
        risk = read_table(roles.spark, layout, f"{kind}_stats")
        grade = read_table(roles.spark, layout, f"{kind}_gpa_stats")
        for measure, frame in (
            ("avg_risk", risk),
            ("avg_engagement", risk),
            ("avg_predicted_gpa", grade),
            ("student_count", grade),
        ):
            parts.append(
                frame.select(
                    F.col(by).alias("cohort"),
                    F.lit(measure).alias("measure"),
                    F.round(F.col(measure).cast("double"), 6).alias("value"),
                )
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@registered
def job_overview(roles: Roles) -> DataFrame:
    """The overview job on written tables: its key figures."""
    figures = jobs.overview_view(roles.spark, _written(roles)).figures
    return rounded(figures, 6, "avg_risk_percent", "avg_engagement")


@registered
def job_profile(roles: Roles) -> DataFrame:
    """The lookup job on written tables: comparison of one student with the average."""
    layout = _written(roles)
    jobs.build_averages(roles.spark, layout)
    view = jobs.profile_view(roles.spark, layout, "12")
    return rounded(view.comparison, 6, "average")


@registered
def job_chain_gpa(roles: Roles) -> DataFrame:
    """From raw CSV through every job up to the grade statistics."""
    spark, layout = roles.spark, _raw_files(roles, *fixed.RAW_TABLES)
    jobs.ingest(spark, layout, types=DAY_TYPES)
    jobs.build_engagement(spark, layout)
    jobs.build_risk(spark, layout)
    jobs.build_grades(spark, layout)
    jobs.build_cohorts(spark, layout)
    stats = jobs.institution_view(spark, layout).region_grades
    return rounded(stats, 6, "avg_predicted_gpa")


def _one_row(roles: Roles, **values: float) -> DataFrame:
    return roles.spark.range(1).select(
        *(F.round(F.lit(value), 6).alias(name) for name, value in values.items())
    )
