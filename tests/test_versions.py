"""Rewrites that fail or are stopped, raw tables with bad lines, lookups by text keys."""

from __future__ import annotations

import os
import threading
import time

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed
from cohortum.functions.keys import is_harmonised, with_harmonised_key
from cohortum.operators import profile
from cohortum.operators.models import area_under_roc, fit_risk, risk_scores, stable_layout
from cohortum.plans import jobs
from cohortum.sources import tables
from cohortum.sources.versions import Files, current_path, rewriting, versions_of
from tests import data
from tests.data import as_set, rows

FAILURES = (Py4JJavaError, PySparkException)


@pytest.fixture
def layout(tmp_path):
    (tmp_path / "raw").mkdir()
    return tables.Layout(f"{tmp_path}/raw", f"{tmp_path}/processed")


def versions(layout, name: str) -> list[str]:
    folder = versions_of(layout.processed(name))
    return sorted(x for x in os.listdir(folder) if not x.startswith(".")) if os.path.exists(folder) else []


def failing(spark, n: int = 1000):
    """Rows of which the last partition cannot be computed."""
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))


def test_a_rewrite_replaces_the_table_in_one_step(spark, layout):
    for n in (3, 5, 7):
        tables.write_table(spark.range(n), layout, "t")
        assert tables.read_table(spark, layout, "t").count() == n
    assert len(versions(layout, "t")) == 2  # the pointer and the version it names
    assert not os.path.exists(layout.processed("t"))


def test_a_table_can_be_rewritten_from_itself(spark, layout):
    tables.write_table(spark.range(10), layout, "t")
    for _ in range(2):
        tables.write_table(tables.read_table(spark, layout, "t").where("id % 2 = 0"), layout, "t")
    tables.write_table(spark.range(1), layout, "t", mode="append")
    assert sorted(rows(tables.read_table(spark, layout, "t"))) == [(0,), (0,), (2,), (4,), (6,), (8,)]


@pytest.mark.parametrize("written_before", [1, 2])
def test_a_rewrite_that_fails_changes_nothing(spark, layout, written_before):
    for n in range(written_before):
        tables.write_table(spark.range(10 + n), layout, "t")
    before = versions(layout, "t")
    with pytest.raises(FAILURES):
        tables.write_table(failing(spark), layout, "t")
    assert tables.read_table(spark, layout, "t").count() == 9 + written_before
    assert versions(layout, "t") == before


def test_a_first_write_that_fails_leaves_no_table(spark, layout):
    with pytest.raises(FAILURES):
        tables.write_table(failing(spark), layout, "t")
    assert tables.read_optional(spark, layout, "t") is None


def test_a_job_that_is_stopped_while_it_writes(spark, layout):
    tables.write_table(spark.range(10), layout, "t")
    caught = []
    slow = spark.range(0, 4, 1, 4).select("id", F.expr("reflect('java.lang.Thread', 'sleep', 8000L)").alias("slept"))

    def write():
        try:
            tables.write_table(slow, layout, "t")
        except BaseException as problem:  # noqa: BLE001
            caught.append(problem)

    thread = threading.Thread(target=write)
    thread.start()
    for _ in range(100):
        time.sleep(0.1)
        if versions(layout, "t"):
            break
    assert tables.read_table(spark, layout, "t").count() == 10
    spark.sparkContext.cancelAllJobs()
    thread.join(60)
    assert caught and not thread.is_alive()
    assert tables.read_table(spark, layout, "t").count() == 10
    assert versions(layout, "t") == []


def test_what_a_killed_process_left_goes_with_the_next_rewrite(spark, layout):
    tables.write_table(spark.range(1), layout, "t")
    spark.range(99).write.parquet(f"{versions_of(layout.processed('t'))}/half")
    assert tables.read_table(spark, layout, "t").count() == 1
    tables.write_table(spark.range(2), layout, "t")
    assert "half" not in versions(layout, "t") and tables.read_table(spark, layout, "t").count() == 2


def test_tables_are_published_together_or_not_at_all(spark, layout):
    for name in ("a", "b"):
        tables.write_table(spark.range(1), layout, name)
    with pytest.raises(FAILURES):
        with rewriting(spark) as rewrite:
            tables.write_table(spark.range(2), layout, "a", rewrite=rewrite)
            assert tables.read_table(spark, layout, "a").count() == 1
            assert tables.read_table(spark, layout, "a", rewrite).count() == 2
            tables.write_table(failing(spark), layout, "b", rewrite=rewrite)
    assert [tables.read_table(spark, layout, name).count() for name in ("a", "b")] == [1, 1]
    with rewriting(spark) as rewrite:
        for name in ("a", "b"):
            tables.write_table(spark.range(3), layout, name, rewrite=rewrite)
    assert [tables.read_table(spark, layout, name).count() for name in ("a", "b")] == [3, 3]


def test_readers_find_one_version_or_the_other(spark, layout):
    """Whoever resolves the table while it is rewritten gets a version that has been published."""
    tables.write_table(spark.range(1), layout, "t")
    path, found, done = layout.processed("t"), [], threading.Event()

    def resolve():
        while not done.is_set():
            found.append(current_path(spark, path))

    reader = threading.Thread(target=resolve)
    reader.start()
    published = [path]
    for _ in range(4):
        tables.write_table(spark.range(1), layout, "t")
        published.append(current_path(spark, path))
    done.set()
    reader.join()
    assert len(set(published)) == 5 and set(found) <= set(published)
    files = Files(spark)
    with pytest.raises(FileExistsError):
        files.create_text(f"{versions_of(path)}/CURRENT.4", "another")
    assert files.text(f"{versions_of(path)}/CURRENT.4") == published[-1].rsplit("/", 1)[1]
    assert len(versions(layout, "t")) == 2


SUBMISSIONS = "id_assessment,id_student,date_submitted,score\n1,1,5,70\n1,x,5,70\n2,2,soon,?\n2,y,later,1\n3,3\n3,4,,5,6\n"


def test_bad_lines_are_counted_and_listed(spark, layout):
    with open(layout.raw("studentAssessment"), "w") as file:
        file.write(SUBMISSIONS)
    jobs.ingest(spark, layout, ["studentAssessment"], most_rejected=5)
    assert as_set(tables.read_table(spark, layout, "studentAssessment")) == [(1, 1, 5, 70.0)]
    report = tables.read_table(spark, layout, fixed.REPORT_TABLE)
    assert {r["column"]: r["rejected"] for r in report.collect()} == {
        "id_assessment": 0, "id_student": 2, "date_submitted": 2, "score": 0, "_line": 2,
    }
    assert {r["lines"] for r in report.collect()} == {6}
    listed = tables.read_table(spark, layout, fixed.REJECTED_TABLE)
    assert as_set(listed.select("column", "text")) == [
        ("_line", "3,3"), ("_line", "3,4,,5,6"), ("date_submitted", "later"),
        ("date_submitted", "soon"), ("id_student", "x"), ("id_student", "y"),
    ]
    assert '"score":"?"' in listed.where("text = 'soon'").first()["line"]


def test_texts_that_are_no_numbers_are_not_cast_and_others_once(spark, tmp_path):
    odd = ["12", " 12 ", "+5", "1.0", ".", "1e3", "\u0661\u0662", "0x10", "?", "x1", "soon", "9223372036854775808",
           "NaN", " nan", "-inf", "Infinity", "1d", "0x1p3", ".5", "--1", "1_0", "\x7f3", None]
    texts = spark.createDataFrame([(x,) for x in odd], "text string")
    for kind in ("double", "bigint", "int", "decimal(10,2)", "date"):
        both = texts.select(F.col("text").try_cast(kind).cast("string").alias("cast"), tables.parsed("text", kind).cast("string").alias("ours"))
        assert both.where("NOT (cast <=> ours)").count() == 0
    texts.where("text IS NOT NULL").select(F.col("text").alias("id"), F.col("text").alias("n")).write.csv(f"{tmp_path}/raw", header=True)
    read = tables.read_raw_with_rejects(spark, f"{tmp_path}/raw", {"id": "bigint", "n": "int"})
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_cast") == 2 and plan.count("RLIKE") == 2 and "filter(" not in plan


def test_too_many_bad_lines_publish_nothing(spark, layout):
    with open(layout.raw("vle"), "w") as file:
        file.write("id_site,kind\n1,a\n")
    jobs.ingest(spark, layout, ["vle"])
    with open(layout.raw("vle"), "w") as file:
        file.write("id_site,kind\n1,a\n2,b\n")
    with open(layout.raw("studentAssessment"), "w") as file:
        file.write(SUBMISSIONS)
    with pytest.raises(jobs.TooManyRejects, match="5 of 6 lines"):
        jobs.ingest(spark, layout, ["vle", "studentAssessment"], most_rejected=4)
    assert tables.read_table(spark, layout, "vle").count() == 1
    assert tables.read_optional(spark, layout, "studentAssessment") is None
    with pytest.raises(FAILURES):
        jobs.ingest(spark, layout, ["studentAssessment"])
    with pytest.raises(ValueError, match="fits every line"):
        jobs.ingest(spark, layout, ["vle"], infer=True, most_rejected=1)


def test_stated_types_hold_beside_inferred_ones(spark, layout):
    with open(layout.raw("studentVle"), "w") as file:
        file.write("id_student,date,sum_click\n007,2024-01-05,3\n010,2024-01-06,4\n")
    found = tables.read_raw_table(spark, layout, "studentVle", {"id_student": "string", "sum_click": "double"}, infer=True)
    assert found.dtypes == [("id_student", "string"), ("date", "date"), ("sum_click", "double")]
    assert found.first()["id_student"] == "007"


def text_tables(spark):
    engagement = data.engagement(spark, (1, 10, 6), (2, 20, 7))
    risk = data.risk(spark, (1, 0.2), (1, 0.9), (2, 0.3))
    grades = data.grades(spark, (1, 120.0), (2, 49.0))
    spelled = lambda frame: frame.withColumn("id_student", F.concat(F.lit(" S-"), F.col("id_student").cast("string"), F.lit("\t")))
    return {
        fixed.ENGAGEMENT_TABLE: spelled(engagement), fixed.RISK_TABLE: spelled(risk), fixed.GRADE_TABLE: spelled(grades),
    }


def test_a_lookup_by_text_reaches_the_scans(spark, layout):
    for name, frame in text_tables(spark).items():
        jobs.store_by_student(frame, layout, name)
    stored = [tables.read_table(spark, layout, name) for name in text_tables(spark)]
    assert all(is_harmonised(frame, "id_student") for frame in stored)
    found = profile.student_lookup("S-1  ", *stored)
    plan = found._jdf.queryExecution().toString()
    assert plan.count("EqualTo(id_student,S-1)") >= 3 and "btrim" not in plan.split("Physical Plan")[1]
    assert tuple(found.select("searched", "lookup_status", "risk_probability", "predicted_gpa").first()) == (
        "S-1", "found", pytest.approx(0.9), 100.0
    )
    assert profile.student_lookup("S-3", *stored).first()["lookup_status"] == "no_such_student"


def test_stored_text_keys_have_bloom_filters(spark, layout):
    """Few distinct keys are found by the dictionary instead, so the table needs very many."""
    many = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id_student"))
    jobs.store_by_student(many.coalesce(1), layout, "many")
    sized = lambda name: sum(
        os.path.getsize(os.path.join(folder, file))
        for folder, _, files in os.walk(current_path(spark, layout.processed(name))) for file in files
    )
    tables.write_table(with_harmonised_key(many.coalesce(1), "id_student"), layout, "bare", ranged_by=["id_student"])
    assert sized("many") > sized("bare") + 50_000


def test_the_mark_of_a_spelling_is_kept_and_joins_do_without_rewriting(spark):
    one = with_harmonised_key(text_tables(spark)[fixed.RISK_TABLE], "id_student")
    assert with_harmonised_key(one.select("id_student"), "id_student") .columns == ["id_student"]
    assert is_harmonised(one.groupBy("id_student").count(), "id_student")
    assert not is_harmonised(one.select(F.upper("id_student").alias("id_student")), "id_student")


def test_students_with_several_spellings_are_one(spark, layout):
    tables.write_table(
        spark.createDataFrame([("12", 1, 3), (" 012", 1, 4), ("12.0", 2, 5), ("x", 1, 1)], "id_student string, date int, sum_click long")
        .withColumn("id_site", F.lit(1)), layout, "studentVle",
    )
    jobs.build_engagement(spark, layout)
    found = tables.read_table(spark, layout, fixed.ENGAGEMENT_TABLE)
    assert as_set(found.select("id_student", "total_clicks", "days_active")) == [("12", 12, 2), ("x", 1, 1)]


def test_requests_made_very_often(spark):
    frame = spark.createDataFrame([(1, 0), (2, 1), (3, 7), (4, 8), (5, 9), (6, 65), (7, 1000)], "k int, times long")
    found = profile.repeated(frame, "times", most=8).groupBy("k").count()
    assert dict(rows(found)) == {2: 1, 3: 7, 4: 8, 5: 9, 6: 65, 7: 1000}


def test_copies_of_a_request_need_no_large_array(spark):
    """Three thousand million copies, of which the plan takes the first few."""
    frame = spark.createDataFrame([("a", 3_000_000_000)], "k string, times long")
    copies = profile.repeated(frame, "times")
    assert copies.limit(5).collect() == [("a", 3_000_000_000)] * 5
    plan = copies._jdf.queryExecution().optimizedPlan().toString()
    assert "10000" in plan and "100000000" in plan


def outcomes(spark):
    features = spark.range(300).selectExpr(
        "id AS id_student", "id * 7 % 101 AS total_clicks", "id * 3 % 17 AS days_active",
        "CAST(id % 23 AS DOUBLE) AS engagement_index",
    )
    labelled = features.withColumn("label", F.expr("CAST(xxhash64(id_student) % 3 = 0 OR total_clicks < 40 AS INT)"))
    return features, labelled.unionByName(labelled.where("id_student % 4 = 0"))


def test_a_forest_does_not_depend_on_how_its_rows_come(spark):
    features, labelled = outcomes(spark)
    scored = [
        as_set(risk_scores(fit_risk(labelled.repartition(n), how, trees=8).model, features, features))
        for how in ("key", "row") for n in (4, 7)
    ]
    assert scored[0] == scored[1] and scored[2] == scored[3]


def test_copies_of_a_row_are_dealt_over_partitions(spark):
    copies = spark.range(50_000).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    laid = stable_layout(copies.unionByName(copies.limit(1).withColumn("a", F.lit(2))), 8)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert laid.rdd.getNumPartitions() == 8 and sum(sizes) == 50_001 and max(sizes) < 25_000


def test_the_area_is_exact_where_bins_are_not(spark):
    scored = spark.range(30_000).selectExpr(
        "CAST(id AS DOUBLE) AS s", "CAST(xxhash64(id) % 30000 < id - 15000 AS INT) AS label", "1 AS one"
    )
    listed = sorted(rows(scored.select("s", "label")))
    below = won = 0
    for _, label in listed:
        won, below = (won + below, below) if label else (won, below + 1)
    positive = sum(label for _, label in listed)
    assert area_under_roc(scored, "s") == won / (positive * (len(listed) - positive))
    assert area_under_roc(scored, "s") != area_under_roc(scored, "s", bins=100)
    assert area_under_roc(scored.where("label = 0"), "s") == 0.0 and area_under_roc(scored.where("label = 1"), "s") == 1.0
    assert area_under_roc(scored.withColumn("s", F.lit(1.0)), "s") == 0.5
