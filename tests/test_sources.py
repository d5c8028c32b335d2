from __future__ import annotations

import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum import fixed_values as fixed
from cohortum.sources import tables
from cohortum.sources.tables import Layout
from tests.data import as_set, rows


@pytest.fixture
def layout(tmp_path):
    (tmp_path / "raw").mkdir()
    return Layout(f"{tmp_path}/raw/", f"{tmp_path}/processed")


def write_csv(layout, name, text):
    with open(layout.raw(name), "w") as file:
        file.write(text)


def test_paths():
    layout = Layout("s3a://bucket/raw/", "hdfs:///processed")
    assert layout.raw("vle") == "s3a://bucket/raw/vle.csv"
    assert layout.processed("vle") == "hdfs:///processed/vle.parquet"


def test_raw_columns_get_types_by_name_in_any_order(spark, layout):
    write_csv(layout, "studentAssessment", "score,code,id_student,date_submitted\n?,x,1,\n7,,2,5\n")
    df = tables.read_raw_table(spark, layout, "studentAssessment")
    assert df.dtypes == [
        ("score", "double"),
        ("code", "string"),
        ("id_student", "bigint"),
        ("date_submitted", "int"),
    ]
    assert as_set(df) == [(7.0, None, 2, 5), (None, "x", 1, None)]


def test_raw_types_can_be_overridden_or_inferred(spark, layout):
    write_csv(layout, "studentVle", "id_student,date,sum_click\n1,2024-01-05,3\n")
    typed = tables.read_raw_table(spark, layout, "studentVle", {"date": T.DateType()})
    assert dict(typed.dtypes)["date"] == "date"
    inferred = tables.read_raw_table(spark, layout, "studentVle", infer=True)
    assert inferred.dtypes == [("id_student", "int"), ("date", "date"), ("sum_click", "int")]


def test_typed_read_looks_at_the_header_only(spark, layout):
    tracker = spark.sparkContext.statusTracker()
    write_csv(layout, "vle", "id_site,kind\n" + "1,a\n" * 1000)
    spark.sparkContext.setJobGroup("header", "header")
    tables.read_raw_table(spark, layout, "vle")
    assert len(tracker.getJobIdsForGroup("header")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_part_files_with_other_column_order_are_refused(spark, layout, tmp_path):
    folder = tmp_path / "raw" / "assessments.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id_assessment,weight\n1,2\n")
    (folder / "b.csv").write_text("weight,id_assessment\n2,1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_raw_table(spark, layout, "assessments").collect()


def test_write_and_read_back(spark, layout):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    tables.write_table(df, layout, "t")
    path = tables.write_table(df.limit(4), layout, "t", partition_by=["part"], sorted_by=["id"])
    assert path == layout.processed("t")
    assert tables.read_table(spark, layout, "t").count() == 4
    tables.write_table(df.limit(1), layout, "t", mode="append", partition_by=["part"])
    assert tables.read_table(spark, layout, "t").count() == 5


def test_written_files_are_snappy(spark, layout, tmp_path):
    tables.write_table(spark.range(1), layout, "t")
    assert list((tmp_path / "processed" / "t.parquet").glob("*.snappy.parquet"))


def test_optional_tables(spark, layout, tmp_path):
    assert tables.read_optional(spark, layout, "absent") is None
    tables.write_table(spark.range(1), layout, "keyless")
    assert tables.read_optional(spark, layout, "keyless", ["id_student"]) is None
    assert tables.read_optional(spark, layout, "keyless").count() == 1
    broken = tmp_path / "processed" / "broken.parquet"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("no parquet at all")
    assert tables.read_optional(spark, layout, "broken") is None
    (tmp_path / "processed" / "empty.parquet").mkdir()
    assert tables.read_optional(spark, layout, "empty") is None


def test_other_failures_are_raised(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_optional(spark, Layout("", "nosuchscheme://x"), "t")


def test_grades_are_read_as_numbers(spark, layout):
    text = spark.createDataFrame([(1, "7.5"), (2, "?")], "id_student long, predicted_gpa string")
    tables.write_table(text, layout, fixed.GRADE_TABLE)
    df = tables.read_grades(spark, layout, fixed.GRADE_TABLE)
    assert as_set(df) == [(1, 7.5), (2, None)]


def test_materialise_cuts_the_lineage(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    stored = tables.materialise(df)
    assert stored.schema.names == df.schema.names
    assert as_set(stored) == as_set(df)
    assert "Range" not in stored._jdf.queryExecution().toString()


def test_shared_folder_follows_the_session():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"}.get(name, default)

    class Session:
        conf = Conf()

    first, second = (tables.shared_folder(Session()) for _ in range(2))
    assert first.startswith("hdfs:///shared/cohortum/") and first != second


@pytest.mark.parametrize("fails", [False, True])
def test_intermediate_folders_go_with_their_job(spark, tmp_path, fails):
    kept = []
    try:
        with tables.intermediate_folder(spark) as folder:
            kept.append(folder)
            assert tables.materialise(spark.range(3), f"{folder}/a").count() == 3
            if fails:
                raise RuntimeError
    except RuntimeError:
        pass
    assert not os.path.exists(kept[0].removeprefix("file:"))


@pytest.mark.parametrize(
    "line, column", [("A1,3,4", "id_student"), ("1,2024-01-05,4", "date"), ("1,3,4.5", "sum_click")]
)
def test_a_value_that_would_be_lost_stops_the_job(spark, layout, line, column):
    write_csv(layout, "studentVle", f"id_student,date,sum_click\n1,2,3\n{line}\n")
    with pytest.raises((PySparkException, Py4JJavaError), match=column):
        tables.read_raw_table(spark, layout, "studentVle").collect()


def test_written_ranges_do_not_overlap(spark, layout, tmp_path):
    rows = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"), F.rand(1).alias("x"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.write_table(rows, layout, "t", ranged_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    stored = tables.read_table(spark, layout, "t").groupBy(F.input_file_name()).agg(F.min("k"), F.max("k"))
    ends = sorted((r[1], r[2]) for r in stored.collect())
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_cluster_must_name_a_shared_folder():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        tables.shared_folder(Session())
