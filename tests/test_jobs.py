from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed
from cohortum.plans import jobs
from cohortum.sources.tables import Layout, read_table, write_table
from tests import data
from tests.data import as_set, rows

STUDENTS = 120


@pytest.fixture(scope="module")
def layout(tmp_path_factory):
    """Raw CSV files of a small course with gaps and oddities."""
    root = tmp_path_factory.mktemp("course")
    raw = root / "raw"
    raw.mkdir()
    rng = random.Random(7)
    activity = ["code_module,id_student,id_site,date,sum_click"]
    info = [
        "code_module,id_student,gender,region,highest_education,studied_credits,final_result"
    ]
    submissions = ["id_assessment,id_student,date_submitted,score"]
    for student in range(STUDENTS):
        busy = rng.randint(1, 30)
        if student % 20:
            for day in range(busy):
                clicks = rng.choice(["", "-4", str(rng.randint(1, 9))])
                activity.append(f"AAA,{student},{rng.randint(1, 5)},{day},{clicks}")
        for enrolment in range(1 + student % 3):
            outcome = "Pass" if busy > 12 else rng.choice(["Fail ", "Withdrawn"])
            info.append(
                f"AAA,{student}, {rng.choice('MF')} ,{rng.choice([' North', 'South '])},"
                f"{rng.choice(['A', 'B'])},{rng.choice(['60', '-1', ''])},{outcome}"
            )
        for assessment in range(student % 4):
            score = rng.choice(["?", str(min(140, 3 * busy + 20))])
            submissions.append(f"{assessment},{student},{rng.choice(['', '9'])},{score}")
    assessments = ["id_assessment,weight", "0,50", "1,40", "2,?", "3,110"]
    for name, lines in {
        "studentVle": activity,
        "studentInfo": info,
        "studentAssessment": submissions,
        "assessments": assessments,
        "vle": ["id_site,activity_type", "1,quiz", "2,page"],
    }.items():
        (raw / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return Layout(str(raw), str(root / "processed"))


@pytest.fixture(scope="module")
def reports(spark, layout):
    paths = jobs.ingest(spark, layout)
    jobs.build_engagement(spark, layout)
    auc = jobs.build_risk(spark, layout, trees=10)
    grades = jobs.build_grades(spark, layout)
    jobs.build_cohorts(spark, layout)
    return paths, auc, grades


def test_ingest_cleans_every_table(spark, layout, reports):
    assert list(reports[0]) == list(fixed.RAW_TABLES)
    info = read_table(spark, layout, "studentInfo")
    values = info.agg(
        F.collect_set("gender"), F.collect_set("region"), F.min("studied_credits"),
        F.collect_set("final_result"),
    ).first()
    assert [set(values[0]), set(values[1]), values[2], set(values[3])] == [
        {"m", "f"}, {"North", "South"}, 0, {"Pass", "Fail", "Withdrawn"},
    ]
    assert read_table(spark, layout, "studentVle").where("sum_click < 0").count() == 0
    weights = dict(rows(read_table(spark, layout, "assessments")))
    assert weights == {0: 50.0, 1: 40.0, 2: None, 3: 100.0}
    assert read_table(spark, layout, "vle").columns == ["id_site", "activity_type"]


def test_risk_has_a_row_per_enrolment_of_an_active_student(spark, layout, reports):
    info = read_table(spark, layout, "studentInfo")
    engagement = read_table(spark, layout, fixed.ENGAGEMENT_TABLE)
    risk = read_table(spark, layout, fixed.RISK_TABLE)
    assert risk.count() == info.join(engagement, "id_student").count()
    assert reports[1] > 0.8


def test_grades_have_a_row_per_graded_active_student(spark, layout, reports):
    grades = read_table(spark, layout, fixed.GRADE_TABLE)
    plain = (
        read_table(spark, layout, "studentAssessment")
        .join(read_table(spark, layout, "assessments"), "id_assessment")
        .where("score * weight is not null")
        .join(read_table(spark, layout, fixed.ENGAGEMENT_TABLE), "id_student")
        .select("id_student").distinct()
    )
    assert as_set(grades.select("id_student")) == as_set(plain)
    assert reports[2].n_capped == grades.where("gpa_bounds_note <> 'within_range'").count()


@pytest.mark.parametrize(
    "name, by, averages, count",
    [
        ("region_stats", "region", ("risk_probability", "engagement_index"), True),
        ("education_stats", "highest_education", ("risk_probability", "engagement_index"), False),
        ("region_gpa_stats", "region", ("predicted_gpa",), True),
        ("education_gpa_stats", "highest_education", ("predicted_gpa",), True),
    ],
)
def test_cohort_tables_equal_the_plain_joins(spark, layout, reports, name, by, averages, count):
    joined = read_table(spark, layout, "studentInfo")
    names = [fixed.GRADE_TABLE] if len(averages) == 1 else [fixed.RISK_TABLE, fixed.ENGAGEMENT_TABLE]
    for table in names:
        joined = joined.join(read_table(spark, layout, table), "id_student")
    expected = joined.groupBy(by).agg(
        *(F.avg(c) for c in averages), *([F.count("id_student")] if count else [])
    )
    found = {r[0]: tuple(r)[1:] for r in read_table(spark, layout, name).collect()}
    for key, *values in map(tuple, expected.collect()):
        assert found.pop(key) == pytest.approx(tuple(values))
    assert not found


def test_cohorts_once_per_student(spark, layout, reports, tmp_path):
    other = Layout(layout.raw_root, str(tmp_path))
    for name in ("studentInfo", fixed.RISK_TABLE, fixed.ENGAGEMENT_TABLE, fixed.GRADE_TABLE):
        read_table(spark, layout, name).write.parquet(other.processed(name))
    jobs.build_cohorts(spark, other, once_per_student=True)
    found = dict(rows(read_table(spark, other, "region_gpa_stats").select("region", "student_count")))
    expected = (
        read_table(spark, layout, "studentInfo")
        .join(read_table(spark, layout, fixed.GRADE_TABLE), "id_student")
        .groupBy("region").agg(F.count_distinct("id_student"))
    )
    assert found == dict(rows(expected))


def test_views(spark, layout, reports):
    view = jobs.overview_view(spark, layout)
    rows_in_view = jobs.student_view(spark, layout).count()
    assert view.figures.first()["row_count"] == rows_in_view
    assert view.distribution.agg(F.sum("row_count")).first()[0] == rows_in_view
    assert view.high_risk.count() <= fixed.LIST_LENGTH
    assert view.good_history.count() <= view.good_history_count.first()[0]
    page = jobs.profile_view(spark, layout, "007")
    assert page.profile.first()["lookup_status"] == "found"
    assert page.comparison.count() == 3
    nobody = jobs.profile_view(spark, layout, "nobody")
    assert nobody.profile.first()["lookup_status"] == "no_such_student"
    assert (nobody.comparison.count(), nobody.inputs.count()) == (0, 0)
    institution = jobs.institution_view(spark, layout)
    averages = [r["avg_predicted_gpa"] for r in institution.region_grades.collect()]
    assert averages == sorted(averages, reverse=True)


def test_views_before_any_model(spark, layout, reports, tmp_path):
    other = Layout(layout.raw_root, str(tmp_path))
    read_table(spark, layout, fixed.ENGAGEMENT_TABLE).write.parquet(
        other.processed(fixed.ENGAGEMENT_TABLE)
    )
    view = jobs.overview_view(spark, other)
    assert view.figures.first()["avg_risk_percent"] == 0.0
    assert view.good_history.count() == 0
    assert jobs.institution_view(spark, other) == (None, None, None, None)
    assert jobs.profile_view(spark, other, "7").profile.first()["grade_status"] == (
        "grades_not_available"
    )


def test_jobs_can_run_again(spark, layout, reports):
    before = as_set(read_table(spark, layout, fixed.ENGAGEMENT_TABLE))
    jobs.build_engagement(spark, layout)
    assert as_set(read_table(spark, layout, fixed.ENGAGEMENT_TABLE)) == before


def test_command_line_runs_a_step(spark, layout, reports, capsys):
    from cohortum.__main__ import main

    main(["engagement", "--raw", layout.raw_root, "--processed", layout.processed_root])
    assert capsys.readouterr().out.startswith("engagement: ")
    with pytest.raises(SystemExit):
        main(["nothing", "--raw", "a", "--processed", "b"])


def test_submissions_of_inactive_students_do_not_reach_the_grades(spark, tmp_path, monkeypatch):
    layout, seen, plain = Layout(f"{tmp_path}/raw", f"{tmp_path}/processed"), [], jobs.weighted_grades
    monkeypatch.setattr(jobs, "weighted_grades", lambda rows_, weights: seen.append(rows_) or plain(rows_, weights))
    active = data.engagement(spark, *((student, 10 * student + student % 7, student % 9) for student in range(1, 31)))
    write_table(active, layout, fixed.ENGAGEMENT_TABLE)
    lines = [(1, student, 2, float((student or 0) % 50)) for student in [*range(1, 61), None]]
    columns = "id_assessment long, id_student long, date_submitted int, score double"
    write_table(spark.createDataFrame(lines, columns), layout, "studentAssessment")
    write_table(spark.createDataFrame([(1, 50.0)], "id_assessment long, weight double"), layout, "assessments")
    jobs.build_grades(spark, layout)
    assert seen[0].count() == 30
    assert sorted(r[0] for r in read_table(spark, layout, fixed.GRADE_TABLE).select("id_student").collect()) == [*range(1, 31)]
