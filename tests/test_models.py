from __future__ import annotations

import math

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortum.operators import models
from cohortum.operators.split import key_share, split_at_random, split_by_key
from tests.data import as_set


@pytest.fixture(scope="module")
def engagement(spark):
    return (
        spark.range(400)
        .select(
            F.col("id").alias("id_student"),
            (F.col("id") * 7 % 101).alias("total_clicks"),
            (F.col("id") * 3 % 17).alias("days_active"),
        )
        .withColumn("engagement_index", F.expr("total_clicks * 0.4D + days_active * 0.6D"))
    )


@pytest.fixture(scope="module")
def labelled(engagement):
    """Two rows per student; few clicks mean the positive label, apart from some noise."""
    noisy = F.when(F.col("id_student") % 10 == 0, 1).otherwise(0)
    first = engagement.withColumn("label", (F.col("total_clicks") < 40).cast("int"))
    return first.unionByName(first.withColumn("label", F.abs(F.col("label") - noisy)))


@pytest.fixture(scope="module")
def graded(engagement):
    return engagement.select(
        "id_student",
        (F.col("total_clicks") * 1.5 + F.col("days_active") - 20).alias("current_gpa"),
        *(F.col(c).cast("double") for c in ("total_clicks", "days_active", "engagement_index")),
    )


def test_split_by_key_covers_all_rows_once(labelled):
    train, held_out = split_by_key(labelled)
    assert train.count() + held_out.count() == labelled.count()
    assert train.join(held_out, "id_student", "left_semi").count() == 0
    assert 0.7 < train.count() / labelled.count() < 0.9


def test_split_by_key_does_not_depend_on_partitions(labelled):
    again = split_by_key(labelled.repartition(3, "label"))[0]
    assert as_set(again) == as_set(split_by_key(labelled)[0])


def test_split_seed_matters_and_missing_keys_stay(spark):
    keys = spark.createDataFrame([(k,) for k in [*range(50), None]], "id_student long")
    shares = [
        tuple(r[0] for r in keys.select(key_share("id_student", seed)).collect())
        for seed in (42, 43)
    ]
    assert shares[0] != shares[1]
    train, held_out = split_by_key(keys)
    assert train.count() + held_out.count() == 51


def test_split_at_random_covers_all_rows(labelled):
    train, held_out = split_at_random(labelled.persist())
    assert train.count() + held_out.count() == labelled.count()


@pytest.mark.parametrize("how", ["key", "row"])
def test_risk_model(spark, engagement, labelled, how):
    fitted = models.fit_risk(labelled, how, trees=10)
    assert fitted.quality > 0.9
    info = labelled.select("id_student")
    scores = models.risk_scores(fitted.model, engagement, info)
    assert scores.dtypes == [
        ("id_student", "bigint"),
        ("prediction", "double"),
        ("risk_probability", "float"),
    ]
    assert scores.count() == info.count()
    ends = scores.agg(F.min("risk_probability"), F.max("risk_probability")).first()
    assert 0 <= ends[0] < 0.5 < ends[1] <= 1
    per_student = scores.groupBy("id_student").agg(F.count_distinct("risk_probability").alias("n"))
    assert per_student.where("n <> 1").count() == 0
    assert scores.where("prediction <> cast(risk_probability > 0.5 as double)").count() == 0


@pytest.mark.parametrize("partitions", [2, 7])
def test_a_feature_that_decides_the_label_is_learned_in_any_partitions(engagement, partitions):
    decided = engagement.withColumn("days_active", (F.col("id_student") % 2).cast("bigint"))
    decided = decided.withColumns({name: F.col("days_active") for name in ("total_clicks", "engagement_index")})
    rows_of = decided.withColumn("label", F.col("days_active").cast("int")).repartition(partitions)
    fitted = models.fit_risk(rows_of, trees=5)
    scores = models.risk_scores(fitted.model, decided, decided.select("id_student"))
    assert fitted.quality == 1
    assert scores.where("prediction <> id_student % 2").count() == 0


def test_the_same_seed_gives_the_same_forest(engagement, labelled):
    info = labelled.select("id_student")
    shuffled = labelled.repartition(5, "id_student")
    first, second = (
        as_set(models.risk_scores(models.fit_risk(shuffled, trees=5).model, engagement, info))
        for _ in range(2)
    )
    assert first == second
    other = models.fit_risk(shuffled, trees=5, forest_seed=1).model
    assert as_set(models.risk_scores(other, engagement, info)) != first


def test_scoring_needs_no_python_worker(engagement, labelled):
    model = models.fit_risk(labelled, trees=3).model
    scores = models.risk_scores(model, engagement, labelled.select("id_student"))
    assert "Python" not in scores._jdf.queryExecution().toString()


def test_missing_features_stop_the_risk_model(labelled):
    broken = labelled.withColumn("days_active", F.nullif("days_active", F.lit(3)))
    with pytest.raises((PySparkException, Py4JJavaError)):
        models.fit_risk(broken, trees=2)


def test_unknown_split_is_refused(labelled):
    with pytest.raises(ValueError):
        models.fit_risk(labelled, "none")


def test_area_under_roc_is_the_rank_sum(spark):
    points = [(0.1, 0), (0.4, 0), (0.4, 1), (0.4, 1), (0.8, 0), (0.9, 1)]
    frame = spark.createDataFrame(points, "s double, label int")
    wins = [
        1.0 if p > n else 0.5 if p == n else 0.0
        for p, one in points if one
        for n, zero in points if not zero
    ]
    assert models.area_under_roc(frame, "s", bins=0) == pytest.approx(sum(wins) / len(wins))


def test_grade_model(graded):
    fitted = models.fit_grades(graded)
    predictions = models.grade_predictions(fitted.model, graded)
    assert predictions.count() == graded.count()
    assert predictions.where("predicted_gpa < 0 or predicted_gpa > 100").count() == 0
    assert set(r[0] for r in predictions.select("gpa_bounds_note").distinct().collect()) == {
        "capped_to_0",
        "within_range",
        "capped_to_100",
    }
    assert fitted.quality < 1


def test_grade_model_has_no_bias_on_its_training_rows(graded):
    train, held_out = split_by_key(graded)
    fitted = models.fit_grades(graded)
    errors = fitted.model.transform(train).agg(F.avg(F.col("prediction") - F.col("current_gpa")))
    assert errors.first()[0] == pytest.approx(0, abs=1e-8)
    squares = fitted.model.transform(held_out).agg(
        F.avg(F.pow(F.col("prediction") - F.col("current_gpa"), 2))
    )
    assert fitted.quality == pytest.approx(math.sqrt(squares.first()[0]))


def test_missing_features_are_skipped_by_the_grade_model(graded):
    gaps = graded.withColumn("days_active", F.nullif("days_active", F.lit(3.0)))
    fitted = models.fit_grades(gaps)
    kept = gaps.where("days_active is not null").count()
    assert models.grade_predictions(fitted.model, gaps).count() == kept


def test_models_can_be_saved(spark, graded, tmp_path):
    from pyspark.ml import PipelineModel

    model = models.fit_grades(graded).model
    model.write().overwrite().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    expected = as_set(models.grade_predictions(model, graded))
    assert as_set(models.grade_predictions(again, graded)) == expected
