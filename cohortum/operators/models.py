"""At-risk classification and grade regression with ``pyspark.ml``."""

from __future__ import annotations

from fractions import Fraction
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from cohortum import fixed_values as fixed
from cohortum.operators.grades import bounded_grades
from cohortum.operators.split import split_at_random, split_by_key
from cohortum.sources.tables import intermediate_folder, materialise


# Copies of a row that are dealt into partitions together.
BLOCK = 1000


class Fitted(NamedTuple):
    """A model and its quality on the held-out rows."""

    model: PipelineModel
    quality: float


def assembler(handle_invalid: str) -> VectorAssembler:
    return VectorAssembler(
        inputCols=list(fixed.FEATURES), outputCol="features", handleInvalid=handle_invalid
    )


def split(rows: DataFrame, how: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Split by ``"key"`` (the default everywhere) or by ``"row"``."""
    if how not in ("key", "row"):
        raise ValueError(f"split must be 'key' or 'row', not {how!r}")
    return split_by_key(rows, seed=seed) if how == "key" else split_at_random(rows, seed=seed)


def area_under_roc(
    scored: DataFrame, score: str = "rawPrediction", label: str = "label", bins: int = 0
) -> float:
    """Area under the ROC curve of a score (or a vector of one per class) for labels 0 and 1.

    Exact, unless ``bins`` asks for Spark's own figure over so many bins of scores.

    It is the share of pairs of a positive and a negative row in which the positive one scores
    higher, equal scores counting one half. Rows are counted per distinct score first. The counts
    are dealt into ranges of scores; the negatives below a score are those in earlier ranges and
    those before it in its own, so no task sees more than one range. All sums are whole numbers.
    Without positives the area is 0, without negatives 1.
    """
    if bins:
        return BinaryClassificationEvaluator(
            rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=bins
        ).evaluate(scored)
    vector = isinstance(scored.schema[score].dataType, VectorUDT)
    value = vector_to_array(score)[1] if vector else F.col(score).cast("double")
    # Zeros of either sign are one score.
    counts = scored.groupBy((value + F.lit(0.0)).alias("score")).agg(
        F.count_if(F.col(label) > 0).alias("positive"), F.count_if(F.col(label) <= 0).alias("negative")
    )
    with intermediate_folder(scored.sparkSession) as folder:
        dealt = materialise(
            counts.repartitionByRange("score").withColumn("part", F.spark_partition_id()), folder
        )
        # A row for each range.
        parts = dealt.groupBy("part").agg(F.sum("negative").alias("all_negative"))
        before = parts.select(
            "part", (F.sum("all_negative").over(Window.orderBy("part")) - F.col("all_negative")).alias("before")
        )
        inside = F.sum("negative").over(Window.partitionBy("part").orderBy("score")) - F.col("negative")
        won = F.col("before") + F.col("inside") + F.col("before") + F.col("inside") + F.col("negative")
        exact = F.col("positive").cast("decimal(18,0)") * won.cast("decimal(18,0)")
        twice, positive, negative = (
            dealt.withColumn("inside", inside).join(before, "part")
            .agg(F.sum(exact), F.sum("positive"), F.sum("negative")).first()
        )
    if not positive or not negative:
        return 0.0 if not positive else 1.0
    return float(Fraction(int(twice), 2 * positive * negative))


def root_mean_square_error(scored: DataFrame, label: str = "current_gpa") -> float:
    error = F.col(label) - F.col("prediction")
    return scored.agg(F.sqrt(F.avg(error * error))).first()[0]


def stable_layout(rows: DataFrame, parts: int) -> DataFrame:
    """The same rows in ``parts`` partitions, in places that depend on nothing but the rows.

    Equal rows are counted first and dealt in blocks of ``BLOCK`` copies, so that a student with
    very many of them fills no partition alone.
    """
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    last = F.expr(f"(_copies - 1) div {BLOCK}")
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(F.lit(BLOCK), F.col("_copies") - F.col("_block") * BLOCK).cast("int")
    return (
        blocks.repartition(parts, *names, "_block")
        .sortWithinPartitions(*names, "_block")
        .select(*names, F.explode(F.array_repeat(F.lit(True), size)).alias("_copy"))
        .drop("_copy")
    )


def fit_risk(
    rows: DataFrame,
    how: str = "key",
    split_seed: int = fixed.SPLIT_SEED,
    trees: int = fixed.FOREST_TREES,
    forest_seed: int = fixed.SPLIT_SEED,
    parts: int = fixed.FOREST_PARTS,
) -> Fitted:
    """Random forest on features and ``label``; the quality is the exact area under ROC.

    A missing feature is an error here. The forest draws its samples by partition and position, so
    the rows are laid out by their values in ``parts`` partitions: however they come, equal rows,
    seeds and ``parts`` give the same split and the same trees. For tables of many gigabytes
    ``parts`` should be raised to a few times the number of cores.
    """
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, seed=forest_seed
    )
    steps = Pipeline(stages=[assembler("error"), forest])
    kept = stable_layout(rows, parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, held_out = split(kept, how, split_seed)
        model = steps.fit(train)
        return Fitted(model, area_under_roc(model.transform(held_out)))
    finally:
        kept.unpersist()


def risk_scores(model: PipelineModel, engagement: DataFrame, info: DataFrame) -> DataFrame:
    """Class and risk for every enrolment of an active student.

    All enrolments of a student share the same features, so each student is scored once and the
    result is joined to the enrolments.
    """
    scored = model.transform(engagement.select("id_student", *fixed.FEATURES)).select(
        "id_student",
        "prediction",
        vector_to_array("probability")[1].cast("float").alias("risk_probability"),
    )
    return scored.join(info.select("id_student"), "id_student")


def fit_grades(
    rows: DataFrame,
    how: str = "key",
    split_seed: int = fixed.SPLIT_SEED,
    penalty: float = fixed.RIDGE_PENALTY,
) -> Fitted:
    """Ridge regression of ``current_gpa`` on the features; the quality is the RMSE.

    With three features Spark solves it in one pass over the rows. The features are linearly
    dependent by construction, so the penalty is what makes the coefficients unique.
    """
    ridge = LinearRegression(
        labelCol="current_gpa", featuresCol="features", regParam=penalty, solver="normal"
    )
    steps = Pipeline(stages=[assembler("skip"), ridge])
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, held_out = split(kept, how, split_seed)
        model = steps.fit(train)
        return Fitted(model, root_mean_square_error(model.transform(held_out)))
    finally:
        kept.unpersist()


def grade_predictions(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Bounded grade predictions for all rows, held out or not."""
    return bounded_grades(model.transform(rows))
