"""The learner tables, read from the commerce tables of a star schema.

Customers stand for students: their events are the activity, their orders the enrolments with
order status as outcome, their order lines the submissions, and parts the assessments. Two
surrogates stand for model results, so that the queries on such results can be checked exactly:
the share of a customer's orders with status F as risk, and the account balance as raw grade.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortum.functions.columns import at_risk_label
from cohortum.operators.cleaning import clean
from cohortum.operators.engagement import engagement_features
from cohortum.operators.grades import bounded_grades
from cohortum.sources.tables import materialise

POSITIVE = ("F",)


@dataclass(frozen=True)
class Roles:
    """Learner tables over the tables in ``folder``.

    ``engagement`` is lazy, for queries that read it once. ``stored_engagement`` and ``risk`` are
    written first, as they are between jobs, so that queries that need them at several places do
    not go back to the activity log for each.
    """

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def activity(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("id_student"),
            F.col("event_type").alias("id_site"),
            F.to_date("ts").alias("date"),
            F.round(F.col("value") * 100).cast("bigint").alias("sum_click"),
        )

    @cached_property
    def places(self) -> DataFrame:
        """Nation key with region name; both tables have a fixed number of rows."""
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "r_name")
        )

    @cached_property
    def enrolments(self) -> DataFrame:
        """Student and outcome of every enrolment, without what is known of the student."""
        return self.table("orders").select(
            F.col("o_custkey").alias("id_student"), F.col("o_orderstatus").alias("final_result")
        )

    @cached_property
    def info(self) -> DataFrame:
        enrolments = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("o_custkey").alias("id_student"),
                F.col("o_orderpriority").alias("gender"),
                F.col("r_name").alias("region"),
                F.col("c_mktsegment").alias("highest_education"),
                F.col("c_acctbal").alias("studied_credits"),
                F.col("o_orderstatus").alias("final_result"),
            )
        )
        return clean("studentInfo", enrolments)

    @cached_property
    def submissions(self) -> DataFrame:
        lines = (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("id_student"),
                F.col("l_partkey").alias("id_assessment"),
                F.when(F.col("o_custkey") % 13 != 0, F.col("l_extendedprice") / 1000).alias("score"),
            )
        )
        return clean("studentAssessment", lines)

    @cached_property
    def assessments(self) -> DataFrame:
        parts = self.table("part").select(
            F.col("p_partkey").alias("id_assessment"),
            F.col("p_size").alias("weight"),
        )
        return clean("assessments", parts)

    @cached_property
    def engagement(self) -> DataFrame:
        return engagement_features(self.activity)

    @cached_property
    def stored_engagement(self) -> DataFrame:
        return materialise(self.engagement)

    @cached_property
    def risk(self) -> DataFrame:
        """A surrogate score per enrolment of an active student, stored.

        It differs by outcome; some students have none, and some scores are missing.
        """
        info = self.enrolments
        label = at_risk_label(F.col("final_result"), POSITIVE)
        share = info.groupBy("id_student").agg(F.avg(label).cast("float").alias("_share"))
        per_student = self.stored_engagement.select("id_student").join(share, "id_student")
        outcome = F.col("final_result")
        part = F.when(outcome == "F", 1.0).when(outcome == "O", 0.75).otherwise(0.5)
        missing = (F.col("id_student") % 5 == 1) & (outcome == "O")
        scored = (
            per_student.join(info, "id_student")
            .where(F.col("id_student") % 7 != 0)
            .select(
                "id_student",
                F.when(~missing, (F.col("_share") * part).cast("float")).alias("risk_probability"),
            )
        )
        prediction = (F.col("risk_probability") > F.lit(0.5).cast("float")).cast("double")
        return materialise(scored.select("id_student", prediction.alias("prediction"), "risk_probability"))

    @cached_property
    def grades(self) -> DataFrame:
        """A surrogate grade per customer."""
        raw = self.table("customer").select(
            F.col("c_custkey").alias("id_student"),
            (F.col("c_acctbal") / 80).alias("prediction"),
        )
        return bounded_grades(raw)
