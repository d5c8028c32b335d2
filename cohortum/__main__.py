"""Run the jobs from a shell: ``python -m cohortum all --raw data/raw --processed data/processed``.

The session is whatever the environment configures, so the same call serves a laptop and a cluster.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import SparkSession

from cohortum.plans import jobs
from cohortum.sources.tables import Layout

STEPS: dict[str, Callable] = {
    "ingest": jobs.ingest,
    "engagement": jobs.build_engagement,
    "risk": jobs.build_risk,
    "grades": jobs.build_grades,
    "cohorts": jobs.build_cohorts,
}


def column_type(text: str) -> tuple[str, str, str]:
    """Table, column and type of ``table.column=type``."""
    place, _, kind = text.partition("=")
    table, _, column = place.partition(".")
    if not (table and column and kind):
        raise argparse.ArgumentTypeError(f"not of the form table.column=type: {text}")
    return table, column, kind


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cohortum", description="Run one job, or all in order.")
    parser.add_argument("step", choices=[*STEPS, "all"])
    parser.add_argument("--raw", required=True, help="folder of the raw CSV files")
    parser.add_argument("--processed", required=True, help="folder of the Parquet tables")
    parser.add_argument("--infer", action="store_true", help="let Spark find the raw types")
    parser.add_argument(
        "--type", action="append", default=[], type=column_type, metavar="TABLE.COLUMN=TYPE",
        help="type of a raw column, for example studentVle.date=date; may be repeated",
    )
    parser.add_argument(
        "--most-rejected", type=int, metavar="LINES",
        help="how many lines of a raw table may be bad; they are listed in rejected_lines",
    )
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"cohortum-{chosen.step}").getOrCreate()
    layout = Layout(chosen.raw, chosen.processed)
    types: dict[str, dict[str, str]] = {}
    for table, column, kind in chosen.type:
        types.setdefault(table, {})[column] = kind
    for step in STEPS if chosen.step == "all" else [chosen.step]:
        ingesting = {"types": types, "infer": chosen.infer, "most_rejected": chosen.most_rejected}
        options = ingesting if step == "ingest" else {}
        print(f"{step}: {STEPS[step](spark, layout, **options)}")


if __name__ == "__main__":
    main()
