"""Named tables under two roots: raw CSV in, Parquet out."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cache
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortum.functions.keys import coerced_number
from cohortum.sources import schemas
from cohortum.sources.versions import Files, Rewrite, current_path, rewriting

# How Spark says that a path is absent, holds no files, or holds other files.
NO_TABLE = ("[PATH_NOT_FOUND]", "[UNABLE_TO_INFER_SCHEMA]", "is not a Parquet file")


# Names of what a tolerant reader adds: a line's reasons for rejection, and a broken line itself.
REJECTED, LINE = "_rejected", "_line"
REASONS = "array<struct<column:string,text:string,line:string>>"

# How the texts begin that can be numbers; a cast of any other text is a costly way to nothing.
NUMBER = r"^[\x00-\x20\x7f]*[+-]?(?:[\p{Nd}.]|[Nn][Aa][Nn]|[Ii][Nn][Ff])"


@dataclass(frozen=True)
class Layout:
    """Where tables live; both roots may be any URI that Spark can read."""

    raw_root: str
    processed_root: str

    def raw(self, name: str) -> str:
        return f"{self.raw_root.rstrip('/')}/{name}.csv"

    def processed(self, name: str) -> str:
        return f"{self.processed_root.rstrip('/')}/{name}.parquet"


def typed(
    name: str, kind: T.DataType | str, missing: Iterable[str] = schemas.MISSING, strict: bool = True
) -> Column:
    """A text column as another type.

    Text that means missing becomes missing. Other text that is no value of the type stops the
    job and names the column; with ``strict`` off it becomes missing too.
    """
    value = F.col(name).try_cast(kind)
    if not strict:
        return value.alias(name)
    message = F.concat(F.lit(f"column {name} holds text that is no {kind}: "), F.col(name))
    return (
        F.when(value.isNotNull(), value)
        .when(is_missing(name, missing), F.lit(None).cast(kind))
        .otherwise(F.raise_error(message).cast(kind))
        .alias(name)
    )


def parsed(name: str, kind: T.DataType | str) -> Column:
    """A text column cast to another type; what is no value of it becomes missing.

    A failed cast to a number raises and catches an error inside, which takes far longer than the
    cast of a number, so texts that do not begin like one are not cast.
    """
    value = F.col(name).try_cast(kind)
    return F.when(F.col(name).rlike(NUMBER), value) if is_number(kind) else value


def is_number(kind: T.DataType | str) -> bool:
    return isinstance(T.DataType.fromDDL(kind) if isinstance(kind, str) else kind, T.NumericType)


def is_missing(name: str, missing: Iterable[str] = schemas.MISSING) -> Column:
    return F.col(name).isNull() | F.trim(name).isin(*missing)


def is_text(kind: T.DataType | str) -> bool:
    return kind in ("string", T.StringType())


def read_raw(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType | str] | None = None,
    infer: bool = False,
    missing: Iterable[str] = schemas.MISSING,
    lenient: Iterable[str] = schemas.LENIENT,
) -> DataFrame:
    """Read CSV with a header row.

    Only the header is looked at up front; columns named in ``types`` get that type and the
    others stay text, so the data itself is read once. ``infer=True`` lets Spark find the types of
    the columns that ``types`` does not name, at the price of a second pass over the files.

    Text listed in ``missing`` is a missing value. In the columns named in ``lenient`` any text
    that does not fit becomes missing; in all others it stops the job, since a key, day or count
    must not get lost. :func:`read_raw_with_rejects` sets such lines aside instead.
    """
    wanted, loose = types or {}, set(lenient)
    found = {f.name: f.dataType for f in spark.read.csv(path, header=True, inferSchema=infer).schema}
    # Columns with a stated type are read as text, which loses nothing of their spelling.
    schema = T.StructType([T.StructField(n, T.StringType() if n in wanted else kind) for n, kind in found.items()])
    # With enforceSchema off, a part file with other column order fails instead of mixing values.
    rows = spark.read.csv(path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST")
    return rows.select(
        *(
            typed(name, wanted[name], missing, name not in loose)
            if name in wanted and not is_text(wanted[name])
            else F.col(name)
            for name in found
        )
    )


def read_raw_with_rejects(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType | str] | None = None,
    missing: Iterable[str] = schemas.MISSING,
    lenient: Iterable[str] = schemas.LENIENT,
) -> DataFrame:
    """Read CSV as :func:`read_raw` does, with what would stop it in the column ``REJECTED``.

    It is an array of the columns whose text is no value of their type, with that text and the
    fields of the line as JSON; a line with too few or too many fields is there once, under
    ``LINE``, as it is. The array of a good row is empty.
    """
    wanted, loose = types or {}, set(lenient)
    names = spark.read.csv(path, header=True).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, LINE]])
    rows = spark.read.csv(
        path, header=True, schema=schema, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE
    )
    # Each text is cast once, in a step of its own, for its value and for its reason.
    cast = {name: f"{REJECTED}_{n}" for n, name in enumerate(names) if name in wanted and not is_text(wanted[name])}
    rows = rows.select(*names, LINE, *(parsed(name, wanted[name]).alias(value) for name, value in cast.items()))
    fields = F.to_json(F.struct(*names))
    reason = lambda name, line: F.struct(F.lit(name).alias("column"), F.col(name).alias("text"), line.alias("line"))
    none = F.array().cast(REASONS)
    reasons = [
        F.when(F.col(value).isNull() & ~is_missing(name, missing), F.array(reason(name, fields)).cast(REASONS)).otherwise(none)
        for name, value in cast.items() if name not in loose
    ]
    broken = F.col(LINE).isNotNull()
    return rows.select(
        *(F.col(cast.get(name, name)).alias(name) for name in names),
        F.when(broken, F.array(reason(LINE, F.col(LINE))).cast(REASONS)).otherwise(F.concat(none, *reasons)).alias(REJECTED),
    )


def read_raw_table(
    spark: SparkSession,
    layout: Layout,
    name: str,
    types: Mapping[str, T.DataType | str] | None = None,
    infer: bool = False,
) -> DataFrame:
    """Read a raw table by name, with its usual column types unless ``types`` overrides some."""
    return read_raw(spark, layout.raw(name), raw_types(name, types, infer), infer)


def raw_types(
    name: str, types: Mapping[str, T.DataType | str] | None, infer: bool = False
) -> dict[str, T.DataType | str]:
    """Stated types before usual ones; with ``infer`` the usual ones are left to Spark."""
    return {**({} if infer else schemas.RAW_TYPES.get(name, {})), **(types or {})}


def read_table(spark: SparkSession, layout: Layout, name: str, rewrite: Rewrite | None = None) -> DataFrame:
    """Read the published version of a table, or the one that ``rewrite`` has written."""
    path = layout.processed(name)
    return spark.read.parquet(rewrite.path(path) if rewrite else current_path(spark, path))


def write_table(
    df: DataFrame,
    layout: Layout,
    name: str,
    mode: str = "overwrite",
    compression: str = "snappy",
    partition_by: Iterable[str] = (),
    sorted_by: Iterable[str] = (),
    ranged_by: Iterable[str] = (),
    bloom: Iterable[str] = (),
    rewrite: Rewrite | None = None,
) -> str:
    """Write a table by name and return its path.

    An overwrite leaves the old table readable until the new one is complete, see
    :mod:`cohortum.sources.versions`; with ``rewrite`` it is published together with other tables.

    ``sorted_by`` orders the rows inside each file, without a shuffle, so that a later lookup on
    those columns skips most row groups by their minimum and maximum. ``ranged_by`` also deals the
    rows into files by ranges of those columns, so that a lookup opens only the files it needs.
    ``bloom`` names columns that get a Bloom filter, of a size that fits the values found, which
    lets a lookup skip row groups whose range holds a value that they do not.
    """
    path = layout.processed(name)
    ranges, order = list(ranged_by), list(sorted_by) or list(ranged_by)
    rows = df.repartitionByRange(*ranges) if ranges else df
    rows = rows.sortWithinPartitions(*order) if order else rows
    keys = list(partition_by)

    def save(place: str) -> None:
        writer = rows.write.mode(mode).option("compression", compression)
        for column in bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            writer = writer.option(f"parquet.bloom.filter.adaptive.enabled#{column}", "true")
        (writer.partitionBy(*keys) if keys else writer).parquet(place)

    if mode != "overwrite":
        save(current_path(df.sparkSession, path))
    elif rewrite is not None:
        rewrite.write(path, save)
    else:
        with rewriting(df.sparkSession) as alone:
            alone.write(path, save)
    return path


def read_optional(
    spark: SparkSession,
    layout: Layout,
    name: str,
    required: Iterable[str] = (),
    rewrite: Rewrite | None = None,
) -> DataFrame | None:
    """Read a table that may not have been written yet.

    ``None`` stands for a table that is absent, is no Parquet table, or lacks a required column.
    Any other failure, such as a refused access, is raised.
    """
    try:
        df = read_table(spark, layout, name, rewrite)
    except (PySparkException, Py4JJavaError) as problem:
        if any(sign in str(problem) for sign in NO_TABLE):
            return None
        raise
    return df if set(required) <= set(df.columns) else None


def read_risk(
    spark: SparkSession, layout: Layout, name: str, rewrite: Rewrite | None = None
) -> DataFrame | None:
    """Risk scores, or ``None`` if no model has been applied yet."""
    return read_optional(spark, layout, name, ["id_student"], rewrite)


def read_grades(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    """Grade predictions with numeric columns, or ``None`` if there are none."""
    df = read_optional(spark, layout, name, ["id_student"])
    if df is None:
        return None
    numeric = [c for c in ("predicted_gpa", "predicted_gpa_raw") if c in df.columns]
    return df.withColumns({c: coerced_number(F.col(c)) for c in numeric}) if numeric else df


@cache
def _folder_of_this_process() -> tempfile.TemporaryDirectory:
    """A folder for local sessions, removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="cohortum-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one that the cluster names for checkpoints.

    Only a local session without that setting, as in tests, gets a temporary folder instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _folder_of_this_process().name
    application = spark.conf.get("spark.app.id", None) or "application"
    return f"{root.rstrip('/')}/cohortum/{application}/{uuid4().hex}"


def remove_intermediate(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, once no result needs them any more.

    Jobs remove their own. What is left are tables behind results that are read lazily, such as
    those of the queries of ``cohortum.llm``.
    """
    Files(spark).remove(shared_folder(spark).rsplit("/", 1)[0])


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors and lets several outputs share the work.
    ``path`` names the folder, for a caller that removes it; see :func:`intermediate_folder`.
    """
    spark = df.sparkSession
    path = path or shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediate_folder(spark: SparkSession) -> Iterator[str]:
    """A new shared folder for the intermediate tables of a job; it goes when the job ends,
    also by a failure."""
    path = shared_folder(spark)
    try:
        yield path
    finally:
        Files(spark).remove(path)
