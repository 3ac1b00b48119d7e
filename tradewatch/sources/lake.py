"""Scans of the lake: raw text, cleaned and aggregate Parquet, CSV snapshots."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRONZE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.StringType()),
    ]
)


def read_bronze(
    spark: SparkSession,
    root: str,
    topic: str | None = None,
    date: str | None = None,
    modified_after: datetime | None = None,
) -> DataFrame:
    """Raw lines. Topic and date prune folders; blank lines are skipped, unreadable files are errors."""
    reader = spark.read.schema(BRONZE)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    return _lines(reader.format("text").load(root), topic, date)


def bronze_stream(
    spark: SparkSession, root: str, topic: str | None = None, max_files: int | None = None
) -> DataFrame:
    """The same lines, file by file as they land; the checkpoint remembers what was read."""
    reader = spark.readStream.schema(BRONZE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return _lines(reader.format("text").load(root), topic, None)


def checked_stream(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Lines that the schema guard let through, as they come."""
    schema = T.StructType([*BRONZE.fields, T.StructField("version", T.LongType())])
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(root).select(*BRONZE.fieldNames())


def _lines(lines: DataFrame, topic: str | None, date: str | None) -> DataFrame:
    if topic is not None:
        lines = lines.where(F.col("topic") == topic)
    if date is not None:
        lines = lines.where(F.col("date") == date)
    return lines.where(F.trim("value") != "")


def _dated(schema: T.StructType) -> T.StructType:
    kept = [f for f in schema if f.name != "date"]
    return T.StructType(kept + [T.StructField("date", T.StringType())])


def read_dated(
    spark: SparkSession, root: str, schema: T.StructType, dates: list[str] | None = None
) -> DataFrame:
    """Rows of a date-partitioned Parquet table; an absent table or date gives no rows."""
    try:
        rows = spark.read.schema(_dated(schema)).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _dated(schema))
    return rows if dates is None else rows.where(F.col("date").isin(dates))


def read_parts(
    spark: SparkSession, root: str, schema: T.StructType, dates: list[str] | None
) -> DataFrame | None:
    """Parts of some dates, or of all; only the folders of those dates are listed.

    The schema holds the partition columns date and version.
    """

    def read(paths: list[str]) -> DataFrame | None:
        try:
            return spark.read.schema(schema).option("basePath", root).parquet(*paths)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    paths = [root] if dates is None else [f"{root}/date={date}" for date in dates]
    whole = read(paths) if paths else None
    if whole is not None or len(paths) == 1:
        return whole
    # A date all of whose rows lack a key has no folder.
    found = [rows for path in paths if (rows := read([path])) is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def read_versions(
    spark: SparkSession, root: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """Rows of a table written by versions, with their version; before: only of earlier ones."""
    full = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
    try:
        rows = spark.read.schema(full).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    return rows if before is None else rows.where(F.col("version") < before)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A snapshot with a header; an empty field is NULL."""
    return spark.read.schema(schema).csv(path, header=True, timestampFormat=CSV_TIMESTAMP)


CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
