"""Batch and streaming scans of Parquet tables, and rows from literals."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starflow import schemas


def scan(spark: SparkSession, *paths: str, schema: T.StructType | None = None, merge: bool = False) -> DataFrame:
    """Snapshot read.

    With a declared ``schema`` a column that older files lack reads as NULL and no
    footer is opened for planning.  ``merge`` finds the union of the files' schemas
    instead, in a Spark job over all footers.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif merge:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def scan_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    max_files: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """Incremental read of an append-only table.

    The path is a folder; ``name_filter`` narrows it to some file names.
    ``max_files`` bounds a micro-batch, and with it the number of versions a
    type-2 dimension gets from the same data.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path)


def literal_events(spark: SparkSession, texts: Iterable[str]) -> DataFrame:
    """Hand-written JSON events as raw rows."""
    return spark.createDataFrame([(t,) for t in texts], schemas.RAW)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
