"""Tables that a stream appends to, kept small: old files folded into few.

The file sink notes each file it has written in a log that every reader and every tenth
batch reads whole, and small batches leave small files.  :func:`fold` writes the rows of all
files older than a time as few files to the folder beside the table, as one version whose
number is that time in milliseconds.  :func:`read_appended` takes the folded versions, and
of the table itself the files from the last such time on, so a reader sees each row once,
before, during and after a fold.

The log forgets what was folded when the stream next runs with the ``retention`` that
:func:`forget_after` gives; the fold after that deletes the files the log no longer names.

A fold must come after every stream that reads the table has seen the files, and later than
the batch that wrote them has ended: choose ``until`` a day back, or fold between runs.
"""

import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow import files
from starflow.sinks import snapshots

DAY_MS = 24 * 3600 * 1000
WRITTEN = "_metadata.file_modification_time"


def folder(path: str) -> str:
    return f"{path}_folded"


def _recent(spark: SparkSession, path: str, schema: T.StructType, since: int | None) -> DataFrame:
    rows = spark.read.schema(schema).parquet(path)
    return rows if since is None else rows.filter(F.col(WRITTEN) >= F.timestamp_millis(F.lit(since)))


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the table; Spark leaves out files by their time before it opens them."""
    until = snapshots.latest(spark, folder(path))
    rows = _recent(spark, path, schema, until).select(*schema.names)
    return rows if until is None else rows.unionByName(snapshots.read_increments(spark, folder(path), schema, until))


def fold(
    spark: SparkSession, path: str, schema: T.StructType, until: datetime | None = None, partition_by: Sequence[str] = ()
) -> bool:
    """Fold the files written before ``until`` (default: now); whether there were any.

    A fold that fails leaves a version without its mark, which no reader sees.
    """
    cut = int(1000 * (time.time() if until is None else until.timestamp()))
    since = snapshots.latest(spark, folder(path))
    _sweep(spark, path, schema, since)
    if since is not None and cut <= since:
        return False
    rows = _recent(spark, path, schema, since).filter(F.col(WRITTEN) < F.timestamp_millis(F.lit(cut)))
    if rows.isEmpty():
        return False
    rows = rows.select(*schema.names)
    snapshots.publish(rows.hint("rebalance", *partition_by), folder(path), cut, partition_by=partition_by)
    return True


def _sweep(spark: SparkSession, path: str, schema: T.StructType, folded: int | None) -> int:
    """Delete folded files that the log has forgotten; returns how many."""
    if folded is None:
        return 0
    name = lambda file: file.rsplit("/", 1)[1]  # noqa: E731  a sink's names are unique
    logged = {name(f) for f in spark.read.schema(schema).parquet(path).inputFiles()}
    stored = [f for pattern in ("part-*", "*=*/part-*") for f in files.matching_times(spark, f"{path}/{pattern}")]
    gone = [file for file, written in stored if written < folded and name(file) not in logged]
    for file in gone:
        files.delete(spark, file)
    return len(gone)


def forget_after(spark: SparkSession, path: str, margin_ms: int = DAY_MS) -> str | None:
    """The sink's ``retention``: long enough that its log forgets folded files only.

    Counted from now: a run must end within ``margin_ms``, or its log begins to forget what it
    wrote itself.  None without a fold: the log keeps all.
    """
    until = snapshots.latest(spark, folder(path))
    return None if until is None else f"{int(1000 * time.time()) - until + margin_ms}ms"
