"""Typed exports under the warehouse's column names.

Exports are written from a published snapshot, so another engine that reads the files
never meets superseded ones.  Surrogate keys are SHA-256 text and stay text: the
warehouse's BIGINT could not hold them.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow import files
from starflow.sinks import snapshots
from starflow.sinks.catalog import declare_table, move_table

# Column order and types of the warehouse tables; None keeps the
# column's own timestamp type.
PATIENT = (
    ("patient_id", "patient_id", "string"),
    ("gender", "gender", "string"),
    ("age", "age", "int"),
    ("effective_from", "effective_from", None),
    ("surrogate_key", "patient_sk", "string"),
    ("effective_to", "effective_to", None),
    ("is_current", "is_current", "boolean"),
)
DEPARTMENT = (
    ("surrogate_key", "department_sk", "string"),
    ("department", "department", "string"),
    ("hospital_id", "hospital_id", "int"),
)
FACT = (
    ("fact_id", "fact_id", "bigint"),
    ("patient_sk", "patient_sk", "string"),
    ("department_sk", "department_sk", "string"),
    ("admission_time", "admission_time", None),
    ("discharge_time", "discharge_time", None),
    ("admission_date", "admission_date", "date"),
    ("length_of_stay_hours", "length_of_stay_hours", "double"),
    ("is_currently_admitted", "is_currently_admitted", "boolean"),
    ("bed_id", "bed_id", "int"),
    ("event_ingestion_time", "event_ingestion_time", None),
)


def typed(df: DataFrame, layout: tuple) -> DataFrame:
    return df.select(
        *[(F.col(src).cast(dtype) if dtype else F.col(src)).alias(name) for name, src, dtype in layout]
    )


def export(spark: SparkSession, df: DataFrame, layout: tuple, name: str, location: str) -> DataFrame:
    """Write the export to a new folder below ``location`` and point the external table at it.

    An export may be repeated.  The table changes over once the files are complete; the
    folders of earlier exports stay for readers that have begun, and may then be deleted.
    """
    out, folder = typed(df, layout), f"{location}/{uuid.uuid4().hex}"
    out.write.parquet(folder)
    declare_table(spark, name, out.schema, folder)
    return move_table(spark, name, folder)


def export_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: Sequence[str],
    layout: tuple,
    name: str,
    location: str,
) -> tuple[DataFrame, list[str]]:
    """Bring a partitioned export up to the newest version of a published table.

    ``columns`` are the partitions of the table at ``path``; the export has those of the first
    one as folders below ``location``, as any engine reads them, and that column last.  Only
    values of which a version since the last export wrote anything are read and replaced; the
    files of all others stay.  A small file beside them names the version exported, written
    once the data are: an export that fails is done again from where the last one ended.
    Returns the table and the values replaced.
    """
    by, marker = columns[0], f"{location}/_version"
    newest, told = snapshots.latest(spark, path), files.read_text(spark, marker)
    exported = None if told is None else int(told)
    values = [] if newest is None else snapshots.changed(spark, path, columns, after=exported, upto=newest)
    rows = typed(snapshots.read_partitions(spark, path, schema, columns, upto=newest, only=values), layout)
    files.make_folder(spark, location)  # the table lists it, also before the first row
    if values:
        out = rows.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(by).parquet(location)
        files.write_text(spark, marker, str(newest))
    ordered = T.StructType([f for f in rows.schema if f.name != by] + [rows.schema[by]])
    if spark.catalog.tableExists(name) and not _lies_in(spark, name, location):
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    table = declare_table(spark, name, ordered, location, partition_by=by)
    spark.catalog.refreshTable(name)
    return table, values


def _lies_in(spark: SparkSession, name: str, location: str) -> bool:
    """Whether the table is one by partitions at this place."""
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    return "# Partition Information" in told and files.same(spark, told.get("Location", ""), location)
