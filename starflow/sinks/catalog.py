"""Catalog tables over Parquet folders."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def quoted(text: str) -> str:
    """A SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def move_table(spark: SparkSession, name: str, location: str) -> DataFrame:
    """Points an external table at another folder of the same columns."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(location)}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def declare_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str, partition_by: str | None = None
) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS with declared columns; of a partitioned one, the partitions there are."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET{partitioned} LOCATION {quoted(location)}")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def register_table(spark: SparkSession, name: str, location: str) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS over existing files; schema and partitions are found there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING PARQUET LOCATION {quoted(location)}")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def write_partitioned(df: DataFrame, path: str, column: str) -> None:
    """First write of a table partitioned by ``column``; fails if the path exists.

    Rows are rebalanced by the column first, so a partition gets few files of even
    size and AQE splits one that holds most rows over several tasks.
    """
    df.hint("rebalance", column).write.partitionBy(column).parquet(path)
