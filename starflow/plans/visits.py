"""Visits derived from the ``events`` table: one event is one visit.

Faults (bad times, future admissions, open stays, NULL hospitals, broken JSON) are
placed by ``event_id``, so that an SQL engine can place the same ones.  Times are
zone-free like ``events.ts``.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.operators import cleaning, facts

# Clock of the cleaning rules and the measures.
AS_OF = datetime(2024, 1, 31)
BATCHES = (0, 1, 2)

# "Latest" everywhere: newest admission, then highest event.
LATEST = ("admission_time", "event_id")


def batch_clock(batch: int) -> datetime:
    """When a batch takes effect: the 11th, 21st and 31st."""
    return datetime(2024, 1, 11 + 10 * batch)


def effective(batch: str = "batch") -> Column:
    return F.expr(f"TIMESTAMP_NTZ '2024-01-11 00:00:00' + make_dt_interval(10 * {batch})")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    stay = F.expr("make_dt_interval(0, CAST((event_id * 37) % 72 + 1 AS INT))")
    return events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("patient_id"),
        F.when(event % 3 == 0, "Female").otherwise("Male").alias("gender"),
        F.floor("value").cast("int").alias("age"),
        F.col("event_type").alias("department"),
        F.when(event % 23 == 0, None)
        .when(event % 20 == 0, F.col("ts") + F.expr("INTERVAL 400 DAY"))
        .otherwise(F.col("ts"))
        .alias("admission_in"),
        F.when(event % 11 == 0, None).otherwise(F.col("ts") + stay).alias("discharge_time"),
        (event % 500 + 1).cast("int").alias("bed_id"),
        F.when(event % 97 == 0, None).otherwise((F.col("user_id") % 7 + 1).cast("int")).alias("hospital_id"),
        F.expr("CAST((dayofmonth(ts) - 1) DIV 10 AS INT)").alias("batch"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visits as event text, beside ``event_id`` and ``batch``."""
    event = F.col("event_id")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    admission = F.when(event % 23 == 0, "not-a-time").otherwise(F.date_format("admission_in", iso))
    text = F.to_json(
        F.struct(
            F.when(event % 101 != 0, F.col("patient_id")).alias("patient_id"),
            "gender",
            "age",
            "department",
            admission.alias("admission_time"),
            F.date_format("discharge_time", iso).alias("discharge_time"),
            "bed_id",
            "hospital_id",
        )
    )
    broken = F.when(event % 31 == 0, F.substring(text, 1, 20)).otherwise(text)
    return visits(spark, sf_dir).select("event_id", broken.alias("raw_json"), "batch")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean visits with ``event_id`` and ``batch``."""
    arrived = visits(spark, sf_dir).withColumnRenamed("admission_in", "admission_time")
    return cleaning.clean_visits(arrived, AS_OF)


def positions() -> dict[str, Column]:
    """A place in the broker for each event, in the order of the events."""
    event = F.col("event_id")
    return {
        "timestamp": F.timestamp_millis(event),
        "partition": (event % 8).cast("int"),
        "offset": event,
    }


def only(df: DataFrame, batch: int) -> DataFrame:
    return df.filter(F.col("batch") == batch)


def fact_rows(clean: DataFrame, ingested_at: datetime = AS_OF) -> DataFrame:
    return facts.fact_rows(clean, AS_OF, ingested_at, ["event_id"])
