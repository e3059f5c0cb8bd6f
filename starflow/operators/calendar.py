"""Date dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_dimension(facts: DataFrame, column: str = "admission_date") -> DataFrame:
    """Every day from the first to the last date, with its calendar parts.

    One min/max pass over the facts; the days themselves number a few hundred a year.
    """
    span = facts.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = span.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("day_of_week"),
        F.weekofyear("date").alias("week_of_year"),
    )
