"""Repairs and measures of one visit."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.functions.clock import instant

# Fixed values of the cleaning rule.
MAX_AGE = 100
CAPPED_AGE = 90


def admission_is_invalid(column: str, now: Column) -> Column:
    return F.col(column).isNull() | (F.col(column) > now)


def capped_age(column: str = "age") -> Column:
    """Ages above 100 become 90; NULL and negative ages stay as they are."""
    return F.when(F.col(column) > MAX_AGE, F.lit(CAPPED_AGE)).otherwise(F.col(column))


def stay_hours(admission: str = "admission_time", discharge: str = "discharge_time") -> Column:
    """Whole seconds between the two times, in hours; each side drops its fraction."""
    return (F.unix_timestamp(F.col(discharge)) - F.unix_timestamp(F.col(admission))) / 3600


def is_admitted(as_of: datetime | Column, like: T.DataType, discharge: str = "discharge_time") -> Column:
    """Discharge lies ahead of ``as_of``.  An open stay (no discharge) counts as discharged."""
    return F.when(F.col(discharge) > instant(as_of, like), F.lit(True)).otherwise(F.lit(False))
