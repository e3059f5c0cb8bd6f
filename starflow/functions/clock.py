"""The explicit clock that stands in for the wall clock."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant(as_of: datetime | Column, like: T.DataType = T.TimestampType()) -> Column:
    """``as_of`` as a column of the timestamp type ``like``.

    A naive datetime is a wall-clock time of the session zone.  It goes in as text,
    because a datetime literal would be read in the zone of the Python process.
    A live stream passes ``F.current_timestamp()``, fixed once per micro-batch.
    """
    if isinstance(as_of, Column):
        return as_of.cast(like)
    text = F.lit(as_of.isoformat(sep=" "))
    if as_of.tzinfo is not None:
        return text.cast("timestamp").cast(like)
    return text.cast(like)
