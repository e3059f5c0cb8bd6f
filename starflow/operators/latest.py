"""One row per key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest in ``by``; the other columns break ties.

    NULL is the least value, as in a descending window.  Written as an aggregate
    rather than ``row_number() = 1``: its partial half sends one row per key and map
    task, however hot the key, and it sorts by the keys alone.  Name the key with
    the most values first, since its leading bytes are what the sort compares.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*by, *rest)).alias("_newest"))
    return newest.select(*[F.col(c) if c in keys else F.col("_newest")[c].alias(c) for c in df.columns])
