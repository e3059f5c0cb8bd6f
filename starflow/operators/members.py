"""Insert-only department dimension."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starflow.functions.keys import department_key
from starflow.operators.pairing import matching

KEYS = ("department", "hospital_id")


def department_members(visits: DataFrame) -> DataFrame:
    """Distinct (department, hospital) with its key.

    De-duplicated inside a batch; the merge takes care of earlier batches, so a
    stream needs no state.  The partial aggregate runs before the shuffle.
    """
    return visits.select(*KEYS).dropDuplicates(list(KEYS)).withColumn("department_sk", department_key(KEYS))


def distinct_within(rows: DataFrame, keys: Sequence[str], time: str, horizon: str) -> DataFrame:
    """The first row of each key, again once its time lies beyond the horizon; for streams.

    Keys wait in the state store until the watermark, the latest time seen less ``horizon``,
    passes their own time and the horizon; so the state holds the keys of about twice the
    horizon, not of all time.  A copy that comes while its key is held is dropped, one that
    comes later is taken as new, and a row older than the watermark is dropped as late.
    """
    return rows.withWatermark(time, horizon).dropDuplicatesWithinWatermark(list(keys))


def absent(target: DataFrame, incoming: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Incoming rows whose key the target lacks; null-safe, as NULL is a member like any other."""
    t, s = target.select(*keys).alias("t"), incoming.alias("s")
    return s.join(t, matching("s", "t", [], keys), "left_anti")


def insert_absent(target: DataFrame, incoming: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Target plus the missing incoming rows; nothing stored is changed."""
    return target.unionByName(absent(target, incoming, keys).select(*target.columns))
