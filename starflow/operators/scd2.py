"""Type-2 patient dimension: versions with an effective range.

``incoming`` is one row per patient as built by :func:`members`.  ``target`` is the
stored dimension.  The two merges of the classic form are :func:`expire` and
:func:`insert`; :func:`apply` does both in one join, and :func:`history` builds the
same versions for many batches at once.

With ``late_guard`` the dimension has one more column, ``attr_event_time``, and an
event older than the one already applied changes nothing.
"""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.functions.clock import instant
from starflow.functions.keys import fingerprint, patient_key
from starflow.operators.latest import latest_per_key
from starflow.operators.pairing import pair_rows

KEY = "patient_id"
ATTRS = ("gender", "age")
EVENT_TIME = "admission_time"
APPLIED = "attr_event_time"


def _carried(by: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([*by, EVENT_TIME, *ATTRS]))


def members(batch: DataFrame, by: Sequence[str] = (EVENT_TIME,), late_guard: bool = False) -> DataFrame:
    """Each patient's row that is greatest in ``by``, with key and fingerprint.

    Rows without a patient belong in quarantine; here they would match nothing and
    come back as a new version each time, so they are no members.
    """
    known = batch.filter(F.col(KEY).isNotNull())
    newest = latest_per_key(known.select(KEY, *_carried(by)), [KEY], by)
    extra = [F.col(EVENT_TIME).alias(APPLIED)] if late_guard else []
    return newest.select(
        patient_key(KEY).alias("patient_sk"), KEY, *ATTRS, fingerprint(ATTRS).alias("attr_hash"), *extra
    )


def _times(target: DataFrame, as_of: datetime | Column) -> tuple[Column, Column]:
    dtype = target.schema["effective_from"].dataType
    return instant(as_of, dtype), F.lit(None).cast(dtype)


def expire(target: DataFrame, incoming: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Merge 1: close the current version of every patient whose attributes changed."""
    now, _ = _times(target, as_of)
    news = incoming.select(
        F.col(KEY).alias("_key"), F.lit(True).alias("_live"), F.col("attr_hash").alias("_hash")
    )
    joined = target.join(news, (target[KEY] == news["_key"]) & (target["is_current"] == news["_live"]), "left")
    changed = F.col("_hash") != F.col("attr_hash")
    closed = {
        "effective_to": F.when(changed, now).otherwise(F.col("effective_to")),
        "is_current": F.when(changed, F.lit(False)).otherwise(F.col("is_current")),
    }
    return joined.select(*[closed[c].alias(c) if c in closed else F.col(c) for c in target.columns])


def insert(target: DataFrame, incoming: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Merge 2: a new current version for every patient that has none."""
    now, never = _times(target, as_of)
    current = target.filter("is_current").select(KEY)
    added = incoming.join(current, KEY, "left_anti").withColumns(
        {"effective_from": now, "effective_to": never, "is_current": F.lit(True)}
    )
    return target.unionByName(added.select(*target.columns))


def news(current: DataFrame, incoming: DataFrame, late_guard: bool = False) -> DataFrame:
    """The incoming members that :func:`apply` would change anything for.

    An anti join on unique keys that reads two columns of the dimension.
    """
    old, new = current.alias("o"), incoming.alias("n")
    if late_guard:  # a later event at least moves the time of the version
        settled = ~F.coalesce(F.col(f"n.{APPLIED}") > F.col(f"o.{APPLIED}"), F.lit(False))
    else:
        settled = F.col("o.attr_hash") == F.col("n.attr_hash")
    return new.join(old, (F.col(f"o.{KEY}") == F.col(f"n.{KEY}")) & settled, "left_anti")


def apply(
    target: DataFrame,
    incoming: DataFrame,
    as_of: datetime | Column,
    late_guard: bool = False,
    few: bool = False,
) -> DataFrame:
    """Both merges in one join.

    Each pair of current version and incoming row yields the version kept or closed,
    the new version, or both.  Closed versions never match and pass through; a
    caller that stores them apart passes current versions only and reads nothing
    else.  Both sides hold one current row per patient, so no key is hot.  Old
    ``effective_to`` and new ``effective_from`` are the same instant, and applying
    a batch again changes nothing.  For ``few`` see :func:`pair_rows`.
    """
    now, never = _times(target, as_of)
    columns = target.columns
    stored = target.select(
        F.col(KEY).alias("_key"), F.col("is_current").alias("_live"), F.struct(*columns).alias("old")
    )
    fresh = {"effective_from": now, "effective_to": never, "is_current": F.lit(True)}
    news = incoming.withColumns(fresh).select(
        F.col(KEY).alias("_key"), F.lit(True).alias("_live"), F.struct(*columns).alias("new")
    )
    pair = pair_rows(stored, news, ["_key", "_live"], few=few)

    changed = F.col("old.attr_hash") != F.col("new.attr_hash")
    kept = F.col("old")
    if late_guard:
        newer = F.col(f"new.{APPLIED}") > F.col(f"old.{APPLIED}")
        changed = newer & changed
        kept = F.when(newer, kept.withField(APPLIED, F.col(f"new.{APPLIED}"))).otherwise(kept)
    closed = F.col("old").withField("effective_to", now).withField("is_current", F.lit(False))
    rows = F.array(
        F.when(changed, closed).otherwise(kept),
        F.when(F.col("old").isNull() | changed, F.col("new")),
    )
    return pair.select(F.inline(F.array_compact(rows)))


def history(
    visits: DataFrame,
    batch: str,
    effective: Column,
    by: Sequence[str] = (EVENT_TIME,),
    late_guard: bool = False,
) -> DataFrame:
    """All versions that applying the batches one after the other would leave.

    ``batch`` numbers the arrivals and ``effective`` gives a batch's clock from it.
    The first shuffle is by (patient, batch) behind a partial aggregate, so a patient
    with a third of all rows is reduced to one row per map task and batch before it
    moves.  The second moves one row per patient and batch; only those meet in one
    window.
    """
    known = visits.filter(F.col(KEY).isNotNull())
    newest = latest_per_key(known.select(KEY, batch, *_carried(by)), [KEY, batch], by)
    arrivals = Window.partitionBy(KEY).orderBy(batch)
    rows = newest.select(batch, KEY, *ATTRS, EVENT_TIME, fingerprint(ATTRS).alias("attr_hash"))
    if late_guard:
        before = arrivals.rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_seen", F.max(EVENT_TIME).over(before))
        rows = rows.filter(F.col("_seen").isNull() | (F.col(EVENT_TIME) > F.col("_seen")))
    changes = rows.withColumn("_before", F.lag("attr_hash").over(arrivals)).filter(
        F.col("_before").isNull() | (F.col("_before") != F.col("attr_hash"))
    )
    ranged = changes.withColumn("effective_from", effective).withColumn(
        "effective_to", F.lead("effective_from").over(arrivals)
    )
    return ranged.select(
        patient_key(KEY).alias("patient_sk"),
        KEY,
        *ATTRS,
        "attr_hash",
        "effective_from",
        "effective_to",
        F.col("effective_to").isNull().alias("is_current"),
    )


def current_members(dimension: DataFrame) -> DataFrame:
    """Filtered, pruned lookup side: one row per patient."""
    return dimension.filter("is_current").select("patient_sk", KEY)
