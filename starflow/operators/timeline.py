"""Patient versions by the time of the events, whatever the order they arrive in.

A *point* is what the newest row of a patient and time says.  Points are stored; a version
begins at a point whose predecessor says something else, and ends where the next begins.
A late event is one more point: if it differs from the version that covers its time it
splits that version, if it agrees with the next one it moves the border, and else it
changes nothing.  All that must be known for it are the points of its own month, beside it.

Windows run over a patient's month.  What crosses from month to month goes through one row
for each of them, so a patient with very many events is split over tasks.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow import schemas
from starflow.functions.keys import fingerprint, patient_key
from starflow.operators.latest import latest_per_key

KEY = "patient_id"
TIME = "admission_time"
ATTRS = ("gender", "age")
MONTH = "event_month"
CHANGE = "is_change"


def points_schema(visits: T.StructType, order: Sequence[str] = ()) -> T.StructType:
    """Columns of the points of such visits; ``order`` are those that tell copies apart."""
    return T.StructType([visits[c] for c in dict.fromkeys([KEY, TIME, *ATTRS, *order])])


def marked_schema(points: T.StructType) -> T.StructType:
    return schemas.with_field(schemas.with_field(points, MONTH, T.StringType()), CHANGE, T.BooleanType())


def month(time: str = TIME) -> Column:
    return F.date_format(time, "yyyy-MM")


def points(visits: DataFrame, by: Sequence[str] = (TIME,)) -> DataFrame:
    """The row of each patient and time that is greatest in ``by``; rows without either are none."""
    known = visits.filter(F.col(KEY).isNotNull() & F.col(TIME).isNotNull())
    order = [c for c in by if c != TIME]
    return latest_per_key(known.select(KEY, TIME, *dict.fromkeys([*ATTRS, *order])), [KEY, TIME], order)


def insert(stored: DataFrame, incoming: DataFrame, by: Sequence[str] = (TIME,)) -> DataFrame:
    """Stored points with new ones among them; applying a batch again changes nothing."""
    return points(stored.unionByName(incoming), by).select(*stored.columns)


def marked(rows: DataFrame) -> DataFrame:
    """Points with their month, and whether they differ from the one before in it (the first does)."""
    inside = Window.partitionBy(KEY, MONTH).orderBy(TIME)
    hashed = rows.withColumn(MONTH, month())
    same = fingerprint(ATTRS) == F.lag(fingerprint(ATTRS)).over(inside)
    return hashed.withColumn(CHANGE, ~F.coalesce(same, F.lit(False)))


def versions(changes: DataFrame) -> DataFrame:
    """Type-2 versions from the points marked as changes of their month.

    The first one of a month is no change if the last one of an earlier month says the same.
    """
    inside = Window.partitionBy(KEY, MONTH).orderBy(TIME)
    rows = changes.select(KEY, MONTH, TIME, *ATTRS, fingerprint(ATTRS).alias("attr_hash"))
    rows = rows.withColumns({"_place": F.row_number().over(inside), "_next": F.lead(TIME).over(inside)})
    # one row for each patient and month
    ends = rows.groupBy(KEY, MONTH).agg(
        F.min_by("attr_hash", TIME).alias("_first"),
        F.max_by("attr_hash", TIME).alias("_last"),
        F.min(TIME).alias("_begin"),
        F.min(F.when(F.col("_place") == 2, F.col(TIME))).alias("_second"),
    )
    along = Window.partitionBy(KEY).orderBy(MONTH)
    repeats = F.coalesce(F.lag("_last").over(along) == F.col("_first"), F.lit(False))
    ends = ends.withColumn("_repeats", repeats)
    start = F.when(F.col("_repeats"), F.col("_second")).otherwise(F.col("_begin"))
    after = along.rowsBetween(1, Window.unboundedFollowing)
    ends = ends.withColumn("_later", F.min(start).over(after)).select(KEY, MONTH, "_repeats", "_later")
    found = rows.join(ends, [KEY, MONTH]).filter((F.col("_place") > 1) | ~F.col("_repeats"))
    until = F.coalesce("_next", "_later")
    return found.select(
        patient_key(KEY).alias("patient_sk"),
        KEY,
        *ATTRS,
        "attr_hash",
        F.col(TIME).alias("effective_from"),
        until.alias("effective_to"),
        until.isNull().alias("is_current"),
    )


def history(visits: DataFrame, by: Sequence[str] = (TIME,)) -> DataFrame:
    """The versions of all visits at once."""
    return versions(marked(points(visits, by)).filter(CHANGE))
