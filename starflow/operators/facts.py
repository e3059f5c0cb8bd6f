"""Visits to facts: measures, one row per visit, lookups, upsert."""

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow import schemas
from starflow.functions import visit
from starflow.functions.clock import instant
from starflow.functions.keys import row_id
from starflow.operators.pairing import matching, pair_rows

NATURAL_KEY = ("patient_id", "department", "hospital_id", "admission_time")
DETAILS = ("discharge_time", "bed_id")
REFRESHED = ("discharge_time", "length_of_stay_hours", "is_currently_admitted", "event_ingestion_time")
LOOKED_UP = ("patient_sk", "department_sk")
COLUMNS = tuple(schemas.FACT.names)


def measures(visits: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Date, length of stay, the admitted flag and the open-stay flag beside it."""
    like = visits.schema["discharge_time"].dataType
    return visits.withColumns(
        {
            "admission_date": F.to_date("admission_time"),
            "length_of_stay_hours": visit.stay_hours(),
            "is_currently_admitted": visit.is_admitted(as_of, like),
            "is_open_stay": F.col("discharge_time").isNull(),
        }
    )


def arrival_order(time: str = "timestamp", partition: str = "partition", offset: str = "offset") -> Column:
    """The broker's time, partition and offset as one number that no other message has.

    A decimal has a fixed width, so aggregates by it work by hash.  Its 38 digits are 14
    of milliseconds (a broker's times have no finer part), 5 of the partition and 19 of
    the offset; a partition above 99,999 is an error.  Rows without a position, as written
    by hand, come before all others, by discharge and bed; NULL is least in both.
    """

    def shifted(number: Column, digits: int) -> Column:
        return number.cast("decimal(18,0)") * F.lit(Decimal(10**digits))

    refused = F.raise_error(F.lit("a partition above 99999 has no place in arrival_order")).cast("int")
    part = F.when(F.col(partition) < 100_000, F.col(partition)).otherwise(refused)
    known = shifted(F.unix_millis(F.col(time).cast("timestamp")), 24) + shifted(part, 19) + F.col(offset)
    # 1 upwards, from the year 0 and from the least integer on
    left = F.coalesce(F.unix_micros(F.col("discharge_time").cast("timestamp")) + 63 * 10**15, F.lit(0))
    bed = F.coalesce(F.col("bed_id").cast("long") + (1 << 31) + 1, F.lit(0))
    unknown = shifted(left, 10) + bed - F.lit(Decimal(10**37))
    has = F.col(time).isNotNull() & F.col(partition).isNotNull() & F.col(offset).isNotNull()
    return F.when(has, known.cast("decimal(38,0)")).otherwise(unknown.cast("decimal(38,0)"))


def fact_rows(
    visits: DataFrame,
    as_of: datetime | Column,
    ingested_at: datetime | Column | None = None,
    by: Sequence[str] | Column = DETAILS,
) -> DataFrame:
    """One fact per visit, without surrogate keys yet.

    Of the copies of a visit the one greatest in ``by`` counts.  A single column in
    ``by`` must be unique, such as an event number, and so must an expression, such as
    :func:`arrival_order`: then every buffer has a fixed width and Spark aggregates by
    hash instead of sorting.  Copies are reduced before the shuffle.  The id leads the grouping, as it spreads evenly and tells
    most rows apart in one comparison.
    """
    if isinstance(by, Column):
        first = by
    else:
        first = F.col(by[0]) if len(by) == 1 else F.struct(*dict.fromkeys([*by, *DETAILS]))
    one = (
        visits.withColumn("fact_id", row_id(NATURAL_KEY))
        .groupBy("fact_id", *NATURAL_KEY)
        .agg(*[F.max_by(c, first).alias(c) for c in DETAILS])
    )
    stamp = instant(as_of if ingested_at is None else ingested_at, visits.schema["admission_time"].dataType)
    measured = measures(one, as_of).withColumn("event_ingestion_time", stamp)
    return measured.select(*[c for c in COLUMNS if c not in LOOKED_UP])


def lookup(facts: DataFrame, dimension: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left outer lookup: the dimension's other columns, NULL where nothing matches.

    No hint is given.  The dimension is a stored table in practice, so Spark knows
    its bytes and broadcasts it only below ``autoBroadcastJoinThreshold``; above
    that the join shuffles and AQE splits a hot key of the fact side.
    """
    f, d = facts.alias("f"), dimension.alias("d")
    match = matching("f", "d", [], keys) if null_safe else matching("f", "d", keys)
    added = [F.col(f"d.{c}") for c in dimension.columns if c not in keys]
    return f.join(d, match, "left").select("f.*", *added)


def lookup_patient(facts: DataFrame, patients: DataFrame) -> DataFrame:
    return lookup(facts, patients.select("patient_sk", "patient_id"), ["patient_id"])


def lookup_department(facts: DataFrame, departments: DataFrame) -> DataFrame:
    """Null-safe, so a department without a hospital finds its member too."""
    keys = ["department", "hospital_id"]
    return lookup(facts, departments.select("department_sk", *keys), keys, null_safe=True)


def enrich(facts: DataFrame, patients: DataFrame, departments: DataFrame) -> DataFrame:
    """Both lookups, in the declared column order.  ``patients`` holds current members."""
    return lookup_department(lookup_patient(facts, patients), departments).select(*COLUMNS)


def unresolved(facts: DataFrame) -> DataFrame:
    """Facts with a failed lookup, and which one failed."""
    return facts.filter(F.col("patient_sk").isNull() | F.col("department_sk").isNull()).withColumns(
        {
            "patient_missing": F.col("patient_sk").isNull(),
            "department_missing": F.col("department_sk").isNull(),
        }
    )


def resolve(facts: DataFrame, patients: DataFrame, departments: DataFrame) -> DataFrame:
    """Look up again what is still unresolved; keys already set stay."""
    bare = facts.withColumnsRenamed({c: f"_{c}" for c in LOOKED_UP})
    found = lookup_department(lookup_patient(bare, patients), departments)
    return found.withColumns({c: F.coalesce(f"_{c}", c) for c in LOOKED_UP}).select(*facts.columns)


def upsert(target: DataFrame, incoming: DataFrame, few: bool = False) -> DataFrame:
    """Target with the incoming facts merged in; ``incoming`` has one row per visit.

    A matched fact takes the four refreshed columns from the incoming row, keeps its
    bed, and keeps each surrogate key unless that is NULL.  Others are inserted.
    The join hashes on ``fact_id``, which spreads evenly, and compares the natural
    key too, so two visits whose ids collide stay apart.  For ``few`` see :func:`pair_rows`.
    """
    key = ["fact_id", *NATURAL_KEY]
    stored = target.select(*key, F.struct(*COLUMNS).alias("old"))
    arrived = incoming.select(*key, F.struct(*COLUMNS).alias("new"))
    pair = pair_rows(stored, arrived, ["fact_id"], NATURAL_KEY, few)

    def merged(name: str) -> Column:
        old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in REFRESHED:
            return F.when(F.col("new").isNotNull(), new).otherwise(old)
        if name in LOOKED_UP:
            return F.coalesce(old, new)
        return F.when(F.col("old").isNotNull(), old).otherwise(new)

    return pair.select(*[merged(c).alias(c) for c in COLUMNS])
