"""Raw text to typed, repaired visits.

Every step is a narrow projection, so the whole stage is one pass over the raw
rows without a shuffle.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow import schemas
from starflow.functions import visit
from starflow.functions.clock import instant

MALFORMED = "malformed"
MISSING_KEY = "missing_key"


def parse_events(raw: DataFrame, schema: T.StructType = schemas.EVENT, text: str = "raw_json") -> DataFrame:
    """The JSON fields as columns, beside the text and whatever else the row has.

    Text that is no JSON object gives NULL in every field; a field of the wrong
    type gives NULL in that field only.  ``inline`` rather than field access: a
    filter on a parsed column then stays above the parse instead of repeating it.
    """
    return raw.select(*raw.columns, F.inline_outer(F.array(F.from_json(text, schema))))


def reject_reason(text: str = "raw_json", key: str = "patient_id") -> Column:
    """Why a parsed row cannot be used, or NULL.

    Only a missing key rejects a row: a damaged field elsewhere is NULL and the
    rest still counts.  The text is looked at again for rejected rows alone.
    """
    return (
        F.when(F.col(key).isNotNull(), F.lit(None).cast("string"))
        .when(F.json_object_keys(text).isNull(), F.lit(MALFORMED))
        .otherwise(F.lit(MISSING_KEY))
    )


def quarantine(parsed: DataFrame, text: str = "raw_json", key: str = "patient_id") -> DataFrame:
    """The unusable rows, untouched, with the reason."""
    fields = set(schemas.EVENT.names)
    carried = [c for c in parsed.columns if c not in fields]
    return parsed.filter(F.col(key).isNull()).select(*carried, reject_reason(text, key).alias("reason"))


def usable(parsed: DataFrame, text: str = "raw_json", key: str = "patient_id") -> DataFrame:
    return parsed.filter(F.col(key).isNotNull()).drop(text)


def parse_times(events: DataFrame, columns: tuple[str, ...] = ("admission_time", "discharge_time")) -> DataFrame:
    """Text times to timestamps; what does not parse becomes NULL.  Typed columns stay."""
    text = [c for c in columns if isinstance(events.schema[c].dataType, T.StringType)]
    return events.withColumns({c: F.try_to_timestamp(F.col(c)) for c in text}) if text else events


def repair_admission(events: DataFrame, as_of: datetime | Column, column: str = "admission_time") -> DataFrame:
    """A missing or future admission becomes ``as_of``; ``admission_repaired`` says so."""
    now = instant(as_of, events.schema[column].dataType)
    invalid = visit.admission_is_invalid(column, now)
    return events.withColumns(
        {column: F.when(invalid, now).otherwise(F.col(column)), "admission_repaired": invalid}
    )


def cap_age(events: DataFrame, column: str = "age") -> DataFrame:
    return events.withColumn(column, visit.capped_age(column))


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """The declared columns in their order; missing ones are typed NULLs.

    Other columns follow when ``keep_extra`` is set and are dropped otherwise.
    """
    have = set(df.columns)
    declared = [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    extra = [c for c in df.columns if c not in schema.names] if keep_extra else []
    return df.select(*declared, *extra)


def clean_visits(events: DataFrame, as_of: datetime | Column) -> DataFrame:
    """The whole stage behind the parse: times, admission, age, declared columns first."""
    repaired = cap_age(repair_admission(parse_times(events), as_of))
    return conform(repaired, schemas.CLEAN, keep_extra=True)
