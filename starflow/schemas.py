"""Declared schemas of every layer.

Times are ``TIMESTAMP`` (an instant, shown in the session zone); ``as_ntz`` gives
the same schema for zone-free input.
"""

from pyspark.sql import types as T


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_STR, _INT, _TS = T.StringType(), T.IntegerType(), T.TimestampType()

RAW = _schema(("raw_json", _STR))

# What a broker says about a message; tells copies and ties apart later on.
BROKER = _schema(("topic", _STR), ("partition", _INT), ("offset", T.LongType()), ("timestamp", _TS))

# The event as it arrives: times are still text.
EVENT = _schema(
    ("patient_id", _STR),
    ("gender", _STR),
    ("age", _INT),
    ("department", _STR),
    ("admission_time", _STR),
    ("discharge_time", _STR),
    ("bed_id", _INT),
    ("hospital_id", _INT),
)

CLEAN = _schema(
    ("patient_id", _STR),
    ("gender", _STR),
    ("age", _INT),
    ("department", _STR),
    ("admission_time", _TS),
    ("discharge_time", _TS),
    ("bed_id", _INT),
    ("hospital_id", _INT),
)

PATIENT_DIM = _schema(
    ("patient_sk", _STR),
    ("patient_id", _STR),
    ("gender", _STR),
    ("age", _INT),
    ("attr_hash", _STR),
    ("effective_from", _TS),
    ("effective_to", _TS),
    ("is_current", T.BooleanType()),
)

DEPARTMENT_DIM = _schema(
    ("department", _STR),
    ("hospital_id", _INT),
    ("department_sk", _STR),
)

# The ten warehouse columns, then the rest of the natural key.  The key stays with
# the row because a 64-bit id alone cannot tell two colliding visits apart, and
# because an unresolved lookup can only be retried from it.
FACT = _schema(
    ("fact_id", T.LongType()),
    ("patient_sk", _STR),
    ("department_sk", _STR),
    ("admission_time", _TS),
    ("discharge_time", _TS),
    ("admission_date", T.DateType()),
    ("length_of_stay_hours", T.DoubleType()),
    ("is_currently_admitted", T.BooleanType()),
    ("bed_id", _INT),
    ("event_ingestion_time", _TS),
    ("patient_id", _STR),
    ("department", _STR),
    ("hospital_id", _INT),
)


# Partitions of the stored facts: a date, hash buckets of the id in it, and apart in each the
# facts that still lack a surrogate key.
DATE = "admission_date"
PENDING = "is_pending"


def as_ntz(schema: T.StructType) -> T.StructType:
    """The same schema with zone-free timestamps."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
            for f in schema.fields
        ]
    )


def with_field(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(name, dtype)])
