"""Small helpers for literal rows."""

from datetime import datetime

from starflow import schemas

VISIT = schemas.CLEAN
VISIT_DEFAULTS = {
    "patient_id": "a",
    "gender": "Female",
    "age": 30,
    "department": "ICU",
    "admission_time": datetime(2026, 1, 1, 10),
    "discharge_time": datetime(2026, 1, 2, 10),
    "bed_id": 1,
    "hospital_id": 2,
}


def frame(spark, schema, *rows, **defaults):
    """Rows given as dicts over defaults; columns in neither are NULL."""
    full = [{**dict.fromkeys(schema.names), **defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in full], schema)


def visits(spark, *rows):
    return frame(spark, VISIT, *rows, **VISIT_DEFAULTS)


def as_set(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or sorted(df.columns))).collect()), key=str)
