from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rows import as_set, visits
from starflow import schemas
from starflow.operators import cleaning
from starflow.sources.tables import literal_events

NOW = datetime(2026, 1, 31)


def parsed(spark, *texts):
    return cleaning.parse_events(literal_events(spark, texts))


def one(spark, text):
    return parsed(spark, text).drop("raw_json").first().asDict()


def test_json_sets_the_fields_that_are_there(spark):
    row = one(spark, '{"patient_id":"a","age":87,"bed_id":3}')
    assert {k: v for k, v in row.items() if v is not None} == {"patient_id": "a", "age": 87, "bed_id": 3}


@pytest.mark.parametrize(
    "text", ["not json", "null", '[{"patient_id":"arr"}]', '{"patient_id":"trunc","age":4', "", None]
)
def test_json_that_is_no_object_is_all_null_and_malformed(spark, text):
    assert set(one(spark, text).values()) == {None}
    bad = cleaning.quarantine(parsed(spark, text)).first()
    assert (bad.raw_json, bad.reason) == (text, "malformed")


@pytest.mark.parametrize("age", ['"87"', "87.5", "99999999999"])
def test_a_damaged_field_does_not_reject_the_row(spark, age):
    text = f'{{"patient_id":"b","age":{age},"bed_id":4}}'
    row = cleaning.usable(parsed(spark, text)).first()
    assert (row.patient_id, row.age, row.bed_id) == ("b", None, 4)
    assert cleaning.quarantine(parsed(spark, text)).isEmpty()


def test_json_number_as_key_becomes_text_and_extra_fields_are_ignored(spark):
    assert one(spark, '{"patient_id":5,"age":1,"extra":true}')["patient_id"] == "5"


@pytest.mark.parametrize("text", ['{"Patient_ID":"e","age":1}', '{"age":"87"}', "{}", '{"patient_id":null}'])
def test_t10_an_object_without_a_patient_is_quarantined(spark, text):
    assert cleaning.quarantine(parsed(spark, text)).first().reason == "missing_key"


def test_quarantine_and_usable_split_the_rows(spark):
    rows = parsed(spark, '{"patient_id":"a"}', "junk", '{"age":1}').withColumn("offset", F.lit(1))
    assert cleaning.usable(rows).count() == 1
    assert as_set(cleaning.quarantine(rows), "reason") == [("malformed",), ("missing_key",)]
    assert cleaning.quarantine(rows).columns == ["raw_json", "offset", "reason"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-02-05T19:56:03.123148", datetime(2026, 2, 5, 19, 56, 3, 123148)),
        ("2026-02-05", datetime(2026, 2, 5)),
        ("2026-02-05T10:00:00Z", datetime(2026, 2, 5, 10)),
        ("2026-02-05T10:00:00+02:00", datetime(2026, 2, 5, 8)),
        ("x", None),
        ("05/02/2026", None),
        (None, None),
    ],
)
def test_times_parse_or_become_null_under_ansi(spark, text, expected):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(text, None)], "admission_time string, discharge_time string")
    got = cleaning.parse_times(df).select(F.col("admission_time").cast("timestamp_ntz")).first()[0]
    assert got == expected


def test_admission_is_clamped_and_marked(spark):
    rows = visits(
        spark,
        {"patient_id": "ok"},
        {"patient_id": "none", "admission_time": None},
        {"patient_id": "future", "admission_time": datetime(2027, 1, 1)},
        {"patient_id": "edge", "admission_time": NOW},
    )
    zone_free = rows.withColumn("admission_time", F.col("admission_time").cast("timestamp_ntz"))
    got = {
        r.patient_id: (r.admission_time, r.admission_repaired)
        for r in cleaning.repair_admission(zone_free, NOW).collect()
    }
    assert got["ok"][1] is False
    assert got["none"] == (NOW, True) and got["future"] == (NOW, True)
    assert got["edge"] == (NOW, False)


def test_t3_repair_is_deterministic_for_a_fixed_clock(spark):
    rows = visits(spark, {"admission_time": None})
    assert as_set(cleaning.clean_visits(rows, NOW)) == as_set(cleaning.clean_visits(rows, NOW))


def test_age_is_capped(spark):
    ages = [(100,), (101,), (150,), (-3,), (None,)]
    got = [r.age for r in cleaning.cap_age(spark.createDataFrame(ages, "age int")).collect()]
    assert got == [100, 90, 90, -3, None]


def test_conform_fills_and_orders(spark):
    df = spark.createDataFrame([(1, "a", "x")], "bed_id int, patient_id string, extra string")
    out = cleaning.conform(df, schemas.CLEAN)
    assert out.columns == schemas.CLEAN.names
    assert out.schema["hospital_id"].dataType == T.IntegerType()
    assert cleaning.conform(df, schemas.CLEAN, keep_extra=True).columns[-1] == "extra"


def test_whole_stage_keeps_what_travels_along(spark):
    raw = literal_events(spark, ['{"patient_id":"a","age":120,"admission_time":"bad"}']).withColumn("offset", F.lit(7))
    out = cleaning.clean_visits(cleaning.usable(cleaning.parse_events(raw)), NOW).first()
    assert (out.age, out.admission_repaired, out.offset) == (90, True, 7)


def test_cleaning_does_not_shuffle(spark, data):
    from starflow.plans import batch

    plan = batch.silver_visits(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
