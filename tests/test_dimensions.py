from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rows import as_set, frame, visits
from starflow import schemas
from starflow.operators import members, scd2
from starflow.operators.calendar import date_dimension
from starflow.operators.latest import latest_per_key
from starflow.sources.tables import empty

DIM = schemas.as_ntz(schemas.PATIENT_DIM)
GUARDED = schemas.with_field(DIM, scd2.APPLIED, T.TimestampNTZType())


def day(n):
    return datetime(2026, 1, n)


def batch(spark, *rows):
    """Rows as (patient, gender, age, admission day)."""
    made = visits(
        spark,
        *[{"patient_id": p, "gender": g, "age": a, "admission_time": None if d is None else day(d)} for p, g, a, d in rows],
    )
    return made.withColumn("admission_time", F.col("admission_time").cast("timestamp_ntz"))


def versions(df):
    got = df.select("patient_id", "gender", "age", "effective_from", "effective_to", "is_current").collect()
    return sorted(map(tuple, got), key=str)


def in_two_merges(target, rows, as_of):
    incoming = scd2.members(rows)
    return scd2.insert(scd2.expire(target, incoming, as_of), incoming, as_of)


def in_one_join(target, rows, as_of):
    return scd2.apply(target, scd2.members(rows), as_of)


@pytest.fixture(params=[in_two_merges, in_one_join])
def step(request):
    return request.param


def run(spark, step, *batches):
    dim = empty(spark, DIM)
    for n, rows in enumerate(batches, start=1):
        dim = step(dim, batch(spark, *rows), day(10 + n))
    return dim


def test_first_batch_inserts(spark, step):
    dim = run(spark, step, [("a", "F", 1, 1), ("b", "M", 2, 1)])
    assert versions(dim) == [("a", "F", 1, day(11), None, True), ("b", "M", 2, day(11), None, True)]


def test_unchanged_attributes_change_nothing(spark, step):
    assert versions(run(spark, step, [("a", "F", 1, 1)], [("a", "F", 1, 2)])) == [("a", "F", 1, day(11), None, True)]


def test_t2_a_change_closes_and_opens_at_one_instant(spark, step):
    assert versions(run(spark, step, [("a", "F", 1, 1)], [("a", "F", 2, 2)])) == [
        ("a", "F", 1, day(11), day(12), False),
        ("a", "F", 2, day(12), None, True),
    ]


def test_there_and_back_gives_three_versions(spark, step):
    dim = run(spark, step, [("a", "F", 1, 1)], [("a", "F", 2, 2)], [("a", "F", 1, 3)])
    assert [v[2:] for v in versions(dim)] == [
        (1, day(11), day(12), False),
        (1, day(13), None, True),
        (2, day(12), day(13), False),
    ]


def test_t9_one_version_per_batch_the_latest_row_wins(spark, step):
    assert versions(run(spark, step, [("a", "F", 1, 5), ("a", "F", 2, 3)])) == [("a", "F", 1, day(11), None, True)]


def test_replay_of_the_batch_changes_nothing(spark, step):
    rows = [("a", "F", 2, 2), ("c", "M", 3, 2)]
    once = run(spark, step, [("a", "F", 1, 1)], rows)
    assert versions(step(once, batch(spark, *rows), day(20))) == versions(once)


def test_crash_between_the_merges_heals_on_replay(spark):
    old = run(spark, in_one_join, [("a", "F", 1, 1)])
    rows = batch(spark, ("a", "F", 2, 2))
    half = scd2.expire(old, scd2.members(rows), day(12))
    assert [v[-1] for v in versions(half)] == [False]
    assert versions(in_two_merges(half, rows, day(12))) == versions(in_one_join(old, rows, day(12)))


def test_null_attribute_counts_as_na(spark, step):
    dim = run(spark, step, [("a", None, 1, 1)], [("a", "NA", 1, 2)])
    assert versions(dim) == [("a", None, 1, day(11), None, True)]


def test_t10_rows_without_a_patient_are_no_members(spark, step):
    assert versions(run(spark, step, [(None, "F", 1, 1)], [(None, "F", 1, 1)])) == []


def test_t5_ties_do_not_depend_on_row_order(spark):
    rows = [("a", "F", 1, 1), ("a", "M", 2, 1), ("a", "F", 9, 1)]
    assert as_set(scd2.members(batch(spark, *rows))) == as_set(scd2.members(batch(spark, *rows[::-1])))


def test_latest_row_against_brute_force(spark, data):
    from starflow.plans import visits as v

    rows = v.silver(spark, data).select("patient_id", "admission_time", "event_id", "gender")
    best = {}
    for r in rows.collect():
        key = (r.admission_time, r.event_id)
        if r.patient_id not in best or key > best[r.patient_id][0]:
            best[r.patient_id] = (key, r)
    got = latest_per_key(rows, ["patient_id"], ["admission_time", "event_id"])
    assert as_set(got) == sorted((tuple(r[c] for c in sorted(got.columns)) for _, r in best.values()), key=str)


def test_late_events_replace_by_default_and_not_under_the_guard(spark):
    first, late = [("a", "F", 1, 8)], [("a", "F", 2, 3)]
    assert [v[2] for v in versions(run(spark, in_one_join, first, late))] == [1, 2]
    dim = empty(spark, GUARDED)
    for n, rows in enumerate([first, late]):
        dim = scd2.apply(dim, scd2.members(batch(spark, *rows), late_guard=True), day(11 + n), late_guard=True)
    assert versions(dim) == [("a", "F", 1, day(11), None, True)]


def test_guard_advances_with_equal_attributes(spark):
    dim = empty(spark, GUARDED)
    # Day 8 repeats the attributes; day 6 then comes too late to change them.
    for n, row in enumerate([("a", "F", 1, 2), ("a", "F", 1, 8), ("a", "F", 5, 6)]):
        dim = scd2.apply(dim, scd2.members(batch(spark, row), late_guard=True), day(11 + n), late_guard=True)
    assert versions(dim) == [("a", "F", 1, day(11), None, True)]
    assert dim.first()[scd2.APPLIED] == day(8)


def test_history_equals_the_batches_one_by_one(spark, data):
    from starflow.plans import batch as plans

    assert versions(plans.scd2_history(spark, data)) == versions(plans.scd2_step(spark, data))


def test_department_members_and_merge(spark):
    seen = visits(spark, {}, {}, {"hospital_id": None}, {"department": None})
    dim = members.department_members(seen)
    assert as_set(dim, "department", "hospital_id") == [("ICU", 2), ("ICU", None), (None, 2)]
    again = members.insert_absent(dim, members.department_members(visits(spark, {"hospital_id": None}, {"hospital_id": 9})))
    assert as_set(again, "department", "hospital_id") == [("ICU", 2), ("ICU", 9), ("ICU", None), (None, 2)]


def test_insert_absent_never_updates(spark):
    target = frame(spark, schemas.DEPARTMENT_DIM, {"department": "ICU", "hospital_id": 2, "department_sk": "old"})
    merged = members.insert_absent(target, members.department_members(visits(spark, {})))
    assert as_set(merged, "department_sk") == [("old",)]


def test_date_dimension_spans_all_days(spark):
    df = spark.createDataFrame([(day(30).date(),), (datetime(2026, 2, 2).date(),), (None,)], "admission_date date")
    got = as_set(date_dimension(df), "month", "day", "day_of_week", "week_of_year")
    assert got == [(1, 30, 6, 5), (1, 31, 7, 5), (2, 1, 1, 5), (2, 2, 2, 6)]
    assert date_dimension(df.limit(0)).isEmpty()
