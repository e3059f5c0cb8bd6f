"""Versions by event time, and streams that remember keys for a while."""

import os
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import as_set, visits
from starflow import files, schemas
from starflow.operators import members, timeline
from starflow.plans import streams
from starflow.plans import visits as v
from starflow.sinks import snapshots
from starflow.sources import tables
from starflow.streaming import jobs

POINTS = timeline.points_schema(schemas.CLEAN, ["bed_id"])
BY = ("admission_time", "bed_id")


def brute_force(rows):
    """(patient, gender, age, from, to) by the plain reading: order, drop repeats, link."""
    newest = {}
    for r in rows:
        if r["patient_id"] is not None:
            key = (r["patient_id"], r["admission_time"])
            newest[key] = max(newest.get(key, r), r, key=lambda x: x["bed_id"])
    out = []
    for patient in {p for p, _ in newest}:
        mine, kept = sorted(t for p, t in newest if p == patient), []
        for t in mine:
            what = (newest[patient, t]["gender"], newest[patient, t]["age"])
            if not kept or kept[-1][1] != what:
                kept.append((t, what))
        for (t, what), after in zip(kept, [*kept[1:], (None, None)]):
            out.append((patient, *what, t, after[0]))
    return sorted(out, key=str)


def got(df):
    rows = df.select("patient_id", "gender", "age", "effective_from", "effective_to", "is_current").collect()
    assert all(r.is_current == (r.effective_to is None) for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=str)


def some_rows(seed, n=80):
    r = random.Random(seed)
    return [
        {
            "patient_id": r.choice([*"abc", None]),
            "gender": "Female",
            "age": r.choice([1, 2, None]),
            "admission_time": datetime(2026, r.randint(1, 4), r.randint(1, 28), r.choice([0, 12])),
            "bed_id": k,
        }
        for k in range(n)
    ]


def stream_in(spark, base, rows, keep=None):
    visits(spark, *rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = tables.scan_stream(spark, f"{base}/in", schemas.CLEAN)
    jobs.patient_timeline(stream, f"{base}/t", f"{base}/cp", schema=POINTS, by=BY, buckets=2, keep=keep)
    return jobs.read_timeline(spark, f"{base}/t", POINTS, buckets=2)


@pytest.mark.parametrize("seed", range(3))
def test_all_at_once_against_a_plain_reading(spark, seed):
    rows = some_rows(seed)
    assert got(timeline.history(visits(spark, *rows), BY)) == brute_force(rows)


@pytest.mark.parametrize("cuts", [(80,), (10, 40, 41, 80), (30, 60, 80)])
def test_batches_in_any_order_give_the_same_history(spark, tmp_path, cuts):
    rows, start = some_rows(7), 0
    for stop in cuts:
        out = stream_in(spark, str(tmp_path), rows[start:stop])
        start = stop
        assert got(out) == brute_force(rows[:stop])


def bucket_of(patient):
    from starflow.functions.keys import hash_bucket
    from pyspark.sql import SparkSession

    return str(SparkSession.active().range(1).select(hash_bucket(F.lit(patient), 2)).first()[0])


def day(n, month=1):
    return datetime(2026, month, n)


def test_a_late_event_splits_a_version_moves_a_border_or_changes_nothing(spark, tmp_path):
    at = lambda when, age: {"patient_id": "a", "age": age, "admission_time": when}
    base, seen = str(tmp_path), [at(day(1), 1), at(day(9), 1), at(day(20), 2), at(day(5, 3), 2)]
    stream_in(spark, base, seen)
    for late, want in (
        (at(day(5), 3), [(1, 1), (3, 5), (1, 9), (2, 20)]),  # splits; the row of the 9th begins a version now
        (at(day(15), 2), [(1, 1), (3, 5), (1, 9), (2, 15)]),  # moves the border
        (at(day(10), 1), [(1, 1), (3, 5), (1, 9), (2, 15)]),  # says what was known
        (at(day(2, 2), 4), [(1, 1), (3, 5), (1, 9), (2, 15), (4, 2), (2, 5)]),  # another month
    ):
        out = stream_in(spark, base, [late])
        seen.append(late)
        rows = out.orderBy("effective_from").collect()
        assert [(r.age, r.effective_from.day) for r in rows] == want
        assert [r.effective_to for r in rows] == [r.effective_from for r in rows[1:]] + [None]


def test_a_batch_writes_the_months_and_buckets_of_its_events(spark, tmp_path):
    base = str(tmp_path)
    many = [{"patient_id": f"p{k}", "admission_time": datetime(2026, 1 + k % 4, 3)} for k in range(40)]
    stream_in(spark, base, many)
    out = stream_in(spark, base, [{"patient_id": "p1", "age": 9, "admission_time": datetime(2026, 2, 1)}])
    assert [f for f in os.listdir(f"{base}/t/v=1") if "=" in f] == ["event_month=2026-02"]
    assert len(os.listdir(f"{base}/t/v=1/event_month=2026-02")) == 1
    assert out.count() == 41


def test_the_history_opens_rows_that_change_something_only(spark, tmp_path):
    base = str(tmp_path)
    out = stream_in(spark, base, [{"admission_time": datetime(2026, 1, d)} for d in range(1, 20)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1 and "PartitionFilters: [isnotnull(is_change" in plan
    assert sorted(os.listdir(f"{base}/t/v=0/event_month=2026-01/bucket_of_2=" + bucket_of("a"))) == ["is_change=false", "is_change=true"]


def test_a_replayed_batch_changes_nothing_and_old_files_go(spark, tmp_path):
    base, rows = str(tmp_path), some_rows(3, 30)
    for part in (rows[:10], rows[10:20], rows[20:]):
        stream_in(spark, base, part, keep=2)
    files.delete(spark, f"{base}/cp/commits/2")
    stream = tables.scan_stream(spark, f"{base}/in", schemas.CLEAN)
    jobs.patient_timeline(stream, f"{base}/t", f"{base}/cp", schema=POINTS, by=BY, buckets=2)
    assert snapshots.versions(spark, f"{base}/t")[-1] == 3
    assert got(jobs.read_timeline(spark, f"{base}/t", POINTS, buckets=2)) == brute_force(rows)


@pytest.mark.parametrize("arrival", ["batch", "(batch + 1) % 3", "event_id % 4"])
def test_three_splits_of_the_events_give_one_history(spark, data, tmp_path, arrival):
    rows = v.silver(spark, data).select(*streams.TIMELINE.names, F.expr(f"CAST({arrival} AS INT)").alias("batch"))
    job = lambda s: jobs.patient_timeline(s, f"{tmp_path}/t", f"{tmp_path}/cp", schema=streams.TIMELINE, by=v.LATEST, buckets=4)
    streams.feed(rows, f"{tmp_path}/in", range(4 if "4" in arrival else 3), job)
    found = jobs.read_timeline(spark, f"{tmp_path}/t", streams.TIMELINE, buckets=4)
    assert as_set(found) == as_set(timeline.history(v.silver(spark, data), v.LATEST))


# --- keys remembered within a horizon ---


def reports(spark, path, *rows):
    df = spark.createDataFrame([(k, datetime(2026, 1, d)) for k, d in rows], "k string, t timestamp")
    df.coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)
    return tables.scan_stream(spark, path, df.schema)


def test_copies_go_within_the_horizon_and_come_again_beyond_it(spark, tmp_path):
    base, sizes = str(tmp_path), []
    for batch in ([("a", 1), ("a", 1)], [("a", 3), ("b", 4)], [("c", 12)], [("a", 13), ("b", 13)], [("late", 2), ("a", 14)]):
        stream = reports(spark, f"{base}/in", *batch)
        query = jobs.distinct_rows(stream, f"{base}/out", f"{base}/cp", keys=["k"], time="t", horizon="3 days")
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    want = [("a", day(1)), ("b", day(4)), ("c", day(12)), ("a", day(13)), ("b", day(13))]
    assert as_set(tables.scan(spark, f"{base}/out")) == sorted(want, key=str)
    assert sizes == [1, 2, 1, 3, 3]  # the 12th lets a and b go


def test_the_state_holds_the_horizon_and_not_all_keys(spark, tmp_path):
    base, sizes = str(tmp_path), []
    for n in range(6):
        stream = reports(spark, f"{base}/in", *[(f"{n}-{k}", 1 + 4 * n) for k in range(50)])
        query = jobs.distinct_rows(stream, f"{base}/out", f"{base}/cp", keys=["k"], time="t", horizon="3 days")
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert tables.scan(spark, f"{base}/out").count() == 300 and max(sizes) <= 100


def test_departments_with_a_horizon_are_the_same(spark, data, tmp_path):
    base = str(tmp_path)
    rows = v.silver(spark, data).select("department", "hospital_id", "batch", F.timestamp_seconds(F.col("batch") * 100).alias("t"))

    def job(stream):
        jobs.department_dimension(stream, f"{base}/dim", f"{base}/cp", time="t", horizon="1 hour", clock=v.batch_clock)

    streams.feed(rows, f"{base}/in", v.BATCHES, job)
    found = as_set(snapshots.read_increments(spark, f"{base}/dim", schemas.DEPARTMENT_DIM))
    assert found == as_set(members.department_members(v.silver(spark, data)).select(*schemas.DEPARTMENT_DIM.names))
    files.delete(spark, f"{base}/cp/commits/{max(int(n) for n in os.listdir(f'{base}/cp/commits') if n.isdigit())}")
    job(tables.scan_stream(spark, f"{base}/in", rows.schema))
    assert as_set(snapshots.read_increments(spark, f"{base}/dim", schemas.DEPARTMENT_DIM)) == found


def test_star_has_both(spark, tmp_path):
    from starflow.star import Star
    from test_streams import Broker, event

    star, source = Star(spark, str(tmp_path / "star")), Broker(spark, str(tmp_path / "messages"))
    for admission, age in (("2026-01-05T10:00:00", 31), ("2026-01-01T10:00:00", 30)):
        source.send(event(age=age, admission_time=admission))
        star.land(source.stream())
        star.clean()
        star.dim_department(horizon="1 day")
        star.timeline()
    assert as_set(star.patients_by_event_time(), "age", "is_current") == [(30, False), (31, True)]
    assert star.departments().count() == 1
    with pytest.raises(ValueError, match="timestamp"):
        Star(spark, str(tmp_path / "other"), schemas.T.StructType([])).dim_department(horizon="1 day")
