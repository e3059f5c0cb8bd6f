"""What a batch of facts, a second lookup, an export and the stored counts read and write."""

import os
import random
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rows import as_set, frame, visits
from starflow import files, schemas
from starflow.operators import facts, kpi, members, scd2
from starflow.sinks import serving, snapshots
from starflow.sources import tables
from starflow.streaming import jobs

COLUMNS = [schemas.DATE, snapshots.BUCKETS]


class Facts:
    """A fact table fed batch by batch; dimensions are set from outside."""

    def __init__(self, spark, base, buckets=4):
        self.spark, self.base, self.path, self.buckets = spark, base, f"{base}/fact", buckets
        self.patients = spark.createDataFrame([], "patient_sk string, patient_id string")
        self.departments = tables.empty(spark, schemas.DEPARTMENT_DIM)

    def know(self, *rows):
        seen = visits(self.spark, *rows)
        self.patients = scd2.members(seen).select("patient_sk", "patient_id")
        self.departments = members.department_members(seen)

    def batch(self, *rows, **options):
        visits(self.spark, *rows).coalesce(1).write.mode("append").parquet(f"{self.base}/in")
        jobs.fact_table(
            tables.scan_stream(self.spark, f"{self.base}/in", schemas.CLEAN),
            self.path,
            f"{self.base}/cp",
            **{"buckets": self.buckets, "as_of": datetime(2026, 1, 31), "keep": None, **self.lookups(), **options},
        )
        return jobs.read_facts(self.spark, self.path)

    def lookups(self):
        return {"patients": lambda _: self.patients, "departments": lambda _: self.departments}

    def resolve(self):
        return jobs.resolve_facts(self.spark, self.path, buckets=self.buckets, keep=None, **self.lookups())


@pytest.fixture
def table(spark, tmp_path):
    return Facts(spark, str(tmp_path))


def on(day, patient, **more):
    return {"patient_id": patient, "admission_time": datetime(2026, 1, day, 10), **more}


def folders(path, version):
    """Partition folders of a version that hold files."""
    top = f"{path}/v={version}"
    return {d[len(top) + 1 :] for d, _, names in os.walk(top) if any(n.startswith("part-") for n in names)}


def test_a_small_batch_on_a_hot_date_moves_its_buckets_only(table):
    table.buckets = 16
    table.batch(*[on(5, f"p{k}") for k in range(400)], *[on(6, f"p{k}") for k in range(20)])
    assert len(folders(table.path, 0)) >= 16 + 10
    out = table.batch(*[on(5, f"new{k}") for k in range(9)], on(5, "p7", discharge_time=datetime(2026, 1, 9)))
    touched = folders(table.path, 1)
    assert 1 <= len(touched) <= 10 and all(f.startswith("admission_date=2026-01-05/") for f in touched)
    assert out.count() == 429 and out.filter("patient_id = 'p7'").count() == 2
    live = [r[0] for r in out.select(F.input_file_name()).distinct().collect()]
    assert sum("/v=1/" in f for f in live) == len(touched)


def test_a_batch_reads_the_buckets_it_touches(table, monkeypatch):
    table.batch(*[on(d, f"p{k}") for d in (5, 6) for k in range(40)])
    asked, read = [], snapshots.read_partitions
    monkeypatch.setattr(snapshots, "read_partitions", lambda *a, **k: asked.append(k["only"] and set(k["only"])) or read(*a, **k))
    table.batch(on(6, "p1"), on(6, "p1"))
    assert len(asked[0]) == 1 and next(iter(asked[0]))[0] == "2026-01-06" and asked[1:] == [None]  # the last by the test


@pytest.mark.parametrize("buckets", [1, 3])
def test_buckets_do_not_change_the_facts(spark, tmp_path, buckets):
    r, table, want = random.Random(buckets), Facts(spark, str(tmp_path), buckets), {}
    for _ in range(3):
        rows = [on(r.randint(1, 3), r.choice("abcdef"), bed_id=r.randint(1, 9), discharge_time=datetime(2026, 1, r.randint(4, 28))) for _ in range(8)]
        newest = {}
        for row in rows:
            key = (row["patient_id"], row["admission_time"])
            newest[key] = max(newest.get(key, row), row, key=lambda x: (x["discharge_time"], x["bed_id"]))
        for key, row in newest.items():
            want[key] = (row["discharge_time"], want[key][1] if key in want else row["bed_id"])
        got = table.batch(*rows)
        assert as_set(got, "patient_id", "admission_time", "discharge_time", "bed_id") == sorted(((*k, *v) for k, v in want.items()), key=str)


def test_another_number_of_buckets_is_refused(table):
    table.batch(on(1, "a"))
    with pytest.raises(StreamingQueryException, match="not in 2 buckets"):
        table.batch(on(1, "b"), buckets=2)


def test_superseded_buckets_go(table):
    for n in range(4):
        table.batch(on(1, "a", bed_id=n), on(2, f"b{n}"), keep=2)
    assert table.spark.read.parquet(table.path).count() < 4 * 5 and jobs.read_facts(table.spark, table.path).count() == 5


# --- facts that lack a key ---


def test_the_second_lookup_opens_pending_facts_and_writes_what_gains(table, monkeypatch):
    table.know({"patient_id": "a"})
    table.batch(*[on(d, "a") for d in range(1, 9)], on(3, "b"), on(4, "c"))
    pending = {f for f in folders(table.path, 0) if f.endswith("is_pending=true")}
    assert {f.split("/")[0] for f in pending} == {"admission_date=2026-01-03", "admission_date=2026-01-04"}
    opened, read = [], snapshots._read
    monkeypatch.setattr(snapshots, "_read", lambda s, p, schema, folders: opened.append(folders) or read(s, p, schema, folders))
    assert table.resolve() == 0
    assert len(opened) == 1 and len(opened[0]) == len(pending) and all(f.endswith("is_pending=true") for f in opened[0])
    table.know({"patient_id": "a"}, {"patient_id": "b"})
    opened.clear()
    assert table.resolve() == 1
    assert {f.split("/")[0] for f in folders(table.path, 1)} == {"admission_date=2026-01-03"}
    assert all("admission_date=2026-01-03/" in f for f in opened[1])
    out = jobs.read_facts(table.spark, table.path)
    assert out.count() == 10 and as_set(out.filter("patient_sk IS NULL"), "patient_id") == [("c",)]
    assert table.resolve() == 0
    table.know(*({"patient_id": p} for p in "abc"))
    assert table.resolve() == 1 and table.resolve() == 0
    opened.clear()
    assert table.resolve() == 0 and opened == [[]]  # none is pending, nothing is opened


def test_a_fact_that_comes_again_leaves_the_pending_ones(table):
    table.batch(on(1, "a"))
    assert all(f.endswith("is_pending=true") for f in folders(table.path, 0))
    table.know({"patient_id": "a"})
    table.batch(on(1, "a"))
    assert all(f.endswith("is_pending=false") for f in folders(table.path, 1))
    assert table.resolve() == 0 and jobs.read_facts(table.spark, table.path).count() == 1


# --- incremental export ---


def exported(location):
    """Files of each date with the time of their last change."""
    return {
        day: {(n, os.stat(f"{location}/{day}/{n}").st_mtime_ns) for n in os.listdir(f"{location}/{day}") if n.startswith("part-")}
        for day in os.listdir(location)
        if day.startswith("admission_date=")
    }


def test_an_export_replaces_the_dates_written_since_the_last_one(table, tmp_path):
    spark, place = table.spark, str(tmp_path / "export")
    serve = lambda: serving.export_changes(spark, table.path, schemas.FACT, COLUMNS, serving.FACT, "inc_fact", place)
    assert serve()[1] == [] and spark.table("inc_fact").isEmpty()
    table.batch(*[on(d, f"p{k}") for d in (1, 2, 3) for k in range(5)])
    assert serve()[1] == ["2026-01-01", "2026-01-02", "2026-01-03"]
    before = exported(place)
    assert serve()[1] == [] and exported(place) == before
    table.batch(on(2, "p1", discharge_time=datetime(2026, 1, 9)), on(7, "q"))
    table.batch(on(7, "r"))
    out, dates = serve()
    after = exported(place)
    assert dates == ["2026-01-02", "2026-01-07"]
    assert {d: after[d] for d in before if "-02" not in d} == {d: before[d] for d in before if "-02" not in d}
    assert not after["admission_date=2026-01-02"] & before["admission_date=2026-01-02"]
    want = serving.typed(jobs.read_facts(spark, table.path), serving.FACT)
    assert as_set(out) == as_set(want) == as_set(spark.read.parquet(place).select(*out.columns)) and out.count() == 17
    assert out.columns[-1] == "admission_date" and sorted(out.columns) == sorted(want.columns)


def test_an_export_that_failed_is_done_again(table, tmp_path, monkeypatch):
    spark, place = table.spark, str(tmp_path / "export")
    serve = lambda: serving.export_changes(spark, table.path, schemas.FACT, COLUMNS, serving.FACT, "again_fact", place)
    table.batch(on(1, "a"))
    serve()
    table.batch(on(1, "b"), on(2, "c"))
    with monkeypatch.context() as broken:
        broken.setattr(files, "write_text", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            serve()
    assert serve()[1] == ["2026-01-01", "2026-01-02"] and spark.table("again_fact").count() == 3


def test_an_export_to_another_place_is_whole(table, tmp_path):
    serve = lambda to: serving.export_changes(table.spark, table.path, schemas.FACT, COLUMNS, serving.FACT, "moved_fact", str(tmp_path / to))
    table.batch(on(1, "a"), on(2, "b"))
    serve("one")
    assert serve("it's two")[1] == ["2026-01-01", "2026-01-02"] and table.spark.table("moved_fact").count() == 2
    assert os.path.isdir(tmp_path / "one" / "admission_date=2026-01-01")


def test_a_small_text_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "told")
    assert files.read_text(spark, path) is None
    for text in ("1", "two"):
        files.write_text(spark, path, text)
        assert files.read_text(spark, path) == text
    assert sorted(f for f in os.listdir(tmp_path) if not f.startswith(".")) == ["told"]


# --- stored counts behind the KPIs ---


def test_stored_counts_give_the_kpis_after_each_batch(table):
    spark, r, stored = table.spark, random.Random(4), f"{table.base}/kpi"
    people = [{"patient_id": p, "gender": "Female" if p < "e" else "Male"} for p in "abcdefgh"]
    table.know(*people[:7])  # one is never found
    dim = scd2.apply(tables.empty(spark, schemas.PATIENT_DIM), scd2.members(visits(spark, *people)), datetime(2026, 2, 1))
    older = dim.withColumns({"gender": F.lit("Other"), "is_current": F.lit(False)}).filter("patient_id < 'c'")
    dim = dim.unionByName(older)
    assert jobs.update_partials(spark, stored, table.path) == []
    for turn in range(3):
        rows = [
            on(r.randint(1, 9), r.choice("abcdefgh"), bed_id=r.choice([1, 2, 3, None]), discharge_time=datetime(2026, r.choice([1, 2]), 20))
            for _ in range(15)
        ]
        if turn == 2:
            rows = [on(3, "a", bed_id=77)]
        full = table.batch(*rows)
        dates = jobs.update_partials(spark, stored, table.path)
        assert dates == sorted({f"{x['admission_time']:%Y-%m-%d}" for x in rows})
        assert jobs.update_partials(spark, stored, table.path) == []
        counts = jobs.read_partials(spark, stored)
        for versions in (dim, dim.filter("is_current")):
            assert as_set(kpi.turnover_of(counts, versions)) == as_set(kpi.bed_turnover(full, versions))
            assert as_set(kpi.occupancy_of(counts, versions)) == as_set(kpi.bed_occupancy(full, versions))
    newest = snapshots.latest(spark, stored)
    assert [f for f in os.listdir(f"{stored}/v={newest}") if "=" in f] == ["admission_date=2026-01-03"]


def test_counts_that_fell_behind_catch_up(table):
    for n in range(3):
        table.batch(on(n + 1, "a", bed_id=n))
    assert jobs.update_partials(table.spark, f"{table.base}/kpi", table.path) == ["2026-01-01", "2026-01-02", "2026-01-03"]


def test_the_turnover_reads_the_facts_once(spark):
    fact = frame(spark, schemas.FACT, {"fact_id": 1, "patient_sk": "a", "bed_id": 1})
    dim = frame(spark, schemas.PATIENT_DIM, {"patient_sk": "a", "gender": "F", "is_current": True})
    plan = kpi.bed_turnover(fact, dim)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Expand" not in plan


def test_facts_read_by_date(table):
    table.batch(*[on(d, f"p{k}") for d in (1, 2) for k in range(9)])
    assert jobs.read_facts(table.spark, table.path, only=["2026-01-02"]).count() == 9
    assert facts.COLUMNS == tuple(jobs.read_facts(table.spark, table.path).columns)
