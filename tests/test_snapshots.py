import glob
import os

import pytest
from pyspark.sql import types as T

from rows import as_set
from starflow.sinks import snapshots as sn

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
HIST = T.StructType([T.StructField("k", T.StringType()), T.StructField("is_current", T.BooleanType())])
PART = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType())])


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), KV)


def hist(spark, *rows):
    return spark.createDataFrame(list(rows), HIST)


def part(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, d string").selectExpr("k", "CAST(d AS DATE) AS d")


def break_version(path, version):
    """What a crash inside the write leaves: files without the final marker."""
    os.remove(f"{path}/v={version}/_SUCCESS")


def test_a_table_without_a_version_reads_empty(spark, path):
    assert sn.latest(spark, path) is None
    assert sn.read_increments(spark, path, KV).schema == KV
    assert sn.read_history(spark, path, HIST).isEmpty()
    assert sn.read_partitions(spark, path, PART, "d").isEmpty()


def test_increments_add_up(spark, path):
    sn.publish(kv(spark, ("a", 1)), path, 0)
    sn.publish(kv(spark, ("b", 2)), path, 3)
    assert as_set(sn.read_increments(spark, path, KV)) == [("a", 1), ("b", 2)]
    assert as_set(sn.read_increments(spark, path, KV, upto=2)) == [("a", 1)]
    assert sn.versions(spark, path) == [0, 3] and sn.latest(spark, path, before=3) == 0


def test_versions_order_as_numbers(spark, path):
    for version in (2, 10):
        sn.publish(kv(spark, ("a", version)), path, version)
    assert sn.latest(spark, path) == 10


def test_writing_the_last_version_again_replaces_it(spark, path):
    sn.publish(kv(spark, ("a", 1)), path, 0)
    sn.publish(kv(spark, ("a", 2)), path, 0)
    assert as_set(sn.read_increments(spark, path, KV)) == [("a", 2)]


def test_an_older_version_is_refused(spark, path):
    sn.publish(kv(spark, ("a", 1)), path, 5)
    with pytest.raises(ValueError, match="version 0"):
        sn.publish(kv(spark, ("a", 2)), path, 0)
    assert as_set(sn.read_increments(spark, path, KV)) == [("a", 1)]


def test_a_crashed_version_is_not_seen_and_is_written_again(spark, path):
    sn.publish(hist(spark, ("a", True)), path, 0, ["is_current"])
    sn.publish(hist(spark, ("a", False), ("b", True)), path, 1, ["is_current"])
    break_version(path, 1)
    assert as_set(sn.read_history(spark, path, HIST)) == [(True, "a")]
    sn.publish(hist(spark, ("a", False), ("c", True)), path, 1, ["is_current"])
    assert as_set(sn.read_history(spark, path, HIST)) == [(False, "a"), (True, "c")]


def test_history_keeps_closed_rows_and_the_last_current_ones(spark, path):
    sn.publish(hist(spark, ("a1", True), ("b1", True)), path, 0, ["is_current"])
    sn.publish(hist(spark, ("a1", False), ("a2", True), ("b1", True)), path, 1, ["is_current"])
    sn.publish(hist(spark, ("a2", False), ("a3", True), ("b1", True)), path, 2, ["is_current"])
    assert as_set(sn.read_history(spark, path, HIST), "k") == [("a1",), ("a2",), ("a3",), ("b1",)]
    assert as_set(sn.read_history(spark, path, HIST, upto=1), "k") == [("a1",), ("a2",), ("b1",)]
    assert as_set(sn.read_history(spark, path, HIST, current=True), "k") == [("a3",), ("b1",)]
    assert as_set(sn.read_history(spark, path, HIST, current=False), "k") == [("a1",), ("a2",)]


def test_reading_current_rows_opens_one_folder(spark, path):
    for version in range(3):
        sn.publish(hist(spark, ("a", False), ("b", True)), path, version, ["is_current"])
    df = sn.read_history(spark, path, HIST, current=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "is_current" in plan
    read = [r[0] for r in df.selectExpr("input_file_name()").collect()]
    assert read and all("/v=2/is_current=true/" in name for name in read)


def test_partitions_come_from_the_version_that_wrote_them_last(spark, path):
    sn.publish(part(spark, ("a", "2026-01-01"), ("b", "2026-01-02")), path, 0, ["d"])
    sn.publish(part(spark, ("B", "2026-01-02"), ("c", None)), path, 1, ["d"])
    whole = sn.read_partitions(spark, path, PART, "d")
    assert as_set(whole, "k") == [("B",), ("a",), ("c",)]
    assert whole.schema == PART
    assert as_set(sn.read_partitions(spark, path, PART, "d", upto=0), "k") == [("a",), ("b",)]
    assert as_set(sn.read_partitions(spark, path, PART, "d", only=["2026-01-02"]), "k") == [("B",)]
    assert as_set(sn.read_partitions(spark, path, PART, "d", only=[None]), "k") == [("c",)]


def test_a_crashed_partition_write_leaves_the_old_partition(spark, path):
    sn.publish(part(spark, ("a", "2026-01-01")), path, 0, ["d"])
    sn.publish(part(spark, ("A", "2026-01-01")), path, 1, ["d"])
    break_version(path, 1)
    assert as_set(sn.read_partitions(spark, path, PART, "d"), "k") == [("a",)]


def test_retire_drops_only_what_no_kept_snapshot_reads(spark, path):
    sn.publish(part(spark, ("a0", "2026-01-01"), ("b0", "2026-01-02")), path, 0, ["d"])
    for version in (1, 2, 3):
        sn.publish(part(spark, (f"b{version}", "2026-01-02")), path, version, ["d"])
    before = {n: as_set(sn.read_partitions(spark, path, PART, "d", upto=n)) for n in (2, 3)}
    assert sn.retire(spark, path, "d", keep=2) == 2
    assert {n: as_set(sn.read_partitions(spark, path, PART, "d", upto=n)) for n in (2, 3)} == before
    left = {f.split("/v=")[1] for f in glob.glob(f"{path}/v=*/d=*")}
    assert left == {"0/d=2026-01-01", "2/d=2026-01-02", "3/d=2026-01-02"}


def test_retire_never_drops_closed_rows(spark, path):
    for version in range(4):
        sn.publish(hist(spark, (f"old{version}", False), ("b", True)), path, version, ["is_current"])
    whole = as_set(sn.read_history(spark, path, HIST))
    assert sn.retire(spark, path, "is_current", keep=2) == 2
    assert as_set(sn.read_history(spark, path, HIST)) == whole
    assert sn.retire(spark, path, "is_current", keep=2) == 0


def test_a_read_makes_as_many_calls_for_many_versions_as_for_few(spark, path, monkeypatch):
    from starflow import files

    calls, asked = [], files._open
    monkeypatch.setattr(files, "_open", lambda *a: calls.append(a) or asked(*a))
    counts = []
    for n in range(12):
        sn.publish(part(spark, ("x", f"2026-01-{n + 1:02}")), path, n, partition_by=["d"])
        calls.clear()
        assert sn.versions(spark, path) == list(range(n + 1))
        sn.latest(spark, path)
        counts.append(len(calls))
    assert len(set(counts)) == 1


def test_the_last_version_is_found_without_a_listing(spark, path, monkeypatch):
    from starflow import files

    for n in range(4):
        sn.publish(kv(spark, ("a", n)), path, n)
    with monkeypatch.context() as m:
        m.setattr(files, "matching", lambda *_: pytest.fail("listed"))
        assert sn.latest(spark, path) == 3 and sn.latest(spark, path, before=4) == 3
    assert sn.latest(spark, path, before=3) == 2
    # a writer that died between the version's mark and the pointer, and a pointer that was lost
    files.write_text(spark, f"{path}/{sn.POINTER}", "2")
    assert sn.latest(spark, path) == 2 and sn.versions(spark, path) == [0, 1, 2, 3]
    sn.publish(kv(spark, ("a", 9)), path, 3)
    assert sn.latest(spark, path) == 3
    files.delete(spark, f"{path}/{sn.POINTER}")
    assert sn.latest(spark, path) == 3
