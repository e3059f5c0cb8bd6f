"""Tables that a stream appends to: a short log and few files, and each row once."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from rows import as_set
from starflow.sinks import appended, snapshots
from starflow.sources import tables
from starflow.streaming.runner import run_append
from test_streams import Broker, event

N = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("p", T.StringType())])


def feed(spark, path, start, count):
    """One file a row."""
    rows = [(n, "even" if n % 2 == 0 else None) for n in range(start, start + count)]
    spark.createDataFrame(rows, N).repartition(count, "n").write.mode("append").option("maxRecordsPerFile", 1).parquet(path)


def stored(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


@pytest.fixture
def short_log(spark):
    """A log that is rewritten every few batches, whose old parts go at once."""
    settings = {"spark.sql.streaming.fileSink.log.compactInterval": "4", "spark.sql.streaming.fileSink.log.cleanupDelay": "0"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_two_hundred_batches_leave_a_short_log_and_few_files(spark, tmp_path, short_log):
    base, logged, files, margin = str(tmp_path), [], [], 20
    table = f"{base}/out"

    def turn(start, count):
        feed(spark, f"{base}/in", start, count)
        stream = tables.scan_stream(spark, f"{base}/in", N, max_files=1)
        keep = appended.forget_after(spark, table, 1000 * margin)
        query = run_append(stream, table, f"{base}/cp", partition_by=("p",), retention=keep)
        assert query.lastProgress["batchId"] >= start + count - 1  # a row, a file, a batch
        logged.append(len(spark.read.schema(N).parquet(table).inputFiles()))
        assert appended.fold(spark, table, N, partition_by=("p",))
        files.append(len(stored(table)))
        assert as_set(appended.read_appended(spark, table, N), "n") == as_set(spark.range(start + count).selectExpr("id AS n"))

    for n in range(8):
        turn(24 * n, 24)
    turn(192, 8)
    # what was written within the margin before the last fold, and since
    assert logged[:3] == [24, 48, 72] and max(logged) < 150
    assert max(files) < 180 and len(stored(f"{table}_folded")) <= 2 * len(snapshots.versions(spark, f"{table}_folded"))
    # Spark keeps the log's last hundred batches
    assert len([f for f in os.listdir(f"{table}/_spark_metadata") if not f.startswith(".")]) <= 100 + 2 * 4


def test_a_fold_takes_old_files_only_and_a_second_one_nothing(spark, tmp_path):
    base, table = str(tmp_path), f"{tmp_path}/out"
    feed(spark, f"{base}/in", 0, 2)
    run = lambda: run_append(tables.scan_stream(spark, f"{base}/in", N), table, f"{base}/cp")
    run()
    assert not appended.fold(spark, table, N, until=datetime.now() - timedelta(days=1))
    assert appended.forget_after(spark, table) is None
    between = datetime.now()
    time.sleep(0.1)
    feed(spark, f"{base}/in", 2, 2)
    run()
    assert appended.fold(spark, table, N, until=between) and not appended.fold(spark, table, N, until=between)
    assert as_set(spark.read.parquet(f"{table}_folded"), "n") == [(0,), (1,)]
    assert as_set(appended.read_appended(spark, table, N), "n") == [(0,), (1,), (2,), (3,)]


def test_a_fold_that_failed_is_not_seen(spark, tmp_path):
    base, table = str(tmp_path), f"{tmp_path}/out"
    feed(spark, f"{base}/in", 0, 3)
    run_append(tables.scan_stream(spark, f"{base}/in", N), table, f"{base}/cp")
    appended.fold(spark, table, N)
    version = snapshots.versions(spark, f"{table}_folded")[0]
    os.remove(f"{table}_folded/v={version}/_SUCCESS")
    assert as_set(appended.read_appended(spark, table, N), "n") == [(0,), (1,), (2,)]
    appended.fold(spark, table, N)
    assert as_set(appended.read_appended(spark, table, N), "n") == [(0,), (1,), (2,)]


def test_a_margin_keeps_what_is_not_folded(spark, tmp_path, short_log):
    """Files younger than the fold stay in the log however often it is rewritten."""
    base, table = str(tmp_path), f"{tmp_path}/out"
    for turn in range(2):
        feed(spark, f"{base}/in", 10 * turn, 10)
        stream = tables.scan_stream(spark, f"{base}/in", N, max_files=1)
        run_append(stream, table, f"{base}/cp", retention=appended.forget_after(spark, table))
        if not turn:
            appended.fold(spark, table, N)
    assert as_set(appended.read_appended(spark, table, N), "n") == sorted(((n,) for n in range(20)), key=str)


def test_the_star_folds_raw_and_clean(spark, tmp_path, capsys):
    from starflow.__main__ import main
    from starflow.star import Star

    star, source = Star(spark, str(tmp_path / "star")), Broker(spark, str(tmp_path / "messages"))
    for patient in "ab":
        source.send(event(patient_id=patient), "junk")
        star.land(source.stream())
        star.clean()
        star.dim_patient()
        assert star.fold(datetime.now()) == ["raw", "clean"]
    assert star.raw().count() == 4 and star.rejected().count() == 2 and star.patients().count() == 2
    main(["--root", star.root, "fold"])
    assert "folded: nothing" in capsys.readouterr().out
