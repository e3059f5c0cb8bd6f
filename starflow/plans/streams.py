"""Streaming queries: each runs its streams to the end and returns the table they left.

A stream is fed batch by batch: the rows of a batch are appended to the source table
and the job is run again on the same checkpoint, so a micro-batch is exactly what is
new, however many files it has.
"""

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow import files, schemas
from starflow.operators import facts, kpi, scd2, timeline
from starflow.plans import batch as b
from starflow.plans import visits as v
from starflow.session import workspace
from starflow.sinks import appended, serving, snapshots
from starflow.sources import tables
from starflow.streaming import jobs
from starflow.streaming.runner import run_append

#: Buckets of current patients, and of a date's facts: few, as the test tables are small.
BUCKETS = 4


def feed(rows: DataFrame, source: str, batches: Iterable[int], job: Callable[[DataFrame], object]) -> None:
    """Append each batch to the source table and run the job on what is new."""
    spark = rows.sparkSession
    for batch in batches:
        v.only(rows, batch).write.mode("append").parquet(source)
        job(tables.scan_stream(spark, source, rows.schema))


def stream_table_scan(spark, sf_dir):
    """The events table read as a stream, appended elsewhere, read back."""
    base = workspace(spark)
    # A table is a folder of files on a cluster and one file in the test data.
    schema = v.events(spark, sf_dir).schema
    folder = files.is_folder(spark, f"{sf_dir}/events.parquet")
    path, name = (f"{sf_dir}/events.parquet", None) if folder else (sf_dir, "events.parquet")
    stream = tables.scan_stream(spark, path, schema, name_filter=name)
    run_append(stream, f"{base}/events", f"{base}/checkpoint")
    return tables.scan(spark, f"{base}/events")


def _land(spark, sf_dir, batches) -> str:
    """Broker messages of the batches, landed as a stream."""
    base = workspace(spark)
    messages = v.raw(spark, sf_dir).select(
        F.lit(None).cast("binary").alias("key"), F.encode("raw_json", "UTF-8").alias("value"), "event_id", "batch"
    )

    def job(stream: DataFrame) -> None:
        jobs.land(stream.drop("batch"), f"{base}/raw", f"{base}/checkpoint")

    feed(messages, f"{base}/messages", batches, job)
    return base


def _landed(raw: DataFrame) -> DataFrame:
    return raw.select("event_id", F.length("raw_json").cast("bigint").alias("n_chars"))


def land_raw_stream(spark, sf_dir):
    base = _land(spark, sf_dir, v.BATCHES)
    return _landed(tables.scan(spark, f"{base}/raw"))


def land_raw_backfill(spark, sf_dir):
    """Batches 0 and 1 by stream, batch 2 appended by hand to the folder beside it."""
    base = _land(spark, sf_dir, v.BATCHES[:2])
    jobs.backfill(v.only(v.raw(spark, sf_dir), 2).select("event_id", "raw_json"), f"{base}/raw_backfill")
    streamed, by_hand = tables.scan(spark, f"{base}/raw"), tables.scan(spark, f"{base}/raw_backfill")
    return _landed(streamed.unionByName(by_hand))


def land_raw_folded(spark, sf_dir):
    """Landed batch by batch; after each its files are folded, and the sink's log may forget them."""
    base = workspace(spark)
    raw, schema = f"{base}/raw", T.StructType([T.StructField("event_id", T.LongType()), *schemas.RAW.fields])
    messages = v.raw(spark, sf_dir).select(F.encode("raw_json", "UTF-8").alias("value"), "event_id", "batch")

    def job(stream: DataFrame) -> None:
        jobs.land(stream.drop("batch"), raw, f"{base}/checkpoint", retention=appended.forget_after(spark, raw))
        appended.fold(spark, raw, schema)

    feed(messages, f"{base}/messages", v.BATCHES, job)
    return _landed(appended.read_appended(spark, raw, schema))


def land_backfill_after_clean(spark, sf_dir):
    """Two batches streamed and cleaned, the third one filled in by hand, cleaned again."""
    base = _land(spark, sf_dir, (0, 1))
    paths = f"{base}/raw", f"{base}/raw_backfill"
    files.make_folder(spark, paths[1])
    extra = T.StructType([T.StructField("event_id", T.LongType())])
    schema = T.StructType(schemas.RAW.fields + extra.fields)

    def clean() -> None:
        raw = jobs.raw_stream(spark, *paths, schema=schema)
        jobs.clean(raw, f"{base}/clean", f"{base}/clean_checkpoint", as_of=v.AS_OF)

    clean()
    jobs.backfill(v.only(v.raw(spark, sf_dir), 2).select(*schema.names), paths[1])
    clean()
    rows = tables.scan(spark, f"{base}/clean", schema=jobs.clean_schema(extra))
    rows = rows.filter(F.col("reject_reason").isNull()).drop("raw_json", "reject_reason")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("admission_time", "discharge_time")}
    return rows.withColumns(times)


def _patients(spark, sf_dir, base: str):
    """The patient job over a table of visits, and the visits to feed it."""
    rows = v.silver(spark, sf_dir).select("event_id", "patient_id", "gender", "age", "admission_time", "batch")

    def job(stream: DataFrame) -> None:
        jobs.patient_dimension(
            stream,
            f"{base}/dim_patient",
            f"{base}/checkpoint",
            schema=b.NTZ_PATIENT,
            by=v.LATEST,
            buckets=BUCKETS,
            clock=v.batch_clock,
        )

    return rows, job


def _stored_patients(spark, base: str) -> DataFrame:
    return snapshots.read_history(spark, f"{base}/dim_patient", b.NTZ_PATIENT)


def stream_dim_patient(spark, sf_dir):
    base = workspace(spark)
    rows, job = _patients(spark, sf_dir, base)
    feed(rows, f"{base}/visits", v.BATCHES, job)
    return _stored_patients(spark, base)


def stream_incremental_rerun(spark, sf_dir):
    """Batches 0 and 1, a run that finds nothing new, then batch 2 on the same checkpoint."""
    base = workspace(spark)
    rows, job = _patients(spark, sf_dir, base)
    feed(rows, f"{base}/visits", v.BATCHES[:2], job)
    job(tables.scan_stream(spark, f"{base}/visits", rows.schema))
    feed(rows, f"{base}/visits", v.BATCHES[2:], job)
    return _stored_patients(spark, base)


def stream_replay_idempotent(spark, sf_dir):
    """Batch 2 is applied twice: its commit is lost, so the restarted stream runs it again."""
    base = workspace(spark)
    rows, job = _patients(spark, sf_dir, base)
    feed(rows, f"{base}/visits", v.BATCHES, job)
    files.delete(spark, f"{base}/checkpoint/commits/{v.BATCHES[-1]}")
    job(tables.scan_stream(spark, f"{base}/visits", rows.schema))
    return _stored_patients(spark, base)


def stream_dim_department(spark, sf_dir):
    base = workspace(spark)
    rows = v.silver(spark, sf_dir).select("department", "hospital_id", "batch")

    def job(stream: DataFrame) -> None:
        jobs.department_dimension(stream, f"{base}/dim_department", f"{base}/checkpoint", clock=v.batch_clock)

    feed(rows, f"{base}/visits", v.BATCHES, job)
    return snapshots.read_increments(spark, f"{base}/dim_department", schemas.DEPARTMENT_DIM)


def stream_dedup_within_horizon(spark, sf_dir):
    """Beds in use by department, reported weekly: again only after five days of silence.

    All reports of a week carry the time of its end, so it does not matter which one comes first.
    """
    base = workspace(spark)
    week = F.expr("CAST((dayofmonth(ts) - 1) DIV 7 AS INT)")
    rows = v.events(spark, sf_dir).select(
        F.col("event_type").alias("department"), (F.col("event_id") % 500 + 1).cast("int").alias("bed_id"), week.alias("batch")
    )
    rows = rows.withColumn("reported", F.expr("TIMESTAMP '2024-01-08 00:00:00' + make_dt_interval(7 * batch)"))

    def job(stream: DataFrame) -> None:
        keys = ["department", "bed_id"]
        jobs.distinct_rows(stream, f"{base}/seen", f"{base}/checkpoint", keys=keys, time="reported", horizon="5 days")

    feed(rows, f"{base}/reports", range(5), job)
    return tables.scan(spark, f"{base}/seen").withColumn("reported", F.col("reported").cast("timestamp_ntz"))


TIMELINE = timeline.points_schema(schemas.with_field(b.NTZ_CLEAN, "event_id", T.LongType()), ["event_id"])


def scd2_event_time_history(spark, sf_dir):
    """Versions by event time, from batches that arrive in the order 2, 0, 1."""
    base = workspace(spark)
    rows = v.silver(spark, sf_dir).select(*TIMELINE.names, "batch")

    def job(stream: DataFrame) -> None:
        jobs.patient_timeline(stream, f"{base}/timeline", f"{base}/checkpoint", schema=TIMELINE, by=v.LATEST, buckets=BUCKETS)

    feed(rows, f"{base}/visits", (2, 0, 1), job)
    return jobs.read_timeline(spark, f"{base}/timeline", TIMELINE, buckets=BUCKETS)


def _fact_job(spark, sf_dir, by, late: bool = False):
    """Visits, the fact job over stored dimensions, its folder, and the second lookup.

    ``late``: some members come after the facts.
    """
    base = workspace(spark)
    clean = v.silver(spark, sf_dir)
    order = {} if isinstance(by, list) else v.positions()
    rows = clean.select("event_id", *facts.NATURAL_KEY, "discharge_time", "bed_id", "batch").withColumns(order)
    b.stored_patients(spark, clean, f"{base}/dim_patient")
    b.stored_departments(spark, clean, f"{base}/dim_department")
    b.stored_departments(spark, v.only(clean, 0), f"{base}/dim_department_early")

    def patients(session) -> DataFrame:
        stored = snapshots.read_history(session, f"{base}/dim_patient", b.NTZ_PATIENT, current=True)
        return scd2.current_members(stored)

    def departments(session, table: str = "dim_department") -> DataFrame:
        return snapshots.read_increments(session, f"{base}/{table}", schemas.DEPARTMENT_DIM)

    def known(session) -> DataFrame:
        return patients(session).filter(~F.col("patient_id").isin("P1", "P2", "P3", "P4", "P5"))

    def job(stream: DataFrame, keep: int | None = 2) -> None:
        jobs.fact_table(
            stream,
            f"{base}/fact",
            f"{base}/checkpoint",
            patients=known if late else patients,
            departments=(lambda session: departments(session, "dim_department_early")) if late else departments,
            schema=b.NTZ_FACT,
            by=by,
            as_of=v.AS_OF,
            buckets=BUCKETS,
            clock=v.batch_clock,
            keep=keep,
        )

    def resolve() -> int:
        return jobs.resolve_facts(
            spark, f"{base}/fact", patients=patients, departments=departments, schema=b.NTZ_FACT, buckets=BUCKETS
        )

    return base, rows, job, resolve


def _facts(spark, sf_dir, by, late: bool = False) -> DataFrame:
    base, rows, job, resolve = _fact_job(spark, sf_dir, by, late)
    feed(rows, f"{base}/visits", v.BATCHES, job)
    if late:
        resolve()
    return jobs.read_facts(spark, f"{base}/fact", b.NTZ_FACT).drop("fact_id")


def stream_fact(spark, sf_dir):
    return _facts(spark, sf_dir, ["event_id"])


def stream_fact_by_arrival(spark, sf_dir):
    """Copies of a visit are told apart by their place in the broker, as in production."""
    return _facts(spark, sf_dir, facts.arrival_order())


def stream_fact_resolved(spark, sf_dir):
    """Facts stored before some of their dimension members, then looked up again."""
    return _facts(spark, sf_dir, facts.arrival_order(), late=True)


def serve_fact_increment(spark, sf_dir):
    """A partitioned export after each batch of facts: only the dates of the batch are replaced."""
    base, rows, job, _ = _fact_job(spark, sf_dir, facts.arrival_order())
    columns = [schemas.DATE, snapshots.BUCKETS]
    name = b._table_name(base, "serve_fact_increment")
    for batch in v.BATCHES:
        feed(rows, f"{base}/visits", [batch], job)
        out, _ = serving.export_changes(spark, f"{base}/fact", b.NTZ_FACT, columns, serving.FACT, name, f"{base}/export")
    return out.drop("fact_id")


def kpi_turnover_incremental(spark, sf_dir):
    """The turnover after each batch, from stored counts of which a batch replaces its dates only."""
    base, rows, job, _ = _fact_job(spark, sf_dir, facts.arrival_order())
    patients = _current(spark, base)
    found = []
    for batch in v.BATCHES:
        feed(rows, f"{base}/visits", [batch], lambda stream: job(stream, keep=None))
        jobs.update_partials(spark, f"{base}/kpi", f"{base}/fact", b.NTZ_FACT, keep=None)
        counts = jobs.read_partials(spark, f"{base}/kpi", upto=snapshots.latest(spark, f"{base}/kpi"))
        found.append(kpi.turnover_of(counts, patients).withColumn("batch", F.lit(batch)))
    return reduce(DataFrame.unionByName, found)


def _current(spark, base: str) -> DataFrame:
    return snapshots.read_history(spark, f"{base}/dim_patient", b.NTZ_PATIENT, current=True)


QUERIES = {
    f.__name__: f
    for f in (
        stream_table_scan, land_raw_stream, land_raw_backfill, land_raw_folded, land_backfill_after_clean, stream_dim_patient,
        stream_dim_department, stream_dedup_within_horizon, scd2_event_time_history, stream_fact, stream_fact_by_arrival, stream_fact_resolved,
        stream_incremental_rerun, stream_replay_idempotent, serve_fact_increment, kpi_turnover_incremental,
    )
}
