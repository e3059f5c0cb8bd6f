"""The jobs of each layer, from raw events to the star schema.

Each takes streaming input, brings its table up to date and returns the query.  A job
may be run again at any time: it takes what is new, and a batch that failed half-way
is done again under the same version number.
"""

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starflow import files, schemas
from starflow.functions.keys import bucket_column, hash_bucket
from starflow.operators import cleaning, facts, kpi, members, scd2, timeline
from starflow.sinks import appended, snapshots
from starflow.sources.broker import decode_messages
from starflow.sources.tables import empty, scan_stream
from starflow.streaming.runner import run_append, run_batches

Clock = Callable[[int], datetime]

#: Hash buckets of the current patients, and of the facts of a date, unless told otherwise.
PATIENT_BUCKETS, FACT_BUCKETS = 16, 8

# Dropped from the stream itself, so that the scan of a micro-batch skips them.
NOT_IN_PATIENT = ("department", "discharge_time", "bed_id", "hospital_id", "admission_repaired")
NOT_IN_FACT = ("gender", "age", "admission_repaired")


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` cached, in memory and on disk, while several actions use it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def land(messages: DataFrame, path: str, checkpoint: str, **run) -> StreamingQuery:
    """Broker messages to the raw table, payload unchanged."""
    return run_append(decode_messages(messages), path, checkpoint, **run)


def backfill(rows: DataFrame, path: str) -> None:
    """Append raw rows by hand.

    ``path`` is a folder beside the streamed one: a streaming file sink logs its
    files, and readers ignore whatever else is put there.
    """
    rows.write.mode("append").parquet(path)


def raw_stream(spark: SparkSession, *paths: str, schema: T.StructType = schemas.RAW) -> DataFrame:
    """The streamed and the backfilled raw rows as one stream."""
    first, *others = [scan_stream(spark, p, schema) for p in paths]
    for other in others:
        first = first.unionByName(other)
    return first


def clean(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    as_of: datetime | Column | None = None,
    schema: T.StructType = schemas.EVENT,
    **run,
) -> StreamingQuery:
    """Raw rows to the clean table, unusable ones apart, in one pass.

    The table is partitioned by ``reject_reason``: usable visits lie under the NULL
    reason with an empty ``raw_json``, rejected rows under theirs with the text.  A
    field added to ``schema`` becomes one more column from the next run on; readers
    that declare it get NULL for older rows.
    """
    parsed = cleaning.parse_events(raw, schema)
    reason = cleaning.reject_reason()
    kept_text = F.when(reason.isNotNull(), F.col("raw_json")).alias("raw_json")
    others = [c for c in parsed.columns if c != "raw_json"]
    judged = parsed.select(*others, kept_text, reason.alias("reject_reason"))
    now = F.current_timestamp() if as_of is None else as_of
    return run_append(
        cleaning.clean_visits(judged, now), path, checkpoint, partition_by=("reject_reason",), **run
    )


def clean_schema(extra: T.StructType | None = None) -> T.StructType:
    """Columns of the clean table; ``extra`` are those the raw rows had beside the text."""
    schema = T.StructType(schemas.CLEAN.fields + (extra.fields if extra else []))
    schema = schemas.with_field(schema, "raw_json", T.StringType())
    schema = schemas.with_field(schema, "reject_reason", T.StringType())
    return schemas.with_field(schema, "admission_repaired", T.BooleanType())


def visits_stream(
    spark: SparkSession, path: str, extra: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """Usable visits of the clean table; rejected rows lie in folders that are not read."""
    rows = scan_stream(spark, path, clean_schema(extra), max_files=max_files)
    return rows.filter(F.col("reject_reason").isNull()).drop("raw_json", "reject_reason")


def rejected(spark: SparkSession, path: str, extra: T.StructType | None = None) -> DataFrame:
    """The quarantined rows of the clean table: text and reason."""
    rows = appended.read_appended(spark, path, clean_schema(extra))
    carried = extra.names if extra else []
    return rows.filter(F.col("reject_reason").isNotNull()).select("raw_json", "reject_reason", *carried)


def patient_dimension(
    visits: DataFrame,
    path: str,
    checkpoint: str,
    *,
    schema: T.StructType = schemas.PATIENT_DIM,
    by: Sequence[str] = (scd2.EVENT_TIME,),
    late_guard: bool = False,
    buckets: int = PATIENT_BUCKETS,
    clock: Clock | None = None,
    first_version: int = 0,
    keep: int | None = 2,
    small_batch: int = 200_000,
    **run,
) -> StreamingQuery:
    """Type-2 patient dimension, one version per changed patient and batch.

    Current rows lie in ``buckets`` hash buckets of the patient.  A batch reads the buckets
    that its patients fall into, and writes those in which one of them changed; all others
    keep their files, and a batch that changes nobody leaves no version.  So a small batch
    costs its buckets, not the dimension.  Which changed is found out by an anti join on two
    columns.  Closed rows are written when they close and never read again.  The number of
    buckets is part of the stored layout and stays; a bucket should hold some 100 MB.

    ``keep`` bounds how many superseded sets of current rows stay on disk (at least two, for
    readers that have just started).  A batch of at most ``small_batch`` members is merged by
    joins that can broadcast it, if Spark finds its bytes below the threshold; the result and
    its layout are the same.
    """
    if late_guard and scd2.APPLIED not in schema.names:
        schema = schemas.with_field(schema, scd2.APPLIED, visits.schema[scd2.EVENT_TIME].dataType)
    place = hash_bucket(scd2.KEY, buckets)
    bucket = bucket_column(buckets)

    def publish(rows: DataFrame, path: str, version: int) -> None:
        # closed rows have no bucket: they lie in one folder
        rows = rows.withColumn(bucket, F.when(F.col("is_current"), place))
        by = ["is_current", bucket]
        snapshots.publish(rows.hint("rebalance", *by), path, version, partition_by=by)

    def step(batch: DataFrame, batch_id: int, as_of: datetime) -> None:
        version = first_version + batch_id
        spark = batch.sparkSession
        base = snapshots.latest(spark, path, before=version)
        incoming = scd2.members(batch, by, late_guard)
        if base is None:
            publish(scd2.apply(empty(spark, schema), incoming, as_of, late_guard), path, version)
            return
        _same_buckets(spark, f"{path}/v=*/is_current=true/*", path, buckets)
        with held(incoming):
            # at most one value for each bucket
            touched = dict(map(tuple, incoming.groupBy(place).count().collect()))
            arrived = sum(touched.values())

            def current(only) -> DataFrame:
                columns = ["is_current=true", bucket]
                return snapshots.read_partitions(spark, path, schema, columns, upto=base, only=only)

            changed = scd2.news(current(touched), incoming, late_guard)
            changed = [row[0] for row in changed.select(place).distinct().collect()]
            if not changed:
                return
            some = incoming.filter(place.isin(changed))
            publish(scd2.apply(current(changed), some, as_of, late_guard, few=arrived <= small_batch), path, version)
        if keep is not None:
            snapshots.retire(spark, path, ["is_current", bucket], max(keep, 2))

    return run_batches(visits.drop(*NOT_IN_PATIENT), step, checkpoint, clock=clock, **run)


def distinct_rows(
    rows: DataFrame, path: str, checkpoint: str, *, keys: Sequence[str], time: str, horizon: str, **run
) -> StreamingQuery:
    """Append each key's first row, and its next one beyond the horizon: see :func:`members.distinct_within`."""
    return run_append(members.distinct_within(rows, keys, time, horizon), path, checkpoint, **run)


def department_dimension(
    visits: DataFrame,
    path: str,
    checkpoint: str,
    *,
    time: str | None = None,
    horizon: str | None = None,
    clock: Clock | None = None,
    first_version: int = 0,
    **run,
) -> StreamingQuery:
    """Insert-only department dimension; a version holds just the new members.

    With ``horizon`` the stream remembers the members of so long a stretch of ``time`` and
    hands on those it has not seen in it, so most batches have nothing to merge.  The
    dimension is the same, but for rows later than the watermark, which are passed over.
    """

    def step(batch: DataFrame, batch_id: int, _as_of: datetime) -> None:
        version = first_version + batch_id
        spark = batch.sparkSession
        base = snapshots.latest(spark, path, before=version)
        stored = (
            empty(spark, schemas.DEPARTMENT_DIM)
            if base is None
            else snapshots.read_increments(spark, path, schemas.DEPARTMENT_DIM, upto=base)
        )
        arrived = members.department_members(batch).select(*schemas.DEPARTMENT_DIM.names)
        with held(members.absent(stored, arrived)) as new:
            # Most batches bring no new member, and then leave no version.
            if not new.isEmpty():
                snapshots.publish(new, path, version)

    rows = visits.select(*members.KEYS)
    if horizon:
        rows = members.distinct_within(visits.select(*members.KEYS, time), members.KEYS, time, horizon)
        run["persist"] = True  # each action on the batch would go through the state again
    return run_batches(rows, step, checkpoint, clock=clock, **run)


def patient_timeline(
    visits: DataFrame,
    path: str,
    checkpoint: str,
    *,
    schema: T.StructType = timeline.points_schema(schemas.CLEAN),
    by: Sequence[str] = (timeline.TIME,),
    buckets: int = 16,
    clock: Clock | None = None,
    keep: int | None = 2,
    **run,
) -> StreamingQuery:
    """What was known of each patient at each event time, to read versions from.

    A late event goes to its place: it splits the version that covered its time, or moves
    a border, so the history depends neither on the order of arrival nor on how the stream
    was cut into batches.  Rows lie by month of the event and hash bucket of the patient; a
    batch reads and writes only the months and buckets of its events.  Rows that change
    something lie apart from those that repeat it, and :func:`read_timeline` opens only them.
    """
    place = hash_bucket(timeline.KEY, buckets)
    columns = [timeline.MONTH, bucket_column(buckets)]

    def step(batch: DataFrame, batch_id: int, _as_of: datetime) -> None:
        spark = batch.sparkSession
        base = snapshots.latest(spark, path)
        version = batch_id if base is None else max(batch_id, base + 1)
        arrived = timeline.points(batch, by).select(*schema.names)
        with held(arrived.withColumn(timeline.MONTH, timeline.month())) as incoming:
            touched = [(r[0], r[1]) for r in incoming.select(timeline.MONTH, place).distinct().collect()]
            if not touched:
                return
            stored = snapshots.read_partitions(spark, path, schema, columns, upto=base, only=touched)
            rows = timeline.insert(stored, incoming.select(*schema.names), by)
            rows = timeline.marked(rows).withColumn(columns[1], place)
            by_folder = [*columns, timeline.CHANGE]
            snapshots.publish(rows.hint("rebalance", *by_folder), path, version, partition_by=by_folder)
        if keep is not None:
            snapshots.retire(spark, path, columns, max(keep, 2))

    return run_batches(visits.select(*schema.names), step, checkpoint, clock=clock, **run)


def read_timeline(
    spark: SparkSession, path: str, schema: T.StructType = timeline.points_schema(schemas.CLEAN), buckets: int = 16
) -> DataFrame:
    """The versions of each patient by event time, from what :func:`patient_timeline` stored."""
    stored = timeline.marked_schema(schema)
    rows = snapshots.read_partitions(spark, path, stored, [timeline.MONTH, bucket_column(buckets)])
    return timeline.versions(rows.filter(timeline.CHANGE))


def fact_table(
    visits: DataFrame,
    path: str,
    checkpoint: str,
    *,
    patients: Callable[..., DataFrame],
    departments: Callable[[SparkSession], DataFrame],
    patient_buckets: int | None = None,
    schema: T.StructType = schemas.FACT,
    by: Sequence[str] | Column = facts.DETAILS,
    as_of: datetime | None = None,
    buckets: int = FACT_BUCKETS,
    clock: Clock | None = None,
    first_version: int = 0,
    keep: int | None = 2,
    small_batch: int = 200_000,
    **run,
) -> StreamingQuery:
    """Upserted fact table, partitioned by admission date and by hash bucket of the fact within it.

    ``patients`` (current members) and ``departments`` read the dimensions anew for
    each batch.  A visit's date is part of its key, so only the dates and buckets of the batch
    are read, joined and written: of a date that holds most facts, as that of all repaired
    admissions does, a small batch moves its buckets.  The list of them is one small
    aggregate, at most one value per calendar day and bucket, as text since a dirty year may be
    none of Python's.  Every write is rebalanced by partition, so it has few files however
    small the batches are.  The number of buckets is part of the stored layout and stays.
    Facts that lack a key lie apart in their bucket, for :func:`resolve_facts`.

    With ``patient_buckets``, the number in which the current patients are stored,
    ``patients`` also takes the list of those that the batch's patients fall into, so that a
    small batch opens no other files of the dimension either.

    ``as_of`` fixes the clock of the measures apart from the ingestion time.  ``keep``
    bounds the superseded partitions on disk.  For ``small_batch`` see
    :func:`patient_dimension`.

    A batch is merged into the newest version, whatever its number: a replayed one, or
    one after :func:`resolve_facts`, becomes a version on top, and merging a visit twice
    is merging it once.
    """
    columns = [schemas.DATE, bucket_column(buckets)]

    def step(batch: DataFrame, batch_id: int, now: datetime) -> None:
        spark = batch.sparkSession
        base = snapshots.latest(spark, path)
        version = first_version + batch_id if base is None else max(first_version + batch_id, base + 1)
        rows = facts.fact_rows(batch, now if as_of is None else as_of, now, by)
        if patient_buckets:
            met = batch.select(hash_bucket(scd2.KEY, patient_buckets)).distinct().collect()
            known = patients(spark, [row[0] for row in met])
        else:
            known = patients(spark)
        incoming = facts.enrich(rows, known, departments(spark))
        if base is None:
            _publish_facts(incoming, path, version, buckets)
            return
        _same_buckets(spark, f"{path}/v=*/{schemas.DATE}=*/*", path, buckets)
        with held(incoming):
            place = F.col(schemas.DATE).cast("string").alias("date"), hash_bucket("fact_id", buckets)
            touched = {(r[0], r[1]): r[2] for r in incoming.groupBy(*place).count().collect()}
            stored = snapshots.read_partitions(spark, path, schema, columns, upto=base, only=touched)
            merged = facts.upsert(stored, incoming, few=sum(touched.values()) <= small_batch)
            _publish_facts(merged, path, version, buckets)
        if keep is not None:
            snapshots.retire(spark, path, columns, max(keep, 2))

    return run_batches(visits.drop(*NOT_IN_FACT), step, checkpoint, clock=clock, **run)


def _publish_facts(rows: DataFrame, path: str, version: int, buckets: int) -> None:
    pending = F.col("patient_sk").isNull() | F.col("department_sk").isNull()
    rows = rows.select("*", hash_bucket("fact_id", buckets), pending.alias(schemas.PENDING))
    by = [schemas.DATE, bucket_column(buckets)]
    snapshots.publish(rows.hint("rebalance", *by), path, version, partition_by=[*by, schemas.PENDING])


def _same_buckets(spark: SparkSession, pattern: str, path: str, buckets: int) -> None:
    """Refuses a table that is stored in another number of buckets, or in none."""
    other = [f for f in files.matching(spark, pattern) if f"/{bucket_column(buckets)}=" not in f]
    if other:
        raise ValueError(f"the rows of {path} are not in {buckets} buckets: {other[0]}")


def read_facts(
    spark: SparkSession, path: str, schema: T.StructType = schemas.FACT, upto: int | None = None, only: Iterable | None = None
) -> DataFrame:
    """The facts of all dates, or of those in ``only``."""
    return snapshots.read_partitions(spark, path, schema, [schemas.DATE, snapshots.BUCKETS], upto=upto, only=only)


def read_current(
    spark: SparkSession, path: str, schema: T.StructType, buckets: int, only: Iterable[int] | None = None
) -> DataFrame:
    """The current patients, or those of some buckets."""
    return snapshots.read_partitions(spark, path, schema, ["is_current=true", bucket_column(buckets)], only=only)


def resolve_facts(
    spark: SparkSession,
    path: str,
    *,
    patients: Callable[[SparkSession], DataFrame],
    departments: Callable[[SparkSession], DataFrame],
    schema: T.StructType = schemas.FACT,
    buckets: int = FACT_BUCKETS,
    keep: int | None = 2,
) -> int:
    """Look up again the facts whose dimension members came late; a new version if any is found.

    The search opens only the folders of facts that lack a key, and the buckets in which one
    can now be filled are read whole and written.  Keys already set stay.  Returns the number
    of dates with such buckets.
    """
    base = snapshots.latest(spark, path)
    if base is None:
        return 0
    columns = [schemas.DATE, bucket_column(buckets)]
    pending = f"{schemas.PENDING}=true"
    lacking = snapshots.read_partitions(spark, path, schema, columns, upto=base, inside=pending)
    if not lacking.inputFiles():
        return 0
    members = patients(spark), departments(spark)
    again = facts.resolve(facts.unresolved(lacking), *members)
    gained = [F.col(f"{c.removesuffix('_sk')}_missing") & F.col(c).isNotNull() for c in facts.LOOKED_UP]
    place = F.col(schemas.DATE).cast("string"), hash_bucket("fact_id", buckets)
    touched = [(r[0], r[1]) for r in again.filter(gained[0] | gained[1]).select(*place).distinct().collect()]
    if not touched:
        return 0
    rows = snapshots.read_partitions(spark, path, schema, columns, upto=base, only=touched)
    _publish_facts(facts.resolve(rows, *members), path, base + 1, buckets)
    if keep is not None:
        snapshots.retire(spark, path, columns, max(keep, 2))
    return len({date for date, _ in touched})


def update_partials(spark: SparkSession, path: str, facts_path: str, schema: T.StructType = schemas.FACT, keep: int | None = 2) -> list[str]:
    """Bring the KPIs' partial counts up to the newest facts; returns the dates counted again.

    ``path`` has one row for each date, patient and bed, partitioned by date; its version is
    that of the facts it counts.  Only dates that a version since wrote are read.
    """
    newest, counted = snapshots.latest(spark, facts_path), snapshots.latest(spark, path)
    if newest is None or newest == counted:
        return []
    dates = snapshots.changed(spark, facts_path, [schemas.DATE, snapshots.BUCKETS], after=counted, upto=newest)
    rows = read_facts(spark, facts_path, schema, upto=newest, only=dates)
    counts = kpi.partials(rows, schemas.DATE)
    snapshots.publish(counts.hint("rebalance", schemas.DATE), path, newest, partition_by=[schemas.DATE])
    if keep is not None:
        snapshots.retire(spark, path, schemas.DATE, max(keep, 2))
    return dates


def read_partials(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    return snapshots.read_partitions(spark, path, kpi.PARTIALS, schemas.DATE, upto=upto)
