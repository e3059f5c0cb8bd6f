"""One way to run a stream."""

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starflow import files

CLOCK = "_batch_time"
ONCE = {"availableNow": True}

BatchFunction = Callable[[DataFrame, int, datetime], None]


def _finish(query: StreamingQuery, wait: bool) -> StreamingQuery:
    if wait:
        query.awaitTermination()  # raises what the stream raised
    return query


def run_batches(
    source: DataFrame,
    apply: BatchFunction,
    checkpoint: str,
    *,
    clock: Callable[[int], datetime] | None = None,
    persist: bool = False,
    trigger: dict | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Call ``apply(batch, batch_id, as_of)`` for each non-empty micro-batch.

    ``as_of`` is one instant per batch.  By default it is the ``current_timestamp()``
    of the streaming plan, which a restarted batch sees again; read inside the batch
    function it would differ from action to action.  ``clock`` derives it from the
    batch id instead.  Ids of a stream are consecutive and a failed batch comes back
    under its id, so ``apply`` can use the id as the version it publishes.

    Set ``persist`` when ``apply`` runs several actions on the batch.  Select the
    needed columns on ``source``: not every batch frame lets a later select reach
    the scan.
    """
    stamped = source if clock else source.withColumn(CLOCK, F.current_timestamp())

    def handle(batch: DataFrame, batch_id: int) -> None:
        if persist:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if clock:
                if not batch.isEmpty():
                    apply(batch, batch_id, clock(batch_id))
            else:
                # The emptiness test and the clock in one small job.  As text the
                # time stays a wall-clock time of the session zone.
                head = batch.select(F.date_format(CLOCK, "yyyy-MM-dd HH:mm:ss.SSSSSS")).head()
                if head is not None:
                    apply(batch.drop(CLOCK), batch_id, datetime.fromisoformat(head[0]))
        finally:
            if persist:
                batch.unpersist()

    writer = stamped.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _finish(writer.trigger(**(trigger or ONCE)).start(), wait)


def run_append(
    source: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: tuple[str, ...] = (),
    retention: str | None = None,
    trigger: dict | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Append to a Parquet folder, each row once.

    ``retention`` is how long the folder's log names a file: see :mod:`starflow.sinks.appended`.

    The folder logs the batches it has, by number.  A checkpoint that has not begun
    starts at number 0 again, and its batches would pass for those already there: their
    rows would be lost without a word.  So it is refused over a folder that has any.
    """
    spark = source.sparkSession
    if files.matching(spark, f"{path}/_spark_metadata/*") and not files.matching(spark, f"{checkpoint}/offsets/*"):
        raise ValueError(f"{path} holds batches that the new checkpoint {checkpoint} does not know; restore it or start a new table")
    writer = source.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if retention:
        writer = writer.option("retention", retention)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _finish(writer.trigger(**(trigger or ONCE)).start(path), wait)
