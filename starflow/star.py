"""One star schema below a root folder: its paths, its jobs in order, its readers."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starflow import files, schemas
from starflow.operators import facts, kpi, scd2, timeline
from starflow.operators.calendar import date_dimension
from starflow.sinks import appended, serving, snapshots
from starflow.streaming import jobs


class Star:
    """The five tables, each brought up to date by the method of its name.

    ``extra`` declares the columns that raw rows carry beside the text.  They travel
    to the clean table, and the broker's own decide which of two copies is newer.  The
    numbers of hash buckets belong to the stored tables: a root keeps those it began with.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        extra: T.StructType = schemas.BROKER,
        patient_buckets: int = jobs.PATIENT_BUCKETS,
        fact_buckets: int = jobs.FACT_BUCKETS,
    ):
        self.spark, self.root, self.extra = spark, root.rstrip("/"), extra
        self.patient_buckets, self.fact_buckets = patient_buckets, fact_buckets
        arrival = [c for c in ("timestamp", "partition", "offset") if c in extra.names]
        self.patient_order = (scd2.EVENT_TIME, *arrival)
        self.fact_order = facts.arrival_order() if len(arrival) == 3 else (*arrival, *facts.DETAILS)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/checkpoints/{table}"

    # --- jobs ---

    def _short_log(self, table: str, run: dict) -> dict:
        """A run that ends lets the log forget what :meth:`fold` took; one that goes on keeps all."""
        kept = None if run.get("trigger") else appended.forget_after(self.spark, self.path(table))
        return {"retention": kept, **run}

    def land(self, messages: DataFrame, **run) -> StreamingQuery:
        return jobs.land(messages, self.path("raw"), self.checkpoint("raw"), **self._short_log("raw", run))

    def backfill(self, rows: DataFrame) -> None:
        jobs.backfill(rows, self.path("raw_backfill"))

    def clean(self, backfilled: bool = True, **run) -> StreamingQuery:
        """Reads the streamed and the hand-filled folder, so a backfill may come at any time.

        A checkpoint keeps the sources that it began with: pass ``backfilled=False`` for
        one that began without the hand-filled folder.
        """
        sources = [self.path("raw")]
        if backfilled:
            sources.append(self.path("raw_backfill"))
            files.make_folder(self.spark, sources[-1])
        schema = T.StructType(schemas.RAW.fields + self.extra.fields)
        raw = jobs.raw_stream(self.spark, *sources, schema=schema)
        return jobs.clean(raw, self.path("clean"), self.checkpoint("clean"), **self._short_log("clean", run))

    def fold(self, until: datetime | None = None) -> list[str]:
        """Folds the files of the raw and clean table written before ``until`` (default: a day ago).

        Every stream that reads them must have run since.  Returns the tables that had any.
        """
        until = until or datetime.now() - timedelta(days=1)
        raw = T.StructType(schemas.RAW.fields + self.extra.fields)
        tables = (("raw", raw, ()), ("clean", jobs.clean_schema(self.extra), ("reject_reason",)))
        found = [t for t in tables if files.exists(self.spark, f"{self.path(t[0])}/_spark_metadata")]
        return [name for name, schema, by in found if appended.fold(self.spark, self.path(name), schema, until, by)]

    def visits(self, max_files: int | None = None) -> DataFrame:
        return jobs.visits_stream(self.spark, self.path("clean"), self.extra, max_files)

    def dim_patient(self, max_files: int | None = None, **run) -> StreamingQuery:
        return jobs.patient_dimension(
            self.visits(max_files),
            self.path("dim_patient"),
            self.checkpoint("dim_patient"),
            by=self.patient_order,
            buckets=self.patient_buckets,
            **run,
        )

    def dim_department(self, max_files: int | None = None, horizon: str | None = None, **run) -> StreamingQuery:
        """With ``horizon`` the members of so long a stretch of the broker's time are remembered between batches."""
        if horizon and "timestamp" not in self.extra.names:
            raise ValueError("a horizon needs the broker's timestamp")
        return jobs.department_dimension(
            self.visits(max_files),
            self.path("dim_department"),
            self.checkpoint("dim_department"),
            time="timestamp",
            horizon=horizon,
            **run,
        )

    def timeline(self, max_files: int | None = None, **run) -> StreamingQuery:
        """The patients by event time, late events in their place; read with :meth:`patients_by_event_time`."""
        return jobs.patient_timeline(
            self.visits(max_files),
            self.path("timeline"),
            self.checkpoint("timeline"),
            schema=self._points(),
            by=self.patient_order,
            buckets=self.patient_buckets,
            **run,
        )

    def fact(self, max_files: int | None = None, **run) -> StreamingQuery:
        return jobs.fact_table(
            self.visits(max_files),
            self.path("fact"),
            self.checkpoint("fact"),
            patients=self._members,
            departments=self._departments,
            patient_buckets=self.patient_buckets,
            by=self.fact_order,
            buckets=self.fact_buckets,
            **run,
        )

    def resolve(self, keep: int | None = 2) -> int:
        """Fills the keys of facts that came before their dimension members.

        Not while :meth:`fact` runs: a table has one writer.  Returns how many dates changed.
        """
        return jobs.resolve_facts(
            self.spark,
            self.path("fact"),
            patients=self._members,
            departments=self._departments,
            buckets=self.fact_buckets,
            keep=keep,
        )

    # --- readers ---

    def raw(self) -> DataFrame:
        return appended.read_appended(self.spark, self.path("raw"), T.StructType(schemas.RAW.fields + self.extra.fields))

    def _points(self) -> T.StructType:
        return timeline.points_schema(T.StructType(schemas.CLEAN.fields + self.extra.fields), self.patient_order)

    def _patients(self, spark: SparkSession, current: bool | None = None) -> DataFrame:
        return snapshots.read_history(spark, self.path("dim_patient"), schemas.PATIENT_DIM, current=current)

    def _members(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        stored = jobs.read_current(spark, self.path("dim_patient"), schemas.PATIENT_DIM, self.patient_buckets, buckets)
        return scd2.current_members(stored)

    def _departments(self, spark: SparkSession) -> DataFrame:
        return snapshots.read_increments(spark, self.path("dim_department"), schemas.DEPARTMENT_DIM)

    def rejected(self) -> DataFrame:
        return jobs.rejected(self.spark, self.path("clean"), self.extra)

    def patients(self, current: bool | None = None) -> DataFrame:
        return self._patients(self.spark, current)

    def patients_by_event_time(self) -> DataFrame:
        return jobs.read_timeline(self.spark, self.path("timeline"), self._points(), self.patient_buckets)

    def departments(self) -> DataFrame:
        return self._departments(self.spark)

    def facts(self) -> DataFrame:
        return jobs.read_facts(self.spark, self.path("fact"))

    def dates(self) -> DataFrame:
        return date_dimension(self.facts())

    def bed_occupancy(self, all_versions: bool = False) -> DataFrame:
        return kpi.bed_occupancy(self.facts(), self.patients(None if all_versions else True))

    def bed_turnover(self, all_versions: bool = False) -> DataFrame:
        return kpi.bed_turnover(self.facts(), self.patients(None if all_versions else True))

    def count_beds(self) -> list[str]:
        """Brings the stored counts behind the KPIs up to the facts; returns the dates counted again."""
        return jobs.update_partials(self.spark, self.path("kpi"), self.path("fact"))

    def stored_occupancy(self, all_versions: bool = False) -> DataFrame:
        """:meth:`bed_occupancy` from the counts that :meth:`count_beds` stored."""
        counts = jobs.read_partials(self.spark, self.path("kpi"))
        return kpi.occupancy_of(counts, self.patients(None if all_versions else True))

    def stored_turnover(self, all_versions: bool = False) -> DataFrame:
        """:meth:`bed_turnover` from the counts that :meth:`count_beds` stored."""
        counts = jobs.read_partials(self.spark, self.path("kpi"))
        return kpi.turnover_of(counts, self.patients(None if all_versions else True))

    # --- warehouse ---

    def serve(self, location: str, prefix: str = "") -> dict[str, DataFrame]:
        """Typed exports of the published tables below ``location``, as catalog tables.

        Dimensions are exported whole.  The fact export is partitioned by date, and only the
        dates written since the last export to this place are replaced.
        """
        exports = {
            "dim_patient": (self.patients(), serving.PATIENT),
            "dim_department": (self.departments(), serving.DEPARTMENT),
        }
        served = {
            name: serving.export(self.spark, df, layout, f"{prefix}{name}", f"{location}/{name}")
            for name, (df, layout) in exports.items()
        }
        columns = [schemas.DATE, snapshots.BUCKETS]
        served["fact"], _ = serving.export_changes(
            self.spark, self.path("fact"), schemas.FACT, columns, serving.FACT, f"{prefix}fact", f"{location}/fact"
        )
        return served
