"""Batch queries: ``(spark, sf_dir) -> DataFrame``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow import schemas
from starflow.functions import keys
from starflow.operators import calendar, cleaning, facts, kpi, members, scd2
from starflow.operators.latest import latest_per_key
from starflow.plans import visits as v
from starflow.session import workspace
from starflow.sinks import catalog, serving, snapshots
from starflow.sources import broker, tables

NTZ_PATIENT = schemas.as_ntz(schemas.PATIENT_DIM)
NTZ_CLEAN = schemas.as_ntz(schemas.CLEAN)
NTZ_FACT = schemas.as_ntz(schemas.FACT)
KEY_AND_MEASURES = [c for c in schemas.FACT.names if c != "fact_id"]


# --- shared steps -----------------------------------------------------------


def history(clean: DataFrame) -> DataFrame:
    return scd2.history(clean, "batch", v.effective(), v.LATEST)


def incoming(clean: DataFrame, batch: int) -> DataFrame:
    return scd2.members(v.only(clean, batch), v.LATEST)


def stored_patients(spark: SparkSession, clean: DataFrame, path: str) -> DataFrame:
    """The patient dimension, written and read back: a lookup side of known size."""
    snapshots.publish(history(clean), path, 0, partition_by=["is_current"])
    return snapshots.read_history(spark, path, NTZ_PATIENT)


def stored_departments(spark: SparkSession, clean: DataFrame, path: str) -> DataFrame:
    snapshots.publish(members.department_members(clean), path, 0)
    return snapshots.read_increments(spark, path, schemas.DEPARTMENT_DIM)


def star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts, patient versions and departments.  The dimensions are stored tables."""
    clean, base = v.silver(spark, sf_dir), workspace(spark)
    patients = stored_patients(spark, clean, f"{base}/dim_patient")
    departments = stored_departments(spark, clean, f"{base}/dim_department")
    rows = facts.enrich(v.fact_rows(clean), scd2.current_members(patients), departments)
    return rows, patients, departments


# --- scans, literals, raw rows ------------------------------------------------


def batch_table_scan(spark, sf_dir):
    return tables.scan(spark, f"{sf_dir}/events.parquet")


def dim_patient_current(spark, sf_dir):
    path = f"{workspace(spark)}/dim_patient"
    return scd2.current_members(stored_patients(spark, v.silver(spark, sf_dir), path))


# A hand-written event for the backfill.
MANUAL_EVENT = """
{
  "patient_id": "P1", "gender": "Male", "age": 41, "department": "view",
  "admission_time": "2024-01-09T07:15:30.250000",
  "discharge_time": "2024-01-12T16:40:00.500000",
  "bed_id": 212, "hospital_id": 3
}
"""


def literal_rows(spark, sf_dir):
    """The raw rows of all events with one written by hand among them, parsed."""
    text = v.raw(spark, sf_dir).select("raw_json")
    parsed = cleaning.parse_events(text.unionByName(tables.literal_events(spark, [MANUAL_EVENT])))
    return cleaning.usable(parsed)


def raw_from_bytes(spark, sf_dir):
    messages = v.raw(spark, sf_dir).select(
        F.lit(None).cast("binary").alias("key"),
        F.encode("raw_json", "UTF-8").alias("value"),
        F.col("event_id").alias("offset"),
    )
    return broker.decode_messages(messages)


def json_parse_visits(spark, sf_dir):
    return cleaning.parse_events(v.raw(spark, sf_dir)).drop("raw_json", "batch")


def parse_timestamps(spark, sf_dir):
    times = ("admission_time", "discharge_time")
    parsed = cleaning.parse_times(cleaning.parse_events(v.raw(spark, sf_dir)))
    return parsed.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in times])


# --- cleaning ----------------------------------------------------------------


def conform_columns(spark, sf_dir):
    """Visits that lack a column and carry one too many."""
    narrow = v.visits(spark, sf_dir).drop("hospital_id").withColumnRenamed("admission_in", "admission_time")
    target = schemas.with_field(schemas.as_ntz(schemas.CLEAN), "event_id", T.LongType())
    return cleaning.conform(narrow, target)


def clean_admission_time(spark, sf_dir):
    arrived = v.visits(spark, sf_dir).select("event_id", F.col("admission_in").alias("admission_time"))
    return cleaning.repair_admission(arrived, v.AS_OF)


def clean_age(spark, sf_dir):
    return cleaning.cap_age(v.visits(spark, sf_dir).select("event_id", "age"))


def silver_visits(spark, sf_dir):
    return v.silver(spark, sf_dir)


def silver_from_raw(spark, sf_dir):
    """The whole stage from the JSON text on; zone-free times for the comparison."""
    parsed = cleaning.usable(cleaning.parse_events(v.raw(spark, sf_dir)))
    clean = cleaning.clean_visits(parsed, v.AS_OF)
    return clean.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("admission_time", "discharge_time")})


def quarantine_rows(spark, sf_dir):
    return cleaning.quarantine(cleaning.parse_events(v.raw(spark, sf_dir))).select("event_id", "reason")


def schema_merge_read(spark, sf_dir):
    """Batch 0 was written before ``hospital_id`` existed."""
    clean = v.silver(spark, sf_dir).select("event_id", "patient_id", "hospital_id", "batch")
    path = f"{workspace(spark)}/visits"
    v.only(clean, 0).drop("hospital_id").write.parquet(f"{path}/generation=0")
    clean.filter(F.col("batch") > 0).write.parquet(f"{path}/generation=1")
    return tables.scan(spark, path, merge=True).drop("generation")


# --- keys --------------------------------------------------------------------


def attr_fingerprint(spark, sf_dir):
    return v.silver(spark, sf_dir).select("event_id", keys.fingerprint(scd2.ATTRS).alias("attr_hash"))


def surrogate_keys(spark, sf_dir):
    return v.silver(spark, sf_dir).select(
        "event_id", keys.patient_key().alias("patient_sk"), keys.department_key().alias("department_sk")
    )


def fact_row_id(spark, sf_dir):
    return v.silver(spark, sf_dir).select("event_id", keys.row_id(facts.NATURAL_KEY).alias("fact_id"))


def fact_row_id_groups(spark, sf_dir):
    """Grouped by id: the same groups as by natural key, or ids had collided."""
    clean = v.silver(spark, sf_dir).withColumn("fact_id", keys.row_id(facts.NATURAL_KEY))
    return (
        clean.groupBy("fact_id")
        .agg(*[F.min(c).alias(c) for c in facts.NATURAL_KEY], F.count(F.lit(1)).alias("visits"))
        .drop("fact_id")
    )


# --- patient and department dimension ------------------------------------------


def latest_per_patient(spark, sf_dir):
    columns = ["event_id", "patient_id", "gender", "age", "admission_time"]
    return latest_per_key(v.silver(spark, sf_dir).select(*columns), ["patient_id"], v.LATEST)


def scd2_history(spark, sf_dir):
    return history(v.silver(spark, sf_dir))


def scd2_expire(spark, sf_dir):
    """Target: batches 0 and 1.  Merge 1 with batch 2."""
    clean = v.silver(spark, sf_dir)
    target = history(clean.filter(F.col("batch") <= 1))
    return scd2.expire(target, incoming(clean, 2), v.batch_clock(2))


def scd2_insert(spark, sf_dir):
    """The same target after both merges."""
    return scd2.insert(scd2_expire(spark, sf_dir), incoming(v.silver(spark, sf_dir), 2), v.batch_clock(2))


def scd2_step(spark, sf_dir):
    """All three batches, one after the other, each in one join."""
    clean = v.silver(spark, sf_dir)
    dimension = tables.empty(spark, NTZ_PATIENT)
    for batch in v.BATCHES:
        dimension = scd2.apply(dimension, incoming(clean, batch), v.batch_clock(batch))
    return dimension


def scd2_late_events(spark, sf_dir):
    """Batches arrive in the order 0, 2, 1; an older event may not replace a newer version."""
    clean = v.silver(spark, sf_dir)
    schema = schemas.with_field(NTZ_PATIENT, scd2.APPLIED, T.TimestampNTZType())
    dimension = tables.empty(spark, schema)
    for arrival, batch in enumerate((0, 2, 1)):
        rows = scd2.members(v.only(clean, batch), v.LATEST, late_guard=True)
        dimension = scd2.apply(dimension, rows, v.batch_clock(arrival), late_guard=True)
    return dimension.drop(scd2.APPLIED)


def scd2_late_history(spark, sf_dir):
    """The same in one pass: arrival 0, 1, 2 is batch 0, 2, 1."""
    arrival = F.when(F.col("batch") == 0, 0).otherwise(3 - F.col("batch"))
    clean = v.silver(spark, sf_dir).withColumn("arrival", arrival)
    return scd2.history(clean, "arrival", v.effective("arrival"), v.LATEST, late_guard=True)


def dim_department_members(spark, sf_dir):
    return members.department_members(v.silver(spark, sf_dir))


def dim_department_merge(spark, sf_dir):
    """Batch 0, then the others, each merged into what is there."""
    clean = v.silver(spark, sf_dir)
    base = workspace(spark)
    path = f"{base}/dim_department"
    for batch in v.BATCHES:
        stored = snapshots.read_increments(spark, path, schemas.DEPARTMENT_DIM)
        arrived = members.department_members(v.only(clean, batch))
        if batch == v.BATCHES[-1]:
            return members.insert_absent(stored, arrived)
        snapshots.publish(members.absent(stored, arrived), path, batch)


def dim_date(spark, sf_dir):
    admitted = v.silver(spark, sf_dir).select(F.to_date("admission_time").alias("admission_date"))
    return calendar.date_dimension(admitted)


# --- facts -------------------------------------------------------------------


def fact_measures(spark, sf_dir):
    return facts.measures(v.silver(spark, sf_dir), v.AS_OF).select(
        "event_id", "admission_date", "length_of_stay_hours", "is_currently_admitted", "is_open_stay"
    )


def fact_lookup_patient(spark, sf_dir):
    clean = v.silver(spark, sf_dir)
    patients = stored_patients(spark, clean, f"{workspace(spark)}/dim_patient")
    rows = v.fact_rows(clean).select(*facts.NATURAL_KEY, "bed_id")
    return facts.lookup_patient(rows, scd2.current_members(patients))


def fact_lookup_department(spark, sf_dir):
    clean = v.silver(spark, sf_dir)
    departments = stored_departments(spark, clean, f"{workspace(spark)}/dim_department")
    return facts.lookup_department(v.fact_rows(clean).select(*facts.NATURAL_KEY, "bed_id"), departments)


def fact_unresolved_keys(spark, sf_dir):
    """All facts against departments of batch 0 and patients without P1 to P5."""
    clean, base = v.silver(spark, sf_dir), workspace(spark)
    patients = stored_patients(spark, clean, f"{base}/dim_patient")
    known = scd2.current_members(patients).filter(~F.col("patient_id").isin("P1", "P2", "P3", "P4", "P5"))
    departments = stored_departments(spark, v.only(clean, 0), f"{base}/dim_department")
    missing = facts.unresolved(facts.enrich(v.fact_rows(clean), known, departments))
    return missing.select(*facts.NATURAL_KEY, "patient_missing", "department_missing")


def fact_resolved_late(spark, sf_dir):
    """Facts looked up before most dimension members came, looked up again, and exported."""
    clean, base = v.silver(spark, sf_dir), workspace(spark)
    patients = scd2.current_members(stored_patients(spark, clean, f"{base}/dim_patient"))
    departments = stored_departments(spark, clean, f"{base}/dim_department")
    early = stored_departments(spark, v.only(clean, 0), f"{base}/dim_department_early")
    known = patients.filter(~F.col("patient_id").isin("P1", "P2", "P3", "P4", "P5"))
    rows = facts.resolve(facts.enrich(v.fact_rows(clean), known, early), patients, departments)
    name = _table_name(base, "resolved_fact")
    return serving.export(spark, rows, serving.FACT, name, f"{base}/serve_fact").drop("fact_id")


def fact_upsert(spark, sf_dir):
    """Target: batches 0 and 1.  Source: batch 2, and batch 1 again with discharge five hours later."""
    clean, base = v.silver(spark, sf_dir), workspace(spark)
    patients = scd2.current_members(stored_patients(spark, clean, f"{base}/dim_patient"))
    departments = stored_departments(spark, clean, f"{base}/dim_department")
    early, late = clean.filter(F.col("batch") <= 1), clean.filter(F.col("batch") >= 1)
    again = F.when(F.col("batch") == 1, F.col("discharge_time") + F.expr("INTERVAL 5 HOURS"))
    late = late.withColumn("discharge_time", again.otherwise(F.col("discharge_time")))
    target = facts.enrich(v.fact_rows(early, v.batch_clock(1)), patients, departments)
    source = facts.enrich(v.fact_rows(late, v.batch_clock(2)), patients, departments)
    return facts.upsert(target, source).select(*KEY_AND_MEASURES)


def fact_partitioned_roundtrip(spark, sf_dir):
    path = f"{workspace(spark)}/fact"
    catalog.write_partitioned(v.fact_rows(v.silver(spark, sf_dir)), path, "admission_date")
    return tables.scan(spark, path).drop("fact_id")


# --- KPIs --------------------------------------------------------------------


def _patient_facts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Facts with their patient, and all patient versions; no KPI asks for the department."""
    clean = v.silver(spark, sf_dir)
    patients = stored_patients(spark, clean, f"{workspace(spark)}/dim_patient")
    return facts.lookup_patient(v.fact_rows(clean), scd2.current_members(patients)), patients


def kpi_bed_occupancy(spark, sf_dir):
    rows, patients = _patient_facts(spark, sf_dir)
    return kpi.bed_occupancy(rows, patients.filter("is_current"))


def kpi_bed_occupancy_all_versions(spark, sf_dir):
    rows, patients = _patient_facts(spark, sf_dir)
    return kpi.bed_occupancy(rows, patients)


def kpi_bed_turnover(spark, sf_dir):
    rows, patients = _patient_facts(spark, sf_dir)
    return kpi.bed_turnover(rows, patients.filter("is_current"))


def kpi_bed_turnover_all_versions(spark, sf_dir):
    rows, patients = _patient_facts(spark, sf_dir)
    return kpi.bed_turnover(rows, patients)


# --- catalog and exports --------------------------------------------------------


def _table_name(base: str, name: str) -> str:
    """A name of its own for each call, as the catalog is shared."""
    return f"{name}_{base.rsplit('-', 1)[1]}"


def ddl_declared_table(spark, sf_dir):
    """Declared empty, then filled."""
    base = workspace(spark)
    name = _table_name(base, "dim_patient")
    catalog.declare_table(spark, name, NTZ_PATIENT, f"{base}/dim_patient")
    history(v.silver(spark, sf_dir)).select(*NTZ_PATIENT.names).write.insertInto(name)
    return spark.table(name)


def ddl_registered_table(spark, sf_dir):
    base = workspace(spark)
    catalog.write_partitioned(v.fact_rows(v.silver(spark, sf_dir)), f"{base}/fact", "admission_date")
    return catalog.register_table(spark, _table_name(base, "fact"), f"{base}/fact").drop("fact_id")


def serve_dim_patient(spark, sf_dir):
    clean, base = v.silver(spark, sf_dir), workspace(spark)
    patients = stored_patients(spark, clean, f"{base}/dim_patient")
    return serving.export(
        spark, patients, serving.PATIENT, _table_name(base, "serve_patient"), f"{base}/serve_patient"
    )


def serve_dim_department(spark, sf_dir):
    clean, base = v.silver(spark, sf_dir), workspace(spark)
    departments = stored_departments(spark, clean, f"{base}/dim_department")
    return serving.export(
        spark, departments, serving.DEPARTMENT, _table_name(base, "serve_department"), f"{base}/serve_department"
    )


def _serve_fact(spark, sf_dir) -> str:
    rows, _, _ = star(spark, sf_dir)
    base = workspace(spark)
    name = _table_name(base, "serve_fact")
    serving.export(spark, rows, serving.FACT, name, f"{base}/serve_fact")
    return name


def serve_fact(spark, sf_dir):
    """The typed export; its id has no SQL counterpart and is left out here."""
    return spark.table(_serve_fact(spark, sf_dir)).drop("fact_id")


def serve_fact_refresh(spark, sf_dir):
    """An export of part of the facts, then one of all to the same place."""
    rows, _, _ = star(spark, sf_dir)
    base = workspace(spark)
    name = _table_name(base, "serve_fact_refresh")
    early = rows.where(F.col("admission_date") < F.lit("2024-01-15").cast("date"))
    for part in (early, rows):
        out = serving.export(spark, part, serving.FACT, name, f"{base}/serve_fact")
    return out.drop("fact_id")


def serve_fact_select(spark, sf_dir):
    """SELECT * over the exported table, in SQL."""
    return spark.sql(f"SELECT * EXCEPT (fact_id) FROM {_serve_fact(spark, sf_dir)}")


QUERIES = {
    f.__name__: f
    for f in (
        batch_table_scan, dim_patient_current, literal_rows, raw_from_bytes, json_parse_visits,
        parse_timestamps, conform_columns, clean_admission_time, clean_age, silver_visits,
        silver_from_raw, quarantine_rows, schema_merge_read, attr_fingerprint, surrogate_keys,
        fact_row_id, fact_row_id_groups, latest_per_patient, scd2_history, scd2_expire, scd2_insert,
        scd2_step, scd2_late_events, scd2_late_history, dim_department_members, dim_department_merge,
        dim_date, fact_measures, fact_lookup_patient, fact_lookup_department, fact_unresolved_keys,
        fact_resolved_late, fact_upsert, fact_partitioned_roundtrip, kpi_bed_occupancy, kpi_bed_occupancy_all_versions,
        kpi_bed_turnover, kpi_bed_turnover_all_versions, ddl_declared_table, ddl_registered_table,
        serve_dim_patient, serve_dim_department, serve_fact, serve_fact_refresh, serve_fact_select,
    )
}
