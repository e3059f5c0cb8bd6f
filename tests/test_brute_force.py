"""Random batches against plain-Python simulations of what the tables should hold."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rows import as_set
from starflow import schemas
from starflow.operators import facts, members, scd2
from starflow.sources.tables import empty

DIM, FACT = schemas.as_ntz(schemas.PATIENT_DIM), schemas.as_ntz(schemas.FACT)
VISIT = T.StructType(
    [*schemas.as_ntz(schemas.CLEAN).fields, T.StructField("event_id", T.LongType()), T.StructField("batch", T.IntegerType())]
)
START = datetime(2026, 1, 1)
BATCHES = 4


def clock(batch):
    return START + timedelta(days=10 + batch)


def random_visits(seed, n=300):
    """Few patients and times, so that changes, copies and ties abound; a third is one patient."""
    rnd = random.Random(seed)
    rows = []
    for event_id in range(n):
        patient = "hot" if rnd.random() < 1 / 3 else f"p{rnd.randrange(12)}"
        admitted = START + timedelta(hours=rnd.randrange(60))
        discharged = None if rnd.random() < 0.2 else admitted + timedelta(minutes=rnd.randrange(-500, 30_000))
        rows.append(
            {
                "patient_id": patient,
                "gender": rnd.choice(["F", "M", None]),
                "age": rnd.choice([30, 31, None]),
                "department": rnd.choice(["ICU", "ER", None]),
                "admission_time": admitted,
                "discharge_time": discharged,
                "bed_id": rnd.choice([1, 2, 3, None]),
                "hospital_id": rnd.choice([1, 2, None]),
                "event_id": event_id,
                "batch": rnd.randrange(BATCHES),
            }
        )
    return rows


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in VISIT.names) for r in rows], VISIT)


def simulated_versions(rows, guard):
    """(patient, gender, age, from, to) after the batches in order."""
    state, out = {}, []
    for batch in range(BATCHES):
        newest = {}
        for r in rows:
            if r["batch"] == batch:
                key = (r["admission_time"], r["event_id"])
                if r["patient_id"] not in newest or key > newest[r["patient_id"]][0]:
                    newest[r["patient_id"]] = (key, r)
        for patient, (_, r) in newest.items():
            attrs = (r["gender"], r["age"])
            held = state.get(patient)
            if held and guard and r["admission_time"] <= held["seen"]:
                continue
            if held and held["attrs"] == attrs:
                held["seen"] = r["admission_time"]
                continue
            if held:
                out.append((patient, *held["attrs"], held["from"], clock(batch)))
            state[patient] = {"attrs": attrs, "from": clock(batch), "seen": r["admission_time"]}
    out += [(p, *s["attrs"], s["from"], None) for p, s in state.items()]
    return sorted(out, key=str)


COLUMNS = ("patient_id", "gender", "age", "effective_from", "effective_to")


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("guard", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_versions(spark, tmp_path, seed, guard, few):
    rows = random_visits(seed)
    visits, by = frame(spark, rows), ("admission_time", "event_id")
    want = simulated_versions(rows, guard)
    assert len(want) > 13

    schema = schemas.with_field(DIM, scd2.APPLIED, T.TimestampNTZType()) if guard else DIM
    dim = empty(spark, schema)
    for batch in range(BATCHES):
        incoming = scd2.members(visits.filter(F.col("batch") == batch), by, guard)
        scd2.apply(dim, incoming, clock(batch), guard, few).write.parquet(f"{tmp_path}/{batch}")
        dim = spark.read.parquet(f"{tmp_path}/{batch}")
    assert as_set(dim, *COLUMNS) == want

    effective = F.expr("TIMESTAMP_NTZ '2026-01-11 00:00:00' + make_dt_interval(batch)")
    assert as_set(scd2.history(visits, "batch", effective, by, guard), *COLUMNS) == want


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("seed", [4, 5])
def test_facts(spark, tmp_path, seed, few):
    rows = random_visits(seed)
    visits = frame(spark, rows)
    table = {}
    for batch in range(BATCHES):
        newest = {}
        for r in rows:
            key = tuple(r[k] for k in facts.NATURAL_KEY)
            if r["batch"] == batch and (key not in newest or r["event_id"] > newest[key]["event_id"]):
                newest[key] = r
        for key, r in newest.items():
            bed = table[key][1] if key in table else r["bed_id"]
            table[key] = (r["discharge_time"], bed, clock(batch))
    want = sorted([(*key, *values) for key, values in table.items()], key=str)

    patients = scd2.members(visits).select("patient_sk", "patient_id")
    departments = members.department_members(visits)
    stored = empty(spark, FACT)
    for batch in range(BATCHES):
        arrived = facts.fact_rows(visits.filter(F.col("batch") == batch), clock(9), clock(batch), ["event_id"])
        merged = facts.upsert(stored, facts.enrich(arrived, patients, departments), few)
        merged.write.parquet(f"{tmp_path}/{batch}")
        stored = spark.read.parquet(f"{tmp_path}/{batch}")
    columns = (*facts.NATURAL_KEY, "discharge_time", "bed_id", "event_ingestion_time")
    assert as_set(stored, *columns) == want
    assert stored.filter("patient_sk IS NULL OR department_sk IS NULL").isEmpty()


def test_a_hot_key_is_split_when_the_lookup_shuffles(spark):
    """Past the broadcast threshold AQE splits the hot partition of the fact side."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.range(0, 200_000, numPartitions=8).select(
            F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("patient_id"), "id"
        )
        dim = spark.range(0, 200_000, 3).select(F.col("id").cast("string").alias("patient_id"), F.lit("k").alias("patient_sk"))
        out = facts.lookup_patient(rows, dim)
        execution = out._jdf.queryExecution()
        assert execution.toRdd().count() == 200_000
        assert "skew=true" in execution.executedPlan().toString()
        assert out.filter("patient_sk IS NULL").count() == rows.filter("patient_id = 'hot'").count()
    finally:
        for key in settings:
            spark.conf.unset(key)
