"""Every registered query against its SQL, and the sizes known for the data."""

import pytest

import __spark_entry__ as contract
from compare import DATA, connect, differences

CONTRACT = """
stream_table_scan batch_table_scan dim_patient_current literal_rows serve_fact_select land_raw_stream
land_raw_backfill schema_merge_read stream_dim_patient stream_dim_department stream_fact
fact_partitioned_roundtrip ddl_declared_table ddl_registered_table serve_dim_patient serve_dim_department
serve_fact raw_from_bytes conform_columns clean_admission_time clean_age silver_visits quarantine_rows
scd2_expire scd2_insert scd2_step scd2_history dim_department_merge fact_upsert fact_lookup_patient
fact_lookup_department fact_unresolved_keys kpi_bed_occupancy kpi_bed_occupancy_all_versions
kpi_bed_turnover kpi_bed_turnover_all_versions dim_date dim_department_members latest_per_patient
json_parse_visits parse_timestamps attr_fingerprint surrogate_keys fact_row_id fact_measures
stream_incremental_rerun stream_replay_idempotent scd2_late_events
""".split()

OWN = set(contract.queries()) - set(contract.corpus_queries)
QUERIES = {name: query for name, query in contract.queries().items() if name in OWN}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}


def test_the_whole_contract_is_registered():
    assert len(CONTRACT) == 48
    assert set(CONTRACT) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_its_sql(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, SQL[name]) == []


@pytest.mark.parametrize(
    "name, rows",
    [
        ("silver_visits", 1000),
        ("quarantine_rows", 42),
        ("dim_department_members", 40),
        ("scd2_history", 45),
        ("dim_patient_current", 15),
        ("fact_row_id_groups", 963),
        ("fact_row_id", 1000),
    ],
)
def test_known_sizes(spark, data, name, rows):
    assert QUERIES[name](spark, data).count() == rows


@pytest.mark.parametrize(
    "name, female, male",
    [
        ("kpi_bed_occupancy", 5.895197, 3.960396),
        ("kpi_bed_occupancy_all_versions", 5.350877, 4.574042),
        ("kpi_bed_turnover", 1.297450, 1.335979),
        ("kpi_bed_turnover_all_versions", 1.630021, 1.937626),
    ],
)
def test_known_kpis(spark, data, name, female, male):
    got = {r[0]: round(r[1], 6) for r in QUERIES[name](spark, data).collect()}
    assert got == {"Female": female, "Male": male}


def test_known_faults(spark, data):
    from pyspark.sql import functions as F

    silver = QUERIES["silver_visits"](spark, data)
    ahead = F.col("discharge_time") > F.lit("2024-01-31").cast("timestamp_ntz")
    counts = silver.agg(
        F.count_if("admission_repaired"),
        F.count_if(F.col("discharge_time").isNull()),
        F.count_if(ahead),
        F.count_if(F.col("discharge_time") < F.col("admission_time")),
        F.count_if(F.col("hospital_id").isNull()),
    ).first()
    assert tuple(counts) == (91, 91, 47, 78, 11)


def test_entry(spark, data):
    assert contract.entry(spark).columns == ["gender", "bed_occupancy_percent"]
