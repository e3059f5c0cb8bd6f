import pytest
from pyspark.sql import functions as F

from rows import as_set, frame
from starflow import schemas, session
from starflow.__main__ import main
from starflow.sinks import catalog, serving
from starflow.sources import broker, tables


def test_declared_table(spark, tmp_path):
    table = catalog.declare_table(spark, "t_declared", schemas.DEPARTMENT_DIM, str(tmp_path / "d"))
    assert table.isEmpty() and table.schema == schemas.DEPARTMENT_DIM
    frame(spark, schemas.DEPARTMENT_DIM, {"department": "ICU", "hospital_id": 1, "department_sk": "x"}).write.insertInto(
        "t_declared"
    )
    again = catalog.declare_table(spark, "t_declared", schemas.DEPARTMENT_DIM, str(tmp_path / "d"))
    assert as_set(again, "department") == [("ICU",)]


def test_registered_table_finds_schema_and_partitions(spark, tmp_path):
    df = spark.sql("SELECT DATE '2026-01-01' AS admission_date, 1 AS n UNION ALL SELECT NULL, 2")
    catalog.write_partitioned(df, str(tmp_path / "f"), "admission_date")
    assert as_set(catalog.register_table(spark, "t_registered", str(tmp_path / "f")), "n") == [(1,), (2,)]


def test_first_partitioned_write_fails_if_the_path_exists(spark, tmp_path):
    df = spark.sql("SELECT DATE '2026-01-01' AS d")
    df.selectExpr("d", "1 AS n").write.parquet(str(tmp_path / "f"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        catalog.write_partitioned(df.selectExpr("d", "1 AS n"), str(tmp_path / "f"), "d")


def test_t13_exports_have_the_warehouse_columns_and_text_keys(spark, tmp_path):
    dim = frame(spark, schemas.PATIENT_DIM, {"patient_sk": "sk", "patient_id": "a", "is_current": True})
    out = serving.export(spark, dim, serving.PATIENT, "t_export", str(tmp_path / "e"))
    assert out.columns == [
        "patient_id", "gender", "age", "effective_from", "surrogate_key", "effective_to", "is_current",
    ]
    assert dict(out.dtypes)["surrogate_key"] == "string" and out.first().surrogate_key == "sk"
    fact = serving.typed(frame(spark, schemas.FACT, {}), serving.FACT)
    assert fact.columns == schemas.FACT.names[:10]


def test_a_column_missing_in_old_files_reads_null_either_way(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.sql("SELECT 1 AS a").write.parquet(path)
    spark.sql("SELECT 2 AS a, 'x' AS b").write.mode("append").parquet(path)
    want = [(1, None), (2, "x")]
    assert as_set(tables.scan(spark, path, merge=True), "a", "b") == want
    declared = tables.scan(spark, path, merge=True).schema
    assert as_set(tables.scan(spark, path, schema=declared), "a", "b") == want


def test_literal_events(spark):
    df = tables.literal_events(spark, ["{}", "x"])
    assert df.schema == schemas.RAW and df.count() == 2


def test_t14_broker_defaults_lose_nothing_and_can_be_overridden():
    options = broker.broker_options("h:9093", "topic")
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("earliest", "true")
    assert broker.broker_options("h", "t", startingOffsets="latest")["startingOffsets"] == "latest"


def test_broker_login_quotes_the_secret():
    login = broker.sasl_plain("user", 'a"b\\c')["kafka.sasl.jaas.config"]
    assert 'username="user"' in login and 'password="a\\"b\\\\c";' in login


def test_broker_login_class_can_be_another():
    from starflow.sources.broker import sasl_plain

    assert sasl_plain("u", "p", "shaded.Login")["kafka.sasl.jaas.config"].startswith("shaded.Login required")


def test_decoded_messages_keep_what_the_broker_says(spark):
    df = spark.createDataFrame([(None, b"{}", 3)], "key binary, value binary, offset long")
    assert as_set(broker.decode_messages(df), "offset", "raw_json") == [(3, "{}")]


def test_workspace_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = session.workspace(spark), session.workspace(spark)
    assert first != second
    assert shared is None or first.startswith(shared)


class Conf:
    def get(self, _key, default):
        return default


def pretend(master):
    context = type("Context", (), {"master": master})
    return type("Session", (), {"conf": Conf(), "sparkContext": context})()


def test_workspace_on_a_cluster_needs_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.workspace(pretend("yarn"))
    assert session.workspace(pretend("local[2]"))


def test_sizing_grows_with_the_input():
    small, large = session.sizing(1 << 30, 8), session.sizing(100 * (1 << 40), 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) == 20_000
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 512 << 20


def test_command_line_wants_its_arguments(spark, tmp_path):
    for step in ("land", "serve"):
        with pytest.raises(SystemExit):
            main(["--root", str(tmp_path), step])


def test_no_python_runs_in_the_tasks(spark, data):
    """Every batch query stays in the JVM and joins without a cross product."""
    from starflow.plans import batch

    for name in ("silver_visits", "scd2_step", "fact_upsert", "kpi_bed_turnover", "dim_date", "fact_unresolved_keys"):
        plan = batch.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "Arrow", "Cartesian", "BroadcastNestedLoop"):
            assert word not in plan, (name, word)


def test_scans_read_only_the_columns_they_need(spark, data):
    from starflow.plans import batch

    plan = batch.scd2_history(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_a_hot_patient_is_reduced_before_the_shuffle(spark):
    """Half of all rows belong to one patient; each map task sends one of them."""
    from starflow.operators.latest import latest_per_key

    rows = spark.range(0, 40_000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    plan = latest_per_key(rows, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")
    assert latest_per_key(rows, ["k"], ["id"]).filter("k = 'hot'").first().id == 39_998
