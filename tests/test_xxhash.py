"""The SQL form of ``xxhash64`` against Spark's."""

import duckdb
import pytest

from starflow.plans.xxhash import Steps

TEXTS = [None, "", "a", "abc", "abcd", "abcde", "abcdefg", "abcdefgh", "P12345678", "0123456789ab", "x" * 15, "y" * 16, "The words of it, 31 characters!"]


def in_sql(kind, values, read):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (n INTEGER, v {kind})")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    steps = Steps("SELECT * FROM t")
    read(steps)
    return [r[1] for r in sorted(con.sql(f"SELECT n, {steps.signed()} FROM ({steps.sql})").fetchall())]


@pytest.mark.parametrize(
    "kind, spark_kind, values, read",
    [
        ("VARCHAR", "string", TEXTS, lambda s: s.text("v")),
        ("INTEGER", "int", [None, 0, 1, 7, 2**31 - 1], lambda s: s.number("v", 4)),
        ("BIGINT", "long", [None, 0, 1, 1_706_659_200_000_000, 2**63 - 1], lambda s: s.number("v", 8)),
    ],
)
def test_each_type(spark, kind, spark_kind, values, read):
    df = spark.createDataFrame(list(enumerate(values)), f"n int, v {spark_kind}")
    want = [r[1] for r in sorted(df.selectExpr("n", "xxhash64(v)").collect())]
    assert in_sql(kind, values, read) == want


def test_columns_one_after_the_other(spark):
    rows = [("P1", 3), (None, 3), ("P1", None), (None, None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (n INTEGER, a VARCHAR, b INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(k, *r) for k, r in enumerate(rows)])
    steps = Steps("SELECT * FROM t")
    steps.text("a")
    steps.number("b", 4)
    got = [r[1] for r in sorted(con.sql(f"SELECT n, {steps.signed()} FROM ({steps.sql})").fetchall())]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "n int, a string, b int")
    assert got == [r[1] for r in sorted(df.selectExpr("n", "xxhash64(a, b)").collect())]
