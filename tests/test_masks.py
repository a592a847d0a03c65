"""Masks: edge rows of FIXTURES.md §4, Column and SQL forms agree, role gate."""

import pytest
from pyspark.sql import functions as F

from veilspark.functions import masks as M

EDGES = [
    ("name", "Joe Smith", "Joe S."),
    ("name", "Dr. Joe Smith", "Dr. J."),
    ("name", "Cher", "Cher ."),
    ("name", "", " ."),
    ("email", "joe@x.com", "j*****@x.com"),
    ("email", "nodomain", "n*****"),
    ("email", "", "*****"),
    ("phone", "555-919-4729", "********4729"),
    ("phone", "911", "***"),
    ("dob", "1980-02-03", "1980"),
    ("dob", "unknown", None),
    ("ssn", "123-45-6789", "***-**-6789"),
    ("ssn", "12", "***-**-****"),
    ("pan", "4111111111115678", "XXXXXXXXXXXX5678"),
    ("pan", "123", "XXX"),
    ("address", "123 Main Street", "123 Main S..."),
    ("address", "x", "x..."),
    ("exp-date", "09/27", "2027"),
    ("exp-date", "7", "207"),
] + [(t, None, None) for t in M.MASKS]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "stype string, v string, expected string")


def test_column_masks_match_expected(spark, edges):
    rows = edges.collect()
    by_type = {}
    for r in rows:
        by_type.setdefault(r.stype, []).append(r)
    for stype, rs in by_type.items():
        df = spark.createDataFrame([(r.v, r.expected) for r in rs], "v string, expected string")
        got = df.select("v", "expected", M.mask_column(F.col("v"), stype).alias("m")).collect()
        for g in got:
            assert g.m == g.expected, (stype, g.v, g.m, g.expected)


def test_sql_bodies_agree_with_columns(spark, edges):
    edges.createOrReplaceTempView("mask_edges")
    for stype, body in M.MASK_SQL.items():
        sql_rows = spark.sql(
            f"SELECT v, {body} AS m FROM (SELECT v FROM mask_edges WHERE stype = '{stype}')"
        ).collect()
        col_rows = edges.where(F.col("stype") == stype).select(
            "v", M.mask_column(F.col("v"), stype).alias("m")
        ).collect()
        assert sorted(map(tuple, sql_rows), key=str) == sorted(map(tuple, col_rows), key=str), stype


def test_unknown_type_raises():
    with pytest.raises(KeyError):
        M.mask_for("iban")


def test_role_gate(spark):
    members = spark.createDataFrame([("g", "alice")], "grp string, member string")
    df = spark.createDataFrame([("123-45-6789",)], "ssn string")
    alice = M.is_member(members, "g", F.lit("alice"))
    bob = M.is_member(members, "g", F.lit("bob"))
    r = df.select(M.gated("ssn", "ssn", alice).alias("a"), M.gated("ssn", "ssn", bob).alias("b")).first()
    assert r.a == "123-45-6789" and r.b == "***-**-6789"


def test_masks_are_native_expressions(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("v"))
    out = df.select(*[M.mask_column("v", t).alias(t.replace("-", "_")) for t in M.MASKS])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
