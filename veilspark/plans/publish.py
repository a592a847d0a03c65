"""Write, audit, publish: a table's data changes by one switch of its location.

A new version is written whole beside the old one, ``<table>.v-<id>`` in the folder of the
table's database. What the write has counted in passing (rows, and rows that break a rule of
the load) is held against what the files hold (their footers; data isn't read again). Only then
``ALTER TABLE ... SET LOCATION`` makes it the table's data. Readers see the old version or the
new one; a crash at any step leaves the old one, and what it left behind goes with the next
publish. The version before stays for running readers until then.

Partitions are found in the folders, not listed in the catalog, so that one switch covers them all.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.hashing import hash_column_name
from veilspark.operators.protect import TablePlan
from veilspark.sources.files import table_location
from veilspark.storage import Files


class AuditError(RuntimeError):
    """What was written isn't what the load promises; nothing was published."""


def unhashed(plan: TablePlan) -> dict[str, Column]:
    """Audit rules of a vault table: each value has a hash, each NULL has none."""
    return {f"{c} and its hash": F.col(f"`{c}`").isNull() != F.col(f"`{hash_column_name(c)}`").isNull() for c in plan.hashed}


def write_audited(df: DataFrame, path: str, partition_by: list[str], faults: Mapping[str, Column] | None = None,
                  max_records_per_file: int | None = None) -> int:
    """Writes parquet files and returns the number of rows. ``faults``: what may hold for no row, by name."""
    faults = dict(faults or {})
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(f"fault{i}") for i, c in enumerate(faults.values())])
    w = counted.write
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    found = seen.get
    rows = found.get("rows", 0)
    stored = df.sparkSession.read.schema(df.schema).parquet(path).count()  # of the footers
    problems = [f"{n} rows break the rule on {name}" for i, name in enumerate(faults) if (n := found.get(f"fault{i}", 0))]
    if stored != rows:
        problems.append(f"{rows} rows were written and {stored} are there")
    if problems:
        raise AuditError("; ".join(problems))
    return rows


def create_empty(spark: SparkSession, name: str, columns: str, partition_by: list[str]) -> None:
    """The table, if absent, with partitions that are found in its folders."""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    own = spark.newSession()  # the setting holds for this statement only, whatever other threads do
    own.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    own.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}")


def publish_version(df: DataFrame, name: str, partition_by: list[str], faults: Mapping[str, Column] | None = None,
                    max_records_per_file: int | None = None) -> int:
    """SNK-4: the rows of ``df`` become the data of the table; returns their number."""
    spark, files = df.sparkSession, Files(df.sparkSession)
    before = table_location(spark, name)
    folder = before.rsplit("/", 1)[0]
    table = name.replace("`", "").split(".")[-1]
    version = f"{folder}/{table}.v-{uuid.uuid4().hex}"
    try:
        rows = write_audited(df, version, partition_by, faults, max_records_per_file)
    except AuditError:
        files.delete(version)
        raise
    point_table(spark, name, version)
    old = re.compile(rf"{re.escape(table)}\.v-[0-9a-f]{{32}}")
    for entry in files.names(folder):
        if old.fullmatch(entry) and entry not in (before.rsplit("/", 1)[1], version.rsplit("/", 1)[1]):
            files.delete(f"{folder}/{entry}")
    return rows


def point_table(spark: SparkSession, name: str, version: str) -> None:
    quoted = version.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
    spark.catalog.refreshTable(name)
