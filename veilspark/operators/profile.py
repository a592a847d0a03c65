"""Which hash columns can be joined, without joining them.

Equal clear values of one sensitivity type have equal hashes, so hash columns of one type
should share values. Hashes are uniform: those below a bound are a sample by value, the same
one in every table, and a filter that the scan can push down. The distinct sampled hashes of
all columns, grouped by hash, give for every pair of columns how many values they share. A
pair of one type that shares none is suspect: one side may carry a wrong salt.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sampled_hashes(df: DataFrame, table: str, columns: Mapping[str, str], halvings: int) -> DataFrame:
    """Distinct (table_name, column_name, type, hash) with a hash in the lowest 2^-``halvings`` of all.

    ``columns``: hash column -> sensitivity type. A value held by any share of the rows is one row before the shuffle.
    """
    bound = f"{(1 << 32) >> halvings:08x}" if halvings else "g"  # above every hex digit
    kept = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("hash")) for c, t in columns.items()]
    rows = df.select(F.inline(F.filter(F.array(*kept), lambda x: x["hash"] < bound)))
    return rows.distinct().select(F.lit(table).alias("table_name"), "column_name", "type", "hash")


def joinability(samples: DataFrame, halvings: int) -> DataFrame:
    """A row for each pair of columns of one type, and of any two that share values:
    estimated distinct values of both, values in common, their share of the smaller column, and ``suspect``.

    Groups are bounded by the number of columns; what is joined afterwards has a row per column.
    """
    side = F.struct("table_name", "column_name", "type")
    scale = F.lit(1 << halvings)
    sizes = samples.groupBy("table_name", "column_name", "type").agg((F.count(F.lit(1)) * scale).alias("n"))
    held = samples.groupBy("hash").agg(F.sort_array(F.collect_set(side)).alias("cols")).where(F.size("cols") > 1)
    pairs = held.select(F.explode("cols").alias("a"), "cols").select("a", F.explode("cols").alias("b")).where("a < b")
    common = pairs.groupBy("a", "b").agg((F.count(F.lit(1)) * scale).alias("common"))
    one, two = sizes.select(side.alias("a"), F.col("n").alias("a_n")), sizes.select(side.alias("b"), F.col("n").alias("b_n"))
    same = one.join(two, F.col("a.type") == F.col("b.type")).where("a < b")
    other = one.join(common, "a").join(two, "b").where("a.type <> b.type").select("a", "a_n", "b", "b_n", "common")
    found = same.join(common, ["a", "b"], "left").select("a", "a_n", "b", "b_n", F.coalesce("common", F.lit(0).cast("long")).alias("common")).unionByName(other)
    return found.select(
        F.col("a.table_name").alias("left_table"), F.col("a.column_name").alias("left_column"),
        F.col("b.table_name").alias("right_table"), F.col("b.column_name").alias("right_column"),
        F.col("a_n").alias("left_distinct"), F.col("b_n").alias("right_distinct"), "common",
        (F.col("common") / F.least("a_n", "b_n")).alias("containment"),
        ((F.col("common") == 0) & (F.col("a.type") == F.col("b.type"))).alias("suspect"))
