"""Helpers shared by the operators of this package.

Input frames may have any further columns, also with names that the operators
use themselves or that differ only in case: ``pick`` takes columns by exact
name and position, and ``packed``/``unpacked`` carry whole input rows in one
struct past the operators' own columns.
"""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.session import scratch_path

ROW = "_row"
GROUP_BYTES, ROW_BYTES = 64 << 20, 64  # texts of a group; what a row adds to them
WHITE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _positional(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def _position(df: DataFrame, name: str) -> int:
    if name not in df.columns:
        raise ValueError(f"column {name!r} is missing; there are {df.columns}")
    return df.columns.index(name)


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """The named columns only: new name = "source column type"."""
    raw = _positional(df)
    out = []
    for new, spec in cols.items():
        source, kind = spec.rsplit(" ", 1)
        out.append(F.col(f"_c{_position(df, source)}").cast(kind).alias(new))
    return raw.select(*out)


def packed(df: DataFrame, /, without: tuple[str, ...] = (), **cols: str) -> DataFrame:
    """As ``pick``, and the whole row as the struct ``_row``, where the columns
    named in ``without`` are null (they are picked, and need not travel twice)."""
    raw = _positional(df)
    gone = {_position(df, x) for x in without}
    row = F.struct(*[(F.lit(None).cast(f.dataType) if i in gone else F.col(f.name)).alias(f.name)
                     for i, f in enumerate(raw.schema.fields)])
    picked = []
    for new, spec in cols.items():
        source, kind = spec.rsplit(" ", 1)
        picked.append(F.col(f"_c{_position(df, source)}").cast(kind).alias(new))
    return raw.select(*picked, row.alias(ROW))


def unpacked(df: DataFrame, like: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``like`` out of ``_row``; ``replaced`` has new values by column name."""
    out = []
    for i, f in enumerate(like.schema.fields):
        c = replaced[f.name].cast(f.dataType) if f.name in replaced else F.col(f"{ROW}._c{i}")
        out.append(c.alias(f.name))
    return df.select(*out)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the cluster's shared folder and reads it back: cuts the
    lineage and outlives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(T.StructType.fromDDL(", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields))).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go when no frame refers to them any more and the
    driver's JVM finds that out; between two large jobs this asks it to look, so that
    they don't add up on disk."""
    for _ in range(3):  # frames of Python let go of the JVM's in one round, those of their shuffles in the next
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_groups(docs: DataFrame, text_col: str, group_bytes: int = GROUP_BYTES) -> int:
    """Into how many groups rows are dealt where a group is held whole: as many as keep one near ``group_bytes``
    of text, however large the input, and enough to occupy all tasks."""
    total = pick(docs, text=f"{text_col} string").agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES)).first()[0] or 0
    return groups(total, group_bytes, 8 * shuffle_partitions(docs.sparkSession))


def groups(total: int, target: int, least: int) -> int:
    return max(least, -(-total // target))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
