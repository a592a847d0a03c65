"""Files of catalog tables: one row per file, listed by Spark from the tables' folders.

Contents aren't read, nor are rows made per data row: the listing is a ``binaryFile``
scan without its content column, over the folders of many tables at once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.schemas import LOADED_FILES, qualified
from veilspark.sources.local import local_frame


def table_location(spark: SparkSession, name: str) -> str:
    """Folder of a catalog table (its root; partitions in folders elsewhere aren't followed)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    if not rows:
        raise ValueError(f"{name} has no location")
    return rows[-1]["data_type"].rstrip("/")


def _plain(path):
    """Without scheme and authority, and without doubled slashes."""
    return F.regexp_replace(F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", ""), "/+", "/")


def table_files(spark: SparkSession, layer: str, tables: Iterable[tuple[str, str]]) -> DataFrame:
    """``LOADED_FILES`` rows of the (schema, table) pairs: path, size, time, and the partition's folders as ``part``.

    Names that begin with ``_`` or ``.`` are no data, as in any Spark scan.
    """
    places = [(s, t, table_location(spark, qualified(layer, s, t))) for s, t in tables]
    if not places:
        return local_frame(spark, [], LOADED_FILES)
    roots = local_frame(spark, places, "schema_name string, table_name string, location string").select(
        "schema_name", "table_name", F.concat(_plain(F.col("location")), F.lit("/")).alias("root"))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([p for *_, p in places]).select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), _plain(F.col("path")).alias("plain"))
    # a file belongs to the table whose folder is one of its ancestors: a join on the ancestors, not on prefixes
    parts = F.split("plain", "/")
    above = listed.select("*", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1),
                                                    lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))).alias("root"))
    found = above.join(roots, "root")
    inside = F.expr("substring(plain, length(root) + 1)")
    hidden = F.exists(F.split(inside, "/"), lambda x: x.rlike("^[_.]") & ~x.contains("="))
    return found.where(~hidden).select(
        F.lit(layer).alias("source_catalog"), "schema_name", "table_name",
        F.regexp_replace(inside, "/?[^/]*$", "").alias("part"), "path", "bytes", "modified")
