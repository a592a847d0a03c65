"""Classification: manifest -> validated column tags.

* :func:`flatten_manifest`  nested manifest documents -> one row per tag
* :func:`manifest_mismatch` manifest columns that do not exist
* :func:`missing_tags`      manifest tags not yet recorded (value-sensitive)
* :func:`apply_tags`        the tag table after applying the manifest,
                            all-or-nothing on mismatches

All are joins on metadata keys; no per-row Python, no driver loops. Tags and
columns are as many as the estate has, however small the file they come from
looks to the planner: these joins merge, so that no side goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.schemas import MISMATCH_REASON

COLUMN_KEYS = ["schema_name", "table_name", "column_name"]
TAG_KEYS = COLUMN_KEYS + ["tag_name", "tag_value"]

# All tags of one document as an array of rows, innermost first: tags of a
# column, columns of a table, tables of a schema. A level that is NULL adds nothing.
_DOCUMENT_TAGS = """
flatten(transform(coalesce(schemas, array()), s ->
  flatten(transform(coalesce(s.tables, array()), t ->
    flatten(transform(coalesce(t.attributes, array()), a ->
      transform(filter(coalesce(map_entries(a.tags), array()), e -> e.value IS NOT NULL), e ->
        named_struct('schema_name', s.schema_name, 'table_name', t.table_name,
                     'column_name', a.attribute_name, 'tag_name', e.key, 'tag_value', e.value))))))))
"""


def flatten_manifest(manifest: DataFrame) -> DataFrame:
    """``(schema_name, table_name, column_name, tag_name, tag_value)``.

    Attributes without tags and tags with a NULL value are dropped. Each
    document becomes rows in one step (one generator, no shuffle).
    """
    return manifest.select(F.inline(F.expr(_DOCUMENT_TAGS)))


def manifest_mismatch(manifest_tags: DataFrame, column_catalog: DataFrame, catalog_name: str) -> DataFrame:
    """Manifest columns absent from ``catalog_name``: ``(schema, table, column, reason)``."""
    cols = column_catalog.where(F.col("catalog_name") == catalog_name).select(*COLUMN_KEYS)
    return (
        manifest_tags.select(*COLUMN_KEYS)
        .distinct()
        .join(cols.hint("merge"), COLUMN_KEYS, "left_anti")
        .withColumn("reason", F.lit(MISMATCH_REASON))
    )


def missing_tags(manifest_tags: DataFrame, column_tags: DataFrame, catalog_name: str) -> DataFrame:
    """Manifest tags not present with the same value; a changed value counts as missing."""
    have = column_tags.where(F.col("catalog_name") == catalog_name).select(*TAG_KEYS)
    return manifest_tags.select(*TAG_KEYS).join(have.hint("merge"), TAG_KEYS, "left_anti")


def one_value_per_tag(manifest_tags: DataFrame) -> DataFrame:
    """The manifest's tags, each once; two values for one tag of a column raise."""
    where = F.concat_ws(".", *COLUMN_KEYS, "tag_name")
    conflict = F.raise_error(F.concat(F.lit("the manifest has two values for the tag "), where))
    values = manifest_tags.groupBy(*COLUMN_KEYS, "tag_name").agg(
        F.min("tag_value").alias("_low"), F.max("tag_value").alias("_high"))
    return values.select(*COLUMN_KEYS, "tag_name",
                         F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(conflict).alias("tag_value"))


def apply_tags(manifest_tags: DataFrame, column_catalog: DataFrame, column_tags: DataFrame,
               catalog_name: str) -> DataFrame:
    """Tag table of ``catalog_name`` after applying the manifest.

    Gate: if any manifest column is missing from the catalog, nothing is
    applied (the gate is an uncorrelated EXISTS, evaluated once, no
    driver round trip). Otherwise a tag takes the manifest's value. Tags
    that the manifest does not name are kept. Two manifest values for one
    tag raise. Tags of other catalogs are not returned. One full outer join
    on the tag keys makes the new table.
    """
    gate = manifest_mismatch(manifest_tags, column_catalog, catalog_name).exists()
    keys = COLUMN_KEYS + ["tag_name"]
    new = one_value_per_tag(manifest_tags).withColumnRenamed("tag_value", "_new").where(~gate)
    now = column_tags.where(F.col("catalog_name") == catalog_name).select(*keys, F.col("tag_value").alias("_now"))
    return now.join(new, keys, "full_outer").select(
        F.lit(catalog_name).alias("catalog_name"), *keys, F.coalesce("_new", "_now").alias("tag_value"))
