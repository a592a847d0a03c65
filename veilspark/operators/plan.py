"""Load planning over catalog metadata frames.

The load plan is one row per column of every table that still has to be
loaded, with the sensitivity type and key names of the sensitive ones.
It is computed as one DataFrame plan (anti, semi and outer joins plus a
one-pass conditional aggregate instead of a tag self-join). Its size is the
number of columns, never the number of data rows. Joins of frames that grow with the
estate merge: none is collected on the driver to be broadcast, whatever its estimate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilspark.functions.hashing import hash_column_name
from veilspark.schemas import (
    DERIVED_HASH,
    SENSITIVE_CATEGORIES,
    TAG_CATEGORY,
    TAG_DERIVED,
    TAG_TYPE,
)

TABLE_KEYS = ["catalog_name", "schema_name", "table_name"]
COLUMN_KEYS = TABLE_KEYS + ["column_name"]

PLAN_COLUMNS = [
    "catalog_name", "schema_name", "table_name", "column_name", "full_data_type", "is_nullable",
    "ordinal_position", "tag_name", "tag_value", "kek_name", "dsk_name",
]


def managed_tables(table_catalog: DataFrame, catalog_name: str) -> DataFrame:
    return table_catalog.where(
        (F.col("catalog_name") == catalog_name) & (F.col("table_type") == "MANAGED")
    ).select(*TABLE_KEYS)


def pending_tables(table_catalog: DataFrame, source: str, target: str) -> DataFrame:
    """Managed tables of ``source`` with no managed table of the same schema/name in ``target``."""
    done = managed_tables(table_catalog, target).select("schema_name", "table_name")
    return managed_tables(table_catalog, source).join(done.hint("merge"), ["schema_name", "table_name"], "left_anti")


def sensitive_columns(column_tags: DataFrame) -> DataFrame:
    """Columns tagged with a pii/pci category *and* a sensitivity type.

    Output ``(catalog, schema, table, column, tag_name, tag_value)`` with
    the type tag. Columns tagged ``derived = hash`` are excluded. Only the
    three tag names that matter are read, in one grouped pass (partial
    aggregation, a single shuffle) instead of joining the tag table with
    itself. Two types for one column raise.
    """
    name, value = F.col("tag_name"), F.col("tag_value")
    per_column = column_tags.where(name.isin(TAG_CATEGORY, TAG_TYPE, TAG_DERIVED)).groupBy(*COLUMN_KEYS).agg(
        F.max(F.when((name == TAG_CATEGORY) & value.isin(*SENSITIVE_CATEGORIES), True)).alias("_sens"),
        F.min(F.when(name == TAG_TYPE, value)).alias("_low"),
        F.max(F.when(name == TAG_TYPE, value)).alias("_high"),
        F.max(F.when((name == TAG_DERIVED) & (value == DERIVED_HASH), True)).alias("_derived"),
    )
    conflict = F.raise_error(F.concat(F.lit("two sensitivity types for column "), F.concat_ws(".", *COLUMN_KEYS)))
    return per_column.where(
        F.col("_sens") & F.col("_low").isNotNull() & F.col("_derived").isNull()
    ).select(*COLUMN_KEYS, F.lit(TAG_TYPE).alias("tag_name"),
             F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(conflict).alias("tag_value"))


def unique_registry(key_registry: DataFrame) -> DataFrame:
    """``(tag_value, kek_name, dsk_name)``; a type with two registry rows raises."""
    rows = key_registry.groupBy(F.col("pci_pii_attribute_name").alias("tag_value")).agg(
        F.count_distinct("kek_name", "dsk_name").alias("_n"), F.max("kek_name").alias("kek_name"),
        F.max("dsk_name").alias("dsk_name"))
    several = F.raise_error(F.concat(F.lit("several registry rows for "), F.col("tag_value")))
    return rows.select("tag_value", F.when(F.col("_n") <= 1, F.col("kek_name")).otherwise(several).alias("kek_name"), "dsk_name")


def load_plan(pending: DataFrame, column_catalog: DataFrame, column_tags: DataFrame,
              key_registry: DataFrame) -> DataFrame:
    """Columns of the pending tables, with type tag and key names where sensitive.

    Key names join the sensitive columns first and then reach the columns on
    their own keys: no hot NULL key. A sensitive column whose type has no
    registry entry keeps NULL key names; the loads refuse such a plan.
    """
    cols = column_catalog.join(pending.select(*TABLE_KEYS).hint("merge"), TABLE_KEYS, "left_semi")
    keyed = sensitive_columns(column_tags).join(unique_registry(key_registry), "tag_value", "left")
    return cols.join(keyed.hint("merge"), COLUMN_KEYS, "left").select(*PLAN_COLUMNS)


def tables_to_load(plan: DataFrame) -> DataFrame:
    return plan.select(*TABLE_KEYS).distinct()


def keys_to_load(plan: DataFrame) -> DataFrame:
    """Distinct ``(tag_value, kek_name, dsk_name)`` with no NULL part."""
    return plan.select("tag_value", "kek_name", "dsk_name").dropna().distinct()


def target_schema(plan: DataFrame, target_catalog: str) -> DataFrame:
    """Column layout of the protected tables.

    Every source column in ordinal order, each hashed column directly
    followed by ``<col>_hash STRING``. Output columns: catalog_name
    (= target), schema, table, column_name, full_data_type, is_nullable,
    ordinal_position, is_hash. The window is per table, so its groups
    are bounded by a table's column count.
    """
    hashed = F.col("dsk_name").isNotNull()
    w = Window.partitionBy("schema_name", "table_name").orderBy("ordinal_position").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum(hashed.cast("int")).over(w), F.lit(0))
    placed = plan.select("schema_name", "table_name", "column_name", "full_data_type", "is_nullable",
                         (F.col("ordinal_position") + before).cast("int").alias("at"), hashed.alias("hashed"))

    def column(name, kind, nullable, at, is_hash):
        return F.struct(name.alias("column_name"), kind.alias("full_data_type"), nullable.alias("is_nullable"),
                        at.alias("ordinal_position"), F.lit(is_hash).alias("is_hash"))

    own = column(F.col("column_name"), F.col("full_data_type"), F.col("is_nullable"), F.col("at"), False)
    digest = column(F.concat("column_name", F.lit(hash_column_name(""))), F.lit("string"), F.lit("YES"), F.col("at") + 1, True)
    return placed.select(F.lit(target_catalog).alias("catalog_name"), "schema_name", "table_name",
                         F.inline(F.when(F.col("hashed"), F.array(own, digest)).otherwise(F.array(own))))


def propagate_tags(column_tags: DataFrame, plan: DataFrame, target_catalog: str) -> DataFrame:
    """Tags for the target tables of ``plan``.

    Every tag of every source column of a planned table is copied to the
    same column in ``target_catalog``; for hashed columns it is also
    copied to ``<col>_hash``, which additionally gets ``derived = hash``
    so that masking and later planning skip it.
    """
    per_column = column_tags.groupBy(*COLUMN_KEYS).agg(F.collect_list(F.struct("tag_name", "tag_value")).alias("own"))
    planned = plan.select(*COLUMN_KEYS, F.col("dsk_name").isNotNull().alias("hashed")).join(per_column.hint("merge"), COLUMN_KEYS)
    digest = F.concat("column_name", F.lit(hash_column_name("")))

    def named(column):
        return F.transform("own", lambda t: F.struct(column.alias("column_name"), t["tag_name"].alias("tag_name"),
                                                     t["tag_value"].alias("tag_value")))

    derived = F.array(F.struct(digest.alias("column_name"), F.lit(TAG_DERIVED).alias("tag_name"),
                               F.lit(DERIVED_HASH).alias("tag_value")))
    copies = F.when(F.col("hashed"), F.concat(named(F.col("column_name")), named(digest), derived)).otherwise(
        named(F.col("column_name")))
    return planned.select(F.lit(target_catalog).alias("catalog_name"), "schema_name", "table_name", F.inline(copies))
