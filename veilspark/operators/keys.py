"""Key lifecycle as table-to-table operators.

Frames (see ``veilspark.schemas``):

* ``key_registry(pci_pii_attribute_name, kek_name, dsk_name)``
* ``kek_versions(kek_name, version, created, kek)``  key encryption keys
* ``dsk_store(attribute, kek_name, dsk_name, kek_version, wrapped_dsk)``

A data salt key (DSK) is stored only wrapped under one KEK version; the
``kek_version`` column says which. Rotation re-wraps the same DSK under a
newer KEK version, so the salted hashes stay valid. All joins here are on
key names and versions. They merge: there are as many keys as the estate has
tenants, and none of these frames goes through the driver to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions.crypto import random_key, unwrap, wrap, key_aad
from veilspark.schemas import (
    DSK_NAME_PREFIX,
    KEK_EXPIRY_DAYS,
    KEK_NAME_PREFIX,
    KEK_ROTATE_BEFORE_DAYS,
)


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------

def registry_rows_for(attributes: DataFrame, attribute_col: str = "attribute") -> DataFrame:
    """Registry rows named by the fixed prefixes for each attribute in ``attributes``."""
    a = F.col(attribute_col)
    return attributes.select(
        a.alias("pci_pii_attribute_name"),
        F.concat(F.lit(KEK_NAME_PREFIX), a).alias("kek_name"),
        F.concat(F.lit(DSK_NAME_PREFIX), a).alias("dsk_name"),
    )


def ensure_registry(existing: DataFrame, required_attributes: DataFrame,
                    attribute_col: str = "attribute") -> DataFrame:
    """Registry after adding a row for every required attribute that has none.

    Idempotent (set semantics): re-running adds nothing and duplicates
    nothing. ``required_attributes`` may be large (e.g. every sensitive
    column of every table); it is reduced to its distinct attributes with
    a partial aggregate before the anti join.
    """
    needed = required_attributes.select(F.col(attribute_col).alias("attribute")).where(
        F.col("attribute").isNotNull()
    ).distinct()
    missing = needed.join(
        existing.select(F.col("pci_pii_attribute_name").alias("attribute")), "attribute", "left_anti"
    )
    return existing.unionByName(registry_rows_for(missing)).distinct()


# ---------------------------------------------------------------------------
# Key encryption keys
# ---------------------------------------------------------------------------

def latest_kek_versions(kek_versions: DataFrame) -> DataFrame:
    """``(kek_name, latest_version, latest_created)``: version with the max ``created``."""
    return kek_versions.groupBy("kek_name").agg(
        F.max_by("version", "created").alias("latest_version"),
        F.max("created").alias("latest_created"),
    )


def latest_keks(kek_versions: DataFrame) -> DataFrame:
    """``(kek_name, latest_version, latest_kek)``."""
    return kek_versions.groupBy("kek_name").agg(
        F.max_by(F.struct("version", "kek"), "created").alias("latest")
    ).select("kek_name", F.col("latest.version").alias("latest_version"), F.col("latest.kek").alias("latest_kek"))


def keys_due(kek_versions: DataFrame, as_of: Column | str,
             expiry_days: int = KEK_EXPIRY_DAYS,
             rotate_before_days: int = KEK_ROTATE_BEFORE_DAYS) -> DataFrame:
    """Latest KEK versions that the rotation policy wants rotated at ``as_of``.

    A version expires ``expiry_days`` after creation and is rotated
    ``rotate_before_days`` before that.
    """
    as_of = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    lead = expiry_days - rotate_before_days
    latest = latest_kek_versions(kek_versions)
    due_at = F.col("latest_created") + F.make_interval(days=F.lit(lead))
    return latest.select(
        "kek_name",
        F.col("latest_version").alias("version"),
        F.col("latest_created").alias("created"),
        due_at.alias("due_at"),
    ).where(F.col("due_at") <= as_of)


def new_kek_versions(kek_names: DataFrame, kek_versions: DataFrame, created: Column) -> DataFrame:
    """A fresh random version for each KEK in ``kek_names`` (creates the KEK if absent).

    Version names are ``v<n+1>`` where n is the number of existing versions.
    Non-deterministic: write the result before using it.
    """
    counts = kek_versions.groupBy("kek_name").agg(F.count(F.lit(1)).alias("n"))
    return (
        kek_names.select("kek_name").distinct()
        .join(counts.hint("merge"), "kek_name", "left")
        .select(
            "kek_name",
            F.concat(F.lit("v"), (F.coalesce(F.col("n"), F.lit(0)) + 1).cast("string")).alias("version"),
            created.cast("timestamp").alias("created"),
            random_key().alias("kek"),
        )
    )


def ensure_keks(registry: DataFrame, kek_versions: DataFrame, created: Column) -> DataFrame:
    """Version ``v1`` for every registry KEK that has no version yet."""
    absent = registry.select("kek_name").distinct().join(
        kek_versions.select("kek_name").hint("merge"), "kek_name", "left_anti"
    )
    return absent.select(
        "kek_name",
        F.lit("v1").alias("version"),
        created.cast("timestamp").alias("created"),
        random_key().alias("kek"),
    )


# ---------------------------------------------------------------------------
# Data salt keys
# ---------------------------------------------------------------------------

def ensure_dsks(registry: DataFrame, dsk_store: DataFrame, kek_versions: DataFrame) -> DataFrame:
    """New wrapped DSKs for registry rows without one, under the latest KEK version.

    Registry rows whose KEK has no version are skipped (create the KEK
    first, see :func:`ensure_keks`). Non-deterministic: write the result
    before using it.
    """
    missing = registry.join(dsk_store.select("dsk_name").hint("merge"), "dsk_name", "left_anti")
    needed = kek_versions.join(missing.select("kek_name").hint("merge"), "kek_name", "left_semi")  # only KEKs that wrap a new key
    ring = latest_keks(needed)
    attr = F.col("pci_pii_attribute_name")
    return (
        missing.join(ring.hint("merge"), "kek_name", "inner")
        .withColumn("_dsk", random_key())
        .select(
            attr.alias("attribute"),
            "kek_name",
            "dsk_name",
            F.col("latest_version").alias("kek_version"),
            wrap(F.col("_dsk"), F.col("latest_kek"), key_aad(attr, F.col("latest_version"))).alias(
                "wrapped_dsk"
            ),
        )
    )


def unwrap_dsks(dsk_store: DataFrame, kek_versions: DataFrame) -> DataFrame:
    """``dsk_store`` with ``wrapped_dsk`` replaced by ``dsk``, unwrapped with the tagged version.

    ``dsk`` is NULL when the KEK version is missing or the AAD does not
    match (tampered or misfiled key).
    """
    keks = kek_versions.select("kek_name", F.col("version").alias("kek_version"), "kek")
    keep = [c for c in dsk_store.columns if c != "wrapped_dsk"]
    return dsk_store.join(keks.hint("merge"), ["kek_name", "kek_version"], "left").select(
        *keep,
        unwrap(F.col("wrapped_dsk"), F.col("kek"), key_aad(F.col("attribute"), F.col("kek_version"))).alias(
            "dsk"
        ),
    )


def rotate_dsks(dsk_store: DataFrame, kek_versions: DataFrame) -> DataFrame:
    """``dsk_store`` with every DSK re-wrapped under the latest version of its KEK.

    The DSK itself is unchanged, so hashes made with it stay valid. Rows
    already on the latest version pass through untouched. A DSK that
    cannot be unwrapped raises instead of being dropped or rewritten.
    Adds a boolean ``rotated`` column.
    """
    ring = latest_keks(kek_versions)
    held = kek_versions.select("kek_name", F.col("version").alias("kek_version"), F.col("kek").alias("old_kek"))
    attr = F.col("attribute")
    dsk = unwrap(F.col("wrapped_dsk"), F.col("old_kek"), key_aad(attr, F.col("kek_version")))
    stale = F.col("kek_version") != F.col("latest_version")
    checked = F.when(dsk.isNull(), F.raise_error(F.concat(F.lit("cannot unwrap DSK "), F.col("dsk_name")))).otherwise(dsk)
    return dsk_store.join(ring.hint("merge"), "kek_name", "left").join(held.hint("merge"), ["kek_name", "kek_version"], "left").select(
        "attribute",
        "kek_name",
        "dsk_name",
        F.when(stale, F.col("latest_version")).otherwise(F.col("kek_version")).alias("kek_version"),
        F.when(stale, wrap(checked, F.col("latest_kek"), key_aad(attr, F.col("latest_version"))))
        .otherwise(F.col("wrapped_dsk"))
        .alias("wrapped_dsk"),
        F.coalesce(stale, F.lit(False)).alias("rotated"),
    )


def missing_salts(required_attributes: DataFrame, unwrapped: DataFrame,
                  attribute_col: str = "attribute") -> DataFrame:
    """Required attributes without exactly one unwrappable DSK (must be empty before hashing)."""
    have = unwrapped.where(F.col("dsk").isNotNull()).groupBy("attribute").agg(
        F.count(F.lit(1)).alias("n")
    ).where(F.col("n") == 1)
    return required_attributes.select(F.col(attribute_col).alias("attribute")).distinct().join(
        have, "attribute", "left_anti"
    )


def salts_struct(unwrapped: DataFrame, attributes) -> Column:
    """DSKs of several attributes as one STRUCT from a single scalar subquery.

    Field ``<attribute>`` holds that attribute's DSK. The subquery (and so
    the unwrap) runs once per query. Raises at run time if an attribute
    lacks exactly one usable DSK. Project it once as a column and read
    the fields from that column: each separate use of a subquery Column
    is planned as a subquery of its own.
    """
    attrs = sorted(set(attributes))
    a, dsk = F.col("attribute"), F.col("dsk")
    usable = unwrapped.where(a.isin(*attrs) & dsk.isNotNull())
    fields = [
        F.when(F.count_if(a == F.lit(x)) == 1, F.max(F.when(a == F.lit(x), dsk)))
        .otherwise(F.raise_error(F.lit(f"no unique data salt key for attribute {x!r}")))
        .alias(x)
        for x in attrs
    ]
    return usable.select(F.struct(*fields).alias("salts")).scalar()
