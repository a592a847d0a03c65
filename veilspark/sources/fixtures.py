"""Inputs derived from the driver's tables (``customer``, ``orders``).

Nothing here is random and nothing is built on the driver: every frame is
column expressions (and generators) over a scan of a given table, so its
size grows with that table. The same rules are written as DuckDB SQL in
``__spark_entry__.oracle_sql`` and the two must agree row for row.

* :func:`pii_rows`        personal/card columns for any id column
* :func:`synthetic_pii`   the same over ``spark.range(n)``
* :func:`orders_pii`      orders carrying their customer's SSN
* tenant estate           one landing table per customer: table/column
                          catalogs, column tags, a manifest document,
                          per-tenant key registry, KEK versions, DSKs
* :func:`global_keys`     one key set for the hashing of data columns
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.functions.crypto import key_aad, wrap
from veilspark.sources.local import local_frame
from veilspark.schemas import (
    DSK_NAME_PREFIX,
    KEK_NAME_PREFIX,
    MANIFEST,
    MANIFEST_ATTRIBUTE,
    SENSITIVITY_TYPES,
    TAG_CATEGORY,
    TAG_TYPE,
)

# ---------------------------------------------------------------------------
# The columns of the sample customer table and their tags, as
# in the reference's sample manifest (column, category, type).
# ---------------------------------------------------------------------------
SENSITIVE_COLUMNS = (
    ("full_name", "pii", "name"),
    ("email", "pii", "email"),
    ("phone_number", "pii", "phone"),
    ("dob", "pii", "dob"),
    ("ssn", "pii", "ssn"),
    ("pan", "pci", "pan"),
    ("address", "pii", "address"),
    ("exp_date", "pci", "exp-date"),
)
PII_COLUMNS = (
    ("id", "bigint", "NO"),
    ("full_name", "string", "YES"),
    ("email", "string", "YES"),
    ("phone_number", "string", "YES"),
    ("dob", "string", "YES"),
    ("ssn", "string", "YES"),
    ("pan", "string", "YES"),
    ("address", "string", "YES"),
    ("exp_date", "string", "YES"),
    ("bank_name", "string", "YES"),
)
SENSITIVE_TYPE_OF = {c: t for c, _, t in SENSITIVE_COLUMNS}
# ---------------------------------------------------------------------------

PRIVILEGED_GROUP = "pii_readers"


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


def ssn_of(i: Column) -> Column:
    """SSN rule of the fixtures: NULL every 50th (+1), a short ``'12'`` every 73rd."""
    return (
        F.when(i % 50 == 1, F.lit(None).cast("string"))
        .when(i % 73 == 0, F.lit("12"))
        .otherwise(F.concat(_pad((i * 31) % 900, 3), F.lit("-"), _pad(i % 100, 2), F.lit("-"), _pad((i * 17) % 10000, 4)))
    )


def pii_columns(i: Column) -> list[Column]:
    """The nine personal/card columns for integer id ``i`` (plus ``id``)."""
    dob = F.date_add(F.lit("1946-01-01").cast("date"), ((i * 37) % 22000).cast("int"))
    return [
        i.cast("bigint").alias("id"),
        F.when(i % 97 == 0, F.lit("Mononym"))
        .when(i % 31 == 0, F.concat(F.lit("Dr. Customer "), _pad(i, 9)))
        .otherwise(F.concat(F.lit("Customer "), _pad(i, 9)))
        .alias("full_name"),
        F.when(i % 89 == 0, F.lit("nodomain"))
        .otherwise(F.concat(F.lit("user"), _s(i), F.lit("@example.com")))
        .alias("email"),
        F.when(i % 83 == 0, F.lit("911"))
        .otherwise(F.concat(F.lit("555-"), _pad((i * 7919) % 1000, 3), F.lit("-"), _pad((i * 104729) % 10000, 4)))
        .alias("phone_number"),
        F.when(i % 79 == 0, F.lit("unknown")).otherwise(_s(dob)).alias("dob"),
        ssn_of(i).alias("ssn"),
        F.when(i % 71 == 0, F.lit("123"))
        .otherwise(F.concat(F.lit("4"), _pad((i * 1000003) % 1000000000, 15)))
        .alias("pan"),
        F.concat(_s(i), F.lit(" Street "), _s(i % 100)).alias("address"),
        F.concat(_pad(i % 12 + 1, 2), F.lit("/"), _pad(i % 8 + 24, 2)).alias("exp_date"),
        F.concat(F.lit("Company "), _s(i % 25), F.lit(" Bank")).alias("bank_name"),
    ]


def pii_rows(src: DataFrame, id_col: str) -> DataFrame:
    return src.select(*pii_columns(F.col(id_col)))


def pii_customers(customer: DataFrame) -> DataFrame:
    """Landing table ``customer_records`` derived from ``customer`` (id = c_custkey)."""
    return pii_rows(customer, "c_custkey")


def synthetic_pii(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    """``n`` synthetic customers generated in parallel from ``spark.range``."""
    return pii_rows(spark.range(0, n, 1, num_partitions), "id")


def orders_pii(orders: DataFrame) -> DataFrame:
    """Orders with the SSN of their customer: a second table joinable on SSN."""
    return orders.select("o_orderkey", "o_custkey", ssn_of(F.col("o_custkey")).alias("cust_ssn"))


def group_members(spark: SparkSession) -> DataFrame:
    """Members of the privileged group used by the role-gate queries."""
    return local_frame(
        spark,
        [(PRIVILEGED_GROUP, "alice"), (PRIVILEGED_GROUP, "carol"), ("auditors", "bob")],
        "grp string, member string",
    )


# ---------------------------------------------------------------------------
# Tenant estate: one landing table per customer row
# ---------------------------------------------------------------------------

TENANTS_A_TASK = 20_000


def _tenants(customer: DataFrame) -> DataFrame:
    """Dealt out so that a task has a bounded number: a tenant becomes up to 18 rows, and
    one input split can hold any number of them. Dealt in turn, not by key: rows of one key,
    or of none, would all come to one task."""
    k = F.col("c_custkey")
    tasks = -(-customer.count() // TENANTS_A_TASK)
    customer = customer.select("c_custkey", "c_mktsegment")
    return (customer.repartition(tasks) if tasks > 1 else customer).select(
        k.alias("k"),
        F.concat(F.lit("pci_pii_"), F.lower("c_mktsegment")).alias("schema_name"),
        F.concat(F.lit("customer_records_"), _s(k)).alias("table_name"),
    )


def estate_table_catalog(customer: DataFrame) -> DataFrame:
    """Landing: a managed table per tenant, a view every 10th; vault has every 4th
    table loaded, anonymized every 8th."""
    t = _tenants(customer)
    k = F.col("k")

    def rows(where: Column, catalog: str, table: Column, ttype: str) -> DataFrame:
        return t.where(where).select(
            F.lit(catalog).alias("catalog_name"), "schema_name", table.alias("table_name"),
            F.lit(ttype).alias("table_type"),
        )

    return (
        rows(F.lit(True), "landing", F.col("table_name"), "MANAGED")
        .unionByName(rows(k % 10 == 0, "landing", F.concat(F.lit("customer_view_"), _s(k)), "VIEW"))
        .unionByName(rows(k % 4 == 0, "vault", F.col("table_name"), "MANAGED"))
        .unionByName(rows(k % 8 == 0, "anonymized", F.col("table_name"), "MANAGED"))
    )


def estate_column_catalog(customer: DataFrame) -> DataFrame:
    """The ten columns of every landing table."""
    cols = F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("full_data_type"),
                 F.lit(nl).alias("is_nullable"), F.lit(i + 1).alias("ordinal_position"))
        for i, (n, t, nl) in enumerate(PII_COLUMNS)
    ])
    return _tenants(customer).select(
        F.lit("landing").alias("catalog_name"), "schema_name", "table_name", F.explode(cols).alias("c")
    ).select("catalog_name", "schema_name", "table_name", "c.*")


def estate_column_tags(customer: DataFrame) -> DataFrame:
    """Tags already recorded in landing.

    Tenants with k % 3 == 0 have none; k % 7 == 0 records ``dob`` with
    category ``pci`` (a value the manifest changes); k % 9 == 1 also tags
    ``bank_name`` as ``public`` / ``org`` (typed but not sensitive).
    """
    k = F.col("k")
    items = []
    for c, cat, typ in SENSITIVE_COLUMNS:
        cat_v = F.when(k % 7 == 0, F.lit("pci")).otherwise(F.lit(cat)) if c == "dob" else F.lit(cat)
        items.append(F.struct(F.lit(c).alias("column_name"), F.lit(TAG_CATEGORY).alias("tag_name"), cat_v.alias("tag_value")))
        items.append(F.struct(F.lit(c).alias("column_name"), F.lit(TAG_TYPE).alias("tag_name"), F.lit(typ).alias("tag_value")))
    extra = F.filter(
        F.array(
            F.struct(F.lit("bank_name").alias("column_name"), F.lit(TAG_CATEGORY).alias("tag_name"), F.lit("public").alias("tag_value")),
            F.struct(F.lit("bank_name").alias("column_name"), F.lit(TAG_TYPE).alias("tag_name"), F.lit("org").alias("tag_value")),
        ),
        lambda _: k % 9 == 1,
    )
    return (
        _tenants(customer).where(k % 3 != 0)
        .select(F.lit("landing").alias("catalog_name"), "schema_name", "table_name",
                F.explode(F.concat(F.array(*items), extra)).alias("t"))
        .select("catalog_name", "schema_name", "table_name", "t.*")
    )


def _attr(name: str, tags: Column) -> Column:
    return F.struct(F.lit(name).alias("attribute_name"), tags.alias("tags"))


def estate_manifest(customer: DataFrame, unknown_columns: bool = True) -> DataFrame:
    """One manifest document per landing table, in the nested manifest schema.

    Each lists the eight sensitive columns with both tags. Variants:
    k % 11 == 0 adds an unknown column ``nickname`` (only with
    ``unknown_columns``), k % 13 == 0 a ``bank_name`` tag with a NULL
    value, k % 17 == 0 an attribute ``loyalty_id`` without tags.
    """
    k = F.col("k")
    tag_map = T.MapType(T.StringType(), T.StringType(), True)
    base = [
        _attr(c, F.create_map(F.lit(TAG_CATEGORY), F.lit(cat), F.lit(TAG_TYPE), F.lit(typ)))
        for c, cat, typ in SENSITIVE_COLUMNS
    ]
    attr_array = T.ArrayType(MANIFEST_ATTRIBUTE, True)

    def only_if(cond: Column, attr: Column) -> Column:
        return F.filter(F.array(attr), lambda _: cond).cast(attr_array)

    parts = [F.array(*base).cast(attr_array)]
    if unknown_columns:
        parts.append(only_if(k % 11 == 0, _attr("nickname", F.create_map(
            F.lit(TAG_CATEGORY), F.lit("pii"), F.lit(TAG_TYPE), F.lit("name")))))
    parts.append(only_if(k % 13 == 0, _attr("bank_name", F.create_map(
        F.lit(TAG_CATEGORY), F.lit(None).cast("string")))))
    parts.append(only_if(k % 17 == 0, _attr("loyalty_id", F.lit(None).cast(tag_map))))
    doc = F.array(F.struct(
        F.col("schema_name").alias("schema_name"),
        F.array(F.struct(F.col("table_name").alias("table_name"), F.concat(*parts).alias("attributes"))).alias("tables"),
    ))
    return _tenants(customer).select(doc.cast(MANIFEST["schemas"].dataType).alias("schemas"))


# ---------------------------------------------------------------------------
# Keys. Fixture KEK bytes are derived from the KEK name and version and
# fixture DSKs are readable text, so the oracle can recompute everything;
# real keys come from veilspark.operators.keys (random, wrapped).
# ---------------------------------------------------------------------------

def fixture_kek(kek_name: Column, version: Column) -> Column:
    return F.unhex(F.sha2(F.concat(kek_name, F.lit("/"), version), 256))


def _version_created(k: Column, v: Column) -> Column:
    days = (k % 300 + (v - 1) * 200).cast("int")
    return F.date_add(F.lit("2024-01-01").cast("date"), days).cast("timestamp")


def _tenant_attrs(customer: DataFrame) -> DataFrame:
    k = F.col("k")
    a = F.col("attribute")
    return _tenants(customer).select("k", F.explode(F.array(*[F.lit(x) for x in SENSITIVITY_TYPES])).alias("attribute")).select(
        "k", "attribute",
        F.concat(F.lit("tenant-"), _s(k), F.lit("-kek-"), a).alias("kek_name"),
        F.concat(F.lit("tenant-"), _s(k), F.lit("-dsk-"), a).alias("dsk_name"),
    )


def estate_key_registry(customer: DataFrame) -> DataFrame:
    """Per-tenant registry: a KEK and a DSK name per tenant and sensitivity type."""
    return _tenant_attrs(customer).select(
        F.col("attribute").alias("pci_pii_attribute_name"), "kek_name", "dsk_name"
    )


def estate_kek_versions(customer: DataFrame) -> DataFrame:
    """1 + k % 3 versions per KEK, 200 days apart; tenants with k % 25 == 0 have no KEK yet."""
    k = F.col("k")
    v = F.col("v")
    return (
        _tenant_attrs(customer).where(k % 25 != 0)
        .select("k", "kek_name", F.explode(F.sequence(F.lit(1), (k % 3 + 1).cast("int"))).alias("v"))
        .select(
            "kek_name",
            F.concat(F.lit("v"), _s(v)).alias("version"),
            _version_created(k, v).alias("created"),
            fixture_kek(F.col("kek_name"), F.concat(F.lit("v"), _s(v))).alias("kek"),
        )
    )


def estate_dsk_store(customer: DataFrame) -> DataFrame:
    """Wrapped DSKs ``SALT-t<k>-<type>`` for tenants with k % 5 != 0.

    Even tenants are wrapped under their latest KEK version, odd ones
    still under ``v1`` (due for re-wrapping).
    """
    k = F.col("k")
    version = F.when(k % 2 == 0, F.concat(F.lit("v"), _s(k % 3 + 1))).otherwise(F.lit("v1"))
    dsk = F.concat(F.lit("SALT-t"), _s(k), F.lit("-"), F.col("attribute")).cast("binary")
    return (
        _tenant_attrs(customer).where(k % 5 != 0)
        .withColumn("kek_version", version)
        .select(
            "attribute", "kek_name", "dsk_name", "kek_version",
            wrap(dsk, fixture_kek(F.col("kek_name"), F.col("kek_version")),
                 key_aad(F.col("attribute"), F.col("kek_version"))).alias("wrapped_dsk"),
        )
    )


def registry_seed(spark: SparkSession, attributes=SENSITIVITY_TYPES) -> DataFrame:
    """The registry rows of the given sensitivity types, named by the fixed prefixes."""
    df = local_frame(spark, [(a,) for a in attributes], "attribute string")
    return df.select(
        F.col("attribute").alias("pci_pii_attribute_name"),
        F.concat(F.lit(KEK_NAME_PREFIX), "attribute").alias("kek_name"),
        F.concat(F.lit(DSK_NAME_PREFIX), "attribute").alias("dsk_name"),
    )


def global_keys(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(key_registry, kek_versions, dsk_store)`` with DSK ``SALT-<type>`` per type.

    Two KEK versions per type (2024-01-01 and 2025-01-01); every DSK is
    wrapped under ``v1``.
    """
    registry = registry_seed(spark)
    versions = registry.select("kek_name", F.explode(F.array(F.lit(1), F.lit(2))).alias("v")).select(
        "kek_name",
        F.concat(F.lit("v"), _s(F.col("v"))).alias("version"),
        F.when(F.col("v") == 1, F.lit("2024-01-01")).otherwise(F.lit("2025-01-01")).cast("timestamp").alias("created"),
        fixture_kek(F.col("kek_name"), F.concat(F.lit("v"), _s(F.col("v")))).alias("kek"),
    )
    a = F.col("pci_pii_attribute_name")
    store = registry.select(
        a.alias("attribute"), "kek_name", "dsk_name", F.lit("v1").alias("kek_version"),
        wrap(F.concat(F.lit("SALT-"), a).cast("binary"), fixture_kek(F.col("kek_name"), F.lit("v1")),
             key_aad(a, F.lit("v1"))).alias("wrapped_dsk"),
    )
    return registry, versions, store
