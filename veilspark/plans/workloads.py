"""The registered workloads: one DataFrame per operator, over the given tables.

Each function takes ``(spark, sf_dir)`` and reads the driver's parquet
tables (``customer``, ``orders``), or frames Spark derives from them, so
the work grows with the tables. ``veilspark.plans.oracle`` holds the
equivalent DuckDB SQL for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions import masks as M
from veilspark.functions.crypto import unwrap, wrap
from veilspark.operators import classify, keys, plan
from veilspark.functions.hashing import hash_column_name
from veilspark.operators.joins import join_on_hash, lookup_on_hash, prune_by_hash
from veilspark.operators.profile import joinability, sampled_hashes
from veilspark.operators.protect import (
    add_hashes,
    hash_projection,
    mask_projection,
    plan_for_frame,
    table_plans,
)
from veilspark.plans import arrivals, pipelines, store
from veilspark.schemas import COLUMN_TAGS, KEK_NAME_PREFIX, SENSITIVITY_TYPES, TAG_CATEGORY, TAG_TYPE
from veilspark.session import ScratchScope, frozen, scratch_path
from veilspark.sources import fixtures as fx
from veilspark.sources.catalog import frames_column_catalog
from veilspark.sources.local import local_frame
from veilspark.sources.manifest import read_documents, read_manifest, split_manifests

# Hash width of the registered workloads: DuckDB, the oracle, has SHA-256
# but no SHA-512. The library default (and the benchmark) is 512.
ORACLE_BITS = 256
ROTATION_AS_OF = "2025-06-01 00:00:00"
KEY_CREATED_AT = "2026-01-01 00:00:00"
MANIFESTS_A_FILE = 64
HALVINGS = 2  # of the sample that hash_joinability takes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _customer(spark, d):
    return table(spark, d, "customer")


def _pii(spark, d):
    return fx.pii_customers(_customer(spark, d))


def _unwrapped_global(spark):
    _, versions, wrapped = fx.global_keys(spark)
    return keys.unwrap_dsks(wrapped, versions)


# --------------------------------------------------------------------------- sources

def synthetic_pii(spark, d):
    """SRC-1: a synthetic customer for each key of ``orders``, generated by the tasks that read it."""
    return fx.pii_rows(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


def _tables_in(spark, d) -> list[str]:
    """Names of the ``<table>.parquet`` files and folders in a folder (contents aren't read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(d.rstrip("/"))
             .select(F.regexp_extract("path", r"([^/]+)\.parquet(/[^/]*)?$", 1).alias("t")).where("t <> ''").distinct())
    return sorted(r.t for r in files.collect())


def column_catalog(spark, d):
    """SRC-4: columns of the tables in the folder (from their schemas) and of every tenant table."""
    frames = {("landing", "testdata", t): table(spark, d, t) for t in _tables_in(spark, d)}
    return frames_column_catalog(spark, frames).unionByName(fx.estate_column_catalog(_customer(spark, d)))


# --------------------------------------------------------------------------- classify

def _manifest_tags(spark, d, unknown_columns=True):
    return classify.flatten_manifest(fx.estate_manifest(_customer(spark, d), unknown_columns))


def manifest_flatten(spark, d):
    """SRC-2: the tenants' manifests as JSON files, read back and flattened."""
    path = scratch_path(spark, "manifests")
    docs = fx.estate_manifest(_customer(spark, d)).select(F.to_json(F.struct("schemas")).alias("doc"))
    files = max(1, -(-docs.count() // MANIFESTS_A_FILE))  # the number of files grows, not their size
    some = docs.groupBy(F.pmod(F.xxhash64("doc"), F.lit(files)).alias("file")).agg(F.collect_list("doc").alias("docs"))
    some.select(F.concat(F.lit("["), F.array_join("docs", ",\n"), F.lit("]")).alias("value")).repartition("value").write.option(
        "maxRecordsPerFile", 1).text(path)  # a file is one multi-line document, here an array of them
    return classify.flatten_manifest(read_manifest(spark, path))


def manifest_quarantine(spark, d):
    """SRC-2: manifests with broken ones among them; the good ones' tags are counted, the others set aside with the reason."""
    path = scratch_path(spark, "mixed-manifests")
    c = _customer(spark, d)
    good = fx.estate_manifest(c).select(F.to_json(F.struct("schemas")).alias("value"))
    k = F.col("c_custkey").cast("string")
    broken = c.select(F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit('{"schemas": [tenant '), k))
                      .when(F.col("c_custkey") % 10 == 1, F.concat(F.lit('{"schemas": "none", "tenant": '), k, F.lit("}")))
                      .when(F.col("c_custkey") % 10 == 2, F.concat(F.lit('{"schemas": [{"schema_name": "s'), k, F.lit('", "tables": 5}]}')))
                      .alias("value")).where("value IS NOT NULL")
    good.unionByName(broken).write.text(path)
    manifests, rejects = split_manifests(read_documents(spark, path, lines=True))
    tags = classify.flatten_manifest(manifests).agg(F.count(F.lit(1)).alias("n_tags"))
    return rejects.select(F.sha2("document", 256).alias("document_sha256"), "reason").join(tags)


def manifest_mismatch(spark, d):
    c = _customer(spark, d)
    return classify.manifest_mismatch(_manifest_tags(spark, d), fx.estate_column_catalog(c), "landing")


def missing_tags(spark, d):
    c = _customer(spark, d)
    return classify.missing_tags(_manifest_tags(spark, d, False), fx.estate_column_tags(c), "landing")


def apply_tags(spark, d):
    c = _customer(spark, d)
    return classify.apply_tags(
        _manifest_tags(spark, d, False), fx.estate_column_catalog(c), fx.estate_column_tags(c), "landing"
    )


# --------------------------------------------------------------------------- planning

def new_tables(spark, d):
    cat = fx.estate_table_catalog(_customer(spark, d))
    to_vault = plan.pending_tables(cat, "landing", "vault").withColumn("target_catalog", F.lit("vault"))
    to_anon = plan.pending_tables(cat, "vault", "anonymized").withColumn("target_catalog", F.lit("anonymized"))
    return to_vault.unionByName(to_anon)


def sensitive_columns(spark, d):
    return plan.sensitive_columns(fx.estate_column_tags(_customer(spark, d)))


def _estate_plan(spark, d):
    c = _customer(spark, d)
    pending = plan.pending_tables(fx.estate_table_catalog(c), "landing", "vault")
    return plan.load_plan(pending, fx.estate_column_catalog(c), fx.estate_column_tags(c), fx.registry_seed(spark))


def load_plan(spark, d):
    return _estate_plan(spark, d)


def tables_and_keys_to_load(spark, d):
    p = _estate_plan(spark, d)
    tables = plan.tables_to_load(p).select(
        F.lit("table").alias("kind"), "catalog_name", "schema_name", "table_name",
        *[F.lit(None).cast("string").alias(c) for c in ("tag_value", "kek_name", "dsk_name")],
    )
    key_rows = plan.keys_to_load(p).select(
        F.lit("key").alias("kind"),
        *[F.lit(None).cast("string").alias(c) for c in ("catalog_name", "schema_name", "table_name")],
        "tag_value", "kek_name", "dsk_name",
    )
    return tables.unionByName(key_rows)


def vault_schema(spark, d):
    return plan.target_schema(_estate_plan(spark, d), "vault")


def propagate_tags(spark, d):
    c = _customer(spark, d)
    return plan.propagate_tags(fx.estate_column_tags(c), _estate_plan(spark, d), "vault")


# --------------------------------------------------------------------------- keys

def key_registry(spark, d):
    """SNK-8/SET-1: registry after ensuring every sensitivity type in use has keys."""
    existing = fx.registry_seed(spark, SENSITIVITY_TYPES[:5])
    in_use = plan.sensitive_columns(fx.estate_column_tags(_customer(spark, d))).select(
        F.col("tag_value").alias("attribute")
    )
    return keys.ensure_registry(existing, in_use)


def _wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as local wall-clock time (TIMESTAMP_NTZ) so results read the same in any session zone."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


def kek_latest_version(spark, d):
    latest = keys.latest_kek_versions(fx.estate_kek_versions(_customer(spark, d)))
    return _wall_clock(latest, "latest_created")


def keys_due(spark, d):
    due = keys.keys_due(fx.estate_kek_versions(_customer(spark, d)), ROTATION_AS_OF)
    return _wall_clock(due, "created", "due_at")


def keys_ensure(spark, d):
    """KEY-1: create missing KEKs and DSKs; report the new DSKs without key bytes."""
    c = _customer(spark, d)
    registry = fx.estate_key_registry(c)
    keks = fx.estate_kek_versions(c)
    out = scratch_path(spark, "keys-ensure")
    with ScratchScope(spark):
        # New keys are random: cut the lineage once so every later use sees the same keys.
        new_keks = frozen(keys.ensure_keks(registry, keks, F.lit(KEY_CREATED_AT)), "keks")
        all_keks = keks.unionByName(new_keks)
        new_dsks = keys.ensure_dsks(registry, fx.estate_dsk_store(c), all_keks)
        checked = keys.unwrap_dsks(new_dsks.withColumn("wrapped_len", F.length("wrapped_dsk")), all_keks)
        return _left(checked.select(
            "attribute", "kek_name", "dsk_name", "kek_version", "wrapped_len",
            (F.coalesce(F.length("dsk"), F.lit(0)) == 32).alias("roundtrip_ok"),
        ), out, spark)


def keys_unwrap(spark, d):
    c = _customer(spark, d)
    u = keys.unwrap_dsks(fx.estate_dsk_store(c), fx.estate_kek_versions(c))
    return u.select("attribute", "kek_name", "dsk_name", "kek_version", F.sha2("dsk", 256).alias("dsk_fingerprint"))


def keys_rotate(spark, d):
    c = _customer(spark, d)
    keks = fx.estate_kek_versions(c)
    rotated = keys.rotate_dsks(fx.estate_dsk_store(c), keks)
    u = keys.unwrap_dsks(rotated, keks)
    return u.select(
        "attribute", "kek_name", "dsk_name", "kek_version", "rotated",
        F.sha2("dsk", 256).alias("dsk_fingerprint"),
    )


def aes_roundtrip(spark, d):
    """KEY-5: encrypt and decrypt data columns with a key read from the KEK table."""
    _, versions, _ = fx.global_keys(spark)
    key = versions.where(
        (F.col("kek_name") == KEK_NAME_PREFIX + "ssn") & (F.col("version") == "v1")
    ).select(F.max("kek")).scalar()
    df = _pii(spark, d)
    aad = F.col("id").cast("string").cast("binary")

    def rt(c):
        return unwrap(wrap(F.col(c).cast("binary"), key, aad), key, aad).cast("string")

    return df.select(
        "id", "ssn", "pan",
        rt("ssn").alias("ssn_roundtrip"),
        rt("pan").alias("pan_roundtrip"),
        F.length(wrap(F.col("ssn").cast("binary"), key, aad)).alias("ssn_cipher_len"),
    )


# --------------------------------------------------------------------------- masks

def _mask_query(column: str, stype: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, d):
        return _pii(spark, d).select("id", column, M.mask_column(F.col(column), stype).alias(f"{column}_masked"))

    run.__name__ = f"mask_{stype.replace('-', '_')}"
    run.__doc__ = f"MSK: mask of {column} ({stype})."
    return run


MASK_QUERIES = {f"mask_{t.replace('-', '_')}": _mask_query(c, t) for c, _, t in fx.SENSITIVE_COLUMNS}


def mask_role_gate(spark, d):
    members = fx.group_members(spark)
    alice = M.is_member(members, fx.PRIVILEGED_GROUP, F.lit("alice"))
    bob = M.is_member(members, fx.PRIVILEGED_GROUP, F.lit("bob"))
    return _pii(spark, d).select(
        "id", "ssn",
        M.gated("ssn", "ssn", alice).alias("ssn_as_alice"),
        M.gated("ssn", "ssn", bob).alias("ssn_as_bob"),
    )


# --------------------------------------------------------------------------- hashing

def hash_column(spark, d):
    return add_hashes(_pii(spark, d), ["id", "ssn"], {"ssn_hash": ("ssn", "ssn")},
                      _unwrapped_global(spark), ORACLE_BITS)


def hash_null(spark, d):
    hashed = add_hashes(_pii(spark, d), ["id", "ssn"], {"ssn_hash": ("ssn", "ssn")},
                        _unwrapped_global(spark), ORACLE_BITS)
    return hashed.select(
        "id",
        F.col("ssn").isNull().alias("ssn_is_null"),
        F.col("ssn_hash").isNull().alias("hash_is_null"),
    )


def hash_interleave(spark, d):
    df = _pii(spark, d)
    return hash_projection(df, plan_for_frame(df, fx.SENSITIVE_TYPE_OF), _unwrapped_global(spark), ORACLE_BITS)


def hash_join(spark, d):
    """JN-9: vault orders joined to vault customers through the stored SSN hashes."""
    def result(s, schema, root):
        customers = s.table(f"vault__{schema}.customer_records").select("id", "ssn_hash")
        orders = s.table(f"vault__{schema}.order_records").select("o_orderkey", "cust_ssn_hash")
        return lookup_on_hash(
            customers, orders, "ssn_hash", "cust_ssn_hash",
            [F.count(F.lit(1)).alias("n_orders"), F.sum("o_orderkey").alias("sum_orderkey")],
        )

    return _of_estate(spark, d, result, vault=True)


def hash_join_rows(spark, d):
    """JN-9 as pairs: every vault order with the customers of the same SSN hash, hot hashes split."""
    def result(s, schema, root):
        orders = s.table(f"vault__{schema}.order_records").select("o_orderkey", "cust_ssn_hash")
        customers = s.table(f"vault__{schema}.customer_records").where("ssn <> '12'").select("id", "ssn_hash")
        return join_on_hash(orders, customers, "cust_ssn_hash", "ssn_hash", salt_buckets=8)

    return _of_estate(spark, d, result, vault=True)


def hash_join_pruned(spark, d):
    """JN-9 with few matches: orders of one customer in a hundred, pruned by their hashes before the shuffle."""
    def result(s, schema, root):
        orders = s.table(f"vault__{schema}.order_records").select("o_orderkey", "cust_ssn_hash")
        few = s.table(f"vault__{schema}.customer_records").where("id % 100 = 0").select("id", "ssn_hash")
        return join_on_hash(prune_by_hash(orders, few, "cust_ssn_hash", "ssn_hash"), few, "cust_ssn_hash", "ssn_hash")

    return _of_estate(spark, d, result, vault=True)


def hash_joinability(spark, d):
    """HSH-3: which hash columns of the vault share values. Customers hashed once more with another
    salt stand for a table that was loaded with a wrong key."""
    def result(s, schema, root):
        customers = s.table(f"vault__{schema}.customer_records")
        types = {hash_column_name(c): t for c, _, t in fx.SENSITIVE_COLUMNS}
        wrong = customers.select(F.sha2(F.concat(F.lit("other"), "ssn"), ORACLE_BITS).alias("ssn_hash"))
        samples = sampled_hashes(customers, "customer_records", types, HALVINGS).unionByName(
            sampled_hashes(s.table(f"vault__{schema}.order_records"), "order_records", {"cust_ssn_hash": "ssn"}, HALVINGS)).unionByName(
            sampled_hashes(wrong, "wrong_records", {"ssn_hash": "ssn"}, HALVINGS))
        return joinability(samples, HALVINGS)

    return _of_estate(spark, d, result, vault=True)


# --------------------------------------------------------------------------- layers

def _sample_tags(spark, catalog: str, schema: str, table_name: str) -> DataFrame:
    """Tags of the sample customer table: the eight sensitive columns, both tags."""
    rows = [(catalog, schema, table_name, c, n, v)
            for c, cat, typ in fx.SENSITIVE_COLUMNS for n, v in ((TAG_CATEGORY, cat), (TAG_TYPE, typ))]
    return local_frame(spark, rows, "catalog_name string, schema_name string, table_name string, "
                                    "column_name string, tag_name string, tag_value string")


def vault_frame(spark, d, num_bits: int = ORACLE_BITS) -> DataFrame:
    """PIPE-3 without the write: catalog + tags + registry -> plan -> hashed projection."""
    landing = _pii(spark, d)
    ids = ("landing", "pci_pii_dataset", "customer_records")
    cols = frames_column_catalog(spark, {ids: landing})
    tbls = local_frame(spark, [(*ids, "MANAGED")], "catalog_name string, schema_name string, "
                                                   "table_name string, table_type string")
    registry, versions, wrapped = fx.global_keys(spark)
    p = plan.load_plan(plan.pending_tables(tbls, "landing", "vault"), cols, _sample_tags(spark, *ids), registry)
    (tp,) = table_plans(p.collect())
    return hash_projection(landing, tp, keys.unwrap_dsks(wrapped, versions), num_bits)


def _left(df: DataFrame, path: str, spark: SparkSession) -> DataFrame:
    """The result written to ``path``, for a reader of ``spark``: what it was made from may go."""
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _own_session(spark: SparkSession, core: str) -> SparkSession:
    """A session over the same catalog with the same settings and a core database of its own."""
    s = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if s.conf.isModifiable(k):
            s.conf.set(k, v)
    s.conf.set(store.CORE_CONF, core)
    return s


def _of_estate(spark, d, result: Callable[[SparkSession, str, str], DataFrame], vault: bool = False,
               first=None, files: int | None = None) -> DataFrame:
    """``result(session, schema, root)`` over an estate that is gone afterwards.

    The estate is a landing schema with customers (or the ``first`` of them, in so many ``files``)
    and orders, tagged and registered, with core tables of its own; ``vault``: loaded into the vault
    with the fixture's keys. The result is written outside of it; databases and files of the estate
    are dropped, whatever happens.
    """
    out = scratch_path(spark, "result")
    with ScratchScope(spark):
        root, schema = scratch_path(spark, "estate"), f"q{uuid.uuid4().hex[:12]}"
        s = _own_session(spark, f"core_{schema}")
        try:
            store.ensure_core(s, f"{root}/core")
            s.sql(f"CREATE DATABASE `landing__{schema}` LOCATION '{root}/landing'")
            customers = fx.pii_customers(_customer(s, d) if first is None else _customer(s, d).where(first))
            customers = customers.repartition(files) if files else customers
            customers.write.format("parquet").saveAsTable(f"landing__{schema}.customer_records")
            fx.orders_pii(table(s, d, "orders")).write.format("parquet").saveAsTable(f"landing__{schema}.order_records")
            ssn = [("landing", schema, "order_records", "cust_ssn", n, v) for n, v in ((TAG_CATEGORY, "pii"), (TAG_TYPE, "ssn"))]
            store.append(_sample_tags(s, "landing", schema, "customer_records").unionByName(
                local_frame(s, ssn, COLUMN_TAGS)), store.tags_of("landing"))
            store.append(fx.registry_seed(s), "key_registry")
            if vault:
                pipelines.load_vault(s, root=root, num_bits=ORACLE_BITS, schemas=[schema], keys=_unwrapped_global(s))
            return _left(result(s, schema, root), out, spark)
        finally:
            for db in (*(f"{x}__{schema}" for x in store.TAG_LAYERS), store.core(s)):
                s.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")


def vault_load(spark, d):
    """PIPE-3: landing tables through the load into vault tables, read back."""
    return _of_estate(spark, d, lambda s, schema, root: s.table(f"vault__{schema}.customer_records"), vault=True)


def _arrived(spark, d, result, files: int | None = None) -> DataFrame:
    """Half of the customers is loaded into both layers, the rest arrives later in one file."""
    def run(s, schema, root):
        pipelines.load_anonymized(s, root=root, schemas=[schema])
        late = _pii(s, d).where("id % 2 <> 0").coalesce(1)
        pipelines.append_table(late, "landing", schema, "customer_records")
        arrivals.load_arrivals(s, num_bits=ORACLE_BITS, schemas=[schema], keys=_unwrapped_global(s))
        return result(s, schema)

    return _of_estate(spark, d, run, vault=True, first=F.col("c_custkey") % 2 == 0, files=files)


def arrivals_load(spark, d):
    """STR-1 end to end: rows that arrive after the load reach both layers."""
    def result(s, schema):
        anonymized = s.table(f"anonymized__{schema}.customer_records").select("id", F.col("ssn").alias("ssn_masked"))
        return s.table(f"vault__{schema}.customer_records").join(anonymized, "id")

    return _arrived(spark, d, result)


def arrivals_audit(spark, d):
    """STR-1 and PIPE-3/4 audits: one file arrives beside 60 that are loaded; rows by audited write,
    and the files that the ledger has for the landing table."""
    def result(s, schema):
        ledger = store.read(s, "loaded_files").where("table_name = 'customer_records'").agg(F.count(F.lit(1)).alias("n_files"))
        return store.read(s, "load_audits").select(
            "target_catalog", "table_name", F.when(F.col("batch") == "", "load").otherwise("arrival").alias("kind"), "rows").join(ledger)

    return _arrived(spark, d, result, files=60)


def anonymized_load(spark, d):
    """PIPE-4: vault tables through the load into anonymized tables, read back."""
    def result(s, schema, root):
        pipelines.load_anonymized(s, root=root, schemas=[schema])
        return s.table(f"anonymized__{schema}.customer_records")

    return _of_estate(spark, d, result, vault=True)


def masked_view(spark, d):
    """GOV-6: the view that the vault load made, through the SQL mask functions, as a user outside the group."""
    return _of_estate(spark, d, lambda s, schema, root: s.table(
        f"vault__{schema}.{pipelines.masked_view_name('customer_records')}"), vault=True)


def vault_tags(spark, d):
    """GOV-2 as loaded: the tags that the vault load recorded for its tables."""
    return _of_estate(spark, d, lambda s, schema, root: store.read(s, store.tags_of("vault")).where(
        F.col("schema_name") == schema).select("table_name", "column_name", "tag_name", "tag_value"), vault=True)


def tag_log(spark, d):
    """GOV-1, GOV-2: recorded tags, then two changes, as batches of the log, with compactions between
    and after them; the tags that count in the end."""
    out = scratch_path(spark, "result")
    with ScratchScope(spark):
        s = _own_session(spark, f"core_q{uuid.uuid4().hex[:12]}")
        try:
            store.ensure_core(s, scratch_path(spark, "core"))
            tags = fx.estate_column_tags(_customer(s, d))
            store.append_tags(tags, "landing")
            store.compact_tags(s, "landing")
            store.append_tags(tags.where("column_name = 'dob' and tag_value = 'pci'").withColumn("tag_value", F.lit("pii")), "landing")
            store.append_tags(tags.where("column_name = 'bank_name'").withColumn("tag_value", F.lit(None).cast("string")), "landing")
            store.compact_tags(s, "landing")
            store.append_tags(tags.where("column_name = 'dob' and tag_value = 'dob'").withColumn("tag_name", F.lit("reviewed")), "landing")
            return _left(store.read(s, store.tags_of("landing")), out, spark)
        finally:
            s.sql(f"DROP DATABASE IF EXISTS `{store.core(s)}` CASCADE")


def incremental_load(spark, d):
    """STR-1: protect new landing files with Structured Streaming, read the result back."""
    from veilspark.streaming.incremental import protect_stream

    registry, versions, wrapped = fx.global_keys(spark)
    schema = table(spark, d, "customer").schema
    out = protect_stream(
        spark, d, schema, file_glob="customer.parquet",
        transform=fx.pii_customers,
        sensitive=fx.SENSITIVE_TYPE_OF,
        unwrapped_keys=keys.unwrap_dsks(wrapped, versions),
        num_bits=ORACLE_BITS,
    )
    from veilspark.streaming.incremental import read_protected

    return read_protected(spark, out)


WORKLOADS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "synthetic_pii": synthetic_pii,
    "column_catalog": column_catalog,
    "manifest_flatten": manifest_flatten,
    "manifest_quarantine": manifest_quarantine,
    "manifest_mismatch": manifest_mismatch,
    "missing_tags": missing_tags,
    "apply_tags": apply_tags,
    "new_tables": new_tables,
    "sensitive_columns": sensitive_columns,
    "load_plan": load_plan,
    "tables_and_keys_to_load": tables_and_keys_to_load,
    "vault_schema": vault_schema,
    "key_registry": key_registry,
    "kek_latest_version": kek_latest_version,
    "keys_ensure": keys_ensure,
    "keys_unwrap": keys_unwrap,
    "keys_rotate": keys_rotate,
    "keys_due": keys_due,
    "aes_roundtrip": aes_roundtrip,
    **MASK_QUERIES,
    "mask_role_gate": mask_role_gate,
    "hash_column": hash_column,
    "hash_null": hash_null,
    "hash_interleave": hash_interleave,
    "hash_join": hash_join,
    "hash_join_rows": hash_join_rows,
    "hash_join_pruned": hash_join_pruned,
    "hash_joinability": hash_joinability,
    "masked_view": masked_view,
    "propagate_tags": propagate_tags,
    "vault_load": vault_load,
    "vault_tags": vault_tags,
    "tag_log": tag_log,
    "anonymized_load": anonymized_load,
    "incremental_load": incremental_load,
    "arrivals_load": arrivals_load,
    "arrivals_audit": arrivals_audit,
}
