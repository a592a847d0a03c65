"""Pipelines that write: classify, keys, vault load, anonymized load, masked views.

Data rows never pass through Python: each table is one
``scan -> select -> write`` Spark job, audited as it is written and published
by one switch of the table's location. The driver sees only metadata: the
load plan is frozen in the shared folder, in a scope of the run's own, and
streamed table by table.
Table jobs run concurrently from a small thread pool; tags and plan are read
a fixed number of times a run, however many tables there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark import schemas as S
from veilspark.functions.masks import MASK_SQL, register_sql_functions, sql_function_name
from veilspark.operators import classify as C
from veilspark.operators import keys as K
from veilspark.operators import plan as P
from veilspark.operators.partitioning import spread
from veilspark.operators.protect import TablePlan, hash_projection, iter_table_plans, mask_projection
from veilspark.plans import store
from veilspark.plans.publish import create_empty, publish_version, unhashed
from veilspark.session import ScratchScope, frozen, scratch_path, shared_dir
from veilspark.sources.catalog import column_catalog, table_catalog
from veilspark.sources.files import table_files
from veilspark.sources.local import local_frame
from veilspark.sources.manifest import read_manifest

LANDING, VAULT, ANON = S.Layer.LANDING.value, S.Layer.VAULT.value, S.Layer.ANONYMIZED.value


# --------------------------------------------------------------------------- classify

@dataclass
class ClassifyResult:
    mismatches: DataFrame  # (schema_name, table_name, column_name, reason), frozen
    mismatch_count: int
    applied: int           # number of tags written (0 if gated)
    batch: str | None      # of the changed tags in the layer's log, if any


def classify(spark: SparkSession, manifest_path: str, catalog_name: str = LANDING,
             schemas: list[str] | None = None) -> ClassifyResult:
    """PIPE-1: manifest -> validation -> tags of ``catalog_name``, all or nothing.

    The manifest is read once and frozen. The mismatch report is returned
    whole as a frame in the shared folder (in the caller's scope), never
    collected. Only tags that are new or change are written, as one batch of the layer's
    log, so a repeated run applies 0. Two values for one tag raise.
    """
    shared_dir(spark)
    report = scratch_path(spark, "mismatches")  # the caller's: outlives this function's scope
    with ScratchScope(spark):
        return _classify(spark, manifest_path, catalog_name, schemas, report)


def _classify(spark: SparkSession, manifest_path: str, catalog_name: str, schemas: list[str] | None, report: str) -> ClassifyResult:
    manifest = frozen(C.one_value_per_tag(C.flatten_manifest(read_manifest(spark, manifest_path))), "manifest")
    tables = table_catalog(spark, [catalog_name], schemas).where("table_type = 'MANAGED'")
    named = tables.join(manifest.select("schema_name", "table_name").distinct(), ["schema_name", "table_name"], "left_semi")
    cols = column_catalog(spark, named)
    found = C.manifest_mismatch(manifest, cols, catalog_name)
    found.write.parquet(report)
    mismatch = spark.read.schema(found.schema).parquet(report)
    n_mismatch = mismatch.count()
    if n_mismatch:
        return ClassifyResult(mismatch, n_mismatch, 0, None)
    tags = store.read(spark, store.tags_of(catalog_name))
    missing = frozen(C.missing_tags(manifest, tags, catalog_name), "missing-tags")
    applied = missing.count()
    if applied == 0:
        return ClassifyResult(mismatch, 0, 0, None)
    return ClassifyResult(mismatch, 0, applied, store.append_tags(missing.withColumn("catalog_name", F.lit(catalog_name)), catalog_name))


# --------------------------------------------------------------------------- keys

def bootstrap_keys(spark: SparkSession, attributes: DataFrame | None = None,
                   created: Column | None = None) -> dict:
    """KEY-1 + SNK-8: registry rows, KEKs and wrapped DSKs for every attribute in use.

    ``attributes`` defaults to the sensitivity types tagged in the landing layer.
    Each generation step is written before the next one reads it, so
    random keys are drawn exactly once. Idempotent.
    """
    created = F.current_timestamp() if created is None else created
    if attributes is None:
        attributes = P.sensitive_columns(store.read(spark, store.tags_of(LANDING))).select(
            F.col("tag_value").alias("attribute")
        )
    registry_now = store.read(spark, "key_registry")
    new_registry = K.ensure_registry(registry_now, attributes).join(
        registry_now, ["pci_pii_attribute_name", "kek_name", "dsk_name"], "left_anti"
    )
    store.append(new_registry, "key_registry")
    registry = store.read(spark, "key_registry")
    store.append(K.ensure_keks(registry, store.read(spark, "kek_versions"), created), "kek_versions")
    new_dsks = K.ensure_dsks(registry, store.read(spark, "dsk_store"), store.read(spark, "kek_versions"))
    store.append(new_dsks, "dsk_store")
    return {
        "registry": registry.count(),
        "keks": store.read(spark, "kek_versions").select("kek_name").distinct().count(),
        "dsks": store.read(spark, "dsk_store").count(),
    }


def rotate_keys(spark: SparkSession, as_of: Column | str | None = None, force: bool = False) -> int | None:
    """KEY-3/4: new versions for due KEKs (all KEKs if ``force``), then re-wrap the DSKs.

    DSKs not on their KEK's latest version are re-wrapped (also ones left
    behind by an earlier interrupted run). The re-wrapped store is
    published as a new version only if something changed; the previous
    version stays until the switch. Returns the new dsk_store version, or
    None when nothing needed re-wrapping.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    versions = store.read(spark, "kek_versions")
    due = versions.select("kek_name").distinct() if force else K.keys_due(versions, as_of)
    store.append(K.new_kek_versions(due, versions, F.current_timestamp()), "kek_versions")
    latest = K.latest_kek_versions(store.read(spark, "kek_versions"))
    stale = store.read(spark, "dsk_store").join(latest, "kek_name").where(
        F.col("kek_version") != F.col("latest_version")
    )
    if stale.isEmpty():
        return None
    rotated = K.rotate_dsks(store.read(spark, "dsk_store"), store.read(spark, "kek_versions"))
    return store.publish(rotated.drop("rotated"), "dsk_store")


def unwrapped_keys(spark: SparkSession) -> DataFrame:
    return K.unwrap_dsks(store.read(spark, "dsk_store"), store.read(spark, "kek_versions"))


# --------------------------------------------------------------------------- layers

class LoadError(RuntimeError):
    """Some tables were not loaded; ``loaded`` were. ``failed``: table -> reason."""

    def __init__(self, loaded: list[str], failed: dict[str, str]):
        super().__init__("; ".join(f"{t}: {why}" for t, why in sorted(failed.items())))
        self.loaded, self.failed = loaded, failed


def _loads(spark: SparkSession, source: str, target: str, status: str) -> DataFrame:
    return store.read(spark, "loads").where(
        (F.col("source_catalog") == source) & (F.col("target_catalog") == target) & (F.col("status") == status)
    ).select("schema_name", "table_name").distinct()


def pending(spark: SparkSession, source: str, target: str, schemas: list[str] | None = None) -> DataFrame:
    """Managed ``source`` tables without a completed load into ``target``.

    Completion is read from ``core.loads``, written after the data, view
    and tags, so a load that crashed half way is redone.
    """
    done = _loads(spark, source, target, "done").select(
        F.lit(target).alias("catalog_name"), "schema_name", "table_name", F.lit("MANAGED").alias("table_type"))
    return P.pending_tables(table_catalog(spark, [source], schemas).unionByName(done), source, target)


def _ensure_db(spark: SparkSession, layer: str, schema: str, root: str | None) -> None:
    loc = f" LOCATION '{root.rstrip('/')}/{layer}/{schema}'" if root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{S.database_name(layer, schema)}`{loc}")


def partition_columns(spark: SparkSession, qualified_name: str) -> list[str]:
    """Partition columns of a catalog table, in order."""
    return [c.name for c in spark.catalog.listColumns(qualified_name.replace("`", "")) if c.isPartition]


def _create_target(df: DataFrame, layer: str, schema: str, table: str, partition_by: list[str]) -> str:
    """SNK-3: the empty target table with the layout of ``df``, if absent."""
    name = S.qualified(layer, schema, table)
    create_empty(df.sparkSession, name, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), partition_by)
    return name


def _fill(df: DataFrame, name: str, max_records_per_file: int | None = None, faults: dict[str, Column] | None = None) -> int:
    """SNK-4: the audited rows become the table's data in one switch; what an unfinished earlier load left goes."""
    spark = df.sparkSession
    columns = spark.table(name).columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"the columns of {name} are {', '.join(columns)}, not {', '.join(df.columns)}")
    return publish_version(df.select(*[f"`{c}`" for c in columns]), name, partition_columns(spark, name), faults, max_records_per_file)


def _record(spark: SparkSession, source: str, target: str, plans: list[TablePlan], status: str) -> None:
    if not plans:
        return
    rows = local_frame(
        spark,
        [(source, target, tp.schema_name, tp.table_name, status) for tp in plans],
        "source_catalog string, target_catalog string, schema_name string, table_name string, status string",
    ).withColumn("loaded_at", F.current_timestamp())
    store.append(rows, "loads")


def record_audits(spark: SparkSession, rows: list[tuple[str, str, str, str, int]]) -> None:
    """(target layer, schema, table, batch, rows) of audited writes."""
    if rows:
        store.append(local_frame(spark, rows, "target_catalog string, schema_name string, table_name string, batch string, rows bigint")
                     .withColumn("written_at", F.current_timestamp()), "load_audits")


def _publish_tags(tags: DataFrame, layer: str) -> None:
    """The layer's tags, those of ``tags`` in place of older ones of the same column and name; only these are written."""
    store.append_tags(tags, layer)


def _chunks(it: Iterator[TablePlan], size: int) -> Iterator[list[TablePlan]]:
    chunk: list[TablePlan] = []
    for tp in it:
        chunk.append(tp)
        if len(chunk) >= size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def vault_plan(spark: SparkSession, source: str = LANDING, target: str = VAULT,
               schemas: list[str] | None = None) -> DataFrame:
    """PIPE-2 over the live catalog: schemas are looked up for pending tables only."""
    todo = frozen(pending(spark, source, target, schemas), "pending")
    return P.load_plan(
        todo,
        column_catalog(spark, todo, store.read(spark, "not_null")),
        store.read(spark, store.tags_of(source)),
        store.read(spark, "key_registry"),
    )


def _refuse(plan_df: DataFrame, source: str, target: str, schemas: list[str] | None,
            hashes: bool) -> None:
    """Validation of the whole plan: raises before anything is written. ``hashes``: the load adds them."""
    spark = plan_df.sparkSession
    problems = []
    no_key = F.col("dsk_name").isNull() if hashes else F.lit(False)
    no_mask = ~F.col("tag_value").isin(*MASK_SQL)
    odd = plan_df.where(F.col("tag_value").isNotNull() & (no_key | no_mask)).select(
        *P.COLUMN_KEYS, "tag_value", no_key.alias("no_key"), no_mask.alias("no_mask")).limit(40).collect()
    if unkeyed := [r for r in odd if r.no_key]:
        problems.append("no registered salt key for " + ", ".join(
            sorted(f"{r.schema_name}.{r.table_name}.{r.column_name} ({r.tag_value})" for r in unkeyed)))
    if unmasked := {r.tag_value for r in odd if r.no_mask}:
        problems.append("no mask for sensitivity type " + ", ".join(sorted(unmasked)))
    started = _loads(spark, source, target, "started")
    there = table_catalog(spark, [target], schemas).select("schema_name", "table_name")
    foreign = P.tables_to_load(plan_df).join(there, ["schema_name", "table_name"], "left_semi").join(
        started, ["schema_name", "table_name"], "left_anti").limit(20).collect()
    if foreign:
        problems.append(f"there are {target} tables that no load has made: " + ", ".join(
            sorted(f"{r.schema_name}.{r.table_name}" for r in foreign)))
    for tp in iter_table_plans(plan_df):
        try:
            if hashes:
                tp.check_names()
        except ValueError as e:
            problems.append(str(e))
        if tp.sensitive:
            parts = partition_columns(spark, S.qualified(source, tp.schema_name, tp.table_name))
            clear = [c for c in parts if c in tp.sensitive]
            if clear:
                problems.append(f"{tp.schema_name}.{tp.table_name} is partitioned by sensitive columns: {', '.join(clear)}")
    if problems:
        raise RuntimeError("; ".join(problems))


def _load_tables(spark: SparkSession, plan_df: DataFrame, source: str, target: str, one, *, root: str | None,
                 parallelism: int, chunk_size: int) -> tuple[list[TablePlan], dict[str, str]]:
    """Run ``one(table plan)``, which returns the rows written, for every table. A table that fails stops no other."""
    done: list[TablePlan] = []
    failed: dict[str, str] = {}

    def attempt(tp: TablePlan):
        try:
            return tp, one(tp), None
        except Exception as e:  # noqa: BLE001 - reported with all others at the end
            return tp, 0, f"{type(e).__name__}: {str(e).splitlines()[0][:300] if str(e) else ''}"

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for chunk in _chunks(iter_table_plans(plan_df), chunk_size):
            for schema in sorted({tp.schema_name for tp in chunk}):  # before the concurrent writes
                _ensure_db(spark, target, schema, root)
            _record(spark, source, target, chunk, "started")
            files = None
            if source == LANDING:  # listed before they are read: later ones count as new
                files = frozen(table_files(spark, source, [(tp.schema_name, tp.table_name) for tp in chunk]), "files")
            audits = []
            for tp, rows, why in pool.map(attempt, chunk):
                if why is None:
                    done.append(tp)
                    audits.append((target, tp.schema_name, tp.table_name, "", rows))
                else:
                    failed[f"{tp.schema_name}.{tp.table_name}"] = why
            record_audits(spark, audits)
            if files is not None:
                store.append(_only(files, failed), "loaded_files")
    return done, failed


def _only(plan_df: DataFrame, failed: dict[str, str]) -> DataFrame:
    """The plan without the tables that failed."""
    if not failed:
        return plan_df
    names = local_frame(plan_df.sparkSession, [tuple(t.split(".", 1)) for t in failed], "schema_name string, table_name string")
    return plan_df.join(names, ["schema_name", "table_name"], "left_anti")


def load_vault(spark: SparkSession, *, num_bits: int = 512, root: str | None = None,
               privileged_group: str = "pii_readers", parallelism: int = 4, chunk_size: int = 64,
               max_records_per_file: int | None = None, partitions: int | None = None,
               schemas: list[str] | None = None, keys: DataFrame | None = None) -> list[str]:
    """PIPE-3: every pending landing table -> vault table with salted hashes.

    The load plan is frozen first (written to the shared folder), since
    the loads change the catalog it reads, and validated as a whole: a
    sensitive column without a usable key or mask, a clash of names, a
    sensitive partition column or a target that no load made raise before
    any write. Then, table by table (several at once): the empty target, its
    role-gated masked view, the data. So clear rows never stand without a
    view. Tags follow in one pass over the plan, then the completion records.
    Tables that fail stop no others; :class:`LoadError` names them at the end.
    ``partitions`` deals each table's rows to so many tasks first. ``schemas``
    limits the load. ``keys``: unwrapped keys, by default those of the store.
    """
    shared_dir(spark)
    with ScratchScope(spark):
        return _load_vault(spark, num_bits, root, privileged_group, parallelism, chunk_size, max_records_per_file, partitions, schemas, keys)


def _load_vault(spark: SparkSession, num_bits: int, root: str | None, privileged_group: str, parallelism: int, chunk_size: int,
                max_records_per_file: int | None, partitions: int | None, schemas: list[str] | None, keys: DataFrame | None) -> list[str]:
    plan_df = frozen(vault_plan(spark, LANDING, VAULT, schemas), "plan")
    keys_df = unwrapped_keys(spark) if keys is None else keys
    _refuse(plan_df, LANDING, VAULT, schemas, hashes=True)
    required = plan_df.where(F.col("tag_value").isNotNull()).select(F.col("tag_value").alias("attribute"))
    missing = [r.attribute for r in K.missing_salts(required, keys_df).collect()]
    if missing:
        raise RuntimeError(f"no usable data salt key for: {', '.join(sorted(missing))}")
    register_mask_functions(spark, privileged_group)

    def one(tp: TablePlan) -> int:
        source = S.qualified(LANDING, tp.schema_name, tp.table_name)
        rows = hash_projection(spread(spark.table(source), partitions), tp, keys_df, num_bits)
        name = _create_target(rows, VAULT, tp.schema_name, tp.table_name, partition_columns(spark, source))
        create_masked_view(spark, VAULT, tp.schema_name, tp.table_name, tp.sensitive)
        return _fill(rows, name, max_records_per_file, unhashed(tp))

    done, failed = _load_tables(spark, plan_df, LANDING, VAULT, one, root=root, parallelism=parallelism, chunk_size=chunk_size)
    loaded = _only(plan_df, failed)
    if done:
        _publish_tags(P.propagate_tags(store.read(spark, store.tags_of(LANDING)), loaded, VAULT), VAULT)
        strict = loaded.where("is_nullable = 'NO'").select(F.lit(VAULT).alias("catalog_name"), "schema_name", "table_name", "column_name")
        store.append(strict, "not_null")
    return _finish(spark, LANDING, VAULT, done, failed)


def _finish(spark: SparkSession, source: str, target: str, done: list[TablePlan], failed: dict[str, str]) -> list[str]:
    _record(spark, source, target, done, "done")
    names = [tp.table_name for tp in done]
    if failed:
        raise LoadError(names, failed)
    return names


def anonymize_plan(spark: SparkSession, schemas: list[str] | None = None) -> DataFrame:
    """Vault tables not yet anonymized, one row per column, type tag where masked."""
    todo = frozen(pending(spark, VAULT, ANON, schemas), "pending")
    loaded = _loads(spark, LANDING, VAULT, "done")  # not what a vault load is still writing
    cols = column_catalog(spark, todo.join(loaded, ["schema_name", "table_name"], "left_semi"), store.read(spark, "not_null"))
    sens = P.sensitive_columns(store.read(spark, store.tags_of(VAULT)))
    return cols.join(sens, ["catalog_name", "schema_name", "table_name", "column_name"], "left").select(
        *P.PLAN_COLUMNS[:9], F.lit(None).cast("string").alias("kek_name"), F.lit(None).cast("string").alias("dsk_name")
    )


def load_anonymized(spark: SparkSession, *, root: str | None = None, parallelism: int = 4,
                    chunk_size: int = 64, max_records_per_file: int | None = None,
                    partitions: int | None = None, schemas: list[str] | None = None) -> list[str]:
    """PIPE-4: vault -> anonymized, masked whoever runs it, hashes kept, tags carried on.

    Validation, order and errors as in :func:`load_vault`.
    """
    shared_dir(spark)
    with ScratchScope(spark):
        return _load_anonymized(spark, root, parallelism, chunk_size, max_records_per_file, partitions, schemas)


def _load_anonymized(spark: SparkSession, root: str | None, parallelism: int, chunk_size: int, max_records_per_file: int | None,
                     partitions: int | None, schemas: list[str] | None) -> list[str]:
    plan_df = frozen(anonymize_plan(spark, schemas), "plan")
    _refuse(plan_df, VAULT, ANON, schemas, hashes=False)

    def one(tp: TablePlan) -> int:
        source = S.qualified(VAULT, tp.schema_name, tp.table_name)
        rows = mask_projection(spread(spark.table(source), partitions), tp.sensitive)
        name = _create_target(rows, ANON, tp.schema_name, tp.table_name, partition_columns(spark, source))
        return _fill(rows, name, max_records_per_file)

    done, failed = _load_tables(spark, plan_df, VAULT, ANON, one, root=root, parallelism=parallelism, chunk_size=chunk_size)
    if done:
        tables = P.tables_to_load(_only(plan_df, failed))
        tags = store.read(spark, store.tags_of(VAULT)).join(tables, P.TABLE_KEYS, "left_semi")
        _publish_tags(tags.withColumn("catalog_name", F.lit(ANON)), ANON)
    return _finish(spark, VAULT, ANON, done, failed)


# --------------------------------------------------------------------------- landing tables

def create_table(spark: SparkSession, layer: str, schema: str, table: str, struct,
                 replace: bool = False, root: str | None = None) -> str:
    """SNK-2/SNK-7: (re)create an empty parquet table with a fixed schema in a layer.

    Its NOT NULL columns are recorded in ``core.not_null`` and checked by the loads.
    """
    _ensure_db(spark, layer, schema, root)
    name = f"{S.database_name(layer, schema)}.{table}"
    if replace or not spark.catalog.tableExists(name):
        spark.createDataFrame([], struct).write.format("parquet").mode("overwrite").saveAsTable(name)
        strict = [(layer, schema, table, f.name) for f in struct.fields if not f.nullable]
        if strict:
            store.append(local_frame(spark, strict, S.NOT_NULL), "not_null")
    return name


def append_table(df: DataFrame, layer: str, schema: str, table: str) -> None:
    """SNK-1: append rows to a layer table, columns matched by name."""
    name = f"{S.database_name(layer, schema)}.{table}"
    cols = df.sparkSession.table(name).columns
    df.select(*cols).write.format("parquet").mode("append").insertInto(name)


# --------------------------------------------------------------------------- masked views

def register_mask_functions(spark: SparkSession, privileged_group: str = "pii_readers") -> list[str]:
    store.ensure_core(spark)
    return register_sql_functions(spark, store.core(spark), privileged_group, store.core_name(spark, "group_members"))


def masked_view_name(table: str) -> str:
    return f"{table}__masked"


def create_masked_view(spark: SparkSession, layer: str, schema: str, table: str,
                       sensitive: dict[str, str]) -> str:
    """GOV-6: ``<table>__masked`` view, sensitive columns through the ``core.<type>_mask`` functions.

    A convenience for SQL users; not a security border for anyone who can
    read the table's files.
    """
    src = S.qualified(layer, schema, table)
    fields = spark.table(src).schema.fields
    sel = []
    for f in fields:
        name = f"`{f.name}`"
        if f.name in sensitive:
            fn = f"`{store.core(spark)}`.{sql_function_name(sensitive[f.name])}"
            sel.append(f"{fn}(CAST({name} AS STRING)) AS {name}")
        else:
            sel.append(name)
    view = f"`{S.database_name(layer, schema)}`.`{masked_view_name(table)}`"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(sel)} FROM {src}")
    return view
