"""STR-1 for catalog tables: rows of files that arrived in loaded landing tables are appended.

Only new files are read: one row per file is listed, and ``core.loaded_files``, the ledger,
has those of earlier batches. A batch goes through these steps, each safe to redo:

1. its rows, hashed, are written to ``_arrivals/<batch>`` in the vault table's folder, where
   readers don't look, and audited; with it the list of its files;
2. if the table is anonymized, the staged rows are masked into the same place there;
3. a ``_READY`` mark ends the staging;
4. the staged files are moved into the tables' folders, one rename each;
5. the batch's files are written to the ledger, and the staging goes.

A run that is cut short before the mark has changed nothing; its staging is dropped. After the
mark the next run moves what is left and completes the ledger before it looks for new files. So a
batch neither loses nor doubles rows wherever it is cut. While files are being moved a
reader may see a part of a batch. Two runs at a time over one table aren't locked against each other.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark import schemas as S
from veilspark.operators import plan as P
from veilspark.operators.protect import TablePlan, hash_projection, iter_table_plans, mask_projection
from veilspark.plans import pipelines as PL
from veilspark.plans import store
from veilspark.plans.publish import unhashed, write_audited
from veilspark.session import ScratchScope, frozen, scratch_path, shared_dir
from veilspark.sources.catalog import column_catalog
from veilspark.sources.files import table_files, table_location
from veilspark.sources.local import local_frame
from veilspark.storage import Files

LANDING, VAULT, ANON = PL.LANDING, PL.VAULT, PL.ANON
STAGE, READY, LISTED = "_arrivals", "_READY", "_files"
MAX_FILES = 10_000  # of one batch of a table
MOVES = 16          # renames at a time


class Moved(NamedTuple):
    """A batch whose files are in place."""

    schema: str
    table: str
    batch: str
    rows: int
    listed: str               # where its source files are listed
    staged: tuple[str, ...]   # folders that go at the end


FILE_KEYS = [f.name for f in S.LOADED_FILES.fields]


def loaded_tables(spark: SparkSession, schemas: list[str] | None = None) -> DataFrame:
    """(schema_name, table_name, anonymized) of completed vault loads."""
    loaded = PL._loads(spark, LANDING, VAULT, "done")
    if schemas is not None:
        loaded = loaded.where(F.col("schema_name").isin(schemas))
    anonymized = PL._loads(spark, VAULT, ANON, "done").withColumn("anonymized", F.lit(True))
    return loaded.join(anonymized, ["schema_name", "table_name"], "left").select(
        "schema_name", "table_name", F.coalesce("anonymized", F.lit(False)).alias("anonymized"))


def arrived_files(spark: SparkSession, tables: DataFrame, chunk_size: int = 64) -> DataFrame:
    """Files of these landing tables that the ledger doesn't have, frozen."""
    path = scratch_path(spark, "landing-files")
    local_frame(spark, [], S.LOADED_FILES).write.parquet(path)
    it = ((r.schema_name, r.table_name) for r in tables.toLocalIterator())
    while chunk := list(islice(it, chunk_size)):
        table_files(spark, LANDING, chunk).write.mode("append").parquet(path)
    known = store.read(spark, "loaded_files").where(F.col("source_catalog") == LANDING)
    return frozen(spark.read.schema(S.LOADED_FILES).parquet(path).join(known, FILE_KEYS, "left_anti"), "arrived")


def _names(tp: TablePlan) -> dict[str, str]:
    return {x: S.qualified(x, tp.schema_name, tp.table_name) for x in (LANDING, VAULT, ANON)}


def new_rows(spark: SparkSession, source: str, paths: list[str]) -> DataFrame:
    """The rows of these files of a table, with its columns."""
    provider = spark.sql(f"DESCRIBE TABLE EXTENDED {source}").where("col_name = 'Provider'").first()["data_type"]
    return spark.read.format(provider).schema(spark.table(source).schema).option(
        "basePath", table_location(spark, source)).load(paths)


def stage(spark: SparkSession, tp: TablePlan, mine: DataFrame, anonymized: bool, keys_df: DataFrame, num_bits: int) -> str:
    """Steps 1 to 3 for the files ``mine`` (at most ``MAX_FILES``); returns the batch."""
    names, files, batch = _names(tp), Files(spark), uuid.uuid4().hex
    root = f"{table_location(spark, names[VAULT])}/{STAGE}/{batch}"
    parts = PL.partition_columns(spark, names[LANDING])
    paths = [r.path for r in mine.select("path").collect()]  # bounded by the batch
    rows = hash_projection(new_rows(spark, names[LANDING], paths), tp, keys_df, num_bits)
    n = write_audited(rows.select(*[f"`{c}`" for c in spark.table(names[VAULT]).columns]), f"{root}/data", parts, unhashed(tp))
    mine.write.parquet(f"{root}/{LISTED}")
    if anonymized:
        staged = spark.read.schema(spark.table(names[VAULT]).schema).parquet(f"{root}/data")
        masked = mask_projection(staged, tp.sensitive).select(*[f"`{c}`" for c in spark.table(names[ANON]).columns])
        write_audited(masked, f"{table_location(spark, names[ANON])}/{STAGE}/{batch}/data", parts)
    files.write_text(f"{root}/{READY}", json.dumps({"rows": n, "anonymized": anonymized}))
    return batch


def _places(spark: SparkSession, schema: str, table: str) -> dict[str, str]:
    return {x: table_location(spark, S.qualified(x, schema, table)) for x in (VAULT, ANON)
            if spark.catalog.tableExists(f"{S.database_name(x, schema)}.{table}")}


def move(spark: SparkSession, schema: str, table: str, batch: str) -> Moved | None:
    """Step 4; a batch without its mark is dropped."""
    files, at = Files(spark), _places(spark, schema, table)
    root = f"{at[VAULT]}/{STAGE}/{batch}"
    staged = {x: f"{place}/{STAGE}/{batch}" for x, place in at.items()}
    if not files.exists(f"{root}/{READY}"):
        for x in staged.values():
            files.delete(x)
        return None
    said = json.loads(files.read_text(f"{root}/{READY}"))
    for layer in (VAULT, ANON) if said["anonymized"] else (VAULT,):
        source, target = f"{staged[layer]}/data", at[layer]
        with ThreadPoolExecutor(max_workers=MOVES) as pool:
            list(pool.map(lambda x, s=source, t=target: files.move(f"{s}/{x}", f"{t}/{x}"), files.data_files(source)))
        spark.catalog.refreshTable(S.qualified(layer, schema, table))
    return Moved(schema, table, batch, said["rows"], f"{root}/{LISTED}", tuple(staged.values()))


def settle(spark: SparkSession, moved: list[Moved]) -> None:
    """Step 5 for batches whose files are in place, all at once."""
    if not moved:
        return
    mine = spark.read.schema(S.LOADED_FILES).parquet(*[m.listed for m in moved])
    store.append(mine.join(store.read(spark, "loaded_files"), FILE_KEYS, "left_anti"), "loaded_files")
    known = {r.batch for r in store.read(spark, "load_audits").where(F.col("batch").isin([m.batch for m in moved])).select("batch").collect()}
    PL.record_audits(spark, [(VAULT, m.schema, m.table, m.batch, m.rows) for m in moved if m.batch not in known])
    files = Files(spark)
    for m in moved:
        for place in m.staged:
            files.delete(place)


def recover(spark: SparkSession, tables: DataFrame, parallelism: int = 4) -> list[str]:
    """Completes or drops what earlier runs have left in the tables' folders; the tables that got rows by it."""
    files = Files(spark)
    changed: list[str] = []

    def one(r) -> list[Moved]:
        if not spark.catalog.tableExists(f"{S.database_name(VAULT, r.schema_name)}.{r.table_name}"):
            return []
        place = table_location(spark, S.qualified(VAULT, r.schema_name, r.table_name))
        found = [move(spark, r.schema_name, r.table_name, batch) for batch in files.names(f"{place}/{STAGE}")]
        return [m for m in found if m]

    it = tables.toLocalIterator()
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        while some := list(islice(it, 64 * parallelism)):
            moved = [m for found in pool.map(one, some) for m in found]
            settle(spark, moved)
            changed += sorted({m.table for m in moved})
    return changed


def load_arrivals(spark: SparkSession, *, num_bits: int = 512, parallelism: int = 4, chunk_size: int = 64,
                  schemas: list[str] | None = None, keys: DataFrame | None = None) -> list[str]:
    """Appends the rows of new landing files to the vault and, where the table is there, the anonymized layer.

    Views and tags stay as they are. Landing tables are taken as append-only: files that
    vanish or are written anew there don't take rows out again. Tables that fail stop no others;
    :class:`~veilspark.plans.pipelines.LoadError` names them. Returns the tables that changed.
    """
    shared_dir(spark)
    with ScratchScope(spark):
        tables = frozen(loaded_tables(spark, schemas), "loaded")
        recovered = recover(spark, tables, parallelism)
        files = arrived_files(spark, tables, chunk_size)
        changed = files.select(F.lit(LANDING).alias("catalog_name"), "schema_name", "table_name").distinct()
        plan_df = frozen(P.load_plan(changed, column_catalog(spark, changed, store.read(spark, "not_null")),
                                     store.read(spark, store.tags_of(LANDING)), store.read(spark, "key_registry")), "plan")
        keys_df = PL.unwrapped_keys(spark) if keys is None else keys
        PL._refuse(plan_df, LANDING, VAULT, schemas, hashes=True)
        of_table = W.partitionBy("schema_name", "table_name")
        batches = frozen(files.withColumn("n", F.floor((F.row_number().over(of_table.orderBy("path")) - 1) / MAX_FILES)), "batches")
        todo = {(r.schema_name, r.table_name): (r.anonymized, r.last) for r in tables.join(
            batches.groupBy("schema_name", "table_name").agg(F.max("n").alias("last")), ["schema_name", "table_name"]).toLocalIterator()}

        def one(tp: TablePlan) -> tuple[list[Moved], str | None]:
            moved = []
            mine = batches.where((F.col("schema_name") == tp.schema_name) & (F.col("table_name") == tp.table_name))
            anonymized, last = todo[tp.schema_name, tp.table_name]
            try:
                for n in range(last + 1):
                    batch = stage(spark, tp, mine.where(F.col("n") == n).select(*FILE_KEYS), anonymized, keys_df, num_bits)
                    moved.append(move(spark, tp.schema_name, tp.table_name, batch))
            except Exception as e:  # noqa: BLE001 - reported with all others at the end
                return moved, f"{type(e).__name__}: {str(e).splitlines()[0][:300] if str(e) else ''}"
            return moved, None

        done = list(recovered)
        failed: dict[str, str] = {}
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            for chunk in PL._chunks(iter_table_plans(plan_df), chunk_size):
                in_place = []
                for tp, (moved, why) in zip(chunk, pool.map(one, chunk), strict=True):
                    in_place += moved
                    if why is None:
                        done.append(tp.table_name)
                    else:
                        failed[f"{tp.schema_name}.{tp.table_name}"] = why
                settle(spark, in_place)
        if failed:
            raise PL.LoadError(done, failed)
        return list(dict.fromkeys(done))
