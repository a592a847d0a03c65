"""Catalog metadata as frames: tables, columns, tags.

Layers live in the session catalog as databases ``<layer>__<schema>``.
Listing tables and schemas is catalog metadata work on the driver (one
row per table or column, never per data row). Listings are always written
to the shared folder in batches and read back: one frame that does not
change while a load changes the catalog, and no estate sits whole in driver
memory. Everything downstream is DataFrame joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from veilspark.schemas import COLUMN_CATALOG, TABLE_CATALOG, database_name, split_database
from veilspark.session import scratch_path
from veilspark.sources.local import local_frame

BATCH_ROWS = 20_000  # rows of a listing that the driver holds at once
LOOKUPS = 8          # concurrent schema lookups


def snapshot(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType, name: str,
             batch_rows: int = BATCH_ROWS) -> DataFrame:
    """The rows as a parquet frame in the shared folder, written a batch at a time."""
    path, it = scratch_path(spark, name), iter(rows)
    batch = list(islice(it, batch_rows))
    local_frame(spark, batch, schema).write.parquet(path)  # there also without a row
    while batch := list(islice(it, batch_rows)):
        local_frame(spark, batch, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _layer_databases(spark: SparkSession, layers: Iterable[str] | None,
                     schemas: Iterable[str] | None = None) -> list[tuple[str, str, str]]:
    wanted = set(layers) if layers is not None else None
    names = set(schemas) if schemas is not None else None
    out = []
    for db in spark.catalog.listDatabases():
        parts = split_database(db.name)
        if parts and (wanted is None or parts[0] in wanted) and (names is None or parts[1] in names):
            out.append((db.name, parts[0], parts[1]))
    return sorted(out)


def table_catalog(spark: SparkSession, layers: Iterable[str] | None = None,
                  schemas: Iterable[str] | None = None, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``(catalog_name, schema_name, table_name, table_type)`` of the layers' databases."""
    def rows() -> Iterator[tuple]:
        for db, layer, schema in _layer_databases(spark, layers, schemas):
            for t in spark.catalog.listTables(db):
                if not t.isTemporary:
                    yield layer, schema, t.name, (t.tableType or "").upper()
    return snapshot(spark, rows(), TABLE_CATALOG, "table-catalog", batch_rows)


def _schema_rows(catalog: str, schema: str, table: str, struct) -> list[tuple]:
    return [
        (catalog, schema, table, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO", i + 1)
        for i, f in enumerate(struct.fields)
    ]


def column_catalog(spark: SparkSession, tables: DataFrame, not_null: DataFrame | None = None,
                   batch_rows: int = BATCH_ROWS) -> DataFrame:
    """One row per column of the given ``(catalog_name, schema_name, table_name)`` tables.

    Only their schemas are looked up, several at a time. Parquet tables
    report every column nullable; columns listed in ``not_null`` are NO.
    """
    def looked_up(r) -> list[tuple]:
        name = f"`{database_name(r.catalog_name, r.schema_name)}`.`{r.table_name}`"
        return _schema_rows(r.catalog_name, r.schema_name, r.table_name, spark.table(name).schema)

    def rows() -> Iterator[tuple]:
        listed = tables.select("catalog_name", "schema_name", "table_name").toLocalIterator()
        with ThreadPoolExecutor(max_workers=LOOKUPS) as pool:
            while some := list(islice(listed, 64 * LOOKUPS)):
                for found in pool.map(looked_up, some):
                    yield from found

    df = snapshot(spark, rows(), COLUMN_CATALOG, "column-catalog", batch_rows)
    if not_null is None:
        return df
    from pyspark.sql import functions as F

    keys = ["catalog_name", "schema_name", "table_name", "column_name"]
    marked = not_null.select(*keys, F.lit("NO").alias("_n")).distinct()
    return df.join(marked, keys, "left").select(
        *[F.coalesce("_n", "is_nullable").alias(c) if c == "is_nullable" else c for c in df.columns]
    )


def frames_column_catalog(spark: SparkSession, frames: Mapping[tuple[str, str, str], DataFrame]) -> DataFrame:
    """Column catalog of frames keyed by ``(catalog, schema, table)`` (reads schemas only)."""
    rows = []
    for (catalog, schema, table), df in sorted(frames.items()):
        rows += _schema_rows(catalog, schema, table, df.schema)
    return local_frame(spark, rows, COLUMN_CATALOG)
