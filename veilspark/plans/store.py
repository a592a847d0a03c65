"""Core tables of the engine in the session catalog (parquet).

* append-only: ``key_registry``, ``kek_versions``, ``group_members``,
  ``not_null``, ``loads``, ``loaded_files``, ``load_audits``, ``tag_folds``
* replaced as a whole: ``dsk_store``
* logs of changes: one per layer, the column tags (``column_tags__landing`` and
  so on; ``column_tags`` shows all layers).

A replaced table is a view on its current version, ``<name>__v<N>_<id>``.
The view is the only record of which version is current: ``read``, ``append``
and ``publish`` all ask it. A new version is written completely before the
view switches, so a crash at any step leaves the previous version in place;
what it left behind has a name of its own, blocks nothing and goes with the
next ``publish`` (parquet has no row update, and a table cannot be overwritten
while it is being read).

Tags are a view as well: on its version and on a log, of which the latest row
of each tag counts. A change writes its own rows only, as a batch in a folder
of its own, and enters the log as one partition, in one step; writers don't
wait for each other, nor does one undo another's change. ``compact_tags`` writes what
the view shows as the next version, with the batch that each tag stems from, so that a
batch counts the same whether it is read from the version, the log or both. So nothing is lost
that arrives meanwhile, and batches leave the log when no current reader needs them.
"""

from __future__ import annotations

import re
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark import schemas as S
from veilspark.sources.files import table_location
from veilspark.sources.local import local_frame
from veilspark.storage import Files

CORE = S.Layer.CORE.value
CORE_CONF = "veilspark.core.database"

APPEND_TABLES = {
    "key_registry": S.KEY_REGISTRY,
    "kek_versions": S.KEK_VERSIONS,
    "group_members": S.GROUP_MEMBERS,
    "not_null": S.NOT_NULL,
    "loads": S.LOADS,
    "loaded_files": S.LOADED_FILES,
    "load_audits": S.LOAD_AUDITS,
    "tag_folds": S.TAG_FOLDS,
}
TAGS = "column_tags"
TAG_LAYERS = (S.Layer.LANDING.value, S.Layer.VAULT.value, S.Layer.ANONYMIZED.value)
VERSIONED_TABLES = {"dsk_store": S.DSK_STORE}
TAG_KEYS = [f.name for f in S.COLUMN_TAGS.fields][:-1]
LOST_BATCH_SECONDS = 86400  # a folder that has been no batch for so long is a killed writer's


_APPENDING = threading.Lock()


class ConcurrentPublish(RuntimeError):
    """Another writer switched the table's version in the meantime."""


def core(spark: SparkSession) -> str:
    """The session's core database: ``core``, or the one that the setting ``CORE_CONF`` names."""
    return spark.conf.get(CORE_CONF, CORE)


def core_name(spark: SparkSession, name: str) -> str:
    return f"`{core(spark)}`.`{name}`"


def tags_of(layer: str) -> str:
    """The core table with the column tags of a layer."""
    return f"{TAGS}__{layer}"


def _log(spark: SparkSession, layer: str) -> str:
    """The log of a layer's tag changes, a partition a batch."""
    return core_name(spark, f"{tags_of(layer)}__log")


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Tables of this name's versions, published or not."""
    pattern = re.compile(rf"^{re.escape(name)}__v\d+_[0-9a-f]+$")
    return sorted(t.name for t in spark.catalog.listTables(core(spark)) if pattern.match(t.name))


def current(spark: SparkSession, name: str) -> str:
    """The table that the view ``name`` stands for."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {core_name(spark, name)}").where("col_name = 'View Text'").collect()
    found = re.search(rf"`({re.escape(name)}__v\d+_[0-9a-f]+)`", rows[0]["data_type"]) if rows else None
    if not found:
        raise RuntimeError(f"core table {name} has no current version; call ensure_core first")
    return found[1]


def _number(version: str) -> int:
    return int(re.search(r"__v(\d+)_[0-9a-f]+$", version)[1])


def _write_version(df: DataFrame, name: str, number: int) -> str:
    version = f"{name}__v{number}_{uuid.uuid4().hex[:12]}"
    df.write.format("parquet").saveAsTable(f"{core(df.sparkSession)}.{version}")
    return version


def _point_view(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {core_name(spark, name)} AS SELECT * FROM {core_name(spark, version)}")


def _tag_state(spark: SparkSession, layer: str, version: str) -> str:
    """The latest value of each tag, and the batch it came with."""
    keys = ", ".join(TAG_KEYS)
    rows = " UNION ALL ".join(f"SELECT {keys}, tag_value, batch FROM {x}" for x in (core_name(spark, version), _log(spark, layer)))
    return f"SELECT {keys}, max_by(struct(tag_value), batch).tag_value AS tag_value, max(batch) AS batch FROM ({rows}) GROUP BY {keys}"


def _point_tags(spark: SparkSession, layer: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {core_name(spark, tags_of(layer))} AS "
              f"SELECT {', '.join(TAG_KEYS)}, tag_value FROM ({_tag_state(spark, layer, version)})")


def ensure_core(spark: SparkSession, location: str | None = None) -> None:
    """Create the core database and its empty tables if absent (idempotent)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{core(spark)}`{loc}")
    for name, schema in APPEND_TABLES.items():
        if not spark.catalog.tableExists(f"{core(spark)}.{name}"):
            local_frame(spark, [], schema).write.format("parquet").saveAsTable(f"{core(spark)}.{name}")
    for name, schema in VERSIONED_TABLES.items():
        if not spark.catalog.tableExists(f"{core(spark)}.{name}"):
            _point_view(spark, name, _write_version(local_frame(spark, [], schema), name, 1))
    for layer in TAG_LAYERS:
        name = tags_of(layer)
        if not spark.catalog.tableExists(f"{core(spark)}.{name}"):
            fields = ", ".join(f"{k} STRING" for k in (*TAG_KEYS, "tag_value", "batch"))
            spark.sql(f"CREATE TABLE IF NOT EXISTS {_log(spark, layer)} ({fields}) USING parquet PARTITIONED BY (batch)")
            _point_tags(spark, layer, _write_version(local_frame(spark, [], S.TAG_ROWS), name, 1))
    if not spark.catalog.tableExists(f"{core(spark)}.{TAGS}"):
        union = " UNION ALL ".join(f"SELECT * FROM {core_name(spark, tags_of(x))}" for x in TAG_LAYERS)
        spark.sql(f"CREATE OR REPLACE VIEW {core_name(spark, TAGS)} AS {union}")


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(core_name(spark, name))


def append(df: DataFrame, name: str) -> None:
    """Append to an append-only table, to the current version of a versioned one, or to the log of a layer's tags."""
    spark = df.sparkSession
    if name in map(tags_of, TAG_LAYERS):
        append_tags(df, name.removeprefix(f"{TAGS}__"))
        return
    target = current(spark, name) if name in VERSIONED_TABLES else name
    cols = spark.table(core_name(spark, target)).columns
    with _APPENDING:  # two appends to a folder share its temporary files
        df.select(*cols).write.format("parquet").mode("append").insertInto(f"{core(spark)}.{target}")


def publish(df: DataFrame, name: str) -> int:
    """Write ``df`` as the next version of ``name`` and switch the view to it.

    Raises :class:`ConcurrentPublish` if the view moved while ``df`` was
    written. The version before stays (running readers may hold it); older
    and abandoned ones are dropped.
    """
    spark = df.sparkSession
    before = current(spark, name)
    version = _write_version(df.select(*[f.name for f in VERSIONED_TABLES[name].fields]), name, _number(before) + 1)
    if current(spark, name) != before:
        spark.sql(f"DROP TABLE IF EXISTS {core_name(spark, version)}")
        raise ConcurrentPublish(f"{name} is no longer at {before}")
    _point_view(spark, name, version)
    for old in _versions(spark, name):
        if old not in (before, version):
            spark.sql(f"DROP TABLE IF EXISTS {core_name(spark, old)}")
    return _number(version)


# --------------------------------------------------------------------------- tags

def tag_batches(spark: SparkSession, layer: str) -> list[str]:
    """Batches in the log of a layer's tags, oldest first."""
    return sorted(r[0].removeprefix("batch=") for r in spark.sql(f"SHOW PARTITIONS {_log(spark, layer)}").collect())


def append_tags(tags: DataFrame, layer: str) -> str:
    """The rows of ``tags`` become tags of ``layer``, in place of older values of the same column and name.

    Only these rows are written. Two values for one tag raise, and nothing enters the
    log. Batches are ordered by their names: by the clock, and after all that were seen.
    """
    spark = tags.sparkSession
    values = tags.groupBy(*TAG_KEYS).agg(F.collect_set(F.struct("tag_value")).alias("v"))
    conflict = F.raise_error(F.concat(F.lit("two values for the tag "), F.concat_ws(".", *TAG_KEYS)))
    rows = values.select(*TAG_KEYS, F.when(F.size("v") == 1, F.col("v")[0]["tag_value"]).otherwise(conflict).alias("tag_value"))
    last = max((int(b.split("-")[0]) for b in tag_batches(spark, layer)), default=0)
    batch = f"{max(time.time_ns(), last + 1):020d}-{uuid.uuid4().hex[:12]}"
    rows.write.parquet(f"{table_location(spark, _log(spark, layer))}/batch={batch}")
    spark.sql(f"ALTER TABLE {_log(spark, layer)} ADD PARTITION (batch = '{batch}')")
    return batch


def compact_tags(spark: SparkSession, layer: str) -> int:
    """What the layer's tags are now becomes their next version; returns its number.

    Batches that the version before has taken in leave the log: readers of that
    version, the oldest that is kept, find them there. Raises :class:`ConcurrentPublish`
    if another compaction came first; appended changes don't matter.
    """
    name = tags_of(layer)
    before, folded = current(spark, name), tag_batches(spark, layer)
    version = _write_version(spark.sql(_tag_state(spark, layer, before)), name, _number(before) + 1)
    if folded:
        append(local_frame(spark, [(version, b) for b in folded], S.TAG_FOLDS), "tag_folds")
    if current(spark, name) != before:
        spark.sql(f"DROP TABLE IF EXISTS {core_name(spark, version)}")
        raise ConcurrentPublish(f"{name} is no longer at {before}")
    _point_tags(spark, layer, version)
    for old in _versions(spark, name):
        if old not in (before, version):
            spark.sql(f"DROP TABLE IF EXISTS {core_name(spark, old)}")
    settled = {r.batch for r in read(spark, "tag_folds").where(F.col("version") == before).select("batch").collect()}
    gone = [b for b in folded[:-1] if b in settled]  # the newest stays: the next batch's name follows it
    if gone:
        spark.sql(f"ALTER TABLE {_log(spark, layer)} DROP IF EXISTS " + ", ".join(f"PARTITION (batch = '{b}')" for b in gone))
    _drop_lost_batches(spark, layer)
    return _number(version)


def _drop_lost_batches(spark: SparkSession, layer: str) -> None:
    """Folders that writers were killed over before they became batches."""
    files, root = Files(spark), table_location(spark, _log(spark, layer))
    for folder in sorted(set(files.names(root)) - {f"batch={b}" for b in tag_batches(spark, layer)}):
        if folder.startswith("batch=") and time.time() - files.modified(f"{root}/{folder}") > LOST_BATCH_SECONDS:
            files.delete(f"{root}/{folder}")
