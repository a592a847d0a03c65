"""Line dedup: sharded cuckoo filters backed by exact reference counts.

The index has two tables, both sharded by the line's key:

* ``counts`` (key, n_docs): in how many documents each key is found, exactly;
* ``filters`` (shard, cells): per shard a cuckoo filter of the keys that are
  found in at least ``min_docs`` documents.

Inserting documents adds to the counts, deleting them subtracts; keys that cross
the threshold are put into, or taken out of, their shard's filter. So a deletion
undoes an insertion: counts and filter members are again what they were.
Cleaning probes the filters with the distinct keys of the documents at hand; what
passes is checked against the exact counts, so false positives drop no line.

A key is the line without ``[\\x20\\x09-\\x0D]`` at either end and with A-Z in
lower case, held as its 128-bit BLAKE2b digest. Empty keys are never counted.

Skew: keys are counted with map-side combining, shards hold distinct keys only,
and the join of a document's lines with the dropped keys is one that adaptive
execution can split, so a line that every third document holds meets in no task.

The groups that a task holds whole, a bucket's documents or a shard's keys, keep their size when the
input grows: their number follows the bytes of the texts. A text is held whole, however long.

Null text counts as empty text, and an empty text is one empty line. Every input
row is a document of its own, repeated rows too; null ids are kept.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.common import GROUP_BYTES, ROW, WHITE, groups, packed, pick, read, shuffle_partitions, text_groups, unpacked, written

SLOTS, MAX_KICKS, MIN_BUCKETS = 4, 500, 16
SHARD_KEYS = 4 << 20  # lines of a shard
_WHITE = WHITE.encode()
LINES = "bucket int, key binary, n long"


# --- the filter -----------------------------------------------------------

class CuckooFilter:
    """16-bit fingerprints in buckets of four; keys are 16-byte digests.

    ``add`` says False when the filter is full; the caller rebuilds a larger one
    from the exact table. Equal keys must be added once.
    """

    def __init__(self, cells: np.ndarray):
        self.cells = cells  # buckets x SLOTS, 0: free
        self.mask = len(cells) - 1
        self.victim = 0

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        buckets = MIN_BUCKETS
        while buckets * SLOTS * 0.85 < n:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, "<u2").reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.cells.astype("<u2").tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """keys: n x 2 uint64 -> fingerprints, first and second buckets."""
        fp = (keys[:, 0] >> np.uint64(48)).astype(np.uint16)
        fp[fp == 0] = 1
        first = (keys[:, 1] & np.uint64(self.mask)).astype(np.int64)
        return fp, first, self._other(first, fp)

    def _other(self, bucket, fp):
        mixed = (np.asarray(fp, np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(3)
        return np.asarray(bucket) ^ (mixed & np.uint64(self.mask)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        fp, a, b = self._places(keys)
        return (self.cells[a] == fp[:, None]).any(1) | (self.cells[b] == fp[:, None]).any(1)

    def add(self, key: np.ndarray) -> bool:
        fp, a, b = (x[0] for x in self._places(key.reshape(1, 2)))
        for at in (a, b):
            free = np.flatnonzero(self.cells[at] == 0)
            if len(free):
                self.cells[at, free[0]] = fp
                return True
        at = int(b)
        for _ in range(MAX_KICKS):
            self.victim = (self.victim + 1) % SLOTS
            fp, self.cells[at, self.victim] = self.cells[at, self.victim], fp
            at = int(self._other(at, fp))
            free = np.flatnonzero(self.cells[at] == 0)
            if len(free):
                self.cells[at, free[0]] = fp
                return True
        return False

    def remove(self, key: np.ndarray) -> bool:
        fp, a, b = (x[0] for x in self._places(key.reshape(1, 2)))
        for at in (a, b):
            held = np.flatnonzero(self.cells[at] == fp)
            if len(held):
                self.cells[at, held[0]] = 0
                return True
        return False


def _words(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


# --- keys of lines --------------------------------------------------------

def line_key(line: bytes) -> bytes | None:
    """Digest of the stripped, lower-cased line; None if nothing is left."""
    line = line.strip(_WHITE).lower()
    return hashlib.blake2b(line, digest_size=16).digest() if line else None


def _keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for bucket, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for key in {line_key(x) for x in (text or b"").split(b"\n")}:
                if key:
                    found[bucket, key] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in found], pa.int32()), pa.array([k for _, k in found], pa.binary()),
             pa.array(list(found.values()), pa.int64())], ["bucket", "key", "n"])


def _bucket(n: int, *cols: str):
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def line_table(docs: DataFrame, n_buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, key, n): the keys in each bucket of documents and how many of its documents hold each."""
    frame = pick(docs, doc_id=f"{id_col} string", text=f"{text_col} string")
    return frame.select(_bucket(n_buckets, "doc_id", "text").alias("bucket"),
                        F.col("text").cast("binary").alias("text")).mapInArrow(_keys_of, LINES)


# --- the index ------------------------------------------------------------

class LineIndex(NamedTuple):
    counts: DataFrame  # key binary, n_docs long
    filters: DataFrame  # shard int, cells binary
    min_docs: int
    n_shards: int


def empty_index(spark: SparkSession, min_docs: int = 10, n_shards: int | None = None) -> LineIndex:
    return LineIndex(spark.range(0).selectExpr("cast(null as binary) key", "id n_docs"),
                     spark.range(0).selectExpr("cast(id as int) shard", "cast(null as binary) cells"),
                     min_docs, n_shards or 4 * shuffle_partitions(spark))


def _changed(key, cells: pa.Table, rows: pa.Table) -> pa.Table:
    """One shard's filter after the keys that came in (+1) or went out (-1); 0: members that stay."""
    held = cells.column("cells").to_pylist()
    change = np.asarray(rows.column("change").to_pylist(), np.int64)
    words = _words(rows.column("key").to_pylist())
    members = int((change >= 0).sum())
    f = CuckooFilter.from_bytes(held[0]) if held else CuckooFilter.sized(members)
    for k in words[change < 0]:
        f.remove(k)
    size = members
    while not all(f.add(k) for k in words[change > 0]):  # full: anew, larger, from the exact rows
        size, f, change = max(2 * size, 64), CuckooFilter.sized(2 * size), (change >= 0).astype(np.int64)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([f.to_bytes()], pa.binary())})


def _shard(index: LineIndex):
    return F.pmod(F.xxhash64("key"), F.lit(index.n_shards)).cast("int")


def _update(index: LineIndex, lines: DataFrame, sign: int) -> LineIndex:
    delta = lines.groupBy("key").agg((F.sum("n") * sign).alias("d"))
    both = index.counts.join(delta, "key", "full_outer").select(
        "key", F.coalesce("n_docs", F.lit(0)).alias("old"),
        F.greatest(F.coalesce("n_docs", F.lit(0)) + F.coalesce("d", F.lit(0)), F.lit(0)).alias("new"))
    both = written(both, "line-counts")
    was, now = F.col("old") >= index.min_docs, F.col("new") >= index.min_docs
    rows = both.filter(was | now).select(
        _shard(index).alias("shard"), "key",
        F.when(was & now, 0).when(now, 1).otherwise(-1).alias("change"))
    filters = index.filters.groupBy("shard").cogroup(rows.groupBy("shard")).applyInArrow(
        _changed, "shard int, cells binary")
    return index._replace(counts=both.filter("new > 0").select("key", F.col("new").alias("n_docs")),
                          filters=written(filters, "line-filters"))


def insert(index: LineIndex, lines: DataFrame) -> LineIndex:
    """``lines``: the ``line_table`` of the new documents."""
    return _update(index, lines, 1)


def delete(index: LineIndex, lines: DataFrame) -> LineIndex:
    """Takes documents out again; they must have been inserted."""
    return _update(index, lines, -1)


def _probe(key, cells: pa.Table, rows: pa.Table) -> pa.Table:
    held = cells.column("cells").to_pylist()
    if not held or not rows.num_rows:
        return rows.select(["key"]).slice(0, 0)
    keys = rows.column("key").to_pylist()
    hit = CuckooFilter.from_bytes(held[0]).contains(_words(keys))
    return pa.table({"key": pa.array([keys[i] for i in np.flatnonzero(hit)], pa.binary())})


def dropped_keys(index: LineIndex, lines: DataFrame) -> DataFrame:
    """The keys of these lines that at least ``min_docs`` indexed documents hold: filter first, then the counts."""
    keys = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select(_shard(index).alias("shard"), "key")
    passed = index.filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInArrow(_probe, "key binary")
    return passed.join(index.counts.filter(F.col("n_docs") >= index.min_docs), "key", "left_semi")


# --- cleaning -------------------------------------------------------------

def _cleaned(docs: pa.Table, drops: pa.Table) -> pa.Table:
    drop = set(drops.column("key").to_pylist())
    lines, gone, kept = [], [], []
    for text in docs.column("text").to_pylist():
        own = (text or b"").split(b"\n")
        left = [x for x in own if line_key(x) not in drop] if drop else own
        lines.append(len(own))
        gone.append(len(own) - len(left))
        kept.append(b"\n".join(left))
    return (docs.drop_columns(["text", "bucket"])
            .append_column("n_lines", pa.array(lines, pa.int64()))
            .append_column("n_dropped", pa.array(gone, pa.int64()))
            .append_column("kept", pa.array(kept, pa.binary())))


def clean(index: LineIndex, docs: DataFrame, lines: DataFrame, n_buckets: int,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that the index drops: (_row, n_lines, n_dropped, kept binary);
    ``_row`` has the input's columns but the text, see ``common.unpacked``.

    ``lines`` is ``line_table(docs, n_buckets)``.
    """
    drops = lines.select("bucket", "key").join(dropped_keys(index, lines), "key", "left_semi")
    frame = packed(docs, without=(text_col,), doc_id=f"{id_col} string", text=f"{text_col} string")
    frame = frame.select(ROW, _bucket(n_buckets, "doc_id", "text").alias("bucket"),
                         F.col("text").cast("binary").alias("text"))
    kind = frame.schema[ROW].dataType.simpleString()
    return frame.groupBy("bucket").cogroup(drops.groupBy("bucket")).applyInArrow(
        _cleaned, f"{ROW} {kind}, n_lines long, n_dropped long, kept binary")


def dedup_lines(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text",
                group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Indexes all documents, then cleans them: see ``clean`` for the result. The number of buckets of documents
    follows the bytes of all texts, that of shards the number of lines."""
    spark = docs.sparkSession
    n_buckets = text_groups(docs, text_col, group_bytes)
    lines = written(line_table(docs, n_buckets, id_col, text_col), "lines")
    n_shards = groups(lines.count(), SHARD_KEYS, 4 * shuffle_partitions(spark))
    index = insert(empty_index(spark, min_docs, n_shards), lines)
    return clean(index, docs, lines, n_buckets, id_col, text_col)


def dedup_lines_stage(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """The documents with the dropped lines gone from ``text``; ``n_chars``, if there, follows the new text."""
    out = dedup_lines(docs, min_docs)
    text = F.col("kept").cast("string")
    new = {"text": text, "n_chars": F.char_length(text)}
    return unpacked(out, docs, **{k: v for k, v in new.items() if k in docs.columns})


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(read(spark, sf_dir, "documents"), doc_id="doc_id long", text="text string")
    return dedup_lines(docs).select(
        F.col(f"{ROW}._c0").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH l AS (SELECT doc_id, u.i, string_split(coalesce(text, ''), chr(10))[u.i] AS line
           FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS u(i)),
     k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     d AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM d)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (key NOT IN (SELECT key FROM d)), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""
