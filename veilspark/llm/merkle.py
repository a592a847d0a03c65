"""Merkle manifest of a dataset, with persistent versions of its tree.

A leaf is the SHA-256 of a row's columns: each ``-`` if null, else the number of its UTF-8
bytes, ``:`` and the value. Rows are ordered by id within a group (here a language); every
``FAN`` consecutive nodes become the SHA-256 of their digests as lowercase hex text, level
by level, until a group has one node, its subroot. The subroots by group (null first,
then bytewise) become the root in the same way.

Leaves are dealt to ranges of (group, id); a leaf's position in its group is its place in
the range plus the leaves of the ranges before. Aligned blocks of ``FAN ** LEVELS`` leaves
are subtrees of their own, each built by one task whatever the group's size. Their roots
are the leaves of the next, smaller round, and so on; the group's subroots go through the
same rounds. Coming down again, a block learns its ``path``: the siblings of each level
above it up to the root.

A tree is never changed. A tampered leaf makes a version, which copies the ancestors of
the leaf within its block and shares all other nodes, by place; the upper part of the
version, in other blocks' tasks above, is continued from the block's path. Two versions
share all that lies beside both paths. ``versions`` lists the copied nodes.

Any column may be null. Rows without id come first in their group. Rows of equal id are
ordered by their digest, and equal rows are leaves of their own with equal digests; which
of them is which doesn't matter. Empty texts are ``0:``; very long ones are hashed in the
JVM and don't travel. A lone leaf is its group's subroot, a lone subroot the root, and a
proof without siblings is the hash of nothing. No rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import ascii_lower, pick, read, shuffle_partitions, written

FAN, LEVELS = 8, 4
BLOCK = FAN ** LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


# --- nodes ----------------------------------------------------------------

def parent(run: list[bytes]) -> bytes:
    return hashlib.sha256("".join([x.hex() for x in run]).encode()).digest()


class Step(NamedTuple):
    """One level of a path: a node's place in its run, and the others of the run."""

    place: int
    others: list[bytes]

    def up(self, node: bytes) -> bytes:
        return parent([*self.others[:self.place], node, *self.others[self.place:]])


def path_bytes(steps: list[Step]) -> bytes:
    return b"".join([bytes([s.place, len(s.others)]) + b"".join(s.others) for s in steps])


def path_steps(data: bytes) -> list[Step]:
    steps, at = [], 0
    while at < len(data):
        place, n = data[at], data[at + 1]
        steps.append(Step(place, [data[i:i + 32] for i in range(at + 2, at + 2 + 32 * n, 32)]))
        at += 2 + 32 * n
    return steps


class Subtree:
    """The levels over a block's nodes; read-only, versions stand beside it."""

    def __init__(self, nodes: list[bytes], height: int):
        self.levels = [nodes]
        for _ in range(height):
            low = self.levels[-1]
            self.levels.append([parent(low[i:i + FAN]) for i in range(0, len(low), FAN)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, i: int) -> list[Step]:
        steps = []
        for level in self.levels[:-1]:
            run = i // FAN * FAN
            steps.append(Step(i - run, level[run:i] + level[i + 1:run + FAN]))
            i //= FAN
        return steps

    def version(self, i: int, node: bytes) -> list[bytes]:
        """The copied nodes of the version with another node at i: one a level, up to its root."""
        copied = [node]
        for step in self.path(i):
            copied.append(step.up(copied[-1]))
        return copied


# --- positions and rounds -------------------------------------------------

def positioned(nodes: DataFrame, by: tuple[str, ...], name: str) -> DataFrame:
    """``pos`` (from 0, within ``grp``) and ``n`` (nodes of the group) in the order of ``by``, and equal rows dealt to several ranges."""
    order = ["grp", *by]
    ranged = nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(
        shuffle_partitions(nodes.sparkSession), *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    ranged = written(ranged.withColumn("_row", F.monotonically_increasing_id()), name)  # partition, then row, in 33 bits
    part = F.shiftright("_row", 33)
    counts = ranged.groupBy("grp", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    whole = W.partitionBy("grp")
    before = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = written(counts.select(F.col("grp").alias("_grp"), F.col("_part").alias("_p"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
                                   F.sum("_n").over(whole).alias("n")), f"{name}-counts")  # a row for each group and range
    joined = ranged.withColumn("_part", part).join(counts, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn("pos", F.col("_row") + F.col("_base")).drop("_row", "_part", "_p", "_grp", "_base")


def height_of(n: int) -> int:
    """Levels above n nodes."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (grp, block, pos, n, node, ...) by block and pos -> a row a block with its nodes in a list, and its root."""
    held: list[dict] = []

    def row() -> dict:
        nodes = [r["node"] for r in held]
        tree = Subtree(nodes, min(LEVELS, height_of(held[0]["n"])))
        return {"grp": held[0]["grp"], "block": held[0]["block"], "n": held[0]["n"], "root": tree.root, "nodes": b"".join(nodes),
                "others": [r["other"] for r in held], "ids": [r["id"] for r in held]}

    done: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if held and (r["grp"], r["block"]) != (held[0]["grp"], held[0]["block"]):
                done.append(row())
                held = []
            held.append(r)
        if done:
            yield pa.RecordBatch.from_pylist(done, BLOCK_SCHEMA)
            done = []
    if held:
        yield pa.RecordBatch.from_pylist([row()], BLOCK_SCHEMA)


BLOCKS = "grp string, block long, n long, root binary, nodes binary, others array<binary>, ids array<long>"
BLOCK_SCHEMA = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("root", pa.binary()), ("nodes", pa.binary()),
                          ("others", pa.list_(pa.binary())), ("ids", pa.list_(pa.int64()))])


def blocks_of(nodes: DataFrame, name: str) -> DataFrame:
    """(grp, pos, n, node, other, id) -> aligned blocks."""
    frame = nodes.select("grp", F.expr(f"pos div {BLOCK}").alias("block"), "pos", "n", "node", "other", "id")
    dealt = frame.repartition(shuffle_partitions(nodes.sparkSession), "grp", "block").sortWithinPartitions("grp", "block", "pos")
    return written(dealt.mapInArrow(_blocks, BLOCKS), name)


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their path -> their nodes with theirs."""
    for batch in batches:
        for r in batch.to_pylist():
            nodes = [r["nodes"][i:i + 32] for i in range(0, len(r["nodes"]), 32)]
            tree = Subtree(nodes, min(LEVELS, height_of(r["n"])))
            first = r["block"] * BLOCK
            yield pa.RecordBatch.from_pydict({
                "grp": pa.array([r["grp"]] * len(nodes), pa.string()), "pos": pa.array(range(first, first + len(nodes)), pa.int64()),
                "path": pa.array([path_bytes(tree.path(i)) + r["path"] for i in range(len(nodes))], pa.binary())})


def paths_above(blocks: DataFrame, top, name: str) -> DataFrame:
    """(grp, block, path): for each block the siblings on the way from its root to the
    whole tree's. ``top``: (grp, path, n = 1) of whole groups' roots, or a function of them."""
    most = blocks.agg(F.max("n").alias("n")).first()["n"] or 0
    roots = blocks.select("grp", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK} - 1) div {BLOCK}").alias("n"), F.col("root").alias("node"),
                          F.lit(None).cast("binary").alias("other"), F.lit(None).cast("long").alias("id"))
    if most <= BLOCK:  # a block is its group
        above = top(roots.select("grp", "node")).withColumn("pos", F.lit(0).cast("long"))
    else:
        upper = blocks_of(roots, f"{name}-upper")
        paths = paths_above(upper, top, f"{name}-upper")
        joined = upper.join(paths.select(F.col("grp").alias("_g"), F.col("block").alias("_b"), "path"),
                            F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")
        above = joined.select("grp", "block", "n", "nodes", "path").mapInArrow(_down, "grp string, pos long, path binary")
    return written(above.select("grp", F.col("pos").alias("block"), "path"), f"{name}-paths")


# --- the manifest ---------------------------------------------------------

class Manifest(NamedTuple):
    """A row a block: its leaves (``nodes``), tampered leaves (``others``, null where there is none), ``ids`` and ``root``;
    paths: (grp, block, path), with the path from the block's root to the whole root."""

    blocks: DataFrame
    paths: DataFrame
    root: bytes | None


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def build(leaves: DataFrame) -> Manifest:
    """``leaves``: (grp string, id long, node binary, other binary)."""
    digests = written(leaves, "digests")  # texts are hashed once, not also to find the ranges
    blocks = blocks_of(positioned(digests, ("id", "node"), "leaves"), "blocks")
    found: list[bytes] = []

    def top(subroots: DataFrame) -> DataFrame:
        nodes = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
        nodes = written(positioned(nodes, ("name",), "subroots"), "subroots-pos")
        upper = blocks_of(nodes.select("grp", "pos", "n", "node", F.lit(None).cast("binary").alias("other"), F.lit(None).cast("long").alias("id")), "top")

        def root(whole: DataFrame) -> DataFrame:
            found.extend(bytes(r["node"]) for r in whole.select("node").collect())  # the root
            return whole.select("grp", F.lit("").cast("binary").alias("path"))

        paths = paths_above(upper, root, "top")
        joined = upper.join(paths.select("block", "path"), "block").select("grp", "block", "n", "nodes", "path")
        down = joined.mapInArrow(_down, "grp string, pos long, path binary").select("pos", "path")
        return nodes.join(down, "pos").select(F.col("name").alias("grp"), "path")

    if blocks.isEmpty():
        none = blocks.sparkSession.createDataFrame([], "grp string, block long, path binary")
        return Manifest(blocks, none, None)
    paths = paths_above(blocks, top, "blocks")
    return Manifest(blocks, paths, found[0])


def _with_paths(manifest: Manifest) -> DataFrame:
    p = manifest.paths.select(F.col("grp").alias("_g"), F.col("block").alias("_b"), "path")
    return manifest.blocks.join(p, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).select(
        "grp", "block", "n", "nodes", "others", "ids", "path")


PROOFS = "grp string, id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(root: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                nodes = [r["nodes"][i:i + 32] for i in range(0, len(r["nodes"]), 32)]
                height = height_of(r["n"])
                tree, above = Subtree(nodes, min(LEVELS, height)), path_steps(r["path"])
                subroot = tree.root
                for step in above[:height - (len(tree.levels) - 1)]:
                    subroot = step.up(subroot)
                tail = "".join(x.hex() for s in above for x in s.others)
                upper = {}  # roots of the block's versions -> of the whole tree's

                def whole(block_root, upper=upper, above=above):
                    if block_root not in upper:
                        node = block_root
                        for step in above:
                            node = step.up(node)
                        upper[block_root] = node
                    return upper[block_root]

                proofs, folded = [], []
                for i, (node, other) in enumerate(zip(nodes, r["others"], strict=True)):
                    steps = tree.path(i)
                    proofs.append(hashlib.sha256(("".join([x.hex() for s in steps for x in s.others]) + tail).encode()).hexdigest())
                    folded.append(whole(tree.version(i, node if other is None else other)[-1]))
                n = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["grp"]] * n, pa.string()), pa.array(r["ids"], pa.int64()), pa.array([x.hex() for x in nodes]), pa.array([subroot.hex()] * n),
                     pa.array([root.hex()] * n), pa.array(proofs), pa.array([x.hex() for x in folded]), pa.array([x == root for x in folded])],
                    [x.split()[0] for x in PROOFS.split(", ")])
    return run


def proofs(manifest: Manifest) -> DataFrame:
    """A row a leaf: its digest, subroot and root of the tree, the digest of its proof, and the root folded from the
    tampered leaf, if there is one, else from the leaf."""
    if manifest.root is None:
        return manifest.blocks.sparkSession.createDataFrame([], PROOFS)
    return _with_paths(manifest).mapInArrow(_proofs(manifest.root), PROOFS)


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            nodes = [r["nodes"][i:i + 32] for i in range(0, len(r["nodes"]), 32)]
            tree, above = Subtree(nodes, min(LEVELS, height_of(r["n"]))), path_steps(r["path"])
            out = []
            for i, (node, other) in enumerate(zip(nodes, r["others"], strict=True)):
                if other is None or other == node:
                    continue
                copied = tree.version(i, other)
                for step in above:
                    copied.append(step.up(copied[-1]))
                out += [(r["grp"], r["block"] * BLOCK + i, r["ids"][i], level, x.hex()) for level, x in enumerate(copied)]
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()], strict=True)],
                                             ["grp", "version", "id", "level", "node"])


def versions(manifest: Manifest) -> DataFrame:
    """(grp, version, id, level, node): what the version of each tampered leaf copies, from the leaf (level 0) to its root.
    ``version`` is the leaf's position in its group; on a group's level l its node stands at version div 8^l. All other nodes are shared."""
    return _with_paths(manifest).mapInArrow(_versions, "grp string, version long, id long, level int, node string")


def manifest(docs: DataFrame, tampered: Column, changed: dict[str, Column], group_col: str = "lang", id_col: str = "doc_id",
             columns: tuple[str, ...] = COLUMNS) -> Manifest:
    """The manifest of ``columns``. Where ``tampered`` holds, a version with the values of ``changed`` stands beside it.
    Both may use the names of ``columns``."""
    kinds = {"doc_id": "long", "n_chars": "long"}
    frame = pick(docs, **{c: f"{c} {kinds.get(c, 'string')}" for c in dict.fromkeys((*columns, group_col, id_col))})
    other = F.when(tampered, leaf([changed.get(c, F.col(c)) for c in columns]))
    return build(frame.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), leaf([F.col(c) for c in columns]).alias("node"), other.alias("other")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    m = manifest(read(spark, sf_dir, "documents"), tampered, {"text": ascii_lower(F.col("text"))})
    return proofs(m).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP13_SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, lang, concat(CASE WHEN doc_id::VARCHAR IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR END,
             CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
             CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
             CASE WHEN n_chars::VARCHAR IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR END) AS head, text,
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
l AS (SELECT doc_id, lang, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
             sha256(head || CASE WHEN low IS NULL THEN '-' ELSE strlen(low) || ':' || low END) AS other,
             xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                 lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
                 lambda b, z: xor(b >> 1, CASE WHEN b & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)))) % 3 = 0 AS tampered FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (SELECT lang, 0 AS lvl, pos, leaf AS h, n FROM p
      UNION ALL
      SELECT lang, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 8, n),
s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, pos, subroot AS h, n FROM s
      UNION ALL
      SELECT lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM u WHERE n > 1 GROUP BY lvl, pos // 8, n),
r AS (SELECT h AS root FROM u WHERE n = 1),
i AS (SELECT p.doc_id, p.leaf, p.pos AS leaf_pos, p.lang, s.subroot, s.pos AS top, CASE WHEN p.tampered THEN p.other ELSE p.leaf END AS now FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang),
f1 AS (SELECT lang, leaf_pos, 0 AS lvl, leaf_pos AS pos, now AS cur, '' AS proof FROM i
       UNION ALL
       SELECT f1.lang, f1.leaf_pos, f1.lvl + 1, f1.pos // 8, sha256(string_agg(CASE WHEN t.pos = f1.pos THEN cur ELSE t.h END, '' ORDER BY t.pos)),
              proof || coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos <> f1.pos), '')
       FROM f1 JOIN t ON f1.lang IS NOT DISTINCT FROM t.lang AND f1.lvl = t.lvl AND f1.pos // 8 = t.pos // 8 AND t.n > 1
       GROUP BY f1.lang, f1.leaf_pos, f1.lvl, f1.pos, cur, proof),
g1 AS (SELECT lang, leaf_pos, max_by(cur, lvl) AS cur, max_by(proof, lvl) AS proof FROM f1 GROUP BY lang, leaf_pos),
f2 AS (SELECT i.lang, i.leaf_pos, 0 AS lvl, i.top AS pos, g1.cur, g1.proof FROM i JOIN g1 ON i.lang IS NOT DISTINCT FROM g1.lang AND i.leaf_pos = g1.leaf_pos
       UNION ALL
       SELECT f2.lang, f2.leaf_pos, f2.lvl + 1, f2.pos // 8, sha256(string_agg(CASE WHEN u.pos = f2.pos THEN cur ELSE u.h END, '' ORDER BY u.pos)),
              proof || coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos <> f2.pos), '')
       FROM f2 JOIN u ON f2.lvl = u.lvl AND f2.pos // 8 = u.pos // 8 AND u.n > 1
       GROUP BY f2.lang, f2.leaf_pos, f2.lvl, f2.pos, cur, proof),
g2 AS (SELECT lang, leaf_pos, max_by(cur, lvl) AS cur, max_by(proof, lvl) AS proof FROM f2 GROUP BY lang, leaf_pos)
SELECT i.doc_id, i.leaf, i.subroot, r.root, sha256(g2.proof) AS proof_sha256, g2.cur AS folded_root, g2.cur = r.root AS verified
FROM i JOIN g2 ON i.lang IS NOT DISTINCT FROM g2.lang AND i.leaf_pos = g2.leaf_pos, r
"""
