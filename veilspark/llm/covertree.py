"""Exact cosine pairs over a threshold, by dual traversal of cover trees.

Within a label, unit vectors with cosine >= c are at most t = sqrt(2 - 2c) apart.
Every label has one tree, of nested levels:

* cells: a cell of more than ``BLOCK`` vectors (at first, the label) is split by at most
  ``MAX_CELLS`` centres, a bounded sample of its vectors by hash; each vector goes to the nearest. Level
  by level, until a cell holds a block; cells that no longer shrink, neither in vectors nor
  in radius, are cut into blocks by hash;
* in a block, a cover tree: a node's children are centres of half its radius that
  cover it (its own centre is the first), down to single vectors; each node
  has the covering radius that its members really need.

Pairs of nodes go down together. A pair whose centres are farther apart than both
covering radii and t is pruned, whole: at every level of cells and at blocks (by joins), then inside
a pair of blocks, where a task has the two trees. There, pairs of nodes with few vectors, and
those whose children can't be told apart any more, end in one product of all their vectors. What is left are
pairs of vectors, decided by their cosine in double precision.

Equal vectors of a label are one class from the start. From a pair of blocks come the
number of links of each class and a spanning forest of the links, never all pairs.
The components follow from the forests.

Vectors that are null, zero, empty, or hold null or non-finite components, and those
without a label, link with nothing; nor do vectors of different dimension. Every input
row is a vector of its own, repeated rows too.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import pick, read, written
from veilspark.llm.components import components
from veilspark.llm.vafile import finite

THRESHOLD = 0.93
BLOCK, MAX_CELLS, GROUP = 1024, 64, 8192
EPS = 1e-6  # room for rounding in the bounds
SHRUNK = 0.9  # a cell has shrunk if it has so much of its parent's vectors or of its radius, or less
DENSE, SMALL, LARGE = 1 << 14, 1 << 8, 1 << 22  # products of two nodes' numbers of vectors: see traverse
PAIRS = 1 << 16  # pairs of vectors looked at together
FLAT = 1e-7  # vectors as near as this can't be told apart by distances: a node's members are its children


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, float).reshape(len(rows), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)  # neither overflow nor underflow in the norm
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


# --- the tree of a block --------------------------------------------------

class Tree:
    """Nodes as arrays: centre (a row of x), covering radius, children first..last; a
    node without children is its centre alone. Node 0 is the root. A node's vectors are
    the rows order[low:high]."""

    def __init__(self, x: np.ndarray, nodes: np.ndarray | None = None):
        self.x, self.unit = x, _unit(x)
        if nodes is None:
            nodes = self._build()
        self.centre, self.first, self.last, self.low, self.high = (nodes[:, i].astype(int) for i in (0, 2, 3, 4, 5))
        self.radius, self.leaf = nodes[:, 1], self.last == 0
        self.order = np.empty(len(x), int)
        self.order[self.low[self.leaf]] = self.centre[self.leaf]

    def _build(self) -> np.ndarray:
        start = int(_distance(self.unit, self.unit.mean(0, keepdims=True))[:, 0].argmin())
        d = _distance(self.unit, self.unit[start:start + 1])[:, 0]
        nodes, members = [[start, float(d.max()), 0, 0, 0, len(self.x)]], [np.arange(len(self.x))]
        at = 0
        while at < len(nodes):
            own, (centre, radius) = members[at], nodes[at][:2]
            members[at] = None
            if len(own) > 1:
                nodes[at][2], low = len(nodes), nodes[at][4]
                for c, r, group in self._net(own, centre, radius / 2):
                    nodes.append([c, r, 0, 0, low, low + len(group)])
                    members.append(group)
                    low += len(group)
                nodes[at][3] = len(nodes)
            at += 1
        return np.array(nodes, float)

    def _net(self, own: np.ndarray, centre: int, radius: float):
        """Centres, the node's own first, each next the farthest from all before, until ``radius`` covers all."""
        u = self.unit[own]
        d = _distance(u, self.unit[centre:centre + 1])[:, 0]
        d[own == centre] = -1  # never the farthest, also where proportional vectors are all at distance 0
        if d.max() <= FLAT:
            yield from ((int(c), 0.0, own[i:i + 1]) for i, c in enumerate(own))
            return
        nearest, centres = np.zeros(len(own), int), [centre]
        while (far := int(d.argmax())) is not None and (d[far] > radius or len(centres) < 2):
            new = _distance(u, u[far:far + 1])[:, 0]
            new[far] = 0
            closer = new < d
            closer[far], closer[own == centre] = True, False
            d[closer], nearest[closer] = new[closer], len(centres)
            centres.append(int(own[far]))
        for i, c in enumerate(centres):
            group = own[nearest == i]
            yield c, float(d[nearest == i].max()) if len(group) > 1 else 0.0, group

    def children(self, node: int) -> np.ndarray:
        return np.arange(self.first[node], self.last[node]) if self.last[node] else np.array([node])

    def nodes(self) -> np.ndarray:
        return np.column_stack([self.centre, self.radius, self.first, self.last, self.low, self.high])

    def vectors(self, node: int) -> np.ndarray:
        return self.order[self.low[node]:self.high[node]]


def _exact(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Row by row: is the cosine ``least`` or more? Close to it, sums are exact before they are rounded."""
    unit_a, unit_b = _unit(a), _unit(b)
    cosine = (unit_a * unit_b).sum(1)
    good = cosine >= least
    for i in np.flatnonzero(np.abs(cosine - least) < 1e-12):
        dot, aa, bb = (math.fsum(x * y for x, y in zip(p, q, strict=True)) for p, q in ((a[i], b[i]), (a[i], a[i]), (b[i], b[i])))
        good[i] = dot / (math.sqrt(aa) * math.sqrt(bb)) >= least
    return good


def _products(a: Tree, b: Tree, p: np.ndarray, q: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of vectors (rows of a, of b) of the node pairs p, q, some ``PAIRS`` at a time; of a node with itself each once."""
    wide, deep = a.high[p] - a.low[p], b.high[q] - b.low[q]
    cut = np.searchsorted(np.cumsum(wide * deep), np.arange(PAIRS, (wide * deep).sum() + PAIRS, PAIRS))
    for k in np.split(np.arange(len(p)), np.unique(cut)):
        n = wide[k] * deep[k]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x, y = np.divmod(at, np.repeat(deep[k], n))
        keep = ~np.repeat(p[k] == q[k], n) | (x < y) if same else slice(None)
        yield a.order[(np.repeat(a.low[p[k]], n) + x)[keep]], b.order[(np.repeat(b.low[q[k]], n) + y)[keep]]


def traverse(a: Tree, b: Tree, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose cosine is ``least`` or more; ``same``: one tree, each pair once.

    A pair of nodes is looked at by one product of its children's centres. What isn't pruned goes down;
    where that is most of it, or for ``DENSE`` pairs of vectors and less, the nodes' vectors are
    multiplied at once. Very small pairs (below ``SMALL``) are gathered and looked at together.
    """
    t = math.sqrt(2 - 2 * least) + EPS
    found, stack = [], [(0, 0)]

    def dense(p: int, q: int) -> None:
        one, two = a.vectors(p), b.vectors(q)
        x, y = np.nonzero(_distance(a.unit[one], b.unit[two]) <= t)
        if same and p == q:
            x, y = x[x < y], y[x < y]
        found.append((one[x], two[y]))

    while stack:
        p, q = stack.pop()
        size = (a.high[p] - a.low[p]) * (b.high[q] - b.low[q])
        if size <= DENSE:
            dense(p, q)
            continue
        one, two = a.children(p), b.children(q)
        near = _distance(a.unit[a.centre[one]], b.unit[b.centre[two]]) <= a.radius[one][:, None] + b.radius[two][None, :] + t
        if size <= LARGE and 2 * near.sum() > near.size:
            dense(p, q)
            continue
        i, j = np.nonzero(near)
        i, j = one[i], two[j]
        if same and p == q:
            i, j = i[i <= j], j[i <= j]
        few = (a.high[i] - a.low[i]) * (b.high[j] - b.low[j]) <= SMALL
        stack += zip(i[~few].tolist(), j[~few].tolist(), strict=True)
        for x, y in _products(a, b, i[few], j[few], same):
            close = np.einsum("ij,ij->i", a.unit[x], b.unit[y]) >= 1 - t * t / 2 - EPS
            found.append((x[close], y[close]))
    out = []
    for i, j in found:
        for k in range(0, len(i), PAIRS):
            x, y = i[k:k + PAIRS], j[k:k + PAIRS]
            good = _exact(a.x[x], b.x[y], least)
            out.append((x[good], y[good]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int))


# --- tasks ----------------------------------------------------------------

def _cells(key, rows: pa.Table, centres: pa.Table) -> pa.Table:
    """The nearest centre of each vector."""
    if not rows.num_rows:
        return rows.append_column("cell", pa.array([], pa.int64())).append_column("away", pa.array([], pa.float64()))
    ids = np.array(centres.column("cid").to_pylist())
    c = _unit(_matrix(centres.column("vec")))
    c, ids = c[np.argsort(ids)], np.sort(ids)
    d = _distance(_unit(_matrix(rows.column("vec"))), c)
    at = d.argmin(1)
    return rows.append_column("cell", pa.array(ids[at], pa.int64())).append_column("away", pa.array(d[np.arange(len(at)), at]))


BLOCKS = "label string, cell long, part int, centre array<double>, radius double, away double, d int, cids binary, sizes binary, vecs binary, nodes binary"


def _tree(key, rows):  # no hints: Spark takes them for another kind of function
    x = _matrix(rows.column("vec"))
    tree = Tree(x)
    root = tree.unit[tree.centre[0]]
    return pa.Table.from_arrays(
        [pa.array([key[0].as_py()], pa.string()), pa.array([key[1].as_py()], pa.int64()), pa.array([key[2].as_py()], pa.int32()),
         pa.array([root.tolist()], pa.list_(pa.float64())), pa.array([float(tree.radius[0])]),
         pa.array([max(rows.column("away").to_pylist())], pa.float64()), pa.array([x.shape[1]], pa.int32()),
         *(pa.array([v], pa.binary()) for v in (np.array(rows.column("cid").to_pylist(), "<i8").tobytes(),
                                                np.array(rows.column("size").to_pylist(), "<i8").tobytes(),
                                                x.astype("<f8").tobytes(), tree.nodes().astype("<f8").tobytes()))],
        [f.split()[0] for f in BLOCKS.split(", ")])


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the components of the links (a, b)."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return [(int(ids[i]), int(ids[j])) for i, j in enumerate(label) if i != j]
        label = new


LINKS = "a long, b long, n long"


def _links(least: float):
    """Pairs of blocks -> (a, null, n): class a has n more links; (a, b, null): a link that spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {x: batch.column(x) for x in batch.schema.names}
            for r in range(batch.num_rows):
                got = {k: v[r].as_py() for k, v in col.items()}
                ids, sizes, trees = {}, {}, {}
                for s in "ab":
                    ids[s], sizes[s] = (np.frombuffer(got[f"{s}_{k}"], "<i8") for k in ("cids", "sizes"))
                    trees[s] = Tree(np.frombuffer(got[f"{s}_vecs"], "<f8").reshape(len(ids[s]), -1),
                                    np.frombuffer(got[f"{s}_nodes"], "<f8").reshape(-1, 6))
                i, j = traverse(trees["a"], trees["b"], least, got["same"])
                if not len(i):
                    continue
                one, two = ids["a"][i], ids["b"][j]
                who, flat = np.unique(np.concatenate([one, two]), return_inverse=True)
                n = np.zeros(len(who), np.int64)
                np.add.at(n, flat, np.concatenate([sizes["b"][j], sizes["a"][i]]))
                forest = _forest(one, two)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*who.tolist(), *(x for x, _ in forest)], pa.int64()),
                     pa.array([*[None] * len(who), *(y for _, y in forest)], pa.int64()),
                     pa.array([*n.tolist(), *[None] * len(forest)], pa.int64())], ["a", "b", "n"])
    return run


# --- the operator ---------------------------------------------------------

def _apart(a: str, b: str):
    """Distance of two centres."""
    squares = F.zip_with(F.col(a), F.col(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def _nested(classes: DataFrame, block: int) -> tuple[DataFrame, list[DataFrame]]:
    """(label, cell, cid, size, vec, away) with the last cell of each vector, and per level the cells there are
    (label, parent, cell, radius, centre); a cell that isn't split is its own parent."""
    rows = classes.select("label", F.lit(-1).cast("long").alias("cell"), "cid", "size", "vec", F.lit(2.0).alias("away"))
    cells = rows.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).select(
        "*", F.lit(None).cast("array<double>").alias("centre"), (F.col("n") > block).alias("open"))
    cells = written(cells, "labels")
    settled, levels = [], []
    while True:
        settled.append(rows.join(cells.filter("not open").select("label", "cell"), ["label", "cell"], "left_semi"))
        wide = cells.filter("open")
        if wide.isEmpty():
            break
        split = rows.drop("away").join(wide.select(
            "label", "cell", F.ceil(F.col("n") / GROUP).cast("int").alias("salts"),
            F.least(F.lit(MAX_CELLS), F.ceil(2 * F.col("n") / block)).cast("int").alias("cells")), ["label", "cell"]).withColumnRenamed("cell", "parent")
        place = F.row_number().over(W.partitionBy("label", "parent").orderBy(F.xxhash64(F.lit(3), "cid"), "cid"))
        centres = written(split.withColumn("place", place).filter(F.col("place") <= MAX_CELLS).filter("place <= cells").select(
            "label", "parent", "cid", "vec", "salts"), "centres")
        salted = split.withColumn("salt", F.pmod(F.xxhash64("cid"), F.col("salts")).cast("int"))
        rows = written(salted.select("label", "parent", "salt", "cid", "size", "vec").groupBy("label", "parent", "salt").cogroup(
            centres.select("label", "parent", "cid", "vec", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt")).groupBy("label", "parent", "salt"))
            .applyInArrow(_cells, "label string, parent long, salt int, cid long, size long, vec array<double>, cell long, away double"), "cells")
        scaled = F.expr("transform(vec, x -> x / array_max(transform(vec, y -> abs(y))))")
        unit = F.expr("transform(vec, x -> x / sqrt(aggregate(vec, 0.0D, (s, y) -> s + y * y)))")
        at = centres.select("label", F.col("cid").alias("cell"), scaled.alias("vec")).select("label", "cell", unit.alias("centre"))
        of = wide.select("label", F.col("cell").alias("parent"), F.col("n").alias("all"), F.col("radius").alias("wide"))
        shrunk = (F.col("n") <= SHRUNK * F.col("all")) | (F.col("radius") <= SHRUNK * F.col("wide"))
        children = rows.groupBy("label", "parent", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).join(
            of, ["label", "parent"]).join(at, ["label", "cell"]).select(
            "label", "parent", "cell", "n", "radius", "centre", ((F.col("n") > block) & shrunk & (F.col("radius") > FLAT)).alias("open"))
        whole = cells.filter("not open").select("label", F.col("cell").alias("parent"), "cell", "n", "radius", "centre", "open")
        level = written(children.unionByName(whole), "level")
        levels.append(level.select("label", "parent", "cell", "radius", "centre"))
        cells, rows = level.drop("parent"), rows.select("label", "cell", "cid", "size", "vec", "away")
    return functools.reduce(DataFrame.unionByName, settled), levels


def _block_links(classes: DataFrame, least: float, block: int) -> DataFrame:
    t = math.sqrt(2 - 2 * least) + EPS
    celled, levels = _nested(classes, block)
    parts = celled.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    parted = celled.join(parts, ["label", "cell"]).withColumn("part", F.pmod(F.xxhash64(F.lit(7), "cid"), F.col("parts")).cast("int"))
    blocks = written(parted.select("label", "cell", "part", "cid", "size", "vec", "away").groupBy("label", "cell", "part")
                     .applyInArrow(_tree, BLOCKS), "blocks")
    # dual traversal, level by level, then blocks: pairs farther apart than both radii and t are pruned
    near = _apart("a_centre", "b_centre") <= F.col("a_radius") + F.col("b_radius") + t
    pairs = classes.select("label").distinct().selectExpr("label", "-1L a_cell", "-1L b_cell")
    for cells in levels:
        side = lambda s: cells.selectExpr("label", f"parent {s}_parent", f"cell {s}_cell", f"radius {s}_radius", f"centre {s}_centre")  # noqa: B023, E731
        pairs = written(pairs.selectExpr("label", "a_cell a_parent", "b_cell b_parent").join(side("a"), ["label", "a_parent"]).join(
            side("b"), ["label", "b_parent"]).filter(
            (F.col("a_cell") == F.col("b_cell")) | (((F.col("a_parent") != F.col("b_parent")) | (F.col("a_cell") < F.col("b_cell"))) & near))
            .select("label", "a_cell", "b_cell"), "cell-pairs")
    head = lambda s: blocks.selectExpr("label", f"cell {s}_cell", f"part {s}_part", f"radius {s}_radius", f"centre {s}_centre")
    pairs = pairs.join(head("a"), ["label", "a_cell"]).join(head("b"), ["label", "b_cell"]).filter(
        ((F.col("a_cell") != F.col("b_cell")) | (F.col("a_part") <= F.col("b_part"))) & near).select(
        "label", "a_cell", "a_part", "b_cell", "b_part")
    body = lambda s: blocks.selectExpr("label", f"cell {s}_cell", f"part {s}_part",
                                       *(f"{x} {s}_{x}" for x in ("cids", "sizes", "vecs", "nodes")))
    loaded = pairs.join(body("a"), ["label", "a_cell", "a_part"]).join(body("b"), ["label", "b_cell", "b_part"]).withColumn(
        "same", (F.col("a_cell") == F.col("b_cell")) & (F.col("a_part") == F.col("b_part")))
    return loaded.drop("label", "a_cell", "a_part", "b_cell", "b_part").mapInArrow(_links(least), LINKS)


def link(table: DataFrame, least: float = THRESHOLD, block: int = BLOCK, id_col: str = "vec_id",
         vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row."""
    frame = pick(table, vec_id=f"{id_col} long", vec=f"{vec_col} array<double>", label=f"{label_col} string")
    usable = F.col("label").isNotNull() & finite(F.col("vec")) & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))
    # the dimension is a part of the label: vectors of another are never compared
    frame = written(frame.select("vec_id", F.when(usable, F.concat_ws(":", F.size("vec").cast("string"), "label")).alias("label"),
                                 F.when(usable, F.col("vec")).alias("vec")), "vectors")
    linkable = frame.filter("label is not null")
    classes = written(linkable.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("low"))
                      .select(F.monotonically_increasing_id().alias("cid"), "label", "vec", "size", "low"), "classes")
    found = written(_block_links(classes.select("label", "cid", "size", "vec"), least, block), "class-links")
    roots = components(found.filter("b is not null").select("a", "b"))
    more = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("more"))
    classes = classes.join(roots, classes["cid"] == roots["node"], "left").drop("node").join(
        more, F.col("cid") == F.col("a"), "left").select(
        "label", "vec", "low", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("root", "cid").alias("root"))
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = classes.join(lows, "root").select("label", "vec", "n_links", "component_id")
    linked = linkable.join(classes, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = frame.filter("label is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS vec FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b USING (label)
          WHERE a.vec_id <> b.vec_id AND len(a.vec) = len(b.vec) AND list_cosine_similarity(a.vec, b.vec) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON l.a = r.b),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM low LEFT JOIN n USING (vec_id)
"""
