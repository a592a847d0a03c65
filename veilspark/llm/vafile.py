"""Exact top-k search by inner product with vector-approximation files.

Components are integers, floor(scale * x). Per dimension a grid of ``2 ** BITS`` equal
cells spans the values found; a vector's approximation is one byte per component.

1. Scan: from the cells alone each query gets a lower and an upper bound of its score with
   every vector. The k-th largest lower bound is a score that k vectors reach for sure.
2. Vectors whose upper bound reaches it are candidates. Their exact vectors are joined
   in and read in falling order of the bound, until the k-th best exact score is above
   the bounds of all that is left. A query's candidates are dealt to several groups (by
   hash, more of them for more blocks), each with its k best, so a query amid very many
   near vectors isn't one task's work.

The approximations are read in blocks of ``BLOCK`` vectors. Queries are taken in chunks
of about ``CHUNK``, whose vectors are sent to all tasks (a bounded size); each chunk
scans all blocks. Per task and query k bounds leave the first scan.

Vectors that are null or hold null or non-finite components take no part, nor do
those without an id; only vectors of equal dimension are compared. Rows repeated in full
count once. A vector is no candidate for a query of the same id. Ties go to the smaller
id. Scores beyond 64 bits stay at the limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import pick, read, shuffle_partitions, written

SCALE, BITS = 1024.0, 8
BLOCK, CHUNK = 4096, 8192
LIMIT = (1 << 63) - 1


def finite(vec: Column) -> Column:
    """True for arrays of finite numbers."""
    return vec.isNotNull() & F.coalesce(F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))), F.lit(False))


def _rows(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return np.split(values, (ends - ends[0])[1:-1]) if len(column) else []


# --- grid and approximations ----------------------------------------------

def _extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for v in _rows(batch.column(0)):
            low, high = found.get(len(v), (v, v))
            found[len(v)] = np.minimum(low, v), np.maximum(high, v)
    rows = [(d, i, int(a), int(b)) for d, (low, high) in found.items() for i, (a, b) in enumerate(zip(low, high, strict=True))]
    cols = list(zip(*rows, strict=True)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.int32(), pa.int64(), pa.int64()], strict=True)],
                                     ["d", "i", "low", "high"])


class Grid:
    """Cells of one dimension count: integer edges, ``2 ** BITS`` cells each."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low = low.astype(float)
        self.width = np.maximum(np.ceil((high.astype(float) - self.low + 1) / (1 << BITS)), 1)

    def codes(self, q: np.ndarray) -> np.ndarray:
        return np.clip((q - self.low) // self.width, 0, (1 << BITS) - 1).astype(np.uint8)

    def bounds(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.low + codes * self.width
        return low, low + self.width - 1


def grids(vectors: DataFrame) -> dict[int, Grid]:
    """A row per dimension comes to the driver."""
    rows = vectors.select("q").mapInArrow(_extremes, "d int, i int, low long, high long").groupBy("d", "i").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d", "i").collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["d"], []).append((r["low"], r["high"]))
    return {d: Grid(*(np.array(x) for x in zip(*v, strict=True))) for d, v in by.items()}


def _approximated(of: dict[int, Grid]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(d):
            ids, q = zip(*held.pop(d), strict=True)
            return pa.RecordBatch.from_pydict({
                "d": pa.array([d], pa.int32()), "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                "codes": pa.array([of[d].codes(np.array(q, float)).tobytes()], pa.binary())})

        for batch in batches:
            for vec_id, q in zip(batch.column(0).to_pylist(), _rows(batch.column(1)), strict=True):
                if len(q):
                    held.setdefault(len(q), []).append((vec_id, q))
                    if len(held[len(q)]) == BLOCK:
                        yield block(len(q))
        for d in list(held):
            yield block(d)
    return run


# --- bounds ---------------------------------------------------------------

class Chunk:
    """Queries of one dimension count, sorted by id."""

    def __init__(self, ids: np.ndarray, q: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.q = ids[order], q[order].astype(float)
        self.plus, self.minus = np.maximum(self.q, 0), np.minimum(self.q, 0)
        self.slack = 1e-9  # of the largest sums, where doubles round

    def bounds(self, grid: Grid, ids: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper), queries x vectors; -inf at a query's own id."""
        low, high = grid.bounds(codes)
        lower = self.plus @ low.T + self.minus @ high.T
        upper = self.plus @ high.T + self.minus @ low.T
        if max(np.abs(lower).max(), np.abs(upper).max()) >= 2.0 ** 52:
            room = self.slack * (np.abs(self.q) @ np.maximum(np.abs(low), np.abs(high)).T)
            lower, upper = lower - room, upper + room
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        own = np.flatnonzero(self.ids[at] == ids)
        lower[at[own], own] = upper[at[own], own] = -np.inf
        return lower, upper


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for d, ids, codes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
        yield d, np.frombuffer(ids, "<i8"), np.frombuffer(codes, np.uint8).reshape(-1, d)


def _lower_bounds(of: dict[int, Grid], chunks: dict[int, Chunk], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, ids, codes in _blocks(batch):
                if d in chunks:
                    lower, _ = chunks[d].bounds(of[d], ids, codes)
                    if d in best:
                        lower = np.concatenate([best[d], lower], axis=1)
                    best[d] = -np.partition(-lower, k - 1, axis=1)[:, :k] if lower.shape[1] > k else lower
        for d, b in best.items():
            q, at = np.nonzero(np.isfinite(b))
            yield pa.RecordBatch.from_pydict({"query_id": pa.array(chunks[d].ids[q]), "d": pa.array(np.full(len(q), d, np.int32)),
                                              "bound": pa.array(b[q, at])})
    return run


def _candidates(of: dict[int, Grid], chunks: dict[int, Chunk], least: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, ids, codes in _blocks(batch):
                if d in chunks:
                    _, upper = chunks[d].bounds(of[d], ids, codes)
                    q, at = np.nonzero((upper >= least[d][:, None]) & (upper > -np.inf))
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(chunks[d].ids[q]), "d": pa.array(np.full(len(q), d, np.int32)),
                        "vec_id": pa.array(ids[at]), "bound": pa.array(upper[q, at])})
    return run


def _score(a: np.ndarray, b: np.ndarray) -> int:
    if float(np.abs(a.astype(float)) @ np.abs(b.astype(float))) < 2.0 ** 62:
        return int(a @ b)
    return max(-LIMIT - 1, min(LIMIT, sum(int(x) * int(y) for x, y in zip(a, b, strict=True))))


FOUND = "query_id long, vec_id long, score long"
MIN_PARTS, PART_BLOCKS = 8, 16


def _verified(chunks: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Rows (query_id, d, vec_id, bound, q, part) by falling bound within a part of a query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, done = None, [], False
        for batch in batches:
            out = []
            queries, ds, ids, bounds = (batch.column(i).to_pylist() for i in range(4))
            parts = batch.column(5).to_pylist()
            for query, d, vec_id, bound, q, part in zip(queries, ds, ids, bounds, _rows(batch.column(4)), parts, strict=True):
                if (query, d, part) != now:
                    now, best, done = (query, d, part), [], False
                    own_ids, own_q = chunks[d]
                    own = own_q[np.searchsorted(own_ids, query)]
                if done or len(best) == k and best[-1] > bound:
                    done = True  # no vector left can enter the k best
                    continue
                score = _score(own, q)
                best = sorted([*best, score], reverse=True)[:k]
                if score >= best[-1]:
                    out.append((query, vec_id, score))
            cols = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])
    return run


# --- the operator ---------------------------------------------------------

def search(table: DataFrame, is_query: Column, k: int = 10, scale: float = SCALE, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score). ``is_query``: a condition on ``vec_id``."""
    spark = table.sparkSession
    vectors = pick(table, vec_id=f"{id_col} long", vec=f"{vec_col} array<double>").filter(
        finite(F.col("vec")) & F.col("vec_id").isNotNull() & (F.size("vec") > 0))
    vectors = written(vectors.select("vec_id", F.transform("vec", lambda x: F.floor(x * scale)).alias("q"))
                      .dropDuplicates(["vec_id", "q"]), "vectors")
    of = grids(vectors)
    blocks = written(vectors.mapInArrow(_approximated(of), "d int, ids binary, codes binary"), "approximations")
    n_blocks = blocks.count()
    queries = vectors.filter(is_query)
    n_chunks = max(1, math.ceil(queries.count() / CHUNK))
    found = None
    for i in range(n_chunks):
        mine = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_chunks)) == i).toArrow()  # about CHUNK rows
        part = _search_chunk(spark, vectors, blocks, n_blocks, of, mine, k)
        found = part if found is None else found.unionAll(part)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_chunk(spark: SparkSession, vectors, blocks, n_blocks: int, of, mine: pa.Table, k: int) -> DataFrame:
    by: dict[int, dict] = {}
    for vec_id, q in zip(mine.column(0).to_pylist(), mine.column(1).to_pylist(), strict=True):
        by.setdefault(len(q), {})[vec_id] = q  # of two vectors of one id and length, one asks
    exact = {d: (np.array(sorted(x)), np.array([x[i] for i in sorted(x)], np.int64)) for d, x in by.items()}
    chunks = {d: Chunk(*x) for d, x in exact.items()}
    lower = blocks.mapInArrow(_lower_bounds(of, chunks, k), "query_id long, d int, bound double")
    place = F.row_number().over(W.partitionBy("query_id", "d").orderBy(F.desc("bound")))
    kth = lower.withColumn("place", place).filter(F.col("place") <= k).filter(F.col("place") == k).collect()  # a row a query
    least = {d: np.full(len(c.ids), -np.inf) for d, c in chunks.items()}
    for r in kth:
        least[r["d"]][np.searchsorted(chunks[r["d"]].ids, r["query_id"])] = r["bound"]
    near = blocks.mapInArrow(_candidates(of, chunks, least), "query_id long, d int, vec_id long, bound double")
    joined = near.join(vectors, (near["vec_id"] == vectors["vec_id"]) & (near["d"] == F.size(vectors["q"]))).select(
        "query_id", "d", near["vec_id"], "bound", "q",
        F.pmod(F.xxhash64(near["vec_id"]), F.lit(max(MIN_PARTS, n_blocks // PART_BLOCKS))).alias("part"))
    ordered = joined.repartition(shuffle_partitions(spark), "query_id", "part").sortWithinPartitions(
        "query_id", "d", "part", F.desc("bound"), "vec_id")
    return ordered.mapInArrow(_verified(exact, k), FOUND)


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


OP4_SQL = """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
           FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
     r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
