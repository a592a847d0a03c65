"""Ranked lexical search over K2-treaps.

Documents are taken in blocks (at most ``BLOCK_DOCS`` documents and about
``BLOCK_POSTINGS`` different terms of documents). A block is a grid with a row per
term, frequent ones last, and a column per document, by id. The grid is halved along
its longer side until its cells are square and along both sides from there on. A cell
is a node if a term of its rows occurs in a document of its columns; it knows the
largest impact in it. A cell with one occurrence is a leaf and holds its row and column
(chains of single children are not kept). Nodes are stored level by level: the set of
children as bits, the maximum as what it lacks to the parent's; so a child's place
follows from counting bits.

A search starts each term of an item at the cell of its row where cells become square
and takes all of them down together: a range of documents with one cell per term has the
sum of weight x maximum as its upper bound. The ranges with the highest bounds are halved
first, ``STEP`` at a time; a range of one document has its exact score. It ends when no
range can reach the k-th best score (or, with an equal bound, a smaller id). What a task
found in its earlier blocks bounds its later ones.

An impact is (10^9 tf) div (1000 tf + 20 m), a term's weight floor(1000 ln((2N+2) / (2df+1)));
m is the document's length in per cent of the mean, half weighted. N, the sum of lengths
and df cover all documents. Blocks are made where their documents are read, so texts
aren't shuffled; tasks give k rows an item.

A null or empty text has no term and is never found. Documents without an id count, and
come after the others of equal score. Rows that repeat are documents of their own. Items
of equal id are one item with all their terms; items without id are one too. A very long
text is one document of a block. No items or no documents: no rows.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import pick, read, written

BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 18
STEP = 128                         # ranges halved at a time
CHUNK_ITEMS, CHUNK_TERMS = 4096, 1 << 20  # of a search; what tasks are sent
# Rows of blocks have megabytes: read and sent to Python one by one, not by the thousand.
ROW_BY_ROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "1"}
NO_ID = (1 << 63) - 1              # sorts after every other id
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
SIGNS = bytes(0x20 if b in SEPARATORS else b for b in range(256))
POPULATION = np.array([b.bit_count() for b in range(16)], np.int32)


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of letters, digits and everything beyond ASCII in UTF-8; A-Z as a-z."""
    return (text or b"").lower().translate(SIGNS).split()


@contextmanager
def _row_by_row(spark: SparkSession) -> Iterator[None]:
    """For the jobs run inside: a task holds one row of blocks at a time, however many its split has."""
    before = {k: spark.conf.get(k, None) for k in ROW_BY_ROW}
    for k, v in ROW_BY_ROW.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# --- postings -------------------------------------------------------------

POSTINGS = "n_docs long, n_terms long, doc_ids binary, lengths binary, terms binary, rows binary, cols binary, tfs binary"


class _Block:
    def __init__(self):
        self.ids, self.lengths = array("q"), array("q")
        self.rows, self.cols, self.tfs = array("i"), array("i"), array("i")  # of the postings
        self.number: dict[bytes, int] = {}

    def add(self, doc_id: int | None, terms: list[bytes]) -> None:
        counts = Counter(terms)
        number = self.number
        self.rows.extend([number.setdefault(t, len(number)) for t in counts])
        self.tfs.extend(counts.values())
        self.cols.extend([len(self.ids)] * len(counts))
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(len(terms))

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or len(self.rows) >= BLOCK_POSTINGS

    def batch(self) -> pa.RecordBatch:
        ids, lengths, rows, cols, tfs = (np.array(x) for x in (self.ids, self.lengths, self.rows, self.cols, self.tfs))
        by_id = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[by_id] = np.arange(len(ids))
        by_df = np.argsort(np.bincount(rows, minlength=len(self.number)), kind="stable")
        row_of = np.empty(len(by_df), np.int64)
        row_of[by_df] = np.arange(len(by_df))
        names = list(self.number)
        cells = [[len(ids)], [int(lengths.sum())], ids[by_id].tobytes(), lengths[by_id].tobytes(), b" ".join([names[i] for i in by_df.tolist()]),
                 row_of[rows].astype("<u4").tobytes(), place[cols].astype("<u2").tobytes(), tfs.tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) if isinstance(c, list) else pa.array([c], pa.binary()) for c in cells],
            [x.split()[0] for x in POSTINGS.split(", ")])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if terms := terms_of(text.as_py()):
                block.add(doc_id, terms)
                if block.full():
                    yield block.batch()
                    block = _Block()
    if block.ids:
        yield block.batch()


# --- the tree -------------------------------------------------------------

def _interleaved(row: np.ndarray, col: np.ndarray, a: int, b: int) -> np.ndarray:
    """A cell's path: the longer side's upper bits, then row and column bits in turn."""
    both = min(a, b)
    key = row >> both if a > b else col >> both
    for i in range(both - 1, -1, -1):
        key = (key << 2) | ((row >> i & 1) << 1) | (col >> i & 1)
    return key


def encode(row: np.ndarray, col: np.ndarray, value: np.ndarray, a: int, b: int) -> dict[str, np.ndarray]:
    """The treap of a grid of 2^a x 2^b with these different cells: children (bits; 0: leaf), lack, and row and col of leaves."""
    key = _interleaved(row, col, a, b)
    order = np.argsort(key, kind="stable")
    key, row, col, value = key[order], row[order], col[order], value[order]
    children, lack, leaf_rows, leaf_cols = [], [], [], []
    above = None  # (parent of each group, bits, maxima) of the level before
    shift = abs(a - b) + 2 * min(a, b)
    for level in range(abs(a - b) + min(a, b) + 1):
        width = 0 if level == 0 else 1 if level <= abs(a - b) else 2
        shift -= width
        prefix = key >> shift
        starts = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])) if len(key) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([starts, [len(key)]]))
        best = np.maximum.reduceat(value, starts) if len(starts) else value[:0]
        if above is not None:
            parent, maxima = above
            slot = prefix[starts] & ((1 << width) - 1)
            of = parent[starts]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else of
            bits = children[-1]
            if len(of):
                bits[of[first]] = np.bitwise_or.reduceat((1 << slot).astype(np.uint8), first)
            lack.append(maxima[of] - best)
        else:
            lack.append(best)
        single = counts == 1
        children.append(np.zeros(len(starts), np.uint8))
        leaf_rows.append(row[starts[single]])
        leaf_cols.append(col[starts[single]])
        stays = np.repeat(~single, counts)
        group = np.repeat(np.arange(len(starts)), counts)
        key, row, col, value = key[stays], row[stays], col[stays], value[stays]
        above = group[stays], best
        if not len(key):
            break
    return {"children": np.concatenate(children), "lack": np.concatenate(lack).astype("<u4"),
            "leaf_rows": np.concatenate(leaf_rows).astype("<u4"), "leaf_cols": np.concatenate(leaf_cols).astype("<u2")}


class Treap:
    """Decoded: node 0 is the root; the last node stands for what is absent."""

    def __init__(self, a: int, b: int, children: np.ndarray, lack: np.ndarray, leaf_rows: np.ndarray, leaf_cols: np.ndarray):
        self.a, self.b, n = a, b, len(children)
        count = POPULATION[children]
        self.none = n
        first = (1 + np.cumsum(count) - count).astype(np.int32)
        self.below = np.full((n + 1, 4), n, np.int32)  # the child in each quarter
        for slot in range(4):
            has = children >> slot & 1 == 1
            self.below[:-1][has, slot] = first[has] + POPULATION[children[has] & ((1 << slot) - 1)]
        self.below = self.below.ravel()
        leaf = children == 0
        self.row, self.col = np.full(n + 1, -1, np.int32), np.zeros(n + 1, np.int32)  # of leaves
        self.row[:-1][leaf], self.col[:-1][leaf] = leaf_rows, leaf_cols
        self.best = np.zeros(n + 1, np.int64)
        at, size = 0, 1
        self.best[0] = lack[0]
        while size:
            below = count[at:at + size]
            nxt, total = at + size, int(below.sum())
            self.best[nxt:nxt + total] = np.repeat(self.best[at:at + size], below) - lack[nxt:nxt + total]
            at, size = nxt, total

    def _child(self, node: np.ndarray, slot: np.ndarray | int, row: np.ndarray) -> np.ndarray:
        found = self.below[node * 4 + slot]
        of = self.row[found]
        return np.where((of < 0) | (of == row), found, self.none)

    def start(self, rows: np.ndarray) -> tuple[int, np.ndarray]:
        """(columns' bits that are left, cell of each row): down the side that is longer, where that is the rows'."""
        node = np.where((self.row[0] < 0) | (self.row[0] == rows), 0, self.none).astype(np.int32)
        for i in range(self.a - 1, self.b - 1, -1):
            node = np.where(self.row[node] >= 0, node, self._child(node, rows >> i & 1, rows))
        return self.b, node

    def halves(self, node: np.ndarray, rows: np.ndarray, left: np.ndarray) -> Iterator[np.ndarray]:
        """The cells of the two halves of ranges with ``left`` bits to go: node is ranges x terms."""
        bit = (left - 1)[:, None]
        both = bit < self.a  # columns alone are halved while they are the longer side
        slot = np.where(both, (rows[None, :] >> bit & 1) * 2, 0).astype(np.int32)
        leaf, half = self.row[node] >= 0, self.col[node] >> bit & 1
        for c in (0, 1):
            yield np.where(leaf, np.where(half == c, node, self.none), self._child(node, slot + c, rows[None, :]))


class Best:
    """The k best (score, id) so far: highest score, then smallest id, first."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc_id: np.ndarray) -> None:
        score, doc_id = np.concatenate([self.score, score]), np.concatenate([self.id, doc_id])
        order = np.lexsort((doc_id, -score))[:self.k]
        self.score, self.id = score[order], doc_id[order]

    def open(self, bound: np.ndarray, first_id: np.ndarray) -> np.ndarray:
        """Which ranges, with this bound and smallest id, may hold one that enters."""
        if len(self.score) < self.k:
            return bound > 0
        return (bound > self.score[-1]) | ((bound == self.score[-1]) & (first_id < self.id[-1]))


def descend(treap: Treap, rows: np.ndarray, weights: np.ndarray, doc_ids: np.ndarray, best: Best) -> int:
    """Adds the block's documents that enter ``best``; the number of ranges that were halved."""
    bits, node = treap.start(rows)
    left, col, nodes = np.array([bits]), np.array([0]), node[None, :]
    bound, halved = treap.best[nodes] @ weights, 0
    n = len(doc_ids)

    def first_id(col, left):
        at = col << left
        return np.where(at < n, doc_ids[np.minimum(at, n - 1)], NO_ID)

    while len(bound):
        done = left == 0
        if done.any():
            at = done & (bound > 0)
            best.add(bound[at], doc_ids[col[at]])
        stay = ~done & best.open(bound, first_id(col, left))
        left, col, nodes, bound = left[stay], col[stay], nodes[stay], bound[stay]
        if not len(bound):
            break
        some = np.argpartition(-bound, STEP)[:STEP] if len(bound) > STEP else np.arange(len(bound))
        rest = np.ones(len(bound), bool)
        rest[some] = False
        halved += len(some)
        new = [(left[some] - 1, col[some] * 2 + c, x, treap.best[x] @ weights)
               for c, x in enumerate(treap.halves(nodes[some], rows, left[some]))]
        left, col, nodes, bound = (np.concatenate([old[rest], *(x[i] for x in new)])
                                   for i, old in enumerate((left, col, nodes, bound)))
    return halved


# --- the index ------------------------------------------------------------

TREAPS = ("doc_ids binary, terms binary, dfs binary, a int, b int, children binary, lack binary, leaf_rows binary, leaf_cols binary")


class Index(NamedTuple):
    blocks: DataFrame  # a treap a row
    n_docs: int        # N
    n_terms: int       # L


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if n_docs * int(length.max(initial=0)) * 50 < 1 << 62:
        m = 50 + (50 * length * n_docs) // n_terms
    else:
        m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in length], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _treaps(n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lengths, terms, rows, cols, tfs in zip(*(batch.column(i) for i in range(6)), strict=True):
                ids, terms = ids.as_py(), terms.as_py()
                length = np.frombuffer(lengths.as_py(), "<i8")
                row, col = (np.frombuffer(x.as_py(), t).astype(np.int64) for x, t in ((rows, "<u4"), (cols, "<u2")))
                value = impacts(np.frombuffer(tfs.as_py(), "<i4").astype(np.int64), length[col], n_docs, n_terms)
                dfs = np.bincount(row)
                a, b = (max(0, int(x - 1).bit_length()) for x in (len(dfs), len(length)))
                tree = encode(row, col, value, a, b)
                cells = [ids, terms, dfs.astype("<u4").tobytes(), a, b, *(tree[x].tobytes() for x in ("children", "lack", "leaf_rows", "leaf_cols"))]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32() if isinstance(c, int) else pa.binary()) for c in cells],
                                                 [x.split()[0] for x in TREAPS.split(", ")])
    return run


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Indexes every document."""
    frame = pick(docs, doc_id=f"{id_col} long", text=f"{text_col} string").select("doc_id", F.col("text").cast("binary").alias("text"))
    postings = written(frame.mapInArrow(_postings, POSTINGS), "postings")
    n = postings.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")).first()
    cells = postings.select("doc_ids", "lengths", "terms", "rows", "cols", "tfs")
    with _row_by_row(docs.sparkSession):
        return Index(written(cells.mapInArrow(_treaps(n["docs"], n["terms"]), TREAPS), "treaps"), n["docs"], n["terms"])


# --- search ---------------------------------------------------------------

def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(i, t) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for t in set(terms_of(text))]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary())], ["item_id", "term"])


def _dfs(wanted: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for terms, dfs in zip(batch.column(0), batch.column(1), strict=True):
                n = np.frombuffer(dfs.as_py(), "<u4")
                for row, t in enumerate(terms.as_py().split(b" ")):
                    if t in wanted:
                        total[t] += int(n[row])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["term", "df"])
    return run


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df + 1)))


FOUND = "part int, item_id long, doc_id long, score long"


def _searched(items: dict[int | None, dict[bytes, int]], k: int):
    """items: weights by term. A row for each of the k best of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: Best(k) for i in items}
        for batch in batches:
            for x in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                row_of = {t: row for row, t in enumerate(x["terms"].split(b" "))}
                doc_ids = np.frombuffer(x["doc_ids"], "<i8")
                kinds = {"children": np.uint8, "lack": "<u4", "leaf_rows": "<u4", "leaf_cols": "<u2"}
                treap = Treap(x["a"], x["b"], *(np.frombuffer(x[name], kind) for name, kind in kinds.items()))
                for i, weights in items.items():
                    here = [(row_of[t], w) for t, w in weights.items() if t in row_of]
                    if here:
                        rows, w = zip(*here, strict=True)
                        descend(treap, np.array(rows, np.int32), np.array(w, np.int64), doc_ids, best[i])
        part = TaskContext.get().partitionId()
        found = [(part, i, None if d == NO_ID else d, s) for i, b in best.items() for d, s in zip(b.id.tolist(), b.score.tolist(), strict=True)]
        cols = list(zip(*found, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)],
                                         ["part", "item_id", "doc_id", "score"])
    return run


def search(index: Index, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = items.sparkSession
    frame = pick(items, item_id=f"{id_col} long", text=f"{text_col} string").select("item_id", F.col("text").cast("binary").alias("text"))
    terms = written(frame.mapInArrow(_terms, "item_id long, term binary").distinct(), "item-terms")
    size = terms.agg(F.count_distinct(F.coalesce("item_id", F.lit(NO_ID))).alias("items"), F.count(F.lit(1)).alias("terms")).first()
    n_chunks = max(1, math.ceil(size["items"] / CHUNK_ITEMS), math.ceil(size["terms"] / CHUNK_TERMS))
    found = []
    for i in range(n_chunks):  # written one by one: a chunk's terms go before the next ones come
        chunk = _searcher(index, terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_chunks)) == i), k)
        with _row_by_row(spark):
            found.append(written(index.blocks.mapInArrow(chunk, FOUND), "found"))
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = W.partitionBy("item_id", F.pmod("part", F.lit(32))).orderBy(*best)
    result = result.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    result = result.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*best)))
    return result.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _searcher(index: Index, terms: DataFrame, k: int):
    """``terms``: (item_id, term) of about CHUNK_ITEMS items."""
    pairs = terms.collect()
    wanted = {bytes(r["term"]) for r in pairs}
    with _row_by_row(terms.sparkSession):
        dfs = {bytes(r["term"]): r["df"] for r in index.blocks.select("terms", "dfs").mapInArrow(
            _dfs(wanted), "term binary, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}  # terms of the chunk
    items: dict[int | None, dict[bytes, int]] = {}
    for r in pairs:
        t = bytes(r["term"])
        if t in dfs and (w := weight(dfs[t], index.n_docs)) > 0:
            items.setdefault(r["item_id"], {})[t] = w
    return _searched(items, k)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"), k=50)


OP12_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
     n AS (SELECT d, doc_id, len(ts)::BIGINT AS n FROM t WHERE len(ts) > 0),
     s AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM n),
     f AS (SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(ts) AS term FROM t) GROUP BY d, term),
     w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(nn) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
           FROM f, s GROUP BY term),
     q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     r AS (SELECT item_id, doc_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // l))))::BIGINT AS score
           FROM q JOIN w USING (term) JOIN f USING (term) JOIN n USING (d), s GROUP BY item_id, doc_id, d),
     k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
           FROM r WHERE score > 0)
SELECT * FROM k WHERE rank <= 50
"""
