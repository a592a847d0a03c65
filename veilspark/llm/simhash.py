"""SimHash near-dedup with deletion-variant signatures.

Fingerprint: the text's A-Z in lower case, its words ``[^\\x20\\x09-\\x0D]+``, every
``k`` consecutive words joined by one space (repeats included; fewer words: the
whole sequence; none: fingerprint zero), hashed by XXH64 (UTF-8, seed 42). A bit is
1 if it is set in over half the hashes. Null text counts as empty.

Linking: two fingerprints at most ``d`` bits apart are cut into ``d // 2 + 1``
segments, so that in one segment they differ by at most one bit. Each distinct
fingerprint is put under a key for every segment and every bit of it, with
that bit wiped out: two fingerprints with at most one other bit in the segment
share a key. Rows of equal key meet after one shuffle; each pair is verified over
all 64 bits, and only under the first key that it shares, so once.

Skew: equal fingerprints are one row from the start. A key that more than
``block`` fingerprints could share is cut into blocks, whose pairs go to tasks
of their own. Inside a key only a spanning forest of the links leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.common import ROW, packed, pick, read, shuffle_partitions, unpacked, written
from veilspark.llm.components import components

SEED = 42
BLOCK = 2048
MAX_BROADCAST = 50_000  # rows of 16 bytes
_xxh = xxhash.xxh64_intdigest


def fingerprint(text: bytes | None, k: int = 4) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        return _xxh(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:len(words) - k]]
    hashes = np.array([_xxh(joined[a:b - 1], SEED) for a, b in zip(starts, ends[k - 1:], strict=True)], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, k) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            columns = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in columns), pa.array(fp)], [*columns, "fp"])
    return run


def fingerprints(docs: DataFrame, k: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, fp): one row per input row; row_key is a hash of id and text."""
    frame = pick(docs, doc_id=f"{id_col} long", text=f"{text_col} string")
    return frame.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"),
                        F.col("text").cast("binary").alias("text")).mapInArrow(
        _fingerprints(k), "doc_id long, row_key long, fp long")


# --- links ----------------------------------------------------------------

def segments(d: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments for distance d."""
    n = d // 2 + 1
    edges = [round(i * 64 / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _canonical(x: np.ndarray, y: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """The number of the first key that x and y share, -1 if none: segment offset + bit."""
    out, diff = np.full(x.shape, -1, np.int16), x ^ y
    for first, width in reversed(cuts):
        part = (diff >> np.uint64(first)) & np.uint64((1 << width) - 1)
        one = (part & (part - np.uint64(1))) == 0  # no bit or one
        bit = np.bitwise_count((part & (~part + np.uint64(1))) - np.uint64(1)).astype(np.int16)
        out = np.where(one, first + np.where(part == 0, 0, bit), out)
    return out.astype(np.int16)


def _forest(fps: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """A link from each node to its component's first node; near: symmetric truth table."""
    label = np.arange(len(fps))
    while True:
        low = np.where(near, label[None, :], len(fps)).min(1)
        low = np.minimum(low, label)
        low = low[low]
        if (low == label).all():
            return [(int(fps[i]), int(fps[j])) for i, j in enumerate(low) if i != j]
        label = low


def _bucket_links(key: int, fps: np.ndarray, d: int, cuts) -> list[tuple[int, int]]:
    u = fps.view(np.uint64)
    near = np.empty((len(u), len(u)), bool)
    for i in range(0, len(u), 256):  # in strips: bounded memory
        x, y = u[i:i + 256, None], u[None, :]
        near[i:i + 256] = (np.bitwise_count(x ^ y) <= d) & (_canonical(x, np.broadcast_to(y, (len(x), len(u))), cuts) == key)
    near |= near.T
    return _forest(fps, near)


def _verify(d: int, short: int = 32):
    """Over rows (variant, masked, block, fp) sorted by the first three: links within each key."""
    cuts = segments(d)

    def links_of(variant, masked, block, fp):
        new = np.r_[True, (variant[1:] != variant[:-1]) | (masked[1:] != masked[:-1]) | (block[1:] != block[:-1])]
        run = np.cumsum(new) - 1
        size = np.bincount(run)
        out = []
        small = size[run] <= short
        r, f, v = run[small], fp[small], variant[small]
        for step in range(1, short):  # the pairs of each short run, step by step
            same = np.flatnonzero(r[step:] == r[:-step])
            if not len(same):
                break
            x, y = f[same].view(np.uint64), f[same + step].view(np.uint64)
            good = np.bitwise_count(x ^ y) <= d
            x, y, w = x[good], y[good], v[same][good]
            good = _canonical(x, y, cuts) == w
            out += zip(x[good].view(np.int64).tolist(), y[good].view(np.int64).tolist(), strict=True)
        starts = np.flatnonzero(new)
        for i in np.flatnonzero(size > short):
            a = starts[i]
            out += _bucket_links(int(variant[a]), np.unique(fp[a:a + size[i]]), d, cuts)
        return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()),
                                           "b": pa.array([y for _, y in out], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            # the last key may go on in the next batch; runs are bounded by the blocks
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield links_of(*(c[:cut] for c in cols))
            held = [c[cut:] for c in cols]
        if held is not None and len(held[0]):
            yield links_of(*held)
    return run


def links(fps: DataFrame, d: int = 4, block: int = BLOCK) -> DataFrame:
    """``fps``: distinct (fp long) -> (a, b): links whose components are those of all
    pairs at most ``d`` bits apart."""
    cuts = segments(d)
    fp = F.col("fp")
    parts = [F.struct(F.lit(first).alias("first"), F.lit(width).alias("width"),
                      F.shiftrightunsigned(fp, first).bitwiseAND((1 << width) - 1).alias("part")) for first, width in cuts]
    # How many fingerprints have each value of a segment: a key holds those of two values.
    # Only values that alone could fill half a block are of interest.
    exploded = fps.select("fp", F.explode(F.array(*parts)).alias("s")).select("fp", "s.*")
    counts = exploded.groupBy("first", "width", "part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block // 2)
    hot = counts.select("first", F.explode(F.expr("sequence(0, width - 1)")).alias("bit"), "part", "n").select(
        (F.col("first") + F.col("bit")).alias("variant"), F.expr("part & ~shiftleft(1L, bit)").alias("masked"), "n") \
        .groupBy("variant", "masked").agg((2 * F.sum("n")).alias("n")) \
        .select("variant", "masked", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    hot = written(hot, "hot-keys")
    n_hot = hot.count()
    variants = exploded.select("fp", "first", F.explode(F.expr("sequence(0, width - 1)")).alias("bit"), "part").select(
        "fp", (F.col("first") + F.col("bit")).alias("variant"), F.expr("part & ~shiftleft(1L, bit)").alias("masked"))
    if n_hot:  # sent to all tasks only if it is small
        variants = variants.join(F.broadcast(hot) if n_hot <= MAX_BROADCAST else hot, ["variant", "masked"], "left")
    else:
        variants = variants.withColumn("blocks", F.lit(1))
    # A key of g blocks: a row of block i goes to the tasks (i, j) and (j, i) with j = 0 .. g-1.
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = variants.select(
        "variant", "masked", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks")).select(
        "variant", "masked", "fp", "blocks", own.alias("own")).select(
        F.col("variant").cast("short"), "masked", "fp", F.explode(F.expr(
            "case when blocks = 1 then array(0L) else "
            "transform(sequence(0, blocks - 1), j -> cast(least(own, j) as bigint) * blocks + greatest(own, j)) end")).alias("block"))
    rows = rows.select("variant", "masked", "block", "fp").repartition("variant", "masked", "block") \
        .sortWithinPartitions("variant", "masked", "block")
    return rows.mapInArrow(_verify(d), "a long, b long").distinct()


# --- the operator ---------------------------------------------------------

def near_duplicates(docs: DataFrame, k: int = 4, d: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, fp, root, component_id): one row per input row. ``root`` is the
    component's smallest fingerprint, ``component_id`` its smallest doc_id (null ids
    count last)."""
    rows = written(fingerprints(docs, k, id_col, text_col), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "fp-classes")
    linked = components(links(classes.select("fp"), d))
    classes = classes.join(linked, classes["fp"] == linked["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = classes.select("fp", "root").join(lows, "root")
    return rows.join(classes, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, k: int = 4, d: int = 4) -> DataFrame:
    """The documents of which one is left for each group: the one with the smallest
    doc_id (null last; among equal ids the smallest row hash)."""
    found = near_duplicates(docs, k, d)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    best = found.groupBy("root").agg(F.min(order).alias("best")).select(
        F.col("best.doc_id").alias("_id"), F.col("best.row_key").alias("_key"))
    frame = packed(docs, doc_id="doc_id long", text="text string").select(
        "doc_id", F.xxhash64("doc_id", "text").alias("row_key"), ROW)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key"))  # hashes tell rows of one id apart, not documents
    kept = frame.join(best, same, "left_semi").dropDuplicates(["doc_id", "row_key"])
    return unpacked(kept, docs)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), k=4, d=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
