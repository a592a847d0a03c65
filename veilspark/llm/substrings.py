"""Substring dedup with difference-cover anchors.

A window is ``length`` consecutive words of one document. Every word goes that is
covered by a window whose words also start anywhere else, in the same document or
another, judged on the input.

1. Anchors: with a difference cover D modulo v, any two positions i, j have a shift s < v
   that brings both to D (modulo v). So of two equal windows some stretch of
   ``length - v + 1`` words starts at a cover position in both documents. Only such
   stretches are hashed: |D| of every v positions. A stretch seen twice is a hit.
2. Extension: only windows that hold a hit, aligned, can have an equal. They are hashed in
   full (96 bits), and those that start twice or more are repeated.
3. The words that repeated windows cover are removed.

Hits go back to the documents by bucket (a hash of id and text), as sets: a bucket
holds many documents, and a stretch that is repeated inside one chunk of a task is known as
a hit there, so a passage in a third of all documents is a row per chunk, not per document.
Groups of equal texts are known by their digest: one of them stands for all.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null text has none. Every input row gives one
row; repeated rows are documents of their own, and so are each other's copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.common import GROUP_BYTES, pick, read, release_shuffles, shuffle_partitions, text_groups, written

LENGTH = 35
#: A perfect difference set: any difference modulo 21 is one of two members.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
CHUNK = 400_000  # anchors that a task holds at once
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_hash = xxhash.xxh3_64_intdigest


class Rolling:
    """Hashes of all windows of a word sequence: sums of word hash x base^position, modulo 2^64."""

    def __init__(self):
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []

    def _upto(self, n: int):
        if not self.powers or len(self.powers[0][0]) < n:
            size = max(4096, 2 * n)
            self.powers = []
            for base, inverse in zip(_BASES, _INVERSES, strict=True):
                up, down = np.full(size, base), np.full(size, inverse)
                up[0] = down[0] = 1
                self.powers.append((np.cumprod(up), np.cumprod(down)))
        return self.powers

    def words(self, words: list[bytes]) -> np.ndarray:
        return np.array([_hash(w) for w in words], np.uint64)

    def windows(self, h: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
        """The hash of each window, as int64."""
        n = len(h)
        if n < length:
            return np.zeros(0, np.int64)
        up, down = self._upto(n + 1)[lane]
        if lane:
            h = (h ^ (h >> np.uint64(29))) * _MIX
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(h * up[:n], out=sums[1:])
        found = (sums[length:] - sums[:-length]) * down[:n - length + 1]
        found ^= found >> np.uint64(32)
        return (found * _MIX).view(np.int64)


def _anchors(rolling: Rolling, h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the stretches that start at cover positions."""
    found = rolling.windows(h, length - PERIOD + 1)
    at = np.arange(len(found))
    at = at[np.isin(at % PERIOD, COVER)]
    return at, found[at]


# Rows of the first shuffle: (h, who). who >= 0: the bucket where the chunk saw h, once;
# -1: the chunk saw it twice or more; -2 - bucket: h is a hit for this bucket.

def _emit_anchors(length: int):
    def flush(hashes: list[np.ndarray], buckets: list[np.ndarray]) -> pa.RecordBatch:
        h, b = np.concatenate(hashes), np.concatenate(buckets)
        order = np.lexsort((b, h))
        h, b = h[order], b[order]
        first = np.r_[True, h[1:] != h[:-1]]
        size = np.diff(np.r_[np.flatnonzero(first), len(h)])
        many = np.repeat(size > 1, size)
        hits = many & np.r_[True, (h[1:] != h[:-1]) | (b[1:] != b[:-1])]
        return pa.RecordBatch.from_pydict({
            "h": pa.array(np.concatenate([h[~many], h[first & many], h[hits]])),
            "who": pa.array(np.concatenate([b[~many], np.full((first & many).sum(), -1, np.int32), -2 - b[hits]]).astype(np.int32))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, hashes, buckets, held = Rolling(), [], [], 0
        for batch in batches:
            for bucket, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or b"").split()
                if len(words) < length:
                    continue
                _, found = _anchors(rolling, rolling.words(words), length)
                hashes.append(found)
                buckets.append(np.full(len(found), bucket, np.int32))
                held += len(found)
                if held >= CHUNK:
                    yield flush(hashes, buckets)
                    hashes, buckets, held = [], [], 0
        if held:
            yield flush(hashes, buckets)
    return run


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by h -> (bucket, h) of the stretches seen twice or more."""
    carry_h, carry_who, known = np.zeros(0, np.int64), np.zeros(0, np.int32), False

    def out(h, who):
        keep = who >= 0
        return pa.RecordBatch.from_pydict({"bucket": pa.array(who[keep]), "h": pa.array(h[keep])})

    for batch in batches:
        h, who = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        direct = who <= -2
        if direct.any():
            yield out(h[direct], -2 - who[direct])
            h, who = h[~direct], who[~direct]
        if not len(h):
            continue
        if len(carry_h) and carry_h[0] != h[0]:
            known = False  # a lone row is dropped; longer runs have been given out
        elif len(carry_h):
            if not known:
                h, who = np.r_[carry_h, h], np.r_[carry_who, who]
        first = np.r_[True, h[1:] != h[:-1]]
        starts = np.flatnonzero(first)
        size = np.diff(np.r_[starts, len(h)])
        several = size > 1
        # a chunk that saw h twice sends -1: one such row is enough
        several |= np.logical_or.reduceat(who == -1, starts)
        if known:
            several[0] = True
        yield out(h[np.repeat(several, size)], who[np.repeat(several, size)])
        carry_h, carry_who, known = h[-1:], who[-1:], bool(several[-1])


# Windows of a bucket: 64 and 32 bits of their hashes, and a flag.
# LONE: one document of the bucket has it, once; MANY: it is known to start twice or
# more, and a pending document has it; OUTSIDE: as MANY, but no pending document has it.
LONE, MANY, OUTSIDE = 0, 1, 2
MARKED = ("bucket int, doc_id long, n_words long, n_removed long, kept binary, text binary, "
          "h1 binary, h2 binary, flags binary")


def _second(rolling: Rolling, h: np.ndarray, length: int) -> np.ndarray:
    return (rolling.windows(h, length, 1) >> np.int64(32)).astype(np.int32)


def _kept(words: list[bytes], covered: np.ndarray | None) -> bytes:
    return b" ".join(words if covered is None else [w for w, gone in zip(words, covered, strict=True) if not gone])


def _marked(length: int):
    """A bucket's documents, with its hits -> finished documents, pending ones, and its windows."""
    def run(key, docs: pa.Table, hits: pa.Table) -> pa.Table:
        rolling, bucket = Rolling(), key[0].as_py()
        at_hit = hits.column("h").to_numpy()
        digests = hits.column("digest").to_pylist()
        copies = {d: (n, w) for d, n, w in zip(digests, hits.column("n").to_pylist(), hits.column("rep").to_pylist(),
                                               strict=True) if d is not None}
        known = np.unique(at_hit[np.array([d is None for d in digests], bool)]) if len(digests) else np.zeros(0, np.int64)
        rows, found = [], []
        for doc_id, text in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=True):
            words = (text or b"").split()
            n = len(words)
            weight, pending, emit = 1, False, n >= length
            if n >= length and copies:
                digest = hashlib.md5(text).digest()
                if digest in copies:
                    times, stands = copies[digest]
                    weight, emit = 2, stands
                    copies[digest] = (times, False)  # the first in this bucket stands for all
            if emit:
                h = rolling.words(words)
                at, hashes = _anchors(rolling, h, length)
                hit = np.zeros(n + 1, np.int64)
                if len(known):
                    place = np.searchsorted(known, hashes)
                    hit[at + 1] = known[np.minimum(place, len(known) - 1)] == hashes
                sums = np.cumsum(hit)
                starts = np.arange(n - length + 1)
                some = np.flatnonzero(sums[starts + PERIOD] - sums[starts])
                if len(some):
                    pending = weight == 1
                    found.append((rolling.windows(h, length)[some], _second(rolling, h, length)[some],
                                  np.full(len(some), weight, np.int32), np.full(len(some), pending)))
            if weight == 2:
                rows.append((bucket, doc_id, n, n, hashlib.sha256(b"").digest(), None))
            elif pending:
                rows.append((bucket, doc_id, n, None, None, text))
            else:
                rows.append((bucket, doc_id, n, 0, hashlib.sha256(_kept(words, None)).digest(), None))
        rows = [(*r, None, None, None) for r in rows]
        if found:
            h1, h2, weight, pending = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((h2, h1))
            h1, h2, weight, pending = (x[order] for x in (h1, h2, weight, pending))
            first = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            inside = np.logical_or.reduceat(pending, first)
            flags = np.where(np.add.reduceat(weight, first) == 1, LONE, np.where(inside, MANY, OUTSIDE)).astype(np.uint8)
            rows.append((bucket, None, None, None, None, None, *(x.tobytes() for x in (h1[first], h2[first], flags))))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * 5
        cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                    [x.split()[0] for x in MARKED.split(", ")])
    return run


# Rows of the second shuffle: (h1, h2, who). who: the bucket of a LONE window, -1 of an
# OUTSIDE one, -2 - bucket of one of MANY.

def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, h1, h2, flags in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            flags = np.frombuffer(flags, np.uint8)
            who = np.where(flags == LONE, bucket, np.where(flags == OUTSIDE, -1, -2 - bucket)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(h1, "<i8")), pa.array(np.frombuffer(h2, "<i4")), pa.array(who)], ["h1", "h2", "who"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h1, h2) -> (bucket, h1, h2) of windows that start twice or more."""
    held, known = None, False
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if not len(cols[0]):
            continue
        if held is not None and (held[0][0] != cols[0][0] or held[1][0] != cols[1][0]):
            known = False  # a lone row is dropped; longer runs have been given out
        elif held is not None and not known:
            cols = [np.r_[a, b] for a, b in zip(held, cols, strict=True)]
        h1, h2, who = cols
        starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        size = np.diff(np.r_[starts, len(h1)])
        several = (size > 1) | np.logical_or.reduceat(who < 0, starts)
        if known:
            several[0] = True
        keep = np.repeat(several, size) & (who != -1)
        bucket = np.where(who < 0, -2 - who, who)[keep]
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(h1[keep]), pa.array(h2[keep])], ["bucket", "h1", "h2"])
        held, known = [c[-1:] for c in cols], bool(several[-1])


DONE = "doc_id long, n_words long, n_removed long, kept binary"


def _finished(length: int):
    """A bucket's pending documents, with its repeated windows."""
    def run(docs: pa.Table, windows: pa.Table) -> pa.Table:
        rolling = Rolling()
        h1, h2 = (windows.column(x).to_numpy() for x in ("h1", "h2"))
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        most = int(np.unique(h1, return_counts=True)[1].max()) if len(h1) else 0
        rows = []
        for doc_id, text in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=True):
            words = text.split()
            n = len(words)
            h = rolling.words(words)
            w1, w2 = rolling.windows(h, length), _second(rolling, h, length)
            hit = np.zeros(len(w1), bool)
            place = np.searchsorted(h1, w1)
            for step in range(most):
                at = np.minimum(place + step, len(h1) - 1)
                hit |= (h1[at] == w1) & (h2[at] == w2)
            edge = np.zeros(n + 1, np.int64)
            edge[:len(hit)] += hit
            edge[length:length + len(hit)] -= hit
            covered = np.cumsum(edge)[:n] > 0
            rows.append((doc_id, n, int(covered.sum()), hashlib.sha256(_kept(words, covered.tolist())).digest()))
        cols = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                    [x.split()[0] for x in DONE.split(", ")])
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept is the SHA-256 of the words left, joined by one space.

    The number of buckets of documents, each of which a task holds whole, follows the bytes of all texts.
    A text is held whole, however long."""
    if length < PERIOD:
        raise ValueError(f"windows need {PERIOD} words at least")
    spark = docs.sparkSession
    marked = _mark(docs, length, id_col, text_col, group_bytes)
    release_shuffles(spark)
    windows = marked.filter("h1 is not null").select("bucket", "h1", "h2", "flags").mapInArrow(_windows, "h1 long, h2 int, who int")
    repeated = windows.repartition(shuffle_partitions(spark), "h1", "h2").sortWithinPartitions("h1", "h2").mapInArrow(
        _repeated, "bucket int, h1 long, h2 int")
    pending = marked.filter("text is not null").select("bucket", "doc_id", "text")
    later = pending.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInArrow(_finished(length), DONE)
    return marked.filter("kept is not null").select("doc_id", "n_words", "n_removed", "kept").unionAll(later)


def _mark(docs: DataFrame, length: int, id_col: str, text_col: str, group_bytes: int) -> DataFrame:
    """Steps 1 and 2 up to the windows' hashes, written."""
    spark = docs.sparkSession
    n_buckets = text_groups(docs, text_col, group_bytes)
    frame = pick(docs, doc_id=f"{id_col} long", text=f"{text_col} string").select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_buckets)).cast("int").alias("bucket"), "doc_id",
        F.col("text").cast("binary").alias("text"))
    anchors = frame.select("bucket", "text").mapInArrow(_emit_anchors(length), "h long, who int")
    by = F.when(F.col("who") <= -2, F.col("who").cast("long")).otherwise(F.col("h"))
    hits = anchors.repartition(shuffle_partitions(spark), by).sortWithinPartitions("h").mapInArrow(_hits, "bucket int, h long")
    # equal texts: the one with the smallest id stands for its group
    texts = written(frame.select("bucket", "doc_id", F.unhex(F.md5("text")).alias("digest")), "digests")
    groups = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "bucket")).alias("least")) \
        .filter("n > 1 and digest is not null")
    copies = texts.groupBy("digest", "bucket").agg(F.min(F.struct("doc_id", "bucket")).alias("own")).join(groups, "digest").select(
        "bucket", F.lit(0).cast("long").alias("h"), "digest", "n", F.col("own").eqNullSafe(F.col("least")).alias("rep"))
    none = [F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("boolean").alias("rep")]
    known = hits.select("bucket", "h", *none).unionAll(copies)
    return written(frame.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_marked(length), MARKED), "marked")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256"))
