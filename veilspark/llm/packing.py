"""Best-fit packing by large-item matching.

Texts become token ids (a ``tokenizers`` file), each document ends with id 0, and
documents longer than the capacity are cut into pieces of the capacity, of which
the first may be shorter. Pieces are packed into sequences:

* pieces above a third of the capacity are large: at most two fit a sequence. In
  falling order each takes the longest large piece left that fits beside it;
* the smaller ones, in falling order, go into the tightest gap that holds them,
  several at once if they fit, and open new sequences when no gap is left.

Pieces of equal length are interchangeable, so the plan is made from the number of
pieces of each length: at most ``capacity`` rows on the driver, however large the
corpus. A plan row says: of this length, from this rank on, so many pieces go to
consecutive sequences from this one on. Ranks within a length come from the
tasks (a count per task and length, summed by a window over the tasks' counts), so
no length is gathered in one task; every piece then finds its plan row by bisection.

The tokenizer works on chunks that end before white space (there no token of a
byte-level BPE that splits at white space can cross); their ids are kept per worker
in two generations of ``MAX_CHUNKS`` entries, the older of which is dropped in time.

The ids are those of the library's defaults: added tokens, special ones too, are
split off before the words (``encode_special_tokens`` takes special ones as plain text).

Null text counts as empty: one piece with id 0 only. Repeated rows and null ids are
documents of their own. No documents: no pieces.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import pick, read, written

CAPACITY = 2048
END_ID = b"\0\0\0\0"
MAX_CHUNKS = 400_000
TOKENIZER = "byte_bpe_50k.json"
_ODD = re.compile(r"[^\S \n]|[ \n]{2}")  # white space that the short way doesn't know
_CHUNK = re.compile(r"(?<=\S)(?=\s)")


# A word of Latin letters, and punctuation after it: two pieces for the tokenizer, whatever follows.
_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")


def byte_signs() -> list[str]:
    """The sign that byte-level BPE writes for each byte: itself if printable, else one from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


class TokenTable:
    """Ids of a text as little-endian unsigned 32-bit integers. ``encode_special_tokens``: special tokens in it are plain text."""

    def __init__(self, spec: str, encode_special_tokens: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        added = [(i, t) for i, t in self.tokenizer.get_added_tokens_decoder().items() if not (t.special and encode_special_tokens)]
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added}
        # the library takes the longest of those that begin leftmost
        self.split = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        # tokens that also depend on what stands around them are left to the library, with the whole text
        self.whole = any(t.single_word or t.lstrip or t.rstrip or (t.normalized and self.tokenizer.normalizer) for _, t in added)
        self.signs = byte_signs()
        # Each with a younger and an older generation: what is asked for again stays.
        self.spaced = [{}, {}]  # by what follows a space; from a line feed on: by itself
        self.plain = [{}, {}]

    def _model(self, word: str) -> bytes:
        """A space and letters, which is one piece for the model."""
        text = word if word.isascii() else "".join([self.signs[b] for b in word.encode()])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(self.signs[0x20] + text)]).tobytes()

    def _encode(self, chunks: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(chunks, add_special_tokens=False)]

    def _room(self, tables: list[dict], n: int) -> None:
        if len(tables[0]) + n > MAX_CHUNKS:
            tables[1], tables[0] = tables[0], {}

    def _learn(self, tables: list[dict], words: list[str], spaced: bool) -> None:
        """Puts all words into the younger generation."""
        self._room(tables, len(words))
        young, old = tables
        rest = []
        for w in {w for w in words if w not in young}:
            if (ids := old.get(w)) is not None:
                young[w] = ids
            elif spaced and (m := _WORD.fullmatch(w)):
                core, tail = m.groups()
                ids = young.get(core) or old.get(core)
                if ids is None:
                    ids = young[core] = self._model(core)
                if tail:
                    young[w] = ids + self._join(self.plain, [tail], False)
            else:
                rest.append(w)
        young.update(zip(rest, self._encode([" " + w if spaced and w[:1] != "\n" else w for w in rest]), strict=True))

    def _join(self, tables: list[dict], words: list[str], spaced: bool) -> bytes:
        try:
            young = tables[0]
            return b"".join([young[w] for w in words])
        except KeyError:
            self._learn(tables, words, spaced)
            young = tables[0]
            return b"".join([young[w] for w in words])

    def ids(self, text: str) -> bytes:
        if self.whole:
            return self._encode([text])[0]
        if self.split and self.split.search(text):
            return b"".join([self.added.get(x) or self._ids(x) for x in self.split.split(text) if x])
        return self._ids(text)

    def _ids(self, text: str) -> bytes:
        if _ODD.search(text):
            return self._join(self.plain, _CHUNK.split(text), False)
        head, *words = text.replace("\n", " \n").split(" ")
        return self._join(self.plain, [head], False) + self._join(self.spaced, words, True)


def token_table(spec: str, encode_special_tokens: bool = False) -> TokenTable:
    """One for each worker, tokenizer and way with special tokens."""
    held = sys.modules.setdefault("_veilspark_tokens", types.ModuleType("_veilspark_tokens"))
    key = f"t{zlib.crc32(spec.encode())}_{encode_special_tokens}"
    if not hasattr(held, key):
        setattr(held, key, TokenTable(spec, encode_special_tokens))
    return getattr(held, key)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


PIECES = "task int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(spec: str, capacity: int, encode_special_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, task, seen = token_table(spec, encode_special_tokens), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = table.ids(text or "") + END_ID
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((task, seen[length], doc_id, piece, start, length,
                                zlib.crc32(ids[4 * start:4 * (start + length)])))
                    seen[length] += 1
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             [x.split()[0] for x in PIECES.split(", ")])
    return run


# --- the plan -------------------------------------------------------------

class Plan:
    """Rows (length, first rank, pieces, first sequence, pieces a sequence, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences, self.rows = capacity, 0, []
        self.left, self.used = dict(counts), Counter()
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)
        self.order: list[int] = []  # the gaps there are
        lengths = sorted(counts, reverse=True)
        large = [x for x in lengths if 3 * x > capacity]
        self._match(large)
        for x in lengths[len(large):]:
            self._fit(x)

    def _put(self, length: int, n: int, first: int, each: int, offset: int) -> None:
        self.rows.append((length, self.used[length], n, first, each, offset))
        self.used[length] += n
        self.left[length] -= n

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _gap(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self.gaps:
                self.gaps[gap] = []
                insort(self.order, gap)
            self.gaps[gap].append((first, n))

    def _match(self, large: list[int]) -> None:
        rising = sorted(large)
        for x in large:
            while n := self.left[x]:
                at = bisect_left(rising, self.capacity - x + 1) - 1  # the longest partner that fits
                while at >= 0 and (not self.left[rising[at]] or rising[at] == x and n < 2):
                    at -= 1
                if at < 0:
                    first = self._open(n)
                    self._put(x, n, first, 1, 0)
                    self._gap(self.capacity - x, first, n)
                    break
                y = rising[at]
                pairs = n // 2 if x == y else min(n, self.left[y])
                first = self._open(pairs)
                self._put(x, pairs, first, 1, 0)
                self._put(y, pairs, first, 1, x)
                self._gap(self.capacity - x - y, first, pairs)

    def _fill(self, length: int, first: int, n: int, gap: int) -> None:
        """Pieces into up to n sequences that have this gap."""
        each, offset = gap // length, self.capacity - gap
        full = min(n, self.left[length] // each)
        if full:
            self._put(length, full * each, first, each, offset)
            self._gap(gap - each * length, first, full)
        if full < n:
            some = self.left[length]
            if some:
                self._put(length, some, first + full, some, offset)
                self._gap(gap - some * length, first + full, 1)
                full += 1
            self._gap(gap, first + full, n - full)

    def _fit(self, length: int) -> None:
        while self.left[length]:
            at = bisect_left(self.order, length)
            if at == len(self.order):
                each = self.capacity // length
                n = -(-self.left[length] // each)
                self._fill(length, self._open(n), n, self.capacity)
                return
            gap = self.order[at]
            first, n = self.gaps[gap].pop()
            if not self.gaps[gap]:
                del self.gaps[gap], self.order[at]
            self._fill(length, first, n, gap)

    def lookup(self):
        """(lengths, ranks) -> (sequence ids, offsets), by bisection."""
        a = np.array(sorted(self.rows), np.int64).reshape(-1, 6)
        keys = (a[:, 0] << 44) + a[:, 1]

        def find(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            row = a[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            at = rank - row[:, 1]
            return row[:, 3] + at // row[:, 4], row[:, 5] + at % row[:, 4] * length
        return find


def _assign(find):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("length", "rank"))
            sequence, offset = find(length, rank)
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), pa.array(sequence), pa.array(offset)],
                                             [*kept, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, spec: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         encode_special_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. ``spec``: a tokenizers JSON text;
    ``encode_special_tokens``: special tokens that stand in a text are plain text."""
    frame = pick(docs, doc_id=f"{id_col} long", text=f"{text_col} string")
    pieces = written(frame.mapInArrow(_pieces(spec, capacity, encode_special_tokens), PIECES), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    counts = written(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    find = Plan({r["length"]: r["n"] for r in lengths}, capacity).lookup()
    ranked = pieces.join(counts.select("task", "length", "base"), ["task", "length"]).withColumn(
        "rank", F.col("rank") + F.col("base"))
    return ranked.mapInArrow(_assign(find), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                            "sequence_id long, offset long")


def tokenizer_spec(path: str | None = None) -> str:
    """The text of a tokenizers file; by default the public byte-level BPE."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_spec(), CAPACITY)
