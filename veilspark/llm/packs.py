"""Packing by shortest pack first over the length histogram.

Texts become token ids (a ``tokenizers`` file) and each document ends with ``end_id``. Whole
multiples of the capacity are cut off its front; these pieces fill a sequence each. The rest of
each document, shorter than the capacity, is packed:

* Lengths are placed longest first. A length goes to the shortest packs that it fits, which are
  those with the most room, and opens new ones when none has room. Packs alike are a pattern with
  a count; placing a length moves a count to a new pattern. So the plan is made from the number of
  documents of each length and is as large for any corpus: at most two patterns a length are open.
* What room is left is closed by cutting. The emptiest packs are taken apart until their ids are
  as many as the room in the others; one after the other these ids, in order, fill that room. What
  is over, less than a sequence, goes into sequences of power-of-two lengths, which need no padding.
  ``close=False`` leaves the packs as they are, and no rest is cut.

Documents of equal length are interchangeable: each has a rank in its length (ranks in its task,
moved by the counts of the tasks before), and finds its pack by its rank. A cut piece's ids come
from the written rests, which only documents that are cut are joined with.

The tokenizer sees words between spaces and line feeds; their ids are kept per worker in two
generations of ``MAX_WORDS`` entries, the older of which is dropped in time. Ids are those of the
library's defaults, with added tokens split off.

Null text counts as empty: a document of ``end_id`` only. Repeated rows and null ids are documents
of their own; which of equally long ones goes where is arbitrary. A very long text is cut into many
pieces. No documents: no pieces.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from array import array
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import pick, read, written
from veilspark.llm.packing import byte_signs, tokenizer_spec

CAPACITY, END_ID = 4096, 2
MAX_WORDS = 400_000
TOKENIZER = "word_bpe_49k.json"
# Letters that are one code point in any case and normal form, and punctuation after them.
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


# --- ids ------------------------------------------------------------------

class WordTable:
    """Ids of a text as little-endian unsigned 32-bit integers, looked up by word.

    For tokenizers that take words between white space by themselves. Words of letters are given to the model at
    once if the tokenizer is one that lower-cases them, marks their bytes by signs and takes a run of letters as one piece."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        added = self.tokenizer.get_added_tokens_decoder().values()
        alone = self._alone("Ab cd", "Abcd,. x", "É,(e\nz")
        # added tokens that stand across words or depend on them are left to the library, with the whole text
        self.whole = not alone or any(t.single_word or t.lstrip or t.rstrip or t.normalized or re.search(r"[ \n]", t.content) for t in added)
        self.letters = not any(re.search(r"^[a-zA-Z]+[!-/:-@\[-`{-~]*$", t.content) for t in added) and self._by_letters()
        self.signs = byte_signs()
        self.tables: list[dict[str, bytes]] = [{}, {}]

    def _encode(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _alone(self, *texts: str) -> bool:
        """Spaces and line feeds have no ids and part the words on both sides."""
        return all(self._encode([t]) == [b"".join(self._encode(re.split(r"[ \n]", t)))] for t in texts)

    def _by_letters(self) -> bool:
        self.signs = byte_signs()
        tried = ["The", "Ça", "don", "ÑÀÿß", "Xyzzyqua", "a"]
        return self._encode(tried) == [self._letters(w) for w in tried]

    def _letters(self, word: str) -> bytes:
        text = word.lower()
        if not text.isascii():
            text = "".join([self.signs[b] for b in text.encode()])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """All words into the younger generation."""
        if len(self.tables[0]) + len(words) > MAX_WORDS:
            self.tables = [{}, self.tables[0]]
        young, old = self.tables
        rest, tails = [], []
        for w in {w for w in words if w not in young}:
            if (ids := old.get(w)) is not None:
                young[w] = ids
            elif self.letters and (m := _WORD.fullmatch(w)):
                core, tail = m.groups()
                ids = young.get(core) or old.get(core)
                young[core] = self._letters(core) if ids is None else ids
                if tail:
                    tails.append((w, core, tail))
            else:
                rest.append(w)
        rest = list({*rest, *(t for *_, t in tails if t not in young)})
        young.update(zip(rest, self._encode(rest), strict=True))
        for w, core, tail in tails:
            young[w] = young[core] + young[tail]
        return young

    def ids(self, text: str) -> bytes:
        if self.whole:
            return self._encode([text])[0]
        words = text.replace("\n", " ").split(" ")
        young = self.tables[0]
        try:
            return b"".join([young[w] for w in words])
        except KeyError:
            young = self._learn(words)
            return b"".join([young[w] for w in words])


def word_table(spec: str) -> WordTable:
    """One for each worker and tokenizer."""
    held = sys.modules.setdefault("_veilspark_words", types.ModuleType("_veilspark_words"))
    key = f"t{zlib.crc32(spec.encode())}"
    if not hasattr(held, key):
        setattr(held, key, WordTable(spec))
    return getattr(held, key)


PIECES = "task int, rank long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
_PIECE_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _pieces(spec: str, capacity: int, end_id: int, keep: bool):
    """Full pieces and rests; rests with their ids if ``keep``, as 16-bit integers where all fit."""
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, task, seen = word_table(spec), TaskContext.get().partitionId(), Counter()
        narrow = max(table.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = table.ids(text or "") + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    part = ids[4 * start:4 * (start + capacity)]
                    length = len(part) // 4
                    held = None if length == capacity or not keep else np.frombuffer(part, "<u4").astype("<u2").tobytes() if narrow else part
                    out.append((task, seen[length], doc_id, start, length, zlib.crc32(part), n, held))
                    seen[length] += 1
            cols = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PIECE_TYPES, strict=True)],
                                             [x.split()[0] for x in PIECES.split(", ")])
    return run


# --- the plan -------------------------------------------------------------

class Packs:
    """Rows (length, first rank, pieces, first pack, offset) from the number of pieces of each length.

    ``open``: room -> ranges (first pack, packs) that have it."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.packs, self.rows = capacity, 0, []
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []  # of the open packs, rising
        for length in sorted(counts, reverse=True):
            self._place(length, counts[length])
        self.closed = self.packs

    def _room(self, room: int, first: int, n: int) -> None:
        if room and n:
            if room not in self.open:
                self.open[room] = []
                insort(self.rooms, room)
            self.open[room].append((first, n))

    def _place(self, length: int, n: int) -> None:
        rank = 0
        while n:
            if self.rooms and self.rooms[-1] >= length:  # the shortest packs
                room = self.rooms[-1]
                first, packs = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room], self.rooms[-1]
                some = min(n, packs)
                self.rows.append((length, rank, some, first, self.capacity - room))
                self._room(room - length, first, some)
                self._room(room, first + some, packs - some)
                rank, n = rank + some, n - some
            else:  # a new one takes as many as fit before the next is opened
                each = min(n, self.capacity // length)
                new, first = n // each, self.packs
                for i in range(each):
                    self.rows.append((length, rank + i * new, new, first, i * length))
                self.packs += new
                self._room(self.capacity - each * length, first, new)
                rank, n = rank + each * new, n - each * new

    def padded(self, room: int) -> bool:
        size = self.capacity - room
        return size & (size - 1) != 0  # a power of two isn't padded

    def close(self) -> Close:
        """What is taken apart, and the room it goes to."""
        ranges = [(room, first, n) for room in reversed(self.rooms) if self.padded(room) for first, n in self.open[room]]
        room_left = sum(room * n for room, _, n in ranges)
        apart: list[tuple[int, int, int]] = []  # (first pack, packs, ids of each)
        total = 0
        for i, (room, first, n) in enumerate(ranges):
            # each pack taken apart adds its ids to those to place and takes its room away: the difference shrinks by the capacity
            need = -(-(room_left - total) // self.capacity)
            some = max(0, min(n, need))
            if some:
                apart.append((first, some, self.capacity - room))
                total += some * (self.capacity - room)
                room_left -= some * room
            if some < n:
                rest = [(room, first + some, n - some), *ranges[i + 1:]]
                break
        else:
            rest = []
        return Close(self, apart, rest, total - room_left)


class Close:
    """Two lines of ids, of the packs taken apart and of the room in the others: equal places belong together."""

    def __init__(self, packs: Packs, apart: list[tuple[int, int, int]], rest: list[tuple[int, int, int]], over: int):
        self.apart = sorted(apart)
        self.apart_first = [first for first, *_ in self.apart]
        self.apart_base = np.concatenate([[0], np.cumsum([n * size for _, n, size in self.apart], dtype=np.int64)]).tolist()
        # room: (base on the line, first sequence, size of each room, offset in the sequence)
        self.rooms: list[tuple[int, int, int, int]] = []
        base = 0
        for room, first, n in rest:
            self.rooms.append((base, first, room, packs.capacity - room))
            base += n * room
        sequence = packs.packs
        for bit in reversed(range(packs.capacity.bit_length())):
            if over >> bit & 1:
                self.rooms.append((base, sequence, 1 << bit, 0))
                base, sequence = base + (1 << bit), sequence + 1
        self.room_base = [r[0] for r in self.rooms]
        self.end = base

    def where(self, pack: int, offset: int) -> int | None:
        """The place on the line of what lies here, if the pack is taken apart."""
        i = bisect_right(self.apart_first, pack) - 1
        if i < 0 or pack >= self.apart_first[i] + self.apart[i][1]:
            return None
        first, _, size = self.apart[i]
        return self.apart_base[i] + (pack - first) * size + offset

    def cut(self, place: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the parts."""
        at = 0
        while at < length:
            now = place + at
            base, first, room, offset = self.rooms[bisect_right(self.room_base, now) - 1]
            k, inside = divmod(now - base, room)
            n = min(length - at, room - inside)
            yield at, n, first + k, offset + inside
            at += n


ASSIGNED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
            "task int, rank long, rest_length long, inside long")
_ASSIGNED_TYPES = [*[pa.int64()] * 7, pa.int32(), *[pa.int64()] * 3]


def _assign(packs: Packs, close: Close | None):
    a = np.array(sorted(packs.rows), np.int64).reshape(-1, 5)
    keys = (a[:, 0] << 44) + a[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "rank", "base")}
            rank = b["rank"] + b["base"]
            row = a[np.searchsorted(keys, (b["length"] << 44) + rank, side="right") - 1]
            pack, offset = (row[:, 3] + rank - row[:, 1]).tolist(), row[:, 4].tolist()
            out = []
            for i, (doc_id, start, length, crc, n, task, own) in enumerate(zip(*(batch.column(x).to_pylist() for x in (
                    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank")), strict=True)):
                place = close.where(pack[i], offset[i]) if close else None
                if place is None:
                    out.append((doc_id, start, length, crc, n, pack[i], offset[i], task, own, length, 0))
                    continue
                parts = list(close.cut(place, length))
                for at, size, sequence, to in parts:
                    out.append((doc_id, start + at, size, crc if len(parts) == 1 else None, n, sequence, to, task, own, length, at))
            cols = list(zip(*out, strict=True)) or [()] * 11
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ASSIGNED_TYPES, strict=True)],
                                             [x.split()[0] for x in ASSIGNED.split(", ")])
    return run


RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = []
        for ids, whole, at, n in zip(*(batch.column(x).to_pylist() for x in ("ids", "rest_length", "inside", "length")), strict=True):
            kind = "<u2" if len(ids) == 2 * whole else "<u4"
            crcs.append(zlib.crc32(np.frombuffer(ids, kind)[at:at + n].astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(crcs, pa.int64()) if x == "ids_crc32" else batch.column(x) for x in RESULT], RESULT)


def pack(docs: DataFrame, spec: str, capacity: int = CAPACITY, end_id: int = END_ID, close: bool = True,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``spec``: a tokenizers JSON text."""
    frame = pick(docs, doc_id=f"{id_col} long", text=f"{text_col} string")
    pieces = written(frame.mapInArrow(_pieces(spec, capacity, end_id, close), PIECES), "rests")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    counts = written(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "rest-counts")
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    packs = Packs({r["length"]: r["n"] for r in lengths}, capacity)
    ranked = pieces.drop("ids").join(counts.select("task", "length", "base"), ["task", "length"])
    assigned = ranked.mapInArrow(_assign(packs, packs.close() if close else None), ASSIGNED)
    if not close:
        return assigned.select(*RESULT)
    assigned = written(assigned, "assigned")
    cut = assigned.filter(F.col("ids_crc32").isNull())
    held = pieces.filter(F.col("ids").isNotNull()).select("task", "rank", F.col("length").alias("rest_length"), "ids")
    parts = cut.join(held, ["task", "rank", "rest_length"])
    return assigned.filter(F.col("ids_crc32").isNotNull()).select(*RESULT).unionAll(
        parts.mapInArrow(_hashed, ", ".join(f"{x} long" for x in RESULT)))


def word_tokenizer_spec(path: str | None = None) -> str:
    """The text of a tokenizers file; by default the public BPE with word ends."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return tokenizer_spec(path)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), word_tokenizer_spec(), CAPACITY, END_ID)
