import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers import empty, frame, mixed_docs
from pyspark.sql import functions as F

from veilspark.llm import common as C
from veilspark.llm import lines as L


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, min_docs):
    n = Counter(k for _, t, *_ in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t, *_ in rows:
        own = (t or "").split("\n")
        left = [x for x in own if n[key(x)] < min_docs]
        out.append((i, len(own), len(own) - len(left), "\n".join(left)))
    return out


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("min_docs", [2, 10])
def test_matches_brute_force(spark, min_docs):
    rows = mixed_docs()
    got = L.dedup_lines(frame(spark, rows), min_docs).select(
        "_row._c0", "n_lines", "n_dropped", F.col("kept").cast("string")).collect()
    assert order(tuple(r) for r in got) == order(brute(rows, min_docs))
    assert any(r[2] for r in got)


def test_stage_keeps_columns_and_drops_lines(spark):
    rows = mixed_docs()
    docs = frame(spark, rows)
    out = L.dedup_lines_stage(docs, 10)
    assert out.schema.simpleString() == docs.schema.simpleString()
    want = {(i, t) for i, _, _, t in brute(rows, 10)}
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) and r["key"] == "k" for r in out.collect())


def test_groups_follow_the_bytes(spark):
    rows = mixed_docs()
    one, ten = frame(spark, rows), frame(spark, rows * 10)
    few = C.text_groups(one, "text", 100)
    assert 9.9 * few < C.text_groups(ten, "text", 100) <= 10 * few
    assert C.text_groups(one, "text") == C.text_groups(empty(spark), "text") == 8 * C.shuffle_partitions(spark)
    got = [sorted(map(tuple, L.dedup_lines(one, 10, group_bytes=b).select("n_lines", "n_dropped", "kept").collect())) for b in (200, 1 << 30)]
    assert got[0] == got[1]


def test_empty_table(spark):
    assert L.dedup_lines(empty(spark)).count() == 0


def state(index):
    return {(bytes(r["key"]), r["n_docs"]) for r in index.counts.collect()}


def test_deletion_undoes_insertion(spark):
    rows = mixed_docs()
    a, b = (L.line_table(frame(spark, x), 8) for x in (rows[:70], rows[70:]))
    both = L.line_table(frame(spark, rows), 8)
    index = L.insert(L.empty_index(spark, 3, 5), a)
    before = state(index)
    index = L.insert(index, b)
    assert state(index) == state(L.insert(L.empty_index(spark, 3, 5), both))
    full = {bytes(r["key"]) for r in L.dropped_keys(index, both).collect()}
    n = Counter(L.line_key(x.encode()) for _, t, *_ in rows for x in {key(y) for y in (t or "").split("\n")} if x)
    assert full == {k for k, v in n.items() if v >= 3}
    index = L.delete(index, b)
    assert state(index) == before
    n = Counter(L.line_key(x.encode()) for _, t, *_ in rows[:70] for x in {key(y) for y in (t or "").split("\n")} if x)
    assert {bytes(r["key"]) for r in L.dropped_keys(index, both).collect()} == {k for k, v in n.items() if v >= 3}


def keys(n, seed):
    return np.frombuffer(hashlib.shake_128(str(seed).encode()).digest(16 * n), "<u8").reshape(-1, 2)


def test_cuckoo_filter():
    f, mine, others = L.CuckooFilter.sized(2000), keys(2000, 1), keys(20000, 2)
    assert all(f.add(k) for k in mine)
    assert f.contains(mine).all()
    assert f.contains(others).mean() < 0.002
    f = L.CuckooFilter.from_bytes(f.to_bytes())
    assert all(f.remove(k) for k in mine[:1000])
    assert f.contains(mine[1000:]).all()
    assert f.contains(mine[:1000]).mean() < 0.01
    small = L.CuckooFilter.sized(1)
    assert not all(small.add(k) for k in mine)
