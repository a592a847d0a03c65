import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import empty, frame, mixed_docs, words

from veilspark.llm import treap as T

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k):
    """(item, rank, doc_id, score) of every item against every document."""
    docs = [(i, Counter(brute_terms(t))) for i, t, *_ in rows]
    n = sum(1 for _, c in docs if c)
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(brute_terms(t))
    out = []
    for i, terms in asked.items():
        found = []
        for doc_id, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2.0 * n + 2) / (2.0 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                found.append((-s, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda x: x[:3])
        out += [(i, r, x[3], -x[0]) for r, x in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")


ITEMS = [(1, "w1 w2 w3"), (2, "W7, w7! w300"), (3, None), (4, ""), (5, "nothing-here absent"), (6, words(random.Random(3), 60)),
         (7, "é ñ 日本 Is"), (8, "w1 " * 50), (None, "w5 w6"), (9, "w9"), (9, "w10 w9"), (10, words(random.Random(4), 3000, 100000))]


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_terms_are_those_of_the_pattern():
    rnd = random.Random(1)
    for _ in range(500):
        text = "".join(rnd.choice("aZ09 _-.,\n\t\x00\x1c\x7f\x85éÉßİ日　'@[`{/:") for _ in range(rnd.randrange(60)))
        assert [t.decode() for t in T.terms_of(text.encode())] == brute_terms(text)


@pytest.mark.parametrize("k", [1, 50])
def test_search_is_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(T, "BLOCK_DOCS", 17)
    monkeypatch.setattr(T, "STEP", 3)
    rows = mixed_docs()
    got = found(T.search(T.build(frame(spark, rows)), items_of(spark, ITEMS), k))
    assert got == brute(rows, ITEMS, k)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, "same text here", "en", "s") for i in range(300, 0, -1)] + [(1000 + i, words(random.Random(i), 30), "en", "s") for i in range(300)]
    got = found(T.search(T.build(frame(spark, rows).repartition(5)), items_of(spark, [(1, "same text")]), 20))
    assert [x[2] for x in sorted(got, key=lambda x: x[1])] == list(range(1, 21))
    assert got == brute(rows, [(1, "same text")], 20)


def test_chunks_of_items(spark, monkeypatch):
    rows = mixed_docs(5, 20)
    monkeypatch.setattr(T, "CHUNK_ITEMS", 3)
    monkeypatch.setattr(T, "CHUNK_TERMS", 700)
    assert found(T.search(T.build(frame(spark, rows)), items_of(spark, ITEMS), 4)) == brute(rows, ITEMS, 4)


def test_empty(spark):
    assert found(T.search(T.build(empty(spark)), items_of(spark, ITEMS))) == []
    assert found(T.search(T.build(frame(spark, mixed_docs())), items_of(spark, []))) == []
    assert found(T.search(T.build(frame(spark, [(1, "...", "en", "s"), (2, None, "en", "s")])), items_of(spark, ITEMS))) == []


@pytest.mark.parametrize("seed", range(8))
def test_treap_holds_the_grid(seed):
    """Every cell, and every maximum on the way to it; grids of any shape."""
    rnd = np.random.default_rng(seed)
    a, b = rnd.integers(0, 9, 2)
    n = int(rnd.integers(1, min(200, 1 << (a + b)) + 1))
    cells = rnd.choice(1 << (a + b), n, replace=False)
    row, col, value = cells >> b, cells & ((1 << b) - 1), rnd.integers(1, 1000, n)
    tree = T.Treap(a, b, **T.encode(row, col, value, int(a), int(b)))
    grid = np.zeros((1 << a, 1 << b), np.int64)
    grid[row, col] = value
    rows = np.arange(1 << a)
    bits, node = tree.start(rows)
    left, ranges, nodes = int(bits), [(0, 1 << int(b))], node[None, :]
    while True:
        for (low, high), x in zip(ranges, nodes, strict=True):
            assert (tree.best[x] >= grid[:, low:high].max(axis=1)).all()
        if not left:
            break
        two = list(tree.halves(nodes, rows, np.full(len(ranges), left)))
        mid = [(low + high) // 2 for low, high in ranges]
        ranges = [(low, m) for (low, _), m in zip(ranges, mid, strict=True)] + [(m, high) for (_, high), m in zip(ranges, mid, strict=True)]
        nodes, left = np.concatenate(two), left - 1
    for (low, _), x in zip(ranges, nodes, strict=True):
        assert (tree.best[x] == grid[:, low]).all()
    assert len(tree.best) - 1 <= 2 * n * (a + b + 1)


def test_ranges_are_pruned(monkeypatch):
    """Ranges that cannot hold one of the best aren't halved."""
    monkeypatch.setattr(T, "STEP", 8)
    rnd = random.Random(2)
    block = T._Block()
    for i in range(4000):
        block.add(i, T.terms_of((words(rnd, 40, 3000) + (" rare gem" if i % 500 == 7 else "")).encode()))
    x = block.batch().to_pylist()[0]
    length = np.frombuffer(x["lengths"], "<i8")
    row, col = np.frombuffer(x["rows"], "<u4").astype(np.int64), np.frombuffer(x["cols"], "<u2").astype(np.int64)
    value = T.impacts(np.frombuffer(x["tfs"], "<i4").astype(np.int64), length[col], 4000, int(length.sum()))
    names = x["terms"].split(b" ")
    a, b = (len(names) - 1).bit_length(), 12
    tree = T.Treap(a, b, **T.encode(row, col, value, a, b))
    best = T.Best(8)
    rows = np.array([names.index(t) for t in (b"rare", b"gem", b"w1")])
    halved = T.descend(tree, rows, np.array([6000, 6000, 3000]), np.frombuffer(x["doc_ids"], "<i8"), best)
    assert sorted(best.id.tolist()) == [i for i in range(4000) if i % 500 == 7]
    assert halved < 4095 / 4  # of all ranges


def test_rows_of_blocks_are_taken_one_by_one(spark, monkeypatch):
    seen, written = {}, T.written

    def spy(df, name):
        seen[name] = {k: df.sparkSession.conf.get(k) for k in T.ROW_BY_ROW}
        return written(df, name)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    monkeypatch.setattr(T, "written", spy)
    before = {k: spark.conf.get(k) for k in T.ROW_BY_ROW}
    docs = spark.createDataFrame([(i, f"word{i % 7} common") for i in range(40)], "doc_id long, text string").repartition(6)
    index = T.build(docs)
    found = T.search(index, spark.createDataFrame([(1, "word3")], "item_id long, text string"), k=3)
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == [3, 10, 17]
    assert seen["treaps"] == seen["found"] == T.ROW_BY_ROW  # the jobs that read rows of blocks
    assert seen["postings"] == seen["item-terms"] == before  # those that read texts
    assert {k: spark.conf.get(k) for k in T.ROW_BY_ROW} == before
    blocks = index.blocks.coalesce(1)
    assert blocks.count() > 1
    with T._row_by_row(spark):
        assert {r["n"] for r in blocks.mapInArrow(sizes, "n long").collect()} == {1}
