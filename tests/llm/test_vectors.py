"""Embedding links by cover trees and top-k search by vector approximations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilspark.llm import covertree as C
from veilspark.llm import vafile as V

SCHEMA = "vec_id long, embedding array<float>, label int, q int, d int, cid long, cell int, size int, _c0 string, vec string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3, 4, 5, "c", "v") for i, v, label in rows], SCHEMA)


def near(seed, n, dim=8, labels=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(n // 3, n):
        x[i] = x[rng.integers(0, i)] + rng.normal(size=dim) * rng.choice([0.02, 0.2, 0.5])
    return [(i, [float(np.float32(a)) for a in v], int(rng.integers(0, labels))) for i, v in enumerate(x)]


NAN, INF = float("nan"), float("inf")


def odd(rows):
    v = rows[0][1]
    return [(900, None, 0), (901, v, None), (902, [0.0] * 8, 0), (903, [None, *v[1:]], 0), (904, [NAN, *v[1:]], 0), (905, [INF, *v[1:]], 0),
            (906, [], 0), (907, v[:5], 0), (908, v, rows[0][2]), (909, [2 * a for a in v], rows[0][2]), (910, [-a for a in v], rows[0][2]),
            (None, v, rows[0][2]), (911, [1e-38 * a for a in v], rows[0][2]), rows[1], rows[1], (912, v[:5], 0), (None, None, None)]


def brute_links(rows, least):
    """One entry a row: (vec_id, links, component, kept)."""
    def fits(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    vecs = [np.array(np.array(v, np.float32), float) if fits(v, label) else None for _, v, label in rows]
    links = [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            a, b = vecs[i], vecs[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2]:
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, (vec_id, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        low = min(ids) if ids else None
        out.append((vec_id, len(links[i]), low, vec_id == low))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [4, 50, 1024])
def test_links_match_brute_force(spark, block):
    rows = near(1, 260)
    rows += odd(rows)
    got = sorted((tuple(r) for r in C.link(table(spark, rows), 0.93, block).collect()), key=str)
    assert got == brute_links(rows, 0.93)


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_tree_of_proportional_vectors_ends(kind, monkeypatch):
    """Copies that differ by a factor or by one ulp have one unit vector; many of them have distance 0 to the last bit."""
    rng, real = np.random.default_rng(5), C.Tree._net

    def bounded(tree, *args):  # a build without end fails here
        tree.calls = getattr(tree, "calls", 0) + 1
        assert tree.calls <= 2 * len(tree.x)
        return real(tree, *args)

    monkeypatch.setattr(C.Tree, "_net", bounded)
    base = rng.normal(size=(40, 64)).astype(kind)
    x = np.concatenate([(base * kind(f)).astype(kind) for f in (1, 2, 3, 0.1, 7e-5, 1e6)] + [np.nextafter(base, kind(9))]).astype(float)
    tree = C.Tree(x)
    assert sorted(tree.centre[tree.last == 0].tolist()) == list(range(len(x)))
    i, j = C.traverse(tree, tree, 0.93, True)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert sorted(zip(np.minimum(i, j), np.maximum(i, j), strict=True)) == sorted(zip(*np.nonzero(np.triu(unit @ unit.T >= 0.93, 1)), strict=True))


def test_links_of_scaled_copies(spark):
    rng = np.random.default_rng(6)
    base = [[float(np.float32(a)) for a in v] for v in rng.normal(size=(20, 64))]
    rows = [(100 * i + k, [f * a for a in v], 0) for i, v in enumerate(base) for k, f in enumerate((1, 2, 3, 0.5, 10))]
    got = sorted((tuple(r) for r in C.link(table(spark, rows), 0.93).collect()), key=str)
    assert got == brute_links(rows, 0.93)


def test_cells_are_split_level_by_level(spark):
    """Clusters within clusters: more than one level, few vectors in cells that no longer shrink, links as by brute force."""
    rng = np.random.default_rng(11)
    x = np.concatenate([c + s * 0.2 + rng.normal(size=(30, 8)) * 0.03 for c in rng.normal(size=(4, 8)) for s in rng.normal(size=(4, 8))])
    rows = [(i, [float(np.float32(a)) for a in v], 0) for i, v in enumerate(x)]
    classes = table(spark, rows).selectExpr("cast(label as string) label", "vec_id cid", "1L size", "cast(embedding as array<double>) vec")
    real, C.MAX_CELLS = C.MAX_CELLS, 4
    try:
        celled, levels = C._nested(classes, 16)
        assert len(levels) > 1 and celled.count() == len(rows) == celled.select("cid").distinct().count()
        assert sum(n for _, n in celled.groupBy("cell").count().collect() if n > 16) < len(rows) / 10
        radii = [r.radius for r in (lv.agg(F.max("radius").alias("radius")).first() for lv in levels)]
        assert radii == sorted(radii, reverse=True)
        got = sorted((tuple(r) for r in C.link(table(spark, rows), 0.93, 16).collect()), key=str)
    finally:
        C.MAX_CELLS = real
    assert got == brute_links(rows, 0.93)


def test_cells_that_do_not_shrink_are_cut(spark):
    """One direction under many lengths: no centre parts it."""
    v = np.random.default_rng(12).normal(size=8)
    rows = [(i, [float(a) for a in v * 2.0 ** (i % 60) * (1 + i // 60)], 0) for i in range(150)]
    classes = spark.createDataFrame([(str(label), i, 1, w) for i, w, label in rows], "label string, cid long, size long, vec array<double>")
    celled, levels = C._nested(classes, 16)
    assert len(levels) == 1 and celled.groupBy("cell").count().count() <= 2
    found = C.link(classes.selectExpr("cid vec_id", "vec embedding", "label"), 0.93, 16).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(149, 0)}


def test_unclustered_vectors_are_multiplied(monkeypatch):
    """Where nothing is pruned, the work is one product and not a walk over pairs of nodes."""
    x = np.random.default_rng(13).normal(size=(1024, 16))
    u, (a, b) = C._unit(x), (C.Tree(x[:512]), C.Tree(x[512:]))
    calls, real = [], C._distance
    monkeypatch.setattr(C, "_distance", lambda p, q: calls.append(len(p) * len(q)) or real(p, q))
    got = set(zip(*(k.tolist() for k in C.traverse(a, b, 0.5, False)), strict=True))
    assert got == set(zip(*(k.tolist() for k in np.nonzero(u[:512] @ u[512:].T >= 0.5)), strict=True))
    assert len(calls) < 1000


def test_no_vectors(spark):
    assert C.link(table(spark, [])).count() == 0
    assert [tuple(r) for r in C.link(table(spark, [(7, None, 1)])).collect()] == [(7, 0, 7, True)]


def test_tree_covers_with_halving_radii():
    x = np.array([v for _, v, _ in near(2, 300)])
    tree = C.Tree(x)
    held = [set() for _ in tree.centre]
    for n in reversed(range(len(held))):
        kids = tree.children(n) if tree.last[n] else []
        held[n] = set().union({int(tree.centre[n])}, *(held[k] for k in kids))
        if len(kids):
            assert tree.centre[n] in tree.centre[kids]  # nested
            assert all(tree.radius[k] <= tree.radius[n] / 2 + 1e-9 for k in kids) or len(kids) == 2
        away = C._distance(tree.unit[sorted(held[n])], tree.unit[tree.centre[n]][None])[:, 0]
        assert away.max() <= tree.radius[n] + 1e-6
    assert held[0] == set(range(300))


@pytest.mark.parametrize("least", [0.5, 0.93, 0.999])
def test_traversal_is_exact(least):
    x = np.array([v for _, v, _ in near(3, 400)])
    u = C._unit(x)
    cosine = u @ u.T
    a, b = C.Tree(x[:150]), C.Tree(x[150:])
    assert set(zip(*(k.tolist() for k in C.traverse(a, b, least, False)), strict=True)) == set(
        zip(*(k.tolist() for k in np.nonzero(cosine[:150, 150:] >= least)), strict=True))
    got = [(min(p), max(p)) for p in zip(*(k.tolist() for k in C.traverse(C.Tree(x), C.Tree(x), least, True)), strict=True)]
    assert len(got) == len(set(got))
    assert set(got) == {(i, j) for i, j in zip(*np.nonzero(cosine >= least), strict=True) if i < j}


# --- top-k ----------------------------------------------------------------

def brute_topk(rows, k, every):
    vecs = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            vecs.setdefault((i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)))
    out = []
    for i, q in vecs:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, w, strict=True)), j) for j, w in vecs if j != i and len(w) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("block,chunk", [(16, 5), (4096, 8192)])
def test_topk_matches_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "CHUNK", chunk)
    rows = near(4, 220)
    rows = [(i, [round(4 * x) / 4 for x in v], 0) if i % 2 else (i, v, 0) for i, v, _ in rows]  # many ties
    rows += [r for r in odd(rows) if r[0] is not None]
    got = sorted(tuple(r) for r in V.search(table(spark, rows), F.col("vec_id") % 10 == 0, 10).collect())
    assert got == brute_topk(rows, 10, 10)


def test_topk_few_empty_and_huge(spark):
    few = [(0, [1.0, 2.0], 0), (1, [3.0, -1.0], 0), (100, [1.0, 2.0], 0)]
    got = sorted(tuple(r) for r in V.search(table(spark, few), F.col("vec_id") % 100 == 0).collect())
    assert got == brute_topk(few, 10, 100)
    assert V.search(table(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert V.search(table(spark, few[1:2]), F.col("vec_id") % 100 == 0).count() == 0
    huge = [(i, [float(np.float32(x)) for x in (10.0 ** (i + 3), -3.0 * 10 ** i, 7.0)], 0) for i in range(5)]
    got = sorted(tuple(r) for r in V.search(table(spark, huge), F.col("vec_id") == 0).collect())
    assert got == [x for x in brute_topk(huge, 10, 1) if x[0] == 0]
