import hashlib
import random
import zlib

import pytest
from helpers import empty, frame, mixed_docs
from pyspark.sql import functions as F

from veilspark.llm import merkle as M
from veilspark.llm.common import ascii_lower

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_leaf(row, fan=8):
    return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def levels(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        low = out[-1]
        out.append([H("".join(low[i:i + fan])) for i in range(0, len(low), fan)])
    return out


def way(tree, i, fan):
    """(place, others) level by level."""
    for level in tree[:-1]:
        run = i // fan * fan
        yield i - run, level[run:i] + level[i + 1:run + fan]
        i //= fan


def is_tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def brute(rows, fan=8):
    """rows: (doc_id, text, lang, source)."""
    groups = {}
    for i, t, lang, source in rows:
        n = None if t is None else len(t)
        low = None if t is None else t.translate(LOWER)
        groups.setdefault(lang, []).append(((i is not None, i or 0), i, *(brute_leaf((i, source, lang, n, x)) for x in (t, low))))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0], x[2]))
        trees[g] = levels([x[2] for x in groups[g]], fan)
    top = levels([trees[g][-1][0] for g in names], fan)
    root = top[-1][0] if names else None
    out = []
    for at, g in enumerate(names):
        for pos, (_, i, leaf, other) in enumerate(groups[g]):
            now, proof = other if is_tampered(i) else leaf, ""
            for place, others in [*way(trees[g], pos, fan), *way(top, at, fan)]:
                now = H("".join([*others[:place], now, *others[place:]]))
                proof += "".join(others)
            out.append((i, leaf, trees[g][-1][0], root, H(proof), now, now == root))
    return sorted(out, key=str)


def manifest(df):
    return M.manifest(df, F.crc32(F.col("doc_id").cast("string")) % 3 == 0, {"text": ascii_lower(F.col("text"))})


def found(df):
    return sorted(((r["id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in df.collect()), key=str)


def many(n=700, seed=3):
    """Groups of every size: one leaf, some full runs, one group far beyond a block; case of the texts is mixed."""
    rnd = random.Random(seed)
    langs = ["en"] * 6 + ["de", None, "fr", ""]
    rows = [(rnd.randrange(10**6), rnd.choice(["Upper Case", "lower", "É ok", "", None]), rnd.choice(langs), rnd.choice(["s", None])) for _ in range(n)]
    return rows + [(5_000_000 + i, "X", f"l{i:03}", "s") for i in range(40)] + [(7, "Same", "en", "s")] * 30


@pytest.mark.parametrize("levels_of_a_block", [1, 2, 4])
def test_proofs_are_brute_force(spark, monkeypatch, levels_of_a_block):
    monkeypatch.setattr(M, "LEVELS", levels_of_a_block)
    monkeypatch.setattr(M, "BLOCK", 8 ** levels_of_a_block)
    for rows in (mixed_docs(), many()):
        m = manifest(frame(spark, rows))
        assert found(M.proofs(m)) == brute(rows)
        assert 0 < m.blocks.agg(F.max(F.size("ids"))).first()[0] <= 8 ** levels_of_a_block


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_one_group_of_each_size(spark, monkeypatch, n):
    monkeypatch.setattr(M, "LEVELS", 2)
    monkeypatch.setattr(M, "BLOCK", 64)
    rows = [(i, "A", "en", "s") for i in range(n)]
    assert found(M.proofs(manifest(frame(spark, rows)))) == brute(rows)


def test_versions_copy_ancestors_only(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 2)
    monkeypatch.setattr(M, "BLOCK", 64)
    rows = many()
    m = manifest(frame(spark, rows))
    folded = {}
    for i, leaf, _, _, _, now, verified in brute(rows):
        folded.setdefault((i, now), verified)
    by = {}
    for r in M.versions(m).collect():
        by.setdefault((r["grp"], r["version"], r["id"]), {})[r["level"]] = r["node"]
    sizes = {g: sum(1 for r in rows if r[2] == g) for g in {r[2] for r in rows}}
    top = M.height_of(len(sizes))
    assert by
    for (g, _, i), nodes in by.items():
        assert sorted(nodes) == list(range(M.height_of(sizes[g]) + top + 1))  # one node a level, no more
        assert folded[i, nodes[max(nodes)]] is False
    changed = sum(1 for i, t, *_ in rows if is_tampered(i) and t is not None and t != t.translate(LOWER))
    assert len(by) == changed


def test_empty(spark):
    m = manifest(empty(spark))
    assert m.root is None and M.proofs(m).count() == 0 and M.versions(m).count() == 0


def test_paths_as_bytes():
    steps = [M.Step(0, []), M.Step(2, [bytes([i]) * 32 for i in range(7)])]
    assert M.path_steps(M.path_bytes(steps)) == steps
