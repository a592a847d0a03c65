import random

import numpy as np
import pytest
import xxhash
from helpers import empty, frame, mixed_docs

from veilspark.llm import simhash as S
from veilspark.llm.components import components


def brute_fingerprint(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, near):
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(nodes)):
        for j in range(i):
            if near(nodes[i], nodes[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(nodes))]


def test_fingerprints():
    for _, t, *_ in mixed_docs():
        assert S.fingerprint((t or "").encode()) == brute_fingerprint(t)


def test_operator(spark):
    rows = mixed_docs()
    got = S.near_duplicates(frame(spark, rows)).collect()
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    roots = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for (i, *_), r in zip(rows, roots, strict=True):
        low[r] = i if low.get(r) is None else min(low[r], i) if i is not None else low[r]
    want = sorted((str(i), f, low[r]) for (i, *_), f, r in zip(rows, fps, roots, strict=True))
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), r["component_id"]) for r in got) == want

    kept = S.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(low[r]) for r in set(roots))


def test_empty(spark):
    assert S.near_duplicates(empty(spark)).count() == 0
    assert S.keep_one(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [8, 2048])
def test_links_find_every_component(spark, block):
    """Chains and a large group of near fingerprints; small blocks cut the group up."""
    rnd = random.Random(3)
    fps = [rnd.getrandbits(64) for _ in range(60)]
    for _ in range(60):  # neighbours at every distance, also in one segment only
        f = rnd.choice(fps)
        for b in rnd.sample(range(64), rnd.randrange(1, 7)):
            f ^= 1 << b
        fps.append(f)
    fps += [fps[0] ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(a)][:200]
    fps += [0, (1 << 64) - 1, 0b1111, 0b11110000]
    fps = sorted(set(fps))
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = {r["node"]: r["root"] for r in components(S.links(df, 4, block)).collect()}
    roots = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    groups, mine = {}, {}
    for f, r in zip(fps, roots, strict=True):
        s = int(np.uint64(f).view(np.int64))
        groups.setdefault(r, set()).add(s)
        mine.setdefault(got.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 200), (None, 3), (101, 100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
