import hashlib
import math
from collections import Counter

import pytest
from helpers import empty, frame, mixed_docs

from veilspark.llm import mixing as M


def brute(rows, weights, rest, seed):
    pool = [s if s in weights else None for *_, s in rows]
    size = Counter()
    for p, (_, t, *_x) in zip(pool, rows, strict=True):
        size[p] += len(t or "")
    wanted = {**weights, None: rest}
    rate = {k: sum(size.values()) * w / sum(wanted.values()) / size[k] if size[k] else 0 for k, w in wanted.items()}
    out = []
    for p, (i, t, *_x) in zip(pool, rows, strict=True):
        name = "" if i is None else str(i)
        u = int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) / 2 ** 52
        n, below = 0, 0.0
        while rate[p] > 0:
            below += math.exp(-rate[p]) * rate[p] ** n / math.factorial(n)
            if u < below or n > 150:
                break
            n += 1
        out += [(i, t, c) for c in range(n)]
    return out


@pytest.mark.parametrize("weights,rest", [({"src0": 0.5, "src1": 0.1, "gone": 0.2}, 0.2), ({}, 1.0), ({"src0": 3.0}, 0.0)])
def test_matches_brute_force(spark, weights, rest):
    rows = mixed_docs()
    got = M.mix(frame(spark, rows), weights, rest, seed=5).select("_row._c0", "_row._c1", "copy").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, weights, rest, 5)))


def test_shares_come_near_the_targets(spark):
    rows = [(i, "x" * 100, "en", "a" if i % 3 else "b") for i in range(3000)]
    got = Counter(r["source"] for r in M.mix_stage(frame(spark, rows), {"a": 0.25, "b": 0.75}, 0.0).collect())
    assert abs(got["b"] / (got["a"] + got["b"]) - 0.75) < 0.03
    assert abs(got["a"] + got["b"] - 3000) < 200


def test_shuffle_is_global_and_repeatable(spark):
    rows = [(i, "x", "en", "a") for i in range(2000)]
    take = lambda: [(r["_row"][0], r["copy"]) for r in M.mix(frame(spark, rows), {"a": 1.0}, 0.0, partitions=4).collect()]
    one = take()
    assert one == take()
    ids = [i for i, _ in one]
    rises = sum(a < b for a, b in zip(ids, ids[1:], strict=False)) / len(ids)
    assert 0.45 < rises < 0.55


def test_cdf():
    assert M.poisson_cdf(0) == [1.0]
    for rate in (1e-9, 0.3, 7.0, 900.0):
        cdf = M.poisson_cdf(rate)
        assert abs(cdf[-1] - 1) < 1e-9 and all(a <= b for a, b in zip(cdf, cdf[1:], strict=False))


def test_stage_columns_and_empty(spark):
    docs = frame(spark, mixed_docs())
    assert M.mix_stage(docs).schema.simpleString() == docs.schema.simpleString()
    assert M.mix_stage(empty(spark)).count() == 0
