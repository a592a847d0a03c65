import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import empty, frame, mixed_docs, words

from veilspark.llm import substrings as S


def brute(rows, length):
    docs = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    seen = Counter(tuple(w[k:k + length]) for _, w in docs for k in range(len(w) - length + 1))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k:k + length])] > 1:
                gone[k:k + length] = [True] * length
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((str(i), len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def run(spark, rows, length=35):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], bytes(r["kept"]).hex())
                  for r in S.remove_repeats(frame(spark, rows), length).collect())


def test_cover():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))
    assert S.PERIOD <= S.LENGTH


@pytest.mark.parametrize("chunk", [100, 400_000])
def test_matches_brute_force(spark, chunk, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", chunk)
    assert run(spark, mixed_docs()) == brute(mixed_docs(), 35)


def test_every_alignment_and_edge(spark):
    """One passage of 35 to 45 words at every offset, runs of one word, near misses of 34 words."""
    rnd = random.Random(5)
    passage = words(rnd, 45, 10_000).split()
    rows = [(i, f"{words(rnd, i, 10_000)} {' '.join(passage[i % 5:35 + i % 11])} {words(rnd, 7, 10_000)}", "en", "s") for i in range(40)]
    miss = words(rnd, 34, 10_000)
    rows += [(100 + i, f"{words(rnd, 9, 10_000)} {miss} {words(rnd, 9, 10_000)}", "en", "s") for i in range(4)]
    rows += [(200, "a " * 34, "en", "s"), (201, "b " * 35, "en", "s"), (202, "c " * 36, "en", "s"), (203, "c " * 35, "en", "s")]
    twice = words(rnd, 40, 10_000)
    rows += [(300, f"{twice} x {twice}", "en", "s"), (301, words(rnd, 35, 10_000), "en", "s")]
    rows += [(None, rows[0][1], "en", "s"), (302, rows[3][1], "en", "s"), (303, rows[3][1] + " tail", "en", "s")]
    got = run(spark, rows)
    assert got == brute(rows, 35)
    assert 0 < sum(r[2] > 0 for r in got) < len(got)


def test_result_does_not_depend_on_the_groups(spark):
    docs = frame(spark, mixed_docs())
    got = [sorted(map(repr, S.remove_repeats(docs, group_bytes=b).collect())) for b in (500, 1 << 30)]
    assert got[0] == got[1]


def test_other_length_and_empty(spark):
    assert run(spark, mixed_docs(7), 25) == brute(mixed_docs(7), 25)
    assert S.remove_repeats(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        S.remove_repeats(empty(spark), 20)


def test_runs_over_batches():
    """Both scans of sorted rows give the same however the rows are cut into batches."""
    import pyarrow as pa

    rnd = np.random.default_rng(1)
    h = np.sort(rnd.integers(0, 60, 150))
    who = rnd.integers(0, 9, 150).astype(np.int32)
    who[rnd.random(150) < 0.03] = -1
    for size in (1, 2, 7, 150):
        cuts = range(0, 150, size)
        got = [x for b in S._hits(pa.RecordBatch.from_pydict({"h": h[i:i + size], "who": who[i:i + size]}) for i in cuts)
               for x in zip(b.column(1).to_pylist(), b.column(0).to_pylist(), strict=True)]
        want = [(a, b) for a, b in zip(h.tolist(), who.tolist(), strict=True)
                if b >= 0 and ((h == a).sum() > 1 or -1 in who[h == a])]
        assert sorted(got) == sorted(want)
        got = [x for b in S._repeated(pa.RecordBatch.from_pydict(
            {"h1": h[i:i + size], "h2": h[i:i + size].astype(np.int32), "who": who[i:i + size]}) for i in cuts)
            for x in zip(b.column(1).to_pylist(), b.column(0).to_pylist(), strict=True)]
        assert sorted(got) == sorted(want)
