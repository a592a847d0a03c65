import random
import zlib

import numpy as np
import pytest
from helpers import empty, frame, mixed_docs
from tokenizers import Tokenizer

from veilspark.llm import packing as P


@pytest.fixture(scope="module")
def spec():
    return P.tokenizer_spec()


@pytest.fixture(scope="module")
def tokenizer(spec):
    t = Tokenizer.from_str(spec)
    t.encode_special_tokens = True
    return t


def test_token_table_is_the_tokenizer(spec, tokenizer):
    rnd = random.Random(1)
    signs = [" ", "\n", "\t", "a", "B", "1", ".", "é", "'s", "\x1c", "\x85", "　", "​", "日", "\r"]
    texts = ["", " ", "\n", "a  b", "<|endoftext|> x<|endoftext|>", "don't  we'll", *(t or "" for _, t, *_ in mixed_docs())]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 40))) for _ in range(1500)]
    table = P.TokenTable(spec)
    for t in texts:
        assert np.frombuffer(table.ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_full_table_is_emptied(spec, tokenizer, monkeypatch):
    monkeypatch.setattr(P, "MAX_CHUNKS", 20)
    table = P.TokenTable(spec)
    for _, t, *_ in mixed_docs()[:30]:
        assert np.frombuffer(table.ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [64, 2048])
def test_round_trip(spark, spec, tokenizer, capacity):
    rows = mixed_docs()
    got = P.pack(frame(spark, rows), spec, capacity).collect()
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])
    want = sorted((str(i), k, s, n, zlib.crc32(np.array(x[s:s + n], "<u4").tobytes()))
                  for i, all_of in ids.items() for x in all_of for k, (s, n) in enumerate(P.cut(len(x), capacity)))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for seq in by.values():
        end = 0
        for offset, n in sorted(seq):
            assert offset == end
            end += n
        assert end <= capacity
    total = sum(r["length"] for r in got)
    assert len(by) <= 1.05 * total / capacity + 1


def test_special_tokens_as_the_library_has_them(spark, spec):
    """The reference is the tokenizer with its defaults."""
    plain = Tokenizer.from_str(spec)
    texts = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>\n\n y<|endoftext|><|endoftext|>", "<|endof<|endoftext|>text|>", "  <|endoftext|>  ", "no token <|endoftext"]
    table = P.TokenTable(spec, encode_special_tokens=False)
    for t in texts:
        assert np.frombuffer(table.ids(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
    got = {r["doc_id"]: r["ids_crc32"] for r in P.pack(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), spec).collect()}
    assert got == {i: zlib.crc32(np.array(plain.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes()) for i, t in enumerate(texts)}


def test_added_tokens_of_other_kinds(spec):
    """Overlapping ones, one that is not special, and one that takes the space before it."""
    from tokenizers import AddedToken

    for more in ([AddedToken("<a>", special=True, normalized=False), AddedToken("<a><b>", normalized=False)], [AddedToken("<m>", lstrip=True, special=True)]):
        for flag in (False, True):
            t = Tokenizer.from_str(spec)
            t.add_tokens(more)
            own = t.to_str()
            t = Tokenizer.from_str(own)
            t.encode_special_tokens = flag
            table = P.TokenTable(own, flag)
            for text in ("x <a><b> <a> y<|endoftext|>", "word  <m> <m>z", "plain words\n"):
                assert np.frombuffer(table.ids(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_empty(spark, spec):
    assert P.pack(empty(spark), spec).count() == 0


def test_cut():
    assert P.cut(1, 10) == [(0, 1)]
    assert P.cut(10, 10) == [(0, 10)]
    assert P.cut(25, 10) == [(0, 5), (5, 10), (15, 10)]


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    """Every piece has one place, sequences are gapless, large ones are two at most, few sequences."""
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 30, 100, 512])
    counts = {rnd.randrange(1, capacity + 1): rnd.randrange(1, 50) for _ in range(rnd.randrange(1, 60))}
    plan = P.Plan(counts, capacity)
    length = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = plan.lookup()(length.astype(np.int64), rank.astype(np.int64))
    by = {}
    for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True):
        by.setdefault(s, []).append((o, n))
    assert sorted(by) == list(range(plan.sequences))
    for seq in by.values():
        end = 0
        for o, n in sorted(seq):
            assert o == end
            end += n
        assert end <= capacity
        assert sum(3 * n > capacity for _, n in seq) <= 2
    bound = -(-int(length.sum()) // capacity)
    assert plan.sequences <= max(bound * 1.25 + 1, sum(n for x, n in counts.items() if 2 * x > capacity) * 1.2 + bound * 0.5 + 1)
