"""The pipeline's stages against brute force, one by one and end to end; and the registration."""

import random

import corpus_pipeline as C
import pytest
from helpers import empty, frame, mixed_docs, words
from test_lines import brute as lines_brute
from test_mixing import brute as mixing_brute
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

from veilspark.llm import mixing
from veilspark.llm.common import written
from veilspark.llm.packing import cut, tokenizer_spec


def with_language(rows):
    """Declared languages are needed to fit the model."""
    return [(i, t, "en", s) for i, t, _, s in rows]


@pytest.fixture(scope="module")
def rows():
    import random

    rnd = random.Random(8)
    more = [(700 + i, words(rnd, 80).replace("w", "und der "), "de", "src1") for i in range(30)]
    return with_language(mixed_docs()) + more + [(800, "", "en", "src0"), (801, "77 88", "en", "src0")]


def test_stages_in_a_row(spark, tmp_path, rows):
    docs = frame(spark, rows)
    stages = dict(C.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    now, want = docs, [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    step = lambda name: written(stages[name](spark, now, str(tmp_path)), name)
    texts = lambda df: sorted((str(r["doc_id"]), r["text"]) for r in df.collect())
    pairs = lambda rows: sorted((str(r[0]), r[1]) for r in rows)

    now = step("language_id")
    assert texts(now) == pairs(want)
    now = step("line_dedup")
    want = [(i, t, lang, s) for (i, *_, t), (_, _, lang, s) in zip(lines_brute(want, 10), want, strict=True)]
    assert texts(now) == pairs(want)
    now = step("near_dedup")
    fps = [brute_fingerprint(r[1]) for r in want]
    best = {}
    for r, root in zip(want, brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4), strict=True):
        if root not in best or (r[0] is not None and (best[root][0] is None or r[0] < best[root][0])):
            best[root] = r
    assert sorted(str(r["doc_id"]) for r in now.collect()) == sorted(str(r[0]) for r in best.values())
    want = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in now.collect()]
    now = step("mixing")
    want = [(i, t) for i, t, _ in mixing_brute(want, mixing.WEIGHTS, mixing.REST, mixing.SEED)]
    assert texts(now) == pairs(want)
    assert now.schema.simpleString() == docs.schema.simpleString()
    now = step("packing")
    tokenizer = Tokenizer.from_str(tokenizer_spec())
    pieces = sorted((str(i), k, s, n) for i, t in want
                    for k, (s, n) in enumerate(cut(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1, 2048)))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"]) for r in now.collect()) == pieces


def test_empty_table(spark, tmp_path):
    now = empty(spark)
    for name, stage in C.STAGES:
        now = written(stage(spark, now, str(tmp_path)), name)
        assert now.count() == 0


def test_run_reads_the_table(spark, tmp_path, rows):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).count() > 0


def test_all_are_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert {"op1_line_dedup", "op2_embedding_links", "op3_mixing", "op4_topk_search", "op12_lexical_search", "op13_merkle_manifest"} <= set(E.oracle_sql())


@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_embedding_links", "op3_mixing", "op4_topk_search",
                                  "op12_lexical_search", "op13_merkle_manifest"])
def test_oracles(spark, sf_small, name):
    from tools.compare_oracle import compare

    found = compare(spark, sf_small, [name])[name]
    assert found.get("hash_match") and found.get("types_match"), found


def test_equal_row_hashes_lose_no_document(spark, monkeypatch):
    """Documents of different ids whose 64-bit hashes are forced to be equal: each is judged by itself."""
    from pyspark.sql import functions as F

    from veilspark.llm import langid, simhash

    rows = [(i, words(random.Random(i), 60), "en", "src0") for i in range(20)] + [(100, "77 88", "en", "src0"), (101, "", "en", "src0")]
    docs = frame(spark, rows)
    real = F.xxhash64
    same = lambda *c: F.lit(7).cast("long") if len(c) == 2 and c[1] == "text" else real(*c)
    monkeypatch.setattr(langid.F, "xxhash64", same)
    assert sorted(r["doc_id"] for r in langid.keep_identified(docs).collect()) == list(range(20))
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs.filter("doc_id < 100")).collect()) == list(range(20))
