import random

import numpy as np
import pytest
from helpers import empty, frame

from veilspark.llm import langid as L

SOUNDS = {"en": ["the", "and", "ing", "tion", "wh", "ou", "sh"], "de": ["der", "und", "sch", "ei", "ung", "ü", "ch"],
          "fr": ["les", "que", "eau", "é", "ai", "ou", "ç"]}


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choice(SOUNDS[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    out = []
    for i in range(600):
        lang = rnd.choice(list(SOUNDS))
        said = lang if rnd.random() < 0.8 else rnd.choice([None, "und", rnd.choice(list(SOUNDS))])
        out.append((i, prose(rnd, lang, rnd.choice([3, 20, 200])), said, rnd.choice([f"{lang}.example.com", f"www.site.{lang}", None, "src0"])))
    rnd.shuffle(out)
    return out


def truth(rows):
    """By the sounds that only one language has."""
    return {i: max(SOUNDS, key=lambda k: sum((t or "").count(x) * len(x) for x in SOUNDS[k])) for i, t, *_ in rows}


def test_held_out_accuracy(spark, rows):
    """Fitted on 30 rows a language, so nearly all rows are held out."""
    want = truth(rows)
    got = L.identify(frame(spark, rows), train_rows=30).collect()
    assert len(got) == len(rows)
    right = [r["lang"] == want[r["id"]] for r in got]
    assert np.mean(right) > 0.97
    assert np.mean([r["keep"] for r in got]) > 0.99


def test_edges(spark, rows):
    odd = [(1000, None, "en", "a.de"), (1001, "", None, None), (1002, "12 34 %% !!", "de", "x"), (None, rows[0][1], rows[0][2], None),
           (1003, None, None, None), rows[5], rows[5], (1004, prose(random.Random(1), "de", 30_000), "de", "b.de")]
    got = {}
    for r in L.identify(frame(spark, rows[:200] + odd)).collect():
        got.setdefault(r["id"], []).append((r["lang"], r["keep"]))
    assert [got[i] for i in (1000, 1001, 1002, 1003)] == [[("und", False)]] * 4
    assert len(got[rows[5][0]]) == 3 and len(set(got[rows[5][0]])) == 1
    assert got[1004] == [("de", True)] and got[None][0][1]
    kept = L.keep_identified(frame(spark, rows[:200] + odd))
    assert kept.count() == 200 + len(odd) - 4
    assert {r["key"] for r in kept.collect()} == {"k"}


def test_priors_settle_short_texts(spark):
    """One ambiguous word: the host's other documents decide."""
    rnd = random.Random(4)
    rows = [(i, prose(rnd, lang, 60), lang, f"{lang}host.example.com") for i, lang in enumerate(list(SOUNDS) * 60)]
    rows += [(900, "ou", None, "enhost.example.com"), (901, "ou", None, "frhost.example.com")]
    got = {r["id"]: r["lang"] for r in L.identify(frame(spark, rows)).collect()}
    assert (got[900], got[901]) == ("en", "fr")


def test_nothing_declared_and_empty(spark):
    got = L.identify(frame(spark, [(1, "some text", None, "a"), (2, None, None, None)])).collect()
    assert {(r["lang"], r["keep"]) for r in got} == {("und", False)}
    assert L.identify(empty(spark)).count() == 0
    assert L.keep_identified(empty(spark)).count() == 0


@pytest.mark.parametrize("n", [400, 401, 10**8, 10**10, 10**13])
def test_training_share_of_any_size(spark, n):
    """The expected number of training rows is the bound, and places are even down to the smallest shares."""
    assert L.train_below(400, n) / (1 << 62) * n == pytest.approx(400, rel=1e-6)
    rows = spark.range(4096).select(L._place("id").alias("p"))
    low, high, under = rows.selectExpr("min(p)", "max(p)", f"count_if(p < {1 << 59})").first()
    assert 0 <= low < high < 1 << 62 and high > 1 << 61
    assert abs(under - 512) < 100


def test_more_languages_than_a_few(spark):
    """150 languages of their own sounds; the rarest are found as well as the others."""
    rnd, letters = random.Random(7), "abcdefghijklmnopqrstuvwxyz"
    codes = [a + b for a in letters for b in letters if a + b not in ("un",)][:150]
    sounds = {c: ["".join(rnd.choice(letters) for _ in range(3)) for _ in range(6)] for c in codes}
    text = lambda c: " ".join("".join(rnd.choice(sounds[c]) for _ in range(2)) for _ in range(40))
    rows = [(1000 * i + j, text(c), c, None) for i, c in enumerate(codes) for j in range(2 if i >= 64 else 4)]
    got = {r["id"]: (r["lang"], r["keep"]) for r in L.identify(frame(spark, rows)).collect()}
    assert got == {i: (c, True) for i, _, c, _ in rows}
