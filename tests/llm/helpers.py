"""Small tables with everything that real ones may hold."""

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "bucket int, key string, _row string, n long, fp long, row_key long, copy int, _c0 string, rank int")


def frame(spark, rows):
    """rows: (doc_id, text, lang, source); further columns clash with names that operators use."""
    rows = [(i, t, lang, s, len(t) if t is not None else None, 7, "k", "r", 1, 2, 3, 4, "c", 5) for i, t, lang, s in rows]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def mixed_docs(seed=1, n=60):
    """Nulls everywhere, empty and blank texts, a long one, copies, near copies, shared passages and lines."""
    rnd = random.Random(seed)
    passage = words(rnd, 50)
    line = "The Same Line \t"
    rows = [(i, words(rnd, rnd.randrange(1, 160)), "en", f"src{i % 4}") for i in range(n)]
    rows += [(100 + i, f"{words(rnd, 20)} {passage} {words(rnd, 20)}", "en", "src0") for i in range(12)]
    rows += [(200 + i, f"{words(rnd, 5)}\n{' ' * i}{line if i % 2 else line.lower()}\n{words(rnd, 4)}\r\n\n", "en", "src1") for i in range(14)]
    base = words(rnd, 120)
    rows += [(300 + i, base, "en", "src0") for i in range(9)]
    rows += [(320 + i, base.replace("w7", f"x{i}", 1), "en", "src0") for i in range(9)]
    rows += [(400, None, None, None), (401, "", "en", None), (402, " \t\n\x0b", None, "src2"), (None, "no id here", "en", "src2"),
             (None, None, None, None), (403, words(rnd, 6000), "en", "src3"), (404, "w1 " * 300, "en", "src3"),
             (405, "é ñ 日本 \x1c x y z w", "fr", "src3")]
    rows += [rows[0], rows[70], rows[70], (400, None, None, None)]
    return rows
