"""URL filters: host and path rules, and a ratio of character language models.

A URL's host and path decide its rule, the longest that fits. Where no rule fits, two
smoothed variable-order Markov models decide, one fitted on the URLs that rules
allow and one on those that rules block: contexts of up to ``ORDER`` bytes, each order
smoothed towards the next shorter one by ``PULL`` pseudo-counts, so an unseen
context falls back to what its suffix knows. The score is the difference of
the log likelihoods over the number of bytes. It is calibrated on URLs held out of the
fit (a fifth, by hash): the threshold is where allowed and blocked ones are best
told apart (mean of both rates); below it a URL is blocked.

Counts come from all URLs that rules decide outside that fifth. They are exact, one row for each
context and byte in a table that grows with the pages. The different n-grams of
each chunk of URLs are joined to it, and a chunk's URLs sum what theirs have.
Without URLs of both classes there is no model, and all is allowed.

Null URLs and those without ``://`` have empty host and path; empty URLs are allowed.
Every input row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.common import ascii_lower, pick, read, written

ORDER, PULL = 4, 4.0
CHUNK = 1 << 17  # bytes
FOLDS = 5
BINS, RANGE = 2000, 5.0  # of held-out scores


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path), both empty for null or without ://."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    fits = url.isNotNull() & (at > 0)
    host = F.when(fits, ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))).otherwise("")
    path = F.when(fits, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # longer ones are asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


# --- the language models --------------------------------------------------

def _grams(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every URL: the byte and the ORDER before it as one number; and the URLs' lengths."""
    texts = [(u or "").lower().encode("utf-8", "replace") for u in urls]
    out = [np.zeros(0, np.int64)]
    for text in texts:
        b = np.frombuffer(b"\0" * ORDER + text, np.uint8).astype(np.int64)
        g = np.zeros(len(text), np.int64)
        for i in range(ORDER + 1):
            g = g << 8 | b[i:i + len(text)]
        out.append(g)
    return np.concatenate(out), np.array([len(x) for x in texts], np.int64)


def _numbered(least: int):
    """Adds a chunk: URLs of about ``least`` bytes in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            chunks = []
            for url in batch.column("url").to_pylist():
                chunks.append(first + size // least)
                size += 16 + len(url or "")
            yield batch.append_column("chunk", pa.array(chunks, pa.int64()))
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        verdicts = np.array([v == "block" for v in batch.column("verdict").to_pylist()], bool)
        grams, lengths = _grams(batch.column("url").to_pylist())
        found, at = np.unique(grams, return_inverse=True)
        blocked = np.bincount(at[np.repeat(verdicts, lengths)], minlength=len(found))
        yield pa.RecordBatch.from_pydict({"gram": pa.array(found, pa.int64()),
                                          "allow": pa.array(np.bincount(at, minlength=len(found)) - blocked, pa.int64()),
                                          "block": pa.array(blocked, pa.int64())})


def _of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        for chunk in np.unique(chunks):
            found = np.unique(_grams(batch.filter(pa.array(chunks == chunk)).column("url").to_pylist())[0])
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(np.full(len(found), chunk), pa.int64()), "gram": pa.array(found, pa.int64())})


def _last(key: str, n: int) -> Column:
    """The last n bytes of a number's."""
    return F.col(key).bitwiseAND(F.lit((1 << 8 * n) - 1).cast("long"))


def fit(labelled: DataFrame) -> DataFrame | None:
    """``labelled``: (url, verdict). Exact counts (kind, key, allow, block): kind 2k is k bytes of context and a
    byte, kind 2k + 1 the context alone. None without URLs of both classes."""
    both = [F.sum("allow").alias("allow"), F.sum("block").alias("block")]
    grams = written(labelled.select("url", "verdict").mapInArrow(_counted, "gram long, allow long, block long")
                    .groupBy("gram").agg(*both), "url-grams")
    if not all(grams.agg(*both).first()):
        return None
    context = F.shiftright("gram", 8).alias("context")
    keys = []
    for k in range(ORDER + 1):
        keys += [F.struct(F.lit(2 * k).alias("kind"), _last("gram", k + 1).alias("key")),
                 F.struct(F.lit(2 * k + 1).alias("kind"), _last("context", k).alias("key"))]
    return written(grams.select("gram", context, "allow", "block").select(F.explode(F.array(*keys)).alias("x"), "allow", "block")
                   .groupBy("x.kind", "x.key").agg(*both), "url-contexts")


def ratios(model: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, ratio): log likelihood as allowed less that as blocked. From order to order, a key meets its
    count, its context's and the next shorter order's result, each shared by 256 keys at most."""
    shorter = None
    for k in range(ORDER + 1):
        level = grams.select(_last("gram", k + 1).alias("key")).distinct()
        level = level.join(model.filter(F.col("kind") == 2 * k).select("key", "allow", "block"), "key", "left")
        level = level.withColumn("context", F.shiftright("key", 8)).join(
            model.filter(F.col("kind") == 2 * k + 1).selectExpr("key context", "allow c_allow", "block c_block"), "context", "left")
        level = level.withColumn("tail", _last("key", k)).join(shorter, "tail") if k else level.withColumns(
            {"s_allow": F.lit(1 / 256), "s_block": F.lit(1 / 256)})
        p = {x: (F.coalesce(x, F.lit(0)) + PULL * F.col(f"s_{x}")) / (F.coalesce(f"c_{x}", F.lit(0)) + PULL) for x in ("allow", "block")}
        level = level.select("key", *(v.alias(f"p_{x}") for x, v in p.items()))
        shorter = level.selectExpr("key tail", "p_allow s_allow", "p_block s_block")
    return level.select(F.col("key").alias("gram"), (F.log("p_allow") - F.log("p_block")).alias("ratio"))


NUMBERED = "page_id long, url string, host string, path string, rule string, verdict string, held boolean, chunk long"


def _score(key, rows, grams):  # no hints: Spark takes them for another kind of function
    """Mean ratio of each URL's bytes; 0 for empty URLs."""
    known, ratio = (grams.column(x).to_numpy() for x in ("gram", "ratio"))
    order = np.argsort(known)
    found, lengths = _grams(rows.column("url").to_pylist())
    values = ratio[order][np.searchsorted(known[order], found)] if len(found) else np.zeros(0)
    total = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=values, minlength=len(lengths))
    return rows.append_column("score", pa.array(total / np.maximum(lengths, 1), pa.float64()))


def score(model: DataFrame, urls: DataFrame) -> DataFrame:
    """``urls`` (NUMBERED) and their scores. What meets the model is a chunk's different n-grams, one row each."""
    grams = written(urls.select("chunk", "url").mapInArrow(_of_chunks, "chunk long, gram long").distinct(), "chunk-grams")
    wanted = written(grams.select("gram").distinct(), "grams")
    known = grams.join(written(ratios(model, wanted), "gram-ratios"), "gram").select("chunk", "gram", "ratio")
    return written(urls.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_score, f"{NUMBERED}, score double"), "url-scores")


def calibrate(held_out: DataFrame) -> float:
    """The score that best parts held-out allowed and blocked URLs; 0 if one kind is missing."""
    bins = np.zeros((2, BINS))
    at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + RANGE) / (2 * RANGE) * BINS)))
    for r in held_out.groupBy("verdict", at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect():
        bins[int(r["verdict"] == "block"), r["bin"]] = r["n"]
    if not bins.sum(1).all():
        return 0.0
    rates = bins / bins.sum(1, keepdims=True)
    blocked_below = np.r_[0, np.cumsum(rates[1])]
    allowed_above = np.r_[1, 1 - np.cumsum(rates[0])]
    balance = blocked_below + allowed_above
    best = np.flatnonzero(balance >= balance.max() - 1e-12)
    return float(best[len(best) // 2] / BINS * 2 * RANGE - RANGE)


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", chunk: int = CHUNK) -> DataFrame:
    """page_id, host, path, rule, verdict, score."""
    frame = pick(pages, page_id=f"{id_col} long", url=f"{url_col} string")
    host, path = split_url(F.col("url"))
    frame = frame.withColumns({"host": host, "path": path})
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    frame = frame.withColumns({"rule": rule, "verdict": verdict}).withColumn("held", F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0)
    urls = written(frame.mapInArrow(_numbered(chunk), NUMBERED), "urls")
    model = fit(urls.filter("verdict is not null and not held"))
    if model is None:
        scored, low = urls.withColumn("score", F.lit(None).cast("double")), F.lit(False)
    else:
        scored = score(model, urls)
        low = F.coalesce((F.col("url") != "") & (F.col("score") < calibrate(scored.filter("verdict is not null and held"))), F.lit(False))
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("verdict", F.when(low, "block").otherwise("allow")).alias("verdict"), "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages")).withColumn("score", F.round("score", 6))
