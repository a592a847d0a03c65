"""Language identification by Bayesian evidence fusion.

Evidence for each language of the fitted model, and for "und" (none of them):

* text: hashed letter trigrams of the whole text under each language's smoothed
  trigram distribution; for "und" under the uniform one. The mean log likelihood
  counts ``WEIGHT * sqrt(n)`` times for n trigrams, as neighbours are not independent;
* the declared language: how often the corpus declares d where the text says l;
* the address suffix: a fixed table of country suffixes and their language;
* the host: its share of each language by text, smoothed towards that of its
  suffix, which is smoothed towards that of the corpus. These counts cover all rows
  and come from grouped aggregation.

The language is the one with the largest posterior. A document is kept if that
language is not "und" and has a posterior of at least ``MIN_POSTERIOR``.

Every declared language is fitted; the model grows with their number, by ``CELLS`` values
each (64 MB for 500), and so does a row's list of scores. The text model is fitted on at most
about ``TRAIN_ROWS`` declared rows of each language (those with the smallest hashes), whole
texts; everything else covers all rows.

Null, empty or letterless text: lang "und", posterior 1, not kept. Letters without a
trigram of two are no text evidence; the rest decides. A null or unknown
declared language or host is no evidence. Every input row gives one row. A corpus
without declared rows has no language to find: all rows are "und".
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.common import ROW, packed, pick, read, unpacked, written

UND = "und"
CELLS = 1 << 14
TRAIN_ROWS = 400  # a language
WEIGHT = 2.0
KAPPA = 20.0  # rows that a smoothing parent counts for
MIN_POSTERIOR = 0.5
TRUST = 0.8  # how far a country suffix settles the language
MAX_BROADCAST = 100_000  # rejected row keys of 8 bytes
MAX_COUNTS = 400_000  # of hosts or suffixes, one for each language found there
# Country suffixes and their main language.
SUFFIX_LANGUAGES = {
    "at": "de", "de": "de", "li": "de", "es": "es", "mx": "es", "ar": "es", "cl": "es", "co": "es", "pe": "es",
    "fr": "fr", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh",
    "kr": "ko", "se": "sv", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en",
}
DECLARED = "declared is not null and declared <> 'und' and declared <> ''"
# Bytes that are no letters become spaces; letters beyond ASCII keep their UTF-8 bytes.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def cells(text: bytes | None) -> np.ndarray:
    """Hashed trigrams of the lower-cased text that hold two letters' bytes at least."""
    b = np.frombuffer((text or b"").lower().translate(_LETTERS), np.uint8).astype(np.uint32)
    if len(b) < 3:
        b = np.concatenate([[32], b, [32, 32]]).astype(np.uint32)
    x, y, z = b[:-2], b[1:-1], b[2:]
    some = ((x != 32).astype(np.int8) + (y != 32) + (z != 32)) >= 2
    mixed = (x * np.uint32(65599) + y) * np.uint32(65599) + z
    return ((mixed ^ (mixed >> np.uint32(15))) & np.uint32(CELLS - 1))[some]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).to_pylist()
        found: dict[str, np.ndarray] = {}
        for lang, text in zip(langs, batch.column(1).to_pylist(), strict=True):
            found.setdefault(lang, np.zeros(CELLS, np.int64))
            found[lang] += np.bincount(cells(text), minlength=CELLS)
        for lang, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                              "cell": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})


class TextModel:
    def __init__(self, languages: list[str], log_p: np.ndarray):
        self.languages, self.log_p = languages, log_p  # cells x languages

    def scores(self, text: bytes | None) -> tuple[int, list[float]]:
        """Number of trigrams (-1: no letter) and their mean log likelihood by language, the uniform one last."""
        c = cells(text)
        uniform = -float(np.log(CELLS))
        if not len(c) or not self.languages:
            letters = self.languages and (text or b"").translate(_LETTERS).strip()
            return 0 if letters else -1, [uniform] * (len(self.languages) + 1)
        counts = np.bincount(c, minlength=CELLS) if len(c) > CELLS else None
        total = counts @ self.log_p if counts is not None else self.log_p[c].sum(0)
        return len(c), [*(total / len(c)).tolist(), uniform]


def train_below(train_rows: int, n: int) -> int:
    """The ``_place`` that ``train_rows`` of n rows lie below on average; all lie below for n of no more."""
    return (1 << 62) if n <= train_rows else (train_rows << 62) // n


def _place(key: str) -> Column:
    """62 bits of a row's hash: fine enough that any n leaves training rows."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(5), key), 2)


def fit_text(frame: DataFrame, train_rows: int = TRAIN_ROWS) -> TextModel:
    """``frame``: (text, declared, row_key). Fits every declared language."""
    declared = frame.filter(DECLARED).groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a language
    languages = sorted(r["declared"] for r in declared)
    if not languages:
        return TextModel([], np.zeros((CELLS, 0)))
    below = frame.sparkSession.createDataFrame([(r["declared"], train_below(train_rows, r["n"])) for r in declared],
                                               "declared string, below long")
    chosen = frame.join(F.broadcast(below), "declared").filter(_place("row_key") < F.col("below"))
    counts = chosen.select("declared", "text").mapInArrow(_counted, "lang string, cell int, n long")
    counts = counts.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()  # CELLS rows a language
    n = np.zeros((CELLS, len(languages)))
    n[counts.column("cell").to_numpy(), pc.index_in(counts.column("lang"), pa.array(languages, pa.string())).to_numpy()] = \
        counts.column("n").to_numpy()
    return TextModel(languages, np.log((n + 0.5) / (n.sum(0) + 0.5 * CELLS)))


def _scored(model: TextModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(t) for t in batch.column("text").to_pylist()]
            kept = [x for x in batch.schema.names if x != "text"]
            best = [int(np.argmax(s)) if n > 0 else len(model.languages) for n, s in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in kept), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([s for _, s in found], pa.list_(pa.float64())), pa.array(best, pa.int32())],
                [*kept, "n", "score", "best"])
    return run


def _fused(languages: list[str], said: dict[str, dict[int, int]], by_text: np.ndarray, whole: np.ndarray):
    """Posterior from (n, score, declared, suffix, host counts, suffix counts). ``said``: rows by declared language
    and language by text; each pair counts once more."""
    k = len(languages) + 1
    place = {x: i for i, x in enumerate(languages)}
    texts = np.log(by_text)
    names = [*languages, UND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {x: batch.column(x).to_pylist() for x in batch.schema.names}
            lang, posterior = [], []
            for n, score, declared, suffix, at_host, at_suffix in zip(
                    *(col[x] for x in ("n", "score", "declared", "suffix", "at_host", "at_suffix")), strict=True):
                if n < 0:
                    lang.append(UND)
                    posterior.append(1.0)
                    continue
                prior = whole
                for counts in (at_suffix, at_host):  # each level is smoothed towards the one above
                    if counts:
                        c = np.zeros(k)
                        for x in counts:
                            c[x["best"]] = x["n"]
                        prior = (c + KAPPA * prior) / (c.sum() + KAPPA)
                log = np.log(prior) + WEIGHT * np.sqrt(n) * np.asarray(score)
                if declared in place:
                    log = log - texts
                    for i, rows in said.get(declared, {}).items():
                        log[i] += np.log1p(rows)
                at = SUFFIX_LANGUAGES.get(suffix)
                if at in place:
                    e = np.full(k, (1 - TRUST) / k)
                    e[place[at]] += TRUST
                    log = log + np.log(e)
                p = np.exp(log - log.max())
                p /= p.sum()
                lang.append(names[int(p.argmax())])
                posterior.append(float(p.max()))
            keep = [x != UND and p >= MIN_POSTERIOR for x, p in zip(lang, posterior, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row_key"), pa.array(lang), pa.array(posterior), pa.array(keep)],
                ["id", "row_key", "lang", "posterior", "keep"])
    return run


def suffix_of(host: Column) -> Column:
    """What follows the host's last dot; null if there is none."""
    return F.when(host.contains("."), F.lower(F.substring_index(host, ".", -1)))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang",
             host_col: str = "source", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(id, row_key, lang, posterior, keep): one row per input row; row_key is a hash of id and text.

    For web pages take the language attribute as ``declared_col`` and the URL's host as ``host_col``.
    """
    frame = pick(docs, id=f"{id_col} long", text=f"{text_col} string", declared=f"{declared_col} string",
                 host=f"{host_col} string").select(
        "id", F.xxhash64("id", "text").alias("row_key"), F.col("text").cast("binary").alias("text"),
        F.regexp_extract(F.lower("declared"), "^[a-z]+", 0).alias("declared"), "host")
    model = fit_text(frame, train_rows)
    rows = written(frame.mapInArrow(
        _scored(model), "id long, row_key long, declared string, host string, n long, score array<double>, best int"),
        "language-scores").withColumn("suffix", suffix_of(F.col("host")))
    k = len(model.languages) + 1
    sure = rows.filter("n > 0")
    tally = F.count(F.lit(1)).alias("n")
    whole = np.ones(k)
    for r in sure.groupBy("best").agg(tally).collect():
        whole[r["best"]] += r["n"]
    said, by_text = {}, np.full(k, max(1.0, len(model.languages)))
    for r in sure.filter(DECLARED).groupBy("declared", "best").agg(tally).collect():  # pairs of languages that occur
        said.setdefault(r["declared"], {})[r["best"]] = r["n"]
        by_text[r["best"]] += r["n"]
    counted = lambda by: _small(sure.filter(f"{by} is not null").groupBy(by, "best").agg(tally).groupBy(by).agg(
        F.collect_list(F.struct("best", "n")).alias(f"at_{by}")))  # a count for each language at most
    hosts, suffixes = counted("host"), counted("suffix")
    joined = rows.join(hosts, "host", "left").join(suffixes, "suffix", "left").select(
        "id", "row_key", "n", "score", "declared", "suffix", "at_host", "at_suffix")
    return joined.mapInArrow(_fused(model.languages, said, by_text, whole / whole.sum()),
                             "id long, row_key long, lang string, posterior double, keep boolean")


def _small(counts: DataFrame) -> DataFrame:
    """Counts by host or suffix: sent to all tasks if they are few, so that a large host is no hot key;
    else joined by a shuffle, whose hot partitions adaptive execution splits."""
    counts = written(counts, "host-counts")
    n = counts.agg(F.sum(F.size(counts.columns[1]))).first()[0]
    return F.broadcast(counts) if (n or 0) <= MAX_COUNTS else counts


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that ``identify`` keeps, unchanged."""
    rejected = written(identify(docs).filter("not keep").select(F.col("id").alias("_id"), F.col("row_key").alias("_key")).distinct(), "rejected")
    n = rejected.count()
    frame = packed(docs, id="doc_id long", text="text string").select("id", F.xxhash64("id", "text").alias("row_key"), ROW)
    # few are rejected: sent to all tasks if they are, else by a join that shuffles
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key"))  # hashes tell rows of one id apart, not documents
    return unpacked(frame.join(F.broadcast(rejected) if n <= MAX_BROADCAST else rejected, same, "left_anti"), docs)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "lang", F.round("posterior", 6).alias("posterior"), "keep")
