"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Base spans come from three patterns, leftmost and non-overlapping per kind (fixed
values below). The battery adds spans of kind "random": tokens of ``MIN_TOKEN`` or
more characters ``[A-Za-z0-9+/_=-]`` that look drawn at random.

For each token an encoding is inferred (hex, lower case, base 32, upper or lower case with
digits, letters, or base 64), and three tests ask whether it is uniform random in it: chi-squared over
the alphabet, the number of runs of character classes (digits, cases, signs; vowels and
consonants where all is lower case), and lag-one serial correlation. The score is the sum of
the log10 p-values, without a floor. A random token's is about -1.3 whatever its length;
written words fail the tests, more clearly the longer they are.

So the null hypothesis "ordinary text" has a score distribution of its own for each cell, a
kind of token by a class of lengths: a normal one, fitted to the cell's scores below
``CUT``, where hardly any random token falls, as one cut off there (so neither many secrets nor few
shift it), together with ``PRIOR_ROWS`` tokens whose scores fall with length as words' do. The fit says how many of
the tokens above the cut are ordinary, hence how many are not. A token's p-value is the
null's upper tail, weighted by its cell's odds of being ordinary; the Benjamini-Hochberg
rule at rate ``FDR`` over all tokens' weighted p-values (letters-only ones too) gives the threshold. Where a
kind's length tells too little (words of 20 lower-case letters), nothing is reported.

The texts are read once; what follows works on a histogram of scores by cell, whose size has
a bound. Positions are code points. Null text counts as empty; texts and tokens may have any length.
Every input row gives one row, repeated ones too; equal tokens have equal scores and fare alike.
An empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.common import pick, read, written

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")

MIN_TOKEN = 20
FDR = 0.001
PRIOR_ROWS = 10
PRIOR_MEAN, PRIOR_SD = -0.35, 0.7  # a character; the deviation grows with the square root
CUT = -4.0  # about one random token in 100 scores less
SPREAD = 0.85
STEP, SCORES = 0.25, 800  # bins of scores, from 0 downwards; the last holds all below
CLASSES = 40
BINS = 400  # of -log10 p, 0.1 wide
_RUNS = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "base32": _UPPER + "234567",
    "upper": _UPPER + _DIGITS,
    "base36": _LOWER + _DIGITS,
    "letters": _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
}
KINDS_OF_TOKENS = tuple(ALPHABETS)


def _classes(name: str) -> list[int]:
    if name == "lower":
        return [int(c in "aeiou") for c in _LOWER]
    return [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in ALPHABETS[name]]


def _table(name: str) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Number of each ASCII character, class of each number, and of a uniform random sequence: the chance that
    neighbours differ in class and the covariance of two changes in a row."""
    at = np.zeros(128, np.int64)
    for i, c in enumerate(ALPHABETS[name]):
        at[ord(c)] = i
    kinds = np.array(_classes(name))
    share = np.bincount(kinds) / len(kinds)
    two, three = float((share ** 2).sum()), float((share ** 3).sum())
    return at, kinds, 1 - two, three - two * two


_TABLES = {k: _table(k) for k in ALPHABETS}
_SETS = {k: frozenset(a) for k, a in ALPHABETS.items()}


def encoding(token: str) -> str:
    """The smallest alphabet that holds the token (URL-safe signs count as base 64's)."""
    have = set(token)
    return next((k for k, a in _SETS.items() if have <= a), "base64")


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _log_tail(z: float) -> float:
    """log10 of the upper tail, for any z."""
    if z < 30:
        return math.log10(_upper_tail(z))
    return -(z * z / 2 + math.log(z * math.sqrt(2 * math.pi))) / math.log(10)


def battery(token: str) -> float:
    """Sum of the log10 p-values of the three tests."""
    token = token.rstrip("=").replace("-", "+").replace("_", "/").replace("=", "/")
    name = encoding(token)
    at, kinds, change, cov = _TABLES[name]
    x = at[np.frombuffer(token.encode("ascii"), np.uint8)]
    n, k = len(x), len(ALPHABETS[name])
    if n < 8:
        return -45.0
    counts = np.bincount(x, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    df = k - 1  # Wilson-Hilferty
    score = _log_tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    of = kinds[x]
    changes = int((of[1:] != of[:-1]).sum())
    var = (n - 1) * change * (1 - change) + 2 * (n - 2) * cov
    score += min(0.0, math.log10(2) + _log_tail(abs(changes - (n - 1) * change) / math.sqrt(var)))
    y = x - x.mean()
    square = float((y * y).sum())
    r = float((y[1:] * y[:-1]).sum()) / square if square else 1.0
    return score + min(0.0, math.log10(2) + _log_tail(abs(r + 1 / n) * math.sqrt(n)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end)."""
    found = []
    low = text.lower()  # only to skip texts; may differ in length
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    for run in _RUNS.finditer(text):  # the other two lie inside such runs
        for kind, pattern, least in ((1, ACCESS, MIN_ACCESS), (2, HEX, MIN_HEX)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text, run.start(), run.end())
                      if m.end() - m.start() >= least]
    return sorted(found)


def length_class(n: int) -> int:
    return min(int(4 * math.log2(n)), CLASSES - 1)


def cell(token: str) -> int:
    return KINDS_OF_TOKENS.index(encoding(token.rstrip("="))) * CLASSES + length_class(len(token))


def score_bin(token: str) -> int:
    return min(int(-battery(token) / STEP), SCORES - 1)


SCANNED = "doc_id long, base array<struct<s:int,k:int,e:int>>, tokens array<struct<s:int,e:int,c:int,b:int>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    kinds = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("c", pa.int32()), ("b", pa.int32())]))
    for batch in batches:
        base, tokens = [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            base.append([{"s": s, "k": k, "e": e} for s, k, e in base_spans(text)])
            tokens.append([{"s": m.start(), "e": m.end(), "c": cell(m[0]), "b": score_bin(m[0])}
                           for m in _RUNS.finditer(text) if m.end() - m.start() >= MIN_TOKEN])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, spans), pa.array(tokens, kinds)],
                                         ["doc_id", "base", "tokens"])


def _normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, as one minus the tail."""
    return np.array([_upper_tail(-v) for v in np.ravel(z)]).reshape(np.shape(z))


def _random_share() -> np.ndarray:
    """Share of random tokens in each bin of scores: of three independent p-values, widened, as the three are
    neither quite independent nor exact (``SPREAD`` covers what random tokens of 20 to 64 characters show)."""
    x = np.arange(SCORES + 1) * STEP * math.log(10) * SPREAD
    return -np.diff(np.exp(-x) * (1 + x + x * x / 2))


_RANDOM = _random_share()


class Null(NamedTuple):
    mean: float
    sd: float
    ordinary: float  # tokens of the cell
    others: float

    def log_p(self, b: int) -> float:
        """-log10 of the upper tail at a bin's lower end, weighted by the odds (``others`` above 0)."""
        return -_log_tail((-(b + 1) * STEP - self.mean) / self.sd) - math.log10(self.ordinary / self.others)


def fit_null(hist: np.ndarray, length: float) -> Null:
    """``hist``: tokens by bin of scores. Maximum likelihood of a normal distribution cut off at ``CUT``, by search.
    What scores less than -1 a character (rows of dashes, repeated digits) is farther off than words and left out."""
    cut = int(-CUT / STEP)
    mid = -(np.arange(SCORES) + 0.5) * STEP
    mean, sd = PRIOR_MEAN * length, PRIOR_SD * math.sqrt(length)
    prior = np.exp(-((mid - mean) / sd) ** 2 / 2)
    own = np.where((np.arange(SCORES) >= cut) & (mid >= -length), hist, 0).astype(float)
    low = 1.5 * hist[:cut].sum() * _RANDOM / _RANDOM[:cut].sum()  # random ones that may have scored low
    own = np.maximum(own - np.where(low > 0.02, np.ceil(low + 2 * np.sqrt(low)), low), 0)
    seen = own + np.where(np.arange(SCORES) >= cut, PRIOR_ROWS * prior / prior.sum(), 0)
    n, a, b = seen.sum(), (seen * mid).sum(), (seen * mid * mid).sum()
    centre, spread = a / n, max(math.sqrt(max(b / n - (a / n) ** 2, 0)), STEP)
    best = None
    lo, hi, smin, smax = centre - spread, min(0.0, centre + 6 * spread), spread / 3, 3 * spread
    for _ in range(4):  # a grid, then finer ones about its best point
        m, s = np.meshgrid(np.linspace(lo, hi, 25), np.geomspace(smin, smax, 25), indexing="ij")
        inside = np.maximum(_normal((CUT - m) / s), 1e-12)
        ll = -(b - 2 * m * a + m * m * n) / (2 * s * s) - n * np.log(s) - n * np.log(inside)
        i, j = np.unravel_index(int(np.argmax(ll)), ll.shape)
        best = (float(m[i, j]), float(s[i, j]), float(inside[i, j]))
        wide = (hi - lo) / 12
        lo, hi = best[0] - wide, min(0.0, best[0] + wide)
        ratio = (smax / smin) ** (1 / 12)
        smin, smax = best[1] / ratio, best[1] * ratio
    below = float(own.sum())
    above = below * (1 - best[2]) / best[2]
    return Null(best[0], best[1], below + above + 1, float(hist[:cut].sum()) - above)


def null_model(rows: Iterable[tuple[int, int, int]], fdr: float = FDR) -> dict[int, int]:
    """(cell, bin, tokens) -> by cell, the number of bins from 0 downwards whose tokens are reported; none below ``CUT``."""
    hists: dict[int, np.ndarray] = {}
    for c, b, n in rows:
        hists.setdefault(c, np.zeros(SCORES, np.int64))[b] += n
    nulls = {c: fit_null(h, 2 ** ((c % CLASSES + 0.5) / 4)) for c, h in hists.items()}
    total = sum(int(h.sum()) for h in hists.values())
    others = sum(max(x.others, 0.0) for x in nulls.values())
    share = math.log10(total / others) if others > 0 else 0.0  # weights average to the plain rule's
    bins: dict[int, int] = {}
    levels = {}
    for c, h in hists.items():
        for b in np.flatnonzero(h).tolist():
            level = 0  # below the cut, and where all is ordinary
            if nulls[c].others > 0 and (b + 1) * STEP <= -CUT:
                level = max(0, min(int(10 * (nulls[c].log_p(b) + share)), BINS - 1))
            levels[c, b] = level
            bins[level] = bins.get(level, 0) + int(h[b])
    least = threshold(bins, fdr)
    out: dict[int, int] = {}
    for (c, b), level in levels.items():
        if level and level / 10 >= least:
            out[c] = max(out.get(c, 0), b + 1)
    return out


def threshold(bins: dict[int, int], fdr: float = FDR) -> float:
    """Benjamini-Hochberg: the least -log10 p such that the expected share of false finds is at most ``fdr``."""
    total, above, best = sum(bins.values()), 0, math.inf
    for b in sorted(bins, reverse=True):
        above += bins[b]
        if total * 10 ** (-b / 10) <= fdr * above:
            best = b / 10
    return best


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _report(reported: dict[int, int]):
    def line(spans):
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, base, tokens in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = [(x["s"], x["k"], x["e"]) for x in base]
                more = [(x["s"], 3, x["e"]) for x in tokens
                        if x["b"] < reported.get(x["c"], 0)]
                n = [sum(k == i for _, k, _ in own) for i in range(3)]
                rows.append((doc_id, *n, hashlib.sha256(line(own).encode()).hexdigest(), line(own + more)))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             [x.split()[0] for x in RESULT.split(", ")])
    return run


def scan(docs: DataFrame, fdr: float = FDR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per input row."""
    frame = pick(docs, doc_id=f"{id_col} long", text=f"{text_col} string")
    scanned = written(frame.mapInArrow(_scan, SCANNED), "scanned")
    cells = scanned.select(F.explode("tokens").alias("t")).groupBy("t.c", "t.b").agg(F.count(F.lit(1)).alias("n"))
    return scanned.mapInArrow(_report(null_model(cells.toLocalIterator(), fdr)), RESULT)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
