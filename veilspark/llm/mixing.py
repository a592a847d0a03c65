"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its share of the target size over its own size
(in characters of text). Every document draws its number of copies from the Poisson
distribution of that mean, by inverting the cumulative distribution at a number
in [0, 1) that is hashed from the seed and the doc_id: the same document gets the same
number in any run and on any cluster. Each copy becomes a row, and all rows are dealt
out anew by a hash of seed, document and copy: a row's partition and its place in
there (rising ``order_key``) are random, so the order is a global shuffle.

``weights`` names sources and their weights; all other sources, the null source
too, share ``rest`` at one common rate. What reaches the driver is one total per named
source. A source without a character has rate 0. Rates are means: no cap holds.

Null text has size 0, null ids draw as the empty id; repeated rows draw the same
number and are each copied; no documents: no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm.common import ROW, packed, pick, read, shuffle_partitions, unpacked

WEIGHTS = {"src0": 0.20, "src1": 0.10, "src2": 0.10, "src3": 0.05}
REST = 0.55
SEED = 17


def poisson_cdf(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until double precision has no more to add."""
    if rate <= 0:
        return [1.0]
    out, total, k = [], 0.0, 0
    while k <= rate or math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1)) > 1e-17:
        total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        out.append(total)
        k += 1
    return out


def _pool(source: Column, names: list[str]) -> Column:
    return F.when(source.isin(names), source) if names else F.lit(None).cast("string")


def rates(docs: DataFrame, weights: dict[str, float], rest: float, epochs: float = 1.0,
          source_col: str = "source", text_col: str = "text") -> dict[str | None, float]:
    """Mean repetition rate of each named source, and of the rest under None."""
    frame = pick(docs, source=f"{source_col} string", text=f"{text_col} string")
    sizes = {r["pool"]: r["n"] or 0 for r in frame.groupBy(_pool(F.col("source"), list(weights)).alias("pool"))
             .agg(F.sum(F.char_length("text")).alias("n")).collect()}
    wanted = {**weights, None: rest}
    total, weight = sum(sizes.values()), sum(wanted.values())
    return {k: epochs * total * w / weight / sizes[k] if sizes.get(k) else 0.0 for k, w in wanted.items()}


def _digest(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def mix(docs: DataFrame, weights: dict[str, float], rest: float, seed: int = SEED, epochs: float = 1.0,
        partitions: int | None = None, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """(_row, doc_id, copy, order_key): a row per copy, copies from 0, in shuffled order."""
    table = rates(docs, weights, rest, epochs, source_col, text_col)
    frame = packed(docs, doc_id=f"{id_col} string", source=f"{source_col} string")
    doc = F.coalesce("doc_id", F.lit(""))
    u = F.conv(F.substring(_digest(seed, doc), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    cdf = F.array(*map(F.lit, poisson_cdf(table[None])))
    for name in weights:
        cdf = F.when(F.col("source") == name, F.array(*map(F.lit, poisson_cdf(table[name])))).otherwise(cdf)
    n = F.size(F.filter(cdf, lambda x: x <= u))
    copies = frame.withColumn("n", n).filter("n > 0").select(ROW, "doc_id", F.explode(F.expr("sequence(0, n - 1)")).alias("copy"))
    copies = copies.withColumn("order_key", _digest(seed + 1, F.coalesce("doc_id", F.lit("")), F.col("copy").cast("string")))
    return copies.repartition(partitions or 2 * shuffle_partitions(docs.sparkSession), "order_key").sortWithinPartitions("order_key")


def mix_stage(docs: DataFrame, weights: dict[str, float] | None = None, rest: float = REST) -> DataFrame:
    return unpacked(mix(docs, WEIGHTS if weights is None else weights, rest), docs)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(read(spark, sf_dir, "documents"), doc_id="doc_id long", source="source string", text="text string")
    return mix(docs, WEIGHTS, REST).select(
        F.col(f"{ROW}._c0").alias("doc_id"), F.col(f"{ROW}._c1").alias("source"), F.col(f"{ROW}._c2").alias("text"),
        F.col("copy").cast("int").alias("copy"), "order_key")


OP3_SQL = f"""
WITH w(pool, weight) AS (VALUES {", ".join(f"('{k}', {v}::DOUBLE)" for k, v in WEIGHTS.items())}, ('', {REST}::DOUBLE)),
     p AS (SELECT *, CASE WHEN source IN ({", ".join(f"'{k}'" for k in WEIGHTS)}) THEN source ELSE '' END AS pool FROM documents),
     s AS (SELECT pool, sum(length(text))::DOUBLE AS size FROM p GROUP BY pool),
     r AS (SELECT pool, (SELECT sum(size) FROM s) * weight / (SELECT sum(weight) FROM w) / size AS rate
           FROM w JOIN s USING (pool) WHERE size > 0),
     f AS (SELECT pool, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY pool ORDER BY k) AS f
           FROM r, range(0, 400) AS x(k)),
     u AS (SELECT p.*, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM p),
     n AS (SELECT doc_id, source, text, u.u AS u, (SELECT count(*) FROM f WHERE f.pool = u.pool AND f.f <= u.u) AS n FROM u)
SELECT doc_id, source, text, c::INTEGER AS copy,
       md5('{SEED + 1}:' || coalesce(doc_id::VARCHAR, '') || ':' || c::VARCHAR) AS order_key
FROM n, unnest(range(0, n.n)) AS x(c)
"""
