"""Joins on salted hash columns.

Hash columns carry the same value for the same clear value of the same
sensitivity type in every table, so anonymized tables join on them as
they would on the clear column. Hash keys inherit the skew of the clear
values (a placeholder such as ``'12'`` or ``'000-00-0000'`` can hold a
large share of all rows), so the many side is aggregated per hash first
(partial aggregation before the shuffle), which turns a many-to-many
join into a lookup of one row per key; AQE's skew-join split handles a
hot key on the remaining side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SALT_COLUMN = "__veilspark_salt"
TOP, TRACKED = 64, 4096          # hot hashes looked for, and counters of the sketch
MAX_FILTER_BYTES = 64 << 20      # of a filter, which every task holds


def hot_hashes(df: DataFrame, column: str, least_share: float | None = None) -> dict[str, float]:
    """Hashes that hold at least this share of the rows (default: a shuffle task's), with their share.

    One pass with a mergeable top-k sketch per task: at most ``TOP`` values come back. Above
    1 / ``TRACKED`` of the rows none is missed; shares may come out too high by as much.
    """
    if least_share is None:
        least_share = 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    c = f"`{column}`"
    found = df.where(F.col(c).isNotNull()).agg(
        F.expr(f"approx_top_k({c}, {TOP}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {r["item"]: r["count"] / found["n"] for r in found["top"] or [] if r["count"] >= least_share * found["n"]}


def join_on_hash(left: DataFrame, right: DataFrame, left_hash: str, right_hash: str,
                 how: str = "inner", salt_buckets: int = 0, hot: dict[str, float] | None = None) -> DataFrame:
    """Equi-join on two hash columns; NULL hashes (NULL clear values) never match.

    ``salt_buckets > 1`` splits the hot hashes of ``left`` (``hot``, by default those that
    ``hot_hashes`` finds) over several tasks, each over at least ``salt_buckets`` and the more
    the larger its share: a left row gets a bucket from a hash of its own content
    (deterministic, so a retried task puts rows in the same buckets), and a right row of a
    hot hash is repeated once per bucket. All other rows of both sides travel once.
    Inner and left joins only.
    """
    r = right.withColumnRenamed(right_hash, left_hash) if right_hash != left_hash else right
    if salt_buckets <= 1:
        return left.join(r, left_hash, how)
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted join supports inner and left joins")
    hot = hot_hashes(left, left_hash) if hot is None else hot
    if not hot:
        return left.join(r, left_hash, how)
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # pieces well below a task's share, so that those that meet in one task by chance don't stand out
    buckets = {h: max(salt_buckets, math.ceil(8 * share * tasks)) for h, share in hot.items()}
    of = F.create_map(*[F.lit(x) for kv in buckets.items() for x in kv])
    n = F.coalesce(F.try_element_at(of, F.col(f"`{left_hash}`")), F.lit(1)).cast("long")
    lcols = [F.col(f"`{c}`") for c in left.columns]
    salted_left = left.withColumn(SALT_COLUMN, F.pmod(F.xxhash64(*lcols), n))
    salted_right = r.withColumn(SALT_COLUMN, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    return salted_left.join(salted_right, [left_hash, SALT_COLUMN], how).drop(SALT_COLUMN)


def prune_by_hash(large: DataFrame, small: DataFrame, large_hash: str, small_hash: str, bits_per_key: int = 16,
                  max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """The rows of ``large`` whose hash may be one of ``small``'s, for a join that follows.

    A filter of bits over the small side's hashes is made with a map-side combined aggregate, comes to the
    tasks as one array of words, and drops rows in the scan, before any shuffle. No row with a match is
    dropped; about 1 in ``bits_per_key`` of the others passes. If the filter would be larger than
    ``max_bytes``, ``large`` comes back as it is.
    """
    keys = small.select(F.col(f"`{small_hash}`").alias("h")).where("h IS NOT NULL").distinct()
    n = keys.count()
    bits = max(64, 1 << max(0, n * bits_per_key - 1).bit_length())
    if bits // 8 > max_bytes:
        return large
    at = F.pmod(F.xxhash64("h"), F.lit(bits))
    words = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("i")).agg(
        F.expr("bit_or(shiftleft(CAST(1 AS BIGINT), CAST(at % 64 AS INT)))").alias("word"))
    dense = small.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("i"), "left")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")))), lambda x: x["word"])
    words = dense.agg(ordered.alias("words")).select("words").scalar()
    c = F.pmod(F.xxhash64(F.col(f"`{large_hash}`")), F.lit(bits))
    masks = F.array(*[F.lit((1 << i) if i < 63 else -(1 << 63)) for i in range(64)])
    hit = F.get(words, F.shiftright(c, 6).cast("int")).bitwiseAND(F.get(masks, (c % 64).cast("int"))) != 0
    return large.where(F.col(f"`{large_hash}`").isNotNull() & hit)


def lookup_on_hash(rows: DataFrame, facts: DataFrame, rows_hash: str, facts_hash: str,
                   aggregates: Sequence[Column], how: str = "inner") -> DataFrame:
    """Attach per-hash aggregates of ``facts`` to each row of ``rows``.

    ``facts`` is grouped by its hash column before the join, so each row
    meets at most one aggregated row whatever the skew of the key.
    """
    per_key = facts.where(F.col(facts_hash).isNotNull()).groupBy(
        F.col(facts_hash).alias(rows_hash)
    ).agg(*aggregates)
    return rows.join(per_key, rows_hash, how)
