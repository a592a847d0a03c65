"""Connected components of a table of links, by alternating star contraction.

Every round is a few aggregations and joins over the links (minima are combined
on the map side, hot nodes sit in joins that adaptive execution can split), and
its result goes to the shared folder. Rounds grow with the logarithm of the
longest path. Nothing is collected but one checksum row a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.llm.common import written


def _round(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    # larger neighbours of every node point to the smallest node around it
    large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    # smaller neighbours, and the node itself, point to the smallest
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").select(
        F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                          F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
    return small.select("x.a", "x.b").filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links``: (a long, b long) -> (node, root): each linked node and the smallest
    node of its component. Self-links, repeated links and direction don't matter;
    rows with a null end are ignored; nodes without links are not returned."""
    now = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a is not null and b is not null and a <> b").distinct(), "links")
    before = None
    while True:
        # a star forest stays as it is: each node has one link, and no root has a parent
        check = now.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if check["n"] == 0 or tuple(check) == before:
            break
        before = tuple(check)
        now = written(_round(now), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
