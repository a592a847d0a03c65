"""Driver-side helpers: catalog listings in batches, literal frames, explicit spread, hash joins."""

import datetime as dt

from pyspark.sql import functions as F

from veilspark.operators.partitioning import spread
from veilspark.schemas import TABLE_CATALOG
from veilspark.sources.catalog import snapshot
from veilspark.sources.local import local_frame


def test_snapshot_is_the_same_for_any_batch_size(spark):
    rows = [("landing", "s", f"t{i}", "MANAGED") for i in range(28)]
    for size in (1, 10, 28, 1000):
        df = snapshot(spark, iter(rows), TABLE_CATALOG, "listing", size)
        assert sorted(map(tuple, df.collect())) == sorted(rows)
        assert all("veilspark-scratch" in f for f in df.inputFiles())
    assert snapshot(spark, iter(()), TABLE_CATALOG, "listing").count() == 0


def test_literal_frame_is_one_path_for_all_sizes(spark):
    for n in (1, 12_000):
        rows = [(i, dt.date(2024, 1, 1 + i % 28), f"v{i}", None) for i in range(n)]
        df = local_frame(spark, rows, "i int, d date, s string, x double")
        assert sorted(map(tuple, df.collect())) == rows
        assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()


def test_spread_is_explicit(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/customer.parquet")
    assert spread(df) is df
    assert spread(df, 4).rdd.getNumPartitions() == 4


def test_lookup_on_hash_with_hot_key_matches_brute_force(spark):
    from collections import Counter

    from veilspark.operators.joins import lookup_on_hash

    facts_rows = [("hot" if i % 3 == 0 else (None if i % 11 == 0 else f"k{i % 50}"), i) for i in range(3000)]
    rows_rows = [(j, "hot" if j % 4 == 0 else f"k{j % 60}") for j in range(400)] + [(999, None)]
    facts = spark.createDataFrame(facts_rows, "h string, v long")
    rows = spark.createDataFrame(rows_rows, "id long, h string")
    out = lookup_on_hash(rows, facts, "h", "h", [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")])
    got = {(r.id, r.n, r.s) for r in out.collect()}
    cnt, sm = Counter(), Counter()
    for h, v in facts_rows:
        if h is not None:
            cnt[h] += 1
            sm[h] += v
    want = {(i, cnt[h], sm[h]) for i, h in rows_rows if h is not None and h in cnt}
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_salted_hash_join_equals_plain_join(spark):
    from veilspark.operators.joins import join_on_hash

    left = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 40}") for i in range(2000)] + [(-1, None)],
                                 "id long, h string")
    right = spark.createDataFrame([(f"k{j}", j) for j in range(30)] + [("hot", 99), ("hot", 98)], "rh string, v long")
    for how in ("inner", "left"):
        plain = join_on_hash(left, right, "h", "rh", how)
        salted = join_on_hash(left, right, "h", "rh", how, salt_buckets=8)
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, salted.collect()), key=str)
        assert "__veilspark_salt" not in salted.columns


def test_local_frame_is_jvm_only(spark):
    from veilspark.sources.local import local_frame

    df = local_frame(spark, [("a", 1), ("b", None)], "k string, v int")
    assert df.dtypes == [("k", "string"), ("v", "int")]
    assert sorted(map(tuple, df.collect()), key=str) == [("a", 1), ("b", None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "Python" not in plan
    assert local_frame(spark, [], "k string").count() == 0


def _skewed(spark, n=60_000):
    """A third of all rows on one hash, a twentieth on another, NULLs, and many small ones."""
    h = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 20 == 1, "warm").when(F.col("id") % 50 == 2, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 4001).cast("string")))
    return spark.range(n).select("id", h.alias("h"))


def test_hot_hashes_are_found(spark):
    from veilspark.operators.joins import hot_hashes

    found = hot_hashes(_skewed(spark), "h", 0.02)
    assert set(found) == {"hot", "warm"}
    assert 0.33 < found["hot"] < 0.36
    assert hot_hashes(_skewed(spark).limit(0), "h") == {}


def test_split_join_is_even_and_copies_hot_rows_only(spark):
    from statistics import median

    from veilspark.operators.joins import SALT_COLUMN, hot_hashes, join_on_hash

    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        left = _skewed(spark)
        right = spark.range(4001).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("rh"), F.col("id").alias("v")).union(
            spark.createDataFrame([("hot", -1), ("warm", -2), (None, -3)], "rh string, v long"))
        out = join_on_hash(left, right, "h", "rh", salt_buckets=8)
        plain = join_on_hash(left, right, "h", "rh")
        assert out.count() == plain.count() and out.exceptAll(plain).count() == 0
        copies = join_on_hash(right.withColumnRenamed("rh", "h"), left.select("h").distinct(), "h", "h", salt_buckets=8, hot={"hot": 0.35, "warm": 0.05})
        assert copies.count() == right.join(left.select("h").distinct(), right.rh == F.col("h")).count()
        # rows by task, dealt as the join deals them
        hot = hot_hashes(left, "h")
        n = {h: max(8, -(-int(8 * s * 32 * 1000) // 1000)) for h, s in hot.items()}
        of = F.create_map(*[F.lit(x) for kv in n.items() for x in kv])
        salted = left.where("h is not null").withColumn(SALT_COLUMN, F.pmod(F.xxhash64("id", "h"), F.coalesce(F.try_element_at(of, F.col("h")), F.lit(1)).cast("long")))
        rows = [r["count"] for r in salted.repartition(32, "h", SALT_COLUMN).groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(rows) == 32 and max(rows) < 3 * median(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)


def test_pruned_join_is_exact_and_shuffles_little(spark):
    from veilspark.operators.joins import join_on_hash, prune_by_hash

    left = spark.range(50_000).select("id", F.when(F.col("id") % 97 != 0, F.sha2((F.col("id") % 5000).cast("string"), 256)).alias("h"))
    few = spark.range(50).select((F.col("id") * 100).alias("v"), F.sha2((F.col("id") * 100).cast("string"), 256).alias("rh")).union(
        spark.createDataFrame([(-1, None)], "v long, rh string"))
    pruned = prune_by_hash(left, few, "h", "rh")
    want = join_on_hash(left, few, "h", "rh")
    got = join_on_hash(pruned, few, "h", "rh")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert pruned.count() < 0.1 * left.count()
    assert "Python" not in pruned._jdf.queryExecution().executedPlan().toString()
    assert prune_by_hash(left, few, "h", "rh", max_bytes=8) is left  # no room for the filter: nothing is dropped
    assert prune_by_hash(left, few.limit(0), "h", "rh").count() == 0


def test_joinability_names_a_wrong_salt(spark):
    from veilspark.operators.profile import joinability, sampled_hashes

    hashed = lambda lo, hi, salt: spark.range(lo, hi).select(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("h"))
    halvings = 3
    samples = sampled_hashes(hashed(0, 8000, "s"), "a", {"h": "ssn"}, halvings).union(
        sampled_hashes(hashed(4000, 8000, "s").union(spark.sql("select cast(null as string)")), "b", {"h": "ssn"}, halvings)).union(
        sampled_hashes(hashed(0, 8000, "x"), "c", {"h": "ssn"}, halvings))
    got = {(r["left_table"], r["right_table"]): r for r in joinability(samples, halvings).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    r = got["a", "b"]
    assert abs(r["left_distinct"] - 8000) < 800 and abs(r["common"] - 4000) < 600 and r["containment"] == 1.0 and not r["suspect"]
    assert got["a", "c"]["suspect"] and got["b", "c"]["suspect"]
