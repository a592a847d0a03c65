"""STR-1: two availableNow runs over arriving files equal one batch run."""

from pyspark.sql import functions as F

from veilspark.operators import keys as K
from veilspark.operators.protect import hash_projection, plan_for_frame
from veilspark.session import scratch_path
from veilspark.sources import fixtures as fx
from veilspark.streaming.incremental import protect_stream, read_protected


def test_incremental_runs_equal_batch(spark, sf_small):
    _, versions, store = fx.global_keys(spark)
    unwrapped = K.unwrap_dsks(store, versions)
    customers = spark.read.parquet(f"{sf_small}/customer.parquet")
    landing = scratch_path(spark, "landing")
    out = scratch_path(spark, "out")
    ckpt = scratch_path(spark, "ckpt")
    schema = customers.schema
    customers.where("c_custkey % 2 = 0").write.parquet(landing)
    run = dict(sensitive=fx.SENSITIVE_TYPE_OF, unwrapped_keys=unwrapped, transform=fx.pii_customers,
               out_path=out, checkpoint=ckpt, num_bits=512)
    protect_stream(spark, landing, schema, **run)
    n1 = read_protected(spark, out).count()
    customers.where("c_custkey % 2 = 1").write.mode("append").parquet(landing)
    protect_stream(spark, landing, schema, **run)
    got = read_protected(spark, out)
    df = fx.pii_customers(customers)
    want = hash_projection(df, plan_for_frame(df, fx.SENSITIVE_TYPE_OF), unwrapped, 512)
    assert n1 == customers.where("c_custkey % 2 = 0").count()
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a third run with nothing new adds nothing
    protect_stream(spark, landing, schema, **run)
    assert read_protected(spark, out).count() == want.count()


def test_stream_partition_by(spark, sf_small):
    _, versions, store = fx.global_keys(spark)
    unwrapped = K.unwrap_dsks(store, versions)
    customers = spark.read.parquet(f"{sf_small}/customer.parquet")
    landing = scratch_path(spark, "landing-p")
    customers.write.parquet(landing)
    out = protect_stream(spark, landing, customers.schema, sensitive=fx.SENSITIVE_TYPE_OF,
                         unwrapped_keys=unwrapped, transform=fx.pii_customers, num_bits=256,
                         partition_by=["exp_date"])
    got = read_protected(spark, out)
    assert got.count() == customers.count()
    assert got.select("exp_date").distinct().count() == fx.pii_customers(customers).select("exp_date").distinct().count()
    assert "exp_date=" in " ".join(got.inputFiles())
