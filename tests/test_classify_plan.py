"""Manifest reading and flattening, validation gate, load plan shapes, plan checks."""

import json

from pyspark.sql import functions as F

from veilspark.operators import classify as C
from veilspark.operators import keys as K
from veilspark.operators import plan as P
from veilspark.operators.protect import hash_projection, plan_for_frame
from veilspark.plans.workloads import _unwrapped_global
from veilspark.sources import fixtures as fx
from veilspark.sources.manifest import read_manifest


def sample_manifest(extra=()):
    attrs = [{"attribute_name": c, "tags": {"sensitivity_category": cat, "sensitivity_type": t}}
             for c, cat, t in fx.SENSITIVE_COLUMNS]
    attrs += list(extra)
    return {"schemas": [{"schema_name": "pci_pii_dataset",
                         "tables": [{"table_name": "customer_records_1", "attributes": attrs}]}]}


def write_json(tmp_path, name, doc):
    p = tmp_path / name
    p.write_text(json.dumps(doc, indent=2))
    return str(p)


def test_read_and_flatten_sample(spark, tmp_path):
    write_json(tmp_path, "a.json", sample_manifest(
        [{"attribute_name": "loyalty_id"},
         {"attribute_name": "bank_name", "tags": {"sensitivity_category": None}}]))
    flat = C.flatten_manifest(read_manifest(spark, str(tmp_path)))
    rows = flat.collect()
    assert len(rows) == 16
    assert {(r.column_name, r.tag_name, r.tag_value) for r in rows if r.column_name == "exp_date"} == {
        ("exp_date", "sensitivity_category", "pci"), ("exp_date", "sensitivity_type", "exp-date")}


def test_null_levels_add_nothing(spark, tmp_path):
    doc = {"schemas": [None, {"schema_name": "a", "tables": None}, {"schema_name": "b", "tables": [
        None, {"table_name": "t", "attributes": None}, {"table_name": "u", "attributes": [
            None, {"attribute_name": "c", "tags": {"x": "1", "y": None}}, {"attribute_name": "d", "tags": {}}]}]}]}
    write_json(tmp_path, "n.json", doc)
    write_json(tmp_path, "e.json", {"schemas": None})
    assert [tuple(r) for r in C.flatten_manifest(read_manifest(spark, str(tmp_path))).collect()] == [("b", "u", "c", "x", "1")]


def _tags(spark, rows):
    return spark.createDataFrame(rows, "schema_name string, table_name string, column_name string, tag_name string, tag_value string")


def test_two_values_for_one_tag_raise(spark):
    import pytest

    one = [("s", "t", "c", "k", "a"), ("s", "t", "c", "k", "a"), ("s", "t", "c", "l", "b")]
    assert C.one_value_per_tag(_tags(spark, one)).count() == 2
    with pytest.raises(Exception, match="two values for the tag s.t.c.k"):
        C.one_value_per_tag(_tags(spark, one + [("s", "t", "c", "k", "z")])).collect()


def test_ambiguous_types_and_registry_raise(spark):
    import pytest

    tags = [("l", "s", "t", "c", "sensitivity_category", "pii"), ("l", "s", "t", "c", "sensitivity_type", "ssn"),
            ("l", "s", "t", "c", "sensitivity_type", "pan")]
    frame = spark.createDataFrame(tags, "catalog_name string, schema_name string, table_name string, column_name string, tag_name string, tag_value string")
    with pytest.raises(Exception, match="two sensitivity types"):
        P.sensitive_columns(frame).collect()
    registry = spark.createDataFrame([("ssn", "k1", "d1"), ("ssn", "k2", "d1")], "pci_pii_attribute_name string, kek_name string, dsk_name string")
    with pytest.raises(Exception, match="several registry rows for ssn"):
        P.unique_registry(registry).collect()


def _scans(df) -> int:
    import re

    return len(re.findall(r"Scan parquet", df._jdf.queryExecution().executedPlan().toString()))


def test_metadata_plans_read_each_input_once(spark, sf_small):
    from veilspark.plans.workloads import _estate_plan
    from veilspark.session import scratch_path

    c = spark.read.parquet(f"{sf_small}/customer.parquet")

    def stored(df):
        path = scratch_path(spark, "frame")
        df.write.parquet(path)
        return spark.read.parquet(path)

    plan, tags = stored(_estate_plan(spark, sf_small)), stored(fx.estate_column_tags(c))
    assert _scans(P.propagate_tags(tags, plan, "vault")) == 2
    assert _scans(P.target_schema(plan, "vault")) == 1
    todo = stored(P.pending_tables(fx.estate_table_catalog(c), "landing", "vault"))
    cols, registry = stored(fx.estate_column_catalog(c)), stored(fx.registry_seed(spark))
    assert _scans(P.load_plan(todo, cols, tags, registry)) == 4


def test_several_files_and_schemas(spark, tmp_path):
    write_json(tmp_path, "1.json", sample_manifest())
    other = sample_manifest()
    other["schemas"][0]["schema_name"] = "other"
    write_json(tmp_path, "2.json", other)
    assert C.flatten_manifest(read_manifest(spark, str(tmp_path))).count() == 32


def test_apply_tags_gate(spark, sf_small):
    c = spark.read.parquet(f"{sf_small}/customer.parquet")
    cols, tags = fx.estate_column_catalog(c), fx.estate_column_tags(c)
    dirty = C.flatten_manifest(fx.estate_manifest(c, True))
    clean = C.flatten_manifest(fx.estate_manifest(c, False))
    gated = C.apply_tags(dirty, cols, tags, "landing")
    assert sorted(map(tuple, gated.collect())) == sorted(map(tuple, tags.collect()))
    applied = C.apply_tags(clean, cols, tags, "landing")
    assert C.missing_tags(clean, applied, "landing").count() == 0
    # one value per (column, tag_name)
    assert applied.groupBy("schema_name", "table_name", "column_name", "tag_name").count().where("count > 1").count() == 0


def test_sensitive_columns_equals_self_join(spark, sf_small):
    tags = fx.estate_column_tags(spark.read.parquet(f"{sf_small}/customer.parquet"))
    keys = ["catalog_name", "schema_name", "table_name", "column_name"]
    cat = tags.where((F.col("tag_name") == "sensitivity_category") & F.col("tag_value").isin("pii", "pci")).select(*keys)
    typ = tags.where(F.col("tag_name") == "sensitivity_type")
    joined = typ.join(cat, keys, "inner").select(*keys, "tag_name", "tag_value")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, P.sensitive_columns(tags).collect()))


def test_protect_plan_is_narrow_and_native(spark, sf_small):
    df = fx.pii_customers(spark.read.parquet(f"{sf_small}/customer.parquet"))
    out = hash_projection(df, plan_for_frame(df, fx.SENSITIVE_TYPE_OF), _unwrapped_global(spark), 512)
    out.write.format("noop").mode("overwrite").save()
    main = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "EvalPython" not in main
    assert "Exchange" not in main
    scan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in out._jdf.queryExecution().simpleString() or "c_custkey" in scan


def test_column_pruning_reaches_scan(spark, sf_small):
    df = fx.pii_customers(spark.read.parquet(f"{sf_small}/customer.parquet")).select("id", "ssn")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "c_name" not in plan and "c_acctbal" not in plan


def test_hash_name_clash_raises(spark):
    df = spark.createDataFrame([("a", "b")], "ssn string, ssn_hash string")
    import pytest

    with pytest.raises(ValueError):
        plan_for_frame(df, {"ssn": "ssn"})


def test_not_null_enforced_in_projection(spark):
    import pytest
    from veilspark.operators.protect import ColumnPlan, TablePlan, hash_projection

    df = spark.createDataFrame([("a",), (None,)], "v string")
    tp = TablePlan("landing", "s", "t", [ColumnPlan("v", nullable=False, position=1)])
    with pytest.raises(Exception, match="NULL in NOT NULL column s.t.v"):
        hash_projection(df, tp, None, 512).collect()
    ok = TablePlan("landing", "s", "t", [ColumnPlan("v", nullable=True, position=1)])
    assert hash_projection(df, ok, None, 512).count() == 2


def test_broken_manifests_are_set_aside(spark, tmp_path):
    from veilspark.sources.manifest import NO_JSON, WRONG_LAYOUT, read_documents, split_manifests

    tag = {"attribute_name": "a", "tags": {"sensitivity_type": "ssn", "none": None}}
    good = {"schemas": [{"schema_name": "s", "tables": [{"table_name": "t", "attributes": [tag]}]}]}
    docs = {
        "one": json.dumps(good, indent=2), "many": json.dumps([good, good]), "nothing": json.dumps([]), "no tags": json.dumps(
            {"schemas": [{"schema_name": "s", "tables": [{"table_name": "t", "attributes": [{"attribute_name": "b"}]}]}]}),
        "cut": json.dumps(good)[:-1], "empty": " \n", "text": "hello", "number": "5", "other": json.dumps({"scheme": []}),
        "mixed": json.dumps([good, {"scheme": []}]), "deep": json.dumps({"schemas": [{"schema_name": "s", "tables": 5}]}),
        "deeper": json.dumps({"schemas": [{"schema_name": "s", "tables": [{"table_name": "t", "attributes": [{"attribute_name": "a", "tags": [1]}]}]}]}),
    }
    for name, text in docs.items():
        (tmp_path / f"{name}.json").write_text(text)
    manifests, rejects = split_manifests(read_documents(spark, str(tmp_path)))
    reasons = {r.path.rsplit("/", 1)[1].replace("%20", " ")[:-5]: r.reason for r in rejects.collect()}
    assert reasons == {"cut": NO_JSON, "empty": NO_JSON, "text": NO_JSON, "number": WRONG_LAYOUT, "other": WRONG_LAYOUT,
                       "mixed": WRONG_LAYOUT, "deep": WRONG_LAYOUT, "deeper": WRONG_LAYOUT}
    assert manifests.count() == 4
    tags = C.flatten_manifest(manifests)
    assert [tuple(r) for r in tags.distinct().collect()] == [("s", "t", "a", "sensitivity_type", "ssn")] and tags.count() == 3


def _broadcast_on(df) -> list[str]:
    """Keys of the plan's broadcast joins, also those in its subqueries."""
    import re

    return re.findall(r"Broadcast(?:Hash|NestedLoop)Join \[?(\w+)", df._jdf.queryExecution().executedPlan().toString())


def test_estate_sized_frames_are_not_broadcast(spark, sf_small):
    c = spark.read.parquet(f"{sf_small}/customer.parquet")  # so small that the planner would broadcast every side
    cols, tags = fx.estate_column_catalog(c), fx.estate_column_tags(c)
    manifest = C.flatten_manifest(fx.estate_manifest(c))
    assert _broadcast_on(C.manifest_mismatch(manifest, cols, "landing")) == []
    assert _broadcast_on(C.missing_tags(manifest, tags, "landing")) == []
    assert _broadcast_on(C.apply_tags(manifest, cols, tags, "landing")) == []
    pending = P.pending_tables(fx.estate_table_catalog(c), "landing", "vault")
    assert _broadcast_on(pending) == []
    plan = P.load_plan(pending, cols, tags, fx.registry_seed(spark))
    assert _broadcast_on(plan) == ["tag_value"]  # the registry: a row per sensitivity type
    assert _broadcast_on(P.propagate_tags(tags, plan, "vault")) == ["tag_value"]
    assert _broadcast_on(P.target_schema(plan, "vault")) == ["tag_value"]
    registry, keks, dsks = fx.estate_key_registry(c), fx.estate_kek_versions(c), fx.estate_dsk_store(c)
    created = F.lit("2026-01-01 00:00:00")
    for df in (K.ensure_keks(registry, keks, created), K.ensure_dsks(registry, dsks, keks), K.unwrap_dsks(dsks, keks),
               K.rotate_dsks(dsks, keks), K.new_kek_versions(keks, keks, created)):
        assert _broadcast_on(df) == []


def test_tenants_of_a_task_are_bounded(spark, sf_small, monkeypatch):
    c = spark.read.parquet(f"{sf_small}/customer.parquet").coalesce(1)
    n = c.count()
    frames = (fx.estate_column_tags, fx.estate_kek_versions, fx.estate_dsk_store, fx.estate_manifest, fx.estate_column_catalog)
    assert [f(c).rdd.getNumPartitions() for f in frames] == [1] * len(frames)
    whole = sorted(map(tuple, fx.estate_column_tags(c).collect()))
    monkeypatch.setattr(fx, "TENANTS_A_TASK", n // 5)
    assert [f(c).rdd.getNumPartitions() for f in frames] == [5] * len(frames)
    assert sorted(map(tuple, fx.estate_column_tags(c).collect())) == whole


def test_tenants_of_a_task_are_bounded_whatever_the_keys(spark, sf_small, monkeypatch):
    c = spark.read.parquet(f"{sf_small}/customer.parquet").coalesce(1)
    n, k = c.count(), F.col("c_custkey")
    monkeypatch.setattr(fx, "TENANTS_A_TASK", n // 5)
    for keys in (F.when(k % 2 == 0, 4).otherwise(k), F.when(k % 2 == 0, None).otherwise(k)):  # half the rows have one key, or none
        tenants = fx._tenants(c.withColumn("c_custkey", keys.cast("bigint")))
        assert max(r["count"] for r in tenants.groupBy(F.spark_partition_id()).count().collect()) <= n // 5 + 1
    hot = c.withColumn("c_custkey", F.when(k % 2 == 0, 4).otherwise(k))
    once = hot.dropDuplicates(["c_custkey", "c_mktsegment"])
    for rows in (lambda x: K.keys_due(fx.estate_kek_versions(x), "2025-06-01 00:00:00"),
                 lambda x: K.ensure_registry(fx.registry_seed(spark, fx.SENSITIVITY_TYPES[:5]), P.sensitive_columns(fx.estate_column_tags(x)), "tag_value"),
                 lambda x: P.sensitive_columns(fx.estate_column_tags(x))):
        assert sorted(map(tuple, rows(hot).collect())) == sorted(map(tuple, rows(once).collect())) != []
