"""End to end over the session catalog: classify, keys, vault, views, anonymized, rotation."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from veilspark.plans import arrivals as AR
from veilspark.plans import pipelines as PL
from veilspark.plans import publish as PU
from veilspark.plans import store
from veilspark.session import shared_dir
from veilspark.sources import fixtures as fx
from veilspark.sources.files import table_location
from veilspark.storage import Files

SCHEMA = "pci_pii_dataset"


def _manifest(tmp_path, extra_table=None):
    attrs = [{"attribute_name": c, "tags": {"sensitivity_category": cat, "sensitivity_type": t}}
             for c, cat, t in fx.SENSITIVE_COLUMNS]
    tables = [{"table_name": "customer_records_1", "attributes": attrs},
              {"table_name": "order_records", "attributes": [
                  {"attribute_name": "cust_ssn", "tags": {"sensitivity_category": "pii", "sensitivity_type": "ssn"}}]}]
    if extra_table:
        tables.append(extra_table)
    d = tmp_path / "manifest"
    d.mkdir(exist_ok=True)
    (d / "m.json").write_text(json.dumps({"schemas": [{"schema_name": SCHEMA, "tables": tables}]}))
    return str(d)


@pytest.fixture(scope="module")
def estate(spark, sf_small, tmp_path_factory):
    store.ensure_core(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS landing__{SCHEMA}")
    c = spark.read.parquet(f"{sf_small}/customer.parquet")
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    fx.pii_customers(c).write.format("parquet").mode("overwrite").saveAsTable(f"landing__{SCHEMA}.customer_records_1")
    fx.orders_pii(o).write.format("parquet").mode("overwrite").saveAsTable(f"landing__{SCHEMA}.order_records")
    spark.read.parquet(f"{sf_small}/nation.parquet").write.format("parquet").mode("overwrite").partitionBy(
        "n_regionkey").saveAsTable(f"landing__{SCHEMA}.nation")
    return tmp_path_factory.mktemp("pipe")


def test_classify_gate_then_apply(spark, estate):
    bad = _manifest(estate, {"table_name": "customer_records_1", "attributes": [
        {"attribute_name": "nickname", "tags": {"sensitivity_category": "pii", "sensitivity_type": "name"}}]})
    r = PL.classify(spark, bad)
    assert r.applied == 0 and r.mismatch_count == 1
    assert [m.column_name for m in r.mismatches.collect()] == ["nickname"]
    good = _manifest(estate)
    r = PL.classify(spark, good)
    assert r.mismatch_count == 0 and r.applied == 18
    assert PL.classify(spark, good).applied == 0


def test_keys_and_vault_load(spark, estate):
    counts = PL.bootstrap_keys(spark)
    assert counts["registry"] == 8 and counts["dsks"] == 8
    assert PL.bootstrap_keys(spark) == counts
    loaded = PL.load_vault(spark, num_bits=512)
    assert sorted(loaded) == ["customer_records_1", "nation", "order_records"]
    v = spark.table(f"vault__{SCHEMA}.customer_records_1")
    assert v.columns[:4] == ["id", "full_name", "full_name_hash", "email"]
    dsk = {r.attribute: bytes(r.dsk) for r in PL.unwrapped_keys(spark).collect()}
    for r in v.where(F.col("ssn").isNotNull()).limit(20).collect():
        assert r.ssn_hash == hashlib.sha512(dsk["ssn"] + r.ssn.encode()).hexdigest()
    assert v.where(F.col("ssn").isNull() & F.col("ssn_hash").isNotNull()).count() == 0
    assert PL.load_vault(spark) == []


def test_hash_join_equals_clear_join(spark, estate):
    cv = spark.table(f"vault__{SCHEMA}.customer_records_1")
    ov = spark.table(f"vault__{SCHEMA}.order_records")
    by_hash = cv.join(ov, cv.ssn_hash == ov.cust_ssn_hash).count()
    by_clear = cv.join(ov, cv.ssn == ov.cust_ssn).count()
    assert by_hash == by_clear > 0


def test_masked_view_follows_membership(spark, estate):
    view = f"vault__{SCHEMA}.customer_records_1__masked"
    me = spark.sql("select session_user() u").first().u
    r = spark.table(view).where("id = 2").first()
    assert r.ssn.startswith("***-**-") and r.ssn_hash is not None
    store.append(spark.createDataFrame([("pii_readers", me)], "grp string, member string"), "group_members")
    r2 = spark.table(view).where("id = 2").first()
    clear = spark.table(f"vault__{SCHEMA}.customer_records_1").where("id = 2").first()
    assert r2.ssn == clear.ssn


def test_anonymized_has_no_clear_values(spark, estate):
    assert sorted(PL.load_anonymized(spark, schemas=[SCHEMA])) == ["customer_records_1", "nation", "order_records"]
    a = spark.table(f"anonymized__{SCHEMA}.customer_records_1")
    v = spark.table(f"vault__{SCHEMA}.customer_records_1")
    j = a.alias("a").join(v.alias("v"), "id")
    assert j.where(F.col("a.ssn") == F.col("v.ssn")).count() == 0
    assert j.where(F.col("a.ssn_hash") != F.col("v.ssn_hash")).count() == 0
    assert j.where(F.col("a.bank_name") != F.col("v.bank_name")).count() == 0
    tags = store.read(spark, store.tags_of("anonymized"))
    assert tags.where("column_name = 'ssn_hash' and tag_name = 'derived'").count() == 1
    assert PL.load_anonymized(spark, schemas=[SCHEMA]) == []


def test_rotation_keeps_hashes_valid(spark, estate):
    before = {r.attribute: bytes(r.dsk) for r in PL.unwrapped_keys(spark).collect()}
    assert PL.rotate_keys(spark) is None          # nothing due: no new store version
    versions_before = store.read(spark, "kek_versions").count()
    assert PL.rotate_keys(spark, force=True) is not None
    assert store.read(spark, "kek_versions").count() == versions_before + 8
    after = {r.attribute: bytes(r.dsk) for r in PL.unwrapped_keys(spark).collect()}
    assert before == after
    latest = store.read(spark, "kek_versions").groupBy("kek_name").agg(F.max_by("version", "created").alias("l"))
    ds = store.read(spark, "dsk_store").join(latest, "kek_name")
    assert ds.where(F.col("kek_version") != F.col("l")).count() == 0


def test_create_and_append_landing_table(spark, sf_small):
    from pyspark.sql import types as T

    struct = T.StructType([T.StructField(n, T.StringType(), True) for n, _, _ in fx.SENSITIVE_COLUMNS])
    name = PL.create_table(spark, "landing", "extra", "customer_records_2", struct)
    assert spark.table(name).count() == 0
    rows = fx.pii_customers(spark.read.parquet(f"{sf_small}/customer.parquet"))
    PL.append_table(rows, "landing", "extra", "customer_records_2")
    PL.append_table(rows, "landing", "extra", "customer_records_2")
    assert spark.table(name).count() == 2 * rows.count()
    PL.create_table(spark, "landing", "extra", "customer_records_2", struct, replace=True)
    assert spark.table(name).count() == 0


def test_no_key_material_in_plans(spark, estate):
    from veilspark.operators.protect import hash_projection, plan_for_frame

    keks = [bytes(r.kek).hex() for r in store.read(spark, "kek_versions").collect()]
    dsks = [bytes(r.dsk).hex() for r in PL.unwrapped_keys(spark).collect()]
    src = spark.table(f"landing__{SCHEMA}.customer_records_1")
    out = hash_projection(src, plan_for_frame(src, fx.SENSITIVE_TYPE_OF), PL.unwrapped_keys(spark), 512)
    out.write.format("noop").mode("overwrite").save()
    text = out._jdf.queryExecution().toString().lower() + out._jdf.queryExecution().executedPlan().toString().lower()
    assert keks and dsks
    assert not any(k in text for k in keks + dsks)


def test_partitioning_is_kept(spark, estate):
    for layer in ("landing", "vault", "anonymized"):
        assert PL.partition_columns(spark, f"{layer}__{SCHEMA}.nation") == ["n_regionkey"], layer
    assert spark.table(f"anonymized__{SCHEMA}.nation").count() == 25


def test_layer_tags_are_tables_of_their_own(spark, estate):
    assert {r.catalog_name for r in store.read(spark, store.tags_of("vault")).collect()} == {"vault"}
    plan = store.read(spark, store.tags_of("vault"))._jdf.queryExecution().executedPlan().toString()
    assert "column_tags__landing" not in plan
    whole = store.read(spark, "column_tags")
    assert whole.count() == sum(store.read(spark, store.tags_of(x)).count() for x in store.TAG_LAYERS)


def test_published_tags_replace_those_of_the_same_column_and_name(spark, estate):
    tags = store.read(spark, store.tags_of("vault"))
    before = sorted(map(tuple, tags.collect()))
    PL._publish_tags(tags, "vault")
    assert sorted(map(tuple, store.read(spark, store.tags_of("vault")).collect())) == before
    changed = tags.where("column_name = 'ssn' and tag_name = 'sensitivity_category'").withColumn("tag_value", F.lit("pci"))
    PL._publish_tags(changed, "vault")
    after = store.read(spark, store.tags_of("vault"))
    assert after.count() == len(before)
    assert after.groupBy(*after.columns[:-1]).count().where("count > 1").count() == 0
    PL._publish_tags(spark.createDataFrame(before, after.schema), "vault")


def test_catalog_listings(spark, estate):
    from veilspark.sources.catalog import column_catalog, table_catalog

    small = table_catalog(spark, ["landing", "vault"], batch_rows=2)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, table_catalog(spark, ["landing", "vault"]).collect()))
    one = table_catalog(spark, ["landing"]).where("table_name = 'customer_records_1'")
    cols = column_catalog(spark, one, batch_rows=3)
    assert cols.count() == 10 and {r.table_name for r in cols.collect()} == {"customer_records_1"}


# --------------------------------------------------------------------------- failures

TAG = "catalog_name string, schema_name string, table_name string, column_name string, tag_name string, tag_value string"


def _landing(spark, schema, table, rows, struct, tags, **options):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS landing__{schema}")
    w = spark.createDataFrame(rows, struct).write.format("parquet").mode("overwrite")
    w = w.partitionBy(*options["partition_by"]) if "partition_by" in options else w
    w.saveAsTable(f"landing__{schema}.{table}")
    if tags:
        store.append(spark.createDataFrame(
            [("landing", schema, table, c, n, v) for c, t in tags.items()
             for n, v in (("sensitivity_category", "pii"), ("sensitivity_type", t))], TAG), store.tags_of("landing"))


def _vault(spark, schema):
    return [t.name for t in spark.catalog.listTables(f"vault__{schema}")] if spark.catalog.databaseExists(f"vault__{schema}") else []


@pytest.mark.parametrize("kind,message", [
    ("unkeyed", "no registered salt key for bad_unkeyed.t.c"), ("clash", "'c_hash' already exists"),
    ("partitioned", "partitioned by sensitive columns: c"), ("foreign", "no load has made: bad_foreign.t")])
def test_refused_before_anything_is_written(spark, estate, kind, message):
    schema = f"bad_{kind}"
    column = "iban" if kind == "unkeyed" else "ssn"
    struct = "id int, c string, c_hash string" if kind == "clash" else "id int, c string"
    row = (1, "v", "w") if kind == "clash" else (1, "v")
    _landing(spark, schema, "t", [row], struct, {"c": column}, **({"partition_by": ["c"]} if kind == "partitioned" else {}))
    _landing(spark, schema, "good", [(1, "v")], "id int, s string", {"s": "ssn"})
    if kind == "foreign":
        spark.sql(f"CREATE DATABASE IF NOT EXISTS vault__{schema}")
        spark.range(3).write.format("parquet").saveAsTable(f"vault__{schema}.t")
    before = _vault(spark, schema)
    with pytest.raises(RuntimeError, match=message.replace(".", r"\.")):
        PL.load_vault(spark, schemas=[schema])
    assert _vault(spark, schema) == before
    if kind == "foreign":
        assert spark.table(f"vault__{schema}.t").columns == ["id"]


def test_failed_table_stops_no_other_and_is_redone(spark, estate):
    from pyspark.sql import types as T

    struct = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("s", T.StringType(), True)])
    PL.create_table(spark, "landing", "half", "broken", struct)
    spark.createDataFrame([(None, "a"), (2, "b")], "id int, s string").write.format("parquet").mode("append").insertInto("landing__half.broken")
    store.append(spark.createDataFrame([("landing", "half", "broken", "s", n, v) for n, v in (
        ("sensitivity_category", "pii"), ("sensitivity_type", "ssn"))], TAG), store.tags_of("landing"))
    _landing(spark, "half", "fine", [(1, "123-45-6789")], "id int, s string", {"s": "ssn"})
    with pytest.raises(PL.LoadError) as e:
        PL.load_vault(spark, schemas=["half"])
    assert e.value.loaded == ["fine"] and list(e.value.failed) == ["half.broken"]
    assert "NOT NULL" in e.value.failed["half.broken"]
    assert spark.table("vault__half.broken").count() == 0 and "broken__masked" in _vault(spark, "half")
    assert store.read(spark, store.tags_of("vault")).where("schema_name = 'half' and table_name = 'broken'").count() == 0
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string").write.format("parquet").mode("overwrite").insertInto("landing__half.broken")
    assert PL.load_vault(spark, schemas=["half"]) == ["broken"]
    assert spark.table("vault__half.broken").count() == 2
    strict = store.read(spark, "not_null").where("schema_name = 'half'")
    assert sorted(r.catalog_name for r in strict.collect()) == ["landing", "vault"]
    assert sorted(PL.load_anonymized(spark, schemas=["half"])) == ["broken", "fine"]


def test_interrupted_load_is_redone(spark, estate, monkeypatch):
    _landing(spark, "cut", "t", [(i, f"123-45-{i:04}") for i in range(50)], "id int, s string", {"s": "ssn"})
    for step in ("_create_target", "create_masked_view", "_fill", "_publish_tags", "_finish"):
        real = getattr(PL, step)

        def crash(*a, real=real, **k):
            if real.__name__ == "_fill":
                real(*a, **k)  # data written, nothing recorded
            raise KeyboardInterrupt

        monkeypatch.setattr(PL, step, crash)
        with pytest.raises(KeyboardInterrupt):
            PL.load_vault(spark, schemas=["cut"], parallelism=1)
        monkeypatch.setattr(PL, step, real)
        if spark.catalog.databaseExists("vault__cut") and spark.catalog.tableExists("vault__cut.t") and spark.table("vault__cut.t").count():
            assert "t__masked" in _vault(spark, "cut")
    assert PL.load_vault(spark, schemas=["cut"]) == ["t"]
    assert spark.table("vault__cut.t").count() == 50
    tags = store.read(spark, store.tags_of("vault")).where("schema_name = 'cut'")
    assert tags.count() == 5 and tags.distinct().count() == 5
    assert PL.load_vault(spark, schemas=["cut"]) == []


def test_scans_do_not_grow_with_chunks(spark, estate, monkeypatch):
    """Plan, listing and tags are read a fixed number of times, however many chunks there are."""
    for i in range(6):
        _landing(spark, f"chunks", f"t{i}", [(1, "x")], "id int, s string", {"s": "ssn"})
    reads = []
    real = store.read
    monkeypatch.setattr(store, "read", lambda spark, name: reads.append(name) or real(spark, name))
    assert len(PL.load_vault(spark, schemas=["chunks"], chunk_size=1)) == 6
    by_one = sorted(x for x in reads)
    for i in range(6):
        _landing(spark, f"chunks2", f"t{i}", [(1, "x")], "id int, s string", {"s": "ssn"})
    reads.clear()
    assert len(PL.load_vault(spark, schemas=["chunks2"], chunk_size=64)) == 6
    assert sorted(x for x in reads) == by_one


def test_arriving_rows_reach_both_layers(spark, estate, monkeypatch):
    _landing(spark, "late", "flat", [(i, f"123-45-{i:04}") for i in range(20)], "id int, s string", {"s": "ssn"})
    _landing(spark, "late", "parts", [(i, f"123-45-{i:04}", i % 3) for i in range(30)], "id int, s string, p int", {"s": "ssn"},
             partition_by=["p"])
    assert sorted(PL.load_vault(spark, schemas=["late"])) == ["flat", "parts"]
    assert sorted(PL.load_anonymized(spark, schemas=["late"])) == ["flat", "parts"]
    assert AR.load_arrivals(spark, schemas=["late"]) == []
    untouched = {f for f in spark.table("vault__late.parts").inputFiles() if "p=1" not in f}
    spark.createDataFrame([(100, "111-11-1111")], "id int, s string").write.format("parquet").mode("append").insertInto("landing__late.flat")
    spark.createDataFrame([(101, "111-11-1111", 1)], "id int, s string, p int").write.format("parquet").mode("append").insertInto("landing__late.parts")

    real = store.append  # cut short after the data: the run is redone
    monkeypatch.setattr(store, "append", lambda df, name: (_ for _ in ()).throw(KeyboardInterrupt()) if name == "loaded_files" else real(df, name))
    with pytest.raises(KeyboardInterrupt):
        AR.load_arrivals(spark, schemas=["late"])
    monkeypatch.setattr(store, "append", real)
    assert sorted(AR.load_arrivals(spark, schemas=["late"])) == ["flat", "parts"]
    for table, n in (("flat", 21), ("parts", 31)):
        for layer in ("landing", "vault", "anonymized"):
            t = spark.table(f"{layer}__late.{table}")
            assert t.count() == n and t.select("id").distinct().count() == n, (layer, table)
        assert spark.table(f"anonymized__late.{table}").where("s = '111-11-1111'").count() == 0
        assert spark.table(f"vault__late.{table}__masked").count() == n
    assert untouched <= set(spark.table("vault__late.parts").inputFiles())  # nothing is written anew
    audits = store.read(spark, "load_audits").where("schema_name = 'late' and target_catalog = 'vault'")
    assert sorted((r.table_name, r.batch != "", r.rows) for r in audits.collect()) == [
        ("flat", False, 20), ("flat", True, 1), ("parts", False, 30), ("parts", True, 1)]
    assert AR.load_arrivals(spark, schemas=["late"]) == []


def test_changed_group_takes_effect(spark, estate):
    me = spark.sql("select session_user() u").first().u
    store.append(spark.createDataFrame([("o'brien\\s", me)], "grp string, member string"), "group_members")
    PL.register_mask_functions(spark, "nobody")
    assert spark.sql("select core.ssn_mask('123-45-6789') v").first().v == "***-**-6789"
    PL.register_mask_functions(spark, "o'brien\\s")
    assert spark.sql("select core.ssn_mask('123-45-6789') v").first().v == "123-45-6789"
    PL.register_mask_functions(spark)


@pytest.mark.parametrize("step", ["_write_version", "_point_view", "after write"])
def test_publish_survives_a_crash_at_each_step(spark, estate, monkeypatch, step):
    name = "dsk_store"
    before = sorted(map(str, store.read(spark, name).collect()))
    real_write, real_point = store._write_version, store._point_view

    def crash(*a):
        if step == "after write":
            real_write(*a)
        raise KeyboardInterrupt

    monkeypatch.setattr(store, "_point_view" if step == "_point_view" else "_write_version", crash)
    with pytest.raises(KeyboardInterrupt):
        store.publish(store.read(spark, name).limit(0), name)
    monkeypatch.setattr(store, "_write_version", real_write)
    monkeypatch.setattr(store, "_point_view", real_point)
    assert sorted(map(str, store.read(spark, name).collect())) == before
    counts = PL.bootstrap_keys(spark)
    assert PL.bootstrap_keys(spark) == counts  # keys written after the crash are the ones that are read
    assert counts["dsks"] == store.read(spark, name).count()
    store.publish(store.read(spark, name), name)
    assert store.read(spark, name).count() == counts["dsks"]
    assert len(store._versions(spark, name)) == 2  # the abandoned version is gone


def test_two_writers(spark, estate, monkeypatch):
    real = store._write_version

    def slow(df, name, number):
        version = real(df, name, number)
        monkeypatch.setattr(store, "_write_version", real)
        store.publish(store.read(spark, name), name)  # the other writer
        return version

    monkeypatch.setattr(store, "_write_version", slow)
    with pytest.raises(store.ConcurrentPublish):
        store.publish(store.read(spark, "dsk_store").limit(0), "dsk_store")
    assert store.read(spark, "dsk_store").count() > 0


def test_classify_settles_and_refuses_conflicts(spark, estate):
    good = _manifest(estate)
    assert PL.classify(spark, good).applied == 0
    both = _manifest(estate, {"table_name": "customer_records_1", "attributes": [
        {"attribute_name": "ssn", "tags": {"sensitivity_type": "pan"}}]})
    with pytest.raises(Exception, match="two values for the tag"):
        PL.classify(spark, both)


def test_arrivals_survive_a_crash_at_each_step(spark, estate, monkeypatch):
    """Wherever a batch is cut, the next run neither loses nor doubles its rows, and reads its files only."""
    struct = "id int, s string, p int"
    _landing(spark, "crash", "t", [(i, f"123-45-{i:04}", i % 2) for i in range(40)], struct, {"s": "ssn"}, partition_by=["p"])
    PL.load_vault(spark, schemas=["crash"])
    PL.load_anonymized(spark, schemas=["crash"])
    write, text, move, append = AR.write_audited, AR.Files.write_text, AR.Files.move, store.append
    files, total = Files(spark), 40

    def then_stop(real, n=1):
        calls = []

        def run(*a, **k):
            calls.append(real(*a, **k))
            if len(calls) == n:
                raise KeyboardInterrupt
        return run

    def stop_at(test, real):
        def run(*a):
            if test(*a):
                raise KeyboardInterrupt
            return real(*a)
        return run

    is_mark = lambda self, path, text: path.endswith(AR.READY)
    steps = {
        "vault staged": (AR, "write_audited", then_stop(write)),
        "anonymized staged": (AR, "write_audited", then_stop(write, 2)),
        "before the mark": (AR.Files, "write_text", stop_at(is_mark, text)),
        "one file moved": (AR.Files, "move", then_stop(move)),
        "all files moved": (store, "append", stop_at(lambda df, name: name == "loaded_files", append)),
        "after the ledger": (PL, "record_audits", stop_at(lambda *a: True, None)),
    }
    for step, (where, name, crash) in steps.items():
        loaded = {x.rsplit("/", 1)[1] for x in spark.table("landing__crash.t").inputFiles()}
        spark.createDataFrame([(total + i, "111-11-1111", i % 2) for i in range(6)], struct).coalesce(1).write.format(
            "parquet").mode("append").insertInto("landing__crash.t")
        monkeypatch.setattr(where, name, crash)
        with pytest.raises(KeyboardInterrupt):
            AR.load_arrivals(spark, schemas=["crash"])
        monkeypatch.undo()
        if step in ("vault staged", "anonymized staged", "before the mark"):
            assert spark.table("vault__crash.t").count() == total, step
        read = []
        monkeypatch.setattr(AR, "new_rows", lambda spark, source, paths, real=AR.new_rows: read.extend(paths) or real(spark, source, paths))
        assert AR.load_arrivals(spark, schemas=["crash"]) == ["t"], step
        monkeypatch.undo()
        total += 6
        for layer in ("vault", "anonymized"):
            t = spark.table(f"{layer}__crash.t")
            assert t.count() == total and t.select("id").distinct().count() == total, (step, layer)
            assert files.names(f"{table_location(spark, f'{layer}__crash.t')}/{AR.STAGE}") == [], step
        assert not {x.rsplit("/", 1)[1] for x in read} & loaded, step
    assert AR.load_arrivals(spark, schemas=["crash"]) == []
    assert spark.table("vault__crash.t").where("s is not null and s_hash is null").count() == 0
    audits = store.read(spark, "load_audits").where("schema_name = 'crash' and batch <> ''")
    assert audits.count() == len(steps) and audits.select("batch").distinct().count() == len(steps)


@pytest.mark.parametrize("step", ["write", "audit", "switch", "clean"])
def test_readers_see_whole_versions_only(spark, estate, monkeypatch, step):
    """SNK-4: whatever step a redo is cut at, the table holds the old rows or the new ones."""
    name = f"`vault__{SCHEMA}`.`redo_{step}`"
    PU.create_empty(spark, name, "`id` bigint, `p` bigint", ["p"])
    assert spark.table(name).count() == 0
    PU.publish_version(spark.range(10).selectExpr("id", "id % 2 p"), name, ["p"])
    new = spark.range(25).selectExpr("id", "id % 2 p")
    if step == "write":
        monkeypatch.setattr(PU, "write_audited", lambda *a, real=PU.write_audited: real(*a) and (_ for _ in ()).throw(KeyboardInterrupt()))
    elif step == "switch":
        monkeypatch.setattr(PU, "point_table", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    elif step == "clean":
        monkeypatch.setattr(PU.Files, "names", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    if step == "audit":
        with pytest.raises(PU.AuditError, match="3 rows break the rule on id"):
            PU.publish_version(new, name, ["p"], {"id": F.col("id") > 21})
    else:
        with pytest.raises(KeyboardInterrupt):
            PU.publish_version(new, name, ["p"])
    monkeypatch.undo()
    assert spark.table(name).count() == (25 if step == "clean" else 10)
    assert PU.publish_version(new, name, ["p"]) == 25
    assert PU.publish_version(new, name, ["p"]) == 25
    assert spark.table(name).count() == 25 and spark.table(name).where("p = 1").count() == 12
    folder = table_location(spark, name).rsplit("/", 1)[0]
    assert sum(x.startswith(f"redo_{step}.v-") for x in Files(spark).names(folder)) == 2  # the version before stays


def test_a_lost_hash_is_refused(spark, estate, monkeypatch):
    """The audit in the write: a fault in the projection leaves the table as it was."""
    _landing(spark, "faulty", "t", [(1, "123-45-6789"), (2, None)], "id int, s string", {"s": "ssn"})
    monkeypatch.setattr(PL, "hash_projection", lambda df, tp, *a, real=PL.hash_projection: real(df, tp, *a).withColumn(
        "s_hash", F.lit(None).cast("string")))
    with pytest.raises(PL.LoadError, match="1 rows break the rule on s and its hash"):
        PL.load_vault(spark, schemas=["faulty"])
    monkeypatch.undo()
    assert spark.table("vault__faulty.t").count() == 0
    assert PL.load_vault(spark, schemas=["faulty"]) == ["t"]
    assert store.read(spark, "load_audits").where("schema_name = 'faulty'").select("rows").first()[0] == 2


def test_loads_leave_no_scratch(spark, estate):
    from veilspark.session import SCRATCH

    _landing(spark, "tidy", "t", [(1, "123-45-6789")], "id int, s string", {"s": "ssn"})
    root = f"{shared_dir(spark)}/{SCRATCH}"
    before = Files(spark).names(root)
    PL.load_vault(spark, schemas=["tidy"])
    PL.load_anonymized(spark, schemas=["tidy"])
    assert AR.load_arrivals(spark, schemas=["tidy"]) == []
    assert Files(spark).names(root) == before


def test_load_queries_leave_no_estates(spark, estate, sf_small):
    """Registered load queries drop their databases, records and files; only their result stays, and a sweep takes that."""
    from veilspark.plans.workloads import WORKLOADS
    from veilspark.session import SCRATCH, sweep

    def state():
        return sorted(d.name for d in spark.catalog.listDatabases()), {x: store.read(spark, x).count() for x in ("loads", "loaded_files", "key_registry", "column_tags")}

    root, before = f"{shared_dir(spark)}/{SCRATCH}", state()
    files = set(Files(spark).names(root))
    out = WORKLOADS["anonymized_load"](spark, sf_small)
    assert out.count() == 150 and state() == before
    assert [x.split("-")[0] for x in set(Files(spark).names(root)) - files] == ["result"]
    assert "scope" not in {x.split("-")[0] for x in Files(spark).names(root)}
    sweep(spark, unscoped_older_than=-60)
    assert Files(spark).names(root) == []


def test_a_killed_run_is_swept(spark):
    from veilspark.session import ScratchScope, frozen, sweep

    scope = ScratchScope(spark, ttl=1.0)
    scope.__enter__()
    assert frozen(spark.range(3), "left").count() == 3
    assert sweep(spark) == []  # its lease is renewed
    scope._done.set()  # as if the driver were gone
    scope._thread.join()
    import time

    time.sleep(1.2)
    assert sweep(spark) == [scope.root.rsplit("/", 1)[1]] and not Files(spark).exists(scope.root)
    scope.__exit__()
