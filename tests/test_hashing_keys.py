"""Salted hashes and the key lifecycle."""

import hashlib

import pytest
from pyspark.sql import functions as F

from veilspark.functions.crypto import key_aad, unwrap, wrap
from veilspark.functions.hashing import salted_hash
from veilspark.operators import keys as K
from veilspark.sources import fixtures as fx


def test_sha512_known_vector(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    h = df.select(salted_hash("v", F.lit(b"").cast("binary"), 512).alias("h")).first().h
    assert h.startswith("ddaf35a1")
    assert h == hashlib.sha512(b"abc").hexdigest()


def test_bad_bits():
    with pytest.raises(ValueError):
        salted_hash("v", F.lit(b""), 100)


def test_null_value_gives_null_hash(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(salted_hash("v", F.lit(b"s"), 512).alias("h")).first().h is None


def test_same_type_same_hash_other_type_differs(spark):
    reg, versions, store = fx.global_keys(spark)
    u = K.unwrap_dsks(store, versions)
    a = spark.createDataFrame([("x",)], "v string")
    b = spark.createDataFrame([("x",)], "w string")
    ha = a.select(salted_hash("v", K.salts_struct(u, ["ssn"]).getField("ssn")).alias("h")).first().h
    hb = b.select(salted_hash("w", K.salts_struct(u, ["ssn"]).getField("ssn")).alias("h")).first().h
    hc = b.select(salted_hash("w", K.salts_struct(u, ["pan"]).getField("pan")).alias("h")).first().h
    assert ha == hb != hc
    assert ha == hashlib.sha512(b"SALT-ssnx").hexdigest()


def test_wrap_roundtrip_and_wrong_aad(spark):
    key = F.lit(bytes(range(32))).cast("binary")
    df = spark.createDataFrame([("secret",)], "v string")
    w = wrap(F.col("v").cast("binary"), key, key_aad(F.lit("ssn"), F.lit("v1")))
    r = df.select(
        unwrap(w, key, key_aad(F.lit("ssn"), F.lit("v1"))).cast("string").alias("ok"),
        unwrap(w, key, key_aad(F.lit("ssn"), F.lit("v2"))).alias("bad"),
        F.length(w).alias("n"),
    ).first()
    assert r.ok == "secret" and r.bad is None and r.n == 6 + 28


def test_missing_salt_raises(spark):
    reg, versions, store = fx.global_keys(spark)
    u = K.unwrap_dsks(store, versions)
    df = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(Exception, match="no unique data salt key"):
        df.select(salted_hash("v", K.salts_struct(u, ["iban"]).getField("iban"))).collect()
    req = spark.createDataFrame([("ssn",), ("iban",)], "attribute string")
    assert [r.attribute for r in K.missing_salts(req, u).collect()] == ["iban"]


def test_salt_not_in_plan(spark):
    reg, versions, store = fx.global_keys(spark)
    # Materialise the key tables so that the plan reads them like real tables.
    v = versions.checkpoint()
    s = store.checkpoint()
    u = K.unwrap_dsks(s, v)
    df = spark.createDataFrame([("x",)], "v string").select(salted_hash("v", K.salts_struct(u, ["ssn"]).getField("ssn")).alias("h"))
    df.collect()
    text = df._jdf.queryExecution().toString()
    assert "SALT-ssn" not in text and b"SALT-ssn".hex() not in text.lower()


def test_rotation_keeps_dsk(spark, sf_small):
    c = spark.read.parquet(f"{sf_small}/customer.parquet")
    keks = fx.estate_kek_versions(c).checkpoint()
    store = fx.estate_dsk_store(c).checkpoint()
    before = K.unwrap_dsks(store, keks).select("dsk_name", F.sha2("dsk", 256).alias("f"))
    rotated = K.rotate_dsks(store, keks).checkpoint()
    after = K.unwrap_dsks(rotated.drop("rotated"), keks).select("dsk_name", F.sha2("dsk", 256).alias("f2"))
    j = before.join(after, "dsk_name")
    assert j.count() == store.count()
    assert j.where(F.col("f") != F.col("f2")).count() == 0
    assert j.where(F.col("f").isNull()).count() == 0
    latest = K.latest_kek_versions(keks)
    stale = rotated.join(latest, "kek_name").where(F.col("kek_version") != F.col("latest_version"))
    assert stale.count() == 0


def test_ensure_registry_idempotent(spark):
    existing = fx.registry_seed(spark, ("name", "ssn"))
    req = spark.createDataFrame([("ssn",), ("pan",), ("pan",), (None,)], "attribute string")
    once = K.ensure_registry(existing, req)
    twice = K.ensure_registry(once, req)
    assert sorted(r[0] for r in once.collect()) == ["name", "pan", "ssn"]
    assert once.count() == twice.count() == 3


def test_keys_due_policy(spark):
    kv = spark.createDataFrame(
        [("k1", "v1", "2024-01-01 00:00:00"), ("k2", "v1", "2024-12-01 00:00:00")],
        "kek_name string, version string, created string",
    ).select("kek_name", "version", F.col("created").cast("timestamp").alias("created"),
             F.lit(b"x").cast("binary").alias("kek"))
    due = K.keys_due(kv, "2024-12-01 00:00:00").collect()
    assert [r.kek_name for r in due] == ["k1"]


def test_typed_columns_mask_and_hash_through_string_form(spark):
    import datetime as dt

    from veilspark.operators.protect import hash_projection, mask_projection, plan_for_frame

    df = spark.createDataFrame([(7, dt.date(1980, 2, 3)), (8, None)], "id bigint, dob date")
    reg, versions, store = fx.global_keys(spark)
    u = K.unwrap_dsks(store, versions)
    tp = plan_for_frame(df, {"id": "ssn", "dob": "dob"})
    vault = hash_projection(df, tp, u, 512)
    r = vault.where("id = 7").first()
    assert r.id_hash == hashlib.sha512(b"SALT-ssn7").hexdigest()
    assert r.dob_hash == hashlib.sha512(b"SALT-dob1980-02-03").hexdigest()
    anon = mask_projection(vault, {"dob": "dob"})
    assert dict(anon.dtypes)["dob"] == "string"
    assert {x.id: x.dob for x in anon.collect()} == {7: "1980", 8: None}


def test_urlsafe_base64_roundtrip(spark):
    import base64
    import os

    from veilspark.functions.crypto import from_urlsafe_base64, to_urlsafe_base64

    raw = [os.urandom(n) for n in (32, 31, 30, 1, 0)]
    texts = [base64.urlsafe_b64encode(b).decode().rstrip("=") for b in raw]
    df = spark.createDataFrame(list(zip(texts, raw)), "t string, b binary")
    for r in df.select("t", "b", from_urlsafe_base64(F.col("t")).alias("dec"),
                       to_urlsafe_base64(F.col("b")).alias("enc")).collect():
        assert bytes(r.dec) == bytes(r.b) and r.enc == r.t
