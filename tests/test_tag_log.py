"""The log of column tags: batches, latest value, compaction, writers that are killed or meet."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from veilspark.plans import pipelines as PL
from veilspark.plans import store
from veilspark.plans.workloads import _own_session
from veilspark.sources.files import table_location
from veilspark.storage import Files

TAG = "catalog_name string, schema_name string, table_name string, column_name string, tag_name string, tag_value string"
LAYER = "landing"


@pytest.fixture
def session(spark, request):
    s = _own_session(spark, f"core_log_{abs(hash(request.node.name))}")
    store.ensure_core(s)
    yield s
    s.sql(f"DROP DATABASE `{store.core(s)}` CASCADE")


def frame(s, *rows):
    return s.createDataFrame([(LAYER, "s", t, c, n, v) for t, c, n, v in rows], TAG)


def tags(s):
    return sorted((tuple(r)[2:] for r in store.read(s, store.tags_of(LAYER)).collect()), key=str)


def log_rows(s, batch):
    return s.table(store._log(s, LAYER)).where(f"batch = '{batch}'").count()


def test_latest_value_counts_and_only_changes_are_written(session):
    s = session
    store.append_tags(frame(s, *[(f"t{i}", "a", "k", "1") for i in range(50)]), LAYER)
    batch = store.append_tags(frame(s, ("t1", "a", "k", "2"), ("t2", "a", "k", None), ("t3", "b", "k", "1"), ("t3", "b", "k", "1")), LAYER)
    assert log_rows(s, batch) == 3
    want = {(f"t{i}", "a", "k"): "1" for i in range(50)} | {("t1", "a", "k"): "2", ("t2", "a", "k"): None, ("t3", "b", "k"): "1"}
    assert tags(s) == sorted(((*k, v) for k, v in want.items()), key=str)
    store.append_tags(frame(s).limit(0), LAYER)
    assert len(tags(s)) == 51


def test_two_values_for_one_tag_raise_and_nothing_is_written(session):
    with pytest.raises(Exception, match="two values for the tag"):
        store.append_tags(frame(session, ("t", "a", "k", "1"), ("t", "a", "k", None), ("u", "a", "k", "1")), LAYER)
    assert tags(session) == [] and store.tag_batches(session, LAYER) == []


def test_compactions_change_nothing_and_empty_the_log(session):
    s = session
    for v in range(3):
        store.append_tags(frame(s, ("t", "a", "k", str(v)), (f"u{v}", "a", "k", None)), LAYER)
        before = tags(s)
        assert store.compact_tags(s, LAYER) == v + 2
        assert tags(s) == before
    assert len(store.tag_batches(s, LAYER)) == 1  # those that the version before has are gone
    assert len(store._versions(s, store.tags_of(LAYER))) == 2
    assert tags(s) == [("t", "a", "k", "2"), *((f"u{v}", "a", "k", None) for v in range(3))]
    store.append_tags(frame(s, ("t", "a", "k", "last")), LAYER)
    assert tags(s)[0] == ("t", "a", "k", "last")


def test_reader_of_the_version_before(session):
    s = session
    store.append_tags(frame(s, ("t", "a", "k", "1")), LAYER)
    store.append_tags(frame(s, ("u", "a", "k", "1")), LAYER)
    reader = store.read(s, store.tags_of(LAYER))
    store.compact_tags(s, LAYER)
    assert reader.count() == 2


@pytest.mark.parametrize("step", ["written", "switched"])
def test_change_during_a_compaction_is_kept(session, monkeypatch, step):
    s = session
    store.append_tags(frame(s, ("t", "a", "k", "1"), ("u", "a", "k", "1")), LAYER)
    name = "_write_version" if step == "written" else "_point_tags"
    real = getattr(store, name)

    def meanwhile(*a):
        out = real(*a)
        store.append_tags(frame(s, ("t", "a", "k", "2")), LAYER)
        return out

    monkeypatch.setattr(store, name, meanwhile)
    store.compact_tags(s, LAYER)
    monkeypatch.setattr(store, name, real)
    want = [("t", "a", "k", "2"), ("u", "a", "k", "1")]
    assert tags(s) == want
    for _ in range(3):
        store.compact_tags(s, LAYER)
        assert tags(s) == want


def test_two_compactions(session, monkeypatch):
    s = session
    store.append_tags(frame(s, ("t", "a", "k", "1")), LAYER)
    real = store._write_version

    def slow(*a):
        version = real(*a)
        monkeypatch.setattr(store, "_write_version", real)
        store.compact_tags(s, LAYER)
        return version

    monkeypatch.setattr(store, "_write_version", slow)
    with pytest.raises(store.ConcurrentPublish):
        store.compact_tags(s, LAYER)
    assert tags(s) == [("t", "a", "k", "1")]


def test_writers_at_once_lose_nothing(session):
    s = session
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: PL._publish_tags(frame(s, (f"t{i}", "a", "k", str(i))), LAYER), range(8)))
    assert tags(s) == [(f"t{i}", "a", "k", str(i)) for i in range(8)]
    assert len(set(store.tag_batches(s, LAYER))) == 8


def test_writer_killed_before_its_batch_is_one(session, monkeypatch):
    s = session
    store.append_tags(frame(s, ("t", "a", "k", "1")), LAYER)
    root, files = table_location(s, store._log(s, LAYER)), Files(s)
    lost = f"{root}/batch=00000000000000000001-killed"
    frame(s, ("t", "a", "k", "9"), ("v", "a", "k", "9")).drop("batch").write.parquet(lost)
    assert tags(s) == [("t", "a", "k", "1")]
    store.compact_tags(s, LAYER)
    assert files.exists(lost)  # it may still be at work
    path = lost.removeprefix("file:")
    os.utime(path, (1, 1))
    store.compact_tags(s, LAYER)
    assert not files.exists(lost) and tags(s) == [("t", "a", "k", "1")]


def test_load_writes_its_own_tables_tags_only(session):
    s = session
    try:
        s.sql("CREATE DATABASE landing__taglog")
        for t in ("one", "two"):
            s.createDataFrame([(1, "123-45-6789")], "id int, ssn string").write.format("parquet").saveAsTable(f"landing__taglog.{t}")
            store.append(s.createDataFrame([(LAYER, "taglog", t, "ssn", n, v) for n, v in (
                ("sensitivity_category", "pii"), ("sensitivity_type", "ssn"))], TAG), store.tags_of(LAYER))
            PL.bootstrap_keys(s)
            assert PL.load_vault(s, schemas=["taglog"]) == [t]
            batch = store.tag_batches(s, "vault")[-1]
            new = s.table(store._log(s, "vault")).where(f"batch = '{batch}'")
            assert {r.table_name for r in new.collect()} == {t} and new.count() == 5  # two, two of the hash, derived
        assert store.read(s, store.tags_of("vault")).count() == 10
    finally:
        for layer in ("landing", "vault"):
            s.sql(f"DROP DATABASE IF EXISTS {layer}__taglog CASCADE")
