"""Saved tables: upserts by key bucket, runs that break off, batches that change nothing, jumps over gaps."""

import re
from datetime import datetime

import pytest

from idweave import schemas
from idweave.config import IdentityConfig
from idweave.operators import lookup
from idweave.plans import runs
from idweave.plans.scratch import scratch_dir, scratch_tables
from idweave.plans.tables import BUCKET, IdentityTables
from tests.conftest import at
from tests.test_extract import BASE, merge, page
from tests.test_runs import KV, NOW, WANT, EVENTS, new_store, shown


def files(store, name):
    """Data files of a table by bucket."""
    found = {}
    for r in store.spark.table(store.name(name)).selectExpr(BUCKET, "input_file_name() as f").distinct().collect():
        found.setdefault(r[0], set()).add(r[1])
    return found


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("broadcast", [True, False])
def test_upsert_replaces_inserts_and_deletes(spark, table, rows, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if broadcast else "-1")
    try:
        store = new_store(spark)
        store.upsert("t", "k", table(KV, [("a", "1"), ("b", "1"), ("c", "1")]))
        gone = table(KV, [("c", None)]).select("k")
        store.upsert("t", "k", table(KV, [("b", "2"), ("d", "2")]), gone)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(store.read("t")) == [("a", "1"), ("b", "2"), ("d", "2")]
    assert rows(IdentityTables(spark, store.database).read("t")) == rows(store.read("t"))


def test_only_touched_buckets_are_rewritten(spark, table):
    store = new_store(spark, buckets=16)
    store.upsert("t", "k", table(KV, [(str(i), "1") for i in range(100)]))
    before = files(store, "t")
    store.upsert("t", "k", table(KV, [("7", "2")]))
    after = files(store, "t")
    assert sum(before[b] != after[b] for b in before) == 1
    store.upsert("t", "k", table(KV, []))
    assert files(store, "t") == after and store.read("t").count() == 100


def test_new_column_is_appended(spark, table, rows):
    store = new_store(spark)
    store.upsert("t", "k", table(KV, [("a", "1"), ("b", "1")]))
    wider = schemas.T.StructType([*KV.fields, schemas.T.StructField("extra", schemas.STR)])
    store.upsert("t", "k", table(wider, [("b", "2", "x")]))
    assert rows(store.read("t"), "k", "v", "extra") == [("a", "1", None), ("b", "2", "x")]
    store.upsert("t", "k", table(KV, [("b", "3")]))  # a batch of an older layout
    assert rows(store.read("t"), "k", "v", "extra") == [("a", "1", None), ("b", "3", None)]


def test_every_row_deleted(spark, table, rows):
    store = new_store(spark)
    store.upsert("t", "k", table(KV, [("a", "1"), ("b", "1")]))
    store.upsert("t", "k", table(KV, []), table(KV, [("a", None), ("b", None)]).select("k"))
    assert rows(store.read("t")) == []
    store.upsert("t", "k", table(KV, [("a", "2")]))
    assert rows(store.read("t")) == [("a", "2")]


def test_the_stored_side_is_not_shuffled(spark, table, rows, monkeypatch, no_broadcast):
    """Neither by an upsert nor by a join on its key; touched buckets are the only partitions read."""
    store = new_store(spark, buckets=4)
    store.upsert("t", "k", table(KV, [(str(i), "1") for i in range(50)]))
    plans = []
    overwrite = IdentityTables._overwrite
    monkeypatch.setattr(
        IdentityTables,
        "_overwrite",
        lambda self, name, df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or overwrite(self, name, df),
    )
    store.upsert("t", "k", table(KV, [("3", "2")]))
    (plan,) = plans
    stored = plan[plan.index("LeftAnti") :].split(":- ")[1].split("+- Sort")[0]
    assert "FileScan" in stored and "Exchange" not in stored and "Bucketed: true" in stored
    assert re.search(r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = \d\)\]", plan)
    assert store.read("t").count() == 50


def test_resolving_identifiers_reads_the_mapping_as_it_lies(spark, table, no_broadcast):
    store = new_store(spark)
    store.upsert("id_mapping", "identity_id", table(schemas.ID_MAPPING, [(f"c{i}", "p", "01 10:00", "01 10:00") for i in range(30)]))
    seen = table(schemas.IDENTIFIERS_THIS_RUN, [(f"c{i}", "X", "v", "e", "web", "web", "01 10:00", "01 10:00") for i in range(9)])
    got = lookup.resolve_active(seen, store.read("id_mapping"))
    assert {r["active_identity_id"] for r in got.collect()} == {"p"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= plan.count("Initial Plan") + 1 and "Bucketed: true" in plan


def test_a_second_sighting_rewrites_neither_log_nor_history(spark, table):
    seen = [
        page("e1", "web", "da", None, "01 10:00", "A"),
        page("e2", "web", "db", None, "01 10:05", "B"),
        merge("m1", "A", "01 11:00", ("B", "01 11:00", "m1")),
    ]
    again = [page("e3", "web", "da", None, "02 11:30", "A"), page("e4", "web", "db", None, "02 12:00", "B")]
    store = new_store(spark)
    cfg = IdentityConfig(start_date=at("01 00:00"), backfill_limit_days=1)
    runs.run_next(store, cfg, table(BASE, seen), NOW)
    before = {t: files(store, t) for t in schemas.KEYS}
    assert runs.run_next(store, cfg, table(BASE, seen + again), NOW) is not None
    after = {t: files(store, t) for t in schemas.KEYS}
    assert after["id_changes"] == before["id_changes"]
    assert after["id_mapping_scd"] == before["id_mapping_scd"]
    assert after["identities"] != before["identities"]


class Broken(RuntimeError):
    pass


@pytest.mark.parametrize("table_name", [*schemas.KEYS, "manifest"])
def test_a_run_that_breaks_off_is_run_again(spark, table, rows, monkeypatch, table_name):
    """Each time another write fails; the second attempt ends at the rows of an unbroken run."""
    raw, cfg = table(BASE, EVENTS), IdentityConfig(start_date=at("01 00:00"), backfill_limit_days=2)
    store = new_store(spark)
    runs.run_next(store, cfg, raw, NOW)
    overwrite, write_manifest = IdentityTables._overwrite, IdentityTables.write_manifest

    def fail(self, name, *args):
        if name == table_name:
            raise Broken
        overwrite(self, name, *args)

    def fail_manifest(self, df):
        raise Broken

    if table_name == "manifest":
        monkeypatch.setattr(IdentityTables, "write_manifest", fail_manifest)
    else:
        monkeypatch.setattr(IdentityTables, "_overwrite", fail)
    with pytest.raises(Broken):
        runs.run_next(store, cfg, raw, NOW)
    monkeypatch.setattr(IdentityTables, "_overwrite", overwrite)
    monkeypatch.setattr(IdentityTables, "write_manifest", write_manifest)
    assert len(runs.catch_up(store, cfg, raw, NOW)) == 1
    assert shown(store, rows) == WANT
    assert {m[1:] for m in rows(runs.load_manifest(store))} == {("01 10:00", "12 11:00")}


def test_tables_are_found_again_by_name(spark, table, rows):
    store = new_store(spark)
    store.upsert("t", "k", table(KV, [("a", "1")]))
    assert rows(spark.sql(f"select k, v from {store.database}.t")) == [("a", "1")]
    assert not store.exists("u")
    with pytest.raises(KeyError):
        store.read("u")


def test_catch_up_does_not_jump_past_what_others_consumed(spark, table):
    store = new_store(spark)
    cfg = IdentityConfig(start_date=datetime(2024, 6, 1), backfill_limit_days=5)
    events = table(BASE, [page("e1", "web", "d", None, "15 10:00", "A"), page("e2", "web", "d", None, "25 10:00", "A")])
    spans = [(m, "01 00:00", "02 00:00" if m == "id_mapping" else "20 00:00") for m in runs.TABLES]
    store.write_manifest(table(schemas.MANIFEST, spans))
    plan = runs.plan_run(store, cfg, events, NOW)
    assert (plan.lower, plan.upper) == (at("15 10:00"), at("15 10:00"))
    # once the one behind has nothing left up to the others, all go on together
    store.write_manifest(table(schemas.MANIFEST, [("id_mapping", "01 00:00", "15 10:00")]))
    plan = runs.plan_run(store, cfg, events, NOW)
    assert plan.upper == at("25 10:00") and plan.lower >= datetime(2024, 6, 20)


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")
