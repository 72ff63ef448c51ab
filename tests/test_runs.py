"""Manifest, run planning, publishing and the stream."""

from datetime import datetime

import pytest

from idweave import schemas
from idweave.config import IdentityConfig, RunContext
from idweave.plans import manifest as mf
from idweave.plans import publish, runs
from idweave.plans.publish import layout
from idweave.plans.scratch import scratch_dir, scratch_tables
from idweave.sources.events import read_typed_csv
from idweave.streaming.stream import process_micro_batch, stream_identities
from tests.conftest import at
from tests.test_extract import BASE, merge, page

CFG = IdentityConfig(start_date=at("01 00:00"), backfill_limit_days=2)
KV = schemas._struct(k=schemas.STR, v=schemas.STR)
NOW = at("20 00:00")


def new_store(spark, buckets=3):
    return scratch_tables(spark, "tables", buckets)


def limits(spark, table, rows, spans, models=("a", "b")):
    manifest = table(schemas.MANIFEST, spans)
    got = rows(mf.run_limits(mf.manifest_status(manifest, models), CFG))
    (state, low, high, inclusive) = got[0]
    return state, low, high, inclusive


def test_run_limits(spark, table, rows):
    assert limits(spark, table, rows, []) == ("first", "01 00:00", "03 00:00", True)
    some = [("a", "01 00:00", "02 06:00")]
    assert limits(spark, table, rows, some) == ("replay", "01 00:00", "02 06:00", True)
    far = [("a", "01 00:00", "08 00:00")]
    assert limits(spark, table, rows, far) == ("replay", "01 00:00", "03 00:00", True)
    uneven = [("a", "01 00:00", "04 00:00"), ("b", "01 00:00", "05 00:00"), ("x", "01 00:00", "09 00:00")]
    assert limits(spark, table, rows, uneven) == ("catch_up", "04 00:00", "05 00:00", False)
    even = [("a", "01 00:00", "04 00:00"), ("b", "02 00:00", "04 00:00")]
    assert limits(spark, table, rows, even) == ("next", "04 00:00", "06 00:00", False)


def test_full_refresh_guard(spark, table, rows):
    assert not mf.full_refresh_allowed(CFG)
    assert mf.full_refresh_allowed(IdentityConfig(environment="dev"))
    assert mf.full_refresh_allowed(IdentityConfig(allow_refresh=True))
    store = new_store(spark)
    store.upsert("t", "k", table(KV, [("a", "1")]))
    store.write_manifest(table(schemas.MANIFEST, [("m", "01 00:00", "02 00:00")]))
    with pytest.raises(PermissionError):
        runs.full_refresh(store, CFG)
    runs.full_refresh(store, IdentityConfig(allow_refresh=True))
    assert not store.exists("t") and rows(runs.load_manifest(store)) == []


EVENTS = [
    page("e1", "web", "da", None, "01 10:00", "A"),
    page("e2", "web", "db", None, "01 11:00", "B"),
    merge("m1", "A", "02 10:00", ("B", "02 10:00", "m1")),
    page("e3", "tv", "db", "u", "02 11:00", "B"),
    # nothing arrives for longer than a window
    page("e4", "ios", "dc", None, "12 10:00", "C"),
    merge("m2", "A", "12 11:00", ("B", "02 10:00", "m1"), ("C", "12 11:00", "m2")),
]


def shown(store, rows):
    return {
        "id_mapping": rows(store.read("id_mapping"), "identity_id", "active_identity_id"),
        "identifiers": rows(
            store.read("identifier_mapping"), "active_identity_id", "id_value", "last_app_id"
        ),
        "current": rows(
            store.read("id_mapping_scd").where("is_current"), "identity_id", "active_identity_id"
        ),
        "changes": rows(store.read("id_changes"), "identity_id", "previous_identity_id"),
    }


WANT = {
    "id_mapping": [("B", "A"), ("C", "A")],
    "identifiers": [("A", "da", "web"), ("A", "db", "tv"), ("A", "dc", "ios"), ("A", "u", "tv")],
    "current": [("A", "A"), ("B", "A"), ("C", "A")],
    "changes": [("A", "B"), ("A", "C"), ("A", None), ("B", None), ("C", None)],
}


def test_catch_up_crosses_a_gap_and_a_model_can_be_replayed(spark, table, rows):
    store, raw = new_store(spark), table(BASE, EVENTS)
    windows = runs.catch_up(store, CFG, raw, NOW)
    assert len(windows) == 2 and windows[1].lower == at("12 10:00")
    assert shown(store, rows) == WANT
    manifest = rows(runs.load_manifest(store))
    assert {m[1:] for m in manifest} == {("01 10:00", "12 11:00")} and len(manifest) == 6
    runs.forget(store, ["identifier_mapping", "id_mapping"])
    assert len(runs.catch_up(store, CFG, raw, NOW)) == 2
    assert shown(store, rows) == WANT
    assert {m[1:] for m in rows(runs.load_manifest(store))} == {("01 10:00", "12 11:00")}


def test_only_some_tables(spark, table, rows):
    store, raw = new_store(spark), table(BASE, EVENTS)
    runs.catch_up(store, CFG, raw, NOW, ["identifier_mapping"])
    made = [t for t in schemas.KEYS if store.exists(t)]
    assert made == ["id_mapping", "identifier_mapping"]
    # the others join later from the start date and end up level
    runs.catch_up(store, CFG, raw, NOW)
    assert shown(store, rows) == WANT


def test_empty_window_writes_nothing(spark, table):
    store, raw = new_store(spark), table(BASE, EVENTS)
    quiet = RunContext(at("05 00:00"), at("06 00:00"), NOW)
    assert runs.execute(store, CFG, raw, quiet) is None
    assert not any(store.exists(t) for t in schemas.KEYS)
    assert runs.plan_run(store, IdentityConfig(start_date=at("25 00:00")), raw, NOW) is None


def test_load_date_partitions_are_pruned(spark, table):
    from pyspark.sql import functions as F

    path = scratch_dir(spark, "dated")
    raw = table(BASE, EVENTS).withColumn("load_date", F.to_date("load_tstamp"))
    raw.write.partitionBy("load_date").parquet(path)
    cfg = IdentityConfig(load_date_column="load_date", start_date=at("01 00:00"))
    run = RunContext(at("01 00:00"), at("01 23:00"), NOW)
    base = runs.base_events_this_run(spark.read.parquet(path), cfg, run)
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan
    assert base.count() == 2


def test_compressed_orphans_leave_no_stale_roots(spark, table, rows):
    """The payload of the second merge no longer lists A; later A is seen again."""
    events = [
        page("e1", "web", "da", None, "01 10:00", "A"),
        merge("m1", "B", "01 11:00", ("A", "01 11:00", "m1")),
        merge("m2", "C", "04 11:00", ("B", "04 11:00", "m2")),
        page("e2", "web", "da", None, "07 10:00", "A"),
    ]
    for compress, parent in ((False, "B"), (True, "C")):
        store = new_store(spark)
        cfg = IdentityConfig(
            start_date=at("01 00:00"), backfill_limit_days=1, compress_orphans=compress
        )
        assert len(runs.catch_up(store, cfg, table(BASE, events), NOW)) == 3
        got = rows(store.read("id_mapping"), "identity_id", "active_identity_id")
        assert got == [("A", parent), ("B", "C")]
        current = store.read("id_mapping_scd").where("identity_id = 'A' and is_current")
        assert rows(current, "active_identity_id") == [("C",)]
        lookup = rows(store.read("identifier_mapping"), "active_identity_id")
        assert (lookup == [("C",)]) is compress


def test_history_can_be_rewritten_for_affected_ids(spark, table, rows):
    """A merge that turns out to be earlier than recorded leaves one row when asked to."""
    events = [
        page("e1", "web", "da", None, "01 10:00", "A"),
        merge("m1", "B", "02 11:00", ("A", "02 11:00", "m1")),
        merge("m2", "B", "05 11:00", ("A", "02 09:00", "m0")),
    ]
    got = {}
    for replace in (False, True):
        store = new_store(spark)
        cfg = IdentityConfig(
            start_date=at("01 00:00"), backfill_limit_days=2, replace_affected=replace
        )
        runs.catch_up(store, cfg, table(BASE, events), NOW)
        got[replace] = rows(store.read("id_mapping_scd"), "active_identity_id", "effective_at", "superseded_at")
    assert got[True] == [("A", "01 10:00", "02 09:00"), ("B", "02 09:00", None)]
    assert ("B", "02 11:00", None) in got[False]


def test_typed_csv(spark, rows):
    path = scratch_dir(spark, "csv")
    spark.sql("select 'B' identity_id, 'A' active_identity_id, '2024-06-01 10:00:00' merged_at,"
              " '2024-06-09 00:00:00' model_tstamp").write.csv(path, header=True)  # fmt: skip
    got = read_typed_csv(spark, path, schemas.ID_MAPPING)
    assert rows(got) == [("B", "A", "01 10:00", "09 00:00")]


def test_views_and_export(spark, table, rows):
    store = new_store(spark)
    runs.catch_up(store, CFG, table(BASE, EVENTS), NOW)
    publish.create_views(store, CFG, "x_", {"identity_id": "visitor_id", "active_identity_id": "root"})
    assert rows(spark.sql("select visitor_id, root from x_id_mapping")) == [("B", "A"), ("C", "A")]
    path = scratch_dir(spark, "export")
    publish.export_tables(store, CFG, path)
    back = spark.read.parquet(f"{path}/id_changes")
    assert back.count() == 5
    assert rows(back.where("effective_at_date = '2024-06-12'"), "identity_id") == [("A",), ("C",)]
    keyed = layout(store.read("id_mapping_scd"), "id_mapping_scd", 2)
    assert "effective_at_date" in keyed.columns and keyed.count() == 5


def test_stream_gives_the_same_tables(spark, table, rows):
    root = scratch_dir(spark, "stream")
    store = new_store(spark, 2)
    raw = table(BASE, EVENTS)
    for low, high in (("01 00:00", "02 10:30"), ("02 10:31", "13 00:00")):
        raw.where(
            raw.load_tstamp.between(at(low), at(high))
        ).write.mode("append").parquet(f"{root}/in")
        query = stream_identities(
            spark, CFG, store, f"{root}/in", BASE, f"{root}/checkpoint", run_tstamp=NOW
        )
        query.awaitTermination()
    assert shown(store, rows) == WANT
    assert store.stream_batch("default") == 1 and store.stream_batch("other") == -1
    # a batch that comes back after a failure is recognised
    assert process_micro_batch(store, CFG, "default", raw, 1, NOW) is None
    assert process_micro_batch(store, CFG, "default", raw.limit(0), 2, NOW) is None


def test_registered_queries_have_a_counterpart():
    import __spark_entry__ as entry

    from idweave.catalog.queries import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 60


def test_flagship_query(spark):
    import __spark_entry__ as entry

    got = entry.entry(spark)
    assert got.columns == ["identity_id", "active_identity_id", "merged_at", "model_tstamp"]
    assert got.count() == 8
    assert isinstance(got.first()["merged_at"], datetime)
