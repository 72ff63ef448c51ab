"""Checksum diffs, metrics of a write, variants, models that are due, streams of deliveries."""

import re

import pytest
from pyspark.sql import functions as F

from idweave import schemas
from idweave.config import IdentityConfig
from idweave.operators import extract, quality
from idweave.plans import manifest as mf
from idweave.plans.scratch import scratch_dir
from idweave.sources import events as src
from idweave.streaming.stream import active_as_of_stream, first_deliveries
from tests.conftest import at
from tests.test_runs import KV


def test_diff_by_checksum_is_the_diff(table, rows):
    left = [(str(i), "1") for i in range(300)] + [("x", None), ("x", None), (None, "x"), (None, None)]
    right = [(str(i), "1" if i % 50 else "2") for i in range(300)] + [("x", None), (None, "x"), ("", None)]
    got = quality.diff_by_checksum(table(KV, left), table(KV, right))
    want = quality.diff_tables(table(KV, left), table(KV, right))
    assert rows(got) == rows(want) and len(rows(got)) == 15
    assert rows(quality.diff_by_checksum(table(KV, left), table(KV, left[::-1]))) == []
    assert rows(quality.diff_by_checksum(table(KV, []), table(KV, []))) == []
    assert len(rows(quality.diff_by_checksum(table(KV, left), table(KV, [])))) == 303


def test_only_buckets_that_differ_are_compared_by_rows(spark):
    path = scratch_dir(spark, "diff")
    spark.range(20_000).selectExpr("cast(id as string) as k", "'1' as v").write.parquet(path)
    left = spark.read.parquet(path)
    right = left.withColumn("v", F.expr("if(k = '777', '2', v)"))
    got = quality.diff_by_checksum(left, right)
    assert got.count() == 2
    seen = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Exchange":
            m = node.metrics().get("shuffleRecordsWritten")
            seen.append(m.get().value() if m.isDefined() else 0)
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next())

    got.collect()
    walk(got._jdf.queryExecution().executedPlan())
    # bucket sums: 256 at most from each task of each side; rows: those of one leaf of 65536
    assert seen and max(seen) <= 256 * 2 * spark.sparkContext.defaultParallelism


def test_metrics_of_a_write_need_no_second_scan(spark, table):
    path = scratch_dir(spark, "metrics") + "/t"
    wide = schemas._struct(k=schemas.STR, v=schemas.STR, at=schemas.TS)
    rows = [("a", None, "01 10:00"), (None, None, "03 10:00"), ("b", "x", None)]
    got = quality.write_with_metrics(table(wide, rows), path, ["k", "v"], "at")
    assert got == {"n_rows": 3, "null_k": 1, "null_v": 2, "first_at": at("01 10:00"), "last_at": at("03 10:00")}
    assert spark.read.parquet(path).count() == 3
    none = quality.write_with_metrics(table(wide, []), path + "2", ["k"], "at")
    assert none == {"n_rows": 0, "null_k": 0, "first_at": None, "last_at": None}


CFG = IdentityConfig()


@pytest.mark.parametrize(
    "context, want",
    [
        ('[{"identity_id":"a","created_at":"2024-06-01T10:00:00Z","new":{"x":[1]}}]', ("a", at("01 10:00"))),
        ('[{"identity_id":12,"created_at":"2024-06-01 10:00:00"}]', ("12", at("01 10:00"))),
        ('[{"identity_id":"a","created_at":17}]', ("a", None)),
        ('[{"created_at":null}]', (None, None)),
        ("[]", (None, None)),
        ('{"identity_id":"a"}', (None, None)),
        ('[{"identity_id":', (None, None)),
        ("", (None, None)),
        (None, (None, None)),
    ],
)
def test_variant_contexts(spark, context, want):
    df = spark.createDataFrame([(context, '{"identity_id":"p","merged":[{"identity_id":5}],"merges":["5",6],"z":1}')],
                               "identity_context string, identity_merge string")
    r = extract.identity_fields(src.parse_variant_contexts(df, CFG), CFG).first()
    assert (r["identity_id"], r["created_at"]) == want
    assert r["identity_merge"]["identity_id"] == "p" and r["identity_merge"]["merges"] == ["5", "6"]
    assert r["identity_merge"]["merged"][0]["identity_id"] == "5" and r["identity_merge"]["merged"][0]["merged_at"] is None


def test_variants_agree_with_the_fixed_schema(spark):
    text = '[{"identity_id":"a","created_at":"2024-06-01T10:00:00.123456Z"}]'
    payload = ('{"identity_id":"p","merged":[{"identity_id":"c","created_at":"2024-06-01T10:00:00Z",'
               '"merged_at":"2024-06-01T11:00:00Z","triggering_event_id":"t"}],"merges":["c"]}')  # fmt: skip
    df = spark.createDataFrame([(text, payload), (None, None)], "identity_context string, identity_merge string")
    one, two = src.parse_json_contexts(df, CFG), src.parse_variant_contexts(df, CFG)
    assert one.dtypes == two.dtypes
    assert one.collect() == two.collect()


def test_due_models(spark, table, rows):
    manifest = table(schemas.MANIFEST, [("a", "01 00:00", "02 00:00"), ("b", "01 00:00", "03 00:00"), ("c", None, None)])
    newest = table(schemas._struct(newest=schemas.TS), [("03 00:00",)])
    assert rows(mf.due_models(manifest, newest)) == [("a", True), ("b", False), ("c", True)]
    nothing = table(schemas._struct(newest=schemas.TS), [(None,)])
    assert {r[1] for r in rows(mf.due_models(manifest, nothing))} == {False}


FACT = schemas._struct(event_id=schemas.STR, identity_id=schemas.STR, derived_tstamp=schemas.TS)


def streamed(spark, batches, make):
    """Rows written by a stream; each batch is consumed before the next lands."""
    root = scratch_dir(spark, "streamed")
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
        query = (
            make(spark.readStream.schema(FACT).parquet(f"{root}/in"))
            .writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def test_copies_in_later_deliveries_go_and_so_does_what_is_late(spark, table, rows):
    one = table(FACT, [("e1", "A", "10 10:00"), ("e2", "A", "04 10:00")])
    two = table(FACT, [("e1", "A", "10 10:00"), ("e3", "B", "09 10:00"), ("e4", "B", "07 09:00"), ("e2", "A", "04 10:00")])
    three = table(FACT, [("e3", "B", "09 10:00"), ("e1", "A", "10 10:00"), ("e5", "C", "12 10:00")])
    got = streamed(spark, [one, two, three], lambda s: first_deliveries(s, "3 days"))
    # the watermark of the second delivery is 7 June, 10:00
    assert rows(got, "event_id") == [("e1",), ("e2",), ("e3",), ("e5",)]


def test_a_stream_of_facts_meets_the_history(spark, table, rows):
    scd = table(schemas.ID_MAPPING_SCD, [
        ("k1", "A", "A", "01 00:00", "05 00:00", "created", False),
        ("k2", "A", "R", "05 00:00", None, "merged", True),
    ])
    one = table(FACT, [("e1", "A", "01 10:00"), ("e2", "Z", "01 10:00")])
    two = table(FACT, [("e3", "A", "05 00:00"), ("e0", "A", "04 23:59")])
    got = streamed(spark, [one, two], lambda s: active_as_of_stream(s, scd, "derived_tstamp"))
    assert rows(got, "event_id", "active_identity_id") == [("e0", "A"), ("e1", "A"), ("e3", "R")]
    assert not re.search("Python", scd._jdf.queryExecution().toString())
