"""Hot keys: one key holds most rows, and the plan still spreads them."""

import pytest
from pyspark.sql import functions as F

from idweave.config import IdentityConfig, RunContext
from idweave.operators import changes, history, lookup, mapping
from idweave.sources import events as src
from tests.conftest import at

RUN = RunContext(at("01 00:00"), at("02 00:00"), at("09 12:00"))
N = 40_000


@pytest.fixture
def tiny_thresholds(spark):
    """Make Spark treat these small inputs the way it treats large ones."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df):
    n = len(df.collect())
    return n, df._jdf.queryExecution().executedPlan().toString()


def star(spark):
    """Edges: one root with most children, many small ones."""
    hot = spark.range(0, N, 1, 16).select(
        F.lit("hot").alias("active_identity_id"), F.concat(F.lit("c"), "id").alias("identity_id"), "id"
    )
    cold = spark.range(0, N // 4, 1, 16).select(
        F.concat(F.lit("p"), F.col("id") % 997).alias("active_identity_id"),
        F.concat(F.lit("x"), "id").alias("identity_id"),
        "id",
    )
    return hot.unionByName(cold).select(
        "active_identity_id",
        "identity_id",
        F.expr("timestamp_ntz '2024-06-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("merged_at"),
        F.concat(F.lit("m"), "id").alias("triggering_event_id"),
    )


def saved(spark, df, name):
    from idweave.plans.scratch import scratch_dir

    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_hot_root(spark, tiny_thresholds):
    absorbed = spark.sql(
        "select concat('q', id) active_identity_id, concat('p', id) identity_id,"
        " timestamp_ntz '2024-06-02' merged_at, 'm' triggering_event_id from range(500)"
    )
    edges = saved(spark, star(spark).unionByName(absorbed), "edges")
    this_run = saved(spark, mapping.id_mapping_this_run(edges, RUN), "this_run")
    n, plan = final_plan(mapping.id_mapping_this_run(edges, RUN))
    assert n == this_run.count() > N
    assert "SortMergeJoin(skew=true)" in plan
    none = this_run.limit(0)
    n, plan = final_plan(changes.resolved_merge_changes(edges, this_run, none, none))
    assert n == this_run.count()
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_parent_is_absorbed(spark, tiny_thresholds):
    """All children of the hot root are orphans of its merge into another root."""
    stored = saved(spark, mapping.id_mapping_this_run(star(spark), RUN), "stored")
    step = spark.sql(
        "select 'top' active_identity_id, 'hot' identity_id,"
        " timestamp_ntz '2024-06-05 00:00:00' merged_at, 'm9' triggering_event_id"
    )
    edges = saved(spark, step, "step")
    this_run = saved(spark, mapping.id_mapping_this_run(edges, RUN), "this_run")
    n, plan = final_plan(mapping.snapshot_affected(stored, this_run))
    assert n == N and "SortMergeJoin(skew=true)" in plan
    affected = saved(spark, mapping.snapshot_affected(stored, this_run), "affected")
    orphans = changes.orphan_cascades(affected, this_run, edges)
    n, plan = final_plan(changes.orphan_merge_changes(orphans, edges))
    assert n == N and "SortMergeJoin(skew=true)" in plan


def test_hot_intermediate_parent_and_hot_history(spark, tiny_thresholds):
    """The hot root is itself absorbed in the same batch; many others are too."""
    tops = spark.sql(
        "select concat('top', id) active_identity_id, if(id = 0, 'hot', concat('p', id)) identity_id,"
        " timestamp_ntz '2024-06-05' merged_at, 'm9' triggering_event_id from range(900)"
    )
    edges = saved(spark, star(spark).unionByName(tops), "edges")
    n, plan = final_plan(changes.intermediate_merge_changes(edges))
    assert n > N and "SortMergeJoin(skew=true)" in plan
    scd = saved(
        spark,
        star(spark).select(
            F.concat(F.lit("k"), "identity_id").alias("scd_key"),
            F.col("active_identity_id").alias("identity_id"),
            F.col("identity_id").alias("active_identity_id"),
            F.col("merged_at").alias("effective_at"),
            F.lit("merged").alias("change_type"),
        ),
        "scd",
    )
    ids = saved(spark, tops.select("identity_id"), "ids").distinct()
    n, plan = final_plan(history.scd_history(scd, ids))
    assert n > N and "SortMergeJoin(skew=true)" in plan


def sightings(spark):
    """Identifier rows, most of them of one identity."""
    return spark.range(0, N, 1, 16).select(
        F.expr("if(id % 5 < 4, 'hot', concat('i', id))").alias("identity_id"),
        F.lit("NET").alias("id_type"),
        F.concat(F.lit("n"), "id").alias("id_value"),
        F.concat(F.lit("e"), "id").alias("first_seen_event_id"),
        F.lit("web").alias("first_app_id"),
        F.lit("web").alias("last_app_id"),
        F.lit(at("01 10:00")).cast("timestamp_ntz").alias("first_derived_tstamp"),
        F.lit(at("01 11:00")).cast("timestamp_ntz").alias("last_derived_tstamp"),
    )


def test_hot_identity_in_the_lookup(spark, tiny_thresholds):
    ids = saved(spark, sightings(spark), "ids")
    this_run = saved(
        spark,
        spark.sql(
            "select 'hot' identity_id, 'top' active_identity_id,"
            " timestamp_ntz '2024-06-05 00:00:00' merged_at,"
            " timestamp_ntz '2024-06-05 00:00:00' model_tstamp"
            " union all select concat('i', id), 'other', timestamp_ntz '2024-06-05 00:00:00',"
            " timestamp_ntz '2024-06-05 00:00:00' from range(2000)"
        ),
        "this_run",
    )
    n, plan = final_plan(lookup.identifier_mapping_this_run(ids, this_run, IdentityConfig()))
    assert n == N and "SortMergeJoin(skew=true)" in plan
    stored = saved(
        spark, lookup.identifier_mapping_this_run(ids, this_run.limit(0), IdentityConfig()), "lookup"
    )
    n, plan = final_plan(lookup.affected_stored(stored, this_run, this_run, stored.limit(0)))
    assert n >= N * 4 // 5 and "SortMergeJoin(skew=true)" in plan


def test_hot_event_id_is_cut_before_the_shuffle(spark):
    copies = spark.range(0, N, 1, 8).select(
        F.concat(F.lit("same"), F.col("id") % 1).alias("event_id"),
        F.expr("timestamp_ntz '2024-06-01' + make_dt_interval(0, 0, 0, id)").alias("collector_tstamp"),
        F.col("id").alias("derived_tstamp"),
    )
    df = src.dedupe_events(copies)
    assert df.collect()[0]["derived_tstamp"] == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in below


def test_hot_identity_facts_are_cut(spark, tiny_thresholds):
    """One identity has nearly all facts, all on one day."""
    facts = spark.range(0, N, 1, 8).select(
        F.expr("if(id % 10 < 9, 'hot', concat('i', id % 50))").alias("identity_id"),
        F.col("id").alias("fact"),
        F.expr("timestamp_ntz '2024-06-02 00:00:00' + make_dt_interval(0, 0, 0, id % 80000)").alias("ts"),
    )
    facts = saved(spark, facts, "facts")
    scd = saved(
        spark,
        spark.sql(
            "select 'hot' identity_id, concat('P', id) active_identity_id,"
            " timestamp_ntz '2024-06-01' + make_dt_interval(0, id) effective_at,"
            " timestamp_ntz '2024-06-01' + make_dt_interval(0, id + 1) superseded_at from range(48)"
        ),
        "scd",
    )
    got = history.active_as_of(facts, scd, "ts")
    wrong = got.where(
        "active_identity_id <> concat('P', 24 + cast(floor((fact % 80000) / 3600) as int))"
    )
    assert got.count() == N * 9 // 10
    assert wrong.count() == 0
    done = got.groupBy("active_identity_id").count()
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 4 and "skew=true" in plan
