"""The stored side of a batch's joins is cut down by a Bloom filter before it is shuffled."""

import pytest
from pyspark.sql import functions as F

from idweave import schemas
from idweave.functions.joins import of_run, only_of_run, own_shuffle
from idweave.operators import history, lookup
from idweave.plans.scratch import scratch_dir
from tests.conftest import at

NOW = at("09 12:00")


@pytest.fixture
def large(spark):
    """Settings under which small files count as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def saved(spark, df, name):
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def below_exchange(df, column):
    """The filter on ``column`` lies under the exchange of the side it reduces."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    lines = plan.split("\n")
    at_filter = [i for i, x in enumerate(lines) if "might_contain" in x and column in x]
    return bool(at_filter) and any("Exchange hashpartitioning" in x for x in lines[: at_filter[0]])


def test_history_of_the_ids_of_a_batch(spark, rows, large):
    n = 3000
    scd = spark.range(n).select(
        *(F.concat(F.lit("i"), F.col("id").cast("string")).alias(c) for c in ("scd_key", "identity_id", "active_identity_id")),
        F.lit("2024-06-01").cast("timestamp_ntz").alias("effective_at"),
        F.lit("created").alias("change_type"),
    )
    stored = saved(spark, scd, "scd")
    ids = saved(spark, of_run(spark.range(5).select(F.concat(F.lit("i"), "id").alias("identity_id")), NOW), "ids")
    known = history.scd_history(stored, only_of_run(ids, NOW))
    assert below_exchange(known, "identity_id")
    assert rows(known, "identity_id") == [(f"i{i}",) for i in range(5)]


def test_lookup_rows_of_the_ids_of_a_batch(spark, table, rows, large):
    n = 3000
    one = F.concat(F.lit("i"), F.col("id").cast("string"))
    when = F.lit("2024-06-01").cast("timestamp_ntz")
    stored = saved(
        spark,
        spark.range(n).select(
            one.alias("uuid"), one.alias("active_identity_id"), F.lit("X").alias("id_type"), one.alias("id_value"),
            F.lit("web").alias("first_app_id"), F.lit("web").alias("last_app_id"), when.alias("first_seen_at"),
            when.alias("last_seen_at"), F.lit("e").alias("first_seen_event_id"),
        ),
        "lookup",
    )
    this_run = table(schemas.ID_MAPPING, [("i1", "i2", "02 10:00", "02 10:00")])
    new = table(schemas.IDENTIFIER_MAPPING, [("u", "i7", "X", "v", "web", "web", "02 10:00", "02 10:00", "e")])
    touched = lookup.touched_ids(this_run, this_run, new)
    staged = only_of_run(saved(spark, of_run(touched, NOW), "touched"), NOW)
    got = lookup.stored_of(stored, staged)
    assert below_exchange(got, "active_identity_id")
    want = [("i1", "i2", True), ("i2", "i2", False), ("i7", "i7", False)]
    assert rows(got, "old_uuid", "active_identity_id", "absorbed") == want
    assert rows(lookup.affected_stored(stored, this_run, this_run, new)) == rows(got)


def test_a_side_that_is_not_said_to_be_of_a_run_gets_none(spark, large):
    left = saved(spark, spark.range(3000).select(F.concat(F.lit("i"), "id").alias("identity_id")), "plain")
    right = saved(spark, spark.range(5).select(F.concat(F.lit("i"), "id").alias("identity_id")), "plain-ids")
    assert not below_exchange(left.join(own_shuffle(right, "identity_id"), "identity_id", "left_semi"), "identity_id")
