"""An identity event stream derived from the plain `events` test table.

The test data has no identity contexts, so they are computed from its rows: every
row is a page event of the identity of its user, and every tenth sign-up inside a
block of five users is a merge. Blocks are, in turn, a fan-in (one root absorbs
the others), a chain whose root changes at every step, and never merged. Every
tenth chain block sends payloads that list only the newest child. Once a block has
lost its four children, every further merge event sends the last payload again. One event in
seventeen arrives ten days late and one in ten is sent twice, the copy with a
later collector time and another app.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.config import Identifier, IdentityConfig, RunContext

CONFIG = IdentityConfig(
    identifiers=(
        Identifier("domain_userid", "domain_userid"),
        Identifier("user_id", "user_id"),
        Identifier("network_userid", "network_userid"),
    ),
    start_date=datetime(2024, 1, 1),
    backfill_limit_days=10,
)

RUN_TIMES = (datetime(2024, 3, 1), datetime(2024, 3, 2), datetime(2024, 3, 3))

EVER = (datetime(1, 1, 1), datetime(9999, 12, 31, 23, 59, 59, 999999))

# Three arrival windows that cover all time.
BATCHES = (
    RunContext(EVER[0], datetime(2024, 1, 10, 23, 59, 59, 999999), RUN_TIMES[0]),
    RunContext(datetime(2024, 1, 11), datetime(2024, 1, 20, 23, 59, 59, 999999), RUN_TIMES[1]),
    RunContext(datetime(2024, 1, 21), EVER[1], RUN_TIMES[2]),
)
WHOLE = RunContext(*EVER, RUN_TIMES[0])

# children a block can lose to its root
MOST_CHILDREN = 4

def _tag(prefix: str, col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(prefix), c.cast("string"))


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test table."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def page_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity-bearing events, copies included."""
    ev = source_events(spark, sf_dir).withColumn(
        "copy", F.explode(F.expr("if(event_id % 10 = 3, array(0, 1), array(0))"))
    )
    app = F.expr("case event_id % 3 when 0 then 'web' when 1 then 'ios' else 'android' end")
    network = F.when(
        F.expr("event_id % 7 <> 0"), _tag("n", F.regexp_extract("props", "([0-9]+)", 1))
    )
    context = F.struct(
        _tag("id_", "user_id").alias("identity_id"),
        F.expr("ts - make_dt_interval(0, 0, 0, event_id % 50)").alias("created_at"),
    )
    return ev.select(
        _tag("e", "event_id").alias("event_id"),
        F.col("event_type").alias("event_name"),
        F.when(F.col("copy") == 1, F.lit("copy")).otherwise(app).alias("app_id"),
        _tag("d", "user_id").alias("domain_userid"),
        F.when(F.col("event_type") == "purchase", _tag("u", "user_id")).alias("user_id"),
        network.alias("network_userid"),
        F.expr("ts + make_dt_interval(0, 0, 0, 0.1 + copy)").alias("collector_tstamp"),
        F.col("ts").alias("derived_tstamp"),
        F.expr("if(event_id % 17 = 0, ts + interval 10 days, ts)").alias("load_tstamp"),
        F.array(context).alias("identity_context"),
        F.lit(None)
        .cast(
            "struct<identity_id:string,merged:array<struct<identity_id:string,"
            "created_at:timestamp_ntz,merged_at:timestamp_ntz,triggering_event_id:string>>,"
            "merges:array<string>>"
        )
        .alias("identity_merge"),
    )


def merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge events with their cumulative payloads."""
    signups = (
        source_events(spark, sf_dir)
        .where("event_type = 'signup'")
        .select("event_id", "ts", F.expr("user_id - user_id % 5").alias("base"))
        .where("base % 15 in (0, 5)")
    )
    in_block = Window.partitionBy("base").orderBy("ts", "event_id")
    steps = (
        signups.withColumn("rk", F.row_number().over(in_block))
        .where("rk % 10 = 0")
        .selectExpr("base", "event_id", "ts", f"cast(least(rk / 10, {MOST_CHILDREN}) as int) as k", "rk")
    )
    fan_in = "base % 15 = 0"
    steps = steps.selectExpr(
        "*",
        f"concat('id_', if({fan_in}, base, base + 4 - k)) as parent",
        f"concat('id_', if({fan_in}, base + k, base + 5 - k)) as child",
        "concat('m', event_id) as merge_id",
    )
    child = F.struct(
        F.col("child").alias("identity_id"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("merged_at"),
        F.col("merge_id").alias("triggering_event_id"),
    )
    # a block's children so far, four at most: a running list in the order of the ranks
    first_steps = F.when(F.col("rk") <= 10 * MOST_CHILDREN, child)
    steps = steps.withColumn("listed", F.collect_list(first_steps).over(in_block))
    listed = F.col("listed")
    merged = F.when(F.expr("base % 30 = 20"), F.slice(listed, -1, 1)).otherwise(listed)
    rows = steps.withColumn("merged", merged)
    null = F.lit(None).cast("string")
    return rows.select(
        F.col("merge_id").alias("event_id"),
        F.lit(CONFIG.merge_event_name).alias("event_name"),
        F.lit("web").alias("app_id"),
        null.alias("domain_userid"),
        null.alias("user_id"),
        null.alias("network_userid"),
        F.expr("ts + make_dt_interval(0, 0, 0, 0.1)").alias("collector_tstamp"),
        F.col("ts").alias("derived_tstamp"),
        F.col("ts").alias("load_tstamp"),
        F.lit(None)
        .cast("array<struct<identity_id:string,created_at:timestamp_ntz>>")
        .alias("identity_context"),
        F.struct(
            F.col("parent").alias("identity_id"),
            "merged",
            F.transform("merged", lambda m: m["identity_id"]).alias("merges"),
        ).alias("identity_merge"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stream, as a tracker pipeline would land it."""
    return page_events(spark, sf_dir).unionByName(merge_events(spark, sf_dir))
