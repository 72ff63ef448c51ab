"""Which arrival window each table has consumed, and which one comes next."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.config import IdentityConfig
from idweave.functions.columns import ntz_lit


def init_manifest(consumed: DataFrame, models: Iterable[str]) -> DataFrame:
    """Manifest rows of the models after they consumed ``consumed`` (first run)."""
    span = consumed.agg(
        F.min("load_tstamp").alias("first_success"), F.max("load_tstamp").alias("last_success")
    ).where(F.col("last_success").isNotNull())
    names = F.explode(F.array(*[F.lit(m) for m in sorted(models)]))
    return span.select(names.alias("model"), "first_success", "last_success")


def commit_manifest(manifest: DataFrame, consumed: DataFrame, models: Iterable[str]) -> DataFrame:
    """Manifest after a successful run of the models over ``consumed``."""
    rows = manifest.unionByName(init_manifest(consumed, models))
    return rows.groupBy("model").agg(
        F.min("first_success").alias("first_success"), F.max("last_success").alias("last_success")
    )


def forget_models(manifest: DataFrame, models: Iterable[str]) -> DataFrame:
    """Manifest without the models, which makes them replay from the start date."""
    return manifest.where(~F.col("model").isin(list(models)))


def manifest_status(manifest: DataFrame, models: Iterable[str]) -> DataFrame:
    """One row describing how far the models are and whether they are in step."""
    wanted = sorted(models)
    return (
        manifest.where(F.col("model").isin(wanted))
        .agg(
            F.min("first_success").alias("min_first_success"),
            F.max("first_success").alias("max_first_success"),
            F.min("last_success").alias("min_last_success"),
            F.max("last_success").alias("max_last_success"),
            F.count("*").cast("int").alias("models_matched"),
            F.count_distinct("last_success").cast("int").alias("sync_count"),
        )
        .withColumn("has_matched_all", F.col("models_matched") == F.lit(len(wanted)))
    )


def run_limits(status: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Next arrival window as one row.

    ======== ================================ ==========================================
    state    when                             window
    ======== ================================ ==========================================
    first    no model known                   [start, start + backfill]
    replay   some models known                [start, min(start + backfill, max last)]
    catch_up all known, different last times  (min last, min(max last, min last + backfill)]
    next     all known, in step               (last, last + backfill]
    ======== ================================ ==========================================
    """
    start = ntz_lit(cfg.start_date)
    step = F.expr(f"interval {int(cfg.backfill_limit_days)} days")
    low, high = F.col("min_last_success"), F.col("max_last_success")
    state = (
        F.when(F.col("models_matched") == 0, "first")
        .when(~F.col("has_matched_all"), "replay")
        .when(F.col("sync_count") > 1, "catch_up")
        .otherwise("next")
    )
    from_start = F.col("state").isin("first", "replay")
    return status.withColumn("state", state).select(
        "state",
        F.when(from_start, start).otherwise(low).alias("lower_limit"),
        F.when(F.col("state") == "first", start + step)
        .when(F.col("state") == "replay", F.least(start + step, high))
        .when(F.col("state") == "catch_up", F.least(high, low + step))
        .otherwise(low + step)
        .alias("upper_limit"),
        from_start.alias("lower_inclusive"),
    )


def has_new_events(last_success: object | None, last_load: object | None) -> bool:
    """Whether a window that ends at ``last_load`` holds anything new for a model."""
    return last_load is not None and (last_success is None or last_load > last_success)


def due_models(manifest: DataFrame, newest: DataFrame) -> DataFrame:
    """(model, is_due): models for which ``newest`` (one row, ``newest``) is past what they consumed."""
    return manifest.join(F.broadcast(newest)).select(
        "model", (F.col("newest").isNotNull() & (F.col("last_success").isNull() | (F.col("newest") > F.col("last_success")))).alias("is_due")
    )


def full_refresh_allowed(cfg: IdentityConfig) -> bool:
    """A full rebuild may drop the manifest only in the dev environment or when allowed."""
    return cfg.environment == cfg.dev_environment or cfg.allow_refresh
