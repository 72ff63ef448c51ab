"""Planning and executing runs over the tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from idweave.config import IdentityConfig, RunContext
from idweave.functions.columns import ntz_lit, utc_ntz
from idweave.plans import manifest as mf
from idweave.plans.batch import TABLES, apply_batch, closure, stage_batch
from idweave.plans.tables import IdentityTables
from idweave.sources.events import (
    arrival_bounds,
    base_events_this_run,
    filter_app_ids,
    filter_event_names,
    select_run_window,
)


def load_manifest(store: IdentityTables) -> DataFrame:
    """The manifest as a table: first and last arrival time consumed per model."""
    return store.manifest()


def plan_run(
    store: IdentityTables,
    cfg: IdentityConfig,
    events: DataFrame,
    run_tstamp: datetime,
    models: Iterable[str] = TABLES,
) -> RunContext | None:
    """The next window with events in it, or None when everything is consumed.

    When the next window is empty but later events exist, it starts at the first
    of them, so a gap longer than the backfill limit cannot stall the runs. While some
    tables are behind, such a jump stays inside what the others have consumed; with
    nothing left there, all tables are level and go on together. Events the
    configuration filters out do not count.
    """
    wanted = closure(models)
    status = mf.manifest_status(load_manifest(store), wanted).first()
    limits = mf.run_limits(mf.manifest_status(load_manifest(store), wanted), cfg).first()
    lower, upper, inclusive = limits["lower_limit"], limits["upper_limit"], limits["lower_inclusive"]
    kept = filter_event_names(filter_app_ids(events, cfg.app_ids), cfg.event_names)
    step = timedelta(days=cfg.backfill_limit_days)

    def seek(start: datetime, end: datetime, with_start: bool) -> Row:
        window = RunContext(start, end, run_tstamp, with_start)
        return _arrivals(select_run_window(kept, window, cfg.load_date_column))

    # normally only the partitions of the window are looked at
    inside = seek(lower, upper, inclusive)
    if inside["events"]:
        return RunContext(lower, inside["last_load"], run_tstamp, inclusive)
    if limits["state"] in ("replay", "catch_up"):
        level = status["max_last_success"]
        behind = seek(upper, level, False) if upper < level else None
        if behind and behind["events"]:
            first = behind["first_load"]
            return RunContext(first, min(first + step, behind["last_load"]), run_tstamp)
        inside = seek(level, level + step, False)
        if inside["events"]:
            return RunContext(level, inside["last_load"], run_tstamp, False)
        upper = level + step
    later = seek(upper, datetime.max, False)
    if not later["events"]:
        return None
    first = later["first_load"]
    return RunContext(first, min(first + step, later["last_load"]), run_tstamp)


def _arrivals(events: DataFrame) -> Row:
    dtype = dict(events.dtypes)["load_tstamp"]
    loads = events.select(utc_ntz(F.col("load_tstamp"), dtype).alias("load_tstamp"))
    return arrival_bounds(loads).first()


def execute(
    store: IdentityTables,
    cfg: IdentityConfig,
    events: DataFrame,
    run: RunContext,
    outputs: Iterable[str] = TABLES,
) -> set[str] | None:
    """Run one window; the tables it updated, None when the window holds nothing new."""
    return process(store, cfg, base_events_this_run(events, cfg, run), run.run_tstamp, outputs)


def process(
    store: IdentityTables,
    cfg: IdentityConfig,
    base: DataFrame,
    run_tstamp: datetime,
    outputs: Iterable[str] = TABLES,
    stream_batch: tuple[str, int] | None = None,
) -> set[str] | None:
    """Stage a batch of base events and update the tables it is new for; their names.

    A stream says itself what is new and passes ``stream_batch``; otherwise the
    manifest decides per table. The manifest, and then the stream's mark, are written
    last: a run that breaks off before is run again and ends at the same rows.
    """
    arrived = Observation("arrived")
    outputs = tuple(outputs)
    staged = stage_batch(store, base, cfg, arrived, outputs)
    span = arrived.get
    if not span["events"]:
        return None
    first, last = span["first_load"], span["last_load"]
    due = closure(outputs)
    if stream_batch is None:
        known = {r["model"]: r["last_success"] for r in load_manifest(store).collect()}  # a row per model
        due = {t for t in due if mf.has_new_events(known.get(t), last)}
    if not due:
        return None
    updated = apply_batch(store, staged, cfg, RunContext(first, last, run_tstamp), due)
    times = store.spark.range(1).select(F.explode(F.array(ntz_lit(first), ntz_lit(last))).alias("load_tstamp"))
    ahead = load_manifest(store).where(F.col("model").isin(sorted(updated)))
    store.write_manifest(mf.commit_manifest(ahead, times, updated))
    if stream_batch is not None:
        store.write_stream_batch(*stream_batch)
    return updated


def run_next(
    store: IdentityTables,
    cfg: IdentityConfig,
    events: DataFrame,
    run_tstamp: datetime,
    outputs: Iterable[str] = TABLES,
) -> RunContext | None:
    """Plan and execute the next window; None when there was nothing to do."""
    run = plan_run(store, cfg, events, run_tstamp, outputs)
    if run is None or execute(store, cfg, events, run, outputs) is None:
        return None
    return run


def catch_up(
    store: IdentityTables,
    cfg: IdentityConfig,
    events: DataFrame,
    run_tstamp: datetime,
    outputs: Iterable[str] = TABLES,
) -> list[RunContext]:
    """Run windows until everything that has arrived is consumed."""
    done: list[RunContext] = []
    while (run := run_next(store, cfg, events, run_tstamp, outputs)) is not None:
        done.append(run)
    return done


def forget(store: IdentityTables, models: Iterable[str]) -> None:
    """Remove models from the manifest so that they replay."""
    none = F.lit(None).cast("timestamp_ntz")
    store.write_manifest(
        store.spark.range(1).select(
            F.explode(F.array(*[F.lit(m) for m in sorted(models)])).alias("model"),
            none.alias("first_success"),
            none.alias("last_success"),
        )
    )


def full_refresh(store: IdentityTables, cfg: IdentityConfig) -> None:
    """Drop all tables and the manifest; refused outside dev unless allowed."""
    if not mf.full_refresh_allowed(cfg):
        raise PermissionError("full refresh needs allow_refresh=True outside the dev environment")
    store.drop_all()
