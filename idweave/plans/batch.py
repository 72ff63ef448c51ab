"""One batch through all tables.

Order matters and follows from what each step reads: the mapping as it was before
the run, the profiles as they are after it, the changes of this run only. All steps are
computed from the tables as they were; "after" is the stored rows with the staged updates
on top. A table is written once nothing else of the run reads it, the mapping after all
others: whatever is written already when a run breaks off, running it again ends at the
same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from idweave import schemas
from idweave.config import IdentityConfig, RunContext
from idweave.functions.joins import of_run, only_of_run, own_shuffle
from idweave.operators import changes, extract, history, lookup, mapping, profile
from idweave.operators import upsert as upsert_ops
from idweave.plans.tables import IdentityTables

TABLES = tuple(schemas.KEYS)

# tables a table is computed from, besides the batch
NEEDS = {
    "merge_events": (),
    "identities": (),
    "id_mapping": (),
    "id_changes": ("identities", "id_mapping"),
    "identifier_mapping": ("id_mapping",),
    "id_mapping_scd": ("identities", "id_mapping"),
}

# tables that need every event of an identity, and not only its merges
FROM_SIGHTINGS = {"identities", "identifier_mapping"}

# columns of the staged batch that are read from merge events only, once arrival times are counted
OF_MERGES = ("event_name", "collector_tstamp", "load_tstamp")

# columns of the staged batch in which values hardly repeat
RARELY_REPEATED = ("event_id", "collector_tstamp", "derived_tstamp", "load_tstamp", "created_at")


def closure(outputs: Iterable[str]) -> set[str]:
    """The tables that have to be kept up to date for ``outputs``."""
    wanted: set[str] = set()
    for table in outputs:
        wanted |= {table, *NEEDS[table]}
    return wanted


def stage_batch(
    store: IdentityTables,
    base: DataFrame,
    cfg: IdentityConfig,
    arrived: Observation,
    outputs: Iterable[str] = TABLES,
) -> DataFrame:
    """Write the deduplicated narrow batch once; every branch reads it from there.

    Merge events get a folder of their own, so the merge branch does not scan the rest.
    ``arrived`` gets the first and last arrival time and the number of events in that pass.
    Where ``outputs`` come from merge events alone, the others are counted but not written.
    The columns of :data:`OF_MERGES` are null in the others, for which no step reads them.
    """
    is_merge = F.col("event_name") == F.lit(cfg.merge_event_name)
    tagged = base.withColumn("is_merge", F.coalesce(is_merge, F.lit(False))).observe(
        arrived,
        F.min("load_tstamp").alias("first_load"),
        F.max("load_tstamp").alias("last_load"),
        F.count("*").alias("events"),
    )
    if not closure(outputs) & FROM_SIGHTINGS:
        tagged = tagged.where("is_merge")
    tagged = tagged.withColumns({c: F.when(F.col("is_merge"), F.col(c)) for c in OF_MERGES})
    return store.stage("base_events", tagged, "is_merge", plain=RARELY_REPEATED)


def apply_batch(
    store: IdentityTables,
    base: DataFrame,
    cfg: IdentityConfig,
    run: RunContext,
    outputs: Iterable[str] = TABLES,
) -> set[str]:
    """Update the tables ``outputs`` from one staged batch (:func:`stage_batch`).

    Tables they are computed from but that are not among them are only read: they
    have consumed the batch before. Returns the tables updated. Steps that do not
    read each other's results are submitted as concurrent Spark jobs, so the tail
    of one does not leave the cluster idle.
    """
    updated = set(outputs)
    wanted = closure(updated)
    layouts = schemas.tables(cfg)
    merge_events = extract.merge_events_this_run(base.where("is_merge"), cfg)

    def stored(table: str) -> DataFrame:
        return store.read(table, layouts[table])

    def this_runs(name: str, rows: DataFrame) -> DataFrame:
        return only_of_run(store.stage(name, of_run(rows, run.run_tstamp)), run.run_tstamp)

    def upsert(table: str, rows: DataFrame, deletes: DataFrame | None = None) -> None:
        if table in updated:
            store.upsert(table, schemas.KEYS[table], rows, deletes)

    def updates_of(table: str, rows: DataFrame) -> DataFrame:
        return store.stage_updates(table, schemas.KEYS[table], rows)

    def observe() -> tuple[DataFrame, DataFrame, DataFrame]:
        """Identifiers of the batch, its profiles, and their updates.

        Both come out of one pass over the events when both are wanted; one alone takes
        a smaller aggregate.
        """
        if "identities" not in wanted:
            return profile.new_identifiers_this_run(base, cfg), None, None
        identifiers = None
        if "identifier_mapping" in updated:
            observed = store.stage("observations", extract.observations(base, cfg))
            identifiers = profile.identifiers_from(observed)
            rows = profile.identities_from(observed, cfg)
        else:
            rows = profile.new_identities_this_run(base, cfg)
        seen = store.stage("identities_this_run", rows)
        if not store.exists("identities"):
            return identifiers, seen, seen
        merged = profile.merge_identities(stored("identities"), seen, cfg)
        return identifiers, seen, updates_of("identities", merged)

    def merge() -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Edges, child to root, stored rows with an absorbed parent, updates of the mapping."""
        edges = store.stage("edges", extract.explode_merged(merge_events))
        if cfg.close_roots:
            rows = mapping.closed_mapping_this_run(edges, stored("id_mapping"), run, store.stage)
        else:
            rows = mapping.id_mapping_this_run(edges, run)
        this_run = store.stage("id_mapping_this_run", rows)
        if not store.exists("id_mapping"):
            return edges, this_run, stored("id_mapping"), this_run
        before = stored("id_mapping")
        affected = store.stage("mapping_affected", mapping.snapshot_affected(before, this_run))
        updates = mapping.mapping_updates(
            before,
            this_run,
            affected,
            compress_orphans=cfg.compress_orphans or cfg.close_roots,
            only_newer=cfg.only_newer,
        )
        if updates is not this_run:
            updates = updates_of("id_mapping", updates)
        return edges, this_run, affected, updates

    def after(table: str, updates: DataFrame) -> DataFrame:
        """The table as this run leaves it."""
        if table not in updated or not store.exists(table):
            return updates if table in updated else stored(table)
        return upsert_ops.upsert_by_key(stored(table), updates, schemas.KEYS[table])

    def record_changes(edges, this_run, affected, seen, profiles) -> DataFrame:
        recorded = None
        # meaningless when the log replays a batch the mapping is already past
        if cfg.suppress_reemission and "id_mapping" in updated and store.exists("id_mapping"):
            children = edges.select("identity_id")
            recorded = stored("id_mapping").join(children, "identity_id", "left_semi")
        rows = changes.id_changes_this_run(
            edges, this_run, affected, seen, after("identities", profiles), run, recorded
        )
        return store.stage("id_changes_this_run", rows)

    def update_log(changed: DataFrame) -> None:
        if store.exists("id_changes"):
            changed = updates_of("id_changes", changes.merge_id_changes(stored("id_changes"), changed))
        upsert("id_changes", changed)

    def update_history(changed: DataFrame, this_run: DataFrame) -> None:
        if not store.exists("id_mapping_scd"):
            none = history.scd_new_records(changed.where(F.lit(False)))
            upsert("id_mapping_scd", history.scd_updates(none, changed, this_run))
            return
        ids = this_runs("scd_ids", history.ids_affected(changed))
        ids = own_shuffle(ids, "identity_id")
        known = store.stage("scd_history", stored("id_mapping_scd").join(ids, "identity_id", "left_semi"))
        rows = history.scd_updates(known.select(*history.COLUMNS), changed, this_run)
        replaced = known.select("scd_key") if cfg.replace_affected else None
        if replaced is None:
            rows = upsert_ops.changed_rows(known, rows, "scd_key")
        upsert("id_mapping_scd", updates_of("id_mapping_scd", rows), replaced)

    def update_lookup(identifiers: DataFrame, this_run: DataFrame, parents: DataFrame) -> None:
        now = after("id_mapping", parents)
        new = store.stage(
            "identifier_mapping_this_run", lookup.identifier_mapping_this_run(identifiers, now, cfg)
        )
        if not store.exists("identifier_mapping"):
            upsert("identifier_mapping", new)
            return
        touched = store.stage(
            "identifier_mapping_affected",
            lookup.stored_of(
                stored("identifier_mapping"), this_runs("lookup_ids", lookup.touched_ids(now, this_run, new))
            ),
        )
        rows = lookup.identifier_mapping_updates(touched, new)
        untouched = touched.where("not absorbed").withColumnRenamed("old_uuid", "uuid")
        rows = updates_of("identifier_mapping", upsert_ops.changed_rows(untouched, rows, "uuid"))
        upsert("identifier_mapping", rows, lookup.stale_rows(touched))

    with ThreadPoolExecutor(max_workers=6) as pool:

        def submit(step: Callable, *args: object) -> Future:
            return pool.submit(inheritable_thread_target(store.spark)(step), *args)

        last: list[Future] = []
        if "merge_events" in updated:
            last.append(submit(upsert, "merge_events", merge_events))
        ids = submit(observe) if wanted & FROM_SIGHTINGS else None
        merges = submit(merge) if "id_mapping" in wanted else None
        if merges:
            edges, this_run, affected, parents = merges.result()
        if ids:
            identifiers, seen, profiles = ids.result()
        if "identifier_mapping" in updated:
            last.append(submit(update_lookup, identifiers, this_run, parents))
        if wanted & {"id_changes", "id_mapping_scd"}:
            changed = record_changes(edges, this_run, affected, seen, profiles)
            if "id_changes" in updated:
                last.append(submit(update_log, changed))
            if "id_mapping_scd" in updated:
                last.append(submit(update_history, changed, this_run))
        if "identities" in updated:  # nothing of this run reads the stored profiles any more
            last.append(submit(upsert, "identities", profiles))
        for step in last:
            step.result()
    if "id_mapping" in updated:
        # a cycle through stored rows may turn one of their children into its root
        again = store.exists("id_mapping") and cfg.close_roots
        upsert("id_mapping", parents, mapping.roots_again(stored("id_mapping"), this_run) if again else None)
    return updated
