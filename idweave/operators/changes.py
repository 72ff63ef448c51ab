"""Audit log: identities created and merged.

Names used below: ``edges`` are the exploded merge edges of the batch, ``this_run``
its child-to-root mapping, ``affected`` the stored mapping rows whose parent is
absorbed by this batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.config import RunContext
from idweave.functions.columns import ntz_lit, surrogate_key
from idweave.functions.joins import own_shuffle
from idweave.operators import mapping


def cascade_times(edges: DataFrame, this_run: DataFrame) -> DataFrame:
    """Per root: the latest merge among its children in the batch."""
    latest = edges.groupBy("identity_id").agg(F.max("merged_at").alias("merged_at"))
    return _root_times(latest.join(_roots(this_run), "identity_id"))


def _roots(this_run: DataFrame) -> DataFrame:
    return this_run.select("identity_id", F.col("active_identity_id").alias("root_id"))


def _root_times(children: DataFrame) -> DataFrame:
    return children.groupBy(F.col("root_id").alias("active_identity_id")).agg(
        F.max("merged_at").alias("last_merge_at")
    )


def cascade_children(edges: DataFrame, affected: DataFrame) -> DataFrame:
    """Children whose root changes in this run.

    Either listed under more than one parent in the batch (smallest and largest
    parent differ, which one plain aggregate can tell), or stored under a parent
    that is absorbed now.
    """
    several = (
        edges.groupBy("identity_id")
        .agg(F.min("active_identity_id").alias("lo"), F.max("active_identity_id").alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select("identity_id")
    )
    return several.unionByName(affected.select("identity_id")).distinct()


def intermediate_event_times(edges: DataFrame) -> DataFrame:
    """Per parent of the batch: its latest merge."""
    return edges.groupBy("active_identity_id").agg(F.max("merged_at").alias("last_merge_at"))


def orphan_cascades(affected: DataFrame, this_run: DataFrame, edges: DataFrame) -> DataFrame:
    """Affected children the payload no longer lists, moved to the new root."""
    moved = mapping.orphan_rows(affected, this_run).select(
        F.col("active_identity_id").alias("identity_id"),
        F.col("identity_id").alias("previous_identity_id"),
        F.col("merged_at").alias("effective_at"),
    )
    listed = edges.select(F.col("identity_id").alias("previous_identity_id"))
    return moved.join(listed, "previous_identity_id", "left_anti").select(*moved.columns)


def created_changes(identities_this_run: DataFrame) -> DataFrame:
    """One ``created`` row per identity seen in the batch."""
    return identities_this_run.select(
        "identity_id",
        F.lit(None).cast("string").alias("previous_identity_id"),
        F.col("first_derived_tstamp").alias("effective_at"),
        F.lit("created").alias("change_type"),
        "first_seen_event_id",
        F.col("first_app_id").alias("first_seen_app_id"),
    )


def resolved_merge_changes(
    edges: DataFrame,
    this_run: DataFrame,
    affected: DataFrame,
    pre_mapping: DataFrame | None = None,
) -> DataFrame:
    """(root, child) rows with a cascade-aware effective time, one per child.

    A child that is re-rooted by a later merge takes the time of the root's latest
    merge; a child merged directly keeps its own. With ``pre_mapping``, the mapping
    before the run, edges recorded there with the same parent and time are not
    emitted again, but they still count for the cascade times.

    The edges are folded to one row per child first. All joins on the child are
    then one-to-one, and the join on the root is the last step, where a root with
    very many children can be split.
    """
    if pre_mapping is None:
        marked = edges.withColumn("known", F.lit(False))
    else:
        recorded = pre_mapping.select(
            "identity_id", "active_identity_id", "merged_at", F.lit(True).alias("known")
        )
        marked = edges.join(
            recorded, ["identity_id", "active_identity_id", "merged_at"], "left"
        ).withColumn("known", F.coalesce("known", F.lit(False)))
    fresh = ~F.col("known")
    per_child = marked.groupBy("identity_id").agg(
        F.max("merged_at").alias("merged_at"),
        F.min("active_identity_id").alias("lo"),
        F.max("active_identity_id").alias("hi"),
        F.min(F.when(fresh, F.struct("merged_at", "triggering_event_id"))).alias("own"),
        F.min(F.when(fresh, F.col("triggering_event_id"))).alias("any_event"),
    )
    moved = affected.select("identity_id").distinct().withColumn("moved", F.lit(True))
    children = per_child.join(_roots(this_run), "identity_id")
    times = _root_times(children.select("root_id", "merged_at")).withColumnRenamed(
        "active_identity_id", "root_id"
    )
    rows = (
        children.where(F.col("own").isNotNull())
        .join(moved, "identity_id", "left")
        .select(
            "root_id",
            "identity_id",
            "own",
            "any_event",
            (F.col("moved").isNotNull() | (F.col("lo") != F.col("hi"))).alias("cascading"),
        )
        .join(own_shuffle(times, "root_id"), "root_id")
    )
    # a cascading child's edges all take the root's time, so the smallest event id names it
    return rows.select(
        F.col("root_id").alias("identity_id"),
        F.col("identity_id").alias("previous_identity_id"),
        F.when(F.col("cascading"), F.col("last_merge_at"))
        .otherwise(F.col("own.merged_at"))
        .alias("effective_at"),
        F.lit("merged").alias("change_type"),
        F.when(F.col("cascading"), F.col("any_event"))
        .otherwise(F.col("own.triggering_event_id"))
        .alias("first_seen_event_id"),
    )


def intermediate_merge_changes(edges: DataFrame) -> DataFrame:
    """(intermediate, child) rows, so a step of a chain inside one batch is kept.

    Every child of an intermediate parent takes the parent's latest merge time.
    """
    inner = mapping.intermediate_parents(edges).withColumnRenamed(
        "passed_id", "active_identity_id"
    )
    times = intermediate_event_times(edges).join(inner, "active_identity_id", "left_semi")
    pairs = edges.groupBy("active_identity_id", "identity_id").agg(
        F.min("triggering_event_id").alias("first_seen_event_id")
    )
    times = own_shuffle(times, "active_identity_id")
    return pairs.join(times, "active_identity_id").select(
        F.col("active_identity_id").alias("identity_id"),
        F.col("identity_id").alias("previous_identity_id"),
        F.col("last_merge_at").alias("effective_at"),
        F.lit("merged").alias("change_type"),
        "first_seen_event_id",
    )


def orphan_merge_changes(orphans: DataFrame, edges: DataFrame) -> DataFrame:
    """(new root, orphan) rows; the event is the one that moved the old parent.

    Edges are folded to one row per (parent, time) before the join, so it never
    multiplies rows.
    """
    events = edges.groupBy(
        F.col("active_identity_id").alias("identity_id"), F.col("merged_at").alias("effective_at")
    ).agg(F.min("triggering_event_id").alias("first_seen_event_id"))
    events = own_shuffle(events, "identity_id")
    return orphans.join(events, ["identity_id", "effective_at"]).select(
        "identity_id",
        "previous_identity_id",
        "effective_at",
        F.lit("merged").alias("change_type"),
        "first_seen_event_id",
    )


def first_apps(
    absorbed: DataFrame, identities: DataFrame, identities_this_run: DataFrame
) -> DataFrame:
    """First app per absorbed identity: the stored profile's, else the batch's.

    ``absorbed`` has one row per id; the profile table is cut down to those ids
    before it is joined, and every join is one-to-one.
    """
    stored = identities.join(absorbed, "identity_id", "left_semi").select(
        "identity_id", F.col("first_app_id").alias("stored_app")
    )
    batch = identities_this_run.select("identity_id", F.col("first_app_id").alias("batch_app"))
    return (
        absorbed.join(stored, "identity_id", "left")
        .join(batch, "identity_id", "left")
        .select(
            F.col("identity_id").alias("previous_identity_id"),
            F.coalesce("stored_app", "batch_app").alias("first_seen_app_id"),
        )
    )


def id_changes_this_run(
    edges: DataFrame,
    this_run: DataFrame,
    affected: DataFrame,
    identities_this_run: DataFrame,
    identities: DataFrame,
    run: RunContext,
    pre_mapping: DataFrame | None = None,
) -> DataFrame:
    """All changes of the batch. ``identities`` is the profile table after its update."""
    merged = (
        resolved_merge_changes(edges, this_run, affected, pre_mapping)
        .unionByName(intermediate_merge_changes(edges))
        .unionByName(orphan_merge_changes(orphan_cascades(affected, this_run, edges), edges))
    )
    absorbed = edges.select("identity_id").unionByName(affected.select("identity_id")).distinct()
    apps = own_shuffle(
        first_apps(absorbed, identities, identities_this_run), "previous_identity_id"
    )
    rows = created_changes(identities_this_run).unionByName(
        merged.join(apps, "previous_identity_id", "left")
    )
    return rows.select(
        surrogate_key("identity_id", "previous_identity_id").alias("id_change_key"),
        "identity_id",
        "previous_identity_id",
        "effective_at",
        ntz_lit(run.run_tstamp).alias("changed_at"),
        "change_type",
        "first_seen_event_id",
        "first_seen_app_id",
    )


def merge_id_changes(prev: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to upsert into the log: earliest times win, ties keep the stored event.

    Rows that come out as they are stored are left out.
    """
    stored = prev.join(new.select("id_change_key"), "id_change_key", "left_semi").select(
        "id_change_key",
        F.struct("effective_at", "changed_at", "first_seen_event_id", "first_seen_app_id").alias(
            "old"
        ),
    )
    newer_wins = F.col("old.effective_at").isNull() | (
        F.col("effective_at") < F.col("old.effective_at")
    )

    def follow(name: str) -> Column:
        return F.when(newer_wins, F.col(name)).otherwise(F.col(f"old.{name}")).alias(name)

    merged = new.join(stored, "id_change_key", "left").select(
        "old",
        "id_change_key",
        "identity_id",
        "previous_identity_id",
        # least skips nulls, so an unmatched row keeps its own times
        F.least("effective_at", "old.effective_at").alias("effective_at"),
        F.least("changed_at", "old.changed_at").alias("changed_at"),
        "change_type",
        follow("first_seen_event_id"),
        follow("first_seen_app_id"),
    )
    now = F.struct("effective_at", "changed_at", "first_seen_event_id", "first_seen_app_id")
    return merged.where(~F.col("old").eqNullSafe(now)).drop("old")
