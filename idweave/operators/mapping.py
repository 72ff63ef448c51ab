"""Child to current parent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.config import RunContext
from idweave.functions.columns import ntz_lit
from idweave.functions.joins import own_shuffle


def _children(edges: DataFrame) -> DataFrame:
    # null children are dropped: they must not empty the anti joins below
    return edges.where(F.col("identity_id").isNotNull()).select("identity_id").distinct()


def true_parents(edges: DataFrame) -> DataFrame:
    """Parents of the batch that are nobody's child in the batch."""
    parents = edges.select("active_identity_id").distinct()
    children = _children(edges).withColumnRenamed("identity_id", "active_identity_id")
    return parents.join(children, "active_identity_id", "left_anti").where(
        F.col("active_identity_id").isNotNull()
    )


def intermediate_parents(edges: DataFrame) -> DataFrame:
    """Parents of the batch that are themselves absorbed in the batch."""
    parents = edges.select("active_identity_id").distinct()
    children = _children(edges).withColumnRenamed("identity_id", "active_identity_id")
    return parents.join(children, "active_identity_id", "left_semi").select(
        F.col("active_identity_id").alias("passed_id")
    )


def edges_to_roots(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges whose parent is a root."""
    roots = own_shuffle(roots, "active_identity_id")
    return edges.join(roots, "active_identity_id", "left_semi").select(*edges.columns)


def latest_parent(edges: DataFrame) -> DataFrame:
    """One row per child: its most recent edge, ties to the larger parent id."""
    best = edges.groupBy("identity_id").agg(
        F.max(F.struct("merged_at", "active_identity_id")).alias("m")
    )
    return best.select("identity_id", "m.active_identity_id", "m.merged_at")


def id_mapping_this_run(edges: DataFrame, run: RunContext) -> DataFrame:
    """Child to root for everything merged in the batch.

    Parents that are children themselves are usually few, so they are what the
    edges are filtered against; the edge rows never need a join on the roots.
    """
    inner = intermediate_parents(edges).withColumnRenamed("passed_id", "active_identity_id")
    to_roots = edges.where(F.col("active_identity_id").isNotNull()).join(
        own_shuffle(inner, "active_identity_id"), "active_identity_id", "left_anti"
    )
    return latest_parent(to_roots).withColumn("model_tstamp", ntz_lit(run.run_tstamp))


def snapshot_affected(mapping: DataFrame, this_run: DataFrame) -> DataFrame:
    """Stored mapping rows whose parent becomes a child in this run."""
    absorbed = this_run.select(F.col("identity_id").alias("active_identity_id"))
    return mapping.join(absorbed, "active_identity_id", "left_semi").select(*mapping.columns)


def mapping_updates(
    prev: DataFrame,
    this_run: DataFrame,
    affected: DataFrame,
    *,
    compress_orphans: bool = False,
    only_newer: bool = False,
) -> DataFrame:
    """Rows to upsert into the id mapping.

    The default is the batch's rows as they are: the last batch wins whatever its
    merge time. ``only_newer`` drops rows older than what is stored.
    ``compress_orphans`` also moves stored children of an absorbed parent, even
    when the payload no longer lists them.
    """
    out = this_run
    if only_newer:
        stored = prev.join(this_run.select("identity_id"), "identity_id", "left_semi").select(
            "identity_id", F.col("merged_at").alias("stored_at")
        )
        out = (
            this_run.join(stored, "identity_id", "left")
            .where(F.col("stored_at").isNull() | (F.col("merged_at") >= F.col("stored_at")))
            .select(*this_run.columns)
        )
    if compress_orphans:
        moved = orphan_rows(affected, this_run).select(*this_run.columns)
        out = out.unionByName(moved.join(this_run, "identity_id", "left_anti"))
    return out


def orphan_rows(affected: DataFrame, this_run: DataFrame) -> DataFrame:
    """Affected children with the new parent of their old parent."""
    parent = this_run.select(
        F.col("identity_id").alias("old_parent"),
        F.col("active_identity_id"),
        F.col("merged_at"),
        F.col("model_tstamp"),
    )
    return (
        affected.select("identity_id", F.col("active_identity_id").alias("old_parent"))
        .join(parent, "old_parent")
        .select("identity_id", "active_identity_id", "merged_at", "model_tstamp")
    )


def close_to_roots(pointers: DataFrame, written: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    """(identity_id, root_id): where the chain of every id ends.

    ``pointers`` has one (identity_id, active_identity_id) per id. Each round an id takes
    the pointer of its pointer, so a chain of n steps takes log2(n) rounds; ``written`` makes
    a table of a round's result. What still points at an id with a pointer after more steps
    than there are ids goes round a cycle: its root is the smallest id of the cycle,
    which has no row of its own. Joins are many-to-one, and a parent with very many children
    can be split.
    """
    step = 0
    steps = written(
        "closure_0",
        pointers.where("identity_id is not null and active_identity_id is not null and identity_id <> active_identity_id").select(
            "identity_id", F.col("active_identity_id").alias("at"), F.col("active_identity_id").alias("least")
        ),
    )
    n = steps.count()
    while True:
        onward = steps.select(
            F.col("identity_id").alias("at"), F.col("at").alias("next"), F.col("least").alias("next_least")
        )
        if 2**step > n:  # more steps than ids: what is still open goes round
            break
        if steps.join(own_shuffle(onward.select("at"), "at"), "at", "left_semi").isEmpty():
            break
        step += 1
        moved = steps.join(own_shuffle(onward, "at"), "at", "left")
        steps = written(
            f"closure_{step}",
            moved.select(
                "identity_id", F.coalesce("next", "at").alias("at"), F.least("least", "next_least").alias("least")
            ),
        )
    # an id on a cycle has seen all of it; an id that leads to one takes what its pointer has seen
    around = own_shuffle(steps.select(F.col("identity_id").alias("at"), F.col("least").alias("root")), "at")
    return (
        steps.select("identity_id", "at")
        .join(around, "at", "left")
        .select("identity_id", F.coalesce("root", "at").alias("root_id"))
        .where("identity_id <> root_id")
    )


def closed_mapping_this_run(
    edges: DataFrame, stored: DataFrame, run: RunContext, written: Callable[[str, DataFrame], DataFrame]
) -> DataFrame:
    """Child to the end of its chain for everything merged in the batch.

    Chains go through the batch's latest edge of each child and, beyond it, through the
    stored parent of an id, which is the end of a stored chain already. Unlike
    :func:`id_mapping_this_run`, payloads needn't be cumulative, and cycles get a root.
    """
    latest = latest_parent(edges.where("active_identity_id is not null and identity_id is not null"))
    parents = latest.select(F.col("active_identity_id").alias("identity_id")).distinct()
    known = stored.join(parents, "identity_id", "left_semi").join(latest, "identity_id", "left_anti")
    columns = ["identity_id", "active_identity_id"]
    roots = close_to_roots(latest.select(*columns).unionByName(known.select(*columns)), written)
    return latest.join(roots, "identity_id").select(
        "identity_id",
        F.col("root_id").alias("active_identity_id"),
        "merged_at",
        ntz_lit(run.run_tstamp).alias("model_tstamp"),
    )


def roots_again(stored: DataFrame, this_run: DataFrame) -> DataFrame:
    """Ids that the batch makes a root and that the mapping still holds as a child."""
    roots = this_run.select(F.col("active_identity_id").alias("identity_id")).distinct()
    return stored.join(own_shuffle(roots, "identity_id"), "identity_id", "left_semi").select("identity_id")


def cyclic_ids(edges: DataFrame, this_run: DataFrame) -> DataFrame:
    """Children of the batch that got no parent: a cycle, or a chain cut off its root."""
    return _children(edges).join(this_run.select("identity_id"), "identity_id", "left_anti")
