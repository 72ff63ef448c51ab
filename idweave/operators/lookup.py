"""External identifier to active identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.config import IdentityConfig
from idweave.functions.columns import surrogate_key
from idweave.functions.joins import own_shuffle
from idweave.operators.extract import hash_identifier_values

KEY = ["active_identity_id", "id_type", "id_value"]


def _uuid() -> Column:
    return surrogate_key(*KEY).alias("uuid")


def resolve_active(identifiers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Identifier rows with the id they resolve to, one hop through the mapping."""
    parents = mapping.select("identity_id", F.col("active_identity_id").alias("parent"))
    return (
        identifiers.where(F.col("identity_id").isNotNull())
        .join(parents, "identity_id", "left")
        .select(
            F.coalesce("parent", "identity_id").alias("active_identity_id"),
            "id_type",
            "id_value",
            "first_app_id",
            "last_app_id",
            F.col("first_derived_tstamp").alias("first_seen_at"),
            F.col("last_derived_tstamp").alias("last_seen_at"),
            "first_seen_event_id",
        )
    )


def _fold(rows: DataFrame, *flags: Column) -> DataFrame:
    """Collapse rows to one per (active id, type, value).

    ``stored`` is 1 for rows already in the table and 0 for rows of the batch:
    at equal times the stored row wins on both ends.
    """
    first = F.struct("first_seen_at", -F.col("stored"), "first_seen_event_id", "first_app_id")
    last = F.struct("last_seen_at", "stored", "last_app_id")
    return rows.groupBy(*KEY).agg(F.min(first).alias("f"), F.max(last).alias("l"), *flags)


def _folded_columns(folded: DataFrame) -> DataFrame:
    return folded.select(
        _uuid(),
        *KEY,
        "f.first_app_id",
        "l.last_app_id",
        "f.first_seen_at",
        "l.last_seen_at",
        "f.first_seen_event_id",
    )


def identifier_mapping_this_run(
    identifiers: DataFrame, mapping: DataFrame, cfg: IdentityConfig
) -> DataFrame:
    """One row per (active id, type, value) of the batch.

    ``mapping`` is the id mapping after this run's update.
    """
    resolved = resolve_active(hash_identifier_values(identifiers, cfg), mapping)
    return _folded_columns(_fold(resolved.withColumn("stored", F.lit(0))))


def repoint_identifiers(
    stored: DataFrame, mapping: DataFrame, this_run: DataFrame, new: DataFrame
) -> DataFrame:
    """Stored rows whose active id was absorbed this run, under their new parent.

    Rows the batch carries itself, and rows for keys that exist already under the
    new parent, are folded instead: see :func:`identifier_mapping_updates`.
    """
    absorbed = this_run.select(F.col("identity_id").alias("active_identity_id"))
    moved = _resolve_stored(stored.join(absorbed, "active_identity_id", "left_semi"), mapping)
    fresh = moved.join(new.select(*KEY), KEY, "left_anti")
    return _folded_columns(_fold(fresh.withColumn("stored", F.lit(1))))


def resolve_history(
    stored: DataFrame, mapping: DataFrame, new: DataFrame, this_run: DataFrame
) -> DataFrame:
    """Stored rows that share an identifier with the batch, with their current parent."""
    ids = (
        new.select("active_identity_id")
        .unionByName(this_run.select(F.col("identity_id").alias("active_identity_id")))
        .distinct()
    )
    values = new.select("id_type", "id_value").distinct()
    relevant = stored.join(
        own_shuffle(values, "id_value"), ["id_type", "id_value"], "left_semi"
    ).join(own_shuffle(ids, "active_identity_id"), "active_identity_id", "left_semi")
    return _resolve_stored(relevant, mapping)


def _resolve_stored(stored: DataFrame, mapping: DataFrame) -> DataFrame:
    parents = mapping.select(
        F.col("identity_id").alias("active_identity_id"),
        F.col("active_identity_id").alias("parent"),
    )
    return stored.join(parents, "active_identity_id", "left").select(
        F.coalesce("parent", "active_identity_id").alias("active_identity_id"),
        "id_type",
        "id_value",
        "first_app_id",
        "last_app_id",
        "first_seen_at",
        "last_seen_at",
        "first_seen_event_id",
    )


def fold_history(new: DataFrame, history: DataFrame) -> DataFrame:
    """The batch's rows widened by the resolved stored rows of the same key."""
    rows = new.select(*history.columns).withColumn("stored", F.lit(0)).unionByName(
        history.withColumn("stored", F.lit(1))
    )
    folded = _fold(rows, F.min("stored").alias("only_stored"))
    return _folded_columns(folded.where(F.col("only_stored") == 0))


def touched_ids(mapping: DataFrame, this_run: DataFrame, new: DataFrame) -> DataFrame:
    """Active ids whose stored rows the run can touch, with ``absorbed`` and ``parent``.

    They are the ids seen in the batch, the ids absorbed by it and the ids they move to.
    """
    absorbed = this_run.select(
        F.col("identity_id").alias("active_identity_id"), F.lit(True).alias("absorbed")
    )
    ids = (
        new.select("active_identity_id")
        .unionByName(this_run.select("active_identity_id"))
        .unionByName(absorbed.select("active_identity_id"))
        .distinct()
    )
    parents = mapping.join(
        ids.withColumnRenamed("active_identity_id", "identity_id"), "identity_id", "left_semi"
    ).select(
        F.col("identity_id").alias("active_identity_id"),
        F.col("active_identity_id").alias("parent"),
    )
    # one small table per id: is it touched, was it absorbed, who is its parent
    return ids.join(absorbed, "active_identity_id", "left").join(parents, "active_identity_id", "left")


def affected_stored(
    stored: DataFrame, mapping: DataFrame, this_run: DataFrame, new: DataFrame
) -> DataFrame:
    """Stored rows the run can touch, resolved, with ``old_uuid`` and ``absorbed``.

    Everything else in the table stays as it is and is only read for its key.
    """
    return stored_of(stored, touched_ids(mapping, this_run, new))


def stored_of(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """:func:`affected_stored` from the ids of :func:`touched_ids`."""
    facts = own_shuffle(touched, "active_identity_id")
    return stored.join(facts, "active_identity_id").select(
        F.col("uuid").alias("old_uuid"),
        F.coalesce("parent", "active_identity_id").alias("active_identity_id"),
        "id_type",
        "id_value",
        "first_app_id",
        "last_app_id",
        "first_seen_at",
        "last_seen_at",
        "first_seen_event_id",
        F.coalesce("absorbed", F.lit(False)).alias("absorbed"),
    )


def identifier_mapping_updates(affected: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to upsert: batch rows and repointed rows, each folded with what is stored.

    Batch rows, repointed rows and rows already stored under the target key meet
    in one aggregate. A key is kept when the batch or a merge touches it.
    """
    columns = [c for c in new.columns if c != "uuid"]
    rows = new.select(*columns, F.lit(0).alias("stored"), F.lit(1).alias("touched")).unionByName(
        affected.select(
            *columns, F.lit(1).alias("stored"), F.col("absorbed").cast("int").alias("touched")
        )
    )
    folded = _fold(rows, F.max("touched").alias("touched"))
    return _folded_columns(folded.where(F.col("touched") == 1))


def stale_rows(affected: DataFrame) -> DataFrame:
    """Keys of stored rows that still point at an id absorbed this run."""
    return affected.where("absorbed").select(F.col("old_uuid").alias("uuid"))
