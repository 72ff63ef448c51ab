"""From raw events to identity rows, merge edges and identifier rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.config import IdentityConfig
from idweave.functions.columns import hash_identifier

# id_type of the extra row that carries the event itself through `observations`
PROFILE = "__PROFILE__"


def identity_fields(events: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Add ``identity_id`` and ``created_at`` from the first element of the context."""
    first = F.get(F.col(cfg.context_column), F.lit(0))
    return events.withColumns(
        {"identity_id": first[cfg.context_id_field], "created_at": first["created_at"]}
    )


def has_identity(events: DataFrame) -> DataFrame:
    """Events that carry an identity."""
    return events.where(F.col("identity_id").isNotNull())


def merge_events_this_run(base: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Merge events of the batch with parent id and payload pulled out."""
    return base.where(F.col("event_name") == cfg.merge_event_name).select(
        F.col("event_id").alias("merge_event_id"),
        "active_identity_id",
        "collector_tstamp",
        "derived_tstamp",
        "merged",
        "merges",
    )


def explode_merged(merge_events: DataFrame) -> DataFrame:
    """Distinct (parent, child, merged_at) edges with their smallest triggering event.

    Payloads are cumulative, so the exploded rows repeat; the aggregate sits
    directly on the explode and folds the repeats before anything is shuffled.
    """
    exploded = merge_events.select("active_identity_id", F.explode("merged").alias("m"))
    return (
        exploded.select("active_identity_id", "m.identity_id", "m.merged_at", "m.triggering_event_id")
        .groupBy("active_identity_id", "identity_id", "merged_at")
        .agg(F.min("triggering_event_id").alias("triggering_event_id"))
    )


def unpivot_identifiers(events: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Identifier columns to (id_type, id_value) rows, nulls dropped."""
    typed = events.select(
        "identity_id",
        "event_id",
        "app_id",
        "derived_tstamp",
        *[F.col(i.alias).cast("string").alias(i.id_type) for i in cfg.identifiers],
    )
    return typed.unpivot(
        ["identity_id", "event_id", "app_id", "derived_tstamp"],
        [i.id_type for i in cfg.identifiers],
        "id_type",
        "id_value",
    ).where(F.col("id_value").isNotNull())


def observations(base: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """First and last sighting per (identity, identifier), and per identity itself.

    One pass serves both the identifier rows and the identity profile: every
    event is unpivoted into its identifiers plus one ``PROFILE`` row, and a
    single aggregate keyed on (identity_id, id_type, id_value) folds them. The
    result is as small as the set of distinct identifiers and is what later
    steps read instead of the events.
    """
    events = has_identity(base).select(
        "identity_id",
        "event_id",
        "app_id",
        "derived_tstamp",
        "created_at",
        *[F.col(i.alias).alias(i.id_type) for i in cfg.identifiers],
        F.lit("").alias(PROFILE),
    )
    rows = events.unpivot(
        ["identity_id", "event_id", "app_id", "derived_tstamp", "created_at"],
        [*[i.id_type for i in cfg.identifiers], PROFILE],
        "id_type",
        "id_value",
    ).where(F.col("id_value").isNotNull())
    sighting = ("derived_tstamp", "event_id", "app_id", "created_at")
    return rows.groupBy("identity_id", "id_type", "id_value").agg(
        F.min(F.struct(*sighting)).alias("first"), F.max(F.struct(*sighting)).alias("last")
    )


def pivot_earliest(identifiers: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Earliest value per (identity, identifier type), one column per identifier."""
    aggs = []
    for i in cfg.identifiers:
        of_type = F.upper("id_type") == i.id_type
        pick = F.struct("first_derived_tstamp", "first_seen_event_id", "id_value")
        aggs.append(F.min(F.when(of_type, pick))["id_value"].alias(i.alias))
    return identifiers.groupBy("identity_id").agg(*aggs)


def hash_identifier_values(identifiers: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Replace ``id_value`` by its hash when the configuration asks for it."""
    if not cfg.hash_identifiers:
        return identifiers
    return identifiers.withColumn("id_value", hash_identifier("id_value"))
