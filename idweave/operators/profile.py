"""First and last sighting of identifiers and identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.config import IdentityConfig
from idweave.functions.columns import earliest, latest
from idweave.operators import extract


def first_occurrence(df: DataFrame, by: list[str]) -> DataFrame:
    """Earliest event per group, by (derived_tstamp, event_id)."""
    first = df.groupBy(*by).agg(earliest("derived_tstamp", "event_id", "app_id").alias("e"))
    return first.select(*by, "e.event_id", "e.app_id", "e.derived_tstamp")


def last_occurrence(df: DataFrame, by: list[str]) -> DataFrame:
    """Latest event per group, by (derived_tstamp, event_id)."""
    last = df.groupBy(*by).agg(latest("derived_tstamp", "event_id", "app_id").alias("e"))
    return last.select(*by, "e.event_id", "e.app_id", "e.derived_tstamp")


def identifiers_from(observed: DataFrame) -> DataFrame:
    """Identifier rows of :func:`extract.observations`."""
    return observed.where(F.col("id_type") != extract.PROFILE).select(
        "identity_id",
        "id_type",
        "id_value",
        F.col("first.event_id").alias("first_seen_event_id"),
        F.col("first.app_id").alias("first_app_id"),
        F.col("last.app_id").alias("last_app_id"),
        F.col("first.derived_tstamp").alias("first_derived_tstamp"),
        F.col("last.derived_tstamp").alias("last_derived_tstamp"),
    )


def identities_from(observed: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Profile per identity out of :func:`extract.observations`, one aggregate, no join."""
    is_profile = F.col("id_type") == extract.PROFILE
    values = [
        F.min(
            F.when(
                F.col("id_type") == i.id_type,
                F.struct("first.derived_tstamp", "first.event_id", "id_value"),
            )
        )["id_value"].alias(i.alias)
        for i in cfg.identifiers
    ]
    profile = observed.groupBy("identity_id").agg(
        F.min(F.when(is_profile, F.col("first"))).alias("first"),
        F.max(F.when(is_profile, F.col("last"))).alias("last"),
        *values,
    )
    return _profile_columns(profile, cfg)


def _profile_columns(seen: DataFrame, cfg: IdentityConfig) -> DataFrame:
    return seen.select(
        "identity_id",
        "first.created_at",
        F.col("first.event_id").alias("first_seen_event_id"),
        F.col("first.app_id").alias("first_app_id"),
        F.col("last.app_id").alias("last_app_id"),
        *cfg.aliases,
        F.col("first.derived_tstamp").alias("first_derived_tstamp"),
        F.col("last.derived_tstamp").alias("last_derived_tstamp"),
    )


def new_identifiers_this_run(base: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """First/last sighting per (identity, type, value) in the batch."""
    rows = extract.unpivot_identifiers(extract.has_identity(base), cfg)
    seen = rows.groupBy("identity_id", "id_type", "id_value").agg(
        earliest("derived_tstamp", "event_id", "app_id").alias("first"),
        latest("derived_tstamp", "event_id", "app_id").alias("last"),
    )
    return identifiers_from(seen)


def new_identities_this_run(base: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Profile of every identity seen in the batch, in one aggregate over the events.

    The rows are those that :func:`identities_from` makes of :func:`extract.observations`,
    without a row per identifier in between, for runs that need no identifier rows.
    """
    sighting = F.struct("derived_tstamp", "event_id", "app_id", "created_at")
    values = [
        F.min(
            F.when(
                F.col(i.alias).isNotNull(),
                F.struct("derived_tstamp", "event_id", F.col(i.alias).alias("id_value")),
            )
        )["id_value"].alias(i.alias)
        for i in cfg.identifiers
    ]
    events = extract.has_identity(base)
    seen = events.groupBy("identity_id").agg(F.min(sighting).alias("first"), F.max(sighting).alias("last"), *values)
    return _profile_columns(seen, cfg)


def merge_identities(prev: DataFrame, new: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """Combine the batch's profiles with the stored ones.

    The stored side keeps its first_* only when strictly earlier and its last_*
    only when strictly later; identifier columns take the newest non-null value.
    Only stored rows of identities in the batch take part, and only rows that
    differ from the stored one come out.
    """
    stored = prev.join(new.select("identity_id"), "identity_id", "left_semi").select(
        "identity_id", F.struct(*[c for c in prev.columns if c != "identity_id"]).alias("old")
    )
    joined = new.join(stored, "identity_id", "left")
    old_first = F.col("old.first_derived_tstamp") < F.col("first_derived_tstamp")
    old_last = F.col("old.last_derived_tstamp") > F.col("last_derived_tstamp")

    def keep(when: Column, name: str) -> Column:
        return F.when(when, F.col(f"old.{name}")).otherwise(F.col(name)).alias(name)

    merged = joined.select(
        "old",
        "identity_id",
        keep(old_first, "created_at"),
        keep(old_first, "first_seen_event_id"),
        keep(old_first, "first_app_id"),
        keep(old_last, "last_app_id"),
        *[
            F.coalesce(F.col(a), F.col(f"old.{a}")).alias(a) if a in prev.columns else F.col(a)
            for a in cfg.aliases
        ],
        keep(old_first, "first_derived_tstamp"),
        keep(old_last, "last_derived_tstamp"),
    )
    now = F.struct(*[F.col(c) for c in prev.columns if c != "identity_id"])
    grown = set(merged.columns) - {"old"} != set(prev.columns)  # a new identifier column
    return (merged if grown else merged.where(~F.col("old").eqNullSafe(now))).drop("old")
