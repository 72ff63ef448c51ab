"""User-facing configuration."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class Identifier:
    """One external identifier: a SQL expression over the events and its column name."""

    expression: str
    alias: str

    @property
    def id_type(self) -> str:
        return self.alias.upper()


DEFAULT_IDENTIFIERS = (
    Identifier("domain_userid", "domain_userid"),
    Identifier("user_id", "user_id"),
)


# names an identifier cannot take, since its column sits next to these
RESERVED = {
    "IDENTITY_ID",
    "EVENT_ID",
    "EVENT_NAME",
    "APP_ID",
    "CREATED_AT",
    "DERIVED_TSTAMP",
    "COLLECTOR_TSTAMP",
    "LOAD_TSTAMP",
    "__PROFILE__",
}


@dataclass(frozen=True)
class IdentityConfig:
    """Everything a run can be told. Every field has a working default."""

    # what to read
    identifiers: tuple[Identifier, ...] = DEFAULT_IDENTIFIERS
    app_ids: tuple[str, ...] = ()
    event_names: tuple[str, ...] = ()
    merge_event_name: str = "identity_merge"
    context_column: str = "identity_context"
    context_id_field: str = "identity_id"
    payload_column: str = "identity_merge"
    payload_id_field: str = "identity_id"
    # column holding the load date when the events table is partitioned by it
    load_date_column: str | None = None
    # set only when the source already guarantees one row per event_id
    events_are_unique: bool = False

    # which window to process
    start_date: datetime = datetime(2026, 1, 1)
    backfill_limit_days: int = 30

    # full rebuilds
    allow_refresh: bool = False
    environment: str = "prod"
    dev_environment: str = "dev"

    # output
    hash_identifiers: bool = False

    # behaviour switches, see README "Choices"
    suppress_reemission: bool = True
    compress_orphans: bool = False
    only_newer: bool = False
    replace_affected: bool = False
    close_roots: bool = False

    def __post_init__(self) -> None:
        aliases = [i.alias.upper() for i in self.identifiers]
        if not aliases or len(set(aliases)) != len(aliases):
            raise ValueError("identifiers need at least one entry and distinct aliases")
        clash = sorted(set(aliases) & RESERVED)
        if clash:
            raise ValueError(f"identifier aliases clash with table columns: {clash}")
        if self.backfill_limit_days <= 0:
            raise ValueError("backfill_limit_days must be positive")

    @property
    def aliases(self) -> list[str]:
        return [i.alias for i in self.identifiers]


@dataclass(frozen=True)
class RunContext:
    """One run: arrival window and the processing time stamped on its rows."""

    lower: datetime
    upper: datetime
    run_tstamp: datetime
    lower_inclusive: bool = True
