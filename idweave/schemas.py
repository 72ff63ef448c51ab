"""Column layout of every table, one StructType each."""

from __future__ import annotations

from pyspark.sql import types as T

from idweave.config import IdentityConfig

STR, TS, BOOL = T.StringType(), T.TimestampNTZType(), T.BooleanType()


def _struct(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in cols.items()])


MERGED_CHILD = _struct(identity_id=STR, created_at=TS, merged_at=TS, triggering_event_id=STR)
IDENTITY_CONTEXT = T.ArrayType(_struct(identity_id=STR, created_at=TS))
MERGE_PAYLOAD = _struct(
    identity_id=STR, merged=T.ArrayType(MERGED_CHILD), merges=T.ArrayType(STR)
)

MANIFEST = _struct(model=STR, first_success=TS, last_success=TS)

MERGE_EVENTS = _struct(
    merge_event_id=STR,
    active_identity_id=STR,
    collector_tstamp=TS,
    derived_tstamp=TS,
    merged=T.ArrayType(MERGED_CHILD),
    merges=T.ArrayType(STR),
)

EDGES = _struct(active_identity_id=STR, identity_id=STR, merged_at=TS, triggering_event_id=STR)

ID_MAPPING = _struct(identity_id=STR, active_identity_id=STR, merged_at=TS, model_tstamp=TS)

ID_CHANGES = _struct(
    id_change_key=STR,
    identity_id=STR,
    previous_identity_id=STR,
    effective_at=TS,
    changed_at=TS,
    change_type=STR,
    first_seen_event_id=STR,
    first_seen_app_id=STR,
)

IDENTIFIERS_THIS_RUN = _struct(
    identity_id=STR,
    id_type=STR,
    id_value=STR,
    first_seen_event_id=STR,
    first_app_id=STR,
    last_app_id=STR,
    first_derived_tstamp=TS,
    last_derived_tstamp=TS,
)

IDENTIFIER_MAPPING = _struct(
    uuid=STR,
    active_identity_id=STR,
    id_type=STR,
    id_value=STR,
    first_app_id=STR,
    last_app_id=STR,
    first_seen_at=TS,
    last_seen_at=TS,
    first_seen_event_id=STR,
)

ID_MAPPING_SCD = _struct(
    scd_key=STR,
    identity_id=STR,
    active_identity_id=STR,
    effective_at=TS,
    superseded_at=TS,
    change_type=STR,
    is_current=BOOL,
)


def identities(cfg: IdentityConfig) -> T.StructType:
    """Profile table; one column per configured identifier."""
    return T.StructType(
        [
            T.StructField("identity_id", STR),
            T.StructField("created_at", TS),
            T.StructField("first_seen_event_id", STR),
            T.StructField("first_app_id", STR),
            T.StructField("last_app_id", STR),
            *[T.StructField(alias, STR) for alias in cfg.aliases],
            T.StructField("first_derived_tstamp", TS),
            T.StructField("last_derived_tstamp", TS),
        ]
    )


def tables(cfg: IdentityConfig) -> dict[str, T.StructType]:
    """The six maintained tables."""
    return {
        "merge_events": MERGE_EVENTS,
        "identities": identities(cfg),
        "id_mapping": ID_MAPPING,
        "id_changes": ID_CHANGES,
        "identifier_mapping": IDENTIFIER_MAPPING,
        "id_mapping_scd": ID_MAPPING_SCD,
    }


KEYS = {
    "merge_events": "merge_event_id",
    "identities": "identity_id",
    "id_mapping": "identity_id",
    "id_changes": "id_change_key",
    "identifier_mapping": "uuid",
    "id_mapping_scd": "scd_key",
}
