"""External identifier lookup."""

from idweave import schemas
from idweave.config import IdentityConfig
from idweave.functions.columns import surrogate_key
from idweave.operators import lookup
from idweave.operators.upsert import delete_where_in, upsert_by_key

CFG = IdentityConfig()
IDS, MAP, LOOKUP = schemas.IDENTIFIERS_THIS_RUN, schemas.ID_MAPPING, schemas.IDENTIFIER_MAPPING
SHOWN = lookup.KEY + [
    "first_app_id", "last_app_id", "first_seen_at", "last_seen_at", "first_seen_event_id",
]


def seen(identity, kind, value, event, first, last=None, app="web", last_app=None):
    return (identity, kind, value, event, app, last_app or app, first, last or first)


def stored(table, *items):
    """Rows (active, value, first, last, event, first app, last app) with their real keys."""
    typed = [("", a, "DUID", v, fa, la, f, la_t, e) for a, v, f, la_t, e, fa, la in items]
    df = table(LOOKUP, typed)
    return df.withColumn("uuid", surrogate_key(*lookup.KEY)) if items else df


def child(identity, parent, when="01 12:00"):
    return (identity, parent, when, when)


def updated(table, rows, have, new, this_run, mapping=None):
    """The table after a run."""
    this_run = table(MAP, this_run)
    mapping = this_run if mapping is None else table(MAP, mapping)
    touched = lookup.affected_stored(have, mapping, this_run, new)
    after = upsert_by_key(have, lookup.identifier_mapping_updates(touched, new), "uuid")
    after = delete_where_in(after, "active_identity_id", this_run.select("identity_id"))
    # dropping the stale keys one by one has to come to the same
    same = upsert_by_key(have, lookup.identifier_mapping_updates(touched, new), "uuid")
    stale = delete_where_in(same, "uuid", lookup.stale_rows(touched))
    assert rows(stale) == rows(after)
    assert after.count() == after.select("uuid").distinct().count()
    return rows(after, *SHOWN)


def test_both_values_resolve_to_the_parent(table, rows):
    ids = table(
        IDS,
        [seen("A", "DUID", "da", "e1", "01 10:00"), seen("B", "DUID", "db", "e2", "01 10:01")],
    )
    got = lookup.identifier_mapping_this_run(ids, table(MAP, [child("B", "A")]), CFG)
    assert rows(got, "active_identity_id", "id_value", "first_seen_event_id") == [
        ("A", "da", "e1"),
        ("A", "db", "e2"),
    ]


def test_one_row_per_type_with_its_own_first_event(table, rows):
    ids = table(
        IDS,
        [
            seen("A", "DUID", "d", "e1", "01 10:00", "01 10:09", last_app="tv"),
            seen("A", "UID", "ann", "e2", "01 10:01", app="tv"),
            seen(None, "UID", "bob", "e3", "01 10:01"),
        ],
    )
    got = lookup.identifier_mapping_this_run(ids, table(MAP, []), CFG)
    assert rows(got, *SHOWN) == [
        ("A", "DUID", "d", "web", "tv", "01 10:00", "01 10:09", "e1"),
        ("A", "UID", "ann", "tv", "tv", "01 10:01", "01 10:01", "e2"),
    ]


def test_shared_value_of_merged_ids_keeps_the_earliest(table, rows):
    ids = table(
        IDS,
        [
            seen("A", "DUID", "d", "e2", "01 10:02", app="ios"),
            seen("B", "DUID", "d", "e1", "01 10:01", app="web"),
        ],
    )
    got = lookup.identifier_mapping_this_run(ids, table(MAP, [child("B", "A")]), CFG)
    assert rows(got, *SHOWN) == [
        ("A", "DUID", "d", "web", "ios", "01 10:01", "01 10:02", "e1")
    ]


def test_hashing(table, rows):
    ids = table(IDS, [seen("A", "UID", " Ann@X.org ", "e1", "01 10:00")])
    cfg = IdentityConfig(hash_identifiers=True)
    (got,) = rows(lookup.identifier_mapping_this_run(ids, table(MAP, []), cfg), "id_value")
    import hashlib

    assert got == (hashlib.sha256(b"ann@x.org").hexdigest(),)


def test_stored_row_follows_the_merge_without_new_events(table, rows):
    have = stored(table, ("B", "db", "01 10:00", "01 10:05", "e2", "web", "web"))
    got = updated(table, rows, have, table(LOOKUP, []), [child("B", "A")])
    assert got == [("A", "DUID", "db", "web", "web", "01 10:00", "01 10:05", "e2")]


def test_merge_together_with_new_events(table, rows):
    have = stored(table, ("B", "db", "01 10:00", "01 10:05", "e2", "web", "web"))
    new = stored(table, ("A", "db", "01 10:00", "02 14:00", "e9", "web", "web"))
    got = updated(table, rows, have, new, [child("B", "A")])
    assert got == [("A", "DUID", "db", "web", "web", "01 10:00", "02 14:00", "e2")]


def test_first_seen_survives_and_last_seen_moves(table, rows):
    have = stored(table, ("A", "d", "01 10:00", "01 10:00", "e1", "web", "web"))
    new = stored(table, ("A", "d", "03 14:00", "03 14:00", "e3", "tv", "tv"))
    assert updated(table, rows, have, new, []) == [
        ("A", "DUID", "d", "web", "tv", "01 10:00", "03 14:00", "e1")
    ]


def test_late_event_takes_over_the_first_sighting(table, rows):
    have = stored(table, ("A", "d", "02 10:00", "02 10:00", "e1", "web", "web"))
    new = stored(table, ("A", "d", "02 09:50", "02 09:50", "e0", "tv", "tv"))
    assert updated(table, rows, have, new, []) == [
        ("A", "DUID", "d", "tv", "web", "02 09:50", "02 10:00", "e0")
    ]


def test_children_sharing_a_value_fold_into_the_parent_row(table, rows):
    have = stored(
        table,
        ("A", "d", "02 10:00", "02 10:00", "ea", "web", "web"),
        ("B", "d", "01 10:00", "01 10:00", "eb", "ios", "ios"),
        ("C", "d", "03 10:00", "03 10:00", "ec", "tv", "tv"),
        ("Z", "d", "01 01:00", "09 10:00", "ez", "web", "web"),
    )
    got = updated(table, rows, have, table(LOOKUP, []), [child("B", "A"), child("C", "A")])
    assert got == [
        ("A", "DUID", "d", "ios", "tv", "01 10:00", "03 10:00", "eb"),
        ("Z", "DUID", "d", "web", "web", "01 01:00", "09 10:00", "ez"),
    ]


def test_untouched_rows_are_not_rewritten(table, rows):
    have = stored(
        table,
        ("A", "d1", "01 10:00", "01 10:00", "e1", "web", "web"),
        ("A", "d2", "01 10:00", "01 10:00", "e2", "web", "web"),
    )
    new = stored(table, ("A", "d1", "02 10:00", "02 10:00", "e3", "web", "web"))
    this_run = table(MAP, [])
    touched = lookup.affected_stored(have, this_run, this_run, new)
    got = lookup.identifier_mapping_updates(touched, new)
    assert rows(got, "id_value") == [("d1",)]


def test_repoint_and_history_steps(table, rows):
    have = stored(
        table,
        ("B", "db", "01 10:00", "01 10:00", "e1", "web", "web"),
        ("B", "dx", "01 10:00", "01 10:00", "e2", "web", "web"),
        ("Q", "db", "01 10:00", "01 10:00", "e3", "web", "web"),
    )
    this_run = table(MAP, [child("B", "A")])
    new = stored(table, ("A", "db", "02 10:00", "02 10:00", "e9", "tv", "tv"))
    moved = lookup.repoint_identifiers(have, this_run, this_run, new)
    assert rows(moved, "active_identity_id", "id_value") == [("A", "dx")]
    known = lookup.resolve_history(have, this_run, new, this_run)
    assert rows(known, "active_identity_id", "id_value") == [("A", "db")]
    folded = lookup.fold_history(new, known)
    assert rows(folded, *SHOWN) == [
        ("A", "DUID", "db", "web", "tv", "01 10:00", "02 10:00", "e1")
    ]
