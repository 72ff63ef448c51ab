"""Mapping and audit log."""

from idweave import schemas
from idweave.config import IdentityConfig, RunContext
from idweave.operators import changes, upsert, mapping
from idweave.operators.upsert import upsert_by_key
from tests.conftest import at

CFG = IdentityConfig()
RUN = RunContext(at("01 00:00"), at("02 00:00"), at("09 12:00"))
IDY = schemas.identities(CFG)
MAP, EDGES, LOG = schemas.ID_MAPPING, schemas.EDGES, schemas.ID_CHANGES


def person(name, app, when, event="e"):
    return (name, when, event, app, app, f"d{name}", None, when, when)


def log(table, rows, edges, seen=(), stored=None, affected=(), pre=None):
    """Change rows of one batch without keys and processing times."""
    edges = table(EDGES, edges)
    people = table(IDY, list(seen))
    everyone = table(IDY, list(stored)) if stored is not None else people
    out = changes.id_changes_this_run(
        edges,
        mapping.id_mapping_this_run(edges, RUN),
        table(MAP, list(affected)),
        people,
        everyone,
        RUN,
        None if pre is None else table(MAP, list(pre)),
    )
    return rows(
        out, "identity_id", "previous_identity_id", "effective_at", "first_seen_event_id",
        "first_seen_app_id",
    )


def merged_only(got):
    return [r for r in got if r[1] is not None]


# A into B at 10:05, B into C at 10:10, payloads cumulative
CHAIN = [
    ("B", "A", "01 10:05", "m1"),
    ("C", "A", "01 10:05", "m1"),
    ("C", "B", "01 10:10", "m2"),
]


def test_mapping_of_one_merge(table, rows):
    got = mapping.id_mapping_this_run(table(EDGES, [("A", "B", "01 10:00", "m")]), RUN)
    assert rows(got) == [("B", "A", "01 10:00", "09 12:00")]


def test_mapping_goes_to_the_root_and_takes_the_latest(table, rows):
    got = mapping.id_mapping_this_run(table(EDGES, CHAIN), RUN)
    assert rows(got, "identity_id", "active_identity_id") == [("A", "C"), ("B", "C")]
    two = [("P", "X", "01 10:00", "m1"), ("Q", "X", "01 11:00", "m2")]
    got = mapping.id_mapping_this_run(table(EDGES, two), RUN)
    assert rows(got, "identity_id", "active_identity_id") == [("X", "Q")]


def test_cut_chain_and_cycle_leave_ids_unmapped(table, rows):
    cut = table(EDGES, [("B", "A", "01 10:05", "m1"), ("C", "B", "01 10:10", "m2")])
    this_run = mapping.id_mapping_this_run(cut, RUN)
    assert rows(this_run, "identity_id", "active_identity_id") == [("B", "C")]
    assert rows(mapping.cyclic_ids(cut, this_run)) == [("A",)]
    loop = table(EDGES, [("A", "B", "01 10:00", "m1"), ("B", "A", "01 10:01", "m2")])
    this_run = mapping.id_mapping_this_run(loop, RUN)
    assert rows(this_run) == []
    assert rows(mapping.cyclic_ids(loop, this_run)) == [("A",), ("B",)]


def test_null_child_does_not_empty_the_result(table, rows):
    edges = table(EDGES, [("A", "B", "01 10:00", "m"), ("A", None, "01 10:00", "m")])
    assert rows(mapping.true_parents(edges)) == [("A",)]
    got = mapping.id_mapping_this_run(edges, RUN)
    assert ("B", "A", "01 10:00", "09 12:00") in rows(got)


def test_remap_overwrites_and_snapshot_sees_the_old_parent(table, rows):
    prev = table(MAP, [("B", "A", "01 10:00", "01 12:00"), ("X", "Y", "01 10:00", "01 12:00")])
    new = table(MAP, [("B", "C", "02 10:00", "02 12:00"), ("A", "C", "02 10:00", "02 12:00")])
    assert rows(mapping.snapshot_affected(prev, new), "identity_id", "active_identity_id") == [("B", "A")]
    got = upsert_by_key(prev, new, "identity_id")
    assert rows(got, "identity_id", "active_identity_id") == [("A", "C"), ("B", "C"), ("X", "Y")]


def test_mapping_options(table, rows):
    prev = table(MAP, [("A", "B", "02 10:00", "02 12:00"), ("Z", "Q", "02 10:00", "02 12:00")])
    new = table(MAP, [("B", "C", "03 10:00", "03 12:00"), ("Z", "P", "01 10:00", "03 12:00")])
    affected = mapping.snapshot_affected(prev, new)
    plain = mapping.mapping_updates(prev, new, affected)
    assert rows(plain, "identity_id", "active_identity_id") == [("B", "C"), ("Z", "P")]
    newer = mapping.mapping_updates(prev, new, affected, only_newer=True)
    assert rows(newer, "identity_id", "active_identity_id") == [("B", "C")]
    moved = mapping.mapping_updates(prev, new, affected, compress_orphans=True)
    assert rows(moved, "identity_id", "active_identity_id") == [("A", "C"), ("B", "C"), ("Z", "P")]


def test_created_and_merged(table, rows):
    got = log(
        table, rows, [("A", "B", "01 10:02", "m")],
        [person("A", "web", "01 10:00", "e1"), person("B", "ios", "01 10:01", "e2")],
    )
    assert got == [
        ("A", "B", "01 10:02", "m", "ios"),
        ("A", None, "01 10:00", "e1", "web"),
        ("B", None, "01 10:01", "e2", "ios"),
    ]


def test_app_of_an_identity_from_an_earlier_run(table, rows):
    got = log(
        table, rows, [("B", "A", "01 10:02", "m")],
        seen=[person("B", "ios", "01 10:01")],
        stored=[person("A", "web", "01 08:00"), person("B", "ios", "01 10:01")],
    )
    assert merged_only(got) == [("B", "A", "01 10:02", "m", "web")]


def test_chain_in_one_batch(table, rows):
    people = [person(p, "web", "01 10:00") for p in "ABC"]
    assert merged_only(log(table, rows, CHAIN, people)) == [
        ("B", "A", "01 10:05", "m1", "web"),
        ("C", "A", "01 10:10", "m1", "web"),
        ("C", "B", "01 10:10", "m2", "web"),
    ]


def test_chain_across_batches(table, rows):
    people = [person(p, "web", "01 10:00") for p in "AB"]
    got = log(
        table, rows, CHAIN[1:], stored=people,
        affected=[("A", "B", "01 10:05", "01 10:08")], pre=[("A", "B", "01 10:05", "01 10:08")],
    )
    assert got == [
        ("C", "A", "01 10:10", "m1", "web"),
        ("C", "B", "01 10:10", "m2", "web"),
    ]


def test_independent_merges_keep_their_times(table, rows):
    people = [person(p, "web", "01 10:00") for p in "ABC"]
    edges = [("C", "A", "01 10:05", "m1"), ("C", "B", "01 10:10", "m2")]
    assert merged_only(log(table, rows, edges, people)) == [
        ("C", "A", "01 10:05", "m1", "web"),
        ("C", "B", "01 10:10", "m2", "web"),
    ]


def test_orphan_follows_its_parent(table, rows):
    people = [person(p, "web", "01 10:00") for p in "AB"]
    got = log(
        table, rows, [("C", "B", "01 10:10", "m2")], stored=people,
        affected=[("A", "B", "01 10:05", "01 10:08")],
    )
    assert got == [
        ("C", "A", "01 10:10", "m2", "web"),
        ("C", "B", "01 10:10", "m2", "web"),
    ]


def test_reemitted_edge_is_not_logged_again(table, rows):
    """C absorbed A (through B) before; now it absorbs D and the payload lists all again."""
    edges = [*CHAIN[1:], ("C", "D", "01 11:00", "m3")]
    before = [("A", "C", "01 10:05", "01 10:30"), ("B", "C", "01 10:10", "01 10:30")]
    assert log(table, rows, edges, pre=before) == [("C", "D", "01 11:00", "m3", None)]
    # without the guard A falls back to its first merge time
    assert ("C", "A", "01 10:05", "m1", None) in log(table, rows, edges)


def test_same_pair_at_two_times_gives_one_row(table, rows):
    edges = [("C", "A", "01 10:05", "m1"), ("C", "A", "01 10:09", "m2")]
    assert log(table, rows, edges) == [("C", "A", "01 10:05", "m1", None)]


def test_log_without_stored_match(table, rows):
    stored = table(LOG, [("ka", "A", None, "01 10:00", "01 12:00", "created", "e1", "web")])
    new = table(LOG, [("kb", "B", None, "01 10:01", "01 13:00", "created", "e2", "web")])
    assert rows(changes.merge_id_changes(stored, new)) == rows(new)
    assert rows(changes.merge_id_changes(stored.limit(0), stored)) == rows(stored)


def test_late_change_moves_the_log_back(table, rows):
    stored = table(LOG, [("ka", "A", None, "01 10:00", "01 12:00", "created", "e1", "web")])
    late = table(LOG, [("ka", "A", None, "01 09:50", "01 13:00", "created", "e0", "ios")])
    got = changes.merge_id_changes(stored, late)
    assert rows(got) == [("ka", "A", None, "01 09:50", "01 12:00", "created", "e0", "ios")]
    same = table(LOG, [("ka", "A", None, "01 10:00", "01 13:00", "created", "e9", "tv")])
    got = changes.merge_id_changes(stored, same)
    # at equal times the stored row stays as it is, so there is nothing to write
    assert rows(got) == []
    kept = upsert.upsert_by_key(stored, got, "id_change_key")
    assert rows(kept, "first_seen_event_id", "changed_at") == [("e1", "01 12:00")]
