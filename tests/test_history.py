"""SCD history, lookups as of a time, and quality checks."""

import random
from datetime import datetime, timedelta

from idweave import schemas
from idweave.operators import history, quality
from idweave.operators.upsert import upsert_by_key
from tests.conftest import at

LOG, MAP, SCD = schemas.ID_CHANGES, schemas.ID_MAPPING, schemas.ID_MAPPING_SCD
SHOWN = ["identity_id", "active_identity_id", "effective_at", "superseded_at", "is_current"]


def created(identity, when):
    return ("k", identity, None, when, "09 00:00", "created", "e", "web")


def merged(parent, child, when):
    return ("k", parent, child, when, "09 00:00", "merged", "e", "web")


def run(table, changes, mapping=(), prev=None):
    """(rows written, table after the run)."""
    changes = table(LOG, changes)
    this_run = table(MAP, [(c, p, w, "09 00:00") for c, p, w in mapping])
    prev = table(SCD, []) if prev is None else prev
    known = history.scd_history(prev, history.ids_affected(changes))
    updates = history.scd_updates(known, changes, this_run)
    return updates, upsert_by_key(prev, updates, "scd_key")


def test_created_only(table, rows):
    updates, _ = run(table, [created("A", "01 10:00")])
    assert rows(updates, *SHOWN) == [("A", "A", "01 10:00", None, True)]


def test_created_then_merged(table, rows):
    updates, _ = run(
        table,
        [created("A", "01 10:00"), created("B", "01 10:01"), merged("B", "A", "01 10:02")],
        [("A", "B", "01 10:02")],
    )
    assert rows(updates, *SHOWN) == [
        ("A", "A", "01 10:00", "01 10:02", False),
        ("A", "B", "01 10:02", None, True),
        ("B", "B", "01 10:01", None, True),
    ]


def test_merge_in_a_later_batch_closes_the_stored_row(table, rows):
    _, first = run(table, [created("A", "01 10:00"), created("B", "01 10:01")])
    updates, after = run(table, [merged("B", "A", "03 10:02")], [("A", "B", "03 10:02")], first)
    assert rows(after, *SHOWN) == [
        ("A", "A", "01 10:00", "03 10:02", False),
        ("A", "B", "03 10:02", None, True),
        ("B", "B", "01 10:01", None, True),
    ]


def test_new_identity_merged_into_a_stored_one(table, rows):
    _, first = run(table, [created("B", "01 10:01")])
    _, after = run(
        table, [created("A", "01 10:00"), merged("B", "A", "01 10:02")], [("A", "B", "01 10:02")], first
    )
    assert rows(after, *SHOWN) == [
        ("A", "A", "01 10:00", "01 10:02", False),
        ("A", "B", "01 10:02", None, True),
        ("B", "B", "01 10:01", None, True),
    ]


def test_repeated_creation_adds_nothing(table, rows):
    _, first = run(table, [created("A", "01 10:00")])
    _, again = run(table, [created("A", "01 10:00")], prev=first)
    assert rows(again, *SHOWN) == [("A", "A", "01 10:00", None, True)]


def test_later_sighting_keeps_the_first_and_earlier_one_backdates(table, rows):
    _, first = run(table, [created("A", "01 10:00")])
    _, later = run(table, [created("A", "01 10:30")], prev=first)
    assert rows(later, *SHOWN) == [("A", "A", "01 10:00", None, True)]
    _, earlier = run(table, [created("A", "01 09:00")], prev=later)
    assert rows(earlier, *SHOWN) == [("A", "A", "01 09:00", None, True)]


CHAIN_TAIL = [merged("C", "A", "01 10:10"), merged("C", "B", "01 10:10")]
CHAIN_MAP = [("A", "C", "01 10:05"), ("B", "C", "01 10:10")]
CHAIN_ROWS = [
    ("A", "A", "01 10:00", "01 10:05", False),
    ("A", "B", "01 10:05", "01 10:10", False),
    ("A", "C", "01 10:10", None, True),
    ("B", "B", "01 10:01", "01 10:10", False),
    ("B", "C", "01 10:10", None, True),
    ("C", "C", "01 10:02", None, True),
]


def test_chain_in_one_batch_and_across_batches(table, rows):
    people = [created("A", "01 10:00"), created("B", "01 10:01"), created("C", "01 10:02")]
    step = merged("B", "A", "01 10:05")
    updates, _ = run(table, [*people, step, *CHAIN_TAIL], CHAIN_MAP)
    assert rows(updates, *SHOWN) == CHAIN_ROWS
    _, first = run(table, [*people, step], [("A", "B", "01 10:05")])
    _, after = run(table, CHAIN_TAIL, CHAIN_MAP, first)
    assert rows(after, *SHOWN) == CHAIN_ROWS


def test_merge_dated_before_the_creation(table, rows):
    updates, _ = run(
        table, [created("A", "01 10:05"), merged("B", "A", "01 10:00")], [("A", "B", "01 10:00")]
    )
    assert rows(updates, *SHOWN) == [
        ("A", "A", "01 10:05", None, True),
        ("A", "B", "01 10:00", "01 10:05", False),
    ]


def test_tie_leaves_the_mapped_parent_current(table, rows):
    updates, _ = run(
        table, [created("A", "01 10:00"), merged("B", "A", "01 10:00")], [("A", "B", "01 10:00")]
    )
    assert rows(updates, *SHOWN) == [
        ("A", "A", "01 10:00", "01 10:00", False),
        ("A", "B", "01 10:00", None, True),
    ]


def test_successor_is_found_across_days(table, rows):
    """Many rows per id spread unevenly over days, against a plain walk through them."""
    rng = random.Random(3)
    log = []
    for i in range(12):
        times = sorted(rng.sample(range(0, 60 * 24 * 6, 7), rng.randint(1, 25)))
        for n, minute in enumerate(times):
            log.append(("k", f"P{n}", f"id{i}", datetime(2024, 6, 1) + timedelta(minutes=minute)))
    changes = table(
        LOG, [(k, p, c, t, datetime(2024, 6, 9), "merged", "e", "web") for k, p, c, t in log]
    )
    updates = history.scd_updates(
        history.scd_new_records(changes.limit(0)), changes, table(MAP, [])
    )
    got = {(r.identity_id, r.effective_at): r.superseded_at for r in updates.collect()}
    want = {}
    for i in range(12):
        mine = sorted(t for _, _, c, t in log if c == f"id{i}")
        want.update({(f"id{i}", t): nxt for t, nxt in zip(mine, [*mine[1:], None])})
    assert got == want


FACTS = schemas._struct(fact=schemas.STR, identity_id=schemas.STR, ts=schemas.TS)


def test_point_in_time(table, rows):
    _, scd = run(
        table,
        [created("A", "01 10:00"), created("B", "01 09:00"), merged("B", "A", "03 10:02")],
        [("A", "B", "03 10:02")],
    )
    facts = table(
        FACTS,
        [
            ("too early", "A", "01 09:59"),
            ("exactly at creation", "A", "01 10:00"),
            ("days later", "A", "02 23:00"),
            ("just before", "A", "03 10:01"),
            ("at the merge", "A", "03 10:02"),
            ("much later", "A", "08 00:00"),
            ("unknown", "Z", "03 10:02"),
        ],
    )
    want = [
        ("at the merge", "B"),
        ("days later", "A"),
        ("exactly at creation", "A"),
        ("just before", "A"),
        ("much later", "B"),
    ]
    got = history.active_as_of(facts, scd, "ts")
    assert rows(got, "fact", "active_identity_id") == want
    fixed = history.active_at(facts, scd, at("03 00:00"))
    assert {r.active_identity_id for r in fixed.collect()} == {"A"}


def test_point_in_time_equals_the_range_join(spark, table, rows):
    rng = random.Random(5)
    start = datetime(2024, 6, 1)
    spans = []
    for i in range(6):
        marks = sorted(rng.sample(range(60 * 24 * 8), 9))
        for n, (a, b) in enumerate(zip(marks, [*marks[1:], None])):
            end = None if b is None else start + timedelta(minutes=b)
            spans.append((f"s{i}{n}", f"id{i}", f"P{n}", start + timedelta(minutes=a), end, "merged", b is None))
    scd = table(SCD, spans)
    asked = [
        (f"f{n}", f"id{rng.randint(0, 6)}", start + timedelta(minutes=rng.randint(0, 60 * 24 * 9)))
        for n in range(400)
    ]
    facts = table(FACTS, asked)
    want = sorted(
        (f, p)
        for f, i, t in asked
        for _, j, p, a, b, _, _ in spans
        if i == j and a <= t and (b is None or t < b)
    )
    got = history.active_as_of(facts, scd, "ts")
    assert rows(got, "fact", "active_identity_id") == want


def test_quality_checks(table, rows):
    df = table(FACTS, [("a", "A", "01 10:00"), ("a", None, "01 10:00"), ("b", None, "01 10:00")])
    assert rows(quality.check_not_null(df, ["identity_id"]), "fact") == [("a",), ("b",)]
    assert rows(quality.check_unique(df, ["fact"])) == [("a", 2)]
    assert rows(quality.check_unique(df, ["identity_id"])) == []
    assert rows(quality.check_unique_combination(df, ["identity_id", "ts"])) == [(None, "01 10:00", 2)]
    other = table(FACTS, [("a", "A", "01 10:00"), ("a", "A", "01 10:00"), ("b", None, "01 10:00")])
    assert rows(quality.diff_tables(df, other), "fact", "identity_id", "side", "copies") == [
        ("a", "A", "right", 1),
        ("a", None, "left", 1),
    ]
    assert rows(quality.diff_tables(df, df)) == []
