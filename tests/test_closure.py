"""Chains closed to their roots: long ones, cycles, and chains that grow over batches."""

import random

import pytest

from idweave import schemas
from idweave.config import IdentityConfig, RunContext
from idweave.operators import mapping, quality
from idweave.plans import runs
from idweave.plans.scratch import scratch_dir
from tests.conftest import at
from tests.test_extract import BASE, merge, page
from tests.test_runs import NOW, new_store

RUN = RunContext(at("01 00:00"), at("02 00:00"), at("09 12:00"))
POINTERS = schemas._struct(identity_id=schemas.STR, active_identity_id=schemas.STR)


@pytest.fixture
def written(spark):
    root, seen = scratch_dir(spark, "closure"), []

    def write(name, df):
        seen.append(name)
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    write.seen = seen
    return write


def plain(pointers):
    out = {}
    for start in pointers:
        seen, x = [], start
        while x in pointers and x not in seen:
            seen.append(x)
            x = pointers[x]
        root = min(seen[seen.index(x) :]) if x in seen else x
        if root != start:
            out[start] = root
    return sorted(out.items())


def test_a_long_chain_takes_few_rounds(table, rows, written):
    n = 700
    chain = {f"n{i:04}": f"n{i + 1:04}" for i in range(n)}
    got = mapping.close_to_roots(table(POINTERS, list(chain.items())), written)
    assert rows(got) == [(c, f"n{n:04}") for c in sorted(chain)]
    assert len(written.seen) <= 12


@pytest.mark.parametrize("seed", range(3))
def test_random_pointers_with_cycles(table, rows, written, seed):
    rng = random.Random(seed)
    names = [f"n{i:02}" for i in range(60)]
    pointers = {a: rng.choice(names) for a in rng.sample(names, 50)}
    pointers = {a: b for a, b in pointers.items() if a != b}
    got = mapping.close_to_roots(table(POINTERS, list(pointers.items())), written)
    assert rows(got) == plain(pointers)


def test_nulls_self_pointers_and_nothing(table, rows, written):
    odd = [("a", "a"), (None, "b"), ("c", None), ("d", "e")]
    assert rows(mapping.close_to_roots(table(POINTERS, odd), written)) == [("d", "e")]
    assert rows(mapping.close_to_roots(table(POINTERS, []), written)) == []


def test_goes_on_through_stored_parents(table, rows, written):
    edges = table(schemas.EDGES, [("P", "c", "01 10:00", "m1"), ("Q", "c", "01 09:00", "m0"), ("S", "T", "01 11:00", "m2")])
    stored = table(schemas.ID_MAPPING, [("P", "R", "01 01:00", "01 02:00"), ("T", "U", "01 01:00", "01 02:00")])
    got = mapping.closed_mapping_this_run(edges, stored, RUN, written)
    # T has a parent in the batch, so its stored one no longer counts
    assert rows(got, "identity_id", "active_identity_id", "merged_at") == [("T", "S", "01 11:00"), ("c", "R", "01 10:00")]


EVENTS = [
    page("e1", "web", "da", None, "01 10:00", "A"),
    merge("m1", "B", "01 11:00", ("A", "01 11:00", "m1")),
    # later payloads list only the newest child
    merge("m2", "C", "02 11:00", ("B", "02 11:00", "m2")),
    page("e2", "web", "da", None, "03 10:00", "A"),
    merge("m3", "D", "03 11:00", ("C", "03 11:00", "m3")),
    # an id absorbed by one that was absorbed before
    merge("m4", "A", "04 11:00", ("Z", "04 11:00", "m4")),
]


def final(spark, table, events, **options):
    store = new_store(spark)
    cfg = IdentityConfig(start_date=at("01 00:00"), backfill_limit_days=1, **options)
    runs.catch_up(store, cfg, table(BASE, events), NOW)
    return store


def test_chains_that_are_not_cumulative_grow_over_batches(spark, table, rows):
    plain_rule = final(spark, table, EVENTS).read("id_mapping")
    assert rows(plain_rule, "identity_id", "active_identity_id") == [("A", "B"), ("B", "C"), ("C", "D"), ("Z", "A")]
    store = final(spark, table, EVENTS, close_roots=True)
    got = rows(store.read("id_mapping"), "identity_id", "active_identity_id")
    assert got == [("A", "D"), ("B", "D"), ("C", "D"), ("Z", "D")]
    assert quality.check_no_stale_roots(store.read("identifier_mapping"), store.read("id_mapping")).count() == 0
    assert rows(store.read("identifier_mapping"), "active_identity_id") == [("D",)]


def test_a_cycle_over_batches_has_one_root(spark, table, rows):
    events = [
        merge("m1", "B", "01 11:00", ("A", "01 11:00", "m1")),
        merge("m2", "A", "02 11:00", ("B", "02 11:00", "m2")),
        merge("m3", "B", "03 11:00", ("C", "03 11:00", "m3")),
    ]
    store = final(spark, table, events, close_roots=True)
    assert rows(store.read("id_mapping"), "identity_id", "active_identity_id") == [("B", "A"), ("C", "A")]
