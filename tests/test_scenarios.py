"""Stories over four arrival days, run as one full and three incremental batches.

A story is a list of lines. ``page`` lines are sightings, ``merge`` lines are what
the upstream service emits: the parent with everything it has absorbed so far.
Day n is loaded by batch n; the time of an event may lie on an earlier day.
"""

from datetime import timedelta

import pytest

from idweave import schemas
from idweave.config import Identifier, IdentityConfig, RunContext
from idweave.operators import quality
from idweave.plans import runs
from idweave.plans.scratch import scratch_tables
from tests.conftest import at
from tests.test_extract import BASE

CFG = IdentityConfig(
    identifiers=(
        Identifier("domain_userid", "domain_userid"),
        Identifier("user_id", "user_id"),
        Identifier("network_userid", "network_userid"),
    ),
    start_date=at("01 00:00"),
    backfill_limit_days=1,
)
RAW = schemas.T.StructType([*BASE.fields, schemas.T.StructField("network_userid", schemas.STR)])


class Story:
    """Collects the raw events of one scenario; ids and values carry its name."""

    def __init__(self, name):
        self.name, self.events, self.n = name, [], 0

    def id(self, letter):
        return f"{self.name}.{letter}"

    def page(self, day, who, clock, d=None, u=None, n=None, app="web", when=None):
        """``who`` seen on ``day``; identifiers default to a cookie of its own."""
        self.n += 1
        time = at(when or f"0{day} {clock}")
        values = [f"{self.name}.{v}" if v else None for v in (d or f"d{who}", u, n)]
        context = [(self.id(who), at("01 00:00"))]
        self.events.append(
            (f"{self.name}-e{self.n:02}", "page_view", app, values[0], values[1],
             time + timedelta(seconds=1), time, at(f"0{day} 12:00"), context, None, values[2])
        )
        return self

    def merge(self, day, parent, **absorbed):
        """``parent`` has absorbed each letter at 'DD HH:MM'."""
        self.n += 1
        last = max(absorbed.values())
        children = [
            (self.id(c), at("01 00:00"), at(t), f"{self.name}-{t}") for c, t in absorbed.items()
        ]
        self.events.append(
            (f"{self.name}-m{self.n:02}", "identity_merge", "web", None, None, at(last), at(last),
             at(f"0{day} 12:30"), None,
             (self.id(parent), children, [c[0] for c in children]), None)
        )
        return self


def people(story, day, letters, first="01:00"):
    hour = int(first[:2])
    for i, letter in enumerate(letters):
        story.page(day, letter, f"{hour:02}:{i:02}")
    return story


def stories():
    """{name: (events, final mapping, {child: history of parents})}"""
    out = {}

    def add(story, mapping, **paths):
        out[story.name] = (story.events, mapping, paths)

    s = people(Story("simple"), 1, "AB").merge(1, "A", B="01 02:00").page(4, "A", "09:00")
    add(s, {"B": "A"}, B=[("B", "01 01:01"), ("A", "01 02:00")])

    s = people(Story("chain"), 1, "AB").merge(1, "A", B="01 02:00")
    s.page(2, "C", "01:00").page(2, "B", "02:00").merge(2, "A", B="01 02:00", C="02 03:00")
    s.page(3, "A", "01:00")
    add(s, {"B": "A", "C": "A"}, B=[("B", "01 01:01"), ("A", "01 02:00")])

    s = people(Story("fanin"), 1, "ABC").merge(1, "A", B="01 02:00")
    s.merge(1, "A", B="01 02:00", C="01 03:00").page(2, "D", "01:00")
    s.merge(2, "A", B="01 02:00", C="01 03:00", D="02 02:00")
    add(s, {"B": "A", "C": "A", "D": "A"}, C=[("C", "01 01:02"), ("A", "01 03:00")])

    s = people(Story("fanout"), 1, "AX").merge(1, "A", X="01 02:00")
    people(s, 2, "BC").merge(2, "A", X="01 02:00", B="02 02:00")
    s.merge(2, "A", X="01 02:00", B="02 02:00", C="02 03:00")
    add(s, {"X": "A", "B": "A", "C": "A"})

    s = people(Story("diamond"), 1, "ABCD").merge(1, "A", B="01 02:00")
    s.merge(1, "A", B="01 02:00", C="01 02:10")
    s.merge(1, "A", B="01 02:00", C="01 02:10", D="01 02:20").page(2, "E", "01:00")
    s.merge(2, "A", B="01 02:00", C="01 02:10", D="01 02:20", E="02 02:00")
    add(s, {c: "A" for c in "BCDE"})

    s = people(Story("disjoint"), 1, "ABCD").merge(1, "A", B="01 02:00").merge(1, "C", D="01 02:00")
    people(s, 2, "EF").merge(2, "E", F="02 02:00")
    add(s, {"B": "A", "D": "C", "F": "E"})

    s = people(Story("longchain"), 1, "ABCD").merge(1, "C", D="01 02:00")
    s.merge(1, "B", D="01 02:00", C="01 03:00")
    s.merge(1, "A", D="01 02:00", C="01 03:00", B="01 04:00")
    add(
        s,
        {"B": "A", "C": "A", "D": "A"},
        C=[("C", "01 01:02"), ("B", "01 03:00"), ("A", "01 04:00")],
        B=[("B", "01 01:01"), ("A", "01 04:00")],
    )

    s = people(Story("altchain"), 1, "ABCDEF")
    s.merge(1, "A", B="01 02:00").merge(1, "C", D="01 02:00").merge(1, "E", F="01 02:00")
    s.page(2, "X", "01:00").merge(2, "A", B="01 02:00", C="02 02:00", D="01 02:00")
    s.merge(2, "A", B="01 02:00", C="02 02:00", D="01 02:00", E="02 03:00", F="01 02:00")
    s.merge(2, "A", B="01 02:00", C="02 02:00", D="01 02:00", E="02 03:00", F="01 02:00", X="02 04:00")
    add(
        s,
        {c: "A" for c in "BCDEFX"},
        # the cascade takes the time of the root's latest merge of the batch
        D=[("D", "01 01:03"), ("C", "01 02:00"), ("A", "02 04:00")],
        C=[("C", "01 01:02"), ("A", "02 02:00")],
    )

    s = people(Story("mergeonly"), 1, "AB").merge(2, "A", B="02 02:00")
    add(s, {"B": "A"}, B=[("B", "01 01:01"), ("A", "02 02:00")])

    s = people(Story("remap"), 1, "ABC").merge(1, "A", B="01 02:00")
    s.merge(3, "A", B="01 02:00", C="03 02:00")
    add(s, {"B": "A", "C": "A"}, C=[("C", "01 01:02"), ("A", "03 02:00")])

    s = Story("multiid").page(1, "A", "01:00", n="nA").page(1, "A", "02:00", u="uA", app="ios")
    s.page(3, "A", "01:00", app="mobile")
    add(s, {}, A=[("A", "01 01:00")])

    s = Story("uid_conflict").page(1, "A", "01:00", u="alice").page(1, "B", "01:01", u="bob")
    add(s, {})

    s = Story("late").page(1, "A", "10:00").page(3, "A", "", when="01 09:00")
    add(s, {}, A=[("A", "01 09:00")])

    s = Story("stable")
    for day in (1, 2, 3, 4):
        s.page(day, "A", "01:00", u="uA")
    add(s, {}, A=[("A", "01 01:00")])

    s = people(Story("reobserve"), 1, "AB").merge(1, "A", B="01 02:00")
    s.page(2, "B", "05:00").page(3, "B", "05:00")
    add(s, {"B": "A"}, B=[("B", "01 01:01"), ("A", "01 02:00")])

    s = Story("selfbridge").page(1, "A", "01:00", n="nA").page(2, "A", "01:00", n="nA")
    add(s, {}, A=[("A", "01 01:00")])

    s = people(Story("rapid_remerge"), 1, "AB").merge(1, "A", B="01 02:00").page(2, "Z", "01:00")
    s.merge(2, "Z", B="01 02:00", A="02 02:00")
    add(
        s,
        {"A": "Z", "B": "Z"},
        A=[("A", "01 01:00"), ("Z", "02 02:00")],
        B=[("B", "01 01:01"), ("A", "01 02:00"), ("Z", "02 02:00")],
    )

    s = people(Story("highfanin"), 1, "RABCDEF")
    absorbed = {}
    for i, c in enumerate("ABCDEF"):
        absorbed[c] = f"01 02:{i:02}"
        s.merge(1, "R", **absorbed)
    add(s, {c: "R" for c in "ABCDEF"}, D=[("D", "01 01:04"), ("R", "01 02:03")])

    s = Story("bridge_creates").page(1, "A", "01:00", n="nA").page(2, "B", "02:00", n="nA")
    s.merge(2, "A", B="02 02:00")
    add(s, {"B": "A"}, B=[("B", "02 02:00"), ("A", "02 02:00")])

    s = people(Story("three_way_bridge"), 1, "ABC").merge(1, "A", B="01 02:00", C="01 02:00")
    add(s, {"B": "A", "C": "A"})

    s = Story("cross_batch_triple").page(1, "A", "01:00")
    absorbed = {}
    for day, c in ((2, "B"), (3, "C"), (4, "D")):
        absorbed[c] = f"0{day} 02:00"
        s.page(day, c, "01:00").merge(day, "A", **absorbed)
    add(s, {c: "A" for c in "BCD"}, B=[("B", "02 01:00"), ("A", "02 02:00")])

    s = Story("shared_identifier_collision").page(1, "A", "01:00", u="alice", n="own")
    s.page(1, "B", "01:01", u="bob", n="shared").page(2, "A", "01:00", n="shared")
    add(s, {})

    s = people(Story("late_merge"), 1, "AB", first="03:00").merge(3, "A", B="01 02:00")
    add(s, {"B": "A"}, B=[("A", "01 02:00"), ("B", "01 03:01")])

    s = people(Story("reverse_chain"), 1, "ABC").merge(2, "B", A="02 02:00")
    s.merge(3, "C", A="02 02:00", B="03 02:00")
    add(
        s,
        {"A": "C", "B": "C"},
        A=[("A", "01 01:00"), ("B", "02 02:00"), ("C", "03 02:00")],
        B=[("B", "01 01:01"), ("C", "03 02:00")],
    )

    s = people(Story("merge_then_uid"), 1, "AB").merge(2, "A", B="02 02:00")
    s.page(3, "A", "01:00", u="alice").page(3, "B", "01:01", u="bob")
    add(s, {"B": "A"})

    s = people(Story("interleaved_merge"), 1, "ABCD").merge(2, "A", B="02 02:00")
    s.merge(3, "C", D="03 02:00").merge(4, "A", B="02 02:00", D="03 02:00", C="04 02:00")
    add(
        s,
        {"B": "A", "C": "A", "D": "A"},
        D=[("D", "01 01:03"), ("C", "03 02:00"), ("A", "04 02:00")],
        C=[("C", "01 01:02"), ("A", "04 02:00")],
        B=[("B", "01 01:01"), ("A", "02 02:00")],
    )

    s = people(Story("deep_single_batch"), 1, "ABCDEF")
    s.merge(2, "A", **{c: f"02 02:0{i}" for i, c in enumerate("BCDEF")})
    add(s, {c: "A" for c in "BCDEF"}, F=[("F", "01 01:05"), ("A", "02 02:04")])
    return out


STORIES = stories()


def run_days(spark, raw, cfg, tag):
    store = scratch_tables(spark, tag, 2)
    windows = runs.catch_up(store, cfg, raw, at("09 00:00"))
    return store, windows


@pytest.fixture(scope="module")
def raw(table):
    return table(RAW, [e for events, _, _ in STORIES.values() for e in events])


@pytest.fixture(scope="module")
def store(spark, raw):
    store, windows = run_days(spark, raw, CFG, "stories")
    assert len(windows) == 4
    return store


@pytest.fixture(scope="module")
def final(store):
    """Every table collected once."""
    return {t: store.read(t).collect() for t in schemas.KEYS}


def test_there_are_27_stories():
    assert len(STORIES) == 27


@pytest.mark.parametrize("name", STORIES)
def test_story(final, name):
    events, mapping, paths = STORIES[name]

    def mine(identity):
        return identity.startswith(f"{name}.")

    got = {r.identity_id: r.active_identity_id for r in final["id_mapping"] if mine(r.identity_id)}
    assert got == {f"{name}.{c}": f"{name}.{p}" for c, p in mapping.items()}
    for child, path in paths.items():
        spans = sorted(
            (r for r in final["id_mapping_scd"] if r.identity_id == f"{name}.{child}"),
            key=lambda r: (r.effective_at, not r.superseded_at),
        )
        assert [(r.active_identity_id, r.effective_at) for r in spans] == [
            (f"{name}.{p}", at(t)) for p, t in path
        ]
        ends = [r.superseded_at for r in spans]
        assert ends == [*[r.effective_at for r in spans[1:]], None]
    # every identifier of the story is found, under the current parent of who carried it
    want = {}
    for e in events:
        if e[8] is None:
            continue
        who = e[8][0][0]
        active = got.get(who, who)
        for kind, value in (("DOMAIN_USERID", e[3]), ("USER_ID", e[4]), ("NETWORK_USERID", e[10])):
            if value:
                times = want.setdefault((active, kind, value), [])
                times.append((e[6], e[0], e[2]))
    table = {
        (r.active_identity_id, r.id_type, r.id_value): r
        for r in final["identifier_mapping"]
        if mine(r.active_identity_id)
    }
    assert table.keys() == want.keys()
    for key, sightings in want.items():
        first, last = min(sightings), max(sightings)
        r = table[key]
        assert (r.first_seen_at, r.first_seen_event_id, r.first_app_id) == first
        assert (r.last_seen_at, r.last_app_id) == (last[0], last[2])


def test_tables_are_clean(spark, store, rows):
    t = {name: store.read(name) for name in schemas.KEYS}
    for name, key in schemas.KEYS.items():
        assert rows(quality.check_not_null(t[name], [key])) == []
        assert rows(quality.check_unique(t[name], [key])) == []
    assert rows(quality.check_unique_combination(t["id_mapping_scd"], ["identity_id", "effective_at"])) in (
        [],
        # created and merged by the same event: two rows at one time, one of them current
        [("bridge_creates.B", "02 02:00", 2)],
    )
    assert rows(quality.check_no_stale_roots(t["identifier_mapping"], t["id_mapping"])) == []
    assert rows(quality.check_scd_replay(t["id_changes"], t["id_mapping"], t["id_mapping_scd"])) == []
    current = [r for r in t["id_mapping_scd"].collect() if r.is_current]
    assert len(current) == len({r.identity_id for r in current}) == t["identities"].count()


def test_one_batch_gives_the_same_mapping_and_lookup(spark, raw, store, rows):
    once = scratch_tables(spark, "once", 3)
    whole = RunContext(at("01 00:00"), at("09 00:00"), at("09 00:00"))
    runs.execute(once, CFG, raw.repartition(7), whole)
    shown = {
        "id_mapping": ["identity_id", "active_identity_id", "merged_at"],
        "identifier_mapping": ["uuid", "first_seen_at", "last_seen_at", "first_app_id",
                               "last_app_id", "first_seen_event_id"],
        "merge_events": ["merge_event_id", "active_identity_id", "merges"],
    }
    for table, cols in shown.items():
        assert rows(once.read(table), *cols) == rows(store.read(table), *cols)


def test_running_again_changes_nothing(spark, raw, store, rows):
    before = {t: rows(store.read(t)) for t in schemas.KEYS}
    manifest = rows(runs.load_manifest(store))
    assert runs.catch_up(store, CFG, raw, at("09 01:00")) == []
    assert rows(runs.load_manifest(store)) == manifest
    # even the last day forced through again leaves every table as it was
    day4 = RunContext(at("04 00:00"), at("05 00:00"), at("09 00:00"))
    runs.process(
        store, CFG, runs.base_events_this_run(raw, CFG, day4), day4.run_tstamp,
        stream_batch=("replay", 0),
    )
    assert {t: rows(store.read(t)) for t in schemas.KEYS} == before
