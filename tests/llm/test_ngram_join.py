"""The n-gram join against brute force over all pairs."""

import random

import numpy as np

from idweave.llm import bit_filter
from idweave.llm import ngram_join as nj
from idweave.llm.components import components

SCHEMA = "doc_id long, text string"


def shingles(text, size=5):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        folded = folded.replace(c, " ")
    w = [x for x in folded.split(" ") if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def found(spark, docs):
    df = nj.similar_documents(spark.createDataFrame(docs, SCHEMA))
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            i = rng.randrange(len(w))
            w[i : i + rng.randint(0, 2)] = [f"e{rng.randrange(10**6)}"] * rng.randint(0, 2)
        out.append(" ".join(w))
    return out


def test_families_around_the_threshold(spark):
    rng = random.Random(5)
    texts = []
    for f in range(12):
        base = [f"w{f}q{rng.randrange(500)}" for _ in range(rng.choice([8, 30, 90, 200]))]
        texts += family(rng, base, 14, max(1, len(base) // 18))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"z{rng.randrange(10**7)}" for _ in range(rng.choice([5, 12, 40, 100]))) for _ in range(40)]
    texts += ["", None, " \n\t", "one two", "ONE  two", "one two three four five", "a b c d e f", "x " * 40]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    assert found(spark, docs) == brute(docs)


def test_chains_over_groups(spark):
    """Neighbours are similar, the ends are not: one component through many links."""
    docs = [(i, " ".join(f"t{k}" for k in range(i * 5, i * 5 + 100))) for i in range(60)]
    got = found(spark, docs)
    assert got == brute(docs)
    assert {c for _, _, c in got} == {0}


def test_large_family_is_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(nj, "CHUNK_SETS", 8)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    docs = list(enumerate(family(rng, base, 120, 4)))
    assert found(spark, docs) == brute(docs)


def test_edges(spark):
    docs = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, None), (None, "x y"), (7, "")]
    assert found(spark, docs) == brute(docs)


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nj.similar_documents(empty).collect() == []
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame(
        [(2, text, "x", 1, "k"), (1, text, "y", 2, "l"), (None, text, "z", 3, "m"), (5, "other", "x", 4, "n")],
        "doc_id long, text string, key string, n long, component_id string",
    )
    kept = nj.one_of_each_group(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == [(1, text, "y", 2, "l"), (5, "other", "x", 4, "n")]


def test_prefixes_hold_enough_of_any_similar_set():
    """For all sizes: similar sets share ``need`` hashes of their prefixes, whatever their order."""
    for n in range(1, 400):
        for m in range(nj.least_overlap(n), n + 1):
            common = -(-80 * (n + m) // 180)
            if common > m:
                continue
            # hashes that both prefixes miss at most lie behind either prefix
            both = min(nj.slack(n), nj.slack(m))
            assert common - (n - nj.prefix_length(n)) >= both
            assert common - (m - nj.prefix_length(m)) >= both
            assert nj.slack(nj.least_overlap(n)) <= both and nj.slack(nj.least_overlap(m)) <= both


def test_components(spark, tmp_path):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    df = components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "c"))
    assert {r["sid"]: r["root"] for r in df.collect()} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_hashes_of_one_cell_do_not_become_rows(spark, monkeypatch):
    """Texts around one passage fill many cells; of their unions only the passage is dealt out."""
    monkeypatch.setattr(nj, "CHUNK_SETS", 8)
    dealt = []

    def counted(unions):
        rows = plain(unions)
        dealt.append((rows.count(), unions.selectExpr("sum(size(hashes))").first()[0] or 0))
        return rows

    plain = nj.held_by_several
    monkeypatch.setattr(nj, "held_by_several", counted)
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, f"{passage} " + " ".join(f"z{rng.randrange(10**7)}" for _ in range(60))) for i in range(80)]
    assert found(spark, docs) == brute(docs)
    rows, hashes = dealt[0]
    cells = -(-80 // 8) * 3  # placed by hash, some cells more than the least
    assert hashes > 80 * 50
    assert rows <= 60 * cells + hashes // 20


def test_repeated_hashes_are_all_held(spark):
    """A hash of two lists is found wherever they lie; hardly any of the others are."""
    rng = random.Random(4)
    each = [[rng.randrange(-(2**63), 2**63) for _ in range(300)] for _ in range(60)]
    twice = {each[2 * k][j] for k in range(30) for j in range(5)}
    for k in range(30):
        each[2 * k + 1][:5] = each[2 * k][:5]
    everywhere = rng.randrange(2**63)
    df = spark.createDataFrame([([*x, everywhere],) for x in each], "hashes array<long>")
    for parts in (1, 7):
        packed, bits = bit_filter.build_repeated(df.repartition(parts), 60 * 301)
        every = np.array(sorted({h for x in each for h in x} | {everywhere}), np.int64)
        held = bit_filter.may_hold(np.frombuffer(packed.value, np.uint8), bits, every.view(np.uint64))
        kept = set(every[held].tolist())
        assert twice | {everywhere} <= kept
        assert len(kept) < len(twice) + 1 + len(every) // 20
    empty, bits = bit_filter.build_repeated(df.where("false"), 0)
    assert not any(empty.value)
