"""Budgets over the tree and prefixes of leaves against a plain recursion."""

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from idweave.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string"


def share(children, budget):
    """{name: tokens}: fill whoever can't take its share until nobody is left out."""
    got, rest = {}, budget
    open_ = {k: (s, w) for k, s, w in children if w > 0}
    while open_:
        total = sum(w for _, w in open_.values())
        full = [k for k, (s, w) in open_.items() if s <= Fraction(max(rest, 0) * w, total)]
        if not full:
            break
        for k in full:
            got[k] = open_.pop(k)[0]
        rest = budget - sum(got.values())
    if open_:
        total = sum(w for _, w in open_.values())
        part = {k: rest * w // total for k, (_, w) in open_.items()}
        odd = rest - sum(part.values())
        for n, k in enumerate(sorted(open_, key=lambda k: (k is not None, k or ""))):
            got[k] = part[k] + (n < odd)
    return got


def brute(docs, budget, epochs, weights, seed):
    size = [len([w for w in (t or "").replace("\n", " ").split(" ") if w]) for _, t, _, _ in docs]
    domain = lambda s: f"domain{(int(s[-1]) if s and s[-1].isdigit() else 0) % 4}"
    leaf = [(domain(s), lang, s) for _, _, lang, s in docs]
    supply = defaultdict(int)
    for key, n in zip(leaf, size, strict=True):
        for depth in range(1, 4):
            supply[key[:depth]] += n * epochs
    handed = {(): budget}
    for depth in range(3):
        level = mixing.LEVELS[depth]
        for parent in {k[:depth] for k in leaf}:
            names = sorted({k[depth] for k in leaf if k[:depth] == parent}, key=str)
            kids = [(k, supply[*parent, k], weights.get(level, {}).get(k, 1)) for k in names]
            for k, v in share(kids, handed.get(parent, 0)).items():
                handed[*parent, k] = v
    taken = [0] * len(docs)
    for key in set(leaf):
        rows = [i for i in range(len(docs)) if leaf[i] == key]
        tokens = sum(size[i] for i in rows)
        b = handed.get(key, 0)
        full = b // tokens if tokens else 0
        order = lambda i: (int(hashlib.md5(f"{seed}:{full + 1}:{docs[i][0]}".encode()).hexdigest()[:15], 16), docs[i][0])  # noqa: E731, B023
        left = b - full * tokens
        for i in sorted(rows, key=order):
            part = min(size[i], left)
            taken[i] = full * size[i] + part
            left -= part
    return sorted((d[0], n, handed.get(k, 0), t) for d, n, k, t in zip(docs, size, leaf, taken, strict=True)), taken


def corpus(rng, n):
    docs = []
    for i in range(n):
        source = rng.choice(["src0"] * 6 + ["src1", "src2", "src5", "other", None])
        lang = rng.choice(["en", "en", "de", None])
        text = rng.choice([None, "", " \n ", *[" ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 60)))] * 9])
        docs.append((i, text, lang, source))
    return docs


def test_budgets_and_prefixes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 5)
    rng = random.Random(6)
    docs = corpus(rng, 150)
    df = spark.createDataFrame(docs, SCHEMA)
    total = sum(len((t or "").split()) for _, t, _, _ in docs)
    weights = {"lang": {"en": 5, "de": 2}, "source": {"src0": 3}, "domain": {"domain1": 2}}
    for budget, epochs in ((total // 2, 1), (total * 2, 4), (total * 9, 4), (7, 2), (0, 2)):
        rows = mixing.mixed(df, budget, epochs=epochs, seed=3, weights=weights).collect()
        got = sorted((r.doc_id, r.n_tokens, r.leaf_budget, r.taken_tokens) for r in rows)
        want, taken = brute(docs, budget, epochs, weights, 3)
        assert got == want, (budget, epochs)
        assert sum(taken) == min(budget, total * epochs)


def test_shortage_goes_to_siblings_first():
    kids = [("a", 10, 1), ("b", 100, 1), ("c", 100, 1)]
    assert share(kids, 90) == {"a": 10, "b": 40, "c": 40}


def test_repeated_by_epoch(spark):
    rows = [(1, "a b c", "en", "s1", "own"), (2, "d e", "en", "s1", "own"), (2, "d e", "en", "s1", "own")]
    df = spark.createDataFrame(rows, SCHEMA + ", domain string")
    out = mixing.repeated_by_epoch(df, "all_tokens * 3", epochs=4)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == sorted(rows * 3)
    assert mixing.repeated_by_epoch(df.limit(0), 5).collect() == []
    none = mixing.mixed(df, 10, weights={"lang": {"en": 0}}).agg(F.sum("taken_tokens")).first()[0]
    assert none == 0


def test_the_last_reading_is_cut_to_its_prefix(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    texts = ["a b c d", "  aa\t\nbb  cc ", None, "", "x" * 10, "one two three four five six seven "]
    rows = [(i, t, "en", "s1", 99) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, schema)
    words = lambda t: re.findall("[^ \t-\r]+", t or "")
    total = sum(len(words(t)) for t in texts)
    for budget in (0, 1, 5, 7, total - 1, total + 3, 2 * total + 1):
        out = mixing.repeated_by_epoch(df, budget, epochs=2).collect()
        assert sum(len(words(r.text)) for r in out) == min(budget, 2 * total)
        cut = [r for r in out if r.text != texts[r.doc_id]]
        assert len(cut) <= 1
        for r in cut:
            assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
            assert words(r.text) == words(texts[r.doc_id])[: len(words(r.text))] and r.text[-1:].strip()


def test_very_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, long, "en", "s1"), (2, "a b", "en", "s1")], SCHEMA.split(", domain")[0])
    (r,) = mixing.mixed(df, 150_000, epochs=1).where("doc_id = 1").collect()
    read = {x.doc_id: len(x.text.split()) for x in mixing.repeated_by_epoch(df, 150_000, epochs=1).collect()}
    assert read[1] == r.taken_tokens and sum(read.values()) == 150_000


def test_leaves_without_weight_are_no_supply(spark):
    rows = [("domain0", "en", "bad", 900), ("domain0", "en", "good", 100), ("domain0", "de", "good", 1000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    got = mixing.leaf_budgets(leaves, 1000, epochs=1, weights={"source": {"bad": 0}}).collect()
    assert {(r.lang, r.source): r.leaf_budget for r in got} == {("en", "bad"): 0, ("en", "good"): 100, ("de", "good"): 900}
