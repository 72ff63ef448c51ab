"""Phrases against a plain count of all n-grams."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from idweave.llm import collocations as co

DOCS = "doc_id long, text string, lang string, rank string, word string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, percent, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    out = []
    for lang in n:
        mine = {p: a for (x, p), a in f.items() if x == lang}
        found = []
        for p, a in mine.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(
                len(q) == 3 and b >= least and p in (q[:2], q[1:]) and 100 * b >= percent * a for q, b in mine.items()
            ):
                continue
            score, k = min((10**6 * a * a // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(1, t, x, "z", "z") for t, x in rows], DOCS).repartition(3)
    return sorted(tuple(r) for r in co.collocations(df, **kw).collect())


def some_texts(seed, n):
    rng = random.Random(seed)
    lexicon = ["the", "The", "of", "en", "es", "New", "york", "CITY", "é", "É", "日本", "a-b", "x"] + [f"w{i}" for i in range(30)]
    ends = [" ", "  ", "\t", ", ", ". ", "\n", "\r", ";", " !"]
    weight = [9, 5, 6, 3, 3, 4, 4, 4, 2, 2, 2, 1, 1] + [1] * 30
    text = lambda: "".join(w + rng.choices(ends, [12, 1, 1, 1, 1, 1, 1, 1, 1])[0] for w in rng.choices(lexicon, weight, k=60))
    rows = [(text(), rng.choice(["en", "en", "en", "es", None])) for _ in range(n)]
    return [*rows, rows[0], rows[0], (None, "en"), ("", None), (" \n.", "fr"), ("New York City. " * 40, "en")]


def test_equal_to_a_plain_count(spark, monkeypatch):
    rows = some_texts(3, 120)
    want = plain(rows, 4, 50, 40)
    assert len(want) > 100 and len({r[0] for r in want}) == 3
    assert run(spark, rows, least=4, top=40) == want
    # many blocks and flushes
    monkeypatch.setattr(co, "MERGE_ENTRIES", 50)
    monkeypatch.setattr(co, "FLUSH_ENTRIES", 200)
    monkeypatch.setattr(co, "FLUSH_WORDS", 20)
    assert run(spark, rows, least=4, top=40) == want


def test_a_full_bit_array_only_counts_more(spark, monkeypatch):
    monkeypatch.setattr(co.bit_filter, "BITS_EACH", 0)
    rows = some_texts(5, 60)
    assert run(spark, rows, least=3, top=25) == plain(rows, 3, 50, 25)


def test_ids_that_clash_are_drawn_anew(spark, monkeypatch):
    usual = co.codes_of
    # the first seed cannot tell letters apart
    monkeypatch.setattr(co, "codes_of", lambda seed: usual(seed) if seed else np.full(256, 3, np.uint64))
    rows = some_texts(7, 40)
    assert run(spark, rows, least=3, top=25) == plain(rows, 3, 50, 25)


def test_small_and_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(None, None), ("", "en")]) == []
    assert run(spark, [("a b", "en")] * 9) == []
    assert run(spark, [("a b", "en")] * 10) == [("en", 1, "a b", 10, 10, 10, 20, 1_000_000)]


def test_scores_past_64_bits(spark):
    exact = spark.sql(
        "select (cast(1000000 as decimal(38,0)) * a * a) div (cast(a as decimal(38,0)) * a) as s from values (5000000000000L) t(a)"
    )
    assert exact.first()["s"] == 1_000_000


@pytest.mark.parametrize("size", [2, 3])
@settings(max_examples=60, deadline=None)
@given(st.data())
def test_filters_are_lossless(size, data):
    ids = st.integers(0, 2**64 - 1) | st.sampled_from([0, 1, 2**64 - 1])
    grams = data.draw(st.lists(st.tuples(*[ids] * size), min_size=1, max_size=60))
    bits = data.draw(st.sampled_from([0, 1, 5]))
    many = data.draw(st.integers(1, 600))
    columns = [np.array(c, np.uint64) for c in zip(*grams, strict=True)]
    top, rest, count = co.merged(co.permuted(columns), columns[1:], np.full(len(grams), many, np.int64))
    got = Counter()
    for block in range(1 << bits):
        own = (top >> np.uint64(64 - bits)) == block if bits else np.ones(len(top), bool)
        if own.any():
            blob = co.encode_filter(bits, top[own], [x[own] for x in rest], count[own])
            t, r, c = co.decode_filter(block, size, blob)
            assert (t[1:] >= t[:-1]).all()
            for row in zip(co.restored(t, r).tolist(), *(x.tolist() for x in r), c.tolist(), strict=True):
                got[row[:-1]] += row[-1]
    assert got == Counter({g: n * many for g, n in Counter(grams).items()})
