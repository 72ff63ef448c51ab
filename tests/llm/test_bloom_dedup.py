"""Exact duplicates against plain grouping."""

import hashlib
import random
from collections import defaultdict

import pytest

from idweave.llm import bloom_dedup as bd

SCHEMA = "doc_id long, text string"


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[fold(t)].append(d)
    out, used = [], set()
    for d, t in docs:
        g = groups[fold(t)]
        keep = max((x for x in g if x is not None), default=None)
        kept = d == keep and (fold(t)) not in used
        used |= {fold(t)} if kept else set()
        out.append((d, keep, len(g), kept, hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, docs, **options):
    df = bd.mark_repeats(spark.createDataFrame(docs, SCHEMA).repartition(3), **options)
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"bits_per_row": 1, "probes": 1, "most_bits": bd.BLOCK_BITS}])
def test_same_as_grouping(spark, options):
    rng = random.Random(2)
    pool = ["", None, "Aa", "aA", "É", "é", "a b", "a  b", "x" * 200_000, *(f"t{i}" for i in range(300))]
    docs = [(i, rng.choice(pool)) for i in range(800)]
    docs += [(None, "only null"), (None, "only null"), (5000, "twice"), (5000, "twice"), (None, "T0")]
    assert found(spark, docs, **options) == brute(docs)


def test_rows_alone_do_not_reach_the_shuffle(spark):
    rows = spark.range(20_000).selectExpr("xxhash64(id) & 1152921504606846975 as h")
    bitmap, bits = bd.repeated_bits(rows, 4, 16, bd.MOST_BITS)
    at = bd._probe_bits(rows.toPandas()["h"].to_numpy(), 4, bits)
    hit = (bitmap[at >> 3] >> (7 - (at & 7)).astype("uint8") & 1).all(axis=1)
    assert hit.mean() < 0.02
    assert bits <= 16 * 20_000 * 2


def test_filter_size_is_bounded(spark):
    rows = spark.range(50_000).selectExpr("id as h")
    bitmap, bits = bd.repeated_bits(rows, 4, 16, 1 << 17)
    assert bits == 1 << 17 and len(bitmap) == 1 << 14


def test_columns_pass_through_and_clash(spark):
    docs = spark.createDataFrame(
        [(1, "a", "mine", 5), (2, "A", "yours", 6)], "doc_id long, text string, kept string, group_size int"
    )
    out = bd.without_repeats(docs)
    assert out.columns == docs.columns
    assert [tuple(r) for r in out.collect()] == [(2, "A", "yours", 6)]
    assert set(bd.mark_repeats(docs).columns) == {"doc_id", "text", "keep_id", "group_size", "kept", "text_sha256"}


def test_empty(spark):
    assert bd.mark_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
