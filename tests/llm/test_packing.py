"""Packing: every id once, no overlap, and the waste of best fit decreasing."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from idweave.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def best_fit(lengths, window):
    """Rooms left in the windows of best fit decreasing, placed one by one."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else window
        bisect.insort(rooms, room - n)
    return Counter(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.just(40))
def test_plan_places_like_one_by_one(lengths, window):
    histogram = Counter(lengths)
    fill, spans = Counter(), defaultdict(list)
    for length, group in histogram.items():
        steps = [s for s in packing.best_fit_plan(histogram, window) if s[0] == length]
        starts = [s[1] for s in steps]
        assert starts == sorted(starts)
        for rank in range(group):
            _, rank0, first, each, base = steps[bisect.bisect_right(starts, rank) - 1]
            w, offset = first + (rank - rank0) // each, base + (rank - rank0) % each * length
            fill[w] += length
            spans[w].append((offset, length))
    for w, s in spans.items():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at == fill[w] <= window
    assert sorted(spans) == list(range(len(spans)))
    assert Counter(window - n for n in fill.values()) == best_fit(lengths, window)


TEXTS = [
    None, "", "Hello, World! it's we'll 'S DON'T", "<|endoftext|> <|ENDOFTEXT|> ends", "a\x0b\x0cb\u00a0c\u2003d\u0301e",
    "İstanbul ΟΔΟΣ straße ñandú", "1234 12a3 ... !!! ---x", "👍🏽 ok", "x" * 9000, "\n\t ", "ABC<|startoftext|>def",
]


def test_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    rng = random.Random(1)
    alphabet = "aAbBzZéÉßİ'.,-<|>19 \n\t\u0301\u00a0中"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    whole = Tokenizer.from_file(PATH)
    got = list(packing.WordIds(PATH).texts(pa.array(texts)))
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def test_every_id_once(spark):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    vocab = [f"word{i}" for i in range(50)]
    texts = TEXTS + [" ".join(rng.choice(vocab) for _ in range(rng.choice([1, 5, 40, 400]))) for _ in range(60)]
    docs = list(enumerate(texts)) + [(None, "no id"), (3, texts[3])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = packing.pack(df, PATH, window=64).collect()
    whole = Tokenizer.from_file(PATH)
    want = Counter()
    for d, t in docs:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for a in range(0, len(ids), 64):
            want[d, a, len(ids[a : a + 64]), zlib.crc32(ids[a : a + 64].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for s in windows.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    rooms = Counter(64 - sum(n for _, n in s) for s in windows.values())
    assert rooms == best_fit([r.length for r in rows], 64)


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, length string, task int")
    assert packing.pack(empty, PATH).collect() == []
    one = spark.createDataFrame([(1, "hi", "x", 2)], "doc_id long, text string, length string, task int")
    (r,) = packing.pack(one, PATH).collect()
    assert (r.doc_id, r.length, r.sequence_id, r.offset) == (1, 2, 0, 0)
