"""The language model: exact recursions, held-out accuracy, edges."""

import itertools
import pickle
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from idweave.llm import crf_language as crf

WORDS = {
    "en": ["the", "house", "with", "thing", "running", "where", "water"],
    "de": ["der", "haus", "mit", "straße", "laufen", "woher", "wasser"],
    "fr": ["le", "maison", "avec", "chose", "courir", "où", "eau"],
}


def sample(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    labels = [k for k in WORDS for _ in range(40)]
    return crf.fit([sample(rng, k, 40) for k in labels], labels)


def test_chunked_marginals_equal_enumeration(model, monkeypatch):
    monkeypatch.setattr(crf, "CHUNK", 3)
    rng = np.random.default_rng(3)
    k, moves = 3, model.transitions()
    first = np.array([0, 8, 8, 9, 13])
    emission = rng.normal(size=(13, k)).astype(np.float32)
    counted = rng.random(13) < 0.7
    got = crf._document_scores(model, emission, counted, first)
    for d in range(4):
        words = range(first[d], first[d + 1])
        want = np.zeros(k)
        total, mass = 0.0, np.zeros((len(words), k))
        for path in itertools.product(range(k), repeat=len(words)):
            p, before = 1.0, np.full(k, 1 / k)
            for i, s in zip(words, path, strict=True):
                p *= (before @ moves)[s] * np.exp(emission[i, s])
                before = np.eye(k)[s]
            total += p
            for at, s in enumerate(path):
                mass[at, s] += p
        for at, i in enumerate(words):
            if counted[i]:
                want += mass[at] / total
        assert np.allclose(got[d], want, atol=1e-4)


def test_documents_and_code_switching(model):
    rng = random.Random(9)
    texts = [sample(rng, k, n) for k in WORDS for n in (1, 5, 200, 3000)]
    names, scores = crf.predict(model, pa.array(texts))
    assert names == [k for k in WORDS for _ in range(4)]
    assert all(0 <= s <= 1 for s in scores)
    mixed, score = crf.predict(model, pa.array([f"{sample(rng, 'en', 30)} {sample(rng, 'de', 10)}"]))
    assert mixed == ["en"] and 0.6 < score[0] < 0.9
    stay = np.diag(model.transitions())
    assert (stay > 0.5).all()


def test_texts_without_letters(model):
    names, scores = crf.predict(model, pa.array([None, "", " \n", "123 ... ,,", "、。", "x"]))
    assert names[:5] == ["und"] * 5 and scores[:5] == [0.0] * 5 and names[5] in WORDS
    assert crf.predict(None, pa.array(["house"])) == (["und"], [0.0])


def test_held_out_accuracy(spark):
    rng = random.Random(2)
    rows = [(i, sample(rng, k, rng.choice([3, 20, 60])), k) for i, k in enumerate(rng.choices(list(WORDS), k=400))]
    rows += [(None, "the house", "en"), (1000, "der haus", None), (1001, None, "en"), (5, "the water", "xx-unused")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, lang string, score string")
    got = crf.identify(df.where("lang is null or lang <> 'xx-unused'")).collect()
    assert len(got) == len(rows) - 1
    truth = {i: k for i, _, k in rows}
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert len(held) > 50
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert {r.doc_id: r.lang_pred for r in got}[1000] == "de"


def test_labels_of_held_out_rows_are_not_read(spark):
    rng = random.Random(4)
    rows = [(i, sample(rng, k, 30), k) for i, k in enumerate(rng.choices(list(WORDS), k=200))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spoiled = df.withColumn("lang", crf.F.when(crf.is_held_out(), "fr").otherwise(crf.F.col("lang")))
    assert sorted(crf.identify(df).collect()) == sorted(crf.identify(spoiled).collect())


def log_likelihood(emission, truth, raw):
    moves = np.exp(raw - raw.max(axis=1, keepdims=True))
    moves /= moves.sum(axis=1, keepdims=True)
    k, total = len(raw), 0.0
    for e, t in zip(emission, truth, strict=True):
        own, every = np.full(k, 1 / k), np.full(k, 1 / k)
        for i in range(len(t)):
            own, every = (own @ moves) * np.exp(e[i]), (every @ moves) * np.exp(e[i])
            own = np.where(np.arange(k) == t[i], own, 0)
        total += np.log(own.sum()) - np.log(every.sum())
    return total


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(5)
    k = 3
    emission, raw, truth = rng.normal(size=(4, 6, k)), rng.normal(size=(k, k)), rng.integers(0, k, (4, 6))
    moves = np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)
    by_score, by_move = crf.gradients(emission, truth, moves)
    step = 1e-5
    for at in np.ndindex(raw.shape):
        up, down = raw.copy(), raw.copy()
        up[at] += step
        down[at] -= step
        slope = (log_likelihood(emission, truth, up) - log_likelihood(emission, truth, down)) / (2 * step)
        assert abs(slope - by_move[at]) < 1e-4
    for at in [(0, 0, 1), (2, 5, 0), (3, 2, 2)]:
        up, down = emission.copy(), emission.copy()
        up[at] += step
        down[at] -= step
        slope = (log_likelihood(up, truth, raw) - log_likelihood(down, truth, raw)) / (2 * step)
        assert abs(slope - by_score[at]) < 1e-4


def test_a_worker_needs_no_copy_of_the_package(model, tmp_path):
    from pyspark import cloudpickle

    state = pickle.dumps(model.state())
    assert b"idweave" not in state

    class Shared:
        value = model.state()

    texts = pa.array(["the house with water", "der haus mit wasser"])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([True, False]), texts], names=["doc_id", "held_out", "text"])
    (tmp_path / "task").write_bytes(cloudpickle.dumps((crf._predict_batches(Shared()), batch)))
    code = (
        "import sys, pickle\n"
        "run, batch = pickle.load(open('task', 'rb'))\n"
        "assert not any(m.startswith('idweave') for m in sys.modules)\n"
        "print([r.column('lang_pred').to_pylist() for r in run(iter([batch]))])\n"
    )
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": ""}, capture_output=True, text=True)
    assert got.stdout.strip() == "[['en', 'de']]", got.stderr


def test_words_come_from_the_whole_text(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(3000)), "en") for i in range(40)] + [(50, "a b c", "de")]
    texts, labels = crf.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), words_each=200)
    places = [int(w.split("x")[1]) for t, k in zip(texts, labels, strict=True) if k == "en" for w in t.split()]
    assert len(places) == 200 * labels.count("en") and max(places) > 2500 and min(places) < 500
    assert sum(p >= 1500 for p in places) > 0.3 * len(places)


def test_of_many_labels_the_most_frequent_are_learned(spark, monkeypatch):
    monkeypatch.setattr(crf, "MOST_LABELS", 2)
    rng = random.Random(6)
    rows = [(i, sample(rng, k, 30), k) for i, k in enumerate(["en"] * 80 + ["de"] * 60 + ["fr"] * 9)]
    got = crf.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.lang_pred for r in got} == {"en", "de"}


def test_very_long_texts_are_labelled_in_segments(model, monkeypatch):
    monkeypatch.setattr(crf, "SEGMENT", 1000)
    monkeypatch.setattr(crf.words.slices, "__defaults__", (1000,))
    rng = random.Random(8)
    long = sample(rng, "de", 3000)
    assert "".join(crf.segments(long, 1000)) == long and max(len(x.encode()) for x in crf.segments(long, 1000)) <= 1000
    odd = "é" * 1501
    assert "".join(crf.segments(odd, 1000)) == odd
    names, scores = crf.predict(model, pa.array([long, "the house", odd]))
    assert names[:2] == ["de", "en"] and scores[0] > 0.9


def test_empty(spark):
    assert crf.identify(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []
