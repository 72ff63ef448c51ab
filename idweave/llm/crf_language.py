"""Language of words and documents by a linear-chain conditional random field.

Each word has a hidden language. Its emission scores are sums of learned weights of the
character 1- to 4-grams of the word with its ends marked, so those at an end are its
affixes, and of the word itself if it is in the lexicon of the training words. Learned
transitions say how readily the language changes from one word to the next. Forward and
backward sums give every word's probability of each language; the mean over a document's
words with a letter is its score per language, and the largest one its label.

Training uses a bounded sample: about ``TRAIN_DOCS`` labelled documents per language,
chosen by a hash of doc_id, and of each about ``TRAIN_WORDS`` words in runs from hashed
places of the whole text. Pieces of
different documents are strung together to code-switched sequences, so transitions are
learned too, and the log-likelihood is climbed with Adam on full gradients. The model
is a few megabytes whatever the data. Prediction reads whole texts: a batch is cut into
chunks of words whose transfer matrices are multiplied for all chunks at once, passed
along each document, and opened again, which equals the plain recursion. A text of more
than ``SEGMENT`` bytes is labelled in segments of that size, cut between words, whose
sums add up; so memory doesn't follow the longest text.

Words are split at 0x20 and 0x09-0x0D, A-Z folded. Defined cases: null text and text
without a letter are ``und`` with score 0; labels that are null take no part in training;
no labelled document at all makes everything ``und``; of more than ``MOST_LABELS``
languages the most frequent ones are learned; ties go to the first label by
name; repeated rows get equal results; null doc_id is predicted like any other and never
trained on. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm import words

TRAIN_DOCS, TRAIN_WORDS, MOST_LABELS = 300, 200, 200
SEQUENCE, STEPS, RATE, DECAY = 64, 40, 0.15, 1e-4
SLOTS = 1 << 17
ORDERS = (1, 2, 3, 4)
CHUNK = 64
SEGMENT = 1 << 21
RUN_WORDS = 20
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Weight slots of all words in ``blob`` (each led by a line end, one more at the end).

    Returns the slots in order and, per word, where its slots begin (n + 1 long).
    """
    data = np.frombuffer(blob, np.uint8)
    edge = np.flatnonzero(data == 10)
    word = np.searchsorted(edge, np.arange(len(data)), side="right") - 1
    code = words._BYTE_CODE[data]
    slots, owners = [], []
    for n in ORDERS:
        h = np.full(max(0, len(data) - n + 1), n, np.uint64)
        for k in range(n):
            h = words.mix(h ^ code[k : len(data) - n + 1 + k])
        # a gram may touch a line end with its first or last byte only
        at = np.arange(len(h))
        last = at + n - 1
        first_word = word[at]
        next_edge = edge[np.minimum(first_word + 1, len(edge) - 1)]
        good = (last <= next_edge) & (first_word < len(edge) - 1)
        if n == 1:
            good &= data[at] != 10
        slots.append((h[good] & np.uint64(SLOTS - 1)).astype(np.int64))
        owners.append(first_word[good])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    begin = np.searchsorted(owner[order], np.arange(len(edge)))
    return np.concatenate(slots)[order], begin


class Model:
    """Labels, gram weights, lexicon with its weights, and log transitions."""

    def __init__(self, labels: list[str], lexicon: np.ndarray) -> None:
        self.labels, self.lexicon = labels, lexicon
        k = len(labels)
        self.grams = np.zeros((SLOTS, k), np.float32)
        self.entries = np.zeros((len(lexicon) + 1, k), np.float32)  # the last: not in the lexicon
        self.moves = np.zeros((k, k), np.float32)

    def state(self) -> tuple:
        """Plain values, to be sent to workers that lack this package."""
        return self.labels, self.lexicon, self.grams, self.entries, self.moves

    @classmethod
    def of(cls, state: tuple) -> Model:
        model = cls(*state[:2])
        model.grams, model.entries, model.moves = state[2:]
        return model

    def entry(self, h: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.lexicon, h)
        at = np.minimum(at, max(0, len(self.lexicon) - 1))
        hit = self.lexicon[at] == h if len(self.lexicon) else np.zeros(len(h), bool)
        return np.where(hit, at, len(self.lexicon))

    def transitions(self) -> np.ndarray:
        e = np.exp(self.moves - self.moves.max(axis=1, keepdims=True))
        return (e / e.sum(axis=1, keepdims=True)).astype(np.float32)

    def emissions(self, slots: np.ndarray, begin: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Per word the scores of all labels: mean gram weight and lexicon weight."""
        n = np.diff(begin)
        out = np.add.reduceat(self.grams[slots], np.minimum(begin[:-1], max(0, len(slots) - 1)), axis=0)
        return out / np.maximum(n, 1)[:, None] + self.entries[entry]


def _pass(emission: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Marginals of (sequences, steps, labels) scores; what precedes a sequence is evenly any label."""
    p = np.exp(emission - emission.max(axis=2, keepdims=True)).astype(np.float32)
    s, t, k = p.shape
    forward = np.zeros_like(p)
    a = np.full((s, k), 1 / k, np.float32)
    for i in range(t):
        b = (a @ moves) * p[:, i]
        b /= b.sum(axis=1, keepdims=True)
        a = np.where(mask[:, i, None], b, a)
        forward[:, i] = a
    out = np.zeros_like(p)
    b = np.ones((s, k), np.float32)
    for i in range(t - 1, -1, -1):
        g = forward[:, i] * b
        out[:, i] = g / g.sum(axis=1, keepdims=True)
        c = (p[:, i] * b) @ moves.T
        c /= c.sum(axis=1, keepdims=True)
        b = np.where(mask[:, i, None], c, b)
    return out


def _pair_counts(emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals and expected transitions of full sequences, those into their first words too."""
    p = np.exp(emission - emission.max(axis=2, keepdims=True)).astype(np.float32)
    s, t, k = p.shape
    forward = [np.full((s, k), 1 / k, np.float32)]
    for i in range(t):
        b = (forward[-1] @ moves) * p[:, i]
        forward.append(b / b.sum(axis=1, keepdims=True))
    out, pairs = np.zeros_like(p), np.zeros((k, k))
    b = np.ones((s, k), np.float32)
    for i in range(t - 1, -1, -1):
        g = forward[i + 1] * b
        out[:, i] = g / g.sum(axis=1, keepdims=True)
        right = p[:, i] * b
        xi = forward[i][:, :, None] * moves[None] * right[:, None, :]
        pairs += (xi / xi.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = right @ moves.T
        b /= b.sum(axis=1, keepdims=True)
    return out, pairs


def gradients(emission: np.ndarray, truth: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood of sequences, by the emission scores and by the raw transitions.

    ``moves`` are transitions whose rows are a softmax of the raw ones.
    """
    k = len(moves)
    marginal, expected = _pair_counts(emission, moves)
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
    # the label before a first word is not known: it is shared out as the transitions have it
    seen += np.bincount(truth[:, 0], minlength=k) * moves / moves.sum(axis=0)
    apart = seen - expected
    return np.eye(k, dtype=np.float32)[truth] - marginal, apart - moves * apart.sum(axis=1, keepdims=True)


def _word_blob(data: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b"\n" + b"".join(data[a:b].lower() + b"\n" for a, b in zip(starts, ends, strict=True))


def fit(texts: list[str], labels: list[str], seed: int = 7) -> Model | None:
    """The model of labelled texts; None if there is no word with a label."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    data, at = words.as_bytes(pa.array(texts, pa.string()))
    starts, ends, first = words.split(data, at)
    if not len(starts):
        return None
    h = words.hashes(data, starts, ends)
    label = np.repeat([names.index(x) for x in labels], np.diff(first))
    kinds, where, which, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    slots, begin = features(_word_blob(data.tobytes(), starts[where], ends[where]))
    model = Model(names, kinds[count >= 2])
    entry = model.entry(kinds)
    # code-switched sequences: runs of 4 to 32 words from random places
    need = max(SEQUENCE, len(h) // SEQUENCE * SEQUENCE)
    runs, total = [], 0
    while total < need:
        doc = int(rng.integers(len(texts)))
        n = int(first[doc + 1] - first[doc])
        if n:
            a = int(first[doc] + rng.integers(n))
            runs.append(np.arange(a, min(first[doc + 1], a + rng.integers(4, 33))))
            total += len(runs[-1])
    order = np.concatenate(runs)[:need].reshape(-1, SEQUENCE)
    k = len(names)
    truth = label[order]
    owner = np.repeat(np.arange(len(kinds)), np.diff(begin))
    share = 1 / np.maximum(np.diff(begin), 1)
    params = [model.grams, model.entries, model.moves]
    first_moment, second_moment = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        scores = model.emissions(slots, begin, entry)[which[order]]
        by_score, by_move = gradients(scores, truth, model.transitions())
        delta = by_score.reshape(-1, k)
        word_of = which[order].ravel()
        per_word = np.stack([np.bincount(word_of, delta[:, c], len(kinds)) for c in range(k)], axis=1)
        per_gram = per_word * share[:, None]
        grads = [
            np.stack([np.bincount(slots, per_gram[owner, c], SLOTS) for c in range(k)], axis=1),
            np.stack([np.bincount(entry, per_word[:, c], len(model.entries)) for c in range(k)], axis=1),
            by_move,
        ]
        for p, g, m, v in zip(params, grads, first_moment, second_moment, strict=True):
            g = g / len(word_of) * 100 - DECAY * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-4)
    return model


def _document_scores(model: Model, emission: np.ndarray, counted: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean marginals per document over its counted words, by chunks of each document."""
    k, moves = len(model.labels), model.transitions()
    n = np.diff(first)
    chunks = -(-n // CHUNK)
    begin = np.concatenate([[0], np.cumsum(chunks)])
    total = int(begin[-1])
    out = np.zeros((len(n), k))
    if not total:
        return out
    doc = np.repeat(np.arange(len(n)), chunks)
    place = np.arange(total) - begin[doc]
    start = first[doc] + place * CHUNK
    at = start[:, None] + np.arange(CHUNK)[None]
    mask = at < first[doc + 1][:, None]
    at = np.minimum(at, len(emission) - 1)
    top = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float32)
    p = top[at]
    # what a chunk does to the message that enters it
    transfer = np.broadcast_to(np.eye(k, dtype=np.float32), (total, k, k)).copy()
    long = chunks[doc] > 1
    if long.any():
        for i in range(CHUNK):
            m = (transfer[long] @ moves) * p[long, i][:, None, :]
            m /= m.sum(axis=(1, 2), keepdims=True)
            transfer[long] = np.where(mask[long, i][:, None, None], m, transfer[long])
    a_in = np.full((total, k), 1 / k, np.float32)
    b_in = np.ones((total, k), np.float32)
    for j in range(1, int(chunks.max())):
        now = begin[:-1][chunks > j] + j
        m = np.einsum("ci,cij->cj", a_in[now - 1], transfer[now - 1])
        a_in[now] = m / m.sum(axis=1, keepdims=True)
    for j in range(1, int(chunks.max())):
        now = begin[1:][chunks > j] - 1 - j
        m = np.einsum("cij,cj->ci", transfer[now + 1], b_in[now + 1])
        b_in[now] = m / m.sum(axis=1, keepdims=True)
    forward = np.zeros_like(p)
    a = a_in
    for i in range(CHUNK):
        b = (a @ moves) * p[:, i]
        b /= b.sum(axis=1, keepdims=True)
        a = np.where(mask[:, i, None], b, a)
        forward[:, i] = a
    weight = counted[at] & mask
    sums = np.zeros((total, k), np.float32)
    b = b_in
    for i in range(CHUNK - 1, -1, -1):
        g = forward[:, i] * b
        g /= g.sum(axis=1, keepdims=True)
        sums += np.where(weight[:, i, None], g, 0)
        c = (p[:, i] * b) @ moves.T
        c /= c.sum(axis=1, keepdims=True)
        b = np.where(mask[:, i, None], c, b)
    np.add.at(out, doc, sums)
    return out


def segments(text: str, most: int) -> list[str]:
    """The text in parts of at most ``most`` bytes, cut before white space where there is any."""
    data = text.encode("utf-8")
    out, a = [], 0
    while len(data) - a > most:
        b = max(data.rfind(x, a + 1, a + most + 1) for x in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if b < 0:
            b = a + most
            while b > a + 1 and data[b] & 0xC0 == 0x80:  # not inside a character
                b -= 1
        out.append(data[a:b].decode("utf-8"))
        a = b
    return [*out, data[a:].decode("utf-8")]


def _label_sums(model: Model, texts: pa.Array) -> np.ndarray:
    """Per text the sums of its counted words' marginals."""
    data, at = words.as_bytes(texts)
    starts, ends, first = words.split(data, at)
    h = words.hashes(data, starts, ends)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    counted = letters[ends] > letters[starts]
    if len(h):
        kinds, where, which = np.unique(h, return_index=True, return_inverse=True)
        slots, begin = features(_word_blob(data.tobytes(), starts[where], ends[where]))
        emission = model.emissions(slots, begin, model.entry(kinds))[which]
    else:
        emission = np.zeros((0, len(model.labels)), np.float32)
    return _document_scores(model, emission, counted, first)


def predict(model: Model | None, texts: pa.Array) -> tuple[list[str], list[float]]:
    """The label and score of each text."""
    names, scores = [], []
    for i, j in words.slices(texts):
        if model is None:
            names += [UNKNOWN] * (j - i)
            scores += [0.0] * (j - i)
            continue
        part = texts.slice(i, j - i)
        if j - i == 1 and len(words.as_bytes(part)[0]) > SEGMENT:
            parts = segments(part[0].as_py(), SEGMENT)
            sums = sum(_label_sums(model, pa.array([x])) for x in parts)
        else:
            sums = _label_sums(model, part)
        real = np.array([_has_letter(t) for t in part], bool)
        mass = sums.sum(axis=1)
        best = sums.argmax(axis=1)
        for d in range(j - i):
            known = bool(real[d]) and mass[d] > 0
            names.append(model.labels[best[d]] if known else UNKNOWN)
            scores.append(float(min(1.0, sums[d, best[d]] / mass[d])) if known else 0.0)
    return names, scores


def _has_letter(text: pa.StringScalar) -> bool:
    """Whether the text has a letter of any script; the common case ends at the first few."""
    value = text.as_py()
    return value is not None and any(c.isalpha() for c in value)


def is_held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def training_sample(docs: DataFrame, docs_per_label: int = TRAIN_DOCS, words_each: int = TRAIN_WORDS) -> tuple[list[str], list[str]]:
    """Texts and labels of a bounded sample; the same for the same rows."""
    usable = docs.where("text is not null and lang is not null and doc_id is not null").where(~is_held_out())
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LABELS).collect()
    rate = F.lit(0.0)
    for r in counts:
        share = min(1.0, 1.25 * docs_per_label / r["count"])
        rate = F.when(F.col("lang") == r["lang"], share).otherwise(rate)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    # runs of words from hashed places; a short text is taken whole
    text_words = F.split(F.trim("text"), "[\\x20\\x09-\\x0D]+")
    spare = F.greatest(F.size("w") - RUN_WORDS + 1, F.lit(1))
    start = lambda k: F.pmod(F.xxhash64("doc_id", k), spare).cast("int") + 1
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(max(1, words_each // RUN_WORDS))), lambda k: F.slice("w", start(k), RUN_WORDS)))
    picked = (
        usable.where(place < rate)
        .select("doc_id", "lang", text_words.alias("w"))
        .select("doc_id", "lang", F.array_join(F.when(F.size("w") <= words_each, F.col("w")).otherwise(runs), " ").alias("some"))
    )
    rows = picked.orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "some").limit(2 * docs_per_label * max(1, len(counts))).collect()
    return [r["some"] for r in rows], [r["lang"] for r in rows]


def _predict_batches(state: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if state.value is None else Model.of(state.value)
        for batch in batches:
            names, scores = predict(known, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang)."""
    texts, labels = training_sample(docs)
    model = fit(texts, labels) if texts else None
    # plain arrays: an instance would be pickled by a reference to this package
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else model.state())
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), "text"
    )
    return rows.mapInArrow(_predict_batches(shared), "doc_id long, held_out boolean, lang_pred string, score double")
