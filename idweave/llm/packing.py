"""Packing documents into training sequences, best fit decreasing.

A document is its token ids and an end token. Documents longer than a window are first
cut into full windows; what remains of each, and every shorter document, is a piece.
Pieces are placed from the longest to the shortest, each into the open window with the
least room that still takes it.

That order only depends on lengths, and there are no more lengths than ``window``. So
the placement is planned from the histogram of lengths: windows with equal room are a
run of consecutive numbers, a segment tree indexed by the room finds the tightest run,
and a run takes as many pieces of a length as fit at once. The plan has a row for each
such step; its size depends on the window, not on the number of documents. Every piece
then looks up its window by its length and its rank among pieces of that length. Ranks
come from the count of each length in each task of the tokenising stage and a running
number within the task, so no length, however common, is sorted or gathered in one place.

Defined cases: null text is empty; an empty text is a piece with the end token only;
repeated rows and rows with a null doc_id are documents of their own; very long texts
are tokenised by word and cut. An empty table gives an empty result. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.llm import words
from idweave.llm.known_spans import KnownSpans
from idweave.plans.scratch import scratch_dir

WINDOW = 4096
END_TOKEN = 2
#: Words a worker keeps the ids of; beyond that it starts anew.
CACHE_WORDS = 1_000_000
SLICE_BYTES = 1 << 20
#: Rows (length, task) that may be broadcast, 24 bytes each.
BROADCAST_ROWS = 500_000


class WordIds:
    """Token ids of whole texts, by word.

    The tokenizer's normaliser and pre-tokenizer never join anything across white space,
    so the ids of a text are those of its words in a row. A worker encodes each distinct
    word once, remembers its ids by a 64-bit hash and puts texts together from them;
    lower-casing A-Z first is part of the normaliser anyway.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # bytes that each token stands for: its name has a character for each
        self.token_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.token_bytes[i] = len(token.removesuffix("</w>"))
        self.known = KnownSpans()
        self._forget()

    def _forget(self) -> None:
        self.known.clear()
        self.ids = np.zeros(0, np.uint32)  # of all known words in a row
        self.begin = np.zeros(1, np.int64)

    def _encode(self, new: list[bytes], simple: np.ndarray) -> list[bytes]:
        """Ids of each word.

        Simple words keep their number of bytes when they are normalised. They are encoded
        in one text, which is cut where the tokens' bytes add up to those of the words.
        """
        out: list[bytes | None] = [None] * len(new)
        plain = np.flatnonzero(simple).tolist()
        for low in range(0, len(plain), 16384):
            part = plain[low : low + 16384]
            text = b" ".join([new[i] for i in part]).decode("utf-8")
            (got,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(got.ids, np.uint32)
            reached = np.cumsum(self.token_bytes[ids])
            words_end = np.cumsum(np.fromiter((len(new[i]) for i in part), np.int64, len(part)))
            ends = np.searchsorted(reached, words_end) + 1
            if len(reached) and ends[-1] == len(ids) and np.array_equal(reached[ends - 1], words_end):
                for i, a, b in zip(part, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    out[i] = ids[a:b].tobytes()
        rest = [i for i, x in enumerate(out) if x is None]
        for low in range(0, len(rest), 4096):
            part = rest[low : low + 4096]
            got = self.tokenizer.encode_batch_fast([new[i].decode("utf-8") for i in part], add_special_tokens=False)
            for i, e in zip(part, got, strict=True):
                out[i] = np.array(e.ids, np.uint32).tobytes()
        return out

    def texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null is empty."""
        for i, j in words.slices(texts, SLICE_BYTES):
            data, at = words.as_bytes(texts.slice(i, j - i))
            starts, ends, first = words.split(data, at)
            blob = data.tobytes()
            special = b"<|" in blob  # a special token's name is case-sensitive
            h = words.hashes(data, starts, ends)
            if special:
                h = words.mix(h ^ _case_hash(data, starts, ends))
            if self.known.count > CACHE_WORDS:
                self._forget()
            which = self.known.find(h)
            missing = np.flatnonzero(which < 0)
            if len(missing):
                kinds, where = np.unique(h[missing], return_index=True)
                a, b = (x[missing[where]] for x in (starts, ends))
                odd = np.concatenate([[0], np.cumsum(_changes_length(data))])
                spans = [blob[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                new = self._encode(spans if special else [s.lower() for s in spans], odd[a] == odd[b])
                length = np.fromiter(map(len, new), np.int64, len(new)) // 4
                self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(new), np.uint32)])
                self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(length)])
                self.known.add(kinds)
                which[missing] = self.known.find(h[missing])
            begin = self.begin[which]
            n = self.begin[which + 1] - begin
            to = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
            stream = self.ids[np.repeat(begin - to[:-1], n) + np.arange(to[-1])]
            for k in range(j - i):
                yield stream[to[first[k]] : to[first[k + 1]]]


def _changes_length(data: np.ndarray) -> np.ndarray:
    """Marks bytes of anything but printable ASCII and Latin letters that stay two bytes long."""
    after = np.append(data[1:], np.uint8(0))
    letter = ((data == 0xC3) & (after != 0x97) & (after != 0xB7)) | ((data == 0xC4) & (after != 0xB0)) | (data == 0xC5)
    return ~(((data > 0x20) & (data < 0x7F)) | ((data >= 0x80) & (data < 0xC0)) | letter)


def _of_this_worker(path: str) -> WordIds:
    """The worker's own :class:`WordIds`, kept from task to task."""
    kept = sys.modules.setdefault("_task_word_ids", ModuleType("_task_word_ids"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.words = path, WordIds(path)
    return kept.words


def _case_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tells apart words that differ in the case of A-Z: a hash of where capitals are."""
    capital = ((data >= 65) & (data <= 90)).astype(np.uint64)
    place = np.arange(len(data), dtype=np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    start_of = np.zeros(len(data), np.uint64)
    for_each = ends - starts
    start_of[np.repeat(starts - np.cumsum(for_each) + for_each, for_each) + np.arange(for_each.sum())] = np.repeat(
        starts, for_each
    ).astype(np.uint64)
    np.cumsum(capital * words.mix(place - start_of + np.uint64(1)), out=sums[1:])
    return sums[ends] - sums[starts]


def _cut(path: str, window: int, end_token: int) -> Callable:
    """Map (doc_id, text) to pieces with the task's number and the rank within task and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        tokens = _of_this_worker(path)
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            ids_in = batch.column("doc_id").to_pylist()
            doc, start, length, crc, total = [], [], [], [], []
            for d, ids in zip(ids_in, tokens.texts(batch.column("text")), strict=True):
                ids = np.append(ids, np.uint32(end_token)).astype("<u4")
                for a in range(0, len(ids), window):
                    piece = ids[a : a + window]
                    doc.append(d)
                    start.append(a)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
            lengths = np.array(length, np.int64)
            rank = np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            kinds, begin, count = np.unique(lengths[order], return_index=True, return_counts=True)
            rank[order] = np.arange(len(lengths)) - np.repeat(begin, count) + np.repeat(seen[kinds], count)
            seen[kinds] += count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(lengths),
                    pa.array(crc, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(np.full(len(lengths), task)),
                    pa.array(rank),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"],
            )

    return run


class RoomTree:
    """A segment tree over room 0..window: the least room of at least r that has windows."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, room: int, value: bool) -> None:
        i = room + self.size
        self.any[i] = value
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, room: int) -> int | None:
        i = room + self.size
        if self.any[i]:
            return room
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_plan(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first rank, first window, pieces in each window, offset of the first).

    Pieces of a length with ranks from the first one on fill window after window.
    """
    open_runs: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]  # by room: (first, count)
    tree = RoomTree(window)
    plan, made = [], 0

    def put(room: int, first: int, count: int) -> None:
        open_runs[room].append((first, count))
        tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                # open as many windows as needed, each as full as it gets
                each = window // length
                first, count = made, -(-left // each)
                made += count
                room = window
            else:
                first, count = open_runs[room].pop()
                if not open_runs[room]:
                    tree.set(room, False)
            each = room // length
            full = min(count, left // each)
            if full:
                plan.append((length, rank, first, each, window - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
                first, count = first + full, count - full
            if count and left and left < each:
                plan.append((length, rank, first, left, window - room))
                put(room - left * length, first, 1)
                rank, left = rank + left, 0
                first, count = first + 1, count - 1
            if count:
                put(room, first, count)
    return plan


def _place(plan: list[tuple[int, int, int, int, int]]) -> Callable:
    """Map pieces with their rank to sequence_id and offset."""
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    for length, *step in plan:
        by_length.setdefault(length, []).append(tuple(step))
    steps = {k: [np.array(c, np.int64) for c in zip(*v, strict=True)] for k, v in by_length.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            kinds, begin = np.unique(length[order], return_index=True)
            for kind, a, b in zip(kinds, begin, [*begin[1:], len(order)], strict=True):
                rows = order[a:b]
                rank0, first, each, base = steps[int(kind)]
                step = np.searchsorted(rank0, rank[rows], side="right") - 1
                nth = rank[rows] - rank0[step]
                sequence[rows] = first[step] + nth // each[step]
                offset[rows] = base[step] + nth % each[step] * kind
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_token: int = END_TOKEN) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "packing")
    shape = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = source.mapInArrow(_cut(tokenizer, window, end_token), f"{shape}, task long, nth long")
    pieces.write.parquet(f"{folder}/pieces")
    pieces = spark.read.schema(pieces.schema).parquet(f"{folder}/pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts.write.parquet(f"{folder}/counts")
    counts = spark.read.schema(counts.schema).parquet(f"{folder}/counts")
    # at most ``window`` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    if counts.count() > BROADCAST_ROWS:  # it grows with the number of tasks
        before = before.hint("merge")
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    return ranked.mapInArrow(
        _place(best_fit_plan(histogram, window)), f"{shape}, sequence_id long, offset long"
    )
