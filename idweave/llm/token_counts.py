"""Token counts of whole texts by a byte-level BPE tokenizer.

Texts are cut where the tokenizer's own pattern always cuts: before white space that
follows a character other than white space. No token reaches over such a place and no
look-ahead sees past it, so the count of a text is the sum over its parts, however long
the text is. Most parts are words that came before; a worker remembers the counts of
those it has seen, by a 64-bit hash of their bytes. New parts go to the tokenizer in
batches of about equal bytes, and only the lengths of its answers are kept.

Defined cases: null text is empty, an empty text has no tokens; special strings in a text
are handled as the tokenizer does by default; repeated rows and rows with a null doc_id are
rows of their own; a text without white space is one part. Columns other than doc_id and
text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm import words
from idweave.llm.known_spans import KnownSpans

LIMIT = 1024
BATCH_BYTES = 1 << 17
#: Parts a worker remembers; beyond that it starts anew.
MOST_PARTS = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CODES = np.random.default_rng(20240911).integers(1, 1 << 63, 256, dtype=np.uint64)


def safe_parts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every part, and per text the index of its first part (n + 1 long).

    The parts of a text cover it. White space beyond ASCII is no place to cut, nor is
    anything right after it: a run of white space is one match of the pattern.
    """
    space = _SPACE[data]
    i = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    one, two, three = (np.where(i >= k, data[np.maximum(i - k, 0)], 0) for k in (1, 2, 3))
    wide = (
        ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
        | ((three == 0xE1) & ((two == 0x9A) | (two == 0xA0)))
        | ((three == 0xE2) & ((two == 0x80) | (two == 0x81)))
        | ((three == 0xE3) & (two == 0x80))
    )
    unsafe = ((one >= 0x1C) & (one < 0x20)) | ((one >= 0x80) & wide)
    cut = np.zeros(len(data), bool)
    cut[i[~unsafe]] = True
    cut[at[:-1][at[:-1] < at[1:]]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    return starts, ends, np.searchsorted(starts, at)


def balanced(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of consecutive items with about equal sums of sizes, no more than ``most`` or one item."""
    total = int(sizes.sum())
    if not total:
        return [(0, len(sizes))] if len(sizes) else []
    share = total / -(-total // most)
    end = np.cumsum(sizes)
    number = ((end - 1) / share).astype(np.int64)
    cut = np.flatnonzero(np.diff(number)) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(sizes)], strict=True))


class PartCounts:
    """Token counts by part, remembered."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # bytes that each token stands for: its name has a character for each
        self.token_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.token_bytes[i] = len(token)
        self.known = KnownSpans()
        self.counts = np.zeros(0, np.int64)

    def _encode(self, parts: list[bytes], sizes: np.ndarray, joins: np.ndarray) -> np.ndarray:
        """Tokens of each part. Those that can follow each other are one text, cut by the tokens' bytes."""
        out = np.full(len(parts), -1, np.int64)
        some = np.flatnonzero(joins)
        for a, b in balanced(sizes[some], BATCH_BYTES):
            which = some[a:b]
            text = b"".join([parts[i] for i in which.tolist()]).decode("utf-8")
            (got,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            reached = np.concatenate([[0], np.cumsum(self.token_bytes[np.array(got.ids, np.int64)])])
            ends = np.concatenate([[0], np.cumsum(sizes[which])])
            at = np.searchsorted(reached, ends)
            if at[-1] == len(got) and np.array_equal(reached[at], ends):
                out[which] = np.diff(at)
        rest = np.flatnonzero(out < 0)
        for a, b in balanced(sizes[rest], BATCH_BYTES):
            which = rest[a:b]
            texts = [parts[i].decode("utf-8") for i in which.tolist()]
            got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            out[which] = [len(e) for e in got]
        return out

    def of(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; null is empty."""
        totals = []
        for i, j in words.slices(texts):
            data, at = words.as_bytes(texts.slice(i, j - i))
            starts, ends, first = safe_parts(data, at)
            h = words.hashes(data, starts, ends, _CODES)
            if self.known.count > MOST_PARTS:
                self.known.clear()
                self.counts = np.zeros(0, np.int64)
            number = self.known.find(h)
            missing = np.flatnonzero(number < 0)
            if len(missing):
                kinds, where = np.unique(h[missing], return_index=True)
                a, b = starts[missing[where]], ends[missing[where]]
                blob = data.tobytes()
                parts = [blob[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                last = data[b - 1]
                joins = _SPACE[data[a]] & (last > 0x20) & (last < 0x7F)
                self.counts = np.concatenate([self.counts, self._encode(parts, b - a, joins)])
                self.known.add(kinds)
                number[missing] = self.known.find(h[missing])
            sums = np.concatenate([[0], np.cumsum(self.counts[number])])
            totals.append(sums[first[1:]] - sums[first[:-1]])
        return np.concatenate([np.zeros(0, np.int64), *totals])


def _of_this_worker(path: str) -> PartCounts:
    """The worker's own :class:`PartCounts`, kept from task to task."""
    kept = sys.modules.setdefault("_task_part_counts", ModuleType("_task_part_counts"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.counts = path, PartCounts(path)
    return kept.counts


def _count(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _of_this_worker(path)
        for batch in batches:
            texts = batch.column("text")
            n_bytes = np.zeros(0, np.int64)
            if len(texts):
                n_bytes = np.diff(words.as_bytes(texts)[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(counts.of(texts), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row of ``docs`` (doc_id, text)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = source.mapInArrow(_count(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
