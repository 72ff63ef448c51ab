"""Exact duplicates with a two-pass Bloom filter.

Texts are equal when identical after folding A-Z to a-z; null counts as empty. Of equal
texts the row with the largest doc_id stays.

Pass one sets ``probes`` bits per row and remembers which bits were set at least twice.
Pass two tests every row: if one of its bits was set once only, no other row has its
hash, and the row goes straight to the result. All others, the true copies and the few
that collide by chance, are shuffled by their SHA-256 and decided exactly.

The filter is ``bits_per_row`` bits for each row, a power of two, and never more than
``most_bits`` (32 MiB as broadcast bytes). Beyond that it lets more rows through to the
shuffle; the result is the same. Tasks send their bits as sorted positions of 64 K-bit
blocks, and blocks are combined by key, so no task or driver sees rows or hashes of the
whole table; the driver passes on the bounded filter only.

Defined cases: null doc_id is smaller than any other; a group of only such rows has a
null keep_id and keeps one. Rows that repeat a (doc_id, text) are separate documents of
which one is kept. An empty table gives an empty result. Other columns pass through;
columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.plans.scratch import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ("keep_id", "group_size", "kept", "text_sha256")
BLOCK_BITS = 1 << 16
MOST_BITS = 1 << 28


def normalised(text: str | Column) -> Column:
    """Null as empty, A-Z folded, all else as it is."""
    c = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(c, F.lit("")), UPPER, LOWER)


def _probe_bits(h: np.ndarray, probes: int, bits: int) -> np.ndarray:
    """(rows, probes) bit positions from the two halves of a 64-bit hash."""
    x = h.view(np.uint64)
    step = (x >> np.uint64(32)) | np.uint64(1)
    k = np.arange(probes, dtype=np.uint64)
    mixed = x[:, None] + k[None, :] * (step[:, None] * np.uint64(0x9E3779B97F4A7C15))
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - int(bits).bit_length() + 1)).astype(np.int64)


def _task_bits(probes: int, bits: int) -> Callable:
    """Per batch: for each block the distinct positions, and those set by more than one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.sort(_probe_bits(h, probes, bits), axis=1)
            fresh = np.ones(at.shape, bool)
            fresh[:, 1:] = at[:, 1:] != at[:, :-1]  # a row counts once for a bit
            position, count = np.unique(at[fresh], return_counts=True)
            block = position // BLOCK_BITS
            ids, begin = np.unique(block, return_index=True)
            edges = np.append(begin, len(position))
            once = [(position[a:b] % BLOCK_BITS).astype("<u2").tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            twice = [
                (position[a:b][count[a:b] > 1] % BLOCK_BITS).astype("<u2").tobytes()
                for a, b in zip(edges, edges[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                names=["block", "once", "twice"],
            )

    return run


def _join_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    count = np.zeros(BLOCK_BITS, np.uint8)
    for once, twice in zip(rows["once"], rows["twice"], strict=True):
        seen = np.frombuffer(once, "<u2")
        count[seen] = np.minimum(count[seen] + 1, 2)
        count[np.frombuffer(twice, "<u2")] = 2
    full = np.packbits(count > 1).tobytes()
    return pd.DataFrame({"block": rows["block"].iloc[:1].to_numpy(), "full": [full]})


def repeated_bits(
    rows: DataFrame, probes: int, bits_per_row: int, most_bits: int
) -> tuple[np.ndarray, int]:
    """The bitmap of bits that at least two rows of ``rows`` (h long) set, and its size in bits."""
    n = rows.count()
    bits = min(max(BLOCK_BITS, 1 << (max(1, n * bits_per_row) - 1).bit_length()), most_bits)
    blocks = (
        rows.mapInArrow(_task_bits(probes, bits), "block long, once binary, twice binary")
        .groupBy("block")
        .applyInPandas(_join_blocks, "block long, full binary")
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    for r in blocks.collect():
        a = r["block"] * (BLOCK_BITS // 8)
        bitmap[a : a + BLOCK_BITS // 8] = np.frombuffer(r["full"], np.uint8)
    return bitmap, bits


def _decided(docs: DataFrame, probes: int, bits_per_row: int, most_bits: int) -> DataFrame:
    """``docs`` and the added columns, their names led by two underscores."""
    sha = F.sha2(normalised("text"), 256)
    hashed = F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")
    bitmap, bits = repeated_bits(docs.select(hashed.alias("h")), probes, bits_per_row, most_bits)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def maybe_repeated(h: pd.Series) -> pd.Series:
        at = _probe_bits(h.to_numpy(np.int64), probes, bits)
        hit = shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1
        return pd.Series(hit.all(axis=1))

    tested = docs.withColumn("__text_sha256", sha)
    tested = tested.withColumn(
        "__maybe", maybe_repeated(F.conv(F.substring("__text_sha256", 1, 15), 16, 10).cast("long"))
    )
    alone = tested.where("not __maybe").select(
        *docs.columns,
        F.col("doc_id").alias("__keep_id"),
        F.lit(1).cast("long").alias("__group_size"),
        F.lit(True).alias("__kept"),
        "__text_sha256",
    )
    rest = tested.where("__maybe").drop("__maybe")
    groups = rest.groupBy("__text_sha256").agg(
        F.max("doc_id").alias("__keep_id"), F.count("*").alias("__group_size")
    )
    # written: small tables are broadcast, large ones get a shuffle of their own, so that
    # Spark can split the partition of a text with very many copies
    folder = scratch_dir(docs.sparkSession, "repeats")
    groups.write.parquet(folder)
    groups = docs.sparkSession.read.schema(groups.schema).parquet(folder)
    same = Window.partitionBy("__text_sha256", "doc_id").orderBy("doc_id")
    decided = rest.withColumn("__nth", F.row_number().over(same)).join(groups, "__text_sha256")
    kept = F.col("doc_id").eqNullSafe(F.col("__keep_id")) & (F.col("__nth") == 1)
    return alone.unionByName(decided.withColumn("__kept", kept).drop("__nth"))


def mark_repeats(
    docs: DataFrame,
    probes: int = 4,
    bits_per_row: int = 16,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256."""
    found = _decided(docs, probes, bits_per_row, most_bits)
    own = [c for c in docs.columns if c not in ADDED]
    return found.select(*own, *(F.col(f"__{c}").alias(c) for c in ADDED))


def without_repeats(
    docs: DataFrame,
    probes: int = 4,
    bits_per_row: int = 16,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return _decided(docs, probes, bits_per_row, most_bits).where("__kept").select(*docs.columns)
