"""Bit arrays of bounded size for membership by 64-bit hash, made on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each hash, and in all: 32 MB.
BITS_EACH, MOST_BITS = 16, 1 << 28
_CHUNK_BITS = 1 << 18
#: Places that a task holds before it hands them on.
_HELD_PLACES = 1 << 22


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def may_hold(packed: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set: true by mistake at times, never false for a member."""
    out = np.ones(len(h), bool)
    for place in _places(h, bits):
        out &= (packed[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def _set_bits(step: int) -> Callable[[pa.Table], pa.Table]:
    """Map a group of (chunk, place) to the chunk's bytes."""

    def run(table: pa.Table) -> pa.Table:
        packed = np.zeros(step, bool)
        packed[table.column("place").to_numpy()] = True
        blob = np.packbits(packed, bitorder="little").tobytes()
        return pa.table({"chunk": table.column("chunk")[:1], "blob": pa.array([blob], pa.binary())})

    return run


def _size(count: int) -> tuple[int, int]:
    """Bits for about ``count`` hashes, and of these in a chunk."""
    bits = 1 << 13
    while bits < BITS_EACH * count and bits < MOST_BITS:
        bits *= 2
    return bits, min(_CHUNK_BITS, bits)


def _put_together(chunks: DataFrame, bits: int, step: int) -> Broadcast:
    packed = np.zeros(bits // 8, np.uint8)
    for r in chunks.collect():  # no more than the bits in all
        at = r["chunk"] * step // 8
        packed[at : at + step // 8] = np.frombuffer(r["blob"], np.uint8)
    return chunks.sparkSession.sparkContext.broadcast(packed.tobytes())


def build(hashes: DataFrame, count: int) -> tuple[Broadcast, int]:
    """The broadcast bytes and the number of bits for about ``count`` rows (h long).

    When there are more than the largest array is made for, it lets more through.
    """
    bits, step = _size(count)
    places = hashes.select(
        F.explode(F.array(F.expr(f"h & {bits - 1}"), F.expr(f"shiftrightunsigned(h, 32) & {bits - 1}"))).alias("p")
    )
    chunks = (
        places.select(F.expr(f"p div {step}").alias("chunk"), F.expr(f"cast(p % {step} as int)").alias("place"))
        .distinct()
        .groupBy("chunk")
        .applyInArrow(_set_bits(step), "chunk long, blob binary")
    )
    return _put_together(chunks, bits, step), bits


def _places_by_chunk(bits: int, step: int) -> Callable:
    """Map lists of hashes to (chunk, places): a task's places, twice those that it met more than once."""

    def met(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        place, count = np.unique(np.concatenate(held), return_counts=True)
        place = np.repeat(place, np.minimum(count, 2)).astype(np.int64)
        chunk, begin = np.unique(place // step, return_index=True)
        ends = pa.array(np.append(begin, len(place)), pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array((place % step).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(chunk), lists], names=["chunk", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held += _places(batch.column("hashes").flatten().to_numpy().view(np.uint64), bits)
            if sum(map(len, held)) >= _HELD_PLACES:
                yield from met(held)
                held = []
        if held:
            yield from met(held)

    return run


def _met_twice(step: int) -> Callable[[pa.Table], pa.Table]:
    """Map a group of (chunk, places) to the bytes of the places that are there more than once."""

    def run(table: pa.Table) -> pa.Table:
        count = np.zeros(step, np.int64)
        for part in table.column("places").chunks:
            count += np.bincount(part.flatten().to_numpy(), minlength=step)
        blob = np.packbits(count > 1, bitorder="little").tobytes()
        return pa.table({"chunk": table.column("chunk")[:1], "blob": pa.array([blob], pa.binary())})

    return run


def build_repeated(lists: DataFrame, count: int) -> tuple[Broadcast, int]:
    """Like :func:`build`, for the hashes that more than one of the rows (hashes array<long>) hold.

    ``count`` is about that of the hashes in all lists, each of which has a hash once. No
    hash becomes a row: a task hands on arrays of places, at most two for each place.
    """
    bits, step = _size(count)
    chunks = (
        lists.select("hashes")
        .mapInArrow(_places_by_chunk(bits, step), "chunk long, places array<int>")
        .groupBy("chunk")
        .applyInArrow(_met_twice(step), "chunk long, blob binary")
    )
    return _put_together(chunks, bits, step), bits
