"""Word splitting and hashing of whole Arrow batches with numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Texts are handled in
slices of a few megabytes, so memory follows the longest single text, not the batch.
Hashes are 64-bit, fixed by a constant seed, and fold A-Z to a-z only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_rng = np.random.default_rng(20240607)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)[_FOLD]
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_UNBASE = pow(_BASE, -1, 1 << 64)
_PLACES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset of each; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    _, at = as_bytes(texts)
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(at, at[i] + most, side="right")) - 1
        j = min(max(j, i + 1), len(texts))
        yield i, j
        i = j


def split(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and per text the index of its first word (n + 1 long)."""
    inside = ~_SEPARATOR[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and its inverse; those for one slice are kept, longer ones are not."""
    if _powers and n <= len(_powers[0][0]):
        return _powers[0]
    both = []
    for base in (_BASE, _UNBASE):
        p = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        p[0] = 1
        both.append(np.cumprod(p, dtype=np.uint64))
    if not _powers and n <= SLICE_BYTES + 1:
        _powers.append((both[0], both[1]))
    return both[0], both[1]


def hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = _BYTE_CODE
) -> np.ndarray:
    """A 64-bit hash of each span of bytes; with the usual codes of a byte A-Z is folded."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:], dtype=np.uint64)
    polynomial = (sums[ends] - sums[starts]) * down[starts]
    return mix(polynomial + (ends - starts).astype(np.uint64) * _PLACES[63])


def windows(
    word: np.ndarray, first: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words per text, and per text the index of its first.

    A text with fewer words, but one at least, has a single run: all its words.
    """
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    padded = np.concatenate([word, np.zeros(size, np.uint64)])
    start = np.repeat(first[:-1] - at[:-1], count) + np.arange(at[-1])
    length = np.repeat(np.minimum(n, size), count)
    total = length.astype(np.uint64) * _PLACES[62]
    for k in range(size):
        part = mix(padded[start + k] * _PLACES[k] + _PLACES[k + 31])
        total += np.where(k < length, part, np.uint64(0))
    return mix(total), at
