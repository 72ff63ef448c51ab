"""Phrase collocations by exact n-gram counts in counting quotient filters.

A word's id is a 64-bit hash. The table of all words shows whether two words of a language
share an id; if any do, the ids are drawn anew with the next seed, so counts by id are
counts by word. Each size of phrase is one pass over the texts:

1. words, counted with their text; they give the ids and the frequent words;
2. pairs of frequent words;
3. triples of which both pairs are frequent.

A task packs the ids of an n-gram and permutes them invertibly: the first id is masked by a
hash of the others and mixed, the others stay. The top bits of the result are the block and
the quotient, the rest of its bits and the other ids are the remainder, kept in full. A
filter holds the remainders of a block sorted by quotient, the length of each quotient's
run, and counters of a byte that overflow into a list. It is lossless: ids and counts are
read back from it. The filters of all tasks for a block are merged in one place, where the
n-grams that occur often enough are read out. Blocks are as many as keep a merge small, and
a frequent n-gram has one entry in each filter, so no group is hot.

Which words or pairs are frequent reaches the tasks as a bit array of at most
``bit_filter.MOST_BITS`` bits. What it lets through by mistake is counted and then found to be rare; nothing that is
frequent is missed. When it is full, passes 2 and 3 only count more.

Defined cases: null text is empty, null lang is ``und``; repeated rows count as often as they
occur; words and pieces are taken from whole texts; doc_id and other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.llm import bit_filter, words
from idweave.llm.known_spans import KnownSpans
from idweave.plans.scratch import scratch_dir

LEAST, INSIDE_PERCENT, TOP = 10, 50, 2000
NO_LANG = "und"
#: Entries a task gathers before it hands them on, and about the most in a merge.
FLUSH_ENTRIES, MERGE_ENTRIES = 1_500_000, 1_000_000
FLUSH_WORDS = 400_000

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_MUL = 0xD6E8FEB86659FD93  # that of words.mix
_UNMUL = np.uint64(pow(_MUL, -1, 1 << 64))
_HALF = np.uint64(32)
_LANG_SEED = 1 << 20


def codes_of(seed: int) -> np.ndarray:
    """A random code for each byte, the same for both cases of A-Z."""
    return np.random.default_rng([20250117, seed]).integers(1, 1 << 63, 256, dtype=np.uint64)[_FOLD]


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of :func:`words.mix`."""
    x = (x ^ (x >> _HALF)) * _UNMUL
    x = (x ^ (x >> _HALF)) * _UNMUL
    return x ^ (x >> _HALF)


def _mask(rest: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(rest[0]), 0x9E3779B97F4A7C15, np.uint64)
    for ids in reversed(rest):
        total = words.mix(ids + total * np.uint64(3))
    return total


def permuted(ids: list[np.ndarray]) -> np.ndarray:
    """The first id of each n-gram, moved by a bijection that depends on the others."""
    return words.mix(ids[0] ^ _mask(ids[1:]))


def restored(top: np.ndarray, rest: list[np.ndarray]) -> np.ndarray:
    """The first ids, from the permuted ones and the others."""
    return unmix(top) ^ _mask(rest)


def in_pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text and piece of every word. Pieces are numbered through all texts."""
    inside = ~_APART[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(at, starts, side="right") - 1
    return starts, ends, text, np.cumsum(_BREAK[data])[starts] + text


def encode_filter(block_bits: int, top: np.ndarray, rest: list[np.ndarray], count: np.ndarray) -> bytes:
    """A counting quotient filter of entries of one block, sorted by ``top``."""
    n = len(top)
    quotient_bits = min(max(0, n.bit_length() - 1), 64 - block_bits, 24)
    left = 64 - block_bits - quotient_bits
    width = -(-left // 8)
    own = top & np.uint64((1 << (64 - block_bits)) - 1)
    quotient = (own >> np.uint64(left)).astype(np.int64) if left < 64 else np.zeros(n, np.int64)
    runs = np.bincount(quotient, minlength=1 << quotient_bits)
    size = next(s for s in (1, 2, 4) if int(runs.max()) < 1 << (8 * s))
    remainder = (own & np.uint64((1 << left) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    over = count[count >= 255]
    return b"".join(
        [
            struct.pack("<IIBBB", n, len(over), block_bits, quotient_bits, size),
            runs.astype(f"<u{size}").tobytes(),
            remainder.tobytes(),
            *(ids.astype("<u8").tobytes() for ids in rest),
            np.minimum(count, 255).astype(np.uint8).tobytes(),
            over.astype("<i8").tobytes(),
        ]
    )


def decode_filter(block: int, size: int, blob: bytes) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Entries of a filter of n-grams of ``size`` words: top, the other ids, count."""
    n, n_over, block_bits, quotient_bits, run_size = struct.unpack_from("<IIBBB", blob)
    place = struct.calcsize("<IIBBB")

    def take(kind: str, items: int) -> np.ndarray:
        nonlocal place
        got = np.frombuffer(blob, kind, items, place)
        place += got.nbytes
        return got

    left = 64 - block_bits - quotient_bits
    width = -(-left // 8)
    runs = take(f"<u{run_size}", 1 << quotient_bits)
    padded = np.zeros((n, 8), np.uint8)
    padded[:, :width] = take("u1", n * width).reshape(n, width)
    own = padded.view("<u8").ravel().astype(np.uint64)
    if left < 64:
        own = own | (np.repeat(np.arange(len(runs)), runs).astype(np.uint64) << np.uint64(left))
    if block_bits:
        own = own | np.uint64(block << (64 - block_bits))
    rest = [take("<u8", n).astype(np.uint64) for _ in range(size - 1)]
    count = take("u1", n).astype(np.int64)
    count[count == 255] = take("<i8", n_over)
    return own, rest, count


def merged(top: np.ndarray, rest: list[np.ndarray], count: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Equal entries added up, sorted."""
    if not len(top):
        return top, rest, count
    order = np.lexsort([*reversed(rest), top])
    top, count, rest = top[order], count[order], [ids[order] for ids in rest]
    new = np.ones(len(top), bool)
    new[1:] = top[1:] != top[:-1]
    for ids in rest:
        new[1:] |= ids[1:] != ids[:-1]
    begin = np.flatnonzero(new)
    return top[begin], [ids[begin] for ids in rest], np.add.reduceat(count, begin)


def _lang_salt(lang: str) -> np.uint64:
    """A hash of the language that no word has by its own spelling."""
    data = np.frombuffer(f"{lang} ".encode(), np.uint8)
    return words.mix(words.hashes(data, np.array([0]), np.array([len(data)]), codes_of(_LANG_SEED)))[0]


def _each_slice(batches: Iterator[pa.RecordBatch], codes: np.ndarray) -> Iterator[tuple]:
    """(lang names, bytes, starts, ends, ids, piece, language number of each word) by slice."""
    for batch in batches:
        langs, texts = batch.column("lang"), batch.column("text")
        for i, j in words.slices(texts):
            data, at = words.as_bytes(texts.slice(i, j - i))
            starts, ends, text, piece = in_pieces(data, at)
            coded = langs.slice(i, j - i).fill_null(NO_LANG).dictionary_encode()
            number = coded.indices.to_numpy(zero_copy_only=False)[text]
            yield coded.dictionary.to_pylist(), data, starts, ends, words.hashes(data, starts, ends, codes), piece, number


def _count_words(seed: int) -> Callable:
    """Map batches of (lang, text) to (lang, id, word, n), few rows for each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = codes_of(seed)
        known = KnownSpans()
        names: list[str] = []
        spans: list[bytes] = []
        ids = np.zeros(0, np.uint64)
        counts = np.zeros(0, np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(ids.view(np.int64)), pa.array(spans, pa.binary()).cast(pa.string()), pa.array(counts)],
                names=["lang", "id", "word", "n"],
            )

        for langs, data, starts, ends, h, _, number in _each_slice(batches, codes):
            salt = np.array([_lang_salt(x) for x in langs], np.uint64)
            keyed = words.mix(h ^ salt[number]) if len(h) else h
            place = known.find(keyed)
            missing = np.flatnonzero(place < 0)
            if len(missing):
                kinds, where = np.unique(keyed[missing], return_index=True)
                where = missing[where]
                low = data.tobytes().lower()
                spans += [low[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
                names += [langs[k] for k in number[where].tolist()]
                ids = np.concatenate([ids, h[where]])
                counts = np.concatenate([counts, np.zeros(len(where), np.int64)])
                known.add(kinds)
                place[missing] = known.find(keyed[missing])
            counts += np.bincount(place, minlength=len(counts))
            if len(counts) > FLUSH_WORDS:
                yield rows()
                known.clear()
                names, spans, ids, counts = [], [], ids[:0], counts[:0]
        if len(counts):
            yield rows()

    return run


def _count_ngrams(size: int, seed: int, block_bits: int, frequent: Broadcast, bits: int) -> Callable:
    """Map batches of (lang, text) to filters of the n-grams whose shorter parts may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = codes_of(seed)
        packed = np.frombuffer(frequent.value, np.uint8)
        held: dict[str, list[tuple]] = {}
        entries = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                top, rest, count = merged(
                    np.concatenate([p[0] for p in parts]),
                    [np.concatenate([p[1][k] for p in parts]) for k in range(size - 1)],
                    np.concatenate([p[2] for p in parts]),
                )
                block = (top >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(top), np.int64)
                cut = np.flatnonzero(np.diff(block)) + 1
                ranges = list(zip([0, *cut.tolist()], [*cut.tolist(), len(top)], strict=True))
                blobs = [encode_filter(block_bits, top[a:b], [x[a:b] for x in rest], count[a:b]) for a, b in ranges]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(blobs), pa.string()),
                        pa.array(block[[a for a, _ in ranges]], pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["lang", "block", "filter"],
                )
            held.clear()

        for langs, _, _, _, h, piece, number in _each_slice(batches, codes):
            if len(h) < size:
                continue
            salt = np.array([_lang_salt(x) for x in langs], np.uint64)[number]
            if size == 2:
                often = bit_filter.may_hold(packed, bits, words.mix(h ^ salt))
                use = often[:-1] & often[1:]
            else:
                often = bit_filter.may_hold(packed, bits, words.mix(permuted([h[:-1], h[1:]]) ^ salt[:-1]))
                use = often[:-1] & often[1:]
            use &= piece[: len(use)] == piece[size - 1 :]
            at = np.flatnonzero(use)
            for k, lang in enumerate(langs):
                i = at[number[at] == k]
                if len(i):
                    ids = [h[i + step] for step in range(size)]
                    part = merged(permuted(ids), ids[1:], np.ones(len(i), np.int64))
                    held.setdefault(lang, []).append(part)
                    entries += len(part[0])
            if entries > FLUSH_ENTRIES:
                yield from flush()
                entries = 0
        yield from flush()

    return run


def _merge_filters(size: int, least: int) -> Callable:
    """Map the filters of a language's block to its frequent n-grams (lang, w1, w2, .., f)."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        parts = [decode_filter(block, size, x.as_py()) for x in table.column("filter")]
        top, rest, count = merged(
            np.concatenate([p[0] for p in parts]),
            [np.concatenate([p[1][k] for p in parts]) for k in range(size - 1)],
            np.concatenate([p[2] for p in parts]),
        )
        keep = count >= least
        rest = [ids[keep] for ids in rest]
        ids = [restored(top[keep], rest), *rest]
        lang = table.column("lang")[0].as_py()
        return pa.table(
            {"lang": pa.array([lang] * len(ids[0]), pa.string())}
            | {f"w{k + 1}": pa.array(x.view(np.int64)) for k, x in enumerate(ids)}
            | {"f": pa.array(count[keep])}
        )

    return run


def _hashed(size: int) -> Callable:
    """Map frequent words or pairs to the hash that tasks look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(f"w{k + 1}").to_numpy().view(np.uint64) for k in range(size)]
            coded = batch.column("lang").dictionary_encode()
            salt = np.array([_lang_salt(x) for x in coded.dictionary.to_pylist()], np.uint64)
            number = coded.indices.to_numpy()
            h = ids[0] if size == 1 else permuted(ids)
            h = words.mix(h ^ salt[number]) if len(h) else h
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return run


def _frequent_bits(frequent: DataFrame, size: int) -> tuple[Broadcast, int]:
    """The bit array of frequent words or pairs, broadcast; its size is bounded."""
    hashed = frequent.select("lang", *(f"w{k + 1}" for k in range(size))).mapInArrow(_hashed(size), "h long")
    return bit_filter.build(hashed, frequent.count())


def collocations(
    docs: DataFrame, least: int = LEAST, inside_percent: int = INSIDE_PERCENT, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases."""
    spark = docs.sparkSession
    base = scratch_dir(spark, "collocations")

    def staged(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    source = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    seed = 0
    while True:
        counted = source.mapInArrow(_count_words(seed), "lang string, id long, word string, n long")
        table = staged(f"words-{seed}", counted.groupBy("lang", "id", "word").agg(F.sum("n").alias("f")))
        if table.groupBy("lang", "id").agg(F.count("*").alias("words")).where("words > 1").isEmpty():
            break
        seed += 1
    per_lang = staged("languages", table.groupBy("lang").agg(F.sum("f").alias("n")))
    all_words = per_lang.agg(F.sum("n")).first()[0] or 0
    block_bits = max(0, (all_words // MERGE_ENTRIES).bit_length())
    uni = staged("frequent-1", table.where(F.col("f") >= least).select("lang", F.col("id").alias("w1"), "word", "f"))

    def frequent_ngrams(size: int, parts: DataFrame) -> DataFrame:
        bits, n_bits = _frequent_bits(parts, size - 1)
        filters = source.mapInArrow(
            _count_ngrams(size, seed, block_bits, bits, n_bits), "lang string, block long, filter binary"
        )
        columns = ", ".join(f"w{k + 1} long" for k in range(size))
        rows = filters.groupBy("lang", "block").applyInArrow(_merge_filters(size, least), f"lang string, {columns}, f long")
        return staged(f"frequent-{size}", rows)

    bi = frequent_ngrams(2, uni)
    tri = frequent_ngrams(3, bi)

    def word(k: int) -> DataFrame:
        return uni.select("lang", F.col("w1").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("f").alias(f"f{k}"))

    def pair(i: int, j: int) -> DataFrame:
        return bi.select("lang", F.col("w1").alias(f"w{i}"), F.col("w2").alias(f"w{j}"), F.col("f").alias(f"f{i}{j}"))

    def score(a: str, left: str, right: str) -> str:
        exact = "cast({} as decimal(38,0))"
        return f"({exact.format(1_000_000)} * {a} * {a}) div ({exact.format(left)} * {right})"

    parts = tri.select("lang", "w1", "w2", "f").unionByName(
        tri.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f")
    )
    around = parts.groupBy("lang", "w1", "w2").agg(F.max("f").alias("around"))
    pairs = (
        bi.join(around, ["lang", "w1", "w2"], "left")
        .where(f"around is null or 100 * around < {inside_percent} * f")
        .join(word(1), ["lang", "w1"])
        .join(word(2), ["lang", "w2"])
        .selectExpr("lang", "concat_ws(' ', word1, word2) as phrase", "f as a", "f1 as l", "f2 as r")
        .withColumn("score", F.expr(score("a", "l", "r")))
    )
    both_cuts = (
        tri.join(word(1), ["lang", "w1"])
        .join(pair(2, 3), ["lang", "w2", "w3"])
        .join(pair(1, 2), ["lang", "w1", "w2"])
        .join(word(2).drop("f2"), ["lang", "w2"])
        .join(word(3), ["lang", "w3"])
        .withColumns({"after_1": F.expr(score("f", "f1", "f23")), "after_2": F.expr(score("f", "f12", "f3"))})
    )
    triples = both_cuts.selectExpr(
        "lang",
        "concat_ws(' ', word1, word2, word3) as phrase",
        "f as a",
        "if(after_1 <= after_2, f1, f12) as l",
        "if(after_1 <= after_2, f23, f3) as r",
        "least(after_1, after_2) as score",
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(per_lang, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
