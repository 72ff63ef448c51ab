"""Similar texts by the Jaccard similarity of their word shingles, with token groups.

Two documents link when their shingle sets have similarity ``percent`` / 100 or more.
The result has a row per document with the size of its set and the smallest doc_id it
can reach over links. Documents with the same set are one class from the start, so
copies cost a row each and never a pair.

Steps:

1. Every set is a sorted array of 64-bit hashes. Its leading part, the prefix, is long
   enough that two similar sets share at least ``need`` hashes of their prefixes. A
   class with fewer prefix hashes in common with other classes links with nothing.
   Only the rest, the candidates, take part in what follows. Hashes that more than one
   class holds are found by one aggregate; a bit array of bounded size then keeps the
   others from being shuffled again.
2. Candidates are partitioned into groups of similar sets: each goes to the class that is
   the smallest holder of most of its prefix hashes, and those of a class are cut into
   cells of bounded size, each with a copy of that class. All links within a cell come
   from a product of its token matrix. This joins whole families of near copies, and
   settles families of near misses, without a row for any pair. The same task returns
   the union of the prefixes of each family in its cell.
3. What is left are links between cells of different components. The token-group matrix
   has a row (hash, cell) for each hash in the union of a cell's sets. A set's overlap
   with the hashes that other cells hold too bounds its overlap with any of them: only
   sets of which four fifths are there stay active, and only their unions stay in the
   matrix; a hash within one component says nothing. A bit array of what more than one
   union holds keeps the hashes of a single cell from becoming rows. Two cells are opened to each other only if they have enough prefix hashes in
   common; there a query's overlap with the union of the other cell bounds its overlap
   with any member, and the exact overlaps of those that pass decide.

Sets are read from the texts once more when it is known where they belong, so they lie in
their cells after one shuffle.

Defined cases: null or empty text and text without words: empty set, no link, own
component. Null doc_id: never the smallest; a component of such rows has a null
component_id. Repeated rows are documents of one class. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.llm import bit_filter, words
from idweave.llm.components import components
from idweave.plans.scratch import scratch_dir

SIZE, PERCENT = 5, 80
#: Chunks hold about so many sets and hashes.
CHUNK_SETS, CHUNK_HASHES = 768, 1_500_000
#: Rows of a narrow side that may be broadcast: 50 bytes each at most, so 12 MB.
BROADCAST_ROWS = 250_000
_COLUMN_BLOCK = 4096


def least_overlap(n, percent: int = PERCENT):
    """Hashes that a set of ``n`` shares with any similar set, at least."""
    return -(-n * percent // 100)


def slack(n):
    return n // 10 + (n < 10)


def prefix_length(n, percent: int = PERCENT):
    return n - least_overlap(n, percent) + slack(n)


def needed(n, percent: int = PERCENT):
    """Hashes that the prefixes of similar sets share, at least."""
    least = least_overlap(n, percent)
    return least // 10 + (least < 10)


def _sql_need(percent: int) -> str:
    least = f"cast(ceil(n * {percent} / 100) as bigint)"
    return f"(({least}) div 10 + if(({least}) < 10, 1, 0))"


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for i, j in words.slices(texts):
        data, at = words.as_bytes(texts.slice(i, j - i))
        starts, ends, first = words.split(data, at)
        run, begin = words.windows(words.hashes(data, starts, ends), first, size)
        run = run.view(np.int64)
        for k in range(j - i):
            own = np.sort(run[begin[k] : begin[k + 1]])
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            yield own[new]


def _set_keys(values: np.ndarray, begin: np.ndarray) -> list[bytes | None]:
    """128 bits that stand for a set; None for the empty one."""
    sums = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(words.mix(values.view(np.uint64) ^ np.uint64(salt)), out=total[1:])
        sums.append(total[begin[1:]] - total[begin[:-1]])
    both = np.stack(sums, axis=1).astype("<u8")
    empty = begin[1:] == begin[:-1]
    return [None if e else row.tobytes() for e, row in zip(empty, both, strict=True)]


def _set_batches(size: int, percent: int, whole: bool) -> Callable:
    """Map batches of (doc_id, text) to sets: doc_id, key, cid, n and the hashes or their prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in words.slices(batch.column("text")):
                ids, texts = (batch.column(c).slice(i, j - i) for c in ("doc_id", "text"))
                sets = list(shingle_sets(texts, size))
                n = np.array([len(s) for s in sets], np.int64)
                begin = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
                flat = np.concatenate([np.zeros(0, np.int64), *sets])
                keys = _set_keys(flat, begin)
                cid = [None if k is None else int.from_bytes(k[:8], "little", signed=True) for k in keys]
                if not whole:
                    lengths = np.where(n > 0, prefix_length(n, percent), 0)
                    flat = np.concatenate(
                        [np.zeros(0, np.int64), *(s[:m] for s, m in zip(sets, lengths, strict=True))]
                    )
                    begin = np.concatenate([[0], np.cumsum(lengths)])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(keys, pa.binary()),
                        pa.array(cid, pa.int64()),
                        pa.array(n),
                        pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(flat)),
                    ],
                    names=["doc_id", "key", "cid", "n", "hashes"],
                )

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, as a product of the 0/1 matrix over shared hashes."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values, column, count = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    shared = count > 1
    place = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], place[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((m, m), np.float32)
    for low in range(0, int(shared.sum()), _COLUMN_BLOCK):
        a, b = np.searchsorted(column, [low, low + _COLUMN_BLOCK])
        block = np.zeros((m, _COLUMN_BLOCK), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        out += block @ block.T
    return out.astype(np.int64)


def _spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a forest with the components of a symmetric boolean matrix."""
    edges, seen = [], np.zeros(len(linked), bool)
    for root in range(len(linked)):
        if seen[root]:
            continue
        seen[root] = True
        queue = [root]
        while queue:
            i = queue.pop()
            fresh = np.flatnonzero(linked[i] & ~seen)
            seen[fresh] = True
            edges += [(i, int(j)) for j in fresh]
            queue += fresh.tolist()
    return edges


def links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``."""
    if len(sets) < 2:
        return []
    n = np.array([len(s) for s in sets], np.int64)
    common = _overlaps(sets)
    linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    np.fill_diagonal(linked, False)
    return _spanning(linked)


def links_across(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two lists of sets, as indices into either.

    Only hashes of both unions matter; a set with too few of them has no partner.
    """
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for sets in (left, right):
        n = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(both, flat), max(0, len(both) - 1))
        hit = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        owner, column = np.repeat(np.arange(len(sets)), n)[hit], at[hit]
        bound = np.bincount(owner, minlength=len(sets))
        keep = np.flatnonzero(bound >= least_overlap(n, percent))
        row = np.full(len(sets), -1)
        row[keep] = np.arange(len(keep))
        use = row[owner] >= 0
        order = np.argsort(column[use], kind="stable")
        sides.append((keep, n[keep], row[owner[use]][order], column[use][order]))
    (rows, n, *_), (columns, m, *_) = sides
    if not len(rows) or not len(columns):
        return []
    common = np.zeros((len(rows), len(columns)), np.float32)
    for low in range(0, len(both), _COLUMN_BLOCK):
        blocks = []
        for keep, _, owner, column in sides:
            a, b = np.searchsorted(column, [low, low + _COLUMN_BLOCK])
            block = np.zeros((len(keep), _COLUMN_BLOCK), np.float32)
            block[owner[a:b], column[a:b] - low] = 1
            blocks.append(block)
        common += blocks[0] @ blocks[1].T
    common = common.astype(np.int64)
    linked = 100 * common >= percent * (n[:, None] + m[None, :] - common)
    i, j = np.nonzero(linked)
    root = list(range(len(rows) + len(columns)))
    forest = []
    for a, b in zip(i.tolist(), (j + len(rows)).tolist(), strict=True):
        ra, rb = a, b
        while root[ra] != ra:
            root[ra] = ra = root[root[ra]]
        while root[rb] != rb:
            root[rb] = rb = root[root[rb]]
        if ra != rb:
            root[rb] = ra
            forest.append((int(rows[a]), int(columns[b - len(rows)])))
    return forest


def _lists(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """sid, n, sets and row numbers of a table with each sid once."""
    sid, rows = np.unique(table.column("sid").to_numpy(), return_index=True)
    column = table.column("hashes").combine_chunks()
    flat, at = column.values.to_numpy(), column.offsets.to_numpy()
    sets = [flat[at[r] : at[r + 1]] for r in rows.tolist()]
    return sid, np.array([len(x) for x in sets], np.int64), sets, rows


def _union(sets: list[np.ndarray]) -> np.ndarray:
    every = np.sort(np.concatenate([np.zeros(0, np.int64), *sets]))
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    return every[new]


def _open_chunk(percent: int) -> Callable[[pa.Table], pa.Table]:
    """A cell's links (a, b), and per family found in it (a member, the union of its prefixes)."""

    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        sid, n, sets, rows = _lists(table)
        own = table.column("own").to_numpy(zero_copy_only=False)
        mine = set(table.column("sid").to_numpy()[own].tolist())
        found = links(sets, percent)
        root = list(range(len(sid)))
        for i, j in found:  # a forest, parents first
            root[j] = root[i]
        families: dict[int, list[np.ndarray]] = {}
        for i, s in enumerate(sid.tolist()):
            if s in mine:
                families.setdefault(root[i], []).append(sets[i][: prefix_length(n[i], percent)])
        unions = [_union(x) for x in families.values()]
        a = [int(sid[i]) for i, _ in found] + [int(sid[r]) for r in families]
        b = [int(sid[j]) for _, j in found] + [None] * len(families)
        return pa.table(
            {
                "cell": pa.array([cell] * len(a), pa.int64()),
                "a": pa.array(a, pa.int64()),
                "b": pa.array(b, pa.int64()),
                "hashes": pa.array([None] * len(found) + unions, pa.list_(pa.int64())),
            }
        )

    return run


def _active_in_cell(percent: int, prefixes: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Sets of a cell with enough of their hashes among those marked, and the unions of them.

    Rows are (sid, n) of the active sets, then one with the union of all their hashes, with
    the least and greatest component that holds each, and one with the marked hashes of
    their prefixes (kind 0, 1, 2). ``prefixes``: only the marked hashes of prefixes count,
    against what prefixes of similar sets share.
    """

    def run(table: pa.Table, marks: pa.Table) -> pa.Table:
        longs = pa.list_(pa.int64())
        shape = {"cell": pa.int64(), "kind": pa.int32(), "sid": pa.int64(), "n": pa.int64()}
        shape |= {"hashes": longs, "lo": longs, "hi": longs}
        out: list[tuple] = []
        if len(table) and len(marks):
            cell = table.column("cell")[0].as_py()
            marked = _union([marks.column("h").to_numpy()])
            sid, n, sets, rows = _lists(table)
            comp = table.column("comp").to_numpy()[rows]
            flat = np.concatenate([np.zeros(0, np.int64), *sets])
            owner = np.repeat(np.arange(len(sets)), n)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            in_prefix = place < prefix_length(n, percent)[owner]
            hit = marked[np.minimum(np.searchsorted(marked, flat), len(marked) - 1)] == flat
            count = np.bincount(owner[hit & in_prefix] if prefixes else owner[hit], minlength=len(sets))
            stays = count >= (needed(n, percent) if prefixes else least_overlap(n, percent))
            if stays.any():
                out = [(cell, 0, int(sid[i]), int(n[i]), None, None, None) for i in np.flatnonzero(stays)]
                of_active = stays[owner]
                every, of = flat[of_active], comp[owner[of_active]]
                order = np.argsort(every, kind="stable")
                every, of = every[order], of[order]
                begin = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
                least, most = np.minimum.reduceat(of, begin), np.maximum.reduceat(of, begin)
                out.append((cell, 1, None, None, every[begin], least, most))
                out.append((cell, 2, None, None, _union([flat[of_active & hit & in_prefix]]), None, None))
        columns = list(zip(*out, strict=True)) if out else [[]] * len(shape)
        return pa.table({k: pa.array(list(c), t) for (k, t), c in zip(shape.items(), columns, strict=True)})

    return run


def _flat(carry: str, bits: int, packed: Broadcast, *along: str) -> Callable:
    """Map (carry, hashes) to rows (carry, h) of the hashes that the bit array may hold.

    ``along``: more lists, with an item for each hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(packed.value, np.uint8)
        for batch in batches:
            column = batch.column("hashes")
            length = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy()
            keep = bit_filter.may_hold(held, bits, flat.view(np.uint64))
            owner = np.repeat(np.arange(len(length)), length)[keep]
            more = [pa.array(batch.column(c).flatten().to_numpy()[keep]) for c in along]
            yield pa.RecordBatch.from_arrays(
                [batch.column(carry).take(pa.array(owner)), pa.array(flat[keep]), *more], names=[carry, "h", *along]
            )

    return run


def held_by_several(unions: DataFrame) -> DataFrame:
    """Rows (cell, h, lo, hi) of the hashes that several cells hold, from a row of lists per cell.

    A few that only one cell holds are among them; the others never become rows.
    """
    count = unions.agg(F.sum(F.size("hashes"))).first()[0] or 0
    packed, bits = bit_filter.build_repeated(unions, count)
    return unions.select("cell", "hashes", "lo", "hi").mapInArrow(
        _flat("cell", bits, packed, "lo", "hi"), "cell long, h long, lo long, hi long"
    )


def _open_pair(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Two cells: bound every query by the union of the other cell, then compare what passes."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sides = [rows[rows["side"] == k] for k in (0, 1)]
        sets = [[np.asarray(x, np.int64) for x in part["hashes"]] for part in sides]
        found = links_across(*sets, percent) if all(sets) else []
        sid = [part["sid"].to_numpy() for part in sides]
        return pd.DataFrame({"a": [sid[0][i] for i, _ in found], "b": [sid[1][j] for _, j in found]}, dtype="int64")

    return run


def _chunks_of(sets: DataFrame, by: str) -> DataFrame:
    """Per value of ``by`` how many chunks keep it within the bounds."""
    return sets.groupBy(by).agg(
        F.ceil(
            F.greatest(F.count("*") / CHUNK_SETS, F.sum("n") / CHUNK_HASHES)
        ).alias("chunks"),
        F.count("*").alias("members"),
    )


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for a broadcast if it has few enough rows; narrow tables only."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def similar_documents(
    docs: DataFrame, size: int = SIZE, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    base = scratch_dir(spark, "ngram-join")

    def staged(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape = "doc_id long, key binary, cid long, n long, hashes array<long>"
    signed = staged("prefixes", source.mapInArrow(_set_batches(size, percent, False), shape))
    need = F.expr(_sql_need(percent))

    # 1. candidates: classes that share enough prefix hashes with other classes
    several = staged(
        "several",
        signed.select("cid", F.explode("hashes").alias("h"))
        .groupBy("h")
        .agg(F.min("cid").alias("lead"), F.max("cid").alias("top"))
        .where("lead <> top")
        .select("h", "lead"),
    )
    packed, bits = bit_filter.build(several.select("h"), several.count())
    shared = signed.select("cid", "hashes").mapInArrow(_flat("cid", bits, packed), "cid long, h long")
    hits = staged("hits", shared.join(several, "h").groupBy("cid", "lead").agg(F.count("*").alias("hits")))
    classes = staged(
        "classes",
        signed.where("key is not null")
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("doc_id"),
            F.first("cid").alias("cid"),
            F.first("n").alias("n"),
        ),
    )
    per_class = hits.groupBy("cid").agg(
        F.sum("hits").alias("hits"),
        F.max_by("lead", F.struct("hits", "lead")).alias("lead"),
    )
    chosen = staged(
        "candidates",
        classes.join(per_class, "cid")
        .where(F.col("hits") >= F.col("copies") * need)
        .select("key", "doc_id", "cid", "n", "lead")
        .withColumn("sid", F.monotonically_increasing_id()),
    )

    # 2. cells of groups around leading classes; the leader is in every cell
    sizes = staged("sizes", _chunks_of(chosen, "lead"))
    placed = staged(
        "placed",
        chosen.join(sizes, "lead").select(
            "key",
            "doc_id",
            "sid",
            "members",
            F.xxhash64("lead", F.pmod(F.xxhash64("sid"), F.col("chunks"))).alias("cell"),
        ),
    )
    leaders = staged(
        "leaders",
        sizes.where("members > 1")
        .join(chosen.select(F.col("cid").alias("lead"), "sid"), "lead")
        .select("sid", F.explode(F.expr("transform(sequence(0L, chunks - 1), c -> xxhash64(lead, c))")).alias("cell")),
    )
    picked = _small(placed.select("doc_id").distinct())
    texts = source.join(picked, source["doc_id"].eqNullSafe(picked["doc_id"]), "left_semi")
    whole = texts.mapInArrow(_set_batches(size, percent, True), shape)
    sets = staged(
        "sets", whole.select("key", "n", "hashes").join(_small(placed.drop("doc_id")), "key").drop("key")
    )
    if sets.count() > placed.count():  # repeated rows, or some with a null doc_id
        sets = staged("sets-once", sets.dropDuplicates(["sid"]))
    several_members = sets.where("members > 1").select("cell", "sid", F.lit(True).alias("own"), "hashes")
    lead_sets = sets.select("sid", "hashes").join(_small(leaders), "sid")
    opened = staged(
        "opened",
        several_members.unionByName(lead_sets.select("cell", "sid", F.lit(False).alias("own"), "hashes"))
        .groupBy("cell")
        .applyInArrow(_open_chunk(percent), "cell long, a long, b long, hashes array<long>"),
    )
    within = opened.where("b is not null").select("a", "b")
    first = components(within, f"{base}/first")

    # 3. cells of other components
    least = f"ceil(n * {percent} / 100)"
    prefix = F.expr(f"slice(hashes, 1, cast(n - {least} + n div 10 + if(n < 10, 1, 0) as int))")
    alone = sets.where("members = 1").select("cell", "sid", prefix.alias("hashes"))
    unions = opened.where("b is null").select("cell", F.col("a").alias("sid"), "hashes").unionByName(alone)
    by_family = unions.join(first, "sid", "left").select(
        "cell", F.coalesce("root", "sid").alias("comp"), F.explode("hashes").alias("h")
    )
    split = staged(
        "split",
        by_family.groupBy("h")
        .agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("cell").alias("near"), F.max("cell").alias("far")
        )
        .where("lo <> hi and near <> far")
        .select("h"),
    )
    active_shape = "cell long, kind int, sid long, n long, hashes array<long>, lo array<long>, hi array<long>"
    components_of = _small(first)

    def active_sets(name: str, among: DataFrame, unions: DataFrame, marked: DataFrame, prefixes: bool) -> DataFrame:
        packed, bits = bit_filter.build(marked, marked.count())
        marks = unions.select("cell", "hashes").mapInArrow(_flat("cell", bits, packed), "cell long, h long")
        marks = staged(f"{name}-marks", marks.join(marked, "h").select("cell", "h").distinct())
        there = _small(marks.select("cell").distinct())
        return staged(
            name,
            among.join(there, "cell", "left_semi")
            .join(components_of, "sid", "left")
            .select("cell", "sid", F.coalesce("root", "sid").alias("comp"), "hashes")
            .groupBy("cell")
            .cogroup(marks.groupBy("cell"))
            .applyInArrow(_active_in_cell(percent, prefixes), active_shape),
        )

    active = active_sets("active", sets, unions, split, True)
    # a set with a partner to find has four fifths of its hashes in other cells and in other
    # components; the second pass counts among those that the first one left
    for step in (1, 2):
        unions = active.where("kind = 1")
        spread = (
            held_by_several(unions)
            .groupBy("h")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("cell").alias("near"), F.max("cell").alias("far"))
            .where("lo <> hi and near <> far")
        )
        among = sets.join(_small(active.where("kind = 0").select("sid")), "sid", "left_semi")
        active = active_sets(f"active-{step}", among, unions, staged(f"spread-{step}", spread.select("h")), False)
    matrix = staged("matrix", active.where("kind = 2").select("cell", F.explode("hashes").alias("h")))
    members = active.where("kind = 0").select("cell", "sid", "n")
    cells = staged(
        "cells",
        members.groupBy("cell").agg(
            F.min(need).alias("need"), F.min("n").alias("least_n"), F.max("n").alias("most_n")
        ),
    )
    of = {
        name: cells.select(*(F.col(c).alias(f"{c}_{name}") for c in cells.columns)) for name in ("left", "right")
    }
    common = (
        matrix.select("h", F.col("cell").alias("cell_left"))
        .join(matrix.select("h", F.col("cell").alias("cell_right")), "h")
        .where("cell_left < cell_right")
        .groupBy("cell_left", "cell_right")
        .agg(F.count("*").alias("common"))
    )
    pairs = staged(
        "pairs",
        common.join(of["left"], "cell_left")
        .join(of["right"], "cell_right")
        .where("common >= greatest(need_left, need_right)")
        .where(f"100 * most_n_left >= {percent} * least_n_right and 100 * most_n_right >= {percent} * least_n_left")
        .select("cell_left", "cell_right"),
    )
    active_hashes = sets.select("sid", "hashes").join(_small(members.select("cell", "sid")), "sid")
    sides = [
        pairs.join(active_hashes, pairs[f"cell_{name}"] == active_hashes["cell"]).select(
            "cell_left", "cell_right", F.lit(k).alias("side"), "sid", "hashes"
        )
        for k, name in enumerate(("left", "right"))
    ]
    across = staged(
        "across",
        sides[0]
        .unionByName(sides[1])
        .groupBy("cell_left", "cell_right")
        .applyInPandas(_open_pair(percent), "a long, b long"),
    )
    found = components(within.unionByName(across), f"{base}/all")

    # 4. back to documents: each class with its component's smallest id
    linked = chosen.select("key", "sid", "doc_id").join(found, "sid")
    smallest = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    moved = linked.select("key", "root").join(smallest.withColumn("root", F.col("root") + 0), "root")
    of_class = classes.select("key", "doc_id").join(moved.select("key", "root", "component_id"), "key", "left").select(
        # a key of its own placement, so that a class with many copies can be split
        F.concat("key", F.lit(b"")).alias("key"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return signed.select("doc_id", "key", "n").join(of_class, "key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each component, all columns; the rest go.

    A row with a null doc_id stays only if its whole component has no other id.
    """
    keep = similar_documents(docs).where("doc_id <=> component_id").select("doc_id").distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["doc_id"]), "left_semi")
