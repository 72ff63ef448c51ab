"""Hard negatives by inner product, with cover trees over norm-augmented vectors.

Components become ``floor(256 * x)``, so scores are whole numbers. An anchor's positives are
its best rows of the same label. A positive's negatives are the best rows of other labels
whose score lies in a window around that of the positive.

Vectors are cut into cells of a label and of bounded size. Within a cell every vector gets
one more component that brings it to the length of the longest, so all lie on a sphere and
the inner product with an anchor falls with the angle. A cover tree divides the cell: a
node's centre is its first child's too, further children are the points farthest from all
centres so far, until the covering angle has shrunk by a level or there are ``FAN_OUT``.
Each node keeps its covering angle, which bounds the scores below it from both sides. A
search goes down best bound first, skips nodes that lie outside all windows or below the
rows found so far, and scores the rows of the leaves it reaches exactly.

Anchors meet the cells in blocks: a task has one cell and one block, both of bounded size.
Positives need the cells of the anchor's label, negatives those of the others. What a task
returns for an anchor is at most its best rows by window, so results add up in the ranking
that follows. The work is anchors by cells; the trees save scoring, not the visit.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite
component take no part. Rows that share an id count once, the one with the smallest label
and then the smallest vector. A shorter vector is filled up with zeros. Equal scores go by
the smaller id. A positive score of less than zero has no window. Scores that don't fit 64
bits are an error. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from idweave.plans.scratch import scratch_dir

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
#: Rows of a cell and anchors of a block, at most about.
CELL_ROWS, BLOCK_ANCHORS = 50_000, 2_000
FAN_OUT, LEAF_ROWS, LEVEL = 12, 128, 1.3
_LEAVES_AT_ONCE = 6
_EXACT = 2.0**53


def whole_numbers(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of floor(256 * x); float64 where that is exact, else Python integers."""
    rows = [np.floor(np.asarray(v, np.float64) * SCALE) for v in vectors.to_pylist()]
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def _padded(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _exact_scores(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whole inner products of the rows with ``q``."""
    most = np.abs(rows).max(initial=0) * np.abs(q).max(initial=0) * max(1, len(q))
    if most < _EXACT:
        return (rows @ q).astype(np.int64)
    whole = [[int(x) for x in r] for r in rows.tolist()]
    other = [int(x) for x in q.tolist()]
    return np.array([sum(a * b for a, b in zip(r, other, strict=True)) for r in whole], object)


class CoverTree:
    """A cover tree over the rows of a cell."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray) -> None:
        norm = np.sqrt((rows * rows).sum(axis=1))
        self.radius = float(norm.max(initial=0.0))
        lift = np.sqrt(np.maximum(self.radius**2 - norm**2, 0.0))
        sphere = np.column_stack([rows, lift]) / (self.radius or 1.0)
        order: list[np.ndarray] = []
        self.children: list[list[int]] = []
        centre, angle, begin, end = [], [], [], []

        def node(own: np.ndarray, at: int, wide: float) -> int:
            centre.append(at)
            angle.append(wide)
            self.children.append([])
            begin.append(-1)
            end.append(-1)
            todo.append((len(centre) - 1, own))
            return len(centre) - 1

        todo: list[tuple[int, np.ndarray]] = []
        if len(rows):
            far = float(np.arccos(np.clip((sphere @ sphere[0]).min(), -1, 1)))
            node(np.arange(len(rows)), 0, far)
        placed = 0
        while todo:
            number, own = todo.pop()
            if len(own) <= LEAF_ROWS or angle[number] < 1e-6:
                begin[number], end[number] = placed, placed + len(own)
                order.append(own)
                placed += len(own)
                continue
            points = sphere[own]
            centres = [centre[number]]
            near, which = points @ sphere[centres[0]], np.zeros(len(own), np.int64)
            level = np.cos(angle[number] / LEVEL)
            while len(centres) < FAN_OUT:
                k = int(np.argmin(near))
                if len(centres) > 1 and near[k] >= level:
                    break
                dot = points @ points[k]
                closer = dot > near
                closer[k] = True
                which[closer], near = len(centres), np.where(closer, dot, near)
                centres.append(int(own[k]))
            for c, at in enumerate(centres):
                mine = np.flatnonzero(which == c)
                if len(mine):
                    wide = float(np.arccos(np.clip(near[mine].min(), -1, 1)))
                    self.children[number].append(node(own[mine], at, wide))
        order_all = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.rows, self.ids = rows[order_all], ids[order_all]
        self.begin, self.end = begin, end
        self.angle = np.array(angle) + 1e-6
        self.centres = rows[np.array(centre, np.int64)]

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each node can hold."""
        reach = float(np.sqrt(q @ q)) * self.radius
        if not reach:
            zero = np.zeros(len(self.angle))
            return zero, zero
        to_centre = np.arccos(np.clip(self.centres @ q / reach, -1, 1))
        slack = 1e-6 * reach + 1e-3
        low = reach * np.cos(np.minimum(np.pi, to_centre + self.angle)) - slack
        high = reach * np.cos(np.maximum(0.0, to_centre - self.angle)) + slack
        return low, high

    def best(
        self, q: np.ndarray, windows: list[tuple[float, float]], most: int, but: int | None = None
    ) -> list[list[tuple[int, int]]]:
        """Per window (lowest, highest score) its first ``most`` rows, as (-score, id)."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        if not len(self.ids):
            return found
        low, high = self.bounds(q)
        low_of, high_of = low.tolist(), high.tolist()
        least = [w[0] for w in windows]  # a row with less is of no use to the window
        queue, leaves = [(-high_of[0], 0)], []

        def verify() -> None:
            at = np.concatenate([np.arange(self.begin[x], self.end[x]) for x in leaves])
            leaves.clear()
            score, ids = _exact_scores(self.rows[at], q), self.ids[at]
            if but is not None:
                score, ids = score[ids != but], ids[ids != but]
            for k, (_, top) in enumerate(windows):
                take = np.flatnonzero((score >= least[k]) & (score <= top))
                if len(take):
                    if len(take) > most:
                        take = take[np.lexsort((ids[take], -score[take]))[:most]]
                    new = zip((-score[take]).tolist(), ids[take].tolist(), strict=True)
                    found[k] = sorted([*found[k], *new])[:most]
                    if len(found[k]) == most:
                        least[k] = max(least[k], -found[k][-1][0])

        while queue or leaves:
            if not queue or len(leaves) == _LEAVES_AT_ONCE:
                verify()
                continue
            top, x = heapq.heappop(queue)
            if -top < min(least):  # and so is all that is left
                queue.clear()
                continue
            if not any(high_of[x] >= a and low_of[x] <= b for a, (_, b) in zip(least, windows, strict=True)):
                continue
            if self.children[x]:
                for y in self.children[x]:
                    heapq.heappush(queue, (-high_of[y], y))
            else:
                leaves.append(x)
        return found


def _tree_and_queries(cell: pa.Table, anchors: pa.Table) -> tuple[CoverTree, np.ndarray]:
    rows, queries = whole_numbers(cell.column("vector")), whole_numbers(anchors.column("vector"))
    width = max(rows.shape[1], queries.shape[1])
    return CoverTree(_padded(rows, width), cell.column("vec_id").to_numpy()), _padded(queries, width)


def _positives_of(most: int) -> Callable:
    """Map a cell and a block of anchors of its label to the anchors' best rows there."""

    def run(cell: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(cell) and len(anchors):
            tree, queries = _tree_and_queries(cell, anchors)
            for a, q in zip(anchors.column("vec_id").to_pylist(), queries, strict=True):
                (best,) = tree.best(q, [(-np.inf, np.inf)], most, a)
                out += [(a, i, -s) for s, i in best]
        return _as_table(out, ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives_of(most: int, low: int, high: int) -> Callable:
    """Map a cell and a block of anchors to the best rows in each window of the anchors."""

    def run(cell: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(cell) and len(anchors):
            tree, queries = _tree_and_queries(cell, anchors)
            label = cell.column("label")[0].as_py()
            each = zip(*(anchors.column(c).to_pylist() for c in ("vec_id", "label", "scores")), queries, strict=True)
            for a, own, scores, q in each:
                windows = {(-(-low * s // 100), high * s // 100) for s in scores}
                windows = [w for w in windows if w[0] <= w[1]]
                if own != label and windows:
                    found = {x for best in tree.best(q, windows, most) for x in best}
                    out += [(a, i, -s) for s, i in found]
        return _as_table(out, ["anchor_id", "negative_id", "negative_score"])

    return run


def _as_table(rows: list[tuple[int, int, int]], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, once for each id."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where("vec_id is not null and label is not null and vector is not null").where(finite)
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r"))
    return one.select("vec_id", "r.label", "r.vector")


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and embedding, ``anchors`` the vec_id of the rows to mine for.
    """
    spark = vectors.sparkSession
    base = scratch_dir(spark, "hard-negatives")

    def staged(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    rows = staged("rows", usable(vectors))
    wanted = anchors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    queries = staged("anchors", rows.join(wanted, "vec_id", "left_semi"))
    sizes = rows.groupBy("label").agg(F.ceil(F.count("*") / CELL_ROWS).cast("long").alias("cells"))
    before = Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each label: labels are classes, few against the rows
    cells = staged("cells", sizes.withColumn("first", F.coalesce(F.sum("cells").over(before), F.lit(0))))
    n_cells = cells.agg(F.sum("cells")).first()[0] or 0
    n_anchors = queries.count()
    if not n_cells or not n_anchors:
        shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], shape)
    n_blocks = -(-n_anchors // BLOCK_ANCHORS)
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    placed = staged(
        "placed",
        rows.join(cells, "label").select(
            "vec_id", "label", "vector", (F.col("first") + F.pmod(F.xxhash64("vec_id"), "cells")).alias("cell")
        ),
    ).select("*", blocks)
    asking = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_blocks)).cast("int"))

    own_cells = asking.join(cells, "label").select(
        "vec_id", "label", "vector", "block", F.explode(F.expr("sequence(first, first + cells - 1)")).alias("cell")
    )
    near = placed.groupBy("cell", "block").cogroup(own_cells.groupBy("cell", "block")).applyInArrow(
        _positives_of(positives), "anchor_id long, positive_id long, positive_score long"
    )
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = staged(
        "positives", near.withColumn("k", F.row_number().over(first)).where(F.col("k") <= positives).drop("k")
    )
    scores = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("scores"))
    all_cells = asking.join(scores, "vec_id").select(
        "vec_id", "label", "vector", "scores", "block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_cells - 1))).alias("cell"),
    )
    far = placed.groupBy("cell", "block").cogroup(all_cells.groupBy("cell", "block")).applyInArrow(
        _negatives_of(negatives, low_percent, high_percent), "anchor_id long, negative_id long, negative_score long"
    )
    exact = T.DecimalType(22, 0)
    positive, negative = F.col("positive_score").cast(exact), F.col("negative_score").cast(exact)
    inside = (low_percent * positive <= 100 * negative) & (100 * negative <= high_percent * positive)
    place = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        chosen.join(far, "anchor_id")
        .where(inside)
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
