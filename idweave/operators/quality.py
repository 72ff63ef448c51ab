"""Data-quality jobs. Each returns the violating rows; empty means clean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from idweave.operators import history


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def check_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Non-null key combinations that occur more than once, with their count."""
    present = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return present.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def check_unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column combinations that occur more than once, nulls compared as values."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def check_no_stale_roots(identifier_mapping: DataFrame, mapping: DataFrame) -> DataFrame:
    """Identifier rows that point at an id which has been absorbed."""
    absorbed = mapping.select(
        F.col("identity_id").alias("stale_active_id"),
        F.col("active_identity_id").alias("correct_active_id"),
    )
    return identifier_mapping.select(
        "id_type", "id_value", F.col("active_identity_id").alias("stale_active_id")
    ).join(absorbed, "stale_active_id")


def diff_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on one side only, duplicates counted, tagged ``side`` left or right.

    Works on counts per distinct row, so two tables are compared in one shuffle.
    """
    cols = left.columns
    tagged = left.select(*cols, F.lit(1).alias("d")).unionByName(
        right.select(*cols, F.lit(-1).alias("d"))
    )
    surplus = tagged.groupBy(*cols).agg(F.sum("d").alias("d")).where("d <> 0")
    return surplus.select(
        *cols,
        F.when(F.col("d") > 0, "left").otherwise("right").alias("side"),
        F.abs("d").alias("copies"),
    )


def rebuild_scd(changes: DataFrame, mapping: DataFrame) -> DataFrame:
    """The SCD as it follows from the change log alone."""
    rows = history.scd_dedupe_key(history.scd_new_records(changes).withColumn("origin", F.lit(1)))
    return history.supersede(rows, mapping)


def check_scd_replay(changes: DataFrame, mapping: DataFrame, scd: DataFrame) -> DataFrame:
    """Differences between the stored SCD and the one rebuilt from the change log."""
    cols = [
        "identity_id",
        "active_identity_id",
        "effective_at",
        "superseded_at",
        "change_type",
        "is_current",
    ]
    return diff_tables(scd.select(*cols), rebuild_scd(changes, mapping).select(*cols))


#: Buckets of a row's hash on the first level, and of each of those on the second.
TOP_BUCKETS, LEAF_BUCKETS = 256, 256


def _row_hash(df: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *(F.struct(F.col(c), F.col(c).isNull()) for c in df.columns))


def _checksums(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows, and sums of two hashes of the rows, per bucket; equal for equal bags of rows."""
    wide = "decimal(38,0)"
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(F.col("__a").cast(wide)).alias("a"), F.sum(F.col("__b").cast(wide)).alias("b")
    )


def _differing(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    sums = _checksums(left, by).withColumn("side", F.lit(1)).unionByName(
        _checksums(right, by).withColumn("side", F.lit(-1))
    )
    apart = sums.groupBy(*by).agg(*(F.sum(F.col(c) * F.col("side")).alias(c) for c in ("n", "a", "b")))
    return apart.where("n <> 0 or a <> 0 or b <> 0").select(*by)


def diff_by_checksum(left: DataFrame, right: DataFrame) -> DataFrame:
    """:func:`diff_tables`, by a tree of checksums: only buckets that differ are compared by rows.

    Rows fall into buckets of their own hash, on two levels. A bucket's checksum is its
    number of rows and the sums of two 64-bit hashes of them. Sums are added up before they
    are shuffled, so comparing equal tables moves a row for each bucket and task. The second
    level is summed for first-level buckets that differ, and what differs there, at most
    ``TOP_BUCKETS * LEAF_BUCKETS`` bucket numbers, selects the rows to compare.
    """
    columns = left.columns
    sides = []
    for df in (left, right.select(*columns)):
        hashed = df.withColumns({"__a": _row_hash(df, 1), "__b": _row_hash(df, 2)})
        top = F.pmod("__a", F.lit(TOP_BUCKETS)).cast("int")
        leaf = F.pmod(F.expr(f"__a div {TOP_BUCKETS}"), F.lit(LEAF_BUCKETS)).cast("int")
        sides.append(hashed.withColumns({"__top": top, "__leaf": leaf}))
    tops = _differing(*sides, ["__top"])
    within = [s.join(F.broadcast(tops), "__top", "left_semi") for s in sides]
    leaves = _differing(*within, ["__top", "__leaf"])
    return diff_tables(*(s.join(F.broadcast(leaves), ["__top", "__leaf"], "left_semi").select(*columns) for s in sides))


def write_with_metrics(df: DataFrame, path: str, not_null: list[str], ts_col: str) -> dict[str, object]:
    """Write ``df`` as Parquet; rows, nulls per column and time bounds come from the same pass."""
    seen = Observation()
    df.observe(
        seen,
        F.count("*").alias("n_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null),
        F.min(ts_col).alias("first_at"),
        F.max(ts_col).alias("last_at"),
    ).write.parquet(path)
    return seen.get
