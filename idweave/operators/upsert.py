"""Table maintenance as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_new_columns(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Target with the updates' extra columns added; old rows hold null there."""
    return target.unionByName(updates.limit(0), allowMissingColumns=True)


def upsert_by_key(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Replace rows with a matching key, insert the rest, delete nothing."""
    kept = target.join(updates.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(updates, allowMissingColumns=True)


def delete_where_in(target: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose column is not among the single-column ``values``."""
    gone = values.toDF(column)
    return target.join(gone, column, "left_anti").select(*target.columns)


def changed_rows(stored: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The ``rows`` that are new or differ from the stored row of their key."""
    old = stored.select(F.col(key).alias("old_key"), F.struct(*rows.columns).alias("old"))
    joined = rows.join(old, rows[key] == old["old_key"], "left")
    now = F.struct(*[rows[c] for c in rows.columns])
    return joined.where(~F.col("old").eqNullSafe(now)).select(*[rows[c] for c in rows.columns])
