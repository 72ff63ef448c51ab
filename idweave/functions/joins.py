"""Join helpers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.functions.columns import ntz_lit


def own_shuffle(lookup_side: DataFrame, key: str) -> DataFrame:
    """Make a join on the string column ``key`` splittable at run time.

    Spark splits an oversized join partition only when both sides come straight out
    of a shuffle made for that join. A lookup side that was just aggregated or
    joined on the same key is already in place and gets none, and then a hot key on
    the other side stays in one task. Rewriting the key as an equal value hides the
    old placement, so the (small) lookup side is shuffled once more and the hot
    partition can be cut.
    """
    return lookup_side.withColumn(key, F.concat(F.col(key), F.lit("")))


RUN_AT = "run_at"


def of_run(rows: DataFrame, run_tstamp: datetime) -> DataFrame:
    """Rows with the time of the run they belong to, to be staged and read by :func:`only_of_run`."""
    return rows.withColumn(RUN_AT, ntz_lit(run_tstamp))


def only_of_run(staged: DataFrame, run_tstamp: datetime) -> DataFrame:
    """The rows of :func:`of_run` as they are read back, for the small side of a join.

    Staged, they are a plain scan, and the comparison tells Spark that they are a
    selection. When the other side of the join is large, Spark then builds a Bloom filter
    of these keys and puts it on that side's scan, below its exchange
    (``spark.sql.optimizer.runtime.bloomFilter.*``): only rows that can match are shuffled.
    """
    return staged.where(F.col(RUN_AT) >= ntz_lit(run_tstamp)).drop(RUN_AT)
