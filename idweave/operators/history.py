"""SCD type 2 history of every identity's parent, and lookups as of a time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.functions.columns import ntz_lit, surrogate_key
from idweave.functions.joins import own_shuffle

COLUMNS = ["scd_key", "identity_id", "active_identity_id", "effective_at", "change_type"]


def ids_affected(changes: DataFrame) -> DataFrame:
    """Ids after a change plus all absorbed ids."""
    absorbed = changes.where(F.col("change_type") == "merged").select(
        F.col("previous_identity_id").alias("identity_id")
    )
    return changes.select("identity_id").unionByName(absorbed).distinct()


def scd_history(prev: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored history of those ids only."""
    ids = own_shuffle(ids, "identity_id")
    return prev.join(ids, "identity_id", "left_semi").select(*COLUMNS)


def scd_new_records(changes: DataFrame) -> DataFrame:
    """History rows of the batch.

    A merge tracks the absorbed id and is keyed by its time, whoever the parent
    is. A creation tracks the id itself and is keyed without its time, so that a
    late event overwrites it instead of adding a second creation.
    """
    merged = F.col("change_type") == "merged"
    tracked = F.when(merged, F.col("previous_identity_id")).otherwise(F.col("identity_id"))
    when = F.when(merged, F.col("effective_at").cast("string")).otherwise(F.lit("created"))
    return changes.select(
        surrogate_key(tracked, when, F.col("change_type")).alias("scd_key"),
        tracked.alias("identity_id"),
        F.col("identity_id").alias("active_identity_id"),
        "effective_at",
        "change_type",
    )


def scd_combine(new: DataFrame, history: DataFrame) -> DataFrame:
    """Batch rows (rank 1) and stored rows (rank 2)."""
    return new.withColumn("origin", F.lit(1)).unionByName(
        history.withColumn("origin", F.lit(2))
    )


def scd_dedupe_key(combined: DataFrame) -> DataFrame:
    """One row per key: earliest, then the batch's row before the stored one."""
    best = combined.groupBy("scd_key").agg(
        F.min(
            F.struct(
                "effective_at", "origin", "active_identity_id", "identity_id", "change_type"
            )
        ).alias("r")
    )
    return best.select(
        "scd_key", "r.identity_id", "r.active_identity_id", "r.effective_at", "r.change_type"
    )


def scd_dedupe_triple(rows: DataFrame) -> DataFrame:
    """One row per (id, parent, change type): the earliest."""
    best = rows.groupBy("identity_id", "active_identity_id", "change_type").agg(
        F.min(F.struct("effective_at", "scd_key")).alias("r")
    )
    return best.select(
        "r.scd_key", "identity_id", "active_identity_id", "r.effective_at", "change_type"
    )


def supersede(rows: DataFrame, this_run: DataFrame) -> DataFrame:
    """Close every row at the start of the next row of the same id.

    At equal times the row that agrees with the batch's mapping comes last and
    stays current. The successor is looked up in two levels: inside the day, and
    for the last row of a day among the days of the id. So a single id never puts
    more than one day, or one row per day, into one window group.
    """
    current = this_run.select("identity_id", "active_identity_id").withColumn("agrees", F.lit(1))
    ranked = (
        rows.join(current, ["identity_id", "active_identity_id"], "left")
        .withColumn("agrees", F.coalesce("agrees", F.lit(0)))
        .withColumn("day", F.to_date("effective_at"))
    )
    order = ["effective_at", "agrees", "change_type", "active_identity_id"]
    in_day = Window.partitionBy("identity_id", "day")
    ranked = ranked.withColumns(
        {
            "next_in_day": F.lead("effective_at").over(in_day.orderBy(*order)),
            "day_start": F.min("effective_at").over(in_day),
        }
    )
    # rows with a successor inside their day stay in a group of their own day
    group = F.when(F.col("next_in_day").isNotNull(), F.col("day"))
    across = Window.partitionBy("identity_id", group).orderBy("day")
    last_of_day = F.when(F.col("next_in_day").isNull(), F.lead("day_start").over(across))
    closed = F.coalesce("next_in_day", last_of_day)
    return ranked.withColumn("superseded_at", closed).select(
        "scd_key",
        "identity_id",
        "active_identity_id",
        "effective_at",
        "superseded_at",
        "change_type",
        F.col("superseded_at").isNull().alias("is_current"),
    )


def scd_updates(history: DataFrame, changes: DataFrame, this_run: DataFrame) -> DataFrame:
    """Rows to upsert into the SCD. ``history`` comes from :func:`scd_history`."""
    combined = scd_combine(scd_new_records(changes), history)
    return supersede(scd_dedupe_triple(scd_dedupe_key(combined)), this_run)


def active_at(facts: DataFrame, scd: DataFrame, at: datetime) -> DataFrame:
    """Active id of every fact as of one point in time.

    The time filter runs on the history before the join, which leaves at most one
    row per id, so the join is many-to-one.
    """
    t = ntz_lit(at)
    valid = scd.where(
        (F.col("effective_at") <= t)
        & (F.col("superseded_at").isNull() | (F.col("superseded_at") > t))
    ).select("identity_id", "active_identity_id")
    return facts.join(valid, "identity_id")


def active_as_of(facts: DataFrame, scd: DataFrame, ts_col: str) -> DataFrame:
    """Active id of every fact as of the fact's own time; facts before the first row drop out.

    The history becomes one row per id and day with changes: the day's rows in order, and
    the span from the day's first change to that of the id's next such day. A fact meets
    the one day whose span holds its time and picks its row there. So the facts are
    shuffled once, by id, a busy id can be split, and a fact is compared with the days of
    its id and not with all its rows.
    """
    history = scd.where(
        F.col("superseded_at").isNull() | (F.col("superseded_at") > F.col("effective_at"))
    )
    days = history.groupBy("identity_id", F.to_date("effective_at").alias("day")).agg(
        F.min("effective_at").alias("first_change"),
        F.array_sort(
            F.collect_list(F.struct(F.col("effective_at").alias("at"), "active_identity_id", "superseded_at"))
        ).alias("changes"),
    )
    next_day = F.lead("first_change").over(Window.partitionBy("identity_id").orderBy("day"))
    days = own_shuffle(days.withColumn("until", next_day).drop("day"), "identity_id")
    at = facts[ts_col]
    spans = (
        (facts["identity_id"] == days["identity_id"])
        & (at >= days["first_change"])
        & (days["until"].isNull() | (at < days["until"]))
    )
    found = facts.join(days, spans).select(
        *[facts[c] for c in facts.columns],
        F.try_element_at(F.filter(days["changes"], lambda r: r["at"] <= at), F.lit(-1)).alias("found"),
    )
    valid = F.col("found.superseded_at").isNull() | (F.col("found.superseded_at") > F.col(ts_col))
    return found.where(valid).select(*facts.columns, "found.active_identity_id")
