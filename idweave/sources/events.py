"""Reading the events table: scan, filters, arrival window, dedupe, JSON parsing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from idweave.config import IdentityConfig, RunContext
from idweave.functions.columns import utc_lit, utc_ntz


def read_events(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """The configured events table: a catalog name, or a path when it contains a slash."""
    if "/" not in location:
        return spark.table(location)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location)


def filter_app_ids(df: DataFrame, app_ids: Iterable[str]) -> DataFrame:
    """Keep only the listed apps; an empty list keeps all."""
    wanted = list(app_ids)
    return df.where(F.col("app_id").isin(wanted)) if wanted else df


def filter_event_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep only the listed event names; an empty list keeps all."""
    wanted = list(names)
    return df.where(F.col("event_name").isin(wanted)) if wanted else df


def select_run_window(
    df: DataFrame, run: RunContext, load_date_column: str | None = None
) -> DataFrame:
    """Rows that arrived inside the run's limits.

    With ``load_date_column`` the same bounds are put on the partition column so
    that only the partitions of the window are listed and read.
    """
    load, dtype = F.col("load_tstamp"), dict(df.dtypes)["load_tstamp"]
    low, high = utc_lit(run.lower, dtype), utc_lit(run.upper, dtype)
    out = df.where((load >= low if run.lower_inclusive else load > low) & (load <= high))
    if load_date_column:
        out = out.where(
            F.col(load_date_column).between(F.lit(run.lower.date()), F.lit(run.upper.date()))
        )
    return out


def dedupe_events(
    df: DataFrame, key: str = "event_id", order: str = "collector_tstamp"
) -> DataFrame:
    """One row per event id; the earliest collector time survives.

    Ties go to the earliest derived time, then to the remaining columns in order,
    so the survivor does not depend on the partitioning. Ranking stops at the
    first row on the map side already, so an id repeated a billion times is still
    one row per map task when it is shuffled.
    """
    lead = [c for c in (order, "derived_tstamp") if c in df.columns]
    rest = [c for c in df.columns if c != key and c not in lead]
    ranked = Window.partitionBy(key).orderBy(*lead, *rest)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def project_events(raw: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """The few columns the engine uses, typed. Everything else is pruned at the scan."""
    types = dict(raw.dtypes)
    first = F.get(F.col(cfg.context_column), F.lit(0))
    payload = F.col(cfg.payload_column)
    # LTZ struct fields become UTC NTZ the same way as top-level columns
    ctx_type = raw.schema[cfg.context_column].dataType.elementType
    child_type = raw.schema[cfg.payload_column].dataType["merged"].dataType.elementType

    def ts(struct: Column, struct_type: T.StructType, name: str) -> Column:
        return utc_ntz(struct[name], struct_type[name].dataType.simpleString())

    def child(c: Column) -> Column:
        return F.struct(
            c[cfg.payload_id_field].alias("identity_id"),
            ts(c, child_type, "created_at").alias("created_at"),
            ts(c, child_type, "merged_at").alias("merged_at"),
            c["triggering_event_id"].alias("triggering_event_id"),
        )

    return raw.select(
        "event_id",
        "event_name",
        "app_id",
        *[F.expr(i.expression).cast("string").alias(i.alias) for i in cfg.identifiers],
        *[
            utc_ntz(F.col(c), types[c]).alias(c)
            for c in ("collector_tstamp", "derived_tstamp", "load_tstamp")
        ],
        first[cfg.context_id_field].alias("identity_id"),
        ts(first, ctx_type, "created_at").alias("created_at"),
        payload[cfg.payload_id_field].alias("active_identity_id"),
        F.transform(payload["merged"], child).alias("merged"),
        payload["merges"].alias("merges"),
    )


def base_events_this_run(
    raw: DataFrame, cfg: IdentityConfig, run: RunContext | None = None
) -> DataFrame:
    """Filtered, windowed, projected and deduplicated events of one run."""
    events = filter_event_names(filter_app_ids(raw, cfg.app_ids), cfg.event_names)
    if run is not None:
        events = select_run_window(events, run, cfg.load_date_column)
    events = project_events(events, cfg)
    return events if cfg.events_are_unique else dedupe_events(events)


def parse_json_contexts(df: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """JSON text columns to the typed nested columns; unparsable text becomes null.

    Timestamps are read as text and cast, since ``from_json`` rejects a trailing
    ``Z`` for TIMESTAMP_NTZ fields.
    """
    cid, pid = cfg.context_id_field, cfg.payload_id_field
    ctx = F.from_json(cfg.context_column, f"array<struct<{cid}:string,created_at:string>>")
    payload = F.from_json(
        cfg.payload_column,
        f"struct<{pid}:string,merged:array<struct<{pid}:string,created_at:string,"
        "merged_at:string,triggering_event_id:string>>,merges:array<string>>",
    )

    def ntz(c: Column) -> Column:
        return c.try_cast("timestamp_ntz")

    parsed = df.withColumns({cfg.context_column: ctx, cfg.payload_column: payload})
    p = F.col(cfg.payload_column)
    return parsed.withColumns(
        {
            cfg.context_column: F.transform(
                cfg.context_column,
                lambda c: F.struct(c[cid].alias(cid), ntz(c["created_at"]).alias("created_at")),
            ),
            cfg.payload_column: F.when(
                p.isNotNull(),
                F.struct(
                    p[pid].alias(pid),
                    F.transform(
                        p["merged"],
                        lambda c: F.struct(
                            c[pid].alias(pid),
                            ntz(c["created_at"]).alias("created_at"),
                            ntz(c["merged_at"]).alias("merged_at"),
                            c["triggering_event_id"].alias("triggering_event_id"),
                        ),
                    ).alias("merged"),
                    p["merges"].alias("merges"),
                ),
            ),
        }
    )


def parse_variant_contexts(df: DataFrame, cfg: IdentityConfig) -> DataFrame:
    """:func:`parse_json_contexts` without a fixed schema of the JSON text.

    The text becomes a VARIANT, from which the known fields are taken by path: fields that
    a tracker adds are skipped, a value of another JSON type is cast, and what cannot be
    cast is null by itself instead of taking the whole row with it.
    """
    cid, pid = cfg.context_id_field, cfg.payload_id_field

    def items(v: Column, path: str) -> Column:
        return F.try_variant_get(v, path, "array<variant>")

    def text(v: Column, path: str) -> Column:
        return F.try_variant_get(v, path, "string")

    def ntz(v: Column, path: str) -> Column:
        return text(v, path).try_cast("timestamp_ntz")

    def child(v: Column) -> Column:
        return F.struct(
            text(v, f"$.{pid}").alias(pid),
            ntz(v, "$.created_at").alias("created_at"),
            ntz(v, "$.merged_at").alias("merged_at"),
            text(v, "$.triggering_event_id").alias("triggering_event_id"),
        )

    context, payload = F.try_parse_json(cfg.context_column), F.try_parse_json(cfg.payload_column)
    parsed = df.withColumns({"__context": context, "__payload": payload})
    v = F.col("__payload")
    return parsed.withColumns(
        {
            cfg.context_column: F.transform(
                items(F.col("__context"), "$"),
                lambda c: F.struct(text(c, f"$.{cid}").alias(cid), ntz(c, "$.created_at").alias("created_at")),
            ),
            cfg.payload_column: F.when(
                v.isNotNull(),
                F.struct(
                    text(v, f"$.{pid}").alias(pid),
                    F.transform(items(v, "$.merged"), child).alias("merged"),
                    F.transform(items(v, "$.merges"), lambda m: text(m, "$")).alias("merges"),
                ),
            ),
        }
    ).drop("__context", "__payload")


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with a header line, read with a given schema (no inference)."""
    return spark.read.schema(schema).csv(path, header=True)


def arrival_bounds(df: DataFrame) -> DataFrame:
    """One row: first and last ``load_tstamp`` and the row count."""
    return df.agg(
        F.min("load_tstamp").alias("first_load"),
        F.max("load_tstamp").alias("last_load"),
        F.count("*").alias("events"),
    )
