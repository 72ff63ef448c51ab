"""The same batch plan on arriving files."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from idweave.config import IdentityConfig
from idweave.plans import runs
from idweave.plans.batch import TABLES
from idweave.operators import history
from idweave.plans.tables import IdentityTables
from idweave.sources.events import base_events_this_run


def process_micro_batch(
    store: IdentityTables,
    cfg: IdentityConfig,
    stream: str,
    events: DataFrame,
    batch_id: int,
    run_tstamp: datetime,
    outputs: Iterable[str] = TABLES,
) -> set[str] | None:
    """One micro-batch through the tables; a batch that is in them already is skipped.

    The batch id is written last, so a replay after a failure either finds the batch done
    or goes through it again, which ends at the same rows.
    """
    if store.stream_batch(stream) >= batch_id:
        return None
    base = base_events_this_run(events, cfg)
    return runs.process(store, cfg, base, run_tstamp, outputs, stream_batch=(stream, batch_id))


def stream_identities(
    spark: SparkSession,
    cfg: IdentityConfig,
    store: IdentityTables,
    source: str,
    schema: T.StructType,
    checkpoint: str,
    run_tstamp: datetime | None = None,
    stream: str = "default",
    max_files_per_trigger: int | None = None,
    outputs: Iterable[str] = TABLES,
) -> StreamingQuery:
    """Consume the files that have arrived under ``source`` and stop.

    The stream's checkpoint takes the place of the manifest as the record of what
    was read. There is no watermark: late events are never dropped, they update
    the tables through the same earliest/latest rules as in a batch run. Only ``outputs``
    and the tables they are computed from are kept; a stream keeps to the same ones.
    """
    outputs = tuple(outputs)
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def handle(events: DataFrame, batch_id: int) -> None:
        now = run_tstamp or datetime.now(timezone.utc).replace(tzinfo=None)
        process_micro_batch(store, cfg, stream, events, batch_id, now, outputs)

    return (
        reader.load(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_deliveries(events: DataFrame, delay: str, key: str = "event_id", ts_col: str = "derived_tstamp") -> DataFrame:
    """A stream without events that an earlier micro-batch has brought already.

    The ids seen are kept in the state store until the watermark, the latest event time
    less ``delay``, has passed their event by ``delay`` more, so the state is bounded by
    the events of that span. An event at or before the watermark is late: it is dropped,
    whether it was seen or not, so choose a delay longer than deliveries are late.
    """
    timed = events.withColumn("__at", F.col(ts_col).cast("timestamp"))
    return timed.withWatermark("__at", delay).dropDuplicatesWithinWatermark([key]).drop("__at")


def active_as_of_stream(facts: DataFrame, scd: DataFrame, ts_col: str) -> DataFrame:
    """:func:`history.active_as_of` for a stream of facts against the history as saved.

    Each micro-batch joins its facts with the history that is stored when it runs; nothing
    is kept between batches, so a fact is not looked up again when the history changes.
    """
    return history.active_as_of(facts, scd, ts_col)
