"""Handing the tables to readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave import schemas
from idweave.config import IdentityConfig
from idweave.plans.tables import IdentityTables


# Order of the rows in an export, so that file and row-group statistics can prune.
CLUSTER_BY = {
    "merge_events": ["active_identity_id"],
    "identities": ["identity_id"],
    "id_mapping": ["active_identity_id", "identity_id"],
    "id_changes": ["identity_id", "previous_identity_id"],
    "identifier_mapping": ["active_identity_id", "uuid"],
    "id_mapping_scd": ["identity_id", "active_identity_id"],
}

# Time column each table is partitioned by when it is exported by day.
DAY_OF = {
    "merge_events": "derived_tstamp",
    "identities": "first_derived_tstamp",
    "id_mapping": "merged_at",
    "id_changes": "effective_at",
    "identifier_mapping": "last_seen_at",
    "id_mapping_scd": "effective_at",
}


def layout(df: DataFrame, table: str, partitions: int | None = None) -> DataFrame:
    """Add the table's day column and cluster its rows for an export by day.

    Rows of a day are spread over tasks by the clustering columns as well as the
    day, so one busy day is not one task.
    """
    day = f"{DAY_OF[table]}_date"
    cluster = CLUSTER_BY[table]
    dated = df.withColumn(day, F.to_date(DAY_OF[table]))
    cols = [F.col(day), *[F.col(c) for c in cluster]]
    spread = (
        dated.repartitionByRange(partitions, *cols)
        if partitions
        else dated.repartitionByRange(*cols)
    )
    return spread.sortWithinPartitions(*cols)


def write_full(df: DataFrame, path: str, table: str) -> None:
    """Full (re)build of a table as day-partitioned parquet."""
    day = f"{DAY_OF[table]}_date"
    layout(df, table).write.mode("overwrite").partitionBy(day).parquet(path)


def _renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names})


def create_views(
    store: IdentityTables,
    cfg: IdentityConfig,
    prefix: str = "",
    names: Mapping[str, str] | None = None,
) -> list[str]:
    """Temporary views over the tables, columns renamed by ``names``.

    Existing queries keep working with the table and column names they know.
    """
    made = []
    for table, schema in schemas.tables(cfg).items():
        view = f"{prefix}{table}"
        _renamed(store.read(table, schema), names or {}).createOrReplaceTempView(view)
        made.append(view)
    return made


def export_tables(store: IdentityTables, cfg: IdentityConfig, path: str) -> list[str]:
    """Write every table as day-partitioned, clustered parquet under ``path``."""
    written = []
    for table, schema in schemas.tables(cfg).items():
        target = f"{path.rstrip('/')}/{table}"
        write_full(store.read(table, schema), target, table)
        written.append(target)
    return written
