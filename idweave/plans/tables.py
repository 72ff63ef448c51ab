"""The maintained tables as saved Spark tables of one database.

A table is a Parquet table partitioned by a key-bucket column, and clustered and sorted by
its unique key within that. An upsert keeps the stored rows whose key is not touched (an
anti join by key), adds the new ones and overwrites the partitions that hold a touched key
(dynamic partition overwrite). The bucket is Spark's own hash of the key, so a join or an
upsert on the key reads the table as it lies, without a shuffle of the stored side.

Writes are not transactions over several tables: a run that breaks off is run again, and
:func:`idweave.plans.batch.apply_batch` orders its writes so that this ends at the same
rows. One run writes a database at a time. Versions, time travel and several writers are a
table format's work and not done here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idweave import schemas

BUCKET = "bucket"
_KEY_PROPERTY, _BUCKETS_PROPERTY = "idweave.key", "idweave.buckets"

# Bucket count of each table relative to the largest one, by their usual sizes.
BUCKET_SHARE = {
    "identifier_mapping": 1.0,
    "identities": 0.5,
    "id_changes": 0.5,
    "id_mapping_scd": 0.5,
    "id_mapping": 0.25,
    "merge_events": 0.25,
}


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known to the optimiser as such, so joins against it fold away."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(*nulls).where(F.lit(False))


def buckets_for(rows: int, rows_per_bucket: int = 2_000_000) -> int:
    """A bucket count for tables made from so many events.

    A bucket is written by one task. Where identifiers rarely repeat, the lookup has nearly
    a row per event, so a bucket stands for no more events than a task should sort.
    """
    return max(4, -(-rows // rows_per_bucket))


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


class IdentityTables:
    """The tables of a database.

    ``buckets`` is the bucket count of the largest table, the others get their share of it;
    it counts when a table is made (:func:`buckets_for`). ``location`` is where the database
    lies if it is new; by default, in the session's warehouse.
    """

    def __init__(
        self, spark: SparkSession, database: str, location: str | None = None, buckets: int = 16
    ) -> None:
        self.spark = spark
        self.database = database
        self.buckets = buckets
        self._touched: dict[str, set[int]] = {}
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
        self._staging = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/run_staging"

    def name(self, table: str) -> str:
        """The table's name for SQL."""
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def bucket_count(self, table: str) -> int:
        """Buckets a table gets when it is made."""
        return max(1, round(self.buckets * BUCKET_SHARE.get(table, 1.0)))

    def _property(self, table: str, key: str) -> str:
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)} ('{key}')").first()["value"]

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table; an empty one with ``schema`` when it does not exist yet."""
        if not self.exists(table):
            if schema is None:
                raise KeyError(f"no table {table}")
            return empty_table(self.spark, schema)
        stored = self.spark.table(self.name(table)).where(F.col(self._property(table, _KEY_PROPERTY)).isNotNull())
        stored = stored.drop(BUCKET)
        for f in schema or []:
            if f.name not in stored.columns:
                stored = stored.withColumn(f.name, F.lit(None).cast(f.dataType))
        return stored

    def stage(
        self,
        name: str,
        df: DataFrame,
        partition_by: str | None = None,
        metrics: Observation | None = None,
        *sums: Column,
        plain: Iterable[str] = (),
    ) -> DataFrame:
        """Write an intermediate result that several steps of a run read, and read it back.

        It replaces that of the run before. ``metrics`` takes ``sums`` in the same pass.
        ``plain``: columns whose values hardly repeat, written without a dictionary.
        """
        path = f"{self._staging}/{name}"
        writer = (df.observe(metrics, *sums) if metrics else df).write.mode("overwrite")
        for column in plain:
            writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stage_updates(self, table: str, key: str, updates: DataFrame) -> DataFrame:
        """Rows for :meth:`upsert`, staged; the buckets they touch come out of the same pass."""
        if not self.exists(table):
            return self.stage(f"{table}_updates", updates)
        n = int(self._property(table, _BUCKETS_PROPERTY))
        seen = Observation()
        buckets = F.collect_set(self._bucket_of(key, n)).alias("buckets")  # n numbers at most
        staged = self.stage(f"{table}_updates", updates, None, seen, buckets)
        self._touched[table] = set(seen.get["buckets"])
        return staged

    def upsert(self, table: str, key: str, updates: DataFrame, deletes: DataFrame | None = None) -> None:
        """Insert or replace ``updates`` by key and drop the keys in ``deletes``.

        ``updates`` come from :meth:`stage_updates` or are staged here, unless the table is
        new. A bucket whose rows may all be deleted gets a row of nulls,
        which :meth:`read` leaves out, since a partition without rows is not overwritten.
        """
        if not self.exists(table):
            n = self.bucket_count(table)
            self.spark.sql(
                f"CREATE TABLE {self.name(table)} ({_columns(updates.schema)}, {BUCKET} int) USING parquet "
                f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({BUCKET}) "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS "
                f"TBLPROPERTIES ('{_KEY_PROPERTY}'='{key}', '{_BUCKETS_PROPERTY}'='{n}')"
            )
            self._overwrite(table, self._bucketed(updates.repartition(n, key), key, n))
            return
        n = int(self._property(table, _BUCKETS_PROPERTY))
        if table not in self._touched:
            updates = self.stage_updates(table, key, updates)
        touched = self._touched.pop(table)
        known = set(self.spark.table(self.name(table)).columns)
        new = T.StructType([f for f in updates.schema if f.name not in known])
        if len(new):
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({_columns(new)})")
        keys = updates.select(key)
        if deletes is not None:
            keys = keys.unionByName(deletes.select(key))
            touched |= {r[0] for r in deletes.select(self._bucket_of(key, n)).distinct().collect()}
        if not touched:
            return
        stored = self.spark.table(self.name(table)).where(F.col(BUCKET).isin(sorted(touched)) & F.col(key).isNotNull())
        kept = stored.join(keys.repartition(n, key), key, "left_anti")
        rows = kept.unionByName(self._bucketed(updates.repartition(n, key), key, n), allowMissingColumns=True)
        if deletes is not None:
            emptied = self.spark.range(n).where(F.col("id").isin(sorted(touched))).select(F.col("id").cast("int").alias(BUCKET))
            rows = rows.unionByName(emptied, allowMissingColumns=True)
        self._overwrite(table, rows)

    @staticmethod
    def _bucket_of(key: str, n: int) -> Column:
        return F.pmod(F.hash(key), F.lit(n))

    def _bucketed(self, rows: DataFrame, key: str, n: int) -> DataFrame:
        return rows.withColumn(BUCKET, self._bucket_of(key, n))

    def _overwrite(self, table: str, rows: DataFrame) -> None:
        name = self.name(table)
        rows.select(*self.spark.table(name).columns).write.insertInto(name, overwrite=True)

    # --- what has been consumed ---------------------------------------------------------

    def _partitioned(self, table: str, columns: str, by: str) -> str:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}, {by} string) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({by})"
        )
        return self.name(table)

    def manifest(self) -> DataFrame:
        """First and last arrival time consumed, per model."""
        name = self._partitioned("manifest", _columns(T.StructType(schemas.MANIFEST.fields[1:])), "model")
        return self.spark.table(name).where("last_success is not null").select(*schemas.MANIFEST.names)

    def write_manifest(self, rows: DataFrame) -> None:
        """Replace the manifest rows of the models in ``rows``; a row without times removes one."""
        self.manifest()
        name = self.name("manifest")
        rows.select(*self.spark.table(name).columns).coalesce(1).write.insertInto(name, overwrite=True)

    def stream_batch(self, stream: str) -> int:
        """The last batch of a stream that is in the tables; -1 for none."""
        name = self._partitioned("stream_batches", "batch_id bigint", "stream")
        row = self.spark.table(name).where(F.col("stream") == stream).agg(F.max("batch_id")).first()
        return -1 if row[0] is None else row[0]

    def write_stream_batch(self, stream: str, batch_id: int) -> None:
        name = self._partitioned("stream_batches", "batch_id bigint", "stream")
        row = self.spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(stream).alias("stream"))
        row.write.insertInto(name, overwrite=True)

    def drop_all(self) -> None:
        """Drop every table of the database."""
        for t in self.spark.catalog.listTables(self.database):
            if not t.isTemporary:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(t.name)}")
