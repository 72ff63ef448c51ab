"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from idweave.plans.tables import IdentityTables


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    A session without one gets a temporary folder only in local mode, where the driver
    and the executors are one process; on a cluster a machine-local folder would lose
    rows, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="idweave-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_tables(spark: SparkSession, name: str, buckets: int) -> IdentityTables:
    """Tables of a new database that lies in a folder of :func:`scratch_dir`."""
    folder = scratch_dir(spark, name)
    return IdentityTables(spark, folder.rsplit("/", 1)[1].replace("-", "_"), folder, buckets)
