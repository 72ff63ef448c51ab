"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(sid, root): the smallest id that every node with an edge (a, b) can reach.

    Each round gives a node the smallest root among itself and its neighbours and then
    follows that root's own root, so path lengths halve and the number of rounds is
    about the logarithm of the longest chain. Every round is a written table under
    ``folder``. A hub's edges combine before they shuffle.
    """
    spark = edges.sparkSession
    both = edges.where("a <> b").select("a", "b").unionByName(
        edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    both = both.distinct()
    both.write.parquet(f"{folder}/edges")
    both = spark.read.schema(both.schema).parquet(f"{folder}/edges")
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "sid")
    labels.write.parquet(f"{folder}/round-0")
    labels = spark.read.schema("sid long, root long").parquet(f"{folder}/round-0")
    step = 0
    while True:
        step += 1
        neighbour = both.join(labels, both["b"] == labels["sid"]).groupBy("a").agg(F.min("root").alias("near"))
        nearest = (
            labels.join(neighbour, labels["sid"] == neighbour["a"])
            .select("sid", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        )
        jump = labels.select(F.col("sid").alias("root"), F.col("root").alias("next"))
        moved = nearest.join(jump, "root", "left").select(
            "sid", "was", F.least("root", F.coalesce("next", "root")).alias("root")
        )
        moved.write.parquet(f"{folder}/round-{step}")
        moved = spark.read.schema("sid long, was long, root long").parquet(f"{folder}/round-{step}")
        labels = moved.select("sid", "root")
        if moved.where("was <> root").isEmpty():
            return labels
