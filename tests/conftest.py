import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("idweave-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    """'03 10:05' -> 3 June 2024, 10:05; seconds optional."""
    if text is None:
        return None
    day, clock = text.split(" ")
    parts = [int(p) for p in clock.split(":")]
    return datetime(2024, 6, int(day), *parts)


@pytest.fixture(scope="session")
def table(spark):
    """Build a DataFrame from a schema and rows; 'DD HH:MM' text becomes a timestamp."""
    from pyspark.sql import types as T

    from idweave.plans.tables import empty_table

    def make(schema, rows):
        if not rows:
            return empty_table(spark, schema)
        typed = [
            tuple(
                at(v) if isinstance(f.dataType, T.TimestampNTZType) and isinstance(v, str) else v
                for f, v in zip(schema.fields, row, strict=True)
            )
            for row in rows
        ]
        return spark.createDataFrame(typed, schema)

    return make


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples of the named columns, times as 'DD HH:MM[:SS]'."""

    def show(v):
        if isinstance(v, datetime):
            text = v.strftime("%d %H:%M:%S")
            return text.removesuffix(":00") if text.endswith(":00") else text
        return v

    def get(df, *cols):
        picked = df.select(*cols) if cols else df
        out = [tuple(show(v) for v in r) for r in picked.collect()]
        return sorted(out, key=lambda r: [str(x) for x in r])

    return get
