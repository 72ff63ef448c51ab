"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key recipe.
NULL_TOKEN = "_null_"
SEPARATOR = "-"


def surrogate_key(*cols: str | Column) -> Column:
    """Deterministic md5 key over the text form of the columns."""
    parts = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(col.cast("string"), F.lit(NULL_TOKEN)))
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def hash_identifier(value: str | Column) -> Column:
    """sha256 hex of the trimmed, lower-cased value, for storing identifiers without PII."""
    col = F.col(value) if isinstance(value, str) else value
    return F.sha2(F.lower(F.trim(col)), 256)


def ntz_lit(value: datetime) -> Column:
    """A naive UTC datetime as a TIMESTAMP_NTZ literal, independent of any time zone setting."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_lit(value: datetime, dtype: str) -> Column:
    """A naive UTC datetime as a literal of the given timestamp type, for pushed-down filters."""
    if dtype == "timestamp":
        return F.lit(value.isoformat(sep=" ") + "Z").cast("timestamp")
    return ntz_lit(value)


def utc_ntz(col: Column, dtype: str) -> Column:
    """A timestamp column as UTC TIMESTAMP_NTZ, whatever the session time zone is."""
    if dtype == "timestamp":
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz"))
    return col.cast("timestamp_ntz")


def earliest(*order_then_payload: str | Column) -> Column:
    """Aggregate: the row that sorts first, as a struct.

    ``min`` over a struct compares field by field, so put the ordering columns
    first; the remaining fields are carried along and make the order total. The
    aggregate combines on the map side, so a hot group shrinks before it is
    shuffled.
    """
    return F.min(F.struct(*order_then_payload))


def latest(*order_then_payload: str | Column) -> Column:
    """Aggregate: the row that sorts last, as a struct (see :func:`earliest`)."""
    return F.max(F.struct(*order_then_payload))
