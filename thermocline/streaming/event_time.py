"""Event time, watermarks and processing time for batch and streaming
DataFrames (one loader for every declaration style of the reference:
``'ts.rowtime`` on a field, a descriptor ``Rowtime().timestampsFromField``,
DDL ``WATERMARK FOR``, an assigner with bounded out-of-orderness, and
ascending timestamps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import as_instant


def event_time_col(df: DataFrame, col: str, unit: str):
    """A TIMESTAMP column from ``col`` given in ``unit``: ``s``, ``ms``,
    ``us`` (epoch numbers), ``ntz`` (TIMESTAMP_NTZ, read as UTC) or
    ``timestamp``."""
    c = F.col(col)
    if unit == "s":
        return F.timestamp_seconds(c)
    if unit == "ms":
        return F.timestamp_millis(c)
    if unit == "us":
        return F.timestamp_micros(c)
    if unit == "ntz":
        return as_instant(c)
    if unit == "timestamp":
        return c
    raise ValueError(f"unknown time unit {unit!r}")


def with_event_time(df: DataFrame, col: str, unit: str = "s", delay: str | None = "2 seconds",
                    out: str = "ts", keep_source: bool = True) -> DataFrame:
    """Declare ``out`` as the event-time attribute: replace ``col`` (when
    ``out == col`` or ``keep_source`` is false) or append it, then attach a
    bounded out-of-orderness watermark of ``delay`` (``None``: no watermark,
    e.g. for batch use)."""
    ts = event_time_col(df, col, unit)
    res = df.withColumn(out, ts)
    if not keep_source and out != col:
        res = res.drop(col)
    if delay is not None:
        res = res.withWatermark(out, delay)
    return res


def ascending(df: DataFrame, col: str, unit: str = "s", out: str = "ts") -> DataFrame:
    """Ascending timestamps: a watermark that trails the maximum by zero."""
    return with_event_time(df, col, unit, "0 seconds", out)


def with_proctime(df: DataFrame, out: str = "pt") -> DataFrame:
    """Processing-time attribute (``'pt.proctime``, ``PROCTIME()``,
    ``LOCALTIMESTAMP``): one value per micro-batch."""
    return df.withColumn(out, F.current_timestamp())


def with_local_time(df: DataFrame, out: str = "pt") -> DataFrame:
    """``select *, LOCALTIMESTAMP as pt`` — wall clock in the session zone."""
    return df.select("*", F.localtimestamp().alias(out))


def merged_sources(streams: list[DataFrame], policy: str = "min") -> DataFrame:
    """The union of streams that carry a watermark each, columns by name.  With
    policy ``min`` the slowest source holds event time back (no row of it is
    late); with ``max`` the fastest leads, so windows close while a source is
    idle, and what the idle one delivers afterwards may be late.  The policy
    is the session's and is fixed in a query's checkpoint at its first start."""
    if policy not in ("min", "max"):
        raise ValueError(f"unknown watermark policy {policy!r}")
    streams[0].sparkSession.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    out = streams[0]
    for other in streams[1:]:
        out = out.unionByName(other)
    return out
