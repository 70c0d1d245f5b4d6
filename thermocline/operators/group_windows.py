"""Group windows: one row per key and window (tumbling, sliding, session),
with the window properties start, end and rowtime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rowtime(end: Column) -> Column:
    """The window's rowtime attribute: its end minus one millisecond."""
    return end - F.expr("INTERVAL 1 MILLISECOND")


def window_count(df: DataFrame, key: str, ts: str, size: str, slide: str | None = None,
                 count_col: str | None = None, out: str = "cnt") -> DataFrame:
    """``window(Tumble|Slide over size [every slide] on ts).groupBy(w, key)
    .select(key, count, w.start, w.end, w.rowtime)``.  A partial + final
    aggregate on (window, key); works unchanged on a streaming DataFrame."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = df.groupBy(F.col(key), w.alias("_w")).agg(F.count(count_col or key).alias(out))
    return g.select(key, out, F.col("_w.start").alias("window_start"),
                    F.col("_w.end").alias("window_end"),
                    rowtime(F.col("_w.end")).alias("window_rowtime"))


def tumble_count(df, key, ts, size, **kw) -> DataFrame:
    return window_count(df, key, ts, size, None, **kw)


def hop_count(df, key, ts, size, slide, **kw) -> DataFrame:
    return window_count(df, key, ts, size, slide, **kw)


def session_count(df: DataFrame, key: str, ts: str, gap: str, count_col: str | None = None,
                  out: str = "cnt") -> DataFrame:
    """``Session.withGap(gap).on(ts)``: one row per key and session, on a
    stream (``ts`` watermarked) as on a batch table.  For batch tables with
    hot keys see :func:`..keyed.sessions`."""
    g = df.groupBy(F.col(key), F.session_window(ts, gap).alias("_w")).agg(F.count(count_col or key).alias(out))
    return g.select(key, out, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"))
