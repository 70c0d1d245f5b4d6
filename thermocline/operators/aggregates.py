"""Per-key aggregates.  Every one is a partial + final aggregate (map-side
combine), so a hot key is reduced inside each map task before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference's definitions:
# the top-2 accumulator starts both slots at the JVM's Int.MinValue (as a
# double), and the max accumulator starts at 0.0.
TOP2_PAD = -2147483648.0
MAX_FLOOR = 0.0


def count_per_key(df: DataFrame, key: str, out: str = "num") -> DataFrame:
    """``groupBy(key).select(key, key.count)``: non-null key values count."""
    return df.groupBy(key).agg(F.count(key).alias(out))


def avg_per_key(df: DataFrame, key: str, value: str, out: str = "avg_value") -> DataFrame:
    """The sum/count average aggregate function."""
    return df.groupBy(key).agg(F.avg(value).alias(out))


def max_floor_per_key(df: DataFrame, key: str, value: str, out: str = "max_value",
                      floor: float = MAX_FLOOR) -> DataFrame:
    """Maximum whose accumulator starts at ``floor``: a group of only smaller
    values yields ``floor``."""
    return df.groupBy(key).agg(F.greatest(F.lit(floor), F.max(value)).alias(out))


def top2_padded(df: DataFrame, key: str, value: str, value_out: str = "temp",
                rank_out: str = "rank", pad: float = TOP2_PAD) -> DataFrame:
    """Two rows per key, ``(value, rank)`` for ranks 1 and 2.

    The accumulator replaces a slot only on a strictly greater value, so
    equal maxima fill both ranks, and values that are not greater than the
    pad (or NaN) never enter; a missing rank gets the pad.

    Plan: ``row_number() <= 2`` lets Catalyst insert a partial window-group
    limit before the shuffle (each map task sends at most 2 rows per key),
    then a group-by on the already key-partitioned result pads the ranks."""
    eligible = (F.col(value).isNotNull() & ~F.isnan(value) & (F.col(value) > F.lit(pad)))
    w = Window.partitionBy(key).orderBy(eligible.desc(), F.col(value).desc())
    top = (df.select(key, value, eligible.alias("_e"), F.row_number().over(w).alias("_r"))
           .where("_r <= 2"))
    per_key = top.groupBy(key).agg(
        F.max(F.when((F.col("_r") == 1) & F.col("_e"), F.col(value))).alias("_v1"),
        F.max(F.when((F.col("_r") == 2) & F.col("_e"), F.col(value))).alias("_v2"))
    slots = F.array(
        F.struct(F.coalesce("_v1", F.lit(pad)).alias("v"), F.lit(1).alias("r")),
        F.struct(F.coalesce("_v2", F.lit(pad)).alias("v"), F.lit(2).alias("r")))
    return (per_key.select(key, F.explode(slots).alias("_s"))
            .select(key, F.col("_s.v").alias(value_out), F.col("_s.r").alias(rank_out)))


def max_by_in_window(df: DataFrame, key: str, ts: str, value: str, tiebreak: str,
                     size: str, carry: list[str]) -> DataFrame:
    """Per key and tumbling window, the row with the largest ``value``;
    on a tie the first arrival (smallest ``tiebreak``) wins."""
    ordering = F.struct(F.col(value), (-F.col(tiebreak)).alias("_first"))
    best = F.max_by(F.struct(*[F.col(c) for c in carry]), ordering)
    g = df.groupBy(key, F.window(ts, size).alias("_w")).agg(best.alias("_b"))
    return g.select(key, F.col("_w.start").alias("window_start"),
                    F.col("_w.end").alias("window_end"),
                    *[F.col(f"_b.{c}").alias(c) for c in carry])


def latest_per_key(df: DataFrame, key: str, ts: str, tiebreak: str,
                   carry: list[str]) -> DataFrame:
    """Latest row per key by ``(ts, tiebreak)`` — the state an upsert sink
    holds for each document id."""
    best = F.max_by(F.struct(*[F.col(c) for c in carry]), F.struct(F.col(ts), F.col(tiebreak)))
    return df.groupBy(key).agg(best.alias("_b")).select(key, *[F.col(f"_b.{c}").alias(c) for c in carry])
