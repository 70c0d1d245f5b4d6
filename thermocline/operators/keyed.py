"""Batch forms of the keyed-state jobs, exact in event time and skew-safe.

* :func:`sessions` — session windows per key (gap: a row exactly ``gap``
  after the previous one joins the session, as Spark's ``session_window``);
* :func:`count_trigger_avg` — "emit (key, count, average) every
  ``threshold`` readings and clear; state expires ``ttl`` after its last
  write";
* :func:`changelog_count` — the retract stream of a running count;
* :func:`control_block` — a control stream blocks keys on a data stream.

Hot keys are handled by the segment layout of :mod:`.segments`; the
streaming forms are in :mod:`thermocline.streaming.stateful`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_micros, epoch_ntz
from ..session import materialize
from .segments import HOT, SEG, global_row_number, hash_tiebreak, segment, with_row_offsets


def _ntz_from_micros(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", c, epoch_ntz())


def sessions(df: DataFrame, keys: list[str], ts: str, gap_seconds: int,
             count_col: str | None = None, target_rows: int | None = None,
             naive: bool = True) -> DataFrame:
    """``Session.withGap(gap).on(ts).groupBy(session, key).select(key,
    count, start, end)``: one row per key and session; end = last + gap.
    ``count`` is ``count(key)`` unless ``count_col`` is given.

    Sessions are found per (key, segment) with Spark's ``session_window``.
    In a hot key only the first and last session of each segment can join
    a neighbouring segment; those (two per segment, a bounded table) are
    merged with a lag over the key, the rest are final."""
    gap = int(gap_seconds) * 1_000_000
    d = df.withColumn("_t", epoch_micros(ts, naive))
    sg = segment(d, keys, "_t", target_rows, hash_tiebreak(d))
    cnt = F.count(count_col or keys[0])
    local = (sg.frame.groupBy(*keys, SEG, F.session_window(ts, f"{int(gap_seconds)} seconds"))
             .agg(cnt.alias("cnt"), F.min("_t").alias("_first"), F.max("_t").alias("_last"),
                  F.max(HOT).alias(HOT))  # constant per key; max is deterministic
             .drop("session_window"))

    def finish(x: DataFrame) -> DataFrame:
        return x.select(*keys, _ntz_from_micros(F.col("_first")).alias("session_start"),
                        _ntz_from_micros(F.col("_last") + gap).alias("session_end"),
                        F.col("cnt").cast("long").alias("cnt"))

    if not sg.split:
        return finish(local)
    ws = Window.partitionBy(*keys, SEG)
    marked = (local.withColumn("_a", F.row_number().over(ws.orderBy(F.col("_first"))))
              .withColumn("_z", F.row_number().over(ws.orderBy(F.col("_first").desc()))))
    edge = F.col(HOT) & ((F.col("_a") == 1) | (F.col("_z") == 1))
    final = marked.where(~edge)
    edges = marked.where(edge)
    wk = Window.partitionBy(*keys).orderBy(SEG, "_first")
    prev_last = F.max("_last").over(wk.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(prev_last.isNull() | (F.col("_first") - prev_last > gap), 1).otherwise(0)
    grp = F.sum("_new").over(wk.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = (edges.withColumn("_new", new).withColumn("_g", grp)
              .groupBy(*keys, "_g")
              .agg(F.sum("cnt").alias("cnt"), F.min("_first").alias("_first"),
                   F.max("_last").alias("_last")))
    return finish(final).unionByName(finish(merged))


def count_trigger_avg(df: DataFrame, keys: list[str], ts: str, value: str,
                      tiebreak: list[str], ttl_seconds: int, threshold: int = 2,
                      target_rows: int | None = None, naive: bool = True) -> DataFrame:
    """Per key, in time order: add each reading to (count, sum); when count
    reaches ``threshold`` emit ``(key, count, sum/count)`` and clear.  State
    not written for ``ttl_seconds`` or more is gone when the next reading
    arrives.

    Equivalent batch form: a gap >= ttl starts a new run; within a run,
    consecutive chunks of ``threshold`` rows; only full chunks emit.  The
    run start of every row is a running max of flagged row numbers, carried
    across segments through a per-segment table (bounded: one row per hot
    segment), so a hot key never sits in one task."""
    ttl = int(ttl_seconds) * 1_000_000
    d = df.withColumn("_t", epoch_micros(ts, naive))
    sg = segment(d, keys, "_t", target_rows, tiebreak)
    f = with_row_offsets(sg)
    w = sg.seg_window().orderBy(F.col("_t"), *[F.col(c) for c in tiebreak])
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def flagged(x: DataFrame) -> DataFrame:
        rn = (F.row_number().over(w) + F.col("_before")).cast("long")
        prev = F.coalesce(F.lag("_t").over(w), F.col("_prev_last"))
        return (x.withColumn("_rn", rn)
                .withColumn("_start", prev.isNull() | (F.col("_t") - prev >= ttl)))

    base = f
    f = flagged(base)
    f = f.withColumn("_rs", F.max(F.when(F.col("_start"), F.col("_rn"))).over(run))
    if sg.split:
        # Carry-in per hot segment: the last run start of the key before it.
        # A separate narrow pass over hot-key rows only, materialised (one
        # row per hot segment), so the main pass shuffles the input once.
        hot_rows = flagged(base.where(F.col(HOT)).select(*keys, SEG, "_t", *tiebreak, "_before",
                                                       "_prev_last"))
        per_seg = hot_rows.groupBy(*keys, SEG).agg(
            F.max(F.when(F.col("_start"), F.col("_rn"))).alias("_ls"))
        prior = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        carry = materialize(per_seg.select(*keys, SEG, F.max("_ls").over(prior).alias("_carry")))
        f = sg.attach(f, ["_carry"], table=carry)
        f = f.withColumn("_rs", F.coalesce("_rs", "_carry"))
    chunk = F.floor((F.col("_rn") - F.col("_rs")) / threshold).cast("long")
    # Chunks are grouped where the rows already are: the window partitioned
    # the rows by (key, segment), which also clusters (key, segment, run,
    # chunk), so this aggregate needs no second shuffle of the input.  Only a
    # chunk of a hot key that straddles a segment boundary arrives in two
    # parts; the incomplete parts of hot keys are merged by a small shuffle.
    local = (f.groupBy(*keys, SEG, F.col("_rs"), chunk.alias("_chunk"))
             .agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).alias("_sum"),
                  F.count(value).alias("_nv"), F.max(ts).alias("emit_ts"), F.max(HOT).alias("_h")))
    cols = [*keys, "cnt", F.when(F.col("_nv") > 0, F.col("_sum") / F.col("_nv")).alias("avg_value"),
            "emit_ts"]
    if not sg.split:
        return local.where(F.col("cnt") == threshold).select(*cols)
    # ``_h`` is never NULL; reading it keeps this branch's input columns equal
    # to the other branch's, so both share one exchange of the input
    done = local.where((F.col("cnt") == threshold) & F.col("_h").isNotNull()).select(*cols)
    parts = (local.where((F.col("cnt") < threshold) & F.col("_h"))
             .groupBy(*keys, "_rs", "_chunk")
             .agg(F.sum("cnt").alias("cnt"), F.sum("_sum").alias("_sum"), F.sum("_nv").alias("_nv"),
                  F.max("emit_ts").alias("emit_ts"))
             .where(F.col("cnt") == threshold).select(*cols))
    return done.unionByName(parts)


def changelog_count(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str],
                    carry: list[str], target_rows: int | None = None,
                    naive: bool = True) -> DataFrame:
    """Retract stream of ``groupBy(key).count`` in arrival (time) order:
    the n-th row of a key yields ``(false, n-1)`` (if n > 1) then
    ``(true, n)``.  Sum of adds minus retracts = the final count.
    ``count(key)`` of the NULL key stays 0: one addition."""
    d = df.withColumn("_t", epoch_micros(ts, naive))
    _, f = global_row_number(d, keys, "_t", tiebreak, target_rows)
    add = F.struct(F.lit(True).alias("is_add"), F.col("_rn").alias("num"), F.lit(2).alias("_o"))
    ret = F.struct(F.lit(False).alias("is_add"), (F.col("_rn") - 1).alias("num"), F.lit(1).alias("_o"))
    none = F.struct(F.lit(True).alias("is_add"), F.lit(0).cast("long").alias("num"), F.lit(2).alias("_o"))
    rows = (F.when(F.col(keys[0]).isNull(), F.when(F.col("_rn") == 1, F.array(none)))
            .when(F.col("_rn") > 1, F.array(ret, add)).otherwise(F.array(add)))
    return (f.select(*keys, *carry, F.explode(rows).alias("_c"))
            .select(*keys, *carry, F.col("_c.is_add").alias("is_add"),
                    F.col("_c.num").cast("long").alias("num")))


def control_block(data: DataFrame, control: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows of ``data`` whose key was not blocked before them: a control row
    blocks its key from its own time on (ties: control first).  Batch form:
    anti-join on the first control time per key, which is a partial
    aggregate.  The per-key table stays lazy: Spark broadcasts it only if its
    measured size is under the broadcast threshold, else the join shuffles
    (AQE splits a hot key)."""
    first = control.groupBy(F.col(key).alias("_bk")).agg(F.min(ts).alias("_block_from"))
    cond = (data[key] == first["_bk"]) & (first["_block_from"] <= data[ts])
    return data.join(first, cond, "left_anti")


def additions(changelog: DataFrame, flag: str = "is_add") -> DataFrame:
    """Keep only the additions of a retract changelog (``filter(_._1)``):
    one row per input row carrying the new value."""
    return changelog.where(F.col(flag)).drop(flag)
