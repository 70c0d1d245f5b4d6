"""Keyed-state operators for Structured Streaming, on
``groupBy(key).applyInPandasWithState``.

Spark has no built-in for these: a count-triggered average with state
expiry, a control stream that blocks keys, OVER frames on a stream (which
Structured Streaming rejects), the per-row retract changelog of a running
count, and the top-2 table aggregate (window functions are not allowed on
streams).  Rows of one key in a micro-batch arrive as pandas batches and are
applied in event-time order (ties by an id column) with numpy.  Keys keep
their own type, a NULL key is a key of its own, and NULL and NaN values are
told apart by a flag column (pandas cannot).  Times cross the Python boundary
as epoch microseconds, never as zone-dependent timestamps.

A hot key is one group per micro-batch — keyed state is sequential per key by
definition — so bound the first micro-batches with the source's
``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``; the state per key is O(1)
(O(frame) for OVER), and that of an idle RANGE frame is removed once the
watermark has left it behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _concat(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = [b for b in batches if len(b)]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()


def _micros(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("_t", F.unix_micros(F.col(ts)))


def _type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def _same_key(k: tuple, n: int) -> pd.Series:
    """The group's key for ``n`` rows, NULL as None."""
    return pd.Series([None if k[0] is None or k[0] != k[0] else k[0]] * n, dtype=object)


def _is_null(k: tuple) -> bool:
    return k[0] is None or k[0] != k[0]


def _doubles(name: str, values: np.ndarray, known: np.ndarray) -> dict:
    """A double column for pandas, which turns NaN into NULL on its way out:
    NaN goes in a flag column beside it (see :func:`_with_nan`)."""
    nan = known & np.isnan(values)
    return {name: pd.Series(values, dtype=object).where(known & ~nan, None), "_nan": nan}


def _with_nan(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col("_nan"), F.lit(float("nan"))).otherwise(F.col(name))).drop("_nan")


# --- count-triggered average with TTL ------------------------------------

def count_trigger_avg_stream(df: DataFrame, key: str, ts: str, value: str, id_col: str,
                            threshold: int = 2, ttl_seconds: int = 120,
                            processing_time: bool = False) -> DataFrame:
    """Per key keep (count, sum); at ``count >= threshold`` emit
    ``(key, count, average of the non-NULL values, emit_ts)`` and clear.
    State whose last write (the latest event time seen) is ``ttl_seconds`` or
    more before a reading is expired for it; a timeout removes idle state once
    the watermark passes its expiry, or with ``processing_time`` once the
    state has not been written for that long on the clock.  ``df`` needs a
    watermark on ``ts`` for the event-time timeout."""
    ttl = int(ttl_seconds) * 1_000_000
    out_schema = f"{key} {_type(df, key)}, cnt long, avg_value double, _nan boolean, emit_t long"
    state_schema = "cnt long, n_values long, total double, last_t long"

    def fn(k, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pdf = _concat(batches)
        if not len(pdf):
            return
        cnt, values, total, last = state.get if state.exists else (0, 0, 0.0, None)
        pdf = pdf.sort_values(["_t", id_col], kind="stable")
        t = pdf["_t"].to_numpy(dtype=np.int64)
        null = pdf["_null"].to_numpy(dtype=bool)
        v = np.where(null, 0.0, pdf["_v"].to_numpy(dtype=np.float64))
        # a gap >= ttl since the latest time so far expires the state: a new
        # run starts there (rows of an older time never move it back)
        seen = np.maximum.accumulate(t if last is None else np.r_[last, t])
        prev = seen[:-1] if last is not None else np.r_[t[0], seen[:-1]]
        reset = (t - prev) >= ttl
        if last is None:
            reset[0] = True
        run = np.cumsum(reset)                     # run 0 continues the state
        start = np.maximum.accumulate(np.where(reset, np.arange(len(t)), 0))
        pos = np.arange(len(t)) - start + np.where(run == 0, cnt, 0)
        chunk = pos // threshold
        at = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (chunk[1:] != chunk[:-1])])
        n = np.diff(np.r_[at, len(t)])
        nv, s, emit = np.add.reduceat(~null, at, dtype=np.int64), np.add.reduceat(v, at), np.maximum.reduceat(t, at)
        if run[0] == 0:                            # the first chunk goes on with the state's readings
            n[0], nv[0], s[0] = n[0] + cnt, nv[0] + values, s[0] + total
        full = n == threshold
        if full[-1]:
            state.remove()
        else:
            last = int(seen[-1])
            state.update((int(n[-1]), int(nv[-1]), float(s[-1]), last))
            if processing_time:
                state.setTimeoutDuration(ttl // 1000)
            else:
                state.setTimeoutTimestamp(max(last + ttl, state.getCurrentWatermarkMs() * 1000 + 1_000) // 1000)
        if full.any():
            avg = _doubles("avg_value", s[full] / np.maximum(nv[full], 1), nv[full] > 0)
            yield pd.DataFrame({key: _same_key(k, int(full.sum())), "cnt": n[full], **avg, "emit_t": emit[full]})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if processing_time else GroupStateTimeout.EventTimeTimeout
    src = _micros(df, ts).select(key, "_t", F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("_v"),
                                 F.col(value).isNull().alias("_null"), id_col, ts)
    res = src.groupBy(key).applyInPandasWithState(fn, out_schema, state_schema, "append", timeout)
    return _with_nan(res, "avg_value").withColumn("emit_ts", F.timestamp_micros("emit_t")).drop("emit_t")


# --- control stream blocks keys ------------------------------------------

def control_block_stream(data: DataFrame, control: DataFrame, key: str, ts: str,
                         id_col: str) -> DataFrame:
    """Emit ``data`` rows whose key has not been blocked by a ``control`` row
    seen before (arrival order across micro-batches; inside a micro-batch
    event-time order, control first on ties).  A NULL key equals no control
    key, so it is never blocked.  State: one flag per key."""
    kind = _type(data, key)
    tagged = (_micros(data, ts).select(key, "_t", id_col, F.lit(1).alias("_side"))
              .unionByName(_micros(control, ts).where(F.col(key).isNotNull()).select(
                  F.col(key).cast(kind).alias(key), "_t",
                  # a typed dummy id (the side tag tells control rows apart): a
                  # NULL would turn the id column into floats in pandas
                  F.lit(0).cast(data.schema[id_col].dataType).alias(id_col),
                  F.lit(0).alias("_side"))))
    out_schema = f"{key} {kind}, {id_col} {_type(data, id_col)}, t long"

    def fn(k, batches, state: GroupState):
        pdf = _concat(batches)
        blocked = bool(state.exists and state.get[0])
        if len(pdf):
            pdf = pdf.sort_values(["_t", "_side"], kind="stable")
            side = pdf["_side"].to_numpy()
            controls = np.flatnonzero(side == 0)
            cut = 0 if blocked else (int(controls[0]) if len(controls) else len(side))
            keep = pdf.iloc[:cut]
            keep = keep[keep["_side"] == 1]
            if blocked or len(controls):
                state.update((True,))
            if len(keep):
                yield pd.DataFrame({key: _same_key(k, len(keep)), id_col: keep[id_col].to_numpy(),
                                    "t": keep["_t"].to_numpy()})

    res = tagged.groupBy(key).applyInPandasWithState(
        fn, out_schema, "blocked boolean", "append", GroupStateTimeout.NoTimeout)
    return res.withColumn(ts, F.timestamp_micros("t")).drop("t")


# --- OVER frames on a stream ---------------------------------------------

def over_stream(df: DataFrame, key: str, ts: str, id_col: str, frame: str, preceding: int | None,
                value: str | None = None, agg: str = "count", out: str = "cnt") -> DataFrame:
    """``agg(value) OVER (PARTITION BY key ORDER BY ts <frame>)`` per input row
    on a stream.  Rows are buffered until the watermark passes them, then
    emitted in (ts, id) order; the state keeps the pending rows and only the
    frame's tail (last ``preceding`` rows for ROWS, last ``preceding``
    seconds for RANGE, running totals for UNBOUNDED).  Rows at or behind the
    watermark on arrival are late and dropped.  ``count`` is ``count(key)``;
    other aggregates read ``value`` with Spark's rules: NULL is left out (NULL
    if nothing is left), NaN spoils sums and is above every number."""
    assert frame in ("rows", "range") and agg in ("count", "sum", "min", "max", "avg")
    width = None if preceding is None else (int(preceding) if frame == "rows"
                                            else int(preceding) * 1_000_000)
    state_schema = ("p_t array<long>, p_id array<long>, p_v array<double>, p_null array<boolean>, "
                    "c_t array<long>, c_v array<double>, c_null array<boolean>, "
                    "n long, nn long, s double, mn double, mx double")
    out_schema = f"{key} {_type(df, key)}, {id_col} long, t long, {out} {'long' if agg == 'count' else 'double'}, _nan boolean"

    def spans(v, null, lo, hi):
        """Aggregate of each [lo, hi) and its number of non-NULL values."""
        pairs = np.column_stack([lo, hi]).ravel()
        part = lambda op, x, fill: op.reduceat(np.r_[x, fill], pairs)[::2]
        nn = part(np.add, (~null).astype(np.int64), 0)
        if agg in ("sum", "avg"):
            return part(np.add, np.where(null, 0.0, v), 0.0), nn
        if agg == "max":
            return part(np.maximum, np.where(null, -np.inf, v), -np.inf), nn
        return part(np.fmin, np.where(null, np.nan, v), np.nan), nn

    def fn(k, batches, state: GroupState):
        wm = state.getCurrentWatermarkMs() * 1000
        if state.exists:
            old = state.get
            n, nn, s, mn, mx = old[7:]
        else:
            old = ([],) * 7
            n, nn, s, mn, mx = 0, 0, 0.0, float("nan"), float("-inf")
        kinds = (np.int64, np.int64, np.float64, bool, np.int64, np.float64, bool)
        p_t, p_id, p_v, p_null, c_t, c_v, c_null = (np.array(x, dtype=d) for x, d in zip(old, kinds))
        pdf = _concat(batches)
        if len(pdf):
            pdf = pdf[pdf["_t"] > wm]
            p_t, p_id, p_v, p_null = (np.r_[p, pdf[c].to_numpy(dtype=p.dtype)] for p, c in (
                (p_t, "_t"), (p_id, id_col), (p_v, "_v"), (p_null, "_null")))
        order = np.lexsort((p_id, p_t))
        p_t, p_id, p_v, p_null = p_t[order], p_id[order], p_v[order], p_null[order]
        m = int(np.searchsorted(p_t, wm, side="right"))
        t, ids, v, null = p_t[:m], p_id[:m], p_v[:m], p_null[:m]
        res = None
        if m and width is None:
            # running totals; peers of a RANGE frame share the last one's
            pick = np.arange(m) if frame == "rows" else np.searchsorted(t, t, side="right") - 1
            count = nn + np.cumsum(~null)
            if agg in ("count", "sum", "avg"):
                total = s + np.cumsum(np.where(null, 0.0, v))
                s = float(total[-1])
            elif agg == "max":
                total = np.maximum.accumulate(np.r_[mx, np.where(null, -np.inf, v)])[1:]
                mx = float(total[-1])
            else:
                total = np.fmin.accumulate(np.r_[mn, np.where(null, np.nan, v)])[1:]
                mn = float(total[-1])
            rows = (n + 1 + np.arange(m))[pick]
            res, have = total[pick], count[pick]
            n, nn = n + m, int(count[-1])
        elif m:
            all_t, all_v, all_null = np.r_[c_t, t], np.r_[c_v, v], np.r_[c_null, null]
            here = len(c_t) + np.arange(m)
            if frame == "rows":
                lo, hi = np.maximum(here - width, 0), here + 1
                keep = max(0, len(all_t) - width)
            else:
                lo, hi = np.searchsorted(all_t, t - width, "left"), np.searchsorted(all_t, t, "right")
                keep = int(np.searchsorted(all_t, t[-1] - width, "left"))
            rows = hi - lo
            res, have = (rows, rows) if agg == "count" else spans(all_v, all_null, lo, hi)
            c_t, c_v, c_null = all_t[keep:], all_v[keep:], all_null[keep:]
        if frame == "range" and width is not None:
            # no row still to come can reach behind the watermark less the frame
            keep = int(np.searchsorted(c_t, wm - width, "left"))
            c_t, c_v, c_null = c_t[keep:], c_v[keep:], c_null[keep:]
        p_t, p_id, p_v, p_null = p_t[m:], p_id[m:], p_v[m:], p_null[m:]
        if not len(p_t) and not len(c_t) and width is not None:
            if state.exists:
                state.remove()
        else:
            state.update((*(x.tolist() for x in (p_t, p_id, p_v, p_null, c_t, c_v, c_null)), n, nn, s, mn, mx))
            if len(p_t):
                state.setTimeoutTimestamp(max(int(p_t[0]), wm + 1) // 1000 + 1)
            elif frame == "range" and width is not None:
                state.setTimeoutTimestamp(max(int(c_t[-1]) + width, wm + 1) // 1000 + 1)
        if m:
            if agg == "count":
                got = {out: np.zeros(m, np.int64) if _is_null(k) else rows, "_nan": False}
            else:
                got = _doubles(out, res / np.maximum(have, 1) if agg == "avg" else res, have > 0)
            yield pd.DataFrame({key: _same_key(k, m), id_col: ids, "t": t, **got})

    read = F.lit(1.0) if agg == "count" else F.col(value or key).cast("double")
    src = _micros(df, ts).select(key, "_t", F.col(id_col).cast("long").alias(id_col),
                                 F.coalesce(read, F.lit(0.0)).alias("_v"), read.isNull().alias("_null"),
                                 F.col(ts).alias("_wm_ts"))
    res = src.groupBy(key).applyInPandasWithState(
        fn, out_schema, state_schema, "append", GroupStateTimeout.EventTimeTimeout)
    res = res.drop("_nan") if agg == "count" else _with_nan(res, out)
    return res.withColumn(ts, F.timestamp_micros("t")).drop("t")


# --- retract changelog of a running count ---------------------------------

def changelog_stream(df: DataFrame, key: str, ts: str, id_col: str) -> DataFrame:
    """Per row: ``(false, n-1)`` when the key had a count, then ``(true, n)``
    — the full retract stream of ``groupBy(key).count`` (update mode in Spark
    gives only the latest value per key and micro-batch), in the order of the
    counts.  ``count(key)`` of the NULL key stays 0: one addition."""
    out_schema = f"{key} {_type(df, key)}, {id_col} long, is_add boolean, num long"

    def fn(k, batches, state: GroupState):
        n = state.get[0] if state.exists else 0
        pdf = _concat(batches)
        if not len(pdf):
            return
        ids = pdf.sort_values(["_t", id_col], kind="stable")[id_col].to_numpy()
        state.update((n + len(ids),))
        if _is_null(k):
            if n == 0:
                yield pd.DataFrame({key: _same_key(k, 1), id_col: ids[:1], "is_add": True, "num": 0})
            return
        both = np.repeat(n + 1 + np.arange(len(ids)), 2)          # the count after each row
        add = np.tile([False, True], len(ids))
        num = both - ~add
        keep = add | (num > 0)
        yield pd.DataFrame({key: _same_key(k, int(keep.sum())), id_col: np.repeat(ids, 2)[keep],
                            "is_add": add[keep], "num": num[keep]})

    src = _micros(df, ts).select(key, "_t", F.col(id_col).cast("long").alias(id_col))
    return src.groupBy(key).applyInPandasWithState(
        fn, out_schema, "n long", "append", GroupStateTimeout.NoTimeout)


# --- top-2 table aggregate on a stream ------------------------------------

def top2_stream(df: DataFrame, key: str, value: str, pad: float = -2147483648.0,
                value_out: str = "temp", rank_out: str = "rank") -> DataFrame:
    """The top-2 table aggregate on a stream (window functions are not
    allowed on streams): per key two slots starting at ``pad``, replaced only
    by a strictly greater value; every micro-batch that touches a key emits
    its two current rows ``(value, rank)`` — run it in ``update`` mode and
    keep the latest row per (key, rank).  State: two doubles per key."""
    out_schema = f"{key} {_type(df, key)}, {value_out} double, {rank_out} int"

    def fn(k, batches, state: GroupState):
        top = np.array(state.get if state.exists else (pad, pad))
        # slots replaced on a strictly greater value hold the two largest of
        # the multiset {slots} + values (equal maxima fill both); NaN, NULL
        # and values not above the pad never enter
        for pdf in batches:
            x = pdf[value].to_numpy(dtype=np.float64, na_value=np.nan)
            top = np.sort(np.r_[top, x[x > pad]])[-2:]
        hi, second = float(top[1]), float(top[0])
        state.update((hi, second))
        yield pd.DataFrame({key: _same_key(k, 2), value_out: [hi, second], rank_out: [1, 2]})

    src = df.select(key, F.col(value).cast("double").alias(value))
    return src.groupBy(key).applyInPandasWithState(
        fn, out_schema, "hi double, second double", "update", GroupStateTimeout.NoTimeout)
