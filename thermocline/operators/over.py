"""OVER windows (one result per input row), skew-safe.

``PARTITION BY key ORDER BY t`` with a frame, evaluated per
``(key, segment)`` (see :mod:`.segments`):

* unbounded frames: local running aggregate + aggregate of earlier segments;
* bounded frames, by rows or by time: what lies in the row's own segment comes
  from the plain window there.  Of the other segments a frame holds the end of
  the one it begins in, and whole ones in between.  The end is found without
  copying rows: a row at place ``x`` (its row number, or its time) begins the
  frame of place ``x + preceding``, so every row whose segment and the segment
  of that place differ sends one narrow message there, with the aggregate from
  it to the end of its segment.  Whole segments come from the summary table:
  differences of prefix sums for counts and sums, a sparse table of minima or
  maxima over 1, 2, 4, ... segments for those.  So a frame costs at most one
  message a row, however many rows or segments it spans;
* a time that fills more than one segment alone: its rows are peers in a RANGE
  frame, so rows also take that time's aggregate in later segments.

Counting the partition key itself over a ROWS frame needs no second pass:
the key is non-null in every row of a non-null partition, so the count is
``least(row_number, k + 1)`` (0 for the NULL-key partition).

Sums of DOUBLE over whole segments are prefix differences of the finite
values; NaN and infinities are counted beside them, so one such value does not
reach frames that do not hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .segments import (HOT, MAX_BROADCAST_BYTES, SEG, Segmented, beside, global_row_number, hash_tiebreak,
                       materialize, materialize_counted, segment, with_row_offsets)

AGGS = ("count", "sum", "min", "max", "avg")
_SPECIAL = ("nan", "pinf", "ninf")


def _needs(name: str) -> list[str]:
    return ["sum", "count"] if name in ("sum", "avg") else [name]


def _plain(name: str, c: Column) -> Column:
    return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}[name](c)


def _is_fraction(df: DataFrame, col: str | None) -> bool:
    return col is not None and isinstance(df.schema[col].dataType, T.FractionalType) \
        and not isinstance(df.schema[col].dataType, T.DecimalType)


def _parts(df: DataFrame, name: str, col: str | None) -> dict[str, tuple[str, Column]]:
    """The aggregates a frame's result is put together from."""
    c = F.col(col) if col else F.lit(1)
    out = {p: (p, c) for p in _needs(name)}
    if "sum" in out and _is_fraction(df, col):
        infinity = F.lit(float("inf"))
        special = {"nan": F.isnan(c), "pinf": c == infinity, "ninf": c == -infinity}
        out["sum"] = ("sum", F.when(~special["nan"] & ~special["pinf"] & ~special["ninf"], c))
        out |= {k: ("count", F.when(test, 1)) for k, test in special.items()}
    return out


def _both(p: str, a: Column, b: Column) -> Column:
    """Two disjoint stretches' aggregates put together; NULL is an empty one."""
    if p in ("min", "max"):
        return (F.least if p == "min" else F.greatest)(a, b)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def _finish(name: str, total: dict[str, Column]) -> Column:
    """The result, from the parts."""
    if name == "count":
        return F.coalesce(total["count"], F.lit(0)).cast("long")
    if name in ("min", "max"):
        return total[name]
    got = total["sum"]
    if "nan" in total:
        n = {k: F.coalesce(total[k], F.lit(0)) for k in _SPECIAL}
        got = (F.when((n["nan"] > 0) | ((n["pinf"] > 0) & (n["ninf"] > 0)), F.lit(float("nan")))
               .when(n["pinf"] > 0, F.lit(float("inf"))).when(n["ninf"] > 0, F.lit(float("-inf"))).otherwise(got))
    return F.when(total["count"] > 0, got if name == "sum" else got / total["count"])


def _type(df: DataFrame, name: str, col: str | None) -> T.DataType:
    return df.select(_plain(name, F.col(col) if col else F.lit(1)).alias("x")).schema["x"].dataType


def over_rows(df: DataFrame, keys: list[str], t: str, tiebreak: list[str],
              preceding: int | None, agg: tuple[str, str], out: str,
              target_rows: int | None = None) -> DataFrame:
    """``agg(col) OVER (PARTITION BY keys ORDER BY t, tiebreak ROWS BETWEEN
    <preceding|UNBOUNDED> PRECEDING AND CURRENT ROW)``."""
    name, col = agg
    assert name in AGGS
    cols = df.columns
    if name == "count" and (preceding is None or col in keys):
        sg, f = global_row_number(df, keys, t, tiebreak, target_rows, count_col=col)
        if preceding is None:
            res = F.col("_nn_run")
        else:
            res = F.when(F.col(col).isNull(), F.lit(0)).otherwise(
                F.least(F.col("_rn"), F.lit(preceding + 1)))
        return f.select(*cols, res.cast("long").alias(out))
    if preceding is None:
        return _unbounded(df, keys, t, tiebreak, name, col, out, target_rows, rows=True)
    sg = segment(df, keys, t, target_rows, tiebreak, _parts(df, name, col))
    w = sg.seg_window().orderBy(F.col(t), *[F.col(c) for c in tiebreak]).rowsBetween(-preceding, Window.currentRow)
    return _framed(sg, _rows_outside(sg, df, tiebreak, preceding, name, col), df, name, col, w, out)


def over_range(df: DataFrame, keys: list[str], t: str, preceding: int | None,
               agg: tuple[str, str], out: str,
               target_rows: int | None = None) -> DataFrame:
    """``agg(col) OVER (PARTITION BY keys ORDER BY t RANGE BETWEEN
    <preceding|UNBOUNDED> PRECEDING AND CURRENT ROW)``; ``t`` numeric and
    ``preceding`` in its units.  Peers (equal ``t``) share a result."""
    name, col = agg
    assert name in AGGS
    if preceding is None:
        return _unbounded(df, keys, t, [], name, col, out, target_rows, rows=False)
    sg = segment(df, keys, t, target_rows, hash_tiebreak(df), _parts(df, name, col))
    w = sg.seg_window().orderBy(F.col(t)).rangeBetween(-preceding, Window.currentRow)
    return _framed(sg, _range_outside(sg, df, preceding, name, col), df, name, col, w, out)


def _framed(sg: Segmented, f: DataFrame, df: DataFrame, name: str, col: str | None, w: Window, out: str) -> DataFrame:
    """The frame's part in the row's own segment and that outside it."""
    if not sg.split:
        return f.select(*df.columns, _plain(name, F.col(col) if col else F.lit(1)).over(w).alias(out))
    parts = _parts(df, name, col)
    for p, (fn, c) in parts.items():
        f = f.withColumn(f"_l_{p}", _plain(fn, c).over(w))
    total = {p: _both(fn, F.col(f"_l_{p}"), F.col(f"_o_{p}")) for p, (fn, _) in parts.items()}
    return f.select(*df.columns, _finish(name, total).cast(_type(df, name, col)).alias(out))


def rows_layout(df: DataFrame, keys: list[str], t: str, tiebreak: list[str], preceding: int,
                target_rows: int | None = None, agg: tuple[str, str] | None = None) -> DataFrame:
    """Rows of ``df`` with ``_seg`` and ``_earlier``: ``agg`` (default: the
    count of the first key) over the rows of ``ROWS BETWEEN preceding PRECEDING
    AND CURRENT ROW`` that lie in earlier segments of the key (0 or NULL
    without any).  A window ``PARTITION BY keys, _seg ORDER BY t, tiebreak ROWS
    BETWEEN preceding PRECEDING AND CURRENT ROW`` over this frame, put together
    with ``_earlier``, equals the same frame partitioned by key alone."""
    name, col = agg or ("count", keys[0])
    sg = segment(df, keys, t, target_rows, tiebreak, _parts(df, name, col))
    return _layout(sg, _rows_outside(sg, df, tiebreak, preceding, name, col), df, name, col, SEG)


def range_layout(df: DataFrame, keys: list[str], t: str, preceding: int,
                 target_rows: int | None = None, agg: tuple[str, str] | None = None) -> DataFrame:
    """The same for ``RANGE BETWEEN preceding PRECEDING AND CURRENT ROW``, with
    the segment in ``_blk``: ``_earlier`` is ``agg`` over the frame's rows in
    other segments (peers may lie in later ones)."""
    name, col = agg or ("count", keys[0])
    sg = segment(df, keys, t, target_rows, hash_tiebreak(df), _parts(df, name, col))
    return _layout(sg, _range_outside(sg, df, preceding, name, col), df, name, col, "_blk")


def _layout(sg: Segmented, f: DataFrame, df: DataFrame, name: str, col: str | None, seg: str) -> DataFrame:
    parts = _parts(df, name, col)
    none = {p: F.lit(0 if fn == "count" else None) for p, (fn, _) in parts.items()}
    got = _finish(name, {p: F.col(f"_o_{p}") for p in parts} if sg.split else none)
    return f.select(*df.columns, F.col(SEG).alias(seg), got.alias("_earlier"))


# --- what a bounded frame holds outside the row's own segment ------------------

def _suffixes(rows: DataFrame, keys: list[str], parts, order: list[Column], peers: bool) -> DataFrame:
    """``_r_<part>``: the aggregate from a row to the end of its segment
    (``order`` is descending, so it is a running one)."""
    w = Window.partitionBy(*keys, SEG).orderBy(*order)
    w = (w.rangeBetween if peers else w.rowsBetween)(Window.unboundedPreceding, Window.currentRow)
    for p, (fn, _) in parts.items():
        rows = rows.withColumn(f"_r_{p}", _plain(fn, F.col(f"_v_{p}")).over(w))
    return rows


def _sparse(sg: Segmented, parts) -> tuple[DataFrame, int]:
    """(keys, _from, _k, _m_<part>): the minimum or maximum over 2**_k
    segments from ``_from`` on."""
    w, steps = Window.partitionBy(*sg.keys).orderBy(SEG), max(1, (sg.most - 1).bit_length())
    names = [p for p in parts if p in ("min", "max")]
    f = sg.table.select(*sg.keys, SEG, *[F.col(f"_s_{p}").alias(f"_m0_{p}") for p in names])
    for k in range(1, steps):
        f = f.select("*", *[_both(p, F.col(f"_m{k - 1}_{p}"), F.lead(f"_m{k - 1}_{p}", 1 << (k - 1)).over(w)).alias(f"_m{k}_{p}")
                            for p in names])
    each = F.array(*[F.struct(F.lit(k).alias("_k"), *[F.col(f"_m{k}_{p}").alias(f"_m_{p}") for p in names])
                     for k in range(steps)])
    return materialize_counted(f.select(*sg.keys, F.col(SEG).alias("_from"), F.explode(each).alias("_x"))
                               .select(*sg.keys, "_from", "_x.*"))


def _heavy(sg: Segmented) -> tuple[DataFrame | None, int]:
    """Times that go on in later segments, counted."""
    return (None, 0) if sg.heavy is None else materialize_counted(sg.heavy)


def _outside(sg: Segmented, f: DataFrame, parts) -> DataFrame:
    """``_o_<part>`` from the begun segment ``_e`` with its end ``_r_<part>``:
    that and the whole segments between ``_e`` and the row's own.  Without
    ``_e`` the frame begins with the key: all earlier segments."""
    at, began = F.col(SEG), F.col("_e").isNotNull()
    sums = [p for p in parts if p not in ("min", "max")]
    f = sg.attach(f, [f"_p_{p}" for p in parts])
    if sums:
        upto = sg.table.select(*sg.keys, SEG, *[_both("sum", F.col(f"_p_{p}"), F.col(f"_s_{p}")).alias(f"_u_{p}") for p in sums])
        f = sg.attach(f, [f"_u_{p}" for p in sums], on="_e", table=upto)
    zero = F.lit(0)
    whole = {p: F.when(at - F.col("_e") > 1, F.coalesce(f"_p_{p}", zero) - F.coalesce(f"_u_{p}", zero)) for p in sums}
    extremes = [p for p in parts if p in ("min", "max")]
    if extremes:
        table, n = _sparse(sg, parts)
        k = F.when(at - F.col("_e") > 1, F.length(F.bin(at - F.col("_e") - 1)) - 1).cast("int")
        f = f.withColumn("_k", k)
        for side, start in (("a", F.col("_e") + 1), ("b", at - F.expr("shiftleft(1L, _k)"))):
            f = f.withColumn("_from", F.when(F.col("_k").isNotNull(), start))
            f = beside(f, table, n, [*sg.keys, "_from", "_k"], *[f"_m_{p}" for p in extremes]).drop("_from")
            for p in extremes:
                f = f.withColumnRenamed(f"_m_{p}", f"_{side}_{p}")
        whole |= {p: F.when(F.col("_k").isNotNull(), _both(p, F.col(f"_a_{p}"), F.col(f"_b_{p}"))) for p in extremes}
    for p in parts:
        fn = p if p in ("min", "max") else "sum"
        f = f.withColumn(f"_o_{p}", F.when(began, F.when(F.col("_e") < at, _both(fn, F.col(f"_r_{p}"), whole[p])))
                         .otherwise(F.when(F.col("_all"), F.col(f"_p_{p}"))))
    return f


def _rows_outside(sg: Segmented, df: DataFrame, tiebreak: list[str], k: int, name: str, col: str | None) -> DataFrame:
    """Rows with ``_o_<part>`` of a frame of the row and ``k`` before it."""
    if not sg.split:
        return sg.frame
    keys, parts = sg.keys, _parts(df, name, col)
    order = [F.col(sg.t), *[F.col(c) for c in tiebreak]]
    numbered = with_row_offsets(sg)
    rn = F.row_number().over(sg.seg_window().orderBy(*order)) + F.col("_before")
    # only the last k rows of a segment begin a frame that ends outside it; the
    # limit is applied in the map tasks where k is small
    from_end = F.row_number().over(sg.seg_window().orderBy(*[c.desc() for c in order]))
    hot = sg.attach(sg.frame.where(F.col(HOT)).select(*keys, SEG, sg.t, *tiebreak, *[
        c.alias(f"_v_{p}") for p, (_, c) in parts.items()]).withColumn("_z", from_end).where(F.col("_z") <= k),
        ["_n", "_before"])
    ends = _suffixes(hot, keys, parts, [c.desc() for c in order], peers=False)
    ends = ends.withColumn("_rn", F.col("_before") + F.col("_n") - F.col("_z") + 1)
    # the segment of the row that is k further: in every run of target_rows
    # row numbers at most one segment begins
    ends = ends.select(*keys, F.col(SEG).alias("_e"), (F.col("_rn") + k).cast("long").alias("_rn"), *[f"_r_{p}" for p in parts])
    begin = sg.table.select(*keys, F.col(SEG).alias("_s"), F.col("_before").alias("_b"),
                            F.floor(F.col("_before") / sg.target_rows).cast("long").alias("_slot"), (F.col("_before") + F.col("_n")).alias("_end"))
    slots = begin.groupBy(*keys).agg(F.max("_end").alias("_total")).select(*keys, "_total", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_total") - 1) / sg.target_rows).cast("long"))).alias("_slot"))
    slots = beside(slots, begin, sg.n_segs, [*keys, "_slot"], "_s", "_b")
    earlier = F.last("_s", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1))
    slots, n_slots = materialize_counted(slots.withColumn("_s0", earlier))
    ends = ends.withColumn("_slot", F.floor((F.col("_rn") - 1) / sg.target_rows).cast("long"))
    ends = beside(ends, slots, n_slots, [*keys, "_slot"], "_s", "_b", "_s0", how="inner")
    ends = ends.withColumn("_to", F.when(F.col("_rn") - 1 >= F.col("_b"), F.col("_s")).otherwise(F.col("_s0")))
    ends = ends.where(F.col("_to") > F.col("_e")).select(*keys, F.col("_to").alias(SEG), "_rn", "_e", *[f"_r_{p}" for p in parts])
    f, bound = numbered.withColumn("_rn", rn.cast("long")), sg.n_segs * min(k, 2 * sg.target_rows)
    if bound * 100 <= MAX_BROADCAST_BYTES:
        ends = materialize(ends)
    f = beside(f, ends, bound, [*keys, SEG, "_rn"], "_e", *[f"_r_{p}" for p in parts])
    f = f.withColumn("_all", F.col("_rn") <= k)
    return _outside(sg, f, parts)


def _range_outside(sg: Segmented, df: DataFrame, d, name: str, col: str | None) -> DataFrame:
    """Rows with ``_o_<part>`` of a frame of the row's time and ``d`` before."""
    if not sg.split:
        return sg.frame
    keys, parts, t = sg.keys, _parts(df, name, col), sg.t
    kind = df.schema[t].dataType
    values = [f"_v_{p}" for p in parts]
    hot = sg.frame.where(F.col(HOT)).select(
        *keys, SEG, F.col(t).alias("_x"), *[c.alias(v) for v, (_, c) in zip(values, parts.values())],
        (F.col(t) + F.lit(d)).cast(kind).alias("_place"), F.lit(None).cast("long").alias("_to"))
    # the frame of each segment's last time, whether or not a row begins it
    marks = sg.table.select(*keys, F.col(SEG).alias("_to"), F.col("_last").cast(kind).alias("_place"),
                            (F.col("_last") - F.lit(d)).cast(kind).alias("_x"))
    unknown = sg._leaf.where("_first IS NULL").select(*keys, F.col(SEG).alias("_to")).distinct()  # NULL times are peers
    marks = marks.where("_x IS NOT NULL").unionByName(unknown, allowMissingColumns=True)
    marks = sg.locate(marks, "_x", SEG, first=True)
    ends = _suffixes(hot.unionByName(marks, allowMissingColumns=True), keys, parts, [F.col("_x").desc()], peers=True)
    found = sg.locate(ends, "_place", "_found")
    ends = beside(found, sg.table.groupBy(*keys).agg(F.max("_last").alias("_end")), sg.n_hot, keys, "_end")
    ends = ends.where(F.col("_to").isNotNull() | (F.col("_place") <= F.col("_end")))
    ends = ends.select(*keys, F.coalesce("_to", "_found").alias(SEG), "_place", F.struct(
        F.col(SEG).alias("_e"), *[f"_r_{p}" for p in parts]).alias("_ev")).where(F.col("_ev._e") < F.col(SEG))
    rows = sg.frame.withColumn("_place", F.col(t))
    both = rows.unionByName(ends, allowMissingColumns=True)
    # the next message at or after a row's time; of equal ones that of the first segment
    near = (sg.seg_window().orderBy(F.col("_place").desc(), F.col("_ev").isNull(), F.col("_ev._e").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    f = both.withColumn("_near", F.last("_ev", ignorenulls=True).over(near)).where(F.col("_ev").isNull())
    f = f.select(*rows.columns, F.when(F.col(HOT), F.col("_near._e")).alias("_e"), *[F.col(f"_near._r_{p}").alias(f"_r_{p}") for p in parts])
    f = _outside(sg, f.withColumn("_all", F.lit(False)), parts)
    # peers in later segments
    heavy, n_heavy = _heavy(sg)
    if n_heavy:
        f = f.withColumn("_at", F.col(t).cast("long"))
        f = beside(f, heavy, n_heavy, [*keys, "_at", SEG], *[f"_after_{p}" for p in parts]).drop("_at")
        for p, (fn, _) in parts.items():
            f = f.withColumn(f"_o_{p}", _both(fn, F.col(f"_o_{p}"), F.col(f"_after_{p}")))
    return f


def _unbounded(df, keys, t, tiebreak, name, col, out, target_rows, rows: bool) -> DataFrame:
    """Running aggregate: local window per segment + earlier segments (and a
    time's later ones, for peers)."""
    parts = _parts(df, name, col)
    sg = segment(df, keys, t, target_rows, tiebreak if rows else hash_tiebreak(df), parts)
    w = sg.seg_window().orderBy(F.col(t), *[F.col(x) for x in tiebreak])
    fr = (w.rowsBetween if rows else w.rangeBetween)(Window.unboundedPreceding, Window.currentRow)
    if not sg.split:
        return sg.frame.select(*df.columns, _plain(name, F.col(col) if col else F.lit(1)).over(fr).alias(out))
    f = sg.frame
    for p, (fn, c) in parts.items():
        f = f.withColumn(f"_l_{p}", _plain(fn, c).over(fr))
    f = sg.attach(f, [f"_p_{p}" for p in parts])
    total = {p: _both(fn, F.col(f"_l_{p}"), F.col(f"_p_{p}")) for p, (fn, _) in parts.items()}
    heavy, n_heavy = (None, 0) if rows else _heavy(sg)
    if n_heavy:
        f = f.withColumn("_at", F.col(t).cast("long"))
        f = beside(f, heavy, n_heavy, [*keys, "_at", SEG], *[f"_after_{p}" for p in parts])
        total = {p: _both(fn, total[p], F.col(f"_after_{p}")) for p, (fn, _) in parts.items()}
    return f.select(*df.columns, _finish(name, total).cast(_type(df, name, col)).alias(out))
