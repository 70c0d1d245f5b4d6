"""Skew-safe layout for ordered per-key work.

Ordered operators (running counts, OVER frames, sessions, count-triggered
averages, changelogs) need all rows of a key in time order.  Partitioning by
the key alone would put a hot key — one that may hold a third of all rows —
into a single task.  Instead:

1. one partial aggregate finds the keys with more than ``target_rows`` rows
   (*hot* keys) and their first and last times;
2. a second one counts the rows of hot keys by (key, bucket), ``PIECES``
   equal stretches of time for every ``target_rows`` rows.  Only buckets that
   are over-full are divided again, by time, and a time that is over-full alone
   by a tiebreak column.  This summary gives the cuts (buckets in a row up to
   ``target_rows`` rows are one segment), the row offsets, the first and last
   times and any further aggregate of each segment together;
3. the work runs per ``(key, segment)``; what one segment needs from the
   others comes from the summary.

A row finds its bucket by arithmetic and one equi-join a level (two levels
unless times are very uneven), so no row ever carries a list of cuts.  The
summary has at most about ``2 * PIECES * N / target_rows`` rows a level;
it is checkpointed, counted, and broadcast only below a size in bytes.

Times are read as integers (``t`` cast to BIGINT); a NULL time stands before
all others; the times of one key must lie less than 2**63 apart.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, materialize_counted

SEG = "_seg"
HOT = "_hot"

# Rows per (key, segment) once a key is split.  A segment is sorted in one
# task; a million rows is a few hundred MB of sort buffer at most.
DEFAULT_TARGET_ROWS = 1_000_000
# Buckets for every target_rows rows: how uneven times may be before a bucket
# has to be divided again.
PIECES = 8
# Largest per-segment table that is broadcast, in bytes; above it the plan
# joins by shuffle (and AQE's skew-join split covers the hot keys).
MAX_BROADCAST_BYTES = 64 << 20

# aggregates that a summary may carry, and how those of buckets are put together
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_WHOLE = -2**63  # the inner place of a bucket that is not divided by tiebreak


def bounded_side(df: DataFrame, n_rows: int, elements: int = 1, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` when its size — the counted rows times the width of a
    row, ``elements`` values to an array — is within ``limit``."""
    def width(kind: T.DataType) -> int:
        if isinstance(kind, T.ArrayType):
            return 24 + elements * width(kind.elementType)
        if isinstance(kind, T.StructType):
            return 16 + sum(width(f.dataType) for f in kind)
        return 40 if isinstance(kind, (T.StringType, T.BinaryType)) else 8
    return F.broadcast(df) if n_rows * (16 + width(df.schema)) <= limit else df


def beside(frame: DataFrame, table: DataFrame, n_rows: int, on: list[str], *cols: str, how: str = "left") -> DataFrame:
    """``frame`` with columns of a small table, joined on equal (or both NULL)
    columns ``on``."""
    names = {c: f"_r{i}" for i, c in enumerate(on)}
    right = table.select(*[F.col(c).alias(r) for c, r in names.items()], *cols)
    same = reduce(Column.__and__, [frame[c].eqNullSafe(right[r]) for c, r in names.items()])
    return frame.join(bounded_side(right, n_rows), same, how).drop(*names.values())


@dataclass
class Segmented:
    frame: DataFrame          # input rows + _seg (long) + _hot (boolean)
    keys: list[str]
    t: str                    # numeric order-time column (e.g. epoch micros)
    n_hot: int                # number of hot keys
    target_rows: int
    #: per hot segment, 0, 1, 2, ... in a key: _n, _first, _last, the
    #: aggregates asked for (``_s_<name>``), ``_before`` = rows of the key in
    #: earlier segments, ``_p_<name>`` = aggregates of earlier segments
    table: DataFrame | None = None
    n_segs: int = 0
    #: (keys, _at, _seg, _after_<name>): rows of one time that go on in later segments
    heavy: DataFrame | None = None
    most: int = 0             # segments of the key that has most
    _levels: list[tuple[DataFrame, int]] = field(default_factory=list)
    _leaf: DataFrame | None = None
    _places: tuple[DataFrame, int] | None = None

    @property
    def split(self) -> bool:
        return self.n_hot > 0

    def seg_window(self) -> Window:
        return Window.partitionBy(*[F.col(k) for k in self.keys], F.col(SEG))

    def attach(self, frame: DataFrame, cols: list[str], on: str = SEG, table: DataFrame | None = None) -> DataFrame:
        """Left-join columns of the segment numbered by column ``on``."""
        source = (self.table if table is None else table).withColumnRenamed(SEG, on)
        return beside(frame, source, self.n_segs, [*self.keys, on], *cols)

    def locate(self, frame: DataFrame, place: str, out: str, first: bool = False) -> DataFrame:
        """The segment of rows of hot keys that holds the time in column
        ``place`` (else the last one before it).  Where the time itself fills
        several, the last of them, or with ``first`` the first."""
        if self._places is None:
            self._places = _dense(self._leaf, self._levels, self.keys)
        table, n = self._places
        f = _in_buckets(frame, self.keys, F.col(place).cast("long"), None, self._levels)
        found = table.select(*self.keys, "_at", F.col("_seg_first" if first else SEG).alias(out))
        return beside(f, found, n, [*self.keys, "_at"], out).drop("_at", "_in")


def _in_buckets(frame: DataFrame, keys: list[str], t: Column, b: Column | None,
                levels: list[tuple[DataFrame, int]]) -> DataFrame:
    """``frame`` with the bucket of time ``t`` (and tiebreak ``b``) of each row
    of a hot key: ``_at`` and ``_in``, where it begins.  NULL elsewhere."""
    first, n = levels[0]
    f = beside(frame, first, n, keys, "_lo", "_min", "_hi", "_w")
    inside = F.when(t.isNull(), F.col("_lo")).otherwise(F.greatest(F.least(t, F.col("_hi")), F.col("_min")))
    f = f.withColumn("_at", F.col("_lo") + _floor(inside - F.col("_lo"), F.col("_w")))
    f = f.withColumn("_t0", inside).withColumn("_in", F.when(F.col("_at").isNotNull(), F.lit(_WHOLE))).drop("_lo", "_min", "_hi", "_w")
    for table, n in levels[1:]:
        f = beside(f, table, n, [*keys, "_at", "_in"], "_w", "_b0", "_bw")
        by_time = F.col("_w").isNotNull() & F.col("_bw").isNull()
        inner = F.lit(None).cast("long") if b is None else F.col("_b0") + _floor(b - F.col("_b0"), F.col("_bw"))
        f = (f.withColumn("_in", F.when(F.col("_bw").isNotNull(), F.coalesce(inner, F.col("_in"))).otherwise(F.col("_in")))
             .withColumn("_at", F.when(by_time, F.col("_at") + _floor(F.col("_t0") - F.col("_at"), F.col("_w")))
                         .otherwise(F.col("_at"))).drop("_w", "_b0", "_bw"))
    return f.drop("_t0")


def _floor(x: Column, width: Column) -> Column:
    """``x`` (not negative) down to a multiple of ``width``."""
    return x - F.pmod(x, width)


def _parts(rows: Column, target: int) -> Column:
    return (F.ceil(rows / F.lit(target)) * PIECES).cast("long")


def _width(span: Column, rows: Column, target: int) -> Column:
    parts = _parts(rows, target)
    return F.greatest(F.lit(1).cast("long"), F.ceil(span.cast("decimal(20,0)") / parts).cast("long"))


def hash_tiebreak(df: DataFrame) -> Column:
    """An order of rows that depends on nothing but their content."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).bitwiseAND(F.lit(2**62 - 1))


def _tiebreak(df: DataFrame, tiebreak: list[str] | Column | None) -> Column | None:
    if isinstance(tiebreak, Column):
        return tiebreak
    if not tiebreak or not isinstance(df.schema[tiebreak[0]].dataType, T.IntegralType):
        return None
    return F.coalesce(F.col(tiebreak[0]).cast("long"), F.lit(-2**62))


def segment(df: DataFrame, keys: list[str], t: str, target_rows: int | None = None,
            tiebreak: list[str] | Column | None = None, aggs: dict[str, tuple[str, Column]] | None = None) -> Segmented:
    """Cut hot keys of ``df`` into segments of about ``target_rows`` rows (at
    most twice as many), contiguous in the order time ``t``.

    Equal times share a segment, except that with a ``tiebreak`` (an integer
    column that orders equal times, or an expression where their order does not
    matter) a time that fills more than one segment alone is cut too.
    ``aggs`` (name: (count, sum, min or max, column)) are kept per segment."""
    target, aggs = target_rows or DEFAULT_TARGET_ROWS, aggs or {}
    when = F.col(t).cast("long")
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(when).alias("_lo"), F.max(when).alias("_hi"), F.count(when).alias("_known"))
           .where(F.col("_n") > target))
    # NULL times have a place of their own before the first
    least = F.coalesce("_lo", F.lit(0).cast("long"))
    hot = hot.select(*keys, (least - (F.col("_known") < F.col("_n")).cast("long")).alias("_lo"), least.alias("_min"),
                     F.coalesce("_hi", F.lit(0).cast("long")).alias("_hi"), "_n")
    hot, n_hot = materialize_counted(hot.withColumn("_w", _width(F.col("_hi") - F.col("_lo") + 1, F.col("_n"), target)))
    if n_hot == 0:
        plain = df.withColumn(SEG, F.lit(0).cast("long")).withColumn(HOT, F.lit(False))
        return Segmented(plain, keys, t, 0, target)
    b = _tiebreak(df, tiebreak)
    levels: list[tuple[DataFrame, int]] = [(hot, n_hot)]
    bucket = [*keys, "_at", "_in"]
    narrow = df.select(*keys, F.col(t).alias("_time"), (F.lit(0).cast("long") if b is None else b).alias("_b"),
                       *[c.alias(f"_v_{name}") for name, (_, c) in aggs.items()])
    narrow = narrow.withColumn("_when", F.col("_time").cast("long"))

    def placed() -> DataFrame:
        return _in_buckets(narrow, keys, F.col("_when"), F.col("_b"), levels).where(F.col("_at").isNotNull())

    # rows to count, with the width of the buckets they are counted in
    rows = beside(placed(), hot.withColumnRenamed("_w", "_cw"), n_hot, keys, "_cw").withColumn("_cb", F.lit(None).cast("long"))
    leaves, n_leaf = [], 0
    while True:
        counted = rows.groupBy(*bucket).agg(
            F.max("_cw").alias("_w"), F.max("_cb").alias("_bw"),
            F.count(F.lit(1)).alias("_n"), F.min("_time").alias("_first"), F.max("_time").alias("_last"),
            F.count("_time").alias("_timed"), F.min("_b").alias("_b_lo"), F.max("_b").alias("_b_hi"),
            *[getattr(F, fn)(f"_v_{name}").alias(f"_s_{name}") for name, (fn, _) in aggs.items()])
        one_time = F.when(F.col("_timed") == 0, True).otherwise((F.col("_timed") == F.col("_n")) & (F.col("_first") == F.col("_last")))
        by_time = (F.col("_w") > 1) & F.col("_bw").isNull()
        by_tie = one_time & (F.col("_w") == 1) & (F.col("_b_lo") < F.col("_b_hi")) & (F.coalesce("_bw", F.lit(2)) > 1)
        over = F.when(F.col("_n") <= target, 0).when(by_time, 1).when(by_tie if b is not None else F.lit(False), 2).otherwise(0)
        counted, n_counted = materialize_counted(counted.withColumn("_go", over))
        leaves.append(counted.where("_go = 0"))
        n_leaf += n_counted
        n_finer = counted.where("_go > 0").count()
        if n_finer == 0:
            break
        n_leaf -= n_finer
        finer = (counted.where("_go > 0").select(
            *bucket, F.when(F.col("_go") == 1, _width(F.col("_w"), F.col("_n"), target)).otherwise(1).cast("long").alias("_w"),
            F.when(F.col("_go") == 2, F.col("_b_lo")).alias("_b0"),
            F.when(F.col("_go") == 2, _width(F.col("_b_hi") - F.col("_b_lo") + 1, F.col("_n"), target)).alias("_bw"),
            F.col("_w").alias("_span")))
        rows = beside(placed(), finer.withColumnRenamed("_w", "_cw").withColumnRenamed("_bw", "_cb"), n_finer, bucket,
                      "_cw", "_cb").where("_cw IS NOT NULL").drop("_at", "_in")
        levels.append((finer, n_finer))
        rows = _in_buckets(rows, keys, F.col("_when"), F.col("_b"), levels)

    leaf = reduce(DataFrame.unionByName, [x.drop("_w", "_bw", "_go", "_timed", "_b_lo", "_b_hi") for x in leaves])
    by_place = Window.partitionBy(*keys).orderBy("_at", "_in")
    before = F.coalesce(F.sum("_n").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    leaf = leaf.withColumn("_cut", before - F.pmod(before, F.lit(target)))
    leaf = leaf.withColumn(SEG, (F.dense_rank().over(Window.partitionBy(*keys).orderBy("_cut")) - 1).cast("long")).drop("_cut")
    leaf = materialize(leaf)

    merged = leaf.groupBy(*keys, SEG).agg(
        F.sum("_n").alias("_n"), F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        *[_MERGE[fn](f"_s_{name}").alias(f"_s_{name}") for name, (fn, _) in aggs.items()])
    in_order = Window.partitionBy(*keys).orderBy(SEG)
    prior = in_order.rowsBetween(Window.unboundedPreceding, -1)
    table, n_segs = materialize_counted(merged.select(
        "*", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_before"), F.lag("_last").over(in_order).alias("_prev_last"),
        *[_MERGE[fn](f"_s_{name}").over(prior).alias(f"_p_{name}") for name, (fn, _) in aggs.items()]))
    most = -(-hot.agg(F.max("_n")).first()[0] // target)  # each begins in a stretch of target rows of its own
    # times that go on in the next segment were cut by tiebreak: their buckets
    # hold one time each
    cut = any("_bw" in x.columns for x, _ in levels[1:]) and b is not None
    later = Window.partitionBy(*keys, "_at").orderBy(SEG).rowsBetween(1, Window.unboundedFollowing)
    heavy = leaf.where(F.col("_in") != _WHOLE).withColumn("_at", F.when(F.col("_first").isNotNull(), F.col("_at"))).groupBy(*keys, "_at", SEG).agg(
        F.sum("_n").alias("_n"), *[_MERGE[fn](f"_s_{name}").alias(f"_s_{name}") for name, (fn, _) in aggs.items()])
    heavy = heavy.select(*keys, "_at", SEG, *[_MERGE[fn](f"_s_{name}").over(later).alias(f"_after_{name}")
                                             for name, (fn, _) in aggs.items()])

    frame = df.withColumn("_b", F.lit(0).cast("long") if b is None else b)
    frame = _in_buckets(frame, keys, when, F.col("_b"), levels)
    frame = beside(frame, leaf, n_leaf, bucket, SEG).drop("_at", "_in", "_b")
    frame = frame.withColumn(HOT, F.col(SEG).isNotNull()).withColumn(SEG, F.coalesce(SEG, F.lit(0).cast("long")))
    return Segmented(frame, keys, t, n_hot, target, table, n_segs, heavy if cut else None, most, levels, leaf)


def _dense(leaf: DataFrame, levels: list[tuple[DataFrame, int]], keys: list[str]) -> tuple[DataFrame, int]:
    """(keys, _at, _seg, _seg_first) of every bucket in time; one without rows
    lies in the last segment before it."""
    first = levels[0][0].select(*keys, F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.col("_w"))).alias("_at"))
    every = first
    for table, _ in levels[1:]:
        every = every.unionByName(table.where("_bw IS NULL").select(
            *keys, F.explode(F.sequence(F.col("_at"), F.col("_at") + F.col("_span") - 1, F.col("_w"))).alias("_at")))
    own = leaf.groupBy(*keys, "_at").agg(F.max(SEG).alias("_own"), F.min(SEG).alias("_own_first"))
    every = every.distinct()
    names = [f"_k{i}" for i in range(len(keys))]
    right = own.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_at").alias("_own_at"), "_own", "_own_first")
    same = reduce(Column.__and__, [every[k].eqNullSafe(right[n]) for k, n in zip(keys, names)])
    every = every.join(right, same & (every["_at"] == right["_own_at"]), "left").drop(*names, "_own_at")
    filled = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last("_own", ignorenulls=True).over(filled)
    return materialize_counted(every.select(*keys, "_at", own.alias(SEG), F.coalesce("_own_first", own).alias("_seg_first")))


def with_row_offsets(sg: Segmented, nn: str | None = None) -> DataFrame:
    """Frame plus ``_before`` (rows of the key in earlier segments),
    ``_nn_before`` (that of the summary's aggregate ``nn``, else the rows) and
    ``_prev_last`` (last order time of the key before this segment)."""
    zero = F.lit(0).cast("long")
    if not sg.split:
        return (sg.frame.withColumn("_before", zero).withColumn("_nn_before", zero)
                .withColumn("_prev_last", F.lit(None).cast("long")))
    table = sg.table.withColumn("_nn_before", F.col(f"_p_{nn}") if nn else F.col("_before"))
    f = sg.attach(sg.frame, ["_before", "_nn_before", "_prev_last"], table=table)
    return (f.withColumn("_before", F.coalesce("_before", zero)).withColumn("_nn_before", F.coalesce("_nn_before", zero)))


def global_row_number(df: DataFrame, keys: list[str], t: str, tiebreak: list[str],
                      target_rows: int | None = None, out: str = "_rn",
                      count_col: str | None = None) -> tuple[Segmented, DataFrame]:
    """``row_number() OVER (PARTITION BY keys ORDER BY t, tiebreak)`` computed
    per (key, segment) plus the row count of earlier segments.  Also adds
    ``_nn_run`` = running count of non-null ``count_col`` (or of rows)."""
    sg = segment(df, keys, t, target_rows, tiebreak, {"nn": ("count", F.col(count_col))} if count_col else None)
    f = with_row_offsets(sg, "nn" if count_col else None)
    w = sg.seg_window().orderBy(F.col(t), *[F.col(c) for c in tiebreak])
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nn = F.count(count_col).over(running) if count_col else F.row_number().over(w)
    f = (f.withColumn(out, (F.row_number().over(w) + F.col("_before")).cast("long"))
         .withColumn("_nn_run", (nn + F.col("_nn_before")).cast("long")))
    return sg, f
