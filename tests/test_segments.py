"""Segmented (hot-key split) operators equal plain key-partitioned windows
on the driver's events table, with a tiny target so every key is split."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from thermocline.functions.time import epoch_micros
from thermocline.operators import keyed, over, segments
from thermocline.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ev(spark):
    return spark.read.parquet(f"{SF}/events.parquet").withColumn("_t", epoch_micros("ts"))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_keys_are_split(spark, ev):
    sg = segments.segment(ev, ["user_id"], "_t", target_rows=10)
    assert sg.n_hot > 0
    per = sg.frame.groupBy("user_id", "_seg").count()
    assert per.agg(F.max("count")).first()[0] < ev.groupBy("user_id").count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("k", [None, 1, 2, 5])
def test_rows_frames(spark, ev, k):
    w = W.partitionBy("user_id").orderBy("_t", "event_id")
    fr = w.rowsBetween(W.unboundedPreceding if k is None else -k, 0)
    for agg, col in [("count", "user_id"), ("sum", "value"), ("max", "value")]:
        got = over.over_rows(ev, ["user_id"], "_t", ["event_id"], k, (agg, col), "r", 7)
        fn = {"count": F.count, "sum": F.sum, "max": F.max}[agg]
        exp = ev.select(*ev.columns, fn(col).over(fr).alias("r"))
        assert same(got.withColumn("r", F.round(F.col("r").cast("double"), 6)),
                    exp.withColumn("r", F.round(F.col("r").cast("double"), 6))), (agg, k)


@pytest.mark.parametrize("d", [None, 3600, 4 * 3600])
def test_range_frames(spark, ev, d):
    w = W.partitionBy("user_id").orderBy("_t")
    fr = w.rangeBetween(W.unboundedPreceding if d is None else -d * 10**6, 0)
    for agg, col in [("count", "user_id"), ("min", "value")]:
        got = over.over_range(ev, ["user_id"], "_t", None if d is None else d * 10**6, (agg, col), "r", 7)
        fn = {"count": F.count, "min": F.min}[agg]
        exp = ev.select(*ev.columns, fn(col).over(fr).alias("r"))
        assert same(got.withColumn("r", F.col("r").cast("double")),
                    exp.withColumn("r", F.col("r").cast("double"))), (agg, d)


@pytest.mark.parametrize("target", [3, 10])
def test_sessions_and_runs(spark, ev, target):
    got = keyed.sessions(ev, ["user_id"], "ts", 4 * 3600, target_rows=target)
    exp = (ev.groupBy("user_id", F.session_window("ts", "14400 seconds").alias("s"))
           .agg(F.count(F.lit(1)).alias("cnt"))
           .select("user_id", F.col("s.start").alias("session_start"),
                   F.col("s.end").alias("session_end"), "cnt"))
    assert same(got, exp)
    got = keyed.count_trigger_avg(ev, ["user_id"], "ts", "value", ["event_id"], 12 * 3600, 3,
                                  target_rows=target)
    pdf = ev.select("user_id", "_t", "event_id", "value", "ts").toPandas() \
        .sort_values(["user_id", "_t", "event_id"])
    out = []
    for u, g in pdf.groupby("user_id"):
        c, s, last = 0, 0.0, None
        for r in g.itertuples():
            if last is not None and r._2 - last >= 12 * 3600 * 10**6:
                c, s = 0, 0.0
            c, s, last = c + 1, s + r.value, r._2
            if c >= 3:
                out.append((u, c, round(s / c, 6)))
                c, s = 0, 0.0
    assert sorted((r.user_id, r.cnt, round(r.avg_value, 6)) for r in got.collect()) == sorted(out)


@pytest.fixture(scope="module")
def skewed(spark):
    """events of sf0.01 with one key holding a third of all rows (derived
    from the table: every third event is re-keyed to user 0)."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long"))
                         .otherwise(F.col("user_id"))).withColumn("_t", epoch_micros("ts"))


def test_hot_key_segments_are_bounded(spark, skewed):
    target = 500
    n_hot_rows = skewed.where("user_id = 0").count()
    assert n_hot_rows > 3000
    sg = segments.segment(skewed, ["user_id"], "_t", target_rows=target)
    assert sg.n_hot == 1
    sizes = [r["count"] for r in sg.frame.where("user_id = 0").groupBy("_seg").count().collect()]
    assert len(sizes) >= n_hot_rows // target
    assert max(sizes) <= 2 * target          # no task gets the hot key whole


def test_hot_key_operators_exact(spark, skewed):
    target = 500
    w = W.partitionBy("user_id").orderBy("_t", "event_id")
    got = over.over_rows(skewed, ["user_id"], "_t", ["event_id"], 3, ("avg", "value"), "r", target)
    exp = skewed.select(*skewed.columns, F.avg("value").over(w.rowsBetween(-3, 0)).alias("r"))
    assert same(got.withColumn("r", F.round("r", 6)), exp.withColumn("r", F.round("r", 6)))
    got = over.over_range(skewed, ["user_id"], "_t", 1800 * 10**6, ("count", "user_id"), "r", target)
    wr = W.partitionBy("user_id").orderBy("_t").rangeBetween(-1800 * 10**6, 0)
    exp = skewed.select(*skewed.columns, F.count("user_id").over(wr).alias("r"))
    assert same(got, exp)
    got = keyed.sessions(skewed, ["user_id"], "ts", 600, target_rows=target)
    exp = (skewed.groupBy("user_id", F.session_window("ts", "600 seconds").alias("s"))
           .agg(F.count(F.lit(1)).alias("cnt"))
           .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                   "cnt"))
    assert same(got, exp)


def test_bursty_hot_key_is_balanced(spark):
    """A hot key with a burst — all of the first day's events plus every
    tenth event after it — still gets segments of about target_rows."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    burst = F.col("ts") < F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    sk = (ev.withColumn("user_id", F.when(burst | (F.col("event_id") % 10 == 0), F.lit(0).cast("long"))
                        .otherwise(F.col("user_id")))
          .withColumn("_t", epoch_micros("ts")))
    target = 100
    sg = segments.segment(sk, ["user_id"], "_t", target_rows=target)
    sizes = sorted(r["count"] for r in sg.frame.where("user_id = 0").groupBy("_seg").count().collect())
    day1 = sk.where(burst).count()
    assert day1 > 3 * target                     # the burst alone is several segments
    assert max(sizes) <= 2 * target
    got = keyed.count_trigger_avg(sk, ["user_id"], "ts", "value", ["event_id"], 3600, 2, target_rows=target)
    w = W.partitionBy("user_id").orderBy("_t", "event_id")
    o = (sk.withColumn("prev", F.lag("_t").over(w))
         .withColumn("run", F.sum(F.when(F.col("prev").isNull() | (F.col("_t") - F.col("prev") >= 3600 * 10**6), 1)
                                  .otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0))))
    o = o.withColumn("chunk", F.floor((F.row_number().over(W.partitionBy("user_id", "run").orderBy("_t", "event_id")) - 1) / 2))
    exp = (o.groupBy("user_id", "run", "chunk").agg(F.count(F.lit(1)).alias("cnt"), F.avg("value").alias("avg_value"),
                                                  F.max("ts").alias("emit_ts"))
           .where("cnt = 2").select("user_id", "cnt", "avg_value", "emit_ts"))
    assert same(got.withColumn("avg_value", F.round("avg_value", 6)),
                exp.withColumn("avg_value", F.round("avg_value", 6)))
    got = keyed.changelog_count(sk, ["user_id"], "ts", ["event_id"], ["event_id"], target_rows=target)
    assert got.where("user_id = 0 AND is_add").agg(F.max("num")).first()[0] == sk.where("user_id = 0").count()


def test_named_window_sql_on_split_layout(spark, ev):
    """The SQL ``WINDOW w`` form over the row layout equals the plain window
    with every key split, and shuffles the rows once (plus a small table)."""
    lay = over.rows_layout(ev, ["user_id"], "_t", ["event_id"], 2, target_rows=7)
    got = spark.sql("""
        SELECT event_id, COUNT(user_id) OVER w + _earlier AS cnt
        FROM {t} WINDOW w AS (PARTITION BY user_id, _seg ORDER BY _t, event_id
                              ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""", t=lay)
    exp = ev.select("event_id", F.count("user_id").over(
        W.partitionBy("user_id").orderBy("_t", "event_id").rowsBetween(-2, 0)).alias("cnt"))
    assert same(got, exp)
    got.collect()
    p = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    big = [x for x in p.split("\n") if "Exchange hashpartitioning(user_id" in x and "_seg" in x]
    assert len(big) == 1


@pytest.mark.parametrize("shape", ["outlier", "one time", "few times"])
def test_cut_of_awkward_times(spark, shape):
    """One stray time, all rows at one time, or three times only: segments
    stay small for row-wise work and results equal the plain window."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").limit(3000).withColumn("user_id", F.lit(1))
    t = {"outlier": F.when(F.col("event_id") % 2999 == 0, F.lit(0)).otherwise(epoch_micros("ts")),
         "one time": F.lit(5_000_000), "few times": (F.col("event_id") % 3) * 1_000_000}[shape]
    ev = ev.withColumn("_t", t.cast("long"))
    target = 200
    sg = segments.segment(ev, ["user_id"], "_t", target, ["event_id"])
    sizes = [r["count"] for r in sg.frame.groupBy("_seg").count().collect()]
    assert max(sizes) <= 2 * target and sum(sizes) == ev.count()
    w = W.partitionBy("user_id").orderBy("_t", "event_id")
    got = over.over_rows(ev, ["user_id"], "_t", ["event_id"], 250, ("max", "value"), "r", target)
    assert same(got, ev.select(*ev.columns, F.max("value").over(w.rowsBetween(-250, 0)).alias("r")))
    got = over.over_range(ev, ["user_id"], "_t", 1_000_000, ("count", "value"), "r", target)
    wr = W.partitionBy("user_id").orderBy("_t").rangeBetween(-1_000_000, 0)
    assert same(got, ev.select(*ev.columns, F.count("value").over(wr).alias("r")))


def test_range_segments_are_balanced_with_an_outlier(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").limit(4000).withColumn("user_id", F.lit(1))
    ev = ev.withColumn("_t", F.when(F.col("event_id") % 3999 == 0, F.lit(0)).otherwise(epoch_micros("ts")).cast("long"))
    lay = over.range_layout(ev, ["user_id"], "_t", 60_000_000, 250)
    assert max(r["count"] for r in lay.groupBy("_blk").count().collect()) <= 500


def test_broadcast_side_is_bounded_in_bytes(spark):
    tails = spark.createDataFrame([(1, [1.0])], "k long, tail array<double>")
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(segments.bounded_side(tails, 1000, elements=100))
    assert not hinted(segments.bounded_side(tails, 1_000_000, elements=1000))


def results(df):
    return {r.event_id: r.r for r in df.select("event_id", F.round(F.col("r").cast("double"), 6).alias("r")).collect()}


def check(got, df, name, col, w):
    fn = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}[name]
    got, want = results(got), results(df.select("event_id", fn(col).over(w).alias("r")))
    assert {k: str(v) for k, v in got.items()} == {k: str(v) for k, v in want.items()}, (name, col)


@pytest.fixture(scope="module")
def one_key(spark):
    """900 rows of one key, with NULL, NaN and infinite values."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").where("event_id < 900").select(
        "event_id", F.lit(1).alias("user_id"), "ts", F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value"))
    odd = (F.when(F.col("event_id") == 200, float("inf")).when(F.col("event_id") == 400, float("nan"))
           .when(F.col("event_id") == 700, float("-inf")).otherwise(F.col("value")))
    ev = ev.withColumn("odd", odd).withColumn("whole", F.col("event_id") % 97).withColumn("_t", epoch_micros("ts"))
    return materialize(ev)


@pytest.mark.parametrize("k,target,name,col", [(10_000, 10, "sum", "odd"), (300, 10, "min", "value"), (40, 3, "avg", "value"),
                                               (1, 60, "count", "value")])
def test_long_rows_frames_over_small_segments(spark, one_key, k, target, name, col):
    w = W.partitionBy("user_id").orderBy("_t", "event_id").rowsBetween(-k, 0)
    check(over.over_rows(one_key, ["user_id"], "_t", ["event_id"], k, (name, col), "r", target), one_key, name, col, w)


@pytest.mark.parametrize("shape,hours,name,col", [
    ("spread", 40, "avg", "odd"), ("spread", 10**4, "max", "value"), ("one time", 1, "sum", "whole"),
    ("few times", 1, "count", "value"), ("bursts", 40, "min", "odd"), ("bursts", 0, "sum", "odd")])
def test_range_frames_of_many_segments(spark, one_key, shape, hours, name, col):
    """Frames that span up to all segments, and times that fill several: no row
    is copied, and segments are balanced when all rows share one time."""
    t = {"spread": F.col("_t"), "one time": F.lit(5), "few times": (F.col("event_id") % 3) * 3_600_000_000,
         "bursts": F.when(F.col("event_id") % 2 == 0, F.col("_t")).otherwise(F.lit(1_704_200_000_000_000))}[shape]
    df = one_key.withColumn("_t", t.cast("long"))
    d = hours * 3600 * 10**6
    lay = over.range_layout(df, ["user_id"], "_t", d, 30, (name, col))
    sizes = [r["count"] for r in lay.groupBy("_blk").count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 60
    w = W.partitionBy("user_id").orderBy("_t").rangeBetween(-d, 0)
    check(over.over_range(df, ["user_id"], "_t", d, (name, col), "r", 30), df, name, col, w)


def test_unbounded_range_of_one_heavy_time(spark, one_key):
    df = one_key.withColumn("_t", F.when(F.col("event_id") % 3 == 0, F.col("_t")).otherwise(F.lit(1_704_200_000_000_000)))
    w = W.partitionBy("user_id").orderBy("_t").rangeBetween(W.unboundedPreceding, 0)
    check(over.over_range(df, ["user_id"], "_t", None, ("sum", "odd"), "r", 30), df, "sum", "odd", w)


def test_null_times_and_keys(spark, one_key):
    df = one_key.withColumn("_t", F.when(F.col("event_id") % 7 != 0, F.col("_t"))).withColumn(
        "user_id", F.when(F.col("event_id") % 2 == 0, F.col("user_id")))
    w = W.partitionBy("user_id").orderBy("_t", "event_id").rowsBetween(-50, 0)
    check(over.over_rows(df, ["user_id"], "_t", ["event_id"], 50, ("sum", "value"), "r", 20), df, "sum", "value", w)
    r = W.partitionBy("user_id").orderBy("_t").rangeBetween(-3600 * 10**6, 0)
    check(over.over_range(df, ["user_id"], "_t", 3600 * 10**6, ("max", "value"), "r", 20), df, "max", "value", r)


def test_frames_send_at_most_one_message_a_row(spark, one_key):
    """A frame over 30 segments and more: its plan copies no rows."""
    sg = segments.segment(one_key, ["user_id"], "_t", 30, segments.hash_tiebreak(one_key), over._parts(one_key, "max", "value"))
    assert sg.n_segs >= 28
    out = over._range_outside(sg, one_key, 10**13, "max", "value")
    p = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in p and p.count("Union") <= 2
