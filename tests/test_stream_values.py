"""Stream = batch with rows shuffled over micro-batches: BIGINT and NULL
keys, NULL and NaN values, descending ids, all frames and aggregates."""

import math
import os
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from thermocline.operators import aggregates as agg_ops
from thermocline.operators import group_windows as gw
from thermocline.operators import lateral
from thermocline.streaming import stateful
from thermocline.streaming.harness import run_to_table

SCHEMA = "k long, ts timestamp, id long, value double, word string"
LAST = 9_000_000_000


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    r = random.Random(6)
    rows = []
    for i in range(90):
        k = r.choice([None, 2**60 + 1, 2**60 + 2, 7])
        v = r.choice([None, float("nan"), 1.0, -2.5, 7.25, 40.0])
        rows.append((k, 1_700_000_000 + 20 * r.randrange(120), 1000 - i, v, r.choice(["a-b", "", None, "c"])))
    df = spark.createDataFrame(rows, "k long, t long, id long, value double, word string").select(
        "k", F.timestamp_seconds("t").alias("ts"), "id", "value", "word")
    end = spark.createDataFrame([(-1, LAST, 0, 0.0, "end")], "k long, t long, id long, value double, word string").select(
        "k", F.timestamp_seconds("t").alias("ts"), "id", "value", "word")
    d = str(tmp_path_factory.mktemp("shuffled"))
    for i in range(5):  # rows of any time in any batch, then one that ends all
        part = df.filter(F.pmod(F.xxhash64("id"), F.lit(4)) == i) if i < 4 else end
        part.coalesce(1).write.parquet(os.path.join(d, f"b{i}"))
        for f in os.scandir(os.path.join(d, f"b{i}")):
            os.utime(f.path, (1_700_000_000 + 10 * i,) * 2)
    return df, d


def stream(spark, data):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(data[1]).withWatermark("ts", "2 hours"))


def clean(rows, drop=-1):
    tell = lambda x: "nan" if isinstance(x, float) and math.isnan(x) else round(x, 6) if isinstance(x, float) else x
    return sorted((tuple(map(tell, r)) for r in rows if r[0] != drop), key=str)


@pytest.mark.parametrize("frame,preceding,name", [
    ("rows", None, "avg"), ("rows", None, "max"), ("rows", 2, "sum"), ("rows", 2, "min"), ("rows", 2, "count"),
    ("range", None, "sum"), ("range", None, "min"), ("range", None, "count"),
    ("range", 300, "avg"), ("range", 300, "max"), ("range", 300, "count")])
def test_over(spark, data, tmp_path, frame, preceding, name):
    got = run_to_table(stateful.over_stream(stream(spark, data), "k", "ts", "id", frame, preceding,
                                            None if name == "count" else "value", name, "r"),
                       f"over_{frame}_{preceding}_{name}", str(tmp_path / "ck"))
    w = W.partitionBy("k").orderBy("t") if frame == "range" else W.partitionBy("k").orderBy("t", "id")
    bound = W.unboundedPreceding if preceding is None else -preceding
    w = w.rangeBetween(bound, 0) if frame == "range" else w.rowsBetween(bound, 0)
    fn = {"count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[name]
    want = data[0].withColumn("t", F.unix_seconds("ts")).select(
        "k", "id", fn("k" if name == "count" else "value").over(w).alias("r"))
    assert clean((r.k, r.id, r.r) for r in got) == clean(map(tuple, want.collect()))


def test_changelog_and_order(spark, data, tmp_path):
    got = run_to_table(stateful.changelog_stream(stream(spark, data), "k", "ts", "id"), "changes", str(tmp_path / "ck"))
    final, order = {}, {}
    for r in got:
        order.setdefault(r.k, []).append((r.is_add, r.num))
        if r.is_add:
            final[r.k] = r.num
    want = {r.k: r.n for r in data[0].groupBy("k").agg(F.count("k").alias("n")).collect()}
    assert {k: n for k, n in final.items() if k != -1} == want
    for k, seq in order.items():
        if k is not None:
            assert seq == [x for n in range(1, want.get(k, 1) + 1) for x in ((False, n - 1), (True, n)) if x[1]]


def brute_runs(rows, threshold, ttl):
    """The count-triggered average over rows in arrival order."""
    out, state = [], {}
    for k, t, v in rows:
        n, nv, s, last = state.get(k, (0, 0, 0.0, None))
        if last is not None and t - last >= ttl:
            n, nv, s, last = 0, 0, 0.0, None
        n, last = n + 1, t if last is None else max(last, t)
        if v is not None:
            nv, s = nv + 1, s + v
        state[k] = (n, nv, s, last)
        if n == threshold:
            out.append((k, n, s / nv if nv else None))
            del state[k]
    return out


def test_count_trigger_average(spark, data, tmp_path):
    got = run_to_table(stateful.count_trigger_avg_stream(stream(spark, data), "k", "ts", "value", "id", 3, 10**8),
                       "runs", str(tmp_path / "ck"))
    rows = data[0].withColumn("b", F.pmod(F.xxhash64("id"), F.lit(4))).orderBy("b", "ts", "id").collect()
    want = brute_runs([(r.k, r.ts.timestamp(), r.value) for r in rows], 3, 10**8)
    assert clean((r.k, r.cnt, r.avg_value) for r in got) == clean(want)


def test_ttl_never_moves_back(spark, tmp_path):
    d = str(tmp_path / "in")
    for i, (t, v) in enumerate([(100_100, 1.0), (100_000, 2.0), (100_130, 3.0)]):
        spark.createDataFrame([(1, t, i, v, "")], "k long, t long, id long, value double, word string").select(
            "k", F.timestamp_seconds("t").alias("ts"), "id", "value", "word").coalesce(1).write.parquet(f"{d}/b{i}")
        for f in os.scandir(f"{d}/b{i}"):
            os.utime(f.path, (1_700_000_000 + 10 * i,) * 2)
    s = stateful.count_trigger_avg_stream(stream(spark, (None, d)), "k", "ts", "value", "id", 3, 120)
    assert [(r.k, r.cnt, r.avg_value) for r in run_to_table(s, "ttl_back", str(tmp_path / "ck"))] == [(1, 3, 2.0)]


def test_control_block_and_top2(spark, data, tmp_path):
    s = stream(spark, data)
    control = s.where("id % 17 = 0").select("k", "ts")
    got = run_to_table(stateful.control_block_stream(s.select("k", "ts", "id"), control, "k", "ts", "id"),
                       "blocked", str(tmp_path / "ck"))
    assert {r.id for r in got if r.k is None} == {r.id for r in data[0].where("k is null").collect()}
    assert {type(r.k) for r in got if r.k is not None} == {int}
    top = run_to_table(stateful.top2_stream(stream(spark, data), "k", "value"), "top2", str(tmp_path / "ck2"), "update")
    last = {(r.k, r.rank): r.temp for r in top if r.k != -1}
    for k in {k for k, _ in last}:
        v = sorted((r.value for r in data[0].where(F.col("k").eqNullSafe(F.lit(k))).collect()
                    if r.value is not None and not math.isnan(r.value)), reverse=True)[:2]
        assert [last[k, 1], last[k, 2]] == v


def test_windows_sessions_aggregates_and_split(spark, data, tmp_path):
    batch = data[0]
    for name, fn in (("hop", lambda d: gw.hop_count(d, "k", "ts", "10 minutes", "5 minutes")),
                     ("session", lambda d: gw.session_count(d, "k", "ts", "2 minutes"))):
        got = run_to_table(fn(stream(spark, data)), name, str(tmp_path / name))
        assert clean(map(tuple, got)) == clean(map(tuple, fn(batch).collect())), name
    split = lambda d: lateral.split_words(d, "word", "-", ["k", "id"], outer=True)
    got = run_to_table(split(stream(spark, data)), "split", str(tmp_path / "split"))
    assert clean(map(tuple, got)) == clean(map(tuple, split(batch).collect()))
    for name, fn in (("avg", lambda d: agg_ops.avg_per_key(d, "k", "value")),
                     ("maxfloor", lambda d: agg_ops.max_floor_per_key(d, "k", "value"))):
        got = run_to_table(fn(stream(spark, data)), name, str(tmp_path / name), "complete")
        assert clean(map(tuple, got)) == clean(map(tuple, fn(batch).collect())), name
