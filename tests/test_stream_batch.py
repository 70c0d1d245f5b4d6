"""Stream = batch on the driver's events table: the rows are replayed as
time-ordered parquet files (one micro-batch each) plus a far-future
sentinel that closes every window; each streaming operator must give the
batch operator's rows."""

import os

import pytest
from pyspark.sql import functions as F

from thermocline.functions.time import as_instant, as_naive, epoch_micros
from thermocline.operators import group_windows as gw
from thermocline.operators import keyed, over
from thermocline.streaming import stateful
from thermocline.streaming.harness import run_to_table

SF = "/root/testdata/sf0.001"
SENTINEL = -1


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    d = str(tmp_path_factory.mktemp("events_replay"))
    days = sorted(r.d for r in ev.select(F.to_date("ts").alias("d")).distinct().collect())
    chunks = [days[i:i + 6] for i in range(0, len(days), 6)]
    t0 = 1_700_000_000
    for i, ch in enumerate(chunks):
        part = os.path.join(d, f"b{i:03d}")
        ev.where(F.to_date("ts").isin(ch)).coalesce(1).write.parquet(part)
        for root, _, files in os.walk(part):
            for f in files:
                os.utime(os.path.join(root, f), (t0 + i * 10, t0 + i * 10))
    sentinel = spark.createDataFrame([(10**9, SENTINEL, "view", 0.0)],
                                     "event_id long, user_id long, event_type string, value double") \
        .select("event_id", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), "user_id",
                "event_type", "value")
    part = os.path.join(d, f"b{len(chunks):03d}")
    sentinel.coalesce(1).write.parquet(part)
    for root, _, files in os.walk(part):
        for f in files:
            os.utime(os.path.join(root, f), (t0 + len(chunks) * 10, t0 + len(chunks) * 10))
    return ev, d


def stream_of(spark, replay, delay="1 minute"):
    ev, d = replay
    files = sorted(os.path.join(r, f) for r, _, fs in os.walk(d) for f in fs if f.endswith(".parquet"))
    s = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(d))
    assert len(files) > 2
    return s.withColumn("ts", as_instant("ts")).withWatermark("ts", delay)


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_tumble_stream_equals_batch(spark, replay, tmp_path):
    ev, _ = replay
    batch = gw.tumble_count(ev, "user_id", "ts", "1 hour")
    s = gw.tumble_count(stream_of(spark, replay), "user_id", "ts", "1 hour") \
        .withColumn("window_start", as_naive("window_start"))
    got = [r for r in run_to_table(s, "sb_tumble", str(tmp_path / "ck")) if r.user_id != SENTINEL]
    assert sorted((r.user_id, r.window_start, r.cnt) for r in got) == rows(batch, ["user_id", "window_start", "cnt"])


def test_session_stream_equals_batch(spark, replay, tmp_path):
    ev, _ = replay
    batch = keyed.sessions(ev, ["user_id"], "ts", 1800, target_rows=10)
    s = (stream_of(spark, replay).groupBy("user_id", F.session_window("ts", "1800 seconds").alias("w"))
         .agg(F.count(F.lit(1)).alias("cnt"))
         .select("user_id", as_naive("w.start").alias("session_start"), "cnt"))
    got = [r for r in run_to_table(s, "sb_session", str(tmp_path / "ck")) if r.user_id != SENTINEL]
    assert sorted((r.user_id, r.session_start, r.cnt) for r in got) == \
        rows(batch, ["user_id", "session_start", "cnt"])


def test_count_trigger_avg_stream_equals_batch(spark, replay, tmp_path):
    ev, _ = replay
    batch = keyed.count_trigger_avg(ev, ["user_id"], "ts", "value", ["event_id"], 7200, 2, target_rows=10)
    s = stateful.count_trigger_avg_stream(stream_of(spark, replay), "user_id", "ts", "value", "event_id",
                                          threshold=2, ttl_seconds=7200)
    got = run_to_table(s, "sb_cta", str(tmp_path / "ck"))
    assert sorted((int(r.user_id), r.cnt, round(r.avg_value, 6)) for r in got) == \
        sorted((r.user_id, r.cnt, round(r.avg_value, 6)) for r in batch.collect())


def test_over_rows_and_changelog_stream_equal_batch(spark, replay, tmp_path):
    ev, _ = replay
    t = ev.withColumn("_t", epoch_micros("ts"))
    batch = over.over_rows(t, ["user_id"], "_t", ["event_id"], 2, ("count", "user_id"), "cnt", 10)
    s = stateful.over_stream(stream_of(spark, replay), "user_id", "ts", "event_id", "rows", 2)
    got = [r for r in run_to_table(s, "sb_over", str(tmp_path / "ck1")) if r.user_id != SENTINEL]
    assert sorted((int(r.user_id), r.event_id, r.cnt) for r in got) == rows(batch, ["user_id", "event_id", "cnt"])
    batch = keyed.changelog_count(ev, ["user_id"], "ts", ["event_id"], ["event_id"], target_rows=10)
    s = stateful.changelog_stream(stream_of(spark, replay), "user_id", "ts", "event_id")
    got = [r for r in run_to_table(s, "sb_changelog", str(tmp_path / "ck2")) if r.user_id != SENTINEL]
    assert sorted((int(r.user_id), r.event_id, r.is_add, r.num) for r in got) == \
        rows(batch, ["user_id", "event_id", "is_add", "num"])


def test_control_block_stream_equals_batch(spark, replay, tmp_path):
    ev, _ = replay
    batch = keyed.control_block(ev.where("event_type != 'error'"), ev.where("event_type = 'error'"),
                                "user_id", "ts")
    st = stream_of(spark, replay)
    s = stateful.control_block_stream(st.where("event_type != 'error'"), st.where("event_type = 'error'"),
                                      "user_id", "ts", "event_id")
    got = [r for r in run_to_table(s, "sb_control", str(tmp_path / "ck")) if r.user_id != SENTINEL]
    assert sorted(r.event_id for r in got) == sorted(r.event_id for r in batch.collect())


def test_over_range_stream_equals_batch(spark, replay, tmp_path):
    ev, _ = replay
    t = ev.withColumn("_t", epoch_micros("ts"))
    batch = over.over_range(t, ["user_id"], "_t", 2 * 3600 * 10**6, ("count", "user_id"), "cnt", 10)
    s = stateful.over_stream(stream_of(spark, replay), "user_id", "ts", "event_id", "range", 2 * 3600)
    got = [r for r in run_to_table(s, "sb_over_range", str(tmp_path / "ck")) if r.user_id != SENTINEL]
    assert sorted((int(r.user_id), r.event_id, r.cnt) for r in got) == rows(batch, ["user_id", "event_id", "cnt"])
