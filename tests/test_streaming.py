"""Stream replay (FIXTURES.md §4): four files, one per micro-batch, watermark
2 s; the third row moves the watermark, the fourth file holds a late row and
a sentinel that closes the open windows."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import BASE
from thermocline.operators import aggregates as agg
from thermocline.operators import group_windows as gw
from thermocline.sinks.files import csv_stream
from thermocline.sources.readings import parse_lines
from thermocline.streaming import stateful
from thermocline.streaming.event_time import with_event_time
from thermocline.streaming.harness import run_to_table, text_stream, write_batches

ROWS = ["sensor_1 1547718199 35.8", "sensor_6 1547718201 15.4", "sensor_7 1547718202 6.7",
        "sensor_10 1547718205 38.1", "sensor_1 1547718207 37.2", "sensor_1 1547718212 33.5",
        "sensor_1 1547718215 38.1"]
REPLAY = [ROWS[:4], ROWS[4:], ["sensor_6 1547718300 1.0"],
          ["sensor_1 1547718201 9.9", "sensor_6 1547718400 1.0"]]


def stream(spark, tmp_path, batches=REPLAY, delay="2 seconds"):
    d = write_batches(str(tmp_path / "in"), batches)
    return with_event_time(parse_lines(text_stream(spark, d), sep=" "), "timestamp", "s", delay)


def secs(c):
    return F.unix_seconds(F.col(c)) - BASE


def test_tumbling_append(spark, tmp_path):
    q = gw.tumble_count(stream(spark, tmp_path), "id", "ts", "10 seconds") \
        .select("id", secs("window_start").alias("s"), "cnt")
    rows = run_to_table(q, "tumble_out", str(tmp_path / "ck"))
    assert sorted((r.id, r.s, r.cnt) for r in rows) == sorted([
        ("sensor_1", 190, 1), ("sensor_1", 200, 1), ("sensor_1", 210, 2), ("sensor_6", 200, 1),
        ("sensor_7", 200, 1), ("sensor_10", 200, 1), ("sensor_6", 300, 1)])


def test_session_append(spark, tmp_path):
    s = stream(spark, tmp_path)
    q = (s.groupBy("id", F.session_window("ts", "5 seconds").alias("w")).agg(F.count("id").alias("cnt"))
         .select("id", secs("w.start").alias("a"), secs("w.end").alias("b"), "cnt"))
    rows = run_to_table(q, "session_out", str(tmp_path / "ck"))
    assert sorted((r.id, r.a, r.b, r.cnt) for r in rows) == sorted([
        ("sensor_1", 199, 204, 1), ("sensor_1", 207, 220, 3), ("sensor_6", 201, 206, 1),
        ("sensor_7", 202, 207, 1), ("sensor_10", 205, 210, 1), ("sensor_6", 300, 305, 1)])


def test_group_count_update_mode(spark, tmp_path):
    q = agg.count_per_key(stream(spark, tmp_path, delay=None), "id")
    rows = run_to_table(q, "count_out", str(tmp_path / "ck"), output_mode="update")
    final = {}
    for r in rows:
        final[r.id] = max(final.get(r.id, 0), r.num)
    assert final == {"sensor_1": 5, "sensor_6": 3, "sensor_7": 1, "sensor_10": 1}


def test_count_trigger_avg_stream(spark, tmp_path):
    q = stateful.count_trigger_avg_stream(stream(spark, tmp_path), "id", "ts", "temperature",
                                          "timestamp", threshold=2, ttl_seconds=120)
    rows = run_to_table(q, "avg_out", str(tmp_path / "ck"))
    assert sorted((r.id, r.cnt, round(r.avg_value, 6)) for r in rows) == [
        ("sensor_1", 2, 35.8), ("sensor_1", 2, 36.5), ("sensor_6", 2, 8.2)]


def test_over_rows_stream_shuffled_with_late_row(spark, tmp_path):
    batches = [[ROWS[3], ROWS[1], ROWS[0], ROWS[2]], [ROWS[6], ROWS[4], ROWS[5]],
               ["zz 1547718300 1.0"], ["sensor_1 1547718201 9.9", "zz 1547718400 1.0"]]
    q = stateful.over_stream(stream(spark, tmp_path, batches), "id", "ts", "timestamp", "rows", 2)
    rows = run_to_table(q, "over_out", str(tmp_path / "ck"))
    got = sorted((r.id, r.timestamp - BASE, r.cnt) for r in rows)
    assert got == sorted([("sensor_1", 199, 1), ("sensor_1", 207, 2), ("sensor_1", 212, 3),
                          ("sensor_1", 215, 3), ("sensor_6", 201, 1), ("sensor_7", 202, 1),
                          ("sensor_10", 205, 1), ("zz", 300, 1)])


def test_over_range_stream_equals_batch(spark, tmp_path):
    q = stateful.over_stream(stream(spark, tmp_path, REPLAY[:3] + [["zz 1547718400 1.0"]]),
                             "id", "ts", "timestamp", "range", 5)
    rows = run_to_table(q, "over_range_out", str(tmp_path / "ck"))
    s1 = [r.cnt for r in sorted(rows, key=lambda r: r.timestamp) if r.id == "sensor_1"]
    assert s1 == [1, 1, 2, 2]


def test_changelog_stream(spark, tmp_path):
    q = stateful.changelog_stream(stream(spark, tmp_path, REPLAY[:2]), "id", "ts", "timestamp")
    rows = run_to_table(q, "changelog_out", str(tmp_path / "ck"))
    s1 = sorted((r.timestamp, r.is_add, r.num) for r in rows if r.id == "sensor_1")
    assert [(x[1], x[2]) for x in s1] == [(True, 1), (False, 1), (True, 2), (False, 2),
                                              (True, 3), (False, 3), (True, 4)]


def test_control_block_stream(spark, tmp_path):
    w = write_batches(str(tmp_path / "w"), [["alpha", "DROP", "beta", "IGNORE"]])
    c = write_batches(str(tmp_path / "c"), [["DROP", "IGNORE"]])
    words = text_stream(spark, w).select(F.col("value").alias("word"),
                                         F.timestamp_seconds(F.lit(0)).alias("ts"),
                                         F.xxhash64("value").alias("rid"))
    control = text_stream(spark, c).select(F.col("value").alias("word"),
                                           F.timestamp_seconds(F.lit(0)).alias("ts"))
    q = stateful.control_block_stream(words, control, "word", "ts", "rid")
    rows = run_to_table(q, "control_out", str(tmp_path / "ck"))
    assert sorted(r.word for r in rows) == ["alpha", "beta"]


def test_csv_sink_with_at_delimiter(spark, tmp_path):
    s = stream(spark, tmp_path).where("id = 'sensor_1'").select("id", "timestamp", "temperature")
    out = str(tmp_path / "out")
    q = csv_stream(s, out, str(tmp_path / "ck"), sep="@", trigger={"availableNow": True})
    q.awaitTermination(300)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == sorted(["sensor_1@1547718199@35.8", "sensor_1@1547718207@37.2",
                            "sensor_1@1547718212@33.5", "sensor_1@1547718215@38.1",
                            "sensor_1@1547718201@9.9"])


def test_restart_from_checkpoint(spark, tmp_path):
    """Stop after two files, add the rest, restart on the same checkpoint:
    same result as one run (offsets and window state restored)."""
    d = str(tmp_path / "in")
    write_batches(d, REPLAY[:2])
    ck = str(tmp_path / "ck")

    def query():
        s = with_event_time(parse_lines(text_stream(spark, d), sep=" "), "timestamp", "s", "2 seconds")
        return gw.tumble_count(s, "id", "ts", "10 seconds").select("id", secs("window_start").alias("s"), "cnt")

    out = str(tmp_path / "out")

    def run():
        q = (query().writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    first = spark.read.parquet(out).collect()
    assert len(first) == 5  # s1 190, 200 and s6/s7/s10 200 closed; s1 210 still open
    write_batches(d + "_more", REPLAY[2:])
    for i, name in enumerate(sorted(os.listdir(d + "_more"))):
        src = os.path.join(d + "_more", name)
        dst = os.path.join(d, f"part-{i + 2:04d}.txt")
        with open(src) as f, open(dst, "w") as g:
            g.write(f.read())
        st = os.stat(os.path.join(d, "part-0001.txt"))
        os.utime(dst, (st.st_mtime + 10 * (i + 1), st.st_mtime + 10 * (i + 1)))
    run()
    second = spark.read.parquet(out).collect()
    got = sorted((r.id, r.s, r.cnt) for r in second)
    assert got == sorted([
        ("sensor_1", 190, 1), ("sensor_1", 200, 1), ("sensor_1", 210, 2), ("sensor_6", 200, 1),
        ("sensor_7", 200, 1), ("sensor_10", 200, 1), ("sensor_6", 300, 1)])


def test_proctime(spark, tmp_path):
    from thermocline.streaming.event_time import with_local_time, with_proctime
    s = with_local_time(with_proctime(stream(spark, tmp_path, REPLAY[:1], delay=None), "pt"), "lt")
    assert dict(s.dtypes)["pt"] == "timestamp" and dict(s.dtypes)["lt"] == "timestamp_ntz"
    rows = run_to_table(s.select("id", "pt", "lt"), "proctime_out", str(tmp_path / "ck"))
    assert len(rows) == 4 and all(r.pt is not None and r.lt is not None for r in rows)


@pytest.mark.parametrize("delay,expect_first", [("0 seconds", 1), ("10 seconds", 2)])
def test_ascending_drops_late(spark, tmp_path, delay, expect_first):
    """Ascending timestamps (zero delay): a row behind the maximum is late and
    its closed window ignores it; a 10 s bound still counts it.  Spark judges
    late input against the previous batch's watermark, so the late row comes
    two batches after the one that moved the watermark past its window."""
    batches = [["k 1547718010 1.0", "k 1547718025 1.0"], ["k 1547718030 1.0"],
               ["k 1547718015 1.0", "k 1547718040 1.0"], ["k 1547718100 1.0"]]
    s = stream(spark, tmp_path, batches, delay=delay)
    q = gw.tumble_count(s, "id", "ts", "10 seconds").select(secs("window_start").alias("s"), "cnt")
    rows = {r.s: r.cnt for r in run_to_table(q, f"asc_out_{expect_first}", str(tmp_path / "ck"))}
    assert rows[10] == expect_first and rows[20] == 1 and rows[30] == 1 and rows[40] == 1


def test_top2_stream(spark, tmp_path):
    q = stateful.top2_stream(stream(spark, tmp_path, REPLAY[:2], delay=None), "id", "temperature")
    rows = run_to_table(q, "top2_out", str(tmp_path / "ck"), output_mode="update")
    latest = {}
    for r in rows:  # the memory sink keeps every update; the last one per (key, rank) is current
        latest[(r.id, r.rank)] = r.temp
    pad = -2147483648.0
    assert latest == {("sensor_1", 1): 38.1, ("sensor_1", 2): 37.2, ("sensor_6", 1): 15.4,
                      ("sensor_6", 2): pad, ("sensor_7", 1): 6.7, ("sensor_7", 2): pad,
                      ("sensor_10", 1): 38.1, ("sensor_10", 2): pad}


def test_window_max_by_stream(spark, tmp_path):
    q = agg.max_by_in_window(stream(spark, tmp_path), "id", "ts", "temperature", "timestamp",
                             "10 seconds", ["timestamp", "temperature"])
    rows = run_to_table(q, "maxby_out", str(tmp_path / "ck"))
    got = sorted((r.id, r.timestamp - BASE, r.temperature) for r in rows)
    assert got == sorted([("sensor_1", 199, 35.8), ("sensor_1", 207, 37.2), ("sensor_1", 215, 38.1),
                          ("sensor_6", 201, 15.4), ("sensor_7", 202, 6.7), ("sensor_10", 205, 38.1),
                          ("sensor_6", 300, 1.0)])


def test_count_trigger_avg_stream_ttl_across_batches(spark, tmp_path):
    """State written at t=0 has expired (TTL 120 s) when the t=130 reading
    arrives in a later micro-batch: one output (2, 3.0) from 130 and 140."""
    batches = [["k 1547718000 1.0"], ["k 1547718130 2.0"], ["k 1547718140 4.0"], ["zz 1547719000 0.0"]]
    q = stateful.count_trigger_avg_stream(stream(spark, tmp_path, batches), "id", "ts", "temperature",
                                          "timestamp", threshold=2, ttl_seconds=120)
    rows = [r for r in run_to_table(q, "ttl_out", str(tmp_path / "ck")) if r.id == "k"]
    assert [(r.cnt, r.avg_value, r.emit_ts.timestamp() - BASE) for r in rows] == [(2, 3.0, 140.0)]


def test_over_range_stream_peers(spark, tmp_path):
    """RANGE frames include peers: rows with equal time share one result."""
    batches = [["k 1547718010 1.0", "k 1547718010 2.0", "k 1547718012 3.0"], ["k 1547718100 0.0"]]
    d = write_batches(str(tmp_path / "in"), batches)
    s = with_event_time(parse_lines(text_stream(spark, d), sep=" "), "timestamp", "s", "2 seconds") \
        .withColumn("rid", (F.col("temperature") * 10).cast("long"))
    q = stateful.over_stream(s, "id", "ts", "rid", "range", 5)
    rows = run_to_table(q, "peers_out", str(tmp_path / "ck"))
    assert sorted((r.rid, r.cnt) for r in rows) == [(10, 2), (20, 2), (30, 3)]


def test_top2_stream_ties_and_nan(spark, tmp_path):
    batches = [["g 1547718000 5.0", "g 1547718001 NaN"], ["g 1547718002 5.0", "g 1547718003 1.0"],
               ["h 1547718004 -3000000000.0"]]
    q = stateful.top2_stream(stream(spark, tmp_path, batches, delay=None), "id", "temperature")
    latest = {}
    for r in run_to_table(q, "top2_ties_out", str(tmp_path / "ck"), output_mode="update"):
        latest[(r.id, r.rank)] = r.temp
    pad = -2147483648.0
    assert latest == {("g", 1): 5.0, ("g", 2): 5.0, ("h", 1): pad, ("h", 2): pad}


def test_over_stream_sum_and_max(spark, tmp_path):
    """Non-count aggregates take the per-row frame path."""
    b = REPLAY[:2] + [["zz 1547718400 1.0"]]
    q = stateful.over_stream(stream(spark, tmp_path, b), "id", "ts", "timestamp", "rows", 1,
                             value="temperature", agg="sum", out="s")
    rows = run_to_table(q, "over_sum_out", str(tmp_path / "ck1"))
    s1 = [round(r.s, 6) for r in sorted(rows, key=lambda r: r.timestamp) if r.id == "sensor_1"]
    assert s1 == [35.8, 73.0, 70.7, 71.6]
    d2 = tmp_path / "second"
    q = stateful.over_stream(stream(spark, d2, b), "id", "ts", "timestamp", "range", 10,
                             value="temperature", agg="max", out="m")
    rows = run_to_table(q, "over_max_out", str(tmp_path / "ck2"))
    s1 = [r.m for r in sorted(rows, key=lambda r: r.timestamp) if r.id == "sensor_1"]
    assert s1 == [35.8, 37.2, 37.2, 38.1]


def test_control_block_stream_keeps_large_ids_exact(spark, tmp_path):
    big = 2**62 + 1                       # not representable as a double
    w = write_batches(str(tmp_path / "w"), [["a"]])
    c = write_batches(str(tmp_path / "c"), [["a"]])
    # the control row of the same key comes later, so the word is emitted from
    # a batch that also holds a control row
    words = text_stream(spark, w).select(F.col("value").alias("word"),
                                         F.timestamp_seconds(F.lit(0)).alias("ts"),
                                         (F.lit(big) + F.length("value")).alias("rid"))
    control = text_stream(spark, c).select(F.col("value").alias("word"),
                                           F.timestamp_seconds(F.lit(10)).alias("ts"))
    rows = run_to_table(stateful.control_block_stream(words, control, "word", "ts", "rid"),
                        "control_big_out", str(tmp_path / "ck"))
    assert [(r.word, r.rid) for r in rows] == [("a", big + 1)]
