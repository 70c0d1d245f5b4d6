"""Golden results on the seven readings (FIXTURES.md §3).  Ordered operators
run with tiny ``target_rows`` too, so the hot-key segment path is exercised
(sensor_1 has 4 rows: targets 1 and 2 split it)."""

import pytest
from pyspark.sql import functions as F

from conftest import BASE
from thermocline.functions.time import naive_from_seconds
from thermocline.operators import aggregates as agg
from thermocline.operators import group_windows as gw
from thermocline.operators import keyed, lateral, over
from thermocline.operators.relational import project, sql_on, where_equals

TARGETS = [1, 2, 1_000_000]


def short(c):
    return (F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
            - BASE)


def by_id(rows, *fields):
    out = {}
    for r in rows:
        out.setdefault(r["id"], []).append(tuple(r[f] for f in fields))
    return {k: sorted(v) for k, v in out.items()}


def test_filter_project_and_sql(spark, readings):
    f = project(where_equals(readings, "id", "sensor_1"), "id", "timestamp", "temperature",
                renames={"temperature": "temp"})
    assert sorted(r.timestamp - BASE for r in f.collect()) == [199, 207, 212, 215]
    s = sql_on(spark, "select * from {t} where id = 'sensor_1'", t=readings)
    assert s.count() == 4
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    assert "sensor_1" in plan


def test_count_avg_max(spark, readings):
    c = {r.id: r.num for r in agg.count_per_key(readings, "id").collect()}
    assert c == {"sensor_1": 4, "sensor_6": 1, "sensor_7": 1, "sensor_10": 1}
    a = {r.id: r.avg_value for r in agg.avg_per_key(readings, "id", "temperature").collect()}
    assert a["sensor_1"] == pytest.approx(36.15) and a["sensor_10"] == pytest.approx(38.1)
    neg = readings.unionByName(spark.createDataFrame(
        [(9, "neg", 0, -5.0)], "rid long, id string, timestamp long, temperature double")
        .withColumn("ts", naive_from_seconds("timestamp")).withColumn("_t", F.lit(0).cast("long")))
    m = {r.id: r.max_value for r in agg.max_floor_per_key(neg, "id", "temperature").collect()}
    assert m == {"sensor_1": 38.1, "sensor_6": 15.4, "sensor_7": 6.7, "sensor_10": 38.1, "neg": 0.0}


def test_top2_padded(spark, readings):
    extra = spark.createDataFrame([("g", 5.0), ("g", 5.0), ("g", 1.0)], "id string, temperature double")
    df = readings.select("id", "temperature").unionByName(extra)
    got = by_id(agg.top2_padded(df, "id", "temperature").collect(), "rank", "temp")
    pad = -2147483648.0
    assert got == {"sensor_1": [(1, 38.1), (2, 37.2)], "sensor_10": [(1, 38.1), (2, pad)],
                   "sensor_6": [(1, 15.4), (2, pad)], "sensor_7": [(1, 6.7), (2, pad)],
                   "g": [(1, 5.0), (2, 5.0)]}


def test_top2_limit_is_pushed_before_shuffle(spark, readings):
    plan = agg.top2_padded(readings, "id", "temperature")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_tumbling_and_rowtime(spark, readings):
    t = gw.tumble_count(readings, "id", "ts", "10 seconds").collect()
    got = by_id([{"id": r.id, "s": r.window_start, "c": r.cnt} for r in
                 gw.tumble_count(readings, "id", "ts", "10 seconds")
                 .select("id", short(F.col("window_start")).alias("window_start"), "cnt").collect()],
                "s", "c")
    assert got == {"sensor_1": [(190, 1), (200, 1), (210, 2)], "sensor_6": [(200, 1)],
                   "sensor_7": [(200, 1)], "sensor_10": [(200, 1)]}
    rt = sorted({r.window_rowtime.strftime("%H:%M:%S.%f")[:12] for r in t})
    assert rt == ["09:43:19.999", "09:43:29.999", "09:43:39.999"]


def test_sliding(spark, readings):
    res = gw.hop_count(readings, "id", "ts", "10 seconds", "5 seconds") \
        .select("id", short(F.col("window_start")).alias("s"), "cnt").collect()
    got = by_id([{"id": r.id, "s": r.s, "c": r.cnt} for r in res], "s", "c")
    assert got["sensor_1"] == [(190, 1), (195, 1), (200, 1), (205, 2), (210, 2), (215, 1)]
    assert got["sensor_6"] == got["sensor_7"] == [(195, 1), (200, 1)]
    assert got["sensor_10"] == [(200, 1), (205, 1)]


@pytest.mark.parametrize("target", TARGETS)
def test_sessions(spark, readings, target):
    res = keyed.sessions(readings, ["id"], "ts", 5, target_rows=target) \
        .select("id", short(F.col("session_start")).alias("a"),
                short(F.col("session_end")).alias("b"), "cnt").collect()
    got = by_id([{"id": r.id, "a": r.a, "b": r.b, "c": r.cnt} for r in res], "a", "b", "c")
    assert got == {"sensor_1": [(199, 204, 1), (207, 220, 3)], "sensor_6": [(201, 206, 1)],
                   "sensor_7": [(202, 207, 1)], "sensor_10": [(205, 210, 1)]}


@pytest.mark.parametrize("target", TARGETS)
def test_over_windows(spark, readings, target):
    def s1(df):
        return [r.cnt for r in df.where("id = 'sensor_1'").orderBy("timestamp").collect()]

    def others(df):
        return {r.cnt for r in df.where("id != 'sensor_1'").collect()}

    cases = {
        "range5": over.over_range(readings, ["id"], "_t", 5_000_000, ("count", "id"), "cnt", target),
        "range10": over.over_range(readings, ["id"], "_t", 10_000_000, ("count", "id"), "cnt", target),
        "rows2": over.over_rows(readings, ["id"], "_t", ["rid"], 2, ("count", "id"), "cnt", target),
        "rows_unb": over.over_rows(readings, ["id"], "_t", ["rid"], None, ("count", "id"), "cnt", target),
        "range_unb": over.over_range(readings, ["id"], "_t", None, ("count", "id"), "cnt", target),
        "slide2": over.over_rows(readings, ["id"], "_t", ["rid"], 1, ("count", "id"), "cnt", target),
        "rows2_sum": over.over_rows(readings, ["id"], "_t", ["rid"], 2, ("count", "temperature"),
                                    "cnt", target),
    }
    expect = {"range5": [1, 1, 2, 2], "range10": [1, 2, 2, 3], "rows2": [1, 2, 3, 3],
              "rows_unb": [1, 2, 3, 4], "range_unb": [1, 2, 3, 4], "slide2": [1, 2, 2, 2],
              "rows2_sum": [1, 2, 3, 3]}
    for name, df in cases.items():
        assert s1(df) == expect[name], name
        assert others(df) == {1}, name


@pytest.mark.parametrize("target", TARGETS)
def test_over_sum_frames(spark, readings, target):
    df = over.over_rows(readings, ["id"], "_t", ["rid"], 1, ("sum", "temperature"), "s", target)
    got = [round(r.s, 6) for r in df.where("id = 'sensor_1'").orderBy("timestamp").collect()]
    assert got == [35.8, 73.0, 70.7, 71.6]
    df = over.over_range(readings, ["id"], "_t", None, ("max", "temperature"), "m", target)
    got = [r.m for r in df.where("id = 'sensor_1'").orderBy("timestamp").collect()]
    assert got == [35.8, 37.2, 37.2, 38.1]


def test_window_max_row(spark, readings):
    res = agg.max_by_in_window(readings, "id", "ts", "temperature", "rid", "2 seconds",
                               ["rid", "temperature"])
    assert res.count() == 7
    tie = spark.createDataFrame([(1, "a", 10, 5.0), (2, "a", 10, 5.0), (3, "a", 10, 4.0)],
                                "rid long, id string, timestamp long, temperature double") \
        .withColumn("ts", naive_from_seconds("timestamp"))
    r = agg.max_by_in_window(tie, "id", "ts", "temperature", "rid", "2 seconds",
                             ["rid", "temperature"]).first()
    assert (r.rid, r.temperature) == (1, 5.0)


@pytest.mark.parametrize("target", TARGETS)
def test_count_trigger_avg(spark, readings, target):
    res = keyed.count_trigger_avg(readings, ["id"], "ts", "temperature", ["rid"], 120, 2,
                                  target_rows=target).collect()
    got = sorted((r.id, r.cnt, round(r.avg_value, 6)) for r in res)
    assert got == [("sensor_1", 2, 35.8), ("sensor_1", 2, 36.5)]
    gap = spark.createDataFrame([(0, "k", 0, 1.0), (1, "k", 130, 2.0), (2, "k", 140, 4.0)],
                                "rid long, id string, timestamp long, temperature double") \
        .withColumn("ts", naive_from_seconds("timestamp"))
    res = keyed.count_trigger_avg(gap, ["id"], "ts", "temperature", ["rid"], 120, 2,
                                  target_rows=target).collect()
    assert [(r.cnt, r.avg_value) for r in res] == [(2, 3.0)]


@pytest.mark.parametrize("target", TARGETS)
def test_changelog(spark, readings, target):
    res = keyed.changelog_count(readings, ["id"], "ts", ["rid"], ["rid"], target_rows=target)
    s1 = [(r.is_add, r.num) for r in res.where("id = 'sensor_1'").orderBy("rid", "is_add").collect()]
    assert s1 == [(True, 1), (False, 1), (True, 2), (False, 2), (True, 3), (False, 3), (True, 4)]
    adds = keyed.additions(res).where("id = 'sensor_1'").orderBy("rid")
    assert [r.num for r in adds.collect()] == [1, 2, 3, 4]
    total = res.select(F.sum(F.when(F.col("is_add"), F.col("num")).otherwise(-F.col("num")))).first()[0]
    assert total == 7  # adds minus retracts = final counts summed


def test_control_block(spark):
    words = spark.createDataFrame([(w, 0) for w in ["alpha", "DROP", "beta", "IGNORE"]],
                                  "word string, t long").withColumn("ts", naive_from_seconds("t"))
    control = spark.createDataFrame([(w, 0) for w in ["DROP", "IGNORE"]],
                                    "word string, t long").withColumn("ts", naive_from_seconds("t"))
    got = sorted(r.word for r in keyed.control_block(words, control, "word", "ts").collect())
    assert got == ["alpha", "beta"]


def test_lateral_split(spark, readings):
    res = lateral.split_words(readings, "id", "_", ["rid"]).collect()
    assert len(res) == 14
    assert {(r.word, r.length) for r in res} == {("sensor", 6), ("1", 1), ("6", 1), ("7", 1),
                                                 ("10", 2)}
    df = spark.createDataFrame([(1, "a_b"), (2, "__")], "rid long, s string")
    inner = lateral.split_words(df, "s", "_", ["rid"]).collect()
    outer = lateral.split_words(df, "s", "_", ["rid"], outer=True).collect()
    assert sorted((r.rid, r.word) for r in inner) == [(1, "a"), (1, "b")]
    assert (2, None, None) in {(r.rid, r.word, r.length) for r in outer}


def test_udtf_and_udaf_registration(spark, readings):
    from thermocline.functions.udfs import partial_averages, register_avg_udaf, register_split_udtf
    register_split_udtf(spark)
    register_avg_udaf(spark)
    readings.createOrReplaceTempView("sensor")
    rows = spark.sql("SELECT id, word, length FROM sensor, LATERAL split_words(id, '_')").collect()
    assert len(rows) == 14
    partial_averages(readings, ["id"], "temperature").createOrReplaceTempView("parts")
    a = {r.id: r.a for r in spark.sql("SELECT id, avg_temp(sum(total), sum(n)) a FROM parts GROUP BY id")
         .collect()}
    assert a["sensor_1"] == pytest.approx(36.15)
