import os

import pytest

from pyspark.sql import functions as F

from conftest import READINGS
from thermocline.sinks.files import write_csv
from thermocline.sinks.jdbc import jdbc_batch_writer, write_jdbc
from thermocline.sinks.kafka import kafka_sink_options, to_kafka_records
from thermocline.sinks.upsert import compact, read_current, upsert_writer, with_json_doc
from thermocline.sources.kafka import decode_value, kafka_source_options
from thermocline.sources.readings import (ddl_table, ddl_table_sql, parse_lines, read_csv,
                                         register_csv_table)
from thermocline.streaming.harness import run_foreach_batch, text_stream, write_batches


def _lines(sep):
    return [sep.join([i, str(t), str(v)]) for i, t, v in READINGS]


def test_parse_lines_separators_and_trim(spark):
    for sep, regex in [(" ", " "), (",", ","), ("-", "-")]:
        df = spark.createDataFrame([(x,) for x in _lines(sep)], "value string")
        got = [tuple(r) for r in parse_lines(df, sep=regex).collect()]
        assert got == READINGS
    padded = spark.createDataFrame([(" sensor_1 , 1547718199 , 35.8 ",)], "value string")
    assert tuple(parse_lines(padded, sep=",").first()) == READINGS[0]
    ms = spark.createDataFrame([("sensor_3-1547718199000-12.50",)], "value string")
    assert tuple(parse_lines(ms, sep="-").first()) == ("sensor_3", 1547718199000, 12.5)


def test_csv_table_and_ddl(spark, tmp_path):
    p = str(tmp_path / "readings.txt")
    with open(p, "w") as f:
        f.write("\n".join(_lines(" ")) + "\n")
    register_csv_table(spark, "inputTable", p, sep=" ")
    rows = spark.sql("select * from inputTable where id = 'sensor_1'").collect()
    assert sorted(r.timestamp for r in rows) == [1547718199, 1547718207, 1547718212, 1547718215]
    c = str(tmp_path / "readings.csv")
    with open(c, "w") as f:
        f.write("\n".join(_lines(",")) + "\n")
    ddl_table(spark, "sensor", c, sep=",")
    r = spark.sql("select id, ts, rt, rt_wm from sensor order by ts limit 1").first()
    assert str(r.rt) == "2019-01-17 09:43:19" and str(r.rt_wm) == "2019-01-17 09:43:18"
    s = ddl_table(spark, "sensor_stream", os.path.dirname(c), sep=",", stream=True)
    assert s.isStreaming
    q = ddl_table_sql(spark, "sensor_sql", c, sep=",")
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, spark.table("sensor").collect()))


def test_csv_sink_at_delimiter(spark, tmp_path, readings):
    out = str(tmp_path / "out")
    f = readings.where("id = 'sensor_1'").select("id", "timestamp", "temperature")
    write_csv(f, out, sep="@")
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == sorted(["sensor_1@1547718199@35.8", "sensor_1@1547718207@37.2",
                            "sensor_1@1547718212@33.5", "sensor_1@1547718215@38.1"])
    back = read_csv(spark, out, sep="@")
    assert back.count() == 4


def test_kafka_codec_and_options(spark, readings):
    rec = to_kafka_records(readings, "id", ["id", "timestamp", "temperature"]).orderBy("value")
    r = rec.where("value like 'sensor_1,1547718199%'").first()
    assert (r.key, r.value) == ("sensor_1", "sensor_1,1547718199,35.8")
    decoded = parse_lines(decode_value(rec.select(F.col("value").cast("binary").alias("value"))), ",")
    assert sorted(tuple(x) for x in decoded.collect()) == sorted(READINGS)
    o = kafka_source_options("h1:9092,h2:9092", "sensor-readings", "g1")
    assert o["subscribe"] == "sensor-readings" and o["startingOffsets"] == "earliest"
    assert o["kafka.group.id"] == "g1"
    assert kafka_sink_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}


def test_jdbc_sink_derby(spark, tmp_path, readings):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    out = readings.where("id = 'sensor_1'").select("id", F.col("timestamp").alias("sj"), "temperature")
    write_jdbc(out, url, "sensor_count", batchsize=1, column_types="id VARCHAR(20)")
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "sensor_count").load()
    assert sorted(r[1] for r in back.collect()) == [1547718199, 1547718207, 1547718212, 1547718215]
    # streaming through foreachBatch
    d = write_batches(str(tmp_path / "in"), [_lines(" ")[:3], _lines(" ")[3:]])
    s = parse_lines(text_stream(spark, d), " ").select("id", F.col("timestamp").alias("sj"), "temperature")
    run_foreach_batch(s, jdbc_batch_writer(url, "sensor_stream", 1, "id VARCHAR(20)"),
                      str(tmp_path / "ck"))
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "sensor_stream").load()
    assert back.count() == 7


def test_upsert_sink(spark, tmp_path):
    d = write_batches(str(tmp_path / "in"), [_lines(" ")[:4], _lines(" ")[4:]])
    s = parse_lines(text_stream(spark, d), " ")
    s = with_json_doc(s, ["id", "timestamp", "temperature"])
    base = str(tmp_path / "store")
    run_foreach_batch(s, upsert_writer(base, "id", "timestamp", "temperature"), str(tmp_path / "ck"))
    cur = {r.id: (r.timestamp, r.doc) for r in read_current(spark, base).collect()}
    assert cur["sensor_1"] == (1547718215,
                               '{"id":"sensor_1","timestamp":1547718215,"temperature":38.1}')
    assert len(cur) == 4


def test_csv_stream_source_with_ddl_watermark(spark, tmp_path):
    """The DDL-declared table as a stream: CSV files, computed rowtime,
    1 s watermark, tumbling 10 s count (a far-future row closes windows)."""
    from thermocline.operators import group_windows as gw
    from thermocline.streaming.harness import run_to_table
    d = write_batches(str(tmp_path / "csv"), [_lines(",")[:4], _lines(",")[4:], ["zz,1547718400,0.0"]],
                      suffix=".csv")
    s = ddl_table(spark, "sensor_ddl_stream", d, sep=",", stream=True)
    q = gw.tumble_count(s, "id", "rt", "10 seconds").select(
        "id", (F.unix_seconds("window_start") - 1547718000).alias("s"), "cnt")
    rows = [r for r in run_to_table(q, "ddl_stream_out", str(tmp_path / "ck")) if r.id != "zz"]
    assert sorted((r.id, r.s, r.cnt) for r in rows) == sorted([
        ("sensor_1", 190, 1), ("sensor_1", 200, 1), ("sensor_1", 210, 2), ("sensor_6", 200, 1),
        ("sensor_7", 200, 1), ("sensor_10", 200, 1)])


def _as_set(df):
    return {(r.id, r.timestamp, r.temperature) for r in df.collect()}


def test_upsert_table_by_uri_over_batches_queries_and_replays(spark, tmp_path):
    base = f"file://{tmp_path}/table"
    frame = lambda *rows: spark.createDataFrame(list(rows), "id string, timestamp long, temperature double")
    write = upsert_writer(base, "id", "timestamp", "temperature")
    assert read_current(spark, base) is None
    write(frame(("a", 1, 1.0), ("b", 1, 2.0)), 0)
    write(frame(("c", 1, 3.0)), 1)
    assert _as_set(read_current(spark, base)) == {("a", 1, 1.0), ("b", 1, 2.0), ("c", 1, 3.0)}
    # a new query starts at batch 0 again and goes on from what is there
    again = upsert_writer(base, "id", "timestamp", "temperature")
    again(frame(("d", 1, 4.0), ("a", 5, 9.0)), 0)
    want = {("a", 5, 9.0), ("b", 1, 2.0), ("c", 1, 3.0), ("d", 1, 4.0)}
    assert _as_set(read_current(spark, base)) == want
    # a replayed batch and an older row change nothing; an empty batch neither
    again(frame(("d", 1, 4.0), ("a", 5, 9.0)), 0)
    again(frame(("a", 2, 7.0), (None, 1, 0.5)), 1)
    again(frame(), 2)
    assert _as_set(read_current(spark, base)) == want | {(None, 1, 0.5)}
    # compaction: the same rows in one batch, and the old queries go on there
    compact(spark, base, f"{base}-2")
    assert _as_set(read_current(spark, f"{base}-2")) == want | {(None, 1, 0.5)}
    assert {p.name for p in (tmp_path / "table-2").glob("*/*") if p.is_dir()} == {"_upsert_batch=compacted"}
    upsert_writer(f"{base}-2", "id", "timestamp", "temperature")(frame(("b", 9, 0.0), ("a", 1, 1.0)), 0)
    assert _as_set(read_current(spark, f"{base}-2")) == (want - {("b", 1, 2.0)}) | {("b", 9, 0.0), (None, 1, 0.5)}


def test_upsert_stream_over_restarts_and_replays(spark, tmp_path):
    """A restarted query goes on with its batch numbers; micro-batches that are
    run again from an older checkpoint replace their own files."""
    import shutil
    from thermocline.operators.aggregates import latest_per_key
    base, ck, d = (str(tmp_path / x) for x in ("store", "ck", "in"))
    lines, write = _lines(" "), upsert_writer(str(tmp_path / "store"), "id", "timestamp", "temperature")

    def run(upto, ck=ck):
        write_batches(d, [[x] for x in lines[:upto]])
        run_foreach_batch(parse_lines(text_stream(spark, d), " "), write, ck)
    run(3)
    shutil.copytree(ck, str(tmp_path / "older"))
    run(7)
    files = lambda: {p.parent for p in (tmp_path / "store").rglob("*.parquet")}
    before, rows = files(), _as_set(read_current(spark, base))
    assert len({p.name for p in before}) == 7 and len({p.name.rsplit("-", 1)[0] for p in before}) == 1
    run(7, str(tmp_path / "older"))
    assert files() == before and _as_set(read_current(spark, base)) == rows
    whole = parse_lines(spark.read.text(d), " ")
    assert rows == _as_set(latest_per_key(whole, "id", "timestamp", "temperature", ["timestamp", "temperature"]))


def test_malformed_row_fails_a_csv_stream(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from thermocline.sources.readings import read_csv
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("a,notanumber,1.0\n")
    query = (read_csv(spark, str(tmp_path / "in"), stream=True).writeStream.format("memory")
             .queryName("bad_rows").trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()


def test_csv_records_round_trip(spark):
    rows = [("a,b", 1, 'say "x"'), ("plain", None, ""), (" space ", 3, "line")]
    df = spark.createDataFrame(rows, "id string, n long, note string")
    rec = to_kafka_records(df, "id", ["id", "n", "note"])
    back = rec.select(F.from_csv("value", "id string, n long, note string",
                                 {"escape": '"', "nullValue": "\0", "emptyValue": ""}).alias("r")).select("r.id", "r.n")
    assert {tuple(r) for r in back.collect()} == {(i, n) for i, n, _ in rows}


FIELDS = ["plain", " lead", "trail ", "  ", "a,b", "a@b", 'say "x"', '"', '""', "", None, "\ttab", "é😀", "two\nlines"]


@pytest.mark.parametrize("sep", [",", "@"])
def test_every_field_comes_back_as_written(spark, tmp_path, sep):
    """Blanks, quotes, separators, NULL and empty text through the record
    codec, the batch file sink and the stream file sink."""
    from thermocline.sinks.files import READ_OPTIONS, csv_stream
    rows = [(a, i, b) for i, (a, b) in enumerate((a, b) for a in FIELDS for b in FIELDS)]
    kinds = "a string, n long, b string"
    df = spark.createDataFrame(rows, kinds)
    rec = to_kafka_records(df, "n", ["a", "n", "b"], sep=sep)
    back = rec.select(F.from_csv("value", kinds, {**READ_OPTIONS, "sep": sep}).alias("r")).select("r.*")
    assert {tuple(r) for r in back.collect()} == set(rows)
    read = spark.read.options(**READ_OPTIONS).option("sep", sep).option("multiLine", "true").schema(kinds)
    write_csv(df, str(tmp_path / "batch"), sep)
    assert {tuple(r) for r in read.csv(str(tmp_path / "batch")).collect()} == set(rows)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kinds).parquet(str(tmp_path / "in"))
    csv_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck"), sep, {"availableNow": True}).awaitTermination()
    assert {tuple(r) for r in read.csv(str(tmp_path / "out")).collect()} == set(rows)


def test_session_zone_of_the_computed_rowtime(spark, tmp_path):
    from thermocline.sources.readings import ddl_table, ddl_table_sql
    (tmp_path / "r.csv").write_text("sensor_1,1547718199,35.8\n")
    path = str(tmp_path / "r.csv")
    for make in (ddl_table, ddl_table_sql):
        assert str(make(spark, "zoned", path, zone="Asia/Shanghai").first().rt) == "2019-01-17 17:43:19"
        assert str(make(spark, "zoned", path).first().rt) == "2019-01-17 09:43:19"


def test_all_split_queries_count_utf16_units(spark, tmp_path):
    """The four registered forms on text outside the basic plane."""
    from thermocline.plans import catalog
    spark.createDataFrame([(1, "xe😀e é"), (2, "é"), (3, "")], "event_id long, event_type string").write.parquet(
        str(tmp_path / "events.parquet"))
    want = {(1, "x", 1), (1, "😀", 2), (1, " é", 2), (2, "é", 1)}
    for query in (catalog.lateral_split, catalog.lateral_split_sql, catalog.lateral_split_outer, catalog.lateral_udtf_sql):
        got = {(r.event_id, r.word, r.length) for r in query(spark, str(tmp_path)).collect()}
        assert {r for r in got if r[1]} == want, query.__name__


def test_word_length_counts_utf16_units(spark):
    from thermocline.operators.lateral import split_words
    df = spark.createDataFrame([("x😀 é",)], "s string")
    assert [(r.word, r.length) for r in split_words(df, "s", " ", []).collect()] == [("x😀", 3), ("é", 1)]
