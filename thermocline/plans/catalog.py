"""Registered queries: each operator of the survey's inventory run over the
driver's ``events`` table (key = user_id, event time = ts, reading = value).

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole table.  Column names equal the DuckDB oracle's (:mod:`.oracle`).
Window sizes are hour-scale because the per-key gaps in ``events`` are
hours; the semantics are those of the reference's 10-second demos.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import (format_number, java_double_hash, java_hash_pair,
                                java_string_hash, scaled_hash, to_csv_value, trim_col)
from ..functions.time import epoch_micros, epoch_seconds, format_epoch_seconds
from ..functions.aggregate import (AvgTemp, Extremes, MaxTemp, TopN, accumulated, aggregate, register_aggregate,
                                   table_aggregate)
from ..functions.udfs import register_split_udtf, register_sql_functions
from ..operators import aggregates as agg
from ..operators import group_windows as gw
from ..operators import keyed, lateral, over
from ..operators.relational import project, sql_on, where_equals
from ..sources.readings import parse_lines, with_computed_rowtime
from ..sources.tables import as_readings, events

KEY = "user_id"
TS = "ts"
VALUE = "value"
TIEBREAK = ["event_id"]
HOUR = 3600
SPLIT_SEP = "error|e"       # regex separator of the lateral split queries
OVER_RANGE_SECONDS = 2 * HOUR
SESSION_GAP_SECONDS = 1800
TTL_SECONDS = 2 * HOUR


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir)


def _ev_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ev(spark, sf_dir).withColumn("_t", epoch_micros(TS))


def _id_text(ev: DataFrame) -> DataFrame:
    return ev.withColumn("id", F.concat(F.lit("sensor_"), F.col(KEY).cast("string")))


# --- sources, projections, filters -----------------------------------------

def parse_readings(spark, sf_dir):
    """Readings written as space-separated lines and parsed back."""
    ev = _ev(spark, sf_dir)
    lines = ev.select(F.concat_ws(" ", F.col(KEY).cast("string"),
                                  epoch_seconds(TS).cast("string"),
                                  F.col(VALUE).cast("string")).alias("value"))
    return parse_lines(lines, sep=" ", trim=True)


def filter_project(spark, sf_dir):
    """Filter on a string column, project with renames."""
    ev = where_equals(_ev(spark, sf_dir), "event_type", "click")
    return project(ev, KEY, TS, VALUE, renames={KEY: "id", VALUE: "temp"})


def filter_sql(spark, sf_dir):
    """``select * ... where`` in SQL over an inlined table object."""
    return sql_on(spark, "SELECT * FROM {t} WHERE event_type = 'click'", t=_ev(spark, sf_dir))


def computed_event_time(spark, sf_dir):
    """Epoch-seconds column → rowtime and rowtime − 1 s."""
    r = as_readings(_ev(spark, sf_dir))
    return with_computed_rowtime(r, "timestamp", "rt", delay_seconds=1)


def format_time(spark, sf_dir):
    """Map to (id, time text, temperature) in two time zones."""
    ev = _id_text(_ev(spark, sf_dir))
    sec = epoch_seconds(TS)
    return ev.select("event_id", "id",
                     format_epoch_seconds(sec, "UTC").alias("time_utc"),
                     format_epoch_seconds(sec, "Asia/Shanghai").alias("time_cn"),
                     F.col(VALUE).alias("temperature"))


def to_csv_value_q(spark, sf_dir):
    """The record's CSV text (Kafka record value) keyed by id."""
    ev = _ev(spark, sf_dir)
    return ev.select("event_id", F.col(KEY).cast("string").alias("key"),
                     to_csv_value(KEY, epoch_seconds(TS), VALUE).alias("value"))


def trim_id(spark, sf_dir):
    """trim a padded text column."""
    ev = _ev(spark, sf_dir)
    padded = F.concat(F.lit("  "), F.col("event_type"), F.lit("  "))
    return ev.select("event_id", trim_col(padded).alias("id_trim"))


def format_number_q(spark, sf_dir):
    """printf formatting of a double."""
    ev = _ev(spark, sf_dir)
    return ev.select("event_id", format_number(VALUE, "%06.3f").alias("f6"),
                     format_number(VALUE, "%.2f").alias("f2"))


def json_round_trip(spark, sf_dir):
    """record → JSON text → record; plus a field of the ``props`` JSON."""
    ev = _ev(spark, sf_dir)
    cols = ["event_id", KEY, "event_type", VALUE]
    doc = ev.select(F.to_json(F.struct(*cols)).alias("doc"), "props")
    back = doc.select(F.from_json("doc", "event_id BIGINT, user_id BIGINT, event_type STRING, "
                                         "value DOUBLE").alias("r"),
                      F.from_json("props", "k INT").alias("p"))
    return back.select("r.*", F.col("p.k").alias("k"))


def hash_factor(spark, sf_dir):
    """String hash × 10 with INT wrap (the parameterised UDF)."""
    ev = _id_text(_ev(spark, sf_dir))
    return ev.select("event_id", "id", scaled_hash("id", 10).alias("hash_id"))


def hash_columns(spark, sf_dir):
    """The three overloads — string, double, string + double."""
    ev = _id_text(_ev(spark, sf_dir))
    return ev.select("event_id",
                     java_string_hash("id").alias("h_id"),
                     java_string_hash(F.col(VALUE).cast("string")).alias("h_temp_text"),
                     java_double_hash(VALUE).alias("h_temp"),
                     java_hash_pair("id", VALUE).alias("h_pair"))


def hash_sql(spark, sf_dir):
    """U1/U2 in SQL: functions registered by name (the string and double hashes
    are Arrow UDFs, the products and wraps around them JVM expressions)."""
    register_sql_functions(spark)
    return sql_on(spark, """
        SELECT event_id, hash_code(id, 10) AS hash_id, hash_string(id) AS h_id,
               hash_double(value) AS h_temp, hash_pair(id, value) AS h_pair
        FROM (SELECT event_id, concat('sensor_', CAST(user_id AS STRING)) AS id, value FROM {t})
    """, t=_ev(spark, sf_dir))


# --- lateral table functions ------------------------------------------------

def lateral_split(spark, sf_dir):
    """``joinLateral(split(col) as (word, length))``."""
    return lateral.split_words(_ev(spark, sf_dir), "event_type", SPLIT_SEP, ["event_id"])


def lateral_split_sql(spark, sf_dir):
    """``, LATERAL TABLE(split(col))`` in SQL."""
    register_sql_functions(spark)
    return sql_on(spark, f"""
        SELECT event_id, word, CAST(octet_length(encode(word, 'UTF-16LE')) / 2 AS INT) AS length
        FROM (SELECT event_id, java_split(event_type, '{SPLIT_SEP}') AS parts FROM {{t}})
        LATERAL VIEW explode(parts) s AS word
    """, t=_ev(spark, sf_dir))


def lateral_split_outer(spark, sf_dir):
    """Left outer lateral join — rows without parts keep NULLs."""
    return lateral.split_words(_ev(spark, sf_dir), "event_type", SPLIT_SEP, ["event_id"],
                               outer=True)


# --- keyed state (batch forms) ----------------------------------------------

def control_block(spark, sf_dir):
    """J4: 'error' events form the control stream that blocks their key."""
    ev = _ev(spark, sf_dir).select("event_id", KEY, TS, "event_type")
    data = ev.where(F.col("event_type") != "error")
    control = ev.where(F.col("event_type") == "error")
    return keyed.control_block(data, control, KEY, TS)


def count_trigger_avg(spark, sf_dir):
    """Average every 2 readings per key, state TTL 2 h."""
    return keyed.count_trigger_avg(_ev(spark, sf_dir), [KEY], TS, VALUE, TIEBREAK,
                                   TTL_SECONDS, threshold=2) \
        .withColumn("avg_value", F.round("avg_value", 6))


def changelog_count(spark, sf_dir):
    """K6: retract stream of the running count per key."""
    return keyed.changelog_count(_ev(spark, sf_dir), [KEY], TS, TIEBREAK, ["event_id"])


def upsert_latest(spark, sf_dir):
    """K4: the keyed upsert store's final state — latest row per key."""
    ev = _ev(spark, sf_dir)
    return agg.latest_per_key(ev, KEY, TS, "event_id", ["event_id", TS, "event_type", VALUE])


# --- aggregates ---------------------------------------------------------------

def count_per_key(spark, sf_dir):
    """A1."""
    return agg.count_per_key(_ev(spark, sf_dir), KEY, "num")


def avg_per_key(spark, sf_dir):
    """A2/U4."""
    return agg.avg_per_key(_ev(spark, sf_dir), KEY, VALUE).withColumn(
        "avg_value", F.round("avg_value", 6))


def max_floor0_per_key(spark, sf_dir):
    """A3/A4."""
    return agg.max_floor_per_key(_ev(spark, sf_dir), KEY, VALUE, "max_value")


def top2_padded(spark, sf_dir):
    """Top-2 table aggregate, padded."""
    return agg.top2_padded(_ev(spark, sf_dir), KEY, VALUE)


def window_max_by(spark, sf_dir):
    """The row with the largest value per key and 1-hour window."""
    return agg.max_by_in_window(_ev(spark, sf_dir), KEY, TS, VALUE, "event_id", "1 hour",
                                ["event_id", VALUE])


# --- group windows ----------------------------------------------------------

def tumble_count(spark, sf_dir):
    """G1/G6."""
    return gw.tumble_count(_ev(spark, sf_dir), KEY, TS, "1 hour")


def tumble_count_sql(spark, sf_dir):
    """GROUP BY window(...) in SQL."""
    return sql_on(spark, """
        SELECT user_id, count(user_id) AS cnt, window.start AS window_start,
               window.end AS window_end, window.end - INTERVAL 1 MILLISECOND AS window_rowtime
        FROM {t} GROUP BY window(ts, '1 hour'), user_id
    """, t=_ev(spark, sf_dir))


def hop_count(spark, sf_dir):
    """Sliding 2 h every 1 h."""
    return gw.hop_count(_ev(spark, sf_dir), KEY, TS, "2 hours", "1 hour")


def session_count(spark, sf_dir):
    """Session gap 30 min."""
    return keyed.sessions(_ev(spark, sf_dir), [KEY], TS, SESSION_GAP_SECONDS)


def row_slide_count(spark, sf_dir):
    """Row-count sliding window of 2 rows every row."""
    ev = _ev_t(spark, sf_dir)
    r = over.over_rows(ev, [KEY], "_t", TIEBREAK, 1, ("count", KEY), "cnt")
    return r.select("event_id", KEY, TS, "cnt")


# --- OVER windows -----------------------------------------------------------

def _over_out(df: DataFrame) -> DataFrame:
    return df.select("event_id", KEY, TS, "cnt")


def over_unbounded_range(spark, sf_dir):
    """O1."""
    return _over_out(over.over_range(_ev_t(spark, sf_dir), [KEY], "_t", None,
                                     ("count", KEY), "cnt"))


def over_unbounded_rows(spark, sf_dir):
    """O2."""
    return _over_out(over.over_rows(_ev_t(spark, sf_dir), [KEY], "_t", TIEBREAK, None,
                                    ("count", KEY), "cnt"))


def over_range(spark, sf_dir):
    """O3: RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND CURRENT ROW."""
    return _over_out(over.over_range(_ev_t(spark, sf_dir), [KEY], "_t",
                                     OVER_RANGE_SECONDS * 1_000_000, ("count", KEY), "cnt"))


def over_rows(spark, sf_dir):
    """ROWS BETWEEN 2 PRECEDING AND CURRENT ROW."""
    return _over_out(over.over_rows(_ev_t(spark, sf_dir), [KEY], "_t", TIEBREAK, 2,
                                    ("count", KEY), "cnt"))


def over_named_window(spark, sf_dir):
    """``COUNT(id) OVER w ... WINDOW w AS (...)`` in SQL, over the
    skew-safe row layout: the window runs per (key, segment) and ``_earlier``
    counts the frame's rows in earlier segments of a hot key."""
    lay = over.rows_layout(_ev_t(spark, sf_dir), [KEY], "_t", TIEBREAK, 2)
    return sql_on(spark, """
        SELECT event_id, user_id, ts,
               COUNT(user_id) OVER w + _earlier AS cnt
        FROM {t}
        WINDOW w AS (PARTITION BY user_id, _seg ORDER BY _t, event_id
                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """, t=lay)


def over_range_sql(spark, sf_dir):
    """O3 in SQL: ``RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND CURRENT ROW``
    over the skew-safe time layout: the window runs per (key, segment),
    ``_earlier`` counts the frame's rows in other segments of a hot key."""
    lay = over.range_layout(_ev_t(spark, sf_dir), [KEY], "_t", OVER_RANGE_SECONDS * 1_000_000)
    return sql_on(spark, f"""
        SELECT event_id, user_id, ts,
               COUNT(user_id) OVER (PARTITION BY user_id, _blk ORDER BY ts
                 RANGE BETWEEN INTERVAL {OVER_RANGE_SECONDS} SECONDS PRECEDING AND CURRENT ROW) + _earlier AS cnt
        FROM {{t}}
    """, t=lay)


def avg_udaf_sql(spark, sf_dir):
    """U4: ``select id, AvgTemp(temperature) ... group by id`` with a registered
    user-defined aggregate; its accumulators are filled in the map tasks and
    merged in a tree before the statement sees them."""
    register_aggregate(spark, AvgTemp())
    return sql_on(spark, "SELECT user_id, round(AvgTemp(value), 6) AS avg_value FROM {t} GROUP BY user_id",
                  t=accumulated(_ev(spark, sf_dir), [KEY], AvgTemp(), VALUE))


def max_udaf(spark, sf_dir):
    """U4/A3: the maximum from 0.0 on as a user-defined aggregate."""
    return aggregate(_ev(spark, sf_dir), [KEY], MaxTemp(), VALUE, "max_value")


def top2_table_udaf(spark, sf_dir):
    """The top-2 table aggregate through the general contract."""
    return table_aggregate(_ev(spark, sf_dir), [KEY], TopN(2), VALUE)


def extremes_table_udaf(spark, sf_dir):
    """Another table aggregate: lowest and highest value of each key, with
    how often they occur."""
    return table_aggregate(_ev(spark, sf_dir), [KEY], Extremes(), VALUE)


def lateral_udtf_sql(spark, sf_dir):
    """``LATERAL split_words(text, sep)`` with a registered table function."""
    register_split_udtf(spark)
    return sql_on(spark, f"""
        SELECT event_id, word, length FROM {{t}}, LATERAL split_words(event_type, '{SPLIT_SEP}')
    """, t=_ev(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tumble_count": tumble_count,
    "tumble_count_sql": tumble_count_sql,
    "hop_count": hop_count,
    "session_count": session_count,
    "row_slide_count": row_slide_count,
    "over_unbounded_range": over_unbounded_range,
    "over_unbounded_rows": over_unbounded_rows,
    "over_range": over_range,
    "over_rows": over_rows,
    "over_named_window": over_named_window,
    "over_range_sql": over_range_sql,
    "count_per_key": count_per_key,
    "avg_per_key": avg_per_key,
    "avg_udaf_sql": avg_udaf_sql,
    "max_udaf": max_udaf,
    "top2_table_udaf": top2_table_udaf,
    "extremes_table_udaf": extremes_table_udaf,
    "max_floor0_per_key": max_floor0_per_key,
    "top2_padded": top2_padded,
    "window_max_by": window_max_by,
    "count_trigger_avg": count_trigger_avg,
    "changelog_count": changelog_count,
    "upsert_latest": upsert_latest,
    "control_block": control_block,
    "lateral_split": lateral_split,
    "lateral_split_sql": lateral_split_sql,
    "lateral_split_outer": lateral_split_outer,
    "lateral_udtf_sql": lateral_udtf_sql,
    "parse_readings": parse_readings,
    "filter_project": filter_project,
    "filter_sql": filter_sql,
    "computed_event_time": computed_event_time,
    "format_time": format_time,
    "to_csv_value": to_csv_value_q,
    "trim_id": trim_id,
    "format_number": format_number_q,
    "json_round_trip": json_round_trip,
    "hash_factor": hash_factor,
    "hash_columns": hash_columns,
    "hash_sql": hash_sql,
}
