"""DuckDB SQL oracles for the registered queries (same column names and
types).  Plain SQL over the ``events`` view, written independently of the
Spark plans: OVER windows partitioned by key, lag-based sessions and runs,
list lambdas for the hashes."""

from __future__ import annotations

from .catalog import (OVER_RANGE_SECONDS, SESSION_GAP_SECONDS, SPLIT_SEP,
                      TTL_SECONDS)

ID = "('sensor_' || CAST(user_id AS VARCHAR))"
SECS = "CAST(floor(epoch(ts)) AS BIGINT)"
HB = "time_bucket(INTERVAL 1 HOUR, ts)"


def _wrap(x: str) -> str:
    return f"CAST(((({x}) % 4294967296 + 4294967296) % 4294967296 + 2147483648) % 4294967296 - 2147483648 AS INTEGER)"


def _jhash(s: str) -> str:
    return _wrap(f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({s}, ''), "
                 f"lambda x: unicode(x)::BIGINT)), lambda a, x: (a * 31 + x) % 4294967296)")


def _dhash(x: str) -> str:
    a = f"abs({x})"
    e0 = f"floor(log2({a}))"
    m0 = f"({a} / pow(2.0, {e0}))"
    e = f"({e0} + CASE WHEN {m0} >= 2 THEN 1 WHEN {m0} < 1 THEN -1 ELSE 0 END)"
    frac = f"CAST(({a} / pow(2.0, {e}) - 1.0) * pow(2.0, 52) AS BIGINT)"
    hi = (f"((CASE WHEN {x} < 0 THEN 2147483648 ELSE 0 END) + CAST({e} + 1023 AS BIGINT) * 1048576"
          f" + {frac} // 4294967296)")
    lo = f"({frac} % 4294967296)"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 THEN 0 "
            f"ELSE {_wrap(f'xor({hi}, {lo})')} END")


def _java_split(s: str, sep: str) -> str:
    p = f"regexp_split_to_array({s}, '{sep}')"
    q = f"list_position(list_reverse(list_transform({p}, lambda x: x <> '')), true)"
    return (f"CASE WHEN len({p}) <= 1 THEN {p} WHEN {q} IS NULL THEN []::VARCHAR[] "
            f"ELSE {p}[1:len({p}) - {q} + 1] END")


_OVER = "SELECT event_id, user_id, ts, count(user_id) OVER (PARTITION BY user_id ORDER BY {o} {f}) AS cnt FROM events"

ORACLE: dict[str, str] = {
    "tumble_count": f"""
        SELECT user_id, count(user_id) AS cnt, {HB} AS window_start,
               {HB} + INTERVAL 1 HOUR AS window_end,
               {HB} + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS window_rowtime
        FROM events GROUP BY user_id, {HB}""",
    "tumble_count_sql": f"""
        SELECT user_id, count(user_id) AS cnt, {HB} AS window_start,
               {HB} + INTERVAL 1 HOUR AS window_end,
               {HB} + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS window_rowtime
        FROM events GROUP BY user_id, {HB}""",
    "hop_count": f"""
        SELECT user_id, count(user_id) AS cnt, s AS window_start, s + INTERVAL 2 HOUR AS window_end,
               s + INTERVAL 2 HOUR - INTERVAL 1 MILLISECOND AS window_rowtime
        FROM (SELECT user_id, unnest([{HB}, {HB} - INTERVAL 1 HOUR]) AS s FROM events)
        GROUP BY user_id, s""",
    "session_count": f"""
        WITH o AS (SELECT user_id, ts, event_id,
                          lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
             g AS (SELECT user_id, ts, sum(CASE WHEN prev IS NULL OR ts - prev > INTERVAL {SESSION_GAP_SECONDS} SECOND
                                              THEN 1 ELSE 0 END)
                          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
                   FROM o)
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {SESSION_GAP_SECONDS} SECOND AS session_end,
               count(*) AS cnt
        FROM g GROUP BY user_id, sid""",
    "row_slide_count": _OVER.format(o="ts, event_id", f="ROWS BETWEEN 1 PRECEDING AND CURRENT ROW"),
    "over_unbounded_range": _OVER.format(o="ts", f="RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"),
    "over_unbounded_rows": _OVER.format(o="ts, event_id", f="ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"),
    "over_range": _OVER.format(
        o="ts", f=f"RANGE BETWEEN INTERVAL {OVER_RANGE_SECONDS} SECOND PRECEDING AND CURRENT ROW"),
    "over_rows": _OVER.format(o="ts, event_id", f="ROWS BETWEEN 2 PRECEDING AND CURRENT ROW"),
    "over_range_sql": _OVER.format(
        o="ts", f=f"RANGE BETWEEN INTERVAL {OVER_RANGE_SECONDS} SECOND PRECEDING AND CURRENT ROW"),
    # the aggregate function sums exactly (order-free), so compare with the
    # compensated sum rather than avg's plain running sum
    "avg_udaf_sql": "SELECT user_id, round(avg(value), 6) AS avg_value FROM events GROUP BY user_id",
    "max_udaf": "SELECT user_id, greatest(0.0, max(value)) AS max_value FROM events GROUP BY user_id",
    "top2_table_udaf": """
        WITH r AS (SELECT user_id, value,
                          row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS rn
                   FROM events WHERE value > -2147483648.0 AND NOT isnan(value)),
             k AS (SELECT user_id, unnest([1, 2]) AS rank FROM (SELECT DISTINCT user_id FROM events))
        SELECT k.user_id AS user_id, coalesce(r.value, -2147483648.0) AS temp, CAST(k.rank AS INTEGER) AS rank
        FROM k LEFT JOIN r ON r.user_id = k.user_id AND r.rn = k.rank""",
    "extremes_table_udaf": """
        WITH x AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM events WHERE value IS NOT NULL GROUP BY user_id)
        SELECT x.user_id AS user_id, 'lowest' AS side, lo AS value, count(*) AS times
        FROM x JOIN events e ON e.user_id = x.user_id AND e.value = lo GROUP BY ALL
        UNION ALL
        SELECT x.user_id AS user_id, 'highest' AS side, hi AS value, count(*) AS times
        FROM x JOIN events e ON e.user_id = x.user_id AND e.value = hi GROUP BY ALL""",
    "lateral_udtf_sql": f"""
        SELECT event_id, word, CAST(length(word) AS INTEGER) AS length
        FROM (SELECT event_id, unnest({_java_split('event_type', SPLIT_SEP)}) AS word FROM events)""",
    "over_named_window": """
        SELECT event_id, user_id, ts, count(user_id) OVER w AS cnt FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "count_per_key": "SELECT user_id, count(user_id) AS num FROM events GROUP BY user_id",
    "avg_per_key": "SELECT user_id, round(avg(value), 6) AS avg_value FROM events GROUP BY user_id",
    "max_floor0_per_key": "SELECT user_id, greatest(0.0, max(value)) AS max_value FROM events GROUP BY user_id",
    "top2_padded": """
        WITH r AS (SELECT user_id, value,
                          row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS rn
                   FROM events WHERE value > -2147483648.0 AND NOT isnan(value)),
             k AS (SELECT user_id, unnest([1, 2]) AS rank FROM (SELECT DISTINCT user_id FROM events))
        SELECT k.user_id AS user_id, coalesce(r.value, -2147483648.0) AS temp, CAST(k.rank AS INTEGER) AS rank
        FROM k LEFT JOIN r ON r.user_id = k.user_id AND r.rn = k.rank""",
    "window_max_by": f"""
        SELECT user_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, event_id, value
        FROM (SELECT user_id, {HB} AS window_start, event_id, value,
                     row_number() OVER (PARTITION BY user_id, {HB} ORDER BY value DESC, event_id) AS rn
              FROM events) WHERE rn = 1""",
    "count_trigger_avg": f"""
        WITH o AS (SELECT user_id, ts, event_id, value,
                          lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
             r AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL {TTL_SECONDS} SECOND
                                 THEN 1 ELSE 0 END)
                          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run
                   FROM o),
             c AS (SELECT *, (row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) - 1) // 2 AS chunk
                   FROM r)
        SELECT user_id, count(*) AS cnt, round(avg(value), 6) AS avg_value, max(ts) AS emit_ts
        FROM c GROUP BY user_id, run, chunk HAVING count(*) = 2""",
    "changelog_count": """
        WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
                   FROM events)
        SELECT user_id, event_id, true AS is_add, rn AS num FROM r
        UNION ALL SELECT user_id, event_id, false AS is_add, rn - 1 AS num FROM r WHERE rn > 1""",
    "upsert_latest": """
        SELECT user_id, event_id, ts, event_type, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events) WHERE rn = 1""",
    "control_block": """
        SELECT event_id, user_id, ts, event_type FROM events w
        WHERE event_type <> 'error' AND NOT EXISTS (
          SELECT 1 FROM events c WHERE c.event_type = 'error' AND c.user_id = w.user_id AND c.ts <= w.ts)""",
    "lateral_split": f"""
        SELECT event_id, word, CAST(length(word) AS INTEGER) AS length
        FROM (SELECT event_id, unnest({_java_split('event_type', SPLIT_SEP)}) AS word FROM events)""",
    "lateral_split_sql": f"""
        SELECT event_id, word, CAST(length(word) AS INTEGER) AS length
        FROM (SELECT event_id, unnest({_java_split('event_type', SPLIT_SEP)}) AS word FROM events)""",
    "lateral_split_outer": f"""
        SELECT event_id, word, CAST(length(word) AS INTEGER) AS length
        FROM (SELECT event_id, unnest(CASE WHEN len(p) = 0 THEN [NULL]::VARCHAR[] ELSE p END) AS word
              FROM (SELECT event_id, {_java_split('event_type', SPLIT_SEP)} AS p FROM events))""",
    "parse_readings": f"""
        SELECT CAST(user_id AS VARCHAR) AS id, {SECS} AS timestamp, value AS temperature FROM events""",
    "filter_project": "SELECT user_id AS id, ts, value AS temp FROM events WHERE event_type = 'click'",
    "filter_sql": "SELECT * FROM events WHERE event_type = 'click'",
    "computed_event_time": f"""
        SELECT CAST(user_id AS VARCHAR) AS id, {SECS} AS timestamp, value AS temperature,
               date_trunc('second', ts) AS rt, date_trunc('second', ts) - INTERVAL 1 SECOND AS rt_wm
        FROM events""",
    "format_time": f"""
        SELECT event_id, {ID} AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_utc,
               strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS time_cn, value AS temperature
        FROM events""",
    "to_csv_value": f"""
        SELECT event_id, CAST(user_id AS VARCHAR) AS key,
               concat_ws(',', CAST(user_id AS VARCHAR), CAST({SECS} AS VARCHAR), CAST(value AS VARCHAR)) AS value
        FROM events""",
    "trim_id": "SELECT event_id, trim('  ' || event_type || '  ') AS id_trim FROM events",
    "format_number": "SELECT event_id, printf('%06.3f', value) AS f6, printf('%.2f', value) AS f2 FROM events",
    "json_round_trip": """
        SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "hash_factor": f"SELECT event_id, {ID} AS id, {_wrap('CAST(' + _jhash(ID) + ' AS BIGINT) * 10')} AS hash_id FROM events",
    "hash_columns": f"""
        SELECT event_id, {_jhash(ID)} AS h_id, {_jhash('CAST(value AS VARCHAR)')} AS h_temp_text,
               {_dhash('value')} AS h_temp, {_wrap(f'CAST({_jhash(ID)} AS BIGINT) + CAST({_dhash("value")} AS BIGINT)')} AS h_pair
        FROM events""",
    "hash_sql": f"""
        SELECT event_id, {_wrap('CAST(' + _jhash(ID) + ' AS BIGINT) * 10')} AS hash_id, {_jhash(ID)} AS h_id,
               {_dhash('value')} AS h_temp, {_wrap(f'CAST({_jhash(ID)} AS BIGINT) + CAST({_dhash("value")} AS BIGINT)')} AS h_pair
        FROM events""",
}
