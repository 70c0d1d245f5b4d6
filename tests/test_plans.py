"""Physical-plan properties the scale design relies on."""

import re

from thermocline.functions.time import epoch_micros
from thermocline.operators import keyed, over
from thermocline.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


def test_filter_pushed_and_columns_pruned(spark):
    p = plan(catalog.filter_project(spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "props" not in schema and "event_id" not in schema


def test_aggregates_combine_before_shuffle(spark):
    for q in (catalog.count_per_key, catalog.tumble_count, catalog.window_max_by, catalog.upsert_latest):
        p = plan(q(spark, SF))
        # hash aggregate, or sort aggregate when the buffer holds a struct
        # (max_by over structs); either way partial before the exchange
        assert re.search(r"(Hash|Sort)Aggregate\(keys?=.*functions=\[partial_", p), q.__name__


def test_top2_limits_before_shuffle(spark):
    p = plan(catalog.top2_padded(spark, SF))
    # a partial WindowGroupLimit sits below the exchange
    assert p.count("WindowGroupLimit") >= 2


def test_split_keys_join_small_tables_by_broadcast(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("_t", epoch_micros("ts"))
    df = over.over_rows(ev, ["user_id"], "_t", ["event_id"], 2, ("sum", "value"), "s", 10)
    p = final_plan(df)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_split_sessions_shuffle_input_once(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    p = final_plan(keyed.sessions(ev, ["user_id"], "ts", 1800, target_rows=10))
    assert "ReusedExchange" in p


def test_unsplit_range_frame_has_no_halo(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("_t", epoch_micros("ts"))
    p = plan(over.over_range(ev, ["user_id"], "_t", 3600 * 10**6, ("count", "user_id"), "c"))
    assert "Generate" not in p and "BroadcastHashJoin" not in p


def test_control_block_broadcasts_counted_table(spark):
    p = plan(catalog.control_block(spark, SF))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p


def test_shuffle_budget_of_registered_queries(spark):
    """Without hot keys every registered query scans the table once and
    shuffles it at most once (zero for row-wise operators)."""
    rowwise = {"lateral_split", "lateral_split_sql", "lateral_split_outer", "lateral_udtf_sql",
               "parse_readings", "filter_project", "filter_sql", "computed_event_time", "format_time",
               "to_csv_value", "trim_id", "format_number", "json_round_trip", "hash_factor",
               "hash_columns", "hash_sql"}
    for name, fn in catalog.QUERIES.items():
        p = plan(fn(spark, SF))
        exchanges = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", p))
        # control_block reads the control rows from the table as well
        assert p.count("FileScan") == (2 if name == "control_block" else 1), name
        assert exchanges == (0 if name in rowwise else 1), (name, exchanges)
        assert "SortMergeJoin" not in p and "CartesianProduct" not in p, name
