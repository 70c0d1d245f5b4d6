"""Windows over several sources, one of which idles."""

import pytest

from conftest import BASE
from thermocline.operators import group_windows as gw
from thermocline.sources.readings import parse_lines
from thermocline.streaming.event_time import merged_sources, with_event_time
from thermocline.streaming.harness import run_to_table, text_stream, write_batches


def readings(spark, d, batches):
    write_batches(d, batches)
    return with_event_time(parse_lines(text_stream(spark, d), sep=" "), "timestamp", "s", "2 seconds")


@pytest.mark.parametrize("policy, want", [("max", [("a", 200, 2), ("b", 200, 1)]), ("min", [])])
def test_windows_close_while_a_source_idles(spark, tmp_path, policy, want):
    busy = readings(spark, str(tmp_path / "busy"), [[f"a {BASE + 201} 1.0", f"a {BASE + 205} 1.0"], [f"a {BASE + 400} 1.0"],
                                                    [f"a {BASE + 401} 1.0"]])
    idle = readings(spark, str(tmp_path / "idle"), [[f"b {BASE + 202} 1.0"]])
    try:
        counted = gw.tumble_count(merged_sources([busy, idle], policy), "id", "ts", "10 seconds")
        rows = run_to_table(counted, f"merged_{policy}", str(tmp_path / "ck"))
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
    assert sorted((r.id, int(r.window_start.timestamp()) - BASE, r.cnt) for r in rows) == want
    with pytest.raises(ValueError):
        merged_sources([busy], "mean")
