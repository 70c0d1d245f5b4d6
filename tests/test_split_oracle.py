"""The ordered queries with every key split into small segments still equal
their DuckDB oracles."""

import pytest
from oracle_check import compare

from thermocline.operators import segments

ORDERED = ["row_slide_count", "over_unbounded_range", "over_unbounded_rows", "over_range", "over_range_sql", "over_rows",
           "over_named_window", "session_count", "count_trigger_avg", "changelog_count"]


@pytest.mark.parametrize("target,sf", [(5, "sf0.001"), (50, "sf0.01"), (500, "sf0.01")])
def test_split_plans_match_oracles(spark, monkeypatch, target, sf):
    monkeypatch.setattr(segments, "DEFAULT_TARGET_ROWS", target)
    res = compare(spark, f"/root/testdata/{sf}", ORDERED)
    bad = {k: v for k, v in res.items() if not v.startswith("OK")}
    assert not bad, bad
