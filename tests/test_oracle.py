"""Every registered query equals its DuckDB oracle (the driver's gate)."""

from oracle_check import compare

from thermocline.plans.catalog import QUERIES


def test_queries_match_oracle(spark):
    res = compare(spark, "/root/testdata/sf0.001", list(QUERIES))
    bad = {k: v for k, v in res.items() if not v.startswith("OK")}
    assert not bad, bad


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["user_id", "cnt", "window_start", "window_end", "window_rowtime"]
    assert df.count() > 0
