"""Run every registered query and its DuckDB oracle on one scale factor and
compare row count, column names and the multiset of rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from thermocline.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, oracles = queries(), oracle_sql()
    result = {}
    for name in names or list(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        got = sdf.toPandas()
        if name not in oracles:
            result[name] = f"rows={len(got)} (no oracle)"
            continue
        exp = con.execute(oracles[name]).df()
        if sorted(got.columns) != sorted(exp.columns):
            result[name] = f"SCHEMA {sorted(got.columns)} vs {sorted(exp.columns)}"
            continue
        a, b = _rows(got), _rows(exp)
        if a == b:
            result[name] = f"OK rows={len(a)} {time.time() - t0:.1f}s"
        else:
            sa, sb = set(a), set(b)
            result[name] = (f"MISMATCH rows {len(a)} vs {len(b)}; only spark {list(sa - sb)[:2]}; "
                            f"only oracle {list(sb - sa)[:2]}")
    return result


if __name__ == "__main__":
    from thermocline.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    tz = os.environ.get("ORACLE_SESSION_TZ")
    spark = build_session("local[8]", extra={"spark.sql.session.timeZone": tz} if tz else None)
    for k, v in compare(spark, sf, names).items():
        print(f"{k:24s} {v}")
