"""Projections, renames and filters in API and SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def project(df: DataFrame, *cols: str, renames: dict[str, str] | None = None) -> DataFrame:
    """``select('a, 'b as 'c)``: keep ``cols``, renaming per ``renames``."""
    renames = renames or {}
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in cols])


def where_equals(df: DataFrame, col: str, value) -> DataFrame:
    """``filter("col = 'value'")`` — pushed into the scan by Catalyst."""
    return df.where(F.col(col) == F.lit(value))


def sql_on(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text that names DataFrames as ``{name}`` (inlining a table
    object into the SQL string), without touching the session catalog."""
    return spark.sql(query, **tables)
