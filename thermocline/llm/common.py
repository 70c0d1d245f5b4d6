"""Small helpers shared by the operators: staged tables, byte-exact text
normalisation, exact selection of a kth value."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Runs of the six ASCII white-space characters that end a word.
SPACES = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays (unlike ``lower``)."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda variable is
    bound to it, so a use inside another lambda does not repeat its work."""
    return F.transform(F.array(value), body)[0]


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared checkpoint folder, deleted when the driver's
    JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it
    back: lineage is cut, and a lost executor costs a re-read only."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns_or_null(docs: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; a name that is absent becomes null.
    Narrowing first keeps other columns, whatever their names, out of the
    operators' way."""
    have = set(docs.columns)
    return docs.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c)
                         for c, t in types.items()])


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def by_bytes(batch: pa.RecordBatch, column: int, size: int):
    """Slices of a batch that hold about ``size`` bytes of a text column, at
    least one row each."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def kth_largest(df: DataFrame, value: str, k: int, lo: int, hi: int, bins: int = 4096) -> tuple[int, int]:
    """The ``k``-th largest BIGINT of column ``value`` (all within lo..hi, which
    are less than 2**63 apart) and
    how many rows are larger, by refining one histogram: each pass counts rows
    in ``bins`` equal ranges on the executors, the driver gets at most
    ``bins`` counts and keeps the range that holds the kth row."""
    above = 0
    while lo < hi:
        width = -(-(hi - lo + 1) // bins)
        counts = dict(df.filter(F.col(value).between(lo, hi)).groupBy(
            F.expr(f"(`{value}` - {lo}L) div {width}L").alias("b")).count().collect())
        for b in sorted(counts, reverse=True):
            if above + counts[b] >= k:
                lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
                break
            above += counts[b]
        else:
            raise ValueError("fewer than k rows")
    return lo, above
