"""Keyed upsert sink (a JSON document store's upsert mode, re-aimed).

Spark's own storage keeps the table: each micro-batch is reduced to the latest
row per key (``max_by``, a partial aggregate, so hot keys collapse map-side)
and appended as Parquet under (key bucket, batch).  Dynamic partition
overwrite makes a replayed micro-batch replace what it wrote before.  The
table is read as the latest row per key over all batches; ``compact`` writes
that as one batch of a new folder."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import latest_per_key

BUCKETS = 64
_BUCKET, _BATCH = "_upsert_bucket", "_upsert_batch"


def with_json_doc(df: DataFrame, cols: list[str], out: str = "doc") -> DataFrame:
    return df.withColumn(out, F.to_json(F.struct(*[F.col(c) for c in cols])))


def _latest(df: DataFrame, key: str, ts: str, tiebreak: str) -> DataFrame:
    return latest_per_key(df, key, ts, tiebreak, [c for c in df.columns if c != key])


def upsert_latest(current: DataFrame | None, updates: DataFrame, key: str, ts: str,
                  tiebreak: str) -> DataFrame:
    return _latest(updates if current is None else current.unionByName(updates), key, ts, tiebreak)


def read_current(spark: SparkSession, base: str, key: str = "id", ts: str = "timestamp",
                 tiebreak: str = "temperature") -> DataFrame | None:
    """The latest row per key; None while nothing was written."""
    try:
        rows = spark.read.parquet(base)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return _latest(rows.drop(_BUCKET, _BATCH), key, ts, tiebreak)


def upsert_into(batch: DataFrame, base: str, key: str, ts: str, tiebreak: str, batch_name: str,
                buckets: int = BUCKETS) -> None:
    """Write ``batch`` under ``batch_name``; the same name again replaces it."""
    rows = _latest(batch, key, ts, tiebreak).withColumns({
        _BUCKET: F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"), _BATCH: F.lit(batch_name)})
    if not batch.isEmpty():
        (rows.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(_BUCKET, _BATCH).parquet(base))


def compact(spark: SparkSession, base: str, to: str, key: str = "id", ts: str = "timestamp",
            tiebreak: str = "temperature", buckets: int = BUCKETS) -> None:
    """Write the table at ``base`` to a new folder ``to`` as one batch; queries
    that are pointed there go on from it."""
    rows = read_current(spark, base, key, ts, tiebreak)
    if rows is not None:
        upsert_into(rows, to, key, ts, tiebreak, "compacted", buckets)


def upsert_writer(base: str, key: str, ts: str, tiebreak: str, query: str | None = None):
    """``foreachBatch`` function: upsert each micro-batch.  Batches are named
    by the streaming query's id, which its checkpoint keeps over restarts, and
    the batch number; ``query`` names them where no streaming query runs."""
    own = query or uuid.uuid4().hex

    def _write(batch: DataFrame, epoch_id: int) -> None:
        running = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert_into(batch, base, key, ts, tiebreak, f"{query or running or own}-{epoch_id}")
    return _write
