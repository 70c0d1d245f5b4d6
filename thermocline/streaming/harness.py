"""Replay fixtures as a file stream and run a query to completion
(``availableNow``): the stream-equals-batch test harness."""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession


def write_batches(base_dir: str, batches: list[list[str]], suffix: str = ".txt") -> str:
    """One text file per micro-batch, modification times strictly increasing,
    so a file source with ``maxFilesPerTrigger=1`` reads them in order."""
    os.makedirs(base_dir, exist_ok=True)
    now = time.time() - 3600
    for i, lines in enumerate(batches):
        p = os.path.join(base_dir, f"part-{i:04d}{suffix}")
        with open(p, "w") as f:
            f.write("\n".join(lines) + ("\n" if lines else ""))
        os.utime(p, (now + i * 10, now + i * 10))
    return base_dir


def text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def run_to_table(df: DataFrame, name: str, checkpoint: str, output_mode: str = "append",
                 timeout_s: int = 300):
    """Run a streaming DataFrame over everything available into a memory
    table ``name``; returns the collected rows."""
    q = (df.writeStream.format("memory").queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish")
    if q.exception():
        raise q.exception()
    return df.sparkSession.table(name).collect()


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, output_mode: str = "append",
                      timeout_s: int = 300) -> None:
    q = (df.writeStream.foreachBatch(fn).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception():
        raise q.exception()
