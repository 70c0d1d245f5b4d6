"""The driver's parquet tables and the reading view over ``events``."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import epoch_micros, epoch_seconds

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events(event_id, ts TIMESTAMP_NTZ, user_id, event_type, value, props)``:
    the sensor stream — user_id is the key, ts the event time, value the
    reading."""
    return load(spark, sf_dir, "events")


def with_micros(df: DataFrame, ts: str = "ts", out: str = "_t") -> DataFrame:
    return df.withColumn(out, epoch_micros(ts))


def as_readings(ev: DataFrame) -> DataFrame:
    """events → ``(id STRING, timestamp BIGINT epoch seconds, temperature)``."""
    return ev.select(F.col("user_id").cast("string").alias("id"),
                     epoch_seconds("ts").alias("timestamp"),
                     F.col("value").alias("temperature"))
