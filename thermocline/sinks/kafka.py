"""Kafka sink: rows as CSV-encoded text values keyed by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import to_csv_value
from .files import WRITE_OPTIONS


def to_kafka_records(df: DataFrame, key: str | None, cols: list[str], sep: str = ",",
                     quoted: bool = True) -> DataFrame:
    """``withFormat(new Csv())``: one text value per row, the key column as
    the record key (NULL key = round-robin partition).  Fields that hold the
    separator or a quote are quoted and blanks stay, so a CSV reader
    (``files.READ_OPTIONS``) gets them back, NULL and empty text told apart;
    ``quoted=False`` gives the plain text form of the record instead."""
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    value = (F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in cols]),
                      {**WRITE_OPTIONS, "sep": sep})
             if quoted else to_csv_value(*cols, sep=sep))
    return df.select(k.alias("key"), value.alias("value"))


def kafka_writer(df: DataFrame, bootstrap: str, topic: str, checkpoint: str | None = None, **extra: str):
    """The writer of (key, value) records: a ``DataStreamWriter`` for a
    stream (``checkpoint`` is its checkpointLocation), else a
    ``DataFrameWriter``; call ``start()`` or ``save()``."""
    writer = df.writeStream if df.isStreaming else df.write
    options = kafka_sink_options(bootstrap, topic, **extra)
    if checkpoint:
        options["checkpointLocation"] = checkpoint
    return writer.format("kafka").options(**options)


def kafka_sink_options(bootstrap: str, topic: str, **extra: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic}
    opts.update(extra)
    return opts
