"""JDBC sink with a flush size, batch and streaming (foreachBatch)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 5000,
               column_types: str | None = None, mode: str = "append",
               properties: dict[str, str] | None = None) -> None:
    """``connector.type=jdbc, connector.write.flush.max-rows=n``: rows are
    inserted in JDBC batches of ``batchsize``, each partition on its own
    connection.  ``column_types`` sets DDL types when Spark creates the table
    (e.g. ``"id VARCHAR(20)"``)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", str(batchsize)).mode(mode)
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def jdbc_batch_writer(url: str, table: str, batchsize: int = 5000, column_types: str | None = None,
                      properties: dict[str, str] | None = None, connections: int = 8):
    """A ``foreachBatch`` function appending each micro-batch over at most
    ``connections`` connections; ``properties`` (user, password, driver, ...)
    as for :func:`write_jdbc`."""
    def _write(batch: DataFrame, epoch_id: int) -> None:
        write_jdbc(batch, url, table, batchsize, column_types,
                   properties={"numPartitions": str(connections), **(properties or {})})
    return _write
