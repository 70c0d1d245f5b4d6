"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library relies on.  AQE re-plans joins
# and coalesces small shuffle partitions at runtime; its skew-join split is
# the fallback for the few joins whose small side is not provably bounded.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Keyed stream state (windows, sessions, applyInPandasWithState) in RocksDB:
# off-heap, spills to local disk, checkpointed incrementally to the query's
# checkpointLocation — the store that holds up with many or large keys.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "thermocline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  rocksdb_state: bool = True) -> SparkSession:
    """A session with this library's settings.  ``master`` and the number of
    shuffle partitions are left to the cluster (``spark-submit``, Spark's
    defaults) unless given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if rocksdb_state:
        conf.update(ROCKSDB_STATE)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Taken from the running context or from ``spark.checkpoint.dir``.  Only a
    single-process session (``local`` or ``local[...]``) without either gets
    a private folder, removed when the interpreter ends (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="thermocline-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: writes ``df`` to the shared checkpoint folder and
    cuts its lineage, so a lost executor does not recompute the upstream
    plan.  Used for the small derived tables (hot keys, segment offsets)
    that later plans broadcast after a size check."""
    checkpoint_dir(df.sparkSession)
    # an eager reliable checkpoint runs its input twice (count, then write)
    # unless the input is persisted; these tables are small
    kept = df.persist()
    try:
        return kept.checkpoint(eager=True)
    finally:
        kept.unpersist()



def materialize_counted(df: DataFrame) -> tuple[DataFrame | None, int]:
    """Count a small derived table and, when it is not empty, checkpoint it
    reliably (from the persisted copy, so its input runs once).  Returns
    ``(None, 0)`` for an empty table: the common "no hot key" case costs a
    single job."""
    checkpoint_dir(df.sparkSession)
    kept = df.persist()
    try:
        n = kept.count()
        if n == 0:
            return None, 0
        return kept.checkpoint(eager=True), n
    finally:
        kept.unpersist()
