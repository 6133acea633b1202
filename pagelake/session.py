"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs count on. Pages are heavy rows, so scan splits and Arrow
# batches are bounded by bytes and not by row counts alone.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
    STATE_STORE: ROCKSDB,
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`DEFAULTS`; ``conf`` entries (dotted names) win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: on disk, so it may outgrow memory. The
    retry counter cannot run on any other store.
    """
    spark.conf.set(STATE_STORE, ROCKSDB)


_local_root: str | None = None


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``.

    A local session without that setting gets a folder of this machine; any
    other session must have the setting, as executors cannot share local disks.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="pagelake-")
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: computed once, and no lineage behind it."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
