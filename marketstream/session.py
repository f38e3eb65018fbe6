"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows per chunk for the running-aggregate scans (operators/scan.py).  A hot key is
# split into chunks of at most this many rows, so no task ever holds one whole key.
CHUNK_ROWS_CONF = "marketstream.scan.chunkRows"
DEFAULT_CHUNK_ROWS = 1 << 20


def build_session(cpus: int | str = "*", app: str = "marketstream",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench.  On a cluster, use the cluster's
    session and only make sure the settings in ``recommended_conf`` are applied."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = recommended_conf()
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (8 if cpus == "*" else cpus))
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("MS_DRIVER_MEMORY", "16g"),
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def recommended_conf() -> dict[str, str]:
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoints of scans go once nothing refers to them (a live job makes them for ever)
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # keyed state of the de-duplicating trade stream
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one when it is
    unset and the session is local (tests, bench).  A cluster without it is an error:
    a machine-local temporary folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
            "spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            named = tempfile.mkdtemp(prefix="marketstream-")
        sc.setCheckpointDir(named)
        root = sc.getCheckpointDir()
    return os.path.join(root, *parts) if parts else root


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint) and go on
    from there: later plans stay small, and a lost executor does not replay the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def few_files(df: DataFrame) -> DataFrame:
    """``df`` in as many parts at most as there are cores: a micro-batch is a union of many
    small ones, each of which would be a task and a file."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder of the shared directory (one per run)."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this engine wrote and no longer reads, wherever it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else default
