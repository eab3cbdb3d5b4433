"""Session construction and the shared scratch folder.

Streaming checkpoints, file topics and written intermediate tables all live
under the folder named by ``spark.checkpoint.dir``.  On a cluster that folder
must be shared storage (HDFS, S3, ABFS ...); it is read from the session and
only created here when it is unset *and* Spark runs in local mode (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stateful streaming: RocksDB keeps large window state off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit = append a changelog, snapshots in the background: less upload
    # per micro-batch on remote checkpoint storage
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "skyrisk",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared scratch root: ``spark.checkpoint.dir`` of this session.

    If it is unset and Spark runs locally (tests, benchmarks) a private folder
    is created and registered as the checkpoint dir.  On a cluster an unset
    value is an error: a machine-local folder would not survive the loss of
    an executor or be visible to the others.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a random sub-folder; use its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not (sc.master or "").startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) so checkpoints and scratch tables survive "
            "executor loss")
    root = tempfile.mkdtemp(prefix="skyrisk-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/skyrisk/{name}-{uuid.uuid4().hex[:12]}"
