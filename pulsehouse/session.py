"""Session construction and the shared scratch area.

Scratch data (stream checkpoints, merge snapshots, landing zones built by the
stand-in plans) always lives under the folder the cluster names in
``spark.checkpoint.dir``. Where that is unset, a session on one machine
(``local`` master) gets a temporary folder, registered as its checkpoint
directory; on a cluster it is an error, as executors would each write to a
disk of their own.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed session settings the library relies on.
# - UTC: epoch arithmetic and the DuckDB oracle agree on wall-clock time.
# - AQE with skew-join splitting and partition coalescing: runtime re-planning
#   of joins (sort-merge -> broadcast when a side turns out small) and of
#   skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: no broadcast from static (file-size)
    # estimates; AQE converts a join to broadcast once a shuffle stage has
    # materialised and its real size is known.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

_fallback_root: str | None = None


def build_session(master: str | None = None, app: str = "pulsehouse",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
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
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; if that is unset, a
    temporary folder for a local master and an error for any other."""
    global _fallback_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _fallback_root is None:
        _fallback_root = tempfile.mkdtemp(prefix="pulsehouse-ckpt-")
        spark.sparkContext.setCheckpointDir(_fallback_root)
    return _fallback_root


def release(spark: SparkSession) -> None:
    """Free the disk that finished jobs hold. Shuffle files go once the driver's garbage
    collector finds that nothing refers to them; a driver that has little to do does not
    run it for long, while the executors' disks fill up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Meanwhile a query's shuffle files go when it ends, those of streams begun here too."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/pulsehouse/{name}/{uuid.uuid4().hex}"

