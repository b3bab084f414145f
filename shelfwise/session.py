"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

import os
import shlex
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants, local or cluster. A cluster launcher
# may override any of them; we only fill in what is not set already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a sort-merge join into a broadcast join at runtime only when
    # the measured shuffle output of one side is below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Coalesce small shuffle partitions, but not below 64 KB: CPU-heavy stages
    # (string rendering, hashing) otherwise end up on two or three cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "shelfwise",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE, skew-join handling and UTC time."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = _launcher_settings()
    conf = {k: v for k, v in _DEFAULTS.items() if k not in given}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _launcher_settings() -> set[str]:
    """Names of the settings that spark-submit or the environment gave."""
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # started by spark-submit: its settings are in the JVM
        SparkContext._ensure_initialized()
        return {k for k, _ in SparkConf().getAll()}
    words = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    return {b.split("=", 1)[0] for a, b in zip(words, words[1:]) if a in ("--conf", "-c")}


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared file system. Only when it is
    unset (local runs and tests) do we pick a scratch folder ourselves.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, tuple[int, str | None]] = {}  # by application: writes under way, the setting before the first
_freeing_lock = threading.Lock()


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside give up their shuffle files as they end (several threads may be inside at once).

    Without it they stay until the driver happens to collect its garbage.
    """
    key = f"{spark.sparkContext.applicationId} {spark._jsparkSession.hashCode()}"
    with _freeing_lock:
        inside, before = _freeing.get(key) or (0, spark.conf.get(_FREE, None))
        _freeing[key] = (inside + 1, before)
        spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            inside, before = _freeing.pop(key)
            if inside > 1:
                _freeing[key] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(_FREE)
            else:
                spark.conf.set(_FREE, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` once as a parquet table in the shared
    checkpoint folder and continue from the stored files.

    Used after expensive stages (model scoring, stage outputs read by several
    later stages). Unlike ``DataFrame.checkpoint`` the plan runs exactly once,
    the files are columnar, and later filters and projections are pushed into
    the scan. A lost executor never forces the upstream to run again. The
    write's shuffle files go when it ends: what is stored stands for them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/shelfwise-{name}-{uuid.uuid4().hex}"
    with _shuffles_freed(spark):
        df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
