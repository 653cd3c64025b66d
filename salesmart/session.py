"""Spark session defaults and the shared scratch folder for materialized layers.

Every intermediate that is read more than once (staging, dimensions) is written as
Parquet under the cluster's ``spark.checkpoint.dir``; that cuts lineage, survives the
loss of an executor and gives the planner real file sizes for its join choices.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

JIT_FLAG = "-XX:-DontCompileHugeMethods"

# Default session settings: AQE on (partition coalescing and skew-join splitting),
# UTC session time zone so DATE <-> TIMESTAMP casts never depend on the host.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "salesmart") -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` stays ``None`` and the launcher's settings win; locally
    (tests, bench) pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    # Generated code for wide projections (the CSV coercion, the mart) exceeds the JVM's
    # 8000-byte JIT limit and would run interpreted; allow the JIT to compile it. The
    # flag is appended to whatever options the launcher already set.
    launch = SparkConf()
    for key in ("spark.driver.extraJavaOptions", "spark.executor.extraJavaOptions"):
        current = launch.get(key, "") or ""
        if JIT_FLAG not in current:
            builder = builder.config(key, f"{current} {JIT_FLAG}".strip())
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", "16g")
        # A running session can't be given this setting any more, so it is named here.
        if not launch.get("spark.checkpoint.dir", None):
            builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="salesmart-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialized intermediates.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a local
    session may fall back to a fresh folder under the system temp dir; on a cluster a
    machine-local folder would be lost with its executor, so an unset value is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root and not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="salesmart-ckpt-"))
    return (root or context.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/salesmart/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder (with the session's compression unless given) and return a scan of it.

    The returned DataFrame has no lineage back to ``df``; later reads get column
    pruning and filter pushdown, and the planner sees the true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests."""
    return path[5:] if path.startswith("file:") else path


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
