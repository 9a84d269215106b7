"""Session helpers: configuration, time zone guard and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every operator relies on. ANSI mode is Spark 4's default and is kept:
# the scalar functions are written so that they never raise under it.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "marketlake",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the engine expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Time stamps are stored as UTC wall clock (TIMESTAMP_NTZ); the casts
    that convert an instant into it use the session time zone, so it must be UTC."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"marketlake needs spark.sql.session.timeZone=UTC, found {tz!r}")


@contextmanager
def utc_session(spark: SparkSession):
    """Build plans with the session time zone set to UTC, then restore the caller's.

    Spark resolves the time zone of every time-zone-aware expression (casts,
    ``date_format``, ``from_json``...) when a DataFrame is analyzed, which
    PySpark does eagerly; a DataFrame built inside this block therefore keeps
    UTC semantics wherever it is executed later.
    """
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    if before in ("UTC", "Etc/UTC"):
        yield
        return
    spark.conf.set(key, "UTC")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder under the shared checkpoint directory of the cluster.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that
    setting is read from the session and only set here when it is unset
    (local runs and tests), never replaced.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        # Unset: local run or test. Only then pick a folder of our own; the executors
        # of a cluster would not see it.
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="marketlake-ckpt-"))
        base = sc.getCheckpointDir()
    base = base.rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    p = _hadoop_path(spark, path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(p)  # wherever a path without a scheme lies
    return path


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, on whatever file system it lies."""
    p = _hadoop_path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
