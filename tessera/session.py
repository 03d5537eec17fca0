"""Spark session helpers.

The library never owns the cluster configuration: it reads what the session
already has and only fills gaps (local tests).  Settings that matter at scale:

* AQE on, with runtime broadcast conversion bounded by
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` -- the size check for every
  join against a fitted statistics table happens at runtime on the real,
  materialised size; above the bound the join stays a sort-merge join.
* AQE skew-join splitting for hot keys.
* ``spark.checkpoint.dir`` must point at shared storage on a cluster; we only
  set a scratch directory when nothing is configured (tests, local runs).
"""
from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Conservative runtime defaults, applied only when the session has no value.
_RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tessera") -> SparkSession:
    """Create (or fetch) a session with the settings the library expects."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # local mode: the driver JVM is the executor; 1g default thrashes GC
               .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_runtime_conf(spark)
    return spark


def ensure_runtime_conf(spark: SparkSession) -> None:
    """Fill runtime SQL settings the caller left unset (never overrides)."""
    for key, value in _RUNTIME_DEFAULTS.items():
        try:
            current = spark.conf.get(key, None)
        except Exception:  # pragma: no cover - conf API differences
            current = None
        if current is None:
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is.  Only when it is unset (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


@contextlib.contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """For work over wide rows: a stage whose code has a method that the JVM leaves
    uncompiled (over 8,000 bytes) runs its operators one by one, whose code is in
    short methods.  A session that has set the limit keeps it."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) not in (None, "65535"):
        yield
        return
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.unset(key)


def cut_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared checkpoint folder and read it back: its plan
    becomes one scan.  Gives the folder too; it goes when the application ends,
    or with :func:`drop_table`."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, name)}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    fs, jpath = _hadoop_path(spark, path)
    fs.deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop_path(spark, path)
    fs.delete(jpath, True)


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name)
