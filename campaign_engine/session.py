"""Session helpers: a tuned local session for tests and benches, and the shared
scratch / checkpoint location every lineage cut goes through."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # long sessions run thousands of small jobs: keep the status store small
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "10000",
}

_local_scratch: dict[str, str] = {}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "campaign_engine", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared filesystem the
    cluster names). Only when that is unset on a local master -- tests -- a
    private temp folder is created once per process; elsewhere it is an error,
    because executors would write to disks of their own.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        root = conf_dir
    else:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        key = "local"
        if key not in _local_scratch:
            _local_scratch[key] = tempfile.mkdtemp(prefix="ce-scratch-", dir="/tmp")
        root = _local_scratch[key]
    try:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(os.path.join(root, "checkpoints"))
    except Exception:  # Spark Connect has no SparkContext; df.checkpoint still works
        pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the scratch root."""
    return os.path.join(scratch_root(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of an intermediate *aggregate* result (one row per group:
    medians, boundaries, bracket states) by writing it to the shared folder.
    Read back, its true file size is known to the planner, which then decides
    on a broadcast by that size; nothing comes through the driver."""
    return materialize(df, "settled")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a large intermediate that several plans reuse once, as Parquet in
    the shared scratch folder, and continue from the written table (one
    computation, a lineage cut that survives executor loss)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly to as many tasks as a shuffle has. For narrow rows before work that is large per row:
    by bytes they come as few files or partitions, and one task would do most of it."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers of every executor
    (``addPyFile`` of a zip, once per application). Needed before any pandas
    UDF / applyInPandas whose function lives in the package."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # Spark Connect: use spark.addArtifacts instead
        return
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="ce-pkg-")  # driver-side artifact; Spark distributes it
    zpath = os.path.join(out_dir, "campaign_engine.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
