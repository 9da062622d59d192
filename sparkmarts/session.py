"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sparkmarts") -> SparkSession:
    """Local session for tests and the benchmark. On a cluster, build the
    session with the cluster's own settings and only add the AQE options."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARKMARTS_DRIVER_MEMORY", "8g"))
    )
    for k, v in recommended_conf().items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def recommended_conf() -> dict[str, str]:
    """Settings this library is designed for (all standard Spark options).

    AQE re-plans joins at runtime (broadcast when a side turns out small,
    skew-join splitting of hot keys), coalesces small shuffle partitions and
    lets dynamic partition overwrite replace only the partitions an
    incremental load touches."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        # on a cluster set spark.sql.shuffle.partitions to about
        # (largest shuffle / 128MB); AQE merges small partitions but keeps at
        # least the cluster's parallelism (parallelismFirst, the default)
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
    }


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and checkpoints: the cluster's
    ``spark.checkpoint.dir``. Only a local session, whose executors share the
    driver's disk, may do without it and then gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparkmarts-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


@contextmanager
def shuffles_cleared(spark: SparkSession):
    """The shuffle files of a job go at its end, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under this application's part of the work folder."""
    return f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _own_scratch(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/sparkmarts/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application: at its end, as
    DataFrames that were returned may still read them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
