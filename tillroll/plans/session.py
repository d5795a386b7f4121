"""Session settings and the shared folder for materialised layers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillroll", event_log_dir: str | None = None
) -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on).  With
    ``event_log_dir`` the stage and task timings go to Spark's event log there."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Python call-site capture on every Column op dominates plan-building
        # time; it only enriches error messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is made for a local master
    (tests); on a cluster executors could not see it, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = _configured_dir(spark)
        if not d:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def builds_dir(spark: SparkSession) -> str:
    """Where builds are published: a folder that other applications find too, if
    ``spark.checkpoint.dir`` names one (below it each application has its own)."""
    return f"{(_configured_dir(spark) or shared_dir(spark)).rstrip('/')}/tillroll-builds"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as its object."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def run_root(spark: SparkSession, label: str) -> str:
    """A folder for one warehouse build, unique per application and build."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tillroll/{app}/{label}-{uuid.uuid4().hex[:8]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package in any file system that Spark reads."""
    if "/tillroll/" not in path:
        raise ValueError(f"not a folder of this package: {path}")
    fs, p = file_system(spark, path)
    fs.delete(p, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of a query as soon as it has ended, not when the
    driver happens to collect the objects that stand for them.  For steps whose result is
    written: a frame that is run again would make its shuffles anew."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and read it back (cuts lineage;
    later passes read only the columns they need)."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
