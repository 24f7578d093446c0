"""Session helpers: a local session for tests and bench, the checkpoint folder and stage tables."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "hoodcast",
                  shuffle_partitions: int = 8, event_log_dir: str | None = None) -> SparkSession:
    """Local session used by tests and the bench. Clusters bring their own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A session in local mode that names none (tests, notebooks) gets a scratch folder of its
    own, removed when the process ends. On a cluster a folder on one machine would not
    be seen by the others, so there the setting is required.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="hoodcast-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (Spark distributes the archive)."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        package = os.path.dirname(os.path.abspath(__file__))
        to = os.path.join(tempfile.mkdtemp(), os.path.basename(package))
        sc.addPyFile(shutil.make_archive(to, "zip", os.path.dirname(package), os.path.basename(package)))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as a parquet table under the shared checkpoint
    folder and return a scan of it.

    Unlike ``Dataset.checkpoint`` (which computes the plan once for the action
    and again to write the checkpoint unless it was cached), the write job
    computes the plan exactly once; later readers scan files that survive
    executor loss. ``drop_stage_tables`` deletes them when a job is done.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_folder(spark: SparkSession) -> str:
    """Where this application's stage tables are."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{spark.sparkContext.applicationId}"


def drop_stage_tables(spark: SparkSession) -> None:
    """Delete the application's stage tables, through Spark's file systems."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(stage_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
