"""Session defaults and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", name: str = "tablewright") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured is None:
        current = sc.getCheckpointDir()
        if current is not None:
            return current
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tablewright-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def reachable(spark: SparkSession, path: str) -> str:
    """``path``, if tasks that open it themselves find the same files everywhere.

    Off a local master a path without a scheme, or with `file`, is each executor's own disk, unless it
    lies in the shared folder.
    """
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return path
    plain = path.removeprefix("file://")
    if "://" not in plain:
        shared = shared_folder(spark)
        if not plain.startswith(shared.removeprefix("file://").rstrip("/") + "/"):
            raise ValueError(f"{path} is on each executor's own disk; name a file system that all of them reach")
    return path


def durable(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably, so that positions taken from it survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
