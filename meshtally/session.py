"""Session settings shared by tests, bench and jobs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "meshtally", cores: int | str = "*", partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session that names none (a test) gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="spark-meshtally-")
    return _LOCAL["dir"]


def run_dir(spark: SparkSession) -> str:
    """This run's folder below the shared one; it goes when the driver ends."""
    path = os.path.join(shared_dir(spark), f"run-{spark.sparkContext.applicationId}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)  # only what exists can be marked
    files.deleteOnExit(folder)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Store a frame in the shared folder and continue from the stored table.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and the
    next plan starts from a table of known size with prunable columns. The table lasts as
    long as the driver.
    """
    path = os.path.join(run_dir(df.sparkSession), f"settled-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
