"""Session helpers: a local session for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and `bench.py`; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wordloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Small test tables still use every core: windows cost far more than their bytes suggest.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.conf.set("wordloom.scan.partitions", cores if cores.isdigit() else "8")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in `spark.checkpoint.dir`. Only a session on one machine may go without:
    a temporary folder is created and remembered then. On a cluster that would scatter files over
    machine-local disks, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("wordloom.scratch.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share ({master})")
        root = tempfile.mkdtemp(prefix="wordloom-")
        spark.conf.set("wordloom.scratch.dir", root)
    return root


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session, wherever they run."""
    if spark.conf.get("wordloom.shipped", None):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="wordloom-package-"), f"wordloom-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)  # the driver serves it to every executor
    spark.conf.set("wordloom.shipped", "true")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, never reused by another run."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df):
    """Cut the lineage of `df`: written once to the shared folder, then read from there.

    Unlike an RDD checkpoint this computes `df` a single time, and readers see its size.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "checkpoint")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
