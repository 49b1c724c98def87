"""Session helpers and the shared work folder.

Intermediate files (checkpoints, fixture files, model tables, stream
outputs) go under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent *and* the master is local (tests, the
bench) do we create our own folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "titlecorpus", initial_partitions: int = 8192,
                advisory_partition_bytes: str = "256m") -> SparkSession:
    """Session with AQE on.

    ``shuffle_partitions`` pins the shuffle width (tests, local bench).
    Without it, shuffles start ``initial_partitions`` wide and AQE coalesces
    them to about ``advisory_partition_bytes`` each, so the one id shuffle of
    a 100 TB corpus does not produce partitions larger than executor memory,
    and a small input does not produce thousands of empty tasks.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_bytes)
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                 str(initial_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    if shuffle_partitions is None and spark.sparkContext.master.startswith("local"):
        # One machine: as many shuffle partitions as cores.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                       str(spark.sparkContext.defaultParallelism))
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, once: they need
    not have it installed, nor on their path. A package that was itself shipped
    as a zip is there already."""
    sc = spark.sparkContext
    here = os.path.dirname(os.path.abspath(__file__))
    if sc.applicationId in _SHIPPED or not os.path.isdir(here):
        return
    _SHIPPED.add(sc.applicationId)
    # Spark copies the driver's file to every executor.
    path = os.path.join(tempfile.mkdtemp(prefix="titlecorpus-"), "titlecorpus.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder of this application (set up on first use)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    # The session's view of the setting (falls back to the SparkConf).
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="titlecorpus-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder every executor can reach")
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
