"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # The newest date of a table laid out by day comes from its folders; every folder written here holds rows.
    "spark.sql.optimizer.metadataOnly": "true",
    # Recording a call site for every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("searchlift")
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder, deleted when the driver ends.

    Where the folder is unset, a local session (tests, checks) sets one of its own; a cluster's must name it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="searchlift-")
        spark.conf.set("spark.checkpoint.dir", shared)
        _delete_at_end(spark, shared)
    path = f"{shared.rstrip('/')}/searchlift-{label}-{uuid.uuid4().hex}"
    _delete_at_end(spark, path)
    return path


def _delete_at_end(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
