"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own.

    The method limit makes Spark split long generated methods that HotSpot would not compile.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("estate")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, readable by all executors.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="estate-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return worker_path(spark, folder)


def worker_path(spark: SparkSession, folder: str) -> str:
    """The folder (made if need be) by a name under which workers reach it without Spark's own file systems.

    A path without a scheme lies on the cluster's default file system, and a viewfs path on what its mount
    table names; only the driver's Hadoop settings know either. A folder on this machine's disk keeps
    its bare path in a local session.
    """
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    path = paths(folder)
    filesystem = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    filesystem.mkdirs(path)
    found = filesystem.resolvePath(path).toString()
    if found.startswith("viewfs:"):
        # The root of a mount table with a fallback is no place of its own, but folders below it are.
        path = paths(path, "estate")
        filesystem.mkdirs(path)
        found = filesystem.resolvePath(path).toString()
    bare = "://" not in folder and spark.sparkContext.master.startswith("local")
    return found.removeprefix("file:") if bare else found


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
