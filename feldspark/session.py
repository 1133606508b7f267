"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_SCRATCH: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A small session for tests and the bench. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feldspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FELDSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (tests, a laptop) a temporary folder is made, and then
    kept in the session so that every later call sees the same one.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if not root:
        root = getattr(context, "_feldspark_scratch", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="feldspark-")
        context._feldspark_scratch = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its file system."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; whether it was ours to write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        stream = files.create(target, False)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException" or files.exists(target):
            return False
        raise
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return True


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, none if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables this process has written; call it when their results are used."""
    while _SCRATCH:
        remove_path(spark, _SCRATCH.pop())


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read of the written files and
    never a second run of the plan behind them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
