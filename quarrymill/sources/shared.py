"""Folders that the driver and all executors share, by Hadoop's file systems: any scheme that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession

_UNSET = "file:///tmp/checkpoints/quarrymill"


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where it is unset and Spark runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return (root or _UNSET).rstrip("/")


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder; storage that can't be asked raises."""
    found, system = _path(spark, path)
    return bool(system.exists(found))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none where there is no folder. For folders of versions and batches, which are few."""
    found, system = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(found)) if system.exists(found) else []


def complete(spark: SparkSession, path: str) -> list[str]:
    """The names whose writer has ended."""
    return [n for n in names(spark, path) if exists(spark, f"{path}/{n}/_SUCCESS")]


def delete(spark: SparkSession, path: str) -> None:
    found, system = _path(spark, path)
    system.delete(found, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    a, system = _path(spark, source)
    if not system.rename(a, _path(spark, target)[0]):
        raise OSError(f"{source} could not be renamed to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the driver's own, as a manifest; replaced as a whole."""
    found, system = _path(spark, path)
    out = system.create(found, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
