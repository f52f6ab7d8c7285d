"""Listing of very many files by the tasks: the driver holds no path.

A level of folders is a table; each task lists its folders through pyarrow's file systems, and the folders that it finds are the
next level. One folder is listed by one task, so what spreads the work is the number of folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import scan as S
from quarrymill.sources import shared

_SCHEMA = "path string, length bigint, modified timestamp, is_folder boolean"
#: Rows that a task gives at once.
_BATCH = 5000


def _opened(path: str):
    from pyarrow import fs

    found, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    # A listed path gets back what stood before it.
    return found, inner, path[: path.index(inner)] if inner in path else ""


def _level(folders: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column("path").to_pylist():
                system, inner, before = _opened(folder)
                found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
                for lo in range(0, len(found), _BATCH):
                    part = found[lo : lo + _BATCH]
                    cols = ([before + f.path for f in part], [f.size for f in part], [f.mtime for f in part], [f.type == fs.FileType.Directory for f in part])
                    types = (pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["path", "length", "modified", "is_folder"])

    return folders.select("path").where("path IS NOT NULL").distinct().repartition("path").mapInArrow(run, _SCHEMA)


def listed(folders: DataFrame, suffix: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, length, modified) of the files below folders(path); of one suffix (any case) where it is given. A folder that isn't there has none.

    As many rounds as the folders are deep; each round's table is written to the shared folder, which cuts the lineage.
    """
    spark = folders.sparkSession
    level, rounds = folders, []
    while True:
        path = f"{shared.shared_root(spark)}/listing-{uuid.uuid4().hex}"
        _level(level).write.parquet(path)
        found = spark.read.schema(_SCHEMA).parquet(path)
        rounds.append(found.where("NOT is_folder"))
        level = found.where("is_folder")
        if not recursive or level.isEmpty():
            break
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return (out if suffix is None else out.where(S.suffix(F.col("path")) == suffix.lower())).drop("is_folder")


def below(spark: SparkSession, *roots: str, suffix: str | None = None) -> DataFrame:
    return listed(spark.createDataFrame([(r.rstrip("/"),) for r in roots], "path string"), suffix)


def figures(folders: DataFrame, source: str) -> DataFrame:
    """(figure_id, source_doc, folder, path, length, number): PNG files of folders(path), numbered by name in their folder from 1."""
    from pyspark.sql import Window as W

    files = listed(folders, "png", recursive=False).withColumn("folder", F.regexp_extract("path", r"\A(.*)/[^/]*\z", 1))
    number = F.row_number().over(W.partitionBy("folder").orderBy("path"))
    return files.select(S.stem(F.col("path")).alias("figure_id"), F.lit(source).alias("source_doc"), "folder", "path", "length", number.alias("number"))
