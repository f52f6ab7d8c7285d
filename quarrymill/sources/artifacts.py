"""Artifacts stored by key: tables of one root that are bucketed and sorted by one key alike.

Parsed papers, poster results, layouts and matches are all joined by the paper's id. Stored here, each is shuffled once, when
it is written; later joins and aggregations by the key read buckets side by side and shuffle only what is not stored (as the
manifest). The number of buckets is a root's, so that all its tables fit together; it stands in the folders' names, so that a
later session finds it there.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.sources import shared

#: About one bucket for each 128 MB of the largest table is a good number.
BUCKETS = 64
_FOLDER = re.compile(r"(\w+)-by-(\w+)-(\d+)")


class ArtifactStore:
    """Bucketed tables below a root folder. Keys are stored as text, rows with a null key are left out (no join finds them)."""

    def __init__(self, spark: SparkSession, root: str, key: str = "paper_id", buckets: int = BUCKETS):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        kept = {(m[2], int(m[3])) for m in map(_FOLDER.fullmatch, shared.names(spark, self.root)) if m}
        if len(kept) > 1 or any(k != key for k, _ in kept):
            raise ValueError(f"{root} is stored by {sorted(kept)}")
        self.buckets = next((n for _, n in kept), buckets)

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}-by-{self.key}-{self.buckets}"

    def table(self, name: str) -> str:
        """The name in the session's catalog; that of another root differs."""
        return f"artifacts_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_{name}"

    def names(self) -> list[str]:
        return [m[1] for m in map(_FOLDER.fullmatch, shared.names(self.spark, self.root)) if m]

    def write(self, name: str, rows: DataFrame, append: bool = False) -> None:
        """Replace the table, or add rows to it: of a key's rows the reader takes the last (assemble.last_of)."""
        if not re.fullmatch(r"\w+", name):
            raise ValueError("a table's name has letters, digits and _")
        if append and name in self.names():
            self._known(name)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}")
        keyed = rows.withColumn(self.key, F.col(f"`{self.key}`").cast("string")).where(F.col(f"`{self.key}`").isNotNull())
        # One file a bucket: rows are dealt by the key as buckets are.
        dealt = keyed.repartition(self.buckets, self.key)
        dealt.write.bucketBy(self.buckets, self.key).sortBy(self.key).mode("append" if append else "overwrite").option("path", self.folder(name)).saveAsTable(self.table(name))

    def _known(self, name: str) -> None:
        if self.spark.catalog.tableExists(self.table(name)):
            return
        schema = self.spark.read.parquet(self.folder(name)).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {self.table(name)} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.folder(name)}'")

    def read(self, name: str) -> DataFrame:
        if name not in self.names():
            raise KeyError(f"{self.root} has no table {name}")
        self._known(name)
        return self.spark.table(self.table(name))

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}")
        shared.delete(self.spark, self.folder(name))
