"""A tracker that is updated batch by batch: a snapshot and the deltas since.

A record's state is the last value of each field with the time that set it, and its first and last time. States merge by
maxima and minima, so merging is associative, commutative and idempotent: batches may come again, and a batch that a snapshot
holds already changes nothing. A batch's states (a row for each record that it touches) are a delta, a folder under its
number; reading merges the last snapshot with the deltas after it, and `compact` writes that as the next snapshot. Work per
batch so grows with the batch, not with the log; snapshots are stored by key (artifacts), so that merging and reading
shuffles the deltas and never the snapshot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators.track import STAGES
from quarrymill.sources import shared
from quarrymill.sources.artifacts import ArtifactStore

#: Deltas that wait before they are merged into a snapshot.
MOST_DELTAS = 16
BUCKETS = 32


def states(log: DataFrame, key: str, stages: tuple[str, ...], fields: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """A row per key of a log(key, stage, success, error, ts, fields...): what was set last, as struct<at, v>."""
    at = F.struct(*(F.col(f"`{c}`") for c in order)).alias("at")
    last = lambda condition, value: F.max(F.when(condition, F.struct(at, value.alias("v"))))
    flags = [last(F.col("stage") == s, F.col("success")).alias(s) for s in stages]
    sets = [last(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`")).alias(c) for c in fields]
    error = last(F.coalesce("error", F.lit("")) != "", F.col("error")).alias("error_message")
    return log.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").cast("string").alias(key)).agg(*flags, error, *sets, F.min("ts").alias("started_at"), F.max("ts").alias("last_updated"))


def merged(parts: list[DataFrame], key: str, buckets: int) -> DataFrame:
    """States of several parts as one row per key, by one shuffle into as many buckets as a snapshot has."""
    rows = reduce(DataFrame.unionByName, parts).repartition(buckets, F.col(f"`{key}`"))
    lasts = [F.max(f"`{c}`").alias(c) for c in rows.columns if c not in (key, "started_at")]
    return rows.groupBy(key).agg(*lasts, F.min("started_at").alias("started_at")).select(rows.columns)


def updated(snapshot: DataFrame, news: DataFrame, key: str) -> DataFrame:
    """A snapshot with the states of news (a row per key each): where the snapshot is stored by key, only news is shuffled."""
    renamed = news.select([F.col(f"`{c}`").alias(f"__{c}") for c in news.columns])
    both = snapshot.join(renamed, F.col(f"`{key}`") == F.col(f"`__{key}`"), "full_outer")
    pick = lambda c: F.coalesce(f"`{c}`", f"`__{c}`") if c == key else F.least(f"`{c}`", f"`__{c}`") if c == "started_at" else F.greatest(f"`{c}`", f"`__{c}`")
    return both.select([pick(c).alias(c) for c in snapshot.columns])


class TrackerStore:
    """The state of all records under a folder. key: stages, error and `fields` may be set; `order` tells updates of one time apart."""

    def __init__(self, spark: SparkSession, path: str, key: str = "paper_id", stages: tuple[str, ...] = STAGES, fields: tuple[str, ...] = (), order: tuple[str, ...] = ("ts",), buckets: int = BUCKETS, most_deltas: int = MOST_DELTAS):
        self.spark, self.key, self.stages, self.fields, self.order, self.most = spark, key, tuple(stages), tuple(fields), tuple(order), most_deltas
        self.tables, self.deltas = ArtifactStore(spark, path, key, buckets), f"{path.rstrip('/')}/deltas"

    def clear(self) -> None:
        """Forget everything."""
        for name in self.tables.names():
            self.tables.drop(name)
        shared.delete(self.spark, self.deltas)

    def _snapshots(self) -> list[int]:
        """Of those whose writer has ended."""
        return sorted(int(n.removeprefix("snapshot_")) for n in self.tables.names() if n.startswith("snapshot_") and shared.exists(self.spark, f"{self.tables.folder(n)}/_SUCCESS"))

    def _waiting(self) -> tuple[int | None, list[int]]:
        """(the last snapshot, the deltas after it)."""
        upto = max(self._snapshots(), default=None)
        return upto, [n for n in map(int, shared.complete(self.spark, self.deltas)) if upto is None or n > upto]

    def add(self, batch: DataFrame, number: int) -> None:
        """Take a batch of updates. A batch that comes again under its number is taken once; numbers must grow, gaps may be."""
        upto, waiting = self._waiting()
        if upto is not None and number <= upto:
            return
        states(batch, self.key, self.stages, self.fields, self.order).write.mode("overwrite").parquet(f"{self.deltas}/{number:012d}")
        if len({*waiting, number}) > self.most:
            self.compact()

    def compact(self) -> None:
        """Merge the waiting deltas into the next snapshot; the last snapshot stays for those who read it, older ones go."""
        _, waiting = self._waiting()
        if not waiting:
            return
        self.tables.write(f"snapshot_{waiting[-1]:012d}", self._states())
        for n in self._snapshots()[:-2]:
            self.tables.drop(f"snapshot_{n:012d}")
        # Also deltas that an earlier run left behind when it ended.
        for name in shared.names(self.spark, self.deltas):
            if int(name) <= waiting[-1]:
                shared.delete(self.spark, f"{self.deltas}/{name}")

    def _states(self) -> DataFrame | None:
        upto, waiting = self._waiting()
        snapshot = None if upto is None else self.tables.read(f"snapshot_{upto:012d}")
        if not waiting:
            return snapshot
        news = merged([self.spark.read.parquet(f"{self.deltas}/{n:012d}") for n in waiting], self.key, self.tables.buckets)
        return news if snapshot is None else updated(snapshot, news, self.key)

    def status(self) -> DataFrame | None:
        """A row per record as track.status gives it for the whole log; none before the first batch."""
        found = self._states()
        if found is None:
            return None
        value = lambda c: F.col(f"`{c}`")["v"]
        flags = [F.coalesce(value(s), F.lit(False)).alias(s) for s in self.stages]
        return found.select(self.key, *flags, value("error_message").alias("error_message"), *(value(c).alias(c) for c in self.fields), "started_at", "last_updated")
