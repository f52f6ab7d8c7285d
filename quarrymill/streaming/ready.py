"""Records that become ready on two streams, and a tracker that follows a stream of updates."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from quarrymill.operators.trackstore import TrackerStore

SIDES = ("l", "r")
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema: str, files_a_batch: int = 10) -> DataFrame:
    """A stream of parquet files, bounded in how many a batch takes: what waits stays in the folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


class _Meeting(StatefulProcessor):
    """For each key the last word of either side, until the other's comes."""

    def __init__(self, kind: str, expire_seconds: float | None):
        self.kind, self.expire = kind, expire_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waits = {side: handle.getValueState(side, f"at {self.kind}, ok boolean") for side in SIDES}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # A key's rows of one batch; a batch is bounded by its files.
        for r in sorted(rows, key=lambda r: (r["at"] is not None, r["at"], r["side"])):
            mine, other = self.waits[r["side"]], self.waits[SIDES[r["side"] == SIDES[0]]]
            if not other.exists():
                mine.update((r["at"], r["ok"]))
                if self.expire is not None:
                    self._forget_timers()
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.expire * 1000))
                continue
            at, ok = other.get()
            other.clear()
            mine.clear()
            self._forget_timers()
            if ok and r["ok"]:
                pair = {r["side"]: r["at"], SIDES[r["side"] == SIDES[0]]: at}
                yield Row(key=key[0], l_at=pair["l"], r_at=pair["r"], matched=True)

    def _forget_timers(self) -> None:
        if self.expire is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Without its partner in time: a row that says so, and no state."""
        found = {}
        for side, state in self.waits.items():
            if state.exists():
                found[side] = state.get()[0]
                state.clear()
        yield Row(key=key[0], l_at=found.get("l"), r_at=found.get("r"), matched=False)

    def close(self) -> None:
        pass


def ready_pairs(left: DataFrame, right: DataFrame, key: str, ts: str, success: str | None = None, expire_seconds: float | None = None) -> DataFrame:
    """A stream of (key, l_at, r_at, matched): keys that both streams finished, with success where `success` names a column.

    A side that comes first waits as long as it takes: one value a key and side, the last one if it comes again, cleared when the
    partner comes (also where one of them failed). So the state holds what waits and nothing else. expire_seconds bounds it:
    a key that waits longer (in processing time) is given up with a row whose `matched` is false. Null keys meet nobody.
    Start it with `run_once` or another query under `state_store(spark)`; `unmatched` tells who still waits.
    """
    kind = left.schema[ts].dataType.simpleString()
    sides = []
    for rows, side in zip((left, right), SIDES, strict=True):
        ok = F.coalesce(F.col(f"`{success}`"), F.lit(False)) if success else F.lit(True)
        sides.append(rows.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("key"), F.col(f"`{ts}`").alias("at"), ok.alias("ok"), F.lit(side).alias("side")))
    out = f"key {left.schema[key].dataType.simpleString()}, l_at {kind}, r_at {kind}, matched boolean"
    met = sides[0].unionByName(sides[1]).groupBy("key").transformWithState(_Meeting(kind, expire_seconds), out, "Append", "None" if expire_seconds is None else "ProcessingTime")
    return met.withColumnRenamed("key", key)


@contextmanager
def state_store(spark: SparkSession):
    """Streams that start inside keep their state in RocksDB, which keyed state of any kind needs: it lives on disk, in the checkpoint.

    Batches without rows are left out, which timers of the processing time would ask for without end: timers fire with the next rows.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def unmatched(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """(key, side, at, ok) of what waits in the state of a `ready_pairs` query as of its last batch: read from the checkpoint, as a table."""
    with state_store(spark):
        sides = [spark.read.format("statestore").option("stateVarName", side).load(checkpoint).select(F.col("key.key").alias(key), F.lit(side).alias("side"), "value.at", "value.ok") for side in SIDES]
    return sides[0].unionByName(sides[1])


def run_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take all that is there, then end; a later run goes on where the checkpoint says."""
    with state_store(stream.sparkSession):
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def follow_store(updates: DataFrame, store: TrackerStore, checkpoint: str) -> StreamingQuery:
    """Merge a stream of tracker updates into a store, batch by batch; a batch that is run again counts once."""
    query = updates.writeStream.foreachBatch(lambda batch, number: store.add(batch, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def follow_tracker(updates: DataFrame, log_path: str, checkpoint: str, key: str = "paper_id") -> StreamingQuery:
    """Append a stream of tracker updates to a log, a folder for each batch: a batch that is run again replaces its own."""

    def add(batch: DataFrame, number: int) -> None:
        batch.where(F.col(key).isNotNull()).write.mode("overwrite").parquet(f"{log_path}/batch={number}")

    query = updates.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class Progress(StreamingQueryListener):
    """Calls back with (rows done so far, rows of the batch)."""

    def __init__(self, callback: Callable[[int, int], None]):
        self.callback, self.done = callback, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.done += event.progress.numInputRows
        self.callback(self.done, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
