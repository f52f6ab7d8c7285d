"""The ready join against a batch join, over restarts; the tracker store against the whole log, over any split."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrymill.operators import track
from quarrymill.operators.trackstore import TrackerStore
from quarrymill.streaming import ready

SCHEMA = "paper_id string, ts timestamp, ok boolean"


def put(spark, folder, rows, files=1):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(str(folder))


def streams(spark, tmp_path):
    return [ready.file_stream(spark, str(tmp_path / side), SCHEMA, 1) for side in "lr"]


def test_ready_join_loses_nothing(spark, tmp_path):
    """Partners nine hours and a month apart, in other files and other runs; failed ones; those without a partner."""
    rng, start = random.Random(2), datetime(2024, 1, 1)
    sides = {s: [(f"p{i}", start + timedelta(minutes=rng.choice([0, 7, 540, 43_200])), rng.random() < 0.8) for i in range(120) if i % 10 != k] for s, k in (("l", 3), ("r", 4))}
    for part in range(3):
        for s, rows in sides.items():
            own = [r for r in rows if random.Random(f"{s}{r[0]}").randrange(3) == part]
            put(spark, tmp_path / s, own, 2)
        for _ in range(2):  # a run after nothing came changes nothing
            ready.run_once(ready.ready_pairs(*streams(spark, tmp_path), "paper_id", "ts", "ok"), str(tmp_path / "out"), str(tmp_path / "cp"))
    left, right = (spark.read.parquet(str(tmp_path / s)) for s in "lr")
    got = spark.read.parquet(str(tmp_path / "out"))
    want = left.where("ok").join(right.where("ok").withColumnRenamed("ts", "r_ts").drop("ok"), "paper_id").select("paper_id", F.col("ts").alias("l_at"), F.col("r_ts").alias("r_at"), F.lit(True).alias("matched"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 50
    # Only those without a partner wait.
    waiting = {(r["paper_id"], r["side"]) for r in ready.unmatched(spark, str(tmp_path / "cp"), "paper_id").collect()}
    assert waiting == {(f"p{i}", s) for i in range(120) for s, k, other in (("l", 3, 4), ("r", 4, 3)) if i % 10 == other}
    for s, other in (("l", 3), ("r", 4)):
        put(spark, tmp_path / s, [(f"p{i}", start, True) for i in range(120) if i % 10 == other])
    ready.run_once(ready.ready_pairs(*streams(spark, tmp_path), "paper_id", "ts", "ok"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert ready.unmatched(spark, str(tmp_path / "cp"), "paper_id").count() == 0


def test_a_side_that_comes_again(spark, tmp_path):
    """The last word before the partner's counts; after a match the key starts anew; null keys meet nobody."""
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    put(spark, tmp_path / "l", [("a", at(0), False), ("a", at(1), True), ("b", at(0), True), ("b", at(1), False), ("c", at(0), True), ("c", at(9), True), (None, at(0), True)])
    put(spark, tmp_path / "r", [("a", at(2), True), ("b", at(2), True), ("c", at(5), True), ("c", at(10), True), (None, at(0), True)])
    ready.run_once(ready.ready_pairs(*[ready.file_stream(spark, str(tmp_path / s), SCHEMA, 9) for s in "lr"], "paper_id", "ts", "ok"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(tuple(r)[:3] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", at(1), at(2)), ("c", at(0), at(5)), ("c", at(9), at(10))]
    assert ready.unmatched(spark, str(tmp_path / "cp"), "paper_id").count() == 0


def test_bounded_wait(spark, tmp_path):
    at = datetime(2024, 1, 1)
    put(spark, tmp_path / "l", [("a", at, True), ("b", at, True)])
    put(spark, tmp_path / "r", [("b", at, True)])
    seen, tries = set(), 0
    while len(seen) < 2 and tries < 10:
        tries += 1
        put(spark, tmp_path / "l", [(None, at, True)])  # a batch lets timers fire
        ready.run_once(ready.ready_pairs(*streams(spark, tmp_path), "paper_id", "ts", "ok", expire_seconds=0.5), str(tmp_path / "out"), str(tmp_path / "cp"))
        seen = {(r["paper_id"], r["matched"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert seen == {("a", False), ("b", True)}
    assert ready.unmatched(spark, str(tmp_path / "cp"), "paper_id").count() == 0


LOG = "paper_id string, stage string, success boolean, error string, ts timestamp, n int, section_count int"


@pytest.fixture(scope="module")
def updates():
    rng, start, out = random.Random(4), datetime(2024, 1, 1), []
    for n in range(900):
        out.append((f"p{rng.randrange(60)}", rng.choice([*track.STAGES, "other"]), rng.random() < 0.7, rng.choice([None, "", f"e{n}"]), start + timedelta(seconds=rng.randrange(5000)), n, rng.choice([None, n])))
    return out


def test_store_equals_the_log(spark, tmp_path, updates):
    """Any split into batches, in any order, with replays; deltas are merged on the way."""
    log = spark.createDataFrame(updates, LOG)
    want = sorted(map(tuple, track.status(log, fields=("section_count",), order=("ts", "n")).collect()))
    for split, (batches, most) in enumerate(((1, 16), (7, 2))):
        store = TrackerStore(spark, str(tmp_path / f"s{split}"), fields=("section_count",), order=("ts", "n"), buckets=4, most_deltas=most)
        rng = random.Random(split)
        parts = [[] for _ in range(batches)]
        for u in updates:
            parts[rng.randrange(batches)].append(u)
        for number, own in enumerate(parts):
            batch = spark.createDataFrame(own, LOG)
            store.add(batch, number)
            if number % 3 == 2:
                # A replay, and one seen by a store that was opened anew.
                TrackerStore(spark, str(tmp_path / f"s{split}"), fields=("section_count",), order=("ts", "n"), buckets=99, most_deltas=most).add(batch, number)
        assert sorted(map(tuple, store.status().collect())) == want
        store.compact()
        store.compact()
        assert store._waiting()[1] == [] and len(store._snapshots()) <= 2
        assert sorted(map(tuple, store.status().collect())) == want


def test_store_shuffles_nothing_to_read(spark, tmp_path, updates):
    store = TrackerStore(spark, str(tmp_path / "s"), order=("ts", "n"), buckets=4)
    assert store.status() is None
    log = spark.createDataFrame(updates, LOG)
    for n in range(2):
        store.add(log.where(F.col("n") % 2 == n), n)
        store.compact()
    plan = store.status()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # With a delta that waits, only that is shuffled.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        store.add(log.where("n < 30"), 7)
        plan = store.status()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Bucketed: true") == 1, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    store.add(spark.createDataFrame([(None, "x", True, None, datetime(2024, 1, 1), 1, 1)], LOG), 9)
    assert store.status().count() == log.select("paper_id").distinct().count()


def test_stream_into_store(spark, tmp_path, updates):
    log = spark.createDataFrame(updates, LOG)
    log.repartition(5).write.parquet(str(tmp_path / "u"))
    store = TrackerStore(spark, str(tmp_path / "s"), order=("ts", "n"), buckets=4, most_deltas=2)
    for _ in range(2):
        ready.follow_store(ready.file_stream(spark, str(tmp_path / "u"), LOG, 2), store, str(tmp_path / "cp"))
        assert sorted(map(tuple, store.status().collect())) == sorted(map(tuple, track.status(log, order=("ts", "n")).collect()))
