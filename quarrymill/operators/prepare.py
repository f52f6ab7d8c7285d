"""A training set from instruction rows: truncation, statistics, format, shuffle, split."""

from __future__ import annotations

import pickle
import random
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.operators.tables import FULL_CHARS, split_train_val
from quarrymill.sources import shared


def prepared(rows: DataFrame, max_tokens: int = 8192, strategy: str = "smart", fmt: str = "alpaca") -> DataFrame:
    """The rows of a format with _meta(type, original_len, extraction_method): inputs of 100 characters or more are cut to the limit."""
    text, method = T.truncated(F.col("input"), T.max_chars(max_tokens), strategy)
    full = F.length("input") >= FULL_CHARS
    meta = F.when(full, F.struct(F.lit("full").alias("type"), F.length("input").alias("original_len"), method.alias("extraction_method")))
    meta = F.coalesce(meta, F.struct(F.lit("partial").alias("type"), F.lit(None).cast("int").alias("original_len"), F.lit(None).cast("string").alias("extraction_method")))
    cut = rows.withColumns({"__cut": F.when(full, text).otherwise(F.col("input")), "_meta": meta}).drop("input").withColumnRenamed("__cut", "input")
    keep = [c for c in cut.columns if c not in ("instruction", "input", "output")]
    return cut.select(*keep, *T.formatted("instruction", "input", "output", fmt))


def truncation_stats(rows: DataFrame, text: Column, cut: Column) -> DataFrame:
    """One row: truncated (got shorter), kept_full, partial (too short for a paper)."""
    full = F.length(text) >= FULL_CHARS
    shorter = F.length(cut) < F.length(text)
    return rows.agg(F.count_if(full & shorter).alias("truncated"), F.count_if(full & ~shorter).alias("kept_full"), F.count_if(~F.coalesce(full, F.lit(False))).alias("partial"))


def split_sets(rows: DataFrame, key: str, ratio: float = 0.1, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validation, both: training rows first) without _meta; both has an order column `set`."""
    cut = split_train_val(rows, key, ratio, seed)
    train, val = (cut.where(F.col("split") == s).drop("split", "_meta") for s in ("train", "val"))
    return train, val, train.withColumn("set", F.lit(0)).unionByName(val.withColumn("set", F.lit(1)))


#: Draws of the generator that a task makes again from a state.
BLOCK = 1 << 20


def _swaps(spark: SparkSession, n: int, seed: int, block: int) -> DataFrame:
    """(i, j): the shuffle of n items swaps i with j, for i from n - 1 down to 1.

    The driver runs the generator and keeps its state at each block; tasks draw the blocks again.
    """
    rng, blocks, top = random.Random(seed), [], n - 1
    while top > 0:
        count = min(block, top)
        blocks.append((top, count, pickle.dumps(rng.getstate())))
        top -= count
        if top > 0:
            for i in range(top + count, top, -1):
                rng._randbelow(i + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = random.Random()
                own.setstate(pickle.loads(row["state"]))
                for lo in range(row["top"], row["top"] - row["n"], -10_000):
                    at = range(lo, max(lo - 10_000, row["top"] - row["n"]), -1)
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([own._randbelow(i + 1) for i in at], pa.int64())], ["i", "j"])

    states = spark.createDataFrame(blocks, "top long, n long, state binary")
    return states.repartition(max(1, len(blocks))).mapInArrow(run, "i bigint, j bigint")


def _roots(ahead: DataFrame) -> DataFrame:
    """(k, root) of pointers (k, root) without cycles: each follows its target's pointer until none has one, by doubling."""
    spark, folder, number = ahead.sparkSession, f"{shared.shared_root(ahead.sparkSession)}/shuffle-{uuid.uuid4().hex}", 0
    while True:
        path = f"{folder}/{number}"
        ahead.write.parquet(path)
        now = spark.read.parquet(path)
        further = now.select(F.col("k").alias("__k"), F.col("root").alias("__next"))
        if now.join(further, F.col("root") == F.col("__k"), "left_semi").isEmpty():
            return now
        ahead = now.join(further, F.col("root") == F.col("__k"), "left").select("k", F.coalesce("__next", "root").alias("root"))
        number += 1


def mersenne_places(spark: SparkSession, n: int, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """(from, shuffled): where each of n items, numbered from 0, stands after a seeded Mersenne Twister shuffle of their list.

    Swap i brings to i what stands at j just before. That came from the least i' > i that also swapped with j (or is j itself),
    and what stood at i' just before its own swap from the least i'' > i' that swapped with i', and so on: pointers that rise,
    whose ends are found by doubling. Nothing of length n is on the driver or in one task.
    """
    if n == 0:
        return spark.createDataFrame([], "`from` long, shuffled long")
    path = f"{shared.shared_root(spark)}/swaps-{uuid.uuid4().hex}"
    _swaps(spark, n, seed, block).write.parquet(path)
    swaps = spark.read.schema("i long, j long").parquet(path)
    roots = _roots(swaps.where("i > j").groupBy(F.col("j").alias("k")).agg(F.min("i").alias("root")))
    # A place swaps with few others: about the logarithm of n.
    later = F.lead("i").over(W.partitionBy("j").orderBy("i"))
    origin = swaps.select(F.col("i").alias("shuffled"), "j", later.alias("later"))
    origin = origin.unionByName(spark.createDataFrame([(0,)], "shuffled long").select("shuffled", F.lit(0).cast("long").alias("j"), F.lit(None).cast("long").alias("later")))
    # The first place has no swap of its own: what stands there came by the last one that swapped with it.
    start = F.when(F.col("shuffled") == 0, F.lit(0)).otherwise(F.coalesce("later", "j")).cast("long")
    follows = F.col("later").isNotNull() | (F.col("shuffled") == 0)
    found = origin.select("shuffled", start.alias("start"), follows.alias("follows"))
    joined = found.join(roots, (F.col("start") == F.col("k")) & F.col("follows"), "left")
    return joined.select(F.coalesce("root", "start").alias("from"), "shuffled")


def mersenne_order(n: int, seed: int = 42) -> list[int]:
    """The order in which a list of n items stands after a seeded Mersenne Twister shuffle."""
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return order


def mersenne_shuffled(rows: DataFrame, position: str, seed: int = 42) -> DataFrame:
    """rows with `shuffled`, their place after that shuffle. position numbers them from 0 without gaps."""
    places = mersenne_places(rows.sparkSession, rows.count(), seed).withColumnRenamed("from", "__from")
    return rows.join(places, F.col(f"`{position}`") == F.col("__from")).drop("__from")
