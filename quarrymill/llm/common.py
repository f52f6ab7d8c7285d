"""What the operators share: words, scratch tables, bounded batches, joins that no common key makes hot, ranks."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A word: a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: bytes.split() cuts at the same six characters as WORD.
SUB_BATCH_BYTES = 4 << 20
_UNSET = "file:///tmp/checkpoints/quarrymill"
#: A side of at most so many rows is broadcast; beyond it the other side's keys are salted SALTS ways.
BROADCAST_ROWS = 50_000
SALTS = 16
#: Bits of the bitmap that `parted` broadcasts: 4 MB at most.
SIEVE_BITS = 1 << 25
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the scopes that are open in this thread, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a local one of our own only where it is unset and Spark runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return (root or _UNSET).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if scopes := _SCOPES.get():
        scopes[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession):
    """What this thread writes for what runs inside is deleted at its end: a result must have been written elsewhere by then."""
    own: list[str] = []
    outer = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield
    finally:
        _SCOPES.reset(outer)
        for path in own:
            delete(spark, path)


@contextmanager
def swept(spark: SparkSession):
    """What is written inside leaves no shuffle files, which else stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Delete the files of a table from `written` that nothing reads any more."""
    for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        delete(table.sparkSession, file)


def looked_up(rows: DataFrame, small: DataFrame, on: dict[str, str], spread: str, how: str = "inner", most: int | None = None) -> DataFrame:
    """rows joined with small (from `written`, no name in common) on row column -> small column, null equal to null.

    small is broadcast where its count allows (most, by default BROADCAST_ROWS, which is meant for rows of few numbers); else rows are salted by `spread`, so that no key, however common, goes to one task.
    """
    same = reduce(lambda a, b: a & b, [F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) for a, b in on.items()])
    if small.count() <= (BROADCAST_ROWS if most is None else most):
        return rows.join(F.broadcast(small), same, how)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(F.col(f"`{spread}`")), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, same & (F.col("__salt") == F.col("__copy")), how).drop("__salt", "__copy")


def parted(rows: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(some, rest): all rows whose key is in the one column of wanted are in some, with few others; each row is in one of the two.

    A bitmap of the wanted keys' hashes is broadcast, of SIEVE_BITS however many there are, so that a join of some with
    wanted, which still decides, need not move the rest. Where the bitmap fills up, some is all rows. rows is read for each part.
    """
    place = F.pmod(F.xxhash64(wanted.columns[0]), F.lit(SIEVE_BITS))
    bits = wanted.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    at = F.pmod(F.xxhash64(rows[f"`{key}`"]), F.lit(SIEVE_BITS))
    bit = F.bitmap_bit_position(at).cast("int")
    byte = F.conv(F.hex(F.substring(bits["bits"], F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = (F.bitmap_bucket_number(at) == bits["part"]) & (F.getbit(byte, bit % 8) == 1)
    return rows.join(F.broadcast(bits), found, "left_semi"), rows.join(F.broadcast(bits), found, "left_anti")


def ranked(rows: DataFrame, keys: tuple[str, str], place: list[str], name: str) -> DataFrame:
    """Rank of each row's keys (two longs) in their global order, and whether the keys stand at an earlier place.

    Adds rank long and later boolean; rows whose keys stand at one place only are left out, as are repeated rows. A range sort
    by keys and place cuts a common key over many tasks; a summary row of each task, joined back, links the ranges.
    """
    order = [*keys, *place]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row waits for the next batch, which tells whether its keys go on.
        held, at, late = None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else one_batch([held, batch])
            same = equal_neighbours(rows, place)
            group = np.logical_and.reduce([equal_neighbours(rows, [k]) for k in keys])
            # A repeated row is skipped: it is no place of its own.
            keep = np.r_[True, ~(group & same)]
            rows, group = rows.filter(pa.array(keep)), group[keep[1:]]
            local = at + np.r_[0, np.cumsum(~group)]
            later = np.r_[late, group]
            shared = later.copy()
            shared[:-1] |= group
            n = rows.num_rows - 1
            # The first group may go on from the range before.
            out = np.flatnonzero(shared[:n] | (local[:n] == 0))
            yield flagged(rows.take(pa.array(out)), local[out], later[out], shared[out])
            held, at, late = rows.slice(n), int(local[n]), bool(later[n])
        if held is not None:
            yield flagged(held, np.array([at]), np.array([late]), np.array([late]))

    def flagged(batch: pa.RecordBatch, local, later, shared) -> pa.RecordBatch:
        cols = [*batch.columns, pa.array(local, pa.int64()), pa.array(later, pa.bool_()), pa.array(shared, pa.bool_())]
        return pa.RecordBatch.from_arrays(cols, [*batch.schema.names, "local", "late", "shared"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema) + ", local bigint, late boolean, shared boolean"
    marked = written(ranges.mapInArrow(run, schema), name)
    key = F.struct(*keys)
    # One row a task: the only window without keys is over these.
    ends = marked.groupBy(F.col("part").alias("e_part")).agg(F.min(F.struct("local", key.alias("k"))).alias("first"), F.max(F.struct("local", key.alias("k"))).alias("last"))
    by_part = W.partitionBy().orderBy("e_part")
    ends = ends.withColumns({"goes_on": F.coalesce(F.lag("last.k").over(by_part) == F.col("first.k"), F.lit(False)), "follows": F.coalesce(F.lead("first.k").over(by_part) == F.col("last.k"), F.lit(False))})
    groups = F.col("last.local") + 1 - F.col("goes_on").cast("long")
    ends = ends.select("e_part", "goes_on", "follows", F.col("last.local").alias("top"), (F.sum(groups).over(by_part) - F.col("last.local") - 1).alias("base"))
    joined = marked.join(F.broadcast(ends), F.col("part") == F.col("e_part"))
    later = F.col("late") | (F.col("goes_on") & (F.col("local") == 0))
    shared = F.col("shared") | later | (F.col("follows") & (F.col("local") == F.col("top")))
    return joined.where(shared).select(*rows.columns, (F.col("base") + F.col("local")).alias("rank"), later.alias("later"))


def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of batches sorted by their first, without nulls, cut so that no run of equal values of it is."""
    held: list[list[np.ndarray]] = []  # rows of one value
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        key = cols[0]
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1], "left"))
        if held and last == 0 and key[0] == held[0][0][0]:
            held.append(cols)
            continue
        done = [*held, [c[:last] for c in cols]]
        yield [np.concatenate(x) for x in zip(*done, strict=True)]
        held = [[c[last:] for c in cols]]
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def one_batch(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def equal_neighbours(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """For every row but the first, whether its columns are those of the row before; nulls are equal."""
    out = np.ones(max(0, batch.num_rows - 1), bool)
    for name in columns:
        col = batch.column(name)
        a, b = col.slice(0, len(col) - 1), col.slice(1)
        same = pa.compute.fill_null(pa.compute.equal(a, b), False).to_numpy(zero_copy_only=False)
        if col.null_count:
            same = same | (a.is_null().to_numpy(zero_copy_only=False) & b.is_null().to_numpy(zero_copy_only=False))
        out &= same
    return out


def pieces(batch: pa.RecordBatch, column: str, most: int = SUB_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about `most` bytes; a longer text stands alone."""
    at, size = 0, 0
    col = batch.column(column)
    for i, n in enumerate(pa.compute.binary_length(col).to_pylist()):
        if size and size + (n or 0) > most:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n or 0
    if at < batch.num_rows:
        yield batch.slice(at)


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def kept(name: str) -> dict:
    """A dictionary that a Python worker keeps from task to task, also where the package was sent by value."""
    return sys.__dict__.setdefault(f"_quarrymill_{name}", {})


def n_words(text) -> F.Column:
    """Number of words of a text column as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
