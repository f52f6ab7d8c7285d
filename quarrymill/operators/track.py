"""A processing tracker as an append-only log of updates, folded to one row per record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The stages of a record and the fields that an update may set, in the order of the status table.
STAGES = ("poster_parsed", "paper_parsed", "figures_matched", "layout_extracted", "training_data_created")
PATHS = ("poster_markdown_path", "poster_figures_dir", "paper_markdown_path", "paper_figures_dir", "figure_matches_path", "layout_json_path", "training_data_path")
COUNTS = ("poster_figure_count", "paper_figure_count", "matched_figure_count", "section_count")
LAST_STAGE = STAGES[-1]


def status(log: DataFrame, key: str = "paper_id", stages=STAGES, fields: tuple[str, ...] = (), order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """One row per key of a log(key, stage, success, error, ts, fields...): the state after all its updates in order.

    A stage has its last success, false before any; other stages' names change nothing. The last error that is not empty
    stays, also after a success. A field has its last value that is not null. started_at and last_updated are the first
    and last time. Partial aggregation: no key's updates are gathered.
    """
    at = F.struct(*order)
    flags = [F.coalesce(F.max_by(F.when(F.col("stage") == s, F.col("success")), F.when(F.col("stage") == s, at)), F.lit(False)).alias(s) for s in stages]
    said = F.coalesce(F.col("error"), F.lit("")) != ""
    error = F.max_by(F.when(said, F.col("error")), F.when(said, at)).alias("error_message")
    sets = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in fields]
    return log.groupBy(key).agg(*flags, error, *sets, F.min("ts").alias("started_at"), F.max("ts").alias("last_updated"))


def initialized(tracker: DataFrame, source: DataFrame, key: str = "paper_id") -> DataFrame:
    """tracker and an empty row for every key of source that it lacks; stages are false there."""
    mine = source.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()
    new = mine.join(tracker.select(F.col(key).cast("string").alias("__k")), F.col(key) == F.col("__k"), "left_anti")
    fresh = new.select(*[F.col(key) if c == key else (F.lit(False) if c in STAGES else F.lit(None)).cast(tracker.schema[c].dataType).alias(c) for c in tracker.columns])
    return tracker.withColumn(key, F.col(key).cast("string")).unionByName(fresh)


def completed(log: DataFrame, times: DataFrame, key: str = "paper_id") -> DataFrame:
    """log's keys with completed_at and processing_time_seconds; a time of zero is none."""
    return log.join(times.groupBy(key).agg(F.max("ts").alias("completed_at"), F.max(F.nullif("seconds", F.lit(0.0))).alias("processing_time_seconds")), key, "left")


def pending(tracker: DataFrame, stage: str | None = None) -> DataFrame:
    """Rows that have not done a stage (by default the last one); an unknown stage is done by none."""
    stage = stage or LAST_STAGE
    return tracker.where(~F.coalesce(F.col(stage), F.lit(False))) if stage in tracker.columns else tracker


def done(tracker: DataFrame, stage: str | None = None) -> DataFrame:
    stage = stage or LAST_STAGE
    return tracker.where(F.coalesce(F.col(stage), F.lit(False))) if stage in tracker.columns else tracker.limit(0)


def failed(tracker: DataFrame) -> DataFrame:
    return tracker.where(F.coalesce(F.col("error_message"), F.lit("")) != "")


def summary(tracker: DataFrame, stages=STAGES, counts=COUNTS[:3]) -> DataFrame:
    """One row: total, rows by stage, failed, mean counts over all rows (null where there are none)."""
    by_stage = [F.count_if(F.coalesce(F.col(s), F.lit(False))).alias(s) for s in stages]
    means = [(F.sum(F.coalesce(F.col(c), F.lit(0))) / F.count("*")).alias("avg_" + c.removesuffix("_count") + "s") for c in counts]
    return tracker.agg(F.count("*").alias("total"), *by_stage, F.count_if(F.coalesce(F.col("error_message"), F.lit("")) != "").alias("failed"), *means)


def stage_counters(log: DataFrame) -> DataFrame:
    """stage, processed, failed, skipped of a log(stage, success, skipped)."""
    skip = F.coalesce(F.col("skipped"), F.lit(False))
    ok = F.coalesce(F.col("success"), F.lit(False))
    return log.groupBy("stage").agg(F.count_if(ok & ~skip).alias("processed"), F.count_if(~ok & ~skip).alias("failed"), F.count_if(skip).alias("skipped"))


def skip_existing(todo: DataFrame, outputs: DataFrame, key: str = "paper_id") -> tuple[DataFrame, DataFrame]:
    """(rows without an output, updates that refresh the status of those with one)."""
    have = outputs.select(F.col(key).alias("__k")).distinct()
    rest = todo.join(have, F.col(key) == F.col("__k"), "left_anti")
    return rest, todo.join(have, F.col(key) == F.col("__k"), "left_semi").select(key, F.lit(True).alias("success"), F.lit(True).alias("skipped"))
