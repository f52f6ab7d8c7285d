"""Comparing models: prompts, outputs of each model, gating, scores, lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import jsonx as J
from quarrymill.functions import scan as S

# What stands for an output that there is none of.
NO_MODEL = "[Model not available]"
NOT_ASKED = "N/A"


def samples(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """sample_id, content (capped), title, abstract of each row."""
    content = S.capped(F.col(text_col), S.EVAL_CHARS, S.EVAL_MARK)
    picked = rows.select(F.col(id_col).alias("sample_id"), content.alias("content"))
    title, abstract = S.title_and_abstract(F.col("content"))
    return picked.select("sample_id", "content", title.alias("title"), abstract.alias("abstract"))


def named_samples(rows: DataFrame, order: str, text_col: str, n: int | None = None) -> DataFrame:
    """(id, title, content): the first n rows in order, named real_0, real_1, ..., titled by their first 50 characters."""
    from pyspark.sql import Window as W

    # Only the rows of the limit are numbered.
    head = rows.orderBy(order).limit(n) if n is not None else rows
    i = F.row_number().over(W.partitionBy().orderBy(order)) - 1
    return head.select(F.concat(F.lit("real_"), i).alias("id"), F.left(F.col(text_col), F.lit(50)).alias("title"), F.col(text_col).alias("content"))


def cross_models(tasks: DataFrame, models: dict[str, Column | None]) -> DataFrame:
    """A row for each sample and model: tasks, model, output. A model is a column expression, null where it is not available.

    A model that fails gives a null and is named in the output.
    """
    pairs = [F.struct(F.lit(name).alias("model"), (F.lit(NO_MODEL) if c is None else F.coalesce(c, F.lit("[Error: no output]"))).alias("output")) for name, c in models.items()]
    return tasks.withColumn("o", F.explode(F.array(*pairs))).select(*tasks.columns, "o.model", "o.output")


def output_lengths(outputs: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """id, lengths: a map model -> length, models in order."""
    pairs = F.array_sort(F.collect_list(F.struct("model", F.length("output").alias("n"))))
    return outputs.groupBy(id_col).agg(F.map_from_entries(pairs).alias("lengths"))


def judgeable(outputs: DataFrame, models: list[str], id_col: str = "sample_id") -> DataFrame:
    """One row per sample none of whose outputs is missing: id and the outputs in the judge's order, N/A for a model that was not asked."""
    own = [F.coalesce(F.max(F.when(F.col("model") == m, F.col("output"))), F.lit(NOT_ASKED)).alias(f"output_{m}") for m in models]
    rows = outputs.groupBy(id_col).agg(F.bool_and(F.col("output") != NO_MODEL).alias("__all"), *own)
    return rows.where("__all").drop("__all")


def judge_summary(evaluations: DataFrame, column: str, models: list[str]) -> DataFrame:
    """model, wins, avg_score over the evaluations that name a winner; zero where there are none."""
    won = J.field(F.col(column), "$.winner")
    per = [F.struct(F.lit(m).alias("model"), F.when(won == m, 1).otherwise(0).alias("won"), J.field(F.col(column), f"$.{m}.total", "double").alias("total")) for m in models]
    counted = evaluations.where(won.isNotNull()).select(F.explode(F.array(*per)).alias("s")).groupBy("s.model").agg(F.sum("s.won").alias("n"), F.avg("s.total").alias("score"))
    names = evaluations.sparkSession.createDataFrame([(m,) for m in models], "model string")
    return names.join(counted, "model", "left").select("model", F.coalesce("n", F.lit(0)).alias("wins"), F.coalesce("score", F.lit(0.0)).alias("avg_score"))


#: Short papers to try a model with.
LITERAL_PAPERS = (
    ("lit_0", "Counting Words at Scale", "# Counting Words at Scale\n\n## Abstract\nWe count words.\n\n## Introduction\nWords are many.\n\n## Method\nWe sort them first."),
    ("lit_1", "Sorting Without Fear", "# Sorting Without Fear\n\n## Abstract\nWe sort rows that do not fit in memory.\n\n## Result\nIt ends."),
    ("lit_2", "Joins of Skewed Keys", "# Joins of Skewed Keys\n\nAbstract: one key holds a third of all rows.\n\n1. Introduction\nWe salt it."),
)


def literal_samples(spark: SparkSession, n: int | None = None) -> DataFrame:
    """(id, title, content) of a few papers of our own."""
    return spark.createDataFrame(list(LITERAL_PAPERS)[:n], "id string, title string, content string")
