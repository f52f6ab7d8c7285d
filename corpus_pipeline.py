"""The corpus pipeline: quality classifier, line dedup, near-dedup, mixing, tokens.

Each stage takes a table of documents (doc_id, text, lang, source, n_chars, further columns) and the folder of the driver
tables; all but the last return the columns that they got. Every stage gives an empty result for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import lines, mixing, nearsets, pieces, quality
from quarrymill.llm.common import delete, scratch, scratch_path, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the classifier rejects.

    A null text is an empty one; null metadata is a value of its own; without labels of both classes all stay; rows that
    repeat an id go together where one of them is rejected; a null id always stays.
    """
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose later copies of line runs and of single long lines; n_chars follows the text.

    A null text stays null; a text may get empty; no row goes; the first place by doc_id, then line, stays; rows that
    repeat an id and text are one document; a null id loses nothing.
    """
    kept = lines.deduplicated(docs, long_words=lines.LONG_WORDS)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays; near copies are those of Jaccard 0.8 of five-word shingles.

    Texts without words (null, empty, white space) are copies of each other; rows that repeat an id stay or go together.
    """
    return nearsets.deduplicated(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it.

    A text without words has size 0; a null source is a source of its own; rows that repeat an id are taken equally often.
    """
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document: doc_id, ids, n_tokens. A null text has null ids, an empty one none."""
    return pieces.encode(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_stage), ("mix", mix_stage), ("tokens", token_stage)]
#: A trained classifier and a Viterbi search are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole table; a stage's scratch tables, and its input, are deleted once its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
