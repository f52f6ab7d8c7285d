"""Relational operators over manifests, trackers, matches and training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Thresholds of the verdicts.
SAME_SCORE, SIMILAR_SCORE = 0.5, 0.25
CANDIDATE_SCORE = 0.10
SAME_CONFIDENCE, SIMILAR_CONFIDENCE = 0.6, 0.7
FULL_CHARS = 100


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing columns: {missing}")
    return df


def valid_rows(manifest: DataFrame, *paths: str, error: str = "error") -> DataFrame:
    """Rows with all paths and without an error."""
    cond = F.coalesce(F.col(error), F.lit("")) == ""
    for p in paths:
        cond &= F.col(p).isNotNull()
    return manifest.where(cond)


def sliced(df: DataFrame, order: str, start: int = 0, limit: int | None = None) -> DataFrame:
    """Rows start, start + 1, ... in order; a limit of 0 or None is none."""
    out = df.orderBy(order).offset(start)
    return out.limit(limit) if limit else out


def skip_null_paths(rows: DataFrame, *paths: str) -> tuple[DataFrame, DataFrame]:
    """(rows that have all paths, one row with the number of those skipped for a null path)."""
    has = F.lit(True)
    for p in paths:
        has &= F.col(p).isNotNull()
    return rows.where(has), rows.agg(F.count_if(~has).alias("skipped"))


def shuffled(rows: DataFrame, seed: int | None = None) -> DataFrame:
    """rows in a random order; another one each time without a seed."""
    return rows.orderBy(F.rand(seed) if seed is not None else F.rand())


def details(ids: DataFrame, facts: DataFrame, key: str, *columns: str) -> DataFrame:
    """ids with the columns of their row of facts; null for an unknown one."""
    known = facts.select(F.col(key).alias("__k"), *columns)
    return ids.join(known, F.col(key) == F.col("__k"), "left").drop("__k")


def merge_status(source: DataFrame, status: DataFrame, key: str, suffix: str = "_tracking") -> DataFrame:
    """Left join by the key as a string; clashing columns of status get a suffix."""
    renamed = status.select([F.col(c).alias(c if c == key or c not in source.columns else c + suffix) for c in status.columns])
    renamed = renamed.withColumn(key, F.col(key).cast("string"))
    return source.withColumn(key, F.col(key).cast("string")).join(renamed, key, "left")


def latest(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by a partial aggregation."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*")


def stage_table(log: DataFrame, key: str, stage: str, stages: list[str], error: str) -> DataFrame:
    """A row per key: a flag per stage, and whether it failed."""
    flags = [F.coalesce(F.bool_or(F.col(stage) == s), F.lit(False)).alias(s) for s in stages]
    return log.groupBy(key).agg(*flags, F.coalesce(F.bool_or(F.col(stage) == error), F.lit(False)).alias("failed"))


def feature_verdict(score):
    """same, similar or null by score alone."""
    return F.when(score >= SAME_SCORE, "same").when(score >= SIMILAR_SCORE, "similar")


def model_verdict(verdict, confidence):
    """Confidence level of a match by a model's verdict; null drops it."""
    sure = (verdict == "same") & (confidence >= SAME_CONFIDENCE)
    likely = (verdict == "same") | ((verdict == "similar") & (confidence >= SIMILAR_CONFIDENCE))
    return F.when(sure, "high").when(likely, "medium").when(verdict == "similar", "low")


def match_pairs(left: DataFrame, right: DataFrame, key: str, score) -> DataFrame:
    """Candidates within a key whose score is high enough, with their rank in the key."""
    pairs = left.join(right, key).withColumn("score", score).where(F.col("score") >= CANDIDATE_SCORE)
    order = W.partitionBy(key).orderBy(F.col("score").desc(), "l_id", "r_id")
    return pairs.withColumn("rank", F.row_number().over(order))


def split_train_val(rows: DataFrame, key: str, ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """+ split: rows in the order of md5(seed:key); the first int(n * (1 - ratio)) train.

    The cut is a row of the order, found by a range sort and counts of its partitions; no window over all rows.
    """
    keyed = rows.withColumn("__o", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    n = rows.count()
    want = int(n * (1 - ratio))
    if want == 0 or want >= n:
        return rows.withColumn("split", F.lit("train" if want else "val"))
    # The cut lies in one of 65,536 ranges of the digest; only that range is sorted.
    sizes = keyed.groupBy(F.left("__o", F.lit(4)).alias("b")).count().orderBy("b").toArrow().to_pylist()
    seen = 0
    for r in sizes:
        if seen + r["count"] > want:
            break
        seen += r["count"]
    edge = keyed.where(F.col("__o").startswith(r["b"])).select("__o", key).orderBy("__o", key).offset(want - seen).limit(1).first()
    edge_key = F.lit(edge[key]).cast(rows.schema[key].dataType)
    after = (F.col("__o") > edge["__o"]) | ((F.col("__o") == edge["__o"]) & (F.col(key) >= edge_key))
    return keyed.withColumn("split", F.when(after, "val").otherwise("train")).drop("__o")


def ordered_text(rows: DataFrame, key: str, order: str, text: str, sep: str = "\n\n") -> DataFrame:
    """A key's non-blank texts in order, joined."""
    kept = rows.where(F.regexp_like(F.col(text), F.lit(r"\S")))
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return kept.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p[text]), sep).alias("text"))


def wins(results: DataFrame, models: list[str], winner: str) -> DataFrame:
    """Wins by model over a fixed list, zero where it has none."""
    spark = results.sparkSession
    names = spark.createDataFrame([(m,) for m in models], "model string")
    counts = results.groupBy(F.col(winner).alias("model")).agg(F.count("*").alias("n"))
    return names.join(counts, "model", "left").select("model", F.coalesce("n", F.lit(0)).alias("wins"))
