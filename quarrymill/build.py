"""Whole builds: a corpus from a manifest, stages that resume, a training set, a comparison of models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarrymill.operators import assemble as A
from quarrymill.operators import evaluate as E
from quarrymill.operators import prepare as P
from quarrymill.operators import tables as O
from quarrymill.operators import track as K
from quarrymill.sources import files, shared


def build_corpus(manifest: DataFrame, papers: DataFrame, posters: DataFrame, mode: str = "simple", limit: int | None = None, start: int = 0, order: str = "paper_id") -> tuple[DataFrame, DataFrame]:
    """(examples with success and error, one row of run statistics).

    simple takes a slice of the manifest and then drops rows without paths; original drops rows without paths or with an
    error, and then takes the slice. Metadata follows the mode's rule of nulls.
    """
    O.require_columns(manifest, "paper_id", "local_image_path", "local_pdf_path")
    paths = ("local_image_path", "local_pdf_path")
    if mode == "simple":
        rows, _ = O.skip_null_paths(O.sliced(manifest, order, start, limit), *paths)
    elif mode == "original":
        rows = O.sliced(O.valid_rows(manifest, *paths), order, start, limit)
    else:
        raise ValueError("mode must be simple or original")
    facts = A.metadata(rows.drop("error"), mode)
    wrong = F.col("error").alias("wrong") if "error" in facts.columns else F.lit(None).cast("string").alias("wrong")
    facts = facts.select(*[c for c in facts.columns if c != "error"], wrong).withColumnsRenamed({"title": "paper_title", "abstract": "paper_abstract"})
    out = A.assembled(facts, papers, posters)
    out = out.withColumns({"success": F.col("success") & F.col("wrong").isNull(), "error": F.coalesce("error", "wrong")}).drop("wrong")
    return out, A.run_stats(out)


def export_corpus(examples: DataFrame, path: str, fmt: str = "jsonl") -> int:
    """The successful examples as instruction rows; returns how many."""
    return files.export(A.export_rows(examples.where("success")), path, fmt)


def build_and_export(manifest: DataFrame, papers: DataFrame, posters: DataFrame, path: str, fmt: str = "jsonl", **kw) -> dict:
    """Build a corpus and export its successful examples in one pass; returns the run's statistics, counted on the way."""
    if fmt not in ("jsonl", "parquet"):
        raise ValueError("a format of many files: jsonl or parquet")
    examples, _ = build_corpus(manifest, papers, posters, **kw)
    seen = Observation()
    ok = F.coalesce("success", F.lit(False))
    observed = examples.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("completed"))
    rows = A.export_rows(observed.where("success"))
    files.write_jsonl(rows, path) if fmt == "jsonl" else rows.write.parquet(path)
    found = seen.get
    return {"total": found["total"], "completed": found["completed"], "failed": found["total"] - found["completed"], "skipped": 0, "cost": round(found["completed"] * A.CALL_COST, 6)}


def run_stages(rows: DataFrame, stages: dict[str, Callable[[DataFrame], DataFrame]], path: str, key: str = "paper_id", resume: bool = True) -> DataFrame:
    """Run stages in order, each on the rows whose earlier stages succeeded; returns the tracker.

    A stage gives (key, success, error). Its updates are a folder of the log at `path`; with resume, rows that have succeeded
    in a stage are not run again, and all others are. Without it every row is run in every stage, as if there were no log.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], f"{key} string, stage string, success boolean, error string, ts timestamp")
    names = tuple(stages)

    # A run writes to a folder of its own; an earlier run's log is read only where this one resumes it.
    earlier_runs = shared.names(spark, path)
    own = f"run-{len(earlier_runs):06d}"

    def log() -> DataFrame:
        found = [f"{path}/{r}/{n}" for r in ([*earlier_runs, own] if resume else [own]) for n in shared.complete(spark, f"{path}/{r}")]
        return spark.read.schema(empty.schema).parquet(*found) if found else empty

    todo = rows.withColumn(key, F.col(key).cast("string"))
    for k, name in enumerate(names):
        state = K.status(log(), key, stages=names)
        done = K.done(state, name).select(F.col(key).alias("__k"))
        ready = todo
        for earlier in names[:k]:
            ready = ready.join(K.done(state, earlier).select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_semi")
        result = stages[name](ready.join(done, F.col(key) == F.col("__k"), "left_anti"))
        updates = result.select(F.col(key).cast("string").alias(key), F.lit(name).alias("stage"), F.col("success"), F.col("error").cast("string").alias("error"), F.current_timestamp().alias("ts"))
        updates.write.parquet(f"{path}/{own}/{k:06d}-{name}")
    return K.initialized(K.status(log(), key, stages=names), todo, key)


def prepare(rows: DataFrame, path: str, key: str, max_tokens: int = 8192, strategy: str = "smart", fmt: str = "alpaca", ratio: float = 0.1) -> DataFrame:
    """Write train, val and combined sets of instruction rows; returns the histogram of extraction methods of full rows."""
    made = P.prepared(rows, max_tokens, strategy, fmt)
    train, val, _ = P.split_sets(made, key, ratio)
    files.write_sets(train.drop(key), val.drop(key), path)
    return made.where("_meta.type = 'full'").groupBy(F.col("_meta.extraction_method").alias("method")).agg(F.count("*").alias("n")).orderBy("method")


def evaluate(papers: DataFrame, models: dict, judge: Callable[[DataFrame], DataFrame], id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """model, wins, avg_score: the models' outputs of each paper go to judge, which adds a JSON column `evaluation`."""
    outputs = E.cross_models(E.samples(papers, id_col, text_col), models)
    judged = judge(E.judgeable(outputs, list(models)))
    summary = E.judge_summary(judged, "evaluation", [f"model_{'abcdefgh'[i]}" for i in range(len(models))])
    if path:
        files.write_summary(summary, E.output_lengths(outputs).join(judged.select("sample_id", "evaluation"), "sample_id", "left"), path)
    return summary
