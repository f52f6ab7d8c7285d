"""Whole builds on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from quarrymill import build

MANIFEST = "paper_id string, local_image_path string, local_pdf_path string, title string, abstract string, conference string, year string, topics string, error string"


def test_build_and_export(spark, tmp_path):
    rows = [("1", "i", "p", "T1", None, "C", "2020", "a,b", None), ("2", None, "p", "T2", None, None, "2020", None, None), ("3", "i", "p", "T3", "A", None, None, None, ""), ("4", "i", "p", "T4", "A", None, "2021", None, "broken"), ("5", "i", "p", "T5", "A", None, "2021", None, None)]
    manifest = spark.createDataFrame(rows, MANIFEST)
    papers = spark.createDataFrame([(str(i), i, f"paper {i}") for i in range(1, 5)] + [("1", 9, "newer")], "paper_id string, pos int, paper_markdown string")
    posters = spark.createDataFrame([(str(i), i, f"poster {i}", '{"q": 1}', None) for i in (1, 3, 4)], "paper_id string, pos int, poster_markdown string, layout string, error string")
    simple, stats = build.build_corpus(manifest, papers, posters, limit=4)
    got = {r["paper_id"]: (r["success"], r["error"]) for r in simple.collect()}
    assert got == {"1": (True, None), "3": (False, "year is no number"), "4": (True, None)}
    assert stats.first().asDict() == {"total": 3, "completed": 2, "failed": 1, "skipped": 0, "cost": 0.006}
    original, _ = build.build_corpus(manifest, papers, posters, "original", limit=3)
    assert {r["paper_id"]: (r["year"], r["topics"], r["error"]) for r in original.collect()} == {"1": (2020, ["a", "b"], None), "3": (0, [], None), "5": (2021, [], "Not processed")}
    assert build.export_corpus(original, str(tmp_path / "out")) == 2
    lines = [json.loads(x) for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines()]
    first = next(x for x in lines if "T1" in x["instruction"])
    assert first["input"] == "newer" and json.loads(first["output"]) == {"layout": {"q": 1}, "content": "poster 1"}
    with pytest.raises(ValueError, match="mode"):
        build.build_corpus(manifest, papers, posters, "other")


def test_stages_resume(spark, tmp_path):
    ran = []

    def stage(name, fails):
        def run(rows):
            ran.append((name, sorted(r["paper_id"] for r in rows.collect())))
            return rows.select("paper_id", (~F.col("paper_id").isin(*fails)).alias("success"), F.when(F.col("paper_id").isin(*fails), f"{name} failed").alias("error"))

        return run

    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "paper_id string")
    path = str(tmp_path / "log")
    build.run_stages(rows, {"parse": stage("parse", ["b"]), "match": stage("match", ["c"])}, path)
    out = build.run_stages(rows, {"parse": stage("parse", []), "match": stage("match", [])}, path)
    assert ran == [("parse", ["a", "b", "c"]), ("match", ["a", "c"]), ("parse", ["b"]), ("match", ["b", "c"])]
    assert {r["paper_id"]: (r["parse"], r["match"], r["error_message"]) for r in out.collect()} == {"a": (True, True, None), "b": (True, True, "parse failed"), "c": (True, True, "match failed")}


def test_prepare_and_evaluate(spark, tmp_path):
    rows = spark.range(40).select("id", F.lit("do").alias("instruction"), F.repeat(F.lit("w "), F.col("id").cast("int") * 10).alias("input"), F.lit("o").alias("output"))
    assert {r["method"]: r["n"] for r in build.prepare(rows, str(tmp_path / "set"), "id", 2050, "head").collect()} == {"head": 29, "none_needed": 6}
    assert spark.read.json(f"{tmp_path}/set/train.jsonl").count() == 36
    papers = spark.createDataFrame([("p", "# T\nbody"), ("q", "# U\nmore")], "id string, text string")

    def judge(rows):
        return rows.withColumn("evaluation", F.lit('{"winner": "model_b", "model_a": {"total": 10}, "model_b": {"total": 30}}'))

    got = build.evaluate(papers, {"small": F.col("title"), "large": F.upper("content")}, judge, "id", "text", str(tmp_path / "eval"))
    assert {r["model"]: (r["wins"], r["avg_score"]) for r in got.collect()} == {"model_a": (0, 10.0), "model_b": (2, 30.0)}
    assert spark.read.json(f"{tmp_path}/eval/summary").count() == 2
