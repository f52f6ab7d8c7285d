"""Artifacts by key without shuffles, listing by tasks, ordered files, refused input, runs of stages, counts on the way."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarrymill import build
from quarrymill.operators import assemble
from quarrymill.sources import files, listing
from quarrymill.sources.artifacts import ArtifactStore

KEY = "paper_id string"


def exchanges(df):
    """How many shuffles a plan has, broadcasts aside."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_stored_joins_shuffle_the_manifest_alone(spark, tmp_path):
    manifest = spark.createDataFrame([(str(i), f"t{i}") for i in range(50)], f"{KEY}, paper_title string")
    papers = spark.createDataFrame([(i % 40, i, None if i % 7 == 0 else f"paper {i}") for i in range(60)], "paper_id int, pos int, paper_markdown string")
    posters = spark.createDataFrame([(i, i, f"poster {i}", "{}", None) for i in range(0, 50, 2)] + [(None, 1, "lost", "{}", None)], "paper_id int, pos int, poster_markdown string, layout string, error string")
    layouts = spark.createDataFrame([(i, '{"q": 1}') for i in range(50)], "paper_id int, layout string")
    matches = spark.createDataFrame([(i, [i]) for i in range(5)], "paper_id int, figure_matches array<int>")
    store = ArtifactStore(spark, str(tmp_path / "a"), buckets=4)
    for name, rows in (("papers", papers), ("posters", posters), ("layouts", layouts), ("matches", matches)):
        store.write(name, rows)
    texts = lambda df: df.withColumn("paper_id", F.col("paper_id").cast("string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = assemble.assembled(manifest, store.read("papers"), store.read("posters"))
        assert exchanges(got) == 1 and exchanges(assemble.assembled(manifest, texts(papers), texts(posters))) > 2
        assert sorted(map(repr, got.collect())) == sorted(map(repr, assemble.assembled(manifest, texts(papers), texts(posters)).collect()))
        last = assemble.last_of(store.read("papers"), "paper_id", "pos")
        assert exchanges(last) == 0
        parts = [store.read("posters").select("paper_id", "poster_markdown"), last.select("paper_id", "paper_markdown"), store.read("layouts"), store.read("matches")]
        both = assemble.combined(manifest, *parts)
        assert exchanges(both) == 1
        plain = [texts(posters).select("paper_id", "poster_markdown"), assemble.last_of(texts(papers), "paper_id", "pos").select("paper_id", "paper_markdown"), texts(layouts), texts(matches)]
        assert sorted(map(repr, both.collect())) == sorted(map(repr, assemble.combined(manifest, *plain).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Another session's view: the catalog knows nothing, the folder does; rows are added, the last counts.
    spark.sql(f"DROP TABLE {store.table('papers')}")
    again = ArtifactStore(spark, str(tmp_path / "a"), buckets=99)
    assert again.buckets == 4 and sorted(again.names()) == ["layouts", "matches", "papers", "posters"]
    again.write("papers", spark.createDataFrame([(3, 999, "newest")], "paper_id int, pos int, paper_markdown string"), append=True)
    assert again.read("papers").count() == 61
    assert assemble.last_of(again.read("papers"), "paper_id", "pos").where("paper_id = '3'").first()["paper_markdown"] == "newest"
    with pytest.raises(ValueError, match="stored by"):
        ArtifactStore(spark, str(tmp_path / "a"), key="other")
    with pytest.raises(KeyError):
        again.read("none")


def test_listing(spark, tmp_path):
    """A tree of 5,000 files equals a walk on the driver; a probe by it; figures by folder."""
    for d in range(50):
        folder = tmp_path / "tree" / f"d{d % 7}" / f"e{d}"
        folder.mkdir(parents=True)
        for f in range(100):
            (folder / f"f{f:03d}.{'PNG' if f % 2 else 'txt'}").write_bytes(b"x" * (f % 5))
    walked = {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(tmp_path / "tree") for f in names}
    got = {r["path"]: r["length"] for r in listing.below(spark, str(tmp_path / "tree"), str(tmp_path / "none")).collect()}
    assert got == walked and len(got) == 5000
    found = listing.below(spark, f"file://{tmp_path}/tree", suffix="png")
    assert found.count() == 2500 and found.first()["path"].startswith("file:///")
    want = spark.createDataFrame([(p,) for p in [*list(walked)[:30], "/no/such"]], "path string")
    assert files.existing(want, listing.below(spark, str(tmp_path / "tree")), "path").count() == 30
    folders = spark.createDataFrame([(str(tmp_path / "tree" / "d0" / e),) for e in ("e0", "e7")], "path string")
    figures = listing.figures(folders, "paper").where("folder LIKE '%e7'").orderBy("number").collect()
    assert [(r["figure_id"], r["number"]) for r in figures] == [(f"f{2 * i + 1:03d}", i + 1) for i in range(50)]


def test_ordered_files(spark, tmp_path):
    """Training rows come first by the manifest, and no file holds all of a set."""
    train, val = (spark.range(n).select(F.concat(F.lit(name), F.col("id").cast("string")).alias("text")) for name, n in (("t", 4000), ("v", 1000)))
    files.write_sets(train, val, str(tmp_path))
    folder = tmp_path / "combined.jsonl"
    manifest = json.loads((folder / "_manifest.json").read_text())
    back = [json.loads(x) for m in manifest for x in (folder / m["file"]).read_text().splitlines()]
    assert [m["rows"] for m in manifest] == [len((folder / m["file"]).read_text().splitlines()) for m in manifest]
    assert [x["set"] for x in back] == [0] * 4000 + [1] * 1000
    assert Counter(x["text"][0] for x in back) == {"t": 4000, "v": 1000} and len({x["text"] for x in back}) == 5000
    assert spark.read.json(str(folder)).count() == 5000
    both = train.withColumn("set", F.lit(0)).unionByName(val.withColumn("set", F.lit(1)))
    cut = files.write_ordered(both, str(tmp_path / "cut"), "set", parts=6)
    assert len(cut) == 6 and max(m["rows"] for m in cut) < 1500 and [m["first"]["set"] for m in cut] == sorted(m["first"]["set"] for m in cut)
    rows = spark.createDataFrame([(i % 3, i) for i in range(300)], "a int, b int")
    made = files.write_ordered(rows, str(tmp_path / "o"), "a", "b", fmt="parquet", parts=5)
    assert [r["b"] for m in made for r in spark.read.parquet(f"{tmp_path}/o/{m['file']}").collect()] == [i for k in range(3) for i in range(k, 300, 3)]


def test_refused_input(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"x": 1, "y": "a"}\n\n{"x": \n[1]\n{"x": "no number"}\n{"x": 2}\nnull\n')
    rows, refused = files.checked_jsonl(spark, str(tmp_path / "x.jsonl"), "x int, y string")
    assert sorted(map(tuple, rows.collect())) == [(1, "a"), (2, None)]
    assert sorted((r["line"], r["reason"]) for r in refused.collect()) == [("[1]", "no object"), ("null", "no object"), ('{"x": ', "no JSON"), ('{"x": "no number"}', "not of the schema")]
    (tmp_path / "j").mkdir()
    for name, body in {"a": '{"x": 1}', "b": '{"x": 1} junk', "c": "[1, 2]"}.items():
        (tmp_path / "j" / f"{name}.json").write_text(body)
    records, bad = files.checked_json_files(spark, str(tmp_path / "j"))
    assert records.count() == 2 and [(r["path"][-6:], r["length"]) for r in bad.collect()] == [("b.json", 13)]
    (tmp_path / "status.csv").write_text("paper_id,poster_parsed,section_count\np,True,3\nq,maybe,x\nr,,\n")
    rows, bad = files.checked_status(spark, str(tmp_path / "status.csv"))
    assert rows.count() == 3 and sorted(map(tuple, bad.collect())) == [("q", "poster_parsed", "maybe"), ("q", "section_count", "x")]


def test_keys_are_names(spark, tmp_path):
    for key in ("../up", "a/b", "", None, ".hidden", "a\\b"):
        with pytest.raises(Exception, match="no file name"):
            files.write_records(spark.createDataFrame([(key, "x")], "k string, v string"), str(tmp_path / "r"), "k", "v")
    files.write_records(spark.createDataFrame([("a.b-1", "x")], "k string, v string"), str(tmp_path / "r"), "k", "v")
    assert os.listdir(tmp_path / "r") == ["a.b-1.json"]


def test_forced_rerun(spark, tmp_path):
    """Without resume all rows run in all stages, whatever an earlier log says; the earlier log stays."""
    ran = []

    def stage(name):
        def run(rows):
            ran.append((name, sorted(r["paper_id"] for r in rows.collect())))
            return rows.select("paper_id", F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"))

        return run

    rows, path = spark.createDataFrame([("a",), ("b",)], "paper_id string"), str(tmp_path / "log")
    for resume in (True, False, True):
        build.run_stages(rows, {"parse": stage("parse"), "match": stage("match")}, path, resume=resume)
    assert ran == [("parse", ["a", "b"]), ("match", ["a", "b"])] * 2 + [("parse", []), ("match", [])]
    assert sorted(os.listdir(path)) == ["run-000000", "run-000001", "run-000002"]


def jobs(spark, f):
    """How many jobs f runs, by their group."""
    group = f"counted-{f.__name__}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        return f(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_on_the_way(spark, tmp_path):
    rows = spark.range(1000).repartition(3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n, done = jobs(spark, lambda: files.export(rows, str(tmp_path / "x")))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert (n, done) == (1000, 1)
    assert files.export(rows, str(tmp_path / "c"), "csv") == 1000 and files.export(rows.limit(0), str(tmp_path / "d"), "csv") == 0
    manifest = spark.createDataFrame([(str(i), "i", "p", "T", None, "C", "2020", None, None) for i in range(6)], "paper_id string, local_image_path string, local_pdf_path string, title string, abstract string, conference string, year string, topics string, error string")
    papers = spark.createDataFrame([(str(i), i, f"paper {i}") for i in range(5)], "paper_id string, pos int, paper_markdown string")
    posters = spark.createDataFrame([(str(i), i, f"poster {i}", "{}", None) for i in range(1, 6)], "paper_id string, pos int, poster_markdown string, layout string, error string")
    got = build.build_and_export(manifest, papers, posters, str(tmp_path / "e"))
    assert got == build.build_corpus(manifest, papers, posters)[1].first().asDict() and got["completed"] == 4
    assert spark.read.json(str(tmp_path / "e")).count() == 4
