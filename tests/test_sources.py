"""Readers, writers, connectors, pictures and streams on small files."""

import base64
import json
import random
import sys
import time

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarrymill.functions import images, jsonx, scan
from quarrymill.operators import assemble, evaluate, prepare, tables, track
from quarrymill.sources import connectors, files
from quarrymill.streaming import ready


def test_manifest_and_status(spark, tmp_path):
    (tmp_path / "train.csv").write_text('paper_id,local_image_path,local_pdf_path,title,extra\n1,a.png,a.pdf,"two\nlines, ""so""",x\n2,,b.pdf,,y\n')
    rows = files.read_manifest(spark, str(tmp_path)).orderBy("paper_id").collect()
    assert [(r["paper_id"], r["local_image_path"], r["title"], r["error"]) for r in rows] == [("1", "a.png", 'two\nlines, "so"', None), ("2", None, None, None)]
    with pytest.raises(ValueError, match="split"):
        files.read_manifest(spark, str(tmp_path), "dev")
    (tmp_path / "status.csv").write_text("paper_id,poster_parsed,section_count,unknown,error_message\np,True,3,z,\nq,maybe,x,z,bad\n,,,,\n")
    got = {r["paper_id"]: (r["poster_parsed"], r["section_count"], r["error_message"]) for r in files.read_status(spark, str(tmp_path / "status.csv")).collect()}
    assert got == {"p": (True, 3, None), "q": (None, None, "bad")}
    assert files.read_status(spark, str(tmp_path / "none.csv")).count() == 0
    assert track.failed(files.read_status(spark, str(tmp_path / "status.csv"))).count() == 1


def test_json_readers(spark, tmp_path):
    (tmp_path / "j").mkdir()
    for name, text in {"a": '{"x": 1}', "b": '{"x": 1} junk', "c": "[1, 2]"}.items():
        (tmp_path / "j" / f"{name}.json").write_text(text)
    records = files.read_json_files(spark, str(tmp_path / "j"))
    assert {r["id"] for r in records.collect()} == {"a", "c"}
    none = records.limit(0)
    got = files.with_artifacts(spark.createDataFrame([("a",), ("z",)], "paper_id string"), records, none)
    assert {r["paper_id"]: (r["layout"] is None, r["m"]) for r in got.withColumn("m", F.to_json("matches")).collect()} == {"a": (False, "[]"), "z": (True, "[]")}
    (tmp_path / "bad.jsonl").write_text('{"x": 1}\n{"x": \n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "x int").collect()
    path = str(tmp_path / "checkpoint")
    assert files.read_checkpoint(spark, path)["completed_ids"] == []
    files.write_checkpoint(spark, path, "combine", ["b", "a", "a"], ["c"])
    found = files.read_checkpoint(spark, path)
    assert (found["stage"], found["completed_ids"], found["failed_ids"]) == ("combine", ["a", "b"], ["c"]) and found["timestamp"]


def test_folders(spark, tmp_path):
    for folder, name in (("p1", "b.md"), ("p1", "a.md"), ("p2", "x.md")):
        (tmp_path / "md" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "md" / folder / name).write_text(f"{folder}/{name}")
    assert {r["id"]: r["text"] for r in files.read_markdown(spark, str(tmp_path / "md")).collect()} == {"p1": "p1/a.md", "p2": "p2/x.md"}
    (tmp_path / "pic").mkdir()
    for name, size in {"z.png": 5, "a.png": 7, "c.JPG": 9}.items():
        (tmp_path / "pic" / name).write_bytes(bytes(range(size)))
    assert [(r["figure_id"], r["length"]) for r in files.list_figures(spark, str(tmp_path / "pic")).collect()] == [("a", 7), ("z", 5)]
    coded = {r["path"].rsplit("/", 1)[1]: (r["data"], r["media_type"]) for r in files.encoded_images(spark, str(tmp_path / "pic")).collect()}
    assert coded["c.JPG"] == (base64.b64encode(bytes(range(9))).decode(), "image/jpeg") and coded["a.png"][1] == "image/png"
    listing = spark.createDataFrame([("a",), ("b",)], "path string")
    rows = spark.createDataFrame([(1, "a", "b"), (2, "a", "c"), (3, None, "a")], "id int, p string, q string")
    assert [r["id"] for r in files.existing(rows, listing, "p", "q").collect()] == [1]


def test_large_images_shrink(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan, "MAX_BASE64", 8)
    (tmp_path / "x.gif").write_bytes(b"123456")
    (tmp_path / "y.gif").write_bytes(b"1234567")
    got = {r["path"].rsplit("/", 1)[1]: r for r in files.encoded_images(spark, str(tmp_path), lambda b: b[:3]).collect()}
    assert (got["x.gif"]["media_type"], got["y.gif"]["media_type"], base64.b64decode(got["y.gif"]["data"])) == ("image/gif", "image/jpeg", b"123")


def test_pdfs(spark, tmp_path):
    with pytest.raises(ValueError, match="no PDF"):
        files.read_pdfs(spark, str(tmp_path), lambda b: "")
    (tmp_path / "one_good-paper.pdf").write_bytes(b"text")
    (tmp_path / "bad.pdf").write_bytes(b"!")

    def parse(content):
        if content == b"!":
            raise ValueError("no text")
        return content.decode()

    got = {r["id"]: (r["title"], r["content"], r["error"] is None) for r in files.read_pdfs(spark, str(tmp_path), parse).collect()}
    assert got == {"one_good-paper": ("one good paper", "text", True), "bad": ("bad", None, False)}
    (tmp_path / "t.md").write_text("# T")
    assert files.read_paper(spark, str(tmp_path / "t.md")).first()["content"] == "# T"


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a"b\n', None, [1, 2]), (2, "é", 0.5, [])], "id int, t string, x double, l array<int>")
    want = [{"id": 1, "t": 'a"b\n', "x": None, "l": [1, 2]}, {"id": 2, "t": "é", "x": 0.5, "l": []}]
    for fmt in ("jsonl", "json", "parquet", "csv"):
        assert files.export(rows, str(tmp_path / fmt), fmt) == 2
    read = lambda fmt: "".join(p.read_text() for p in sorted((tmp_path / fmt).glob("part-*")))
    assert sorted(map(json.loads, read("jsonl").splitlines()), key=lambda r: r["id"]) == want
    assert sorted(json.loads(read("json")), key=lambda r: r["id"]) == want
    assert sorted(r.asDict()["id"] for r in spark.read.parquet(str(tmp_path / "parquet")).collect()) == [1, 2]
    back = spark.read.csv(str(tmp_path / "csv"), header=True, multiLine=True, escape='"').orderBy("id").collect()
    assert [(r["t"], r["l"]) for r in back] == [('a"b\n', "[1,2]"), ("é", "[]")]
    files.write_json_array(rows.limit(0), str(tmp_path / "none"))
    assert json.loads(read("none")) == []
    files.write_csv(rows.limit(0), str(tmp_path / "nocsv"))
    assert not (tmp_path / "nocsv").exists()
    files.write_records(rows, str(tmp_path / "rec"), "id", "t", ".md")
    files.write_records(rows, str(tmp_path / "rec"), "id", "t", ".md")
    assert {p.name: p.read_text() for p in (tmp_path / "rec").iterdir()} == {"1.md": 'a"b\n', "2.md": "é"}
    assert files.peek(rows, 1)["shape"] == (2, 4)
    assert rows.select(files.shown(F.struct("t"), 5).alias("s")).first()["s"].endswith("[output truncated]")
    with pytest.raises(ValueError, match="format"):
        files.export(rows, str(tmp_path / "q"), "xml")


def test_sets_and_summary(spark, tmp_path):
    rows = spark.range(100).select(F.col("id"), F.concat(F.lit("i"), "id").alias("instruction"), F.lit("x").alias("input"), F.lit("o").alias("output"))
    train, val, both = prepare.split_sets(prepare.prepared(rows, fmt="alpaca"), "id")
    assert (train.count(), val.count(), both.count()) == (90, 10, 100) and "_meta" not in both.columns
    files.write_sets(train, val, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/combined.jsonl").count() == 100
    splits = files.read_splits(spark, f"{tmp_path}/train.jsonl", f"{tmp_path}/val.jsonl")
    assert splits["train"].columns == ["text"] and splits["validation"].count() == 10
    files.write_summary(spark.range(1), spark.createDataFrame([("s1", 1)], "sample_id string, n int"), str(tmp_path / "e"))
    assert spark.read.json(f"{tmp_path}/e/samples").first()["sample_id"] == "s1"


def test_mersenne_shuffle(spark):
    want = list(range(57))
    random.seed(42)
    random.shuffle(want)
    rows = spark.range(57).withColumnRenamed("id", "pos")
    assert [r["pos"] for r in prepare.mersenne_shuffled(rows, "pos").orderBy("shuffled").collect()] == want
    assert prepare.mersenne_shuffled(rows.limit(0), "pos").count() == 0


def test_prepared_partial_rows(spark):
    rows = spark.createDataFrame([(1, "i", "short", "o"), (2, "i", "w" * 9000, "o")], "id int, instruction string, input string, output string")
    out = {r["id"]: r for r in prepare.prepared(rows, 3500, "head", "mistral").collect()}
    assert out[1]["_meta"]["type"] == "partial" and out[1]["text"] == "<s>[INST] i\n\nshort [/INST] o</s>"
    assert out[2]["_meta"].asDict() == {"type": "full", "original_len": 9000, "extraction_method": "head"} and len(out[2]["text"]) < 6100


def flaky():
    """A connector that fails with the statuses of a request, one a call, then answers."""
    seen = {}

    def call(request):
        plan = request.split(":")[1]
        n = seen[request] = seen.get(request, 0) + 1
        if n <= len(plan):
            raise connectors.CallError({"r": 429, "s": 503, "t": None, "x": 400}[plan[n - 1]], 2.0 if plan[n - 1] == "r" else None)
        return f"ok {request}"

    return call


def test_connector(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    requests = spark.createDataFrame([(i, f"{i}:{p}") for i, p in enumerate(["", "r", "st", "x", "sss"])], "id int, q string")
    got = {r["id"]: (r["answer"], r["error"]) for r in connectors.answered(requests, "q", lambda: flaky(), concurrency=2, sleep=lambda s: None).collect()}
    assert got[0] == ("ok 0:", None) and got[1][0] == "ok 1:r" and got[2][0] == "ok 2:st"
    assert got[3][0] is None and "400" in got[3][1] and got[4][0] is None and "503" in got[4][1]
    assert [scan.backoff_seconds(k, 429) for k in (0, 3, 9)] == [1.0, 8.0, 60.0] and scan.backoff_seconds(2, 500) == 3.0
    waits = []
    connectors.called(flaky(), "q:rts", connectors.Retry(5), waits.append)
    assert waits == [2.0, 2.0, 3.0]


def test_sections_by_a_model(spark):
    papers = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "boom")], "id int, text string")

    def make():
        def call(q):
            if q == "boom":
                raise connectors.CallError(400)
            return '```json\n{"abstract": "A"}\n```' if q == "good" else "no json"

        return call

    out = {r["id"]: (r["abstract"], r["method"]) for r in connectors.extracted_sections(papers, "text", make, {"abstract": F.lit("by pattern")}).collect()}
    assert out == {1: ("A", "llm"), 2: ("by pattern", "llm_fallback_regex"), 3: ("by pattern", "llm_fallback_regex")}


def test_parsers_and_elements(spark):
    docs = spark.createDataFrame([("a.pdf", bytearray(b"1|2| |4")), ("b.pdf", bytearray(b"!"))], "path string, content binary")

    def parse(content):
        if content == b"!":
            raise RuntimeError("unreadable")
        return content.decode().split("|")

    pages = connectors.parsed_documents(docs, {"plain": parse}, ("fancy", "plain"))
    assert [r["error"] for r in pages.where("error IS NOT NULL").collect()] == ["unreadable"]
    from quarrymill.operators import figures

    assert figures.pages_text(pages, "path", "page", "text").first()["markdown"] == "## Page 1\n\n1\n\n## Page 2\n\n2\n\n## Page 4\n\n4"
    with pytest.raises(ValueError, match="available"):
        connectors.parsed_documents(docs, {}, ("fancy",))
    elements = spark.createDataFrame([(i, "tab" if i % 3 else "text", bytearray([65 + i])) for i in range(20)], "reading_order int, label string, crop binary")
    read = connectors.read_elements(elements, "label", lambda kind: lambda crops: [f" {kind}{c.decode()}\n" for c in crops], batch=3)
    assert {r["reading_order"]: r["text"] for r in read.collect()} == {i: ("tab" if i % 3 else "text") + chr(65 + i) for i in range(20)}


def test_pictures(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (32, 32), dtype=np.uint8)
    b = np.clip(a.astype(int) + rng.integers(-20, 20, a.shape), 0, 255).astype(np.uint8)

    def plain(x, y):
        out = []
        for i in range(26):
            for j in range(26):
                p, q = (v[i : i + 7, j : j + 7].astype(float).ravel() for v in (x, y))
                cov = np.cov(p, q)
                out.append((2 * p.mean() * q.mean() + 6.5025) * (2 * cov[0, 1] + 58.5225) / ((p.mean() ** 2 + q.mean() ** 2 + 6.5025) * (cov[0, 0] + cov[1, 1] + 58.5225)))
        return np.mean(out)

    assert images.structural_similarity(a, a) == pytest.approx(1.0) and images.structural_similarity(a, b) == pytest.approx(plain(a, b))
    rows = spark.createDataFrame([(bytearray(a.tobytes()), bytearray(b.tobytes())), (None, bytearray(b"x"))], "a binary, b binary")
    got = [r[0] for r in rows.select(images.ssim_score(32)("a", "b")).collect()]
    assert got[0] == pytest.approx(plain(a, b)) and got[1] is None
    ratio = rows.select(images.feature_score(lambda v: np.frombuffer(v, np.uint8).reshape(-1, 32))("a", "a")).collect()
    assert ratio[0][0] == 1.0 and ratio[1][0] == 0.0
    h = images.perceptual_hash(a)
    assert h.shape == (256,) and (h != images.perceptual_hash(b)).sum() < (h != images.perceptual_hash(255 - a)).sum()


def test_tracker(spark):
    log = [("p", "poster_parsed", True, None, 1), ("p", "poster_parsed", False, "bad", 2), ("p", "poster_parsed", True, "", 3), ("q", "other", True, None, 1)]
    df = spark.createDataFrame(log, "paper_id string, stage string, success boolean, error string, ts int")
    now = {r["paper_id"]: r for r in track.status(df).collect()}
    assert now["p"]["poster_parsed"] and now["p"]["error_message"] == "bad" and (now["p"]["started_at"], now["p"]["last_updated"]) == (1, 3) and not now["q"]["poster_parsed"]
    assert track.pending(track.status(df), "unknown").count() == 2 and track.done(track.status(df), "unknown").count() == 0
    assert track.summary(track.status(df).limit(0), counts=()).first()["total"] == 0
    rest, again = track.skip_existing(spark.createDataFrame([("p",), ("r",)], "paper_id string"), spark.createDataFrame([("p",)], "paper_id string"))
    assert [r[0] for r in rest.collect()] == ["r"] and [r[0] for r in again.collect()] == ["p"]
    times = spark.createDataFrame([("p", 9, 0.0)], "paper_id string, ts int, seconds double")
    done = track.completed(track.status(df), times).where("paper_id = 'p'").first()
    assert done["completed_at"] == 9 and done["processing_time_seconds"] is None


def test_verdicts_and_helpers(spark):
    rows = spark.createDataFrame([("same", 0.6), ("same", 0.1), ("similar", 0.7), ("similar", 0.1), ("different", 1.0)], "v string, c double")
    assert [r[0] for r in rows.select(tables.model_verdict(F.col("v"), F.col("c"))).collect()] == ["high", "medium", "medium", "low", None]
    one = spark.createDataFrame([("", " {} ", None)], "a string, b string, c string")
    assert tuple(one.select(*(assemble.nonempty(F.col(c)) for c in "abc")).first()) == (None, None, None)
    scores = evaluate.judge_summary(spark.createDataFrame([(None,)], "e string"), "e", ["model_a"]).first()
    assert (scores["wins"], scores["avg_score"]) == (0, 0.0)


def test_streams(spark, tmp_path):
    """Two streams in files: pairs of records that both succeeded, also nine hours apart; a second run goes on, a listener counts."""
    schema = "paper_id string, ts timestamp, ok boolean"
    for side, rows in (("l", [("a", "2024-01-01 00:00:00", True), ("b", "2024-01-01 00:01:00", True), ("c", "2024-01-01 00:02:00", False)]), ("r", [("a", "2024-01-01 00:10:00", True), ("c", "2024-01-01 00:10:00", True), ("b", "2024-01-01 09:00:00", True)])):
        spark.createDataFrame(rows, "paper_id string, ts string, ok boolean").withColumn("ts", F.col("ts").cast("timestamp")).repartition(3).write.parquet(str(tmp_path / side))
    seen = []
    listener = ready.Progress(lambda done, batch: seen.append((done, batch)))
    spark.streams.addListener(listener)
    try:
        for _ in range(2):
            left, right = (ready.file_stream(spark, str(tmp_path / side), schema, 1) for side in "lr")
            ready.run_once(ready.ready_pairs(left, right, "paper_id", "ts", "ok"), str(tmp_path / "out"), str(tmp_path / "cp"))
            assert sorted(r["paper_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
        time.sleep(1)
    finally:
        spark.streams.removeListener(listener)
    assert seen and seen[-1][0] == 6
    more = [("p", "poster_parsed", True, 1), (None, "x", True, 2)]
    spark.createDataFrame(more, "paper_id string, stage string, success boolean, ts int").write.parquet(str(tmp_path / "u"))
    for _ in range(2):
        ready.follow_tracker(ready.file_stream(spark, str(tmp_path / "u"), "paper_id string, stage string, success boolean, ts int"), str(tmp_path / "log"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1


def test_python_json(spark):
    records = [{"a": [1, None, 2.5], "b": {"é": "中\n", "c": []}}, {}, [1, "x"]]
    rows = spark.createDataFrame([(i, json.dumps(r, ensure_ascii=False, separators=(",", ":"))) for i, r in enumerate(records)] + [(9, None)], "i int, t string")
    for indent in (None, 2):
        got = {r["i"]: r["j"] for r in rows.select("i", jsonx.python_json(indent)("t").alias("j")).collect()}
        assert got == {i: json.dumps(r, indent=indent) for i, r in enumerate(records)} | {9: None}


def test_strip_unicode(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = ["".join(blanks) + "a b" + "".join(reversed(blanks)), "\u200bx", "", " ", "x"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(jsonx.stripped(F.col("t"))).collect()]
    assert got == [t.strip() for t in texts]


def test_layout_json_order(spark):
    rows = spark.createDataFrame([("p", "x.png", '{"poster": {"orientation": "portrait"}, "sections": [{"id": 1}]}'), ("q", None, "{}")], "id string, path string, layout string")
    out = [json.loads(r[0]) for r in rows.select(jsonx.layout_json(F.col("id"), F.col("path"), F.col("layout"))).collect()]
    assert list(out[0])[:3] == ["paper_id", "poster_path", "poster"] and out[0]["poster"] == {"orientation": "portrait", "aspect_ratio": "16:9", "background": "#FFFFFF"}
    assert out[0]["sections"] == [{"id": 1}] and out[1]["figures"] == [] and out[1]["header"] == {} and out[1]["reading_order"] == "columns-left-to-right"


def test_json_is_whole(spark):
    texts = ['{"a":1}', '{"a":1} x', '{"a":1} {"b":2}', "5", "1,2", "", " [1] ", '"s"', '{"a":', "5] junk", None]
    got = [r[0] is not None for r in spark.createDataFrame([(t,) for t in texts], "t string").select(jsonx.json_or_null(F.col("t"))).collect()]
    assert got == [True, False, False, True, False, False, True, True, False, False, False]


def test_figures_and_posters(spark, tmp_path):
    docs = spark.createDataFrame([("d", bytearray(b"ok")), ("e", bytearray(b"!"))], "path string, content binary")

    def extract(content):
        if content == b"!":
            raise ValueError
        return [(0, 200, 50, b"a"), (0, 120, 120, b"b"), (1, 300, 300, b"c")]

    from quarrymill.operators import figures

    found = figures.numbered_figures(connectors.extracted_figures(docs, extract), "path", "page", "idx")
    assert {r["figure_id"]: bytes(r["image"]) for r in found.collect()} == {"d_fig_1": b"b", "d_fig_2": b"c"}
    for name in ("a.png", "b.jpg"):
        (tmp_path / name).write_bytes(name.encode())
    rows = [("same", 1, f"{tmp_path}/a.png", f"{tmp_path}/b.jpg", "why"), ("odd", 1, f"{tmp_path}/b.jpg", f"{tmp_path}/a.png", None)]
    files.copy_matches(spark.createDataFrame(rows, "verdict string, number int, poster_path string, paper_path string, reasoning string"), str(tmp_path / "out"))
    assert sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*.*")) == ["same/match_01_paper.jpg", "same/match_01_poster.png", "same/match_01_reasoning.txt", "uncertain/match_01_paper.png", "uncertain/match_01_poster.jpg"]

    def make():
        def call(q):
            if q == "boom":
                raise connectors.CallError(400)
            return {"p": '---CONTENT---\nhi\n---LAYOUT---\n{"sections": []}', "v": '{"verdict": "same", "confidence": 0.9}'}[q]

        return call

    posters = {r["q"]: (r["content"], r["layout"], r["error"] is None) for r in connectors.described_posters(spark.createDataFrame([("p",), ("boom",)], "q string"), "q", make).collect()}
    assert posters == {"p": ("hi", '{"sections": []}', True), "boom": (None, None, False)}
    pairs = {r["q"]: (r["verdict"], r["level"]) for r in connectors.compared_figures(spark.createDataFrame([("v",), ("boom",)], "q string"), "q", make).collect()}
    assert pairs == {"v": ("same", "high"), "boom": (None, None)}
    assert spark.createDataFrame([("x",)], "t string").select(scan.poster_markdown(F.col("t"))).first()[0] == "# Poster Content\n\nx"


def test_orders_and_literals(spark):
    rows = spark.range(50)
    assert sorted(r[0] for r in tables.shuffled(rows).collect()) == list(range(50)) and tables.shuffled(rows, 1).collect() == tables.shuffled(rows, 1).collect()
    papers = evaluate.samples(evaluate.literal_samples(spark), "id", "content").orderBy("sample_id").collect()
    assert [r["title"] for r in papers] == [p[1] for p in evaluate.LITERAL_PAPERS] and papers[0]["abstract"].startswith("We count words.")
