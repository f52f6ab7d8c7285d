"""Nested records: order of fields, defaults, nulls, round trips; the nearest two exactly and by projections."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymill.functions import records
from quarrymill.operators import figures


def test_round_trips(spark):
    one = spark.range(1)
    fig = lambda i: records.record("figure", figure_id=F.lit(i), source_doc=F.lit("poster"), file_path=F.lit("p.png"), bbox=F.array(F.lit(1), F.lit(2)))
    match = records.record("match", poster_figure=fig("a"), paper_figure=fig("b"), feature_score=F.lit(1))
    doc = records.record("document", doc_id=F.lit(7), markdown_content=F.lit("# T\n\"q\""), figures=F.array(fig("c")), tables=F.array(F.parse_json(F.lit('{"rows": [1, null]}'))))
    layout = F.parse_json(F.lit('{"paper_id": "7", "sections": []}'))
    example = records.record("example", paper_id=F.lit("7"), paper_markdown=F.lit("m"), poster_layout=layout, poster_markdown=F.lit("p"), figure_matches=F.array(match))
    result = records.record("result", paper_id=F.lit("7"), success=F.lit(True), parsed_paper=doc, figure_matches=F.array(match))
    said = one.select(*(records.as_json(c).alias(k) for k, c in (("figure", fig("a")), ("match", match), ("document", doc), ("layout", layout), ("example", example), ("result", result)))).first()
    got = {k: json.loads(said[k]) for k in records.KINDS}
    figure = {"figure_id": "a", "source_doc": "poster", "file_path": "p.png", "bbox": [1.0, 2.0], "caption": None, "figure_type": None, "page_number": 1}
    assert got["figure"] == figure and list(got["figure"]) == list(figure)
    assert got["match"]["paper_figure"] == figure | {"figure_id": "b"} and got["match"]["vlm_reasoning"] is None and got["match"]["feature_score"] == 1.0
    assert got["document"] == {"doc_id": "7", "doc_type": None, "source_path": None, "markdown_content": '# T\n"q"', "figures": [figure | {"figure_id": "c"}], "tables": [{"rows": [1, None]}], "equations": [], "metadata": {}}
    assert got["example"]["poster_layout"] == {"paper_id": "7", "sections": []} and got["example"]["year"] == 0 and got["example"]["conference"] == "" and got["example"]["topics"] == []
    assert got["result"]["parsed_poster"] is None and got["result"]["parsed_paper"] == got["document"] and list(got["result"]) == ["paper_id", "success", "error", "parsed_poster", "parsed_paper", "figure_matches", "poster_layout"]
    for kind in records.KINDS:
        back = spark.createDataFrame([(said[kind],), ("no json {",), (None,)], "t string").select(records.as_json(records.loaded(kind, F.col("t"))).alias("j")).collect()
        assert json.loads(back[0]["j"]) == got[kind] and back[1]["j"] is None and back[2]["j"] is None
    made = one.select(records.training_format(example, F.lit("do")).alias("t")).first()["t"]
    assert (made["instruction"], made["input"]) == ("do", "m") and json.loads(made["output"]) == {"layout": got["example"]["poster_layout"], "content": "p", "figure_mapping": [{"paper_figure": "b", "poster_position": "a"}]}
    with pytest.raises(ValueError, match="has no"):
        records.record("figure", id=F.lit(1))


def test_nearest_two_keep_two(spark):
    """The rank's limit stands below the shuffle; results equal a brute force, with ties and single descriptors."""
    rng = np.random.default_rng(0)
    rows = [(k, s, i, rng.integers(0, 4, 3).astype(float).tolist()) for k in range(8) for s in (0, 1) for i in range(int(rng.integers(1, 9)))]
    t = spark.createDataFrame(rows, "key int, side int, id int, v array<double>")
    out = figures.nearest_ratio(t.where("side = 0").drop("side"), t.where("side = 1").drop("side"), "key")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan and "collect_list" not in plan
    got = {r["key"]: (r["good"], r["ratio"]) for r in out.collect()}
    for k in range(8):
        a, b = ([np.array(v) for kk, ss, _, v in rows if kk == k and ss == s] for s in (0, 1))
        good = 0
        if min(len(a), len(b)) >= 2:
            good = sum(d[0] < 0.49 * d[1] for d in (sorted(float(((x - y) ** 2).sum()) for y in b)[:2] for x in a))
        assert got[k] == (good, good / min(len(a), len(b)) if min(len(a), len(b)) >= 2 else 0.0)


def test_approximate_recall(spark):
    """Two nearest by projections: recall of at least 0.9 on 3,000 clustered vectors, distances exact, no pair twice."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((300, 16))
    right = centres[rng.integers(300, size=3000)] + 0.08 * rng.standard_normal((3000, 16))
    left = right[rng.choice(3000, 60, replace=False)] + 0.02 * rng.standard_normal((60, 16))
    frames = [spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "id long, v array<double>") for m in (left, right)]
    rows = figures.nearest_approximate(*frames, dim=16).collect()
    exact = ((left[:, None, :] - right[None, :, :]) ** 2).sum(axis=2)
    want = {(i, int(j)) for i in range(60) for j in np.argsort(exact[i], kind="stable")[:2]}
    got = {(r["l_id"], r["r_id"]) for r in rows}
    assert len(got) == len(rows) and all(r["d"] == pytest.approx(exact[r["l_id"], r["r_id"]]) for r in rows)
    assert len(got & want) >= 0.9 * len(want)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 20_000])
def test_shuffle_of_blocks(spark, n):
    """The list's own shuffle, from states of blocks and pointers."""
    from quarrymill.operators import prepare

    got = prepare.mersenne_places(spark, n, 42, block=max(1, n // 5)).orderBy("shuffled").collect()
    assert [r["from"] for r in got] == prepare.mersenne_order(n, 42) and [r["shuffled"] for r in got] == list(range(n))
