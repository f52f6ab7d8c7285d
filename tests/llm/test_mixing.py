"""The mix against an iterative water-fill and a plain walk in hash order."""

import random

import pytest

from quarrymill.llm import common, mixing


def brute(rows, weights=(1, 2, 3), most=3):
    """source -> target size: shares by weight, sources above their cap clamped and the rest shared anew."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > most * sizes[s]}
        if not over:
            return sizes, target | {s: share * weight[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over
    return sizes, target


def held(rows, plan):
    sizes, target = brute(rows)
    taken = {}
    for r in plan:
        taken.setdefault(r["source"], []).append((r["size"], r["taken"]))
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["size"] * r["repeats"] <= 3 * r["size"]
    for source, own in taken.items():
        assert abs(sum(t for _, t in own) - target[source]) <= max(n for n, _ in own)


def test_plan(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "", "one two", "w " * rng.randrange(1, 300)]), rng.choice(["hot", "hot", "hot", None, "é", "z", "A", f"s{rng.randrange(6)}", "none"])) for i in range(3000)]
    rows = [(i, None if s == "none" else t, s) for i, t, s in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(docs)
    first = sorted(map(tuple, plan.collect()), key=repr)
    assert len(first) == 3000
    held(rows, plan.collect())
    assert sorted(map(tuple, mixing.mix_plan(docs.repartition(3)).collect()), key=repr) == first


def test_many_sources_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice(["hot", f"s{i % 200}", None])) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    held(rows, mixing.mix_plan(docs).collect())


def test_repeated_ids_and_names(spark):
    """Rows of one id share a decision; clashing and dotted names are kept."""
    rows = [(7, "a b c", "x", 1, 2) if i < 50 else (i, "a b c", "y", i, i) for i in range(120)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", "a.b", "__mix_n"]).withColumnRenamed("source", "u")
    out = mixing.mixed(docs, source_col="u")
    assert out.columns == docs.columns
    got = out.collect()
    assert len([r for r in got if r["doc_id"] == 7]) % 50 == 0
    assert all(r["a.b"] == r["__mix_n"] for r in got if r["doc_id"] != 7)
    assert mixing.mixed(docs.limit(0), source_col="u").count() == 0
