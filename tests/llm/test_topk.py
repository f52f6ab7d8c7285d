"""Top-k search against all scores: clusters, ties, repeated ids, huge components, many shards."""

import random

import numpy as np
import pytest

from quarrymill.llm import balltree

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, asks, k, scale=64):
    ok = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(scale * x) for x in v)]
    ok = list({(i, tuple(v)) for i, v in ok})
    out = {}
    for q, own in ok:
        if asks(q):
            top = 1 << 63
            scored = sorted((-max(-top, min(top - 1, sum(a * b for a, b in zip(own, v, strict=True)))), i) for i, v in ok if i != q)[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.fixture
def small_shards(monkeypatch):
    for name, value in {"SHARD_ROWS": 60, "LEAST_ROWS": 20, "LEAF": 8, "QUERY_BLOCK": 16, "NEXT": 3}.items():
        monkeypatch.setattr(balltree, name, value)


def test_clusters(spark, small_shards):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 6)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=6) * 0.1).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(balltree.top_k(df, "vec_id % 7 = 0", k=5, tasks=24)) == brute(rows, lambda q: q % 7 == 0, 5)


def test_ties_of_one_common_vector(spark, small_shards):
    rng = random.Random(2)
    rows = [(i, [1.0, 0.5, 0.0]) for i in range(300)] + [(i, [rng.choice([0.0, 1.0, -1.0]) for _ in range(3)]) for i in range(300, 500)]
    rows += [(600, None), (601, [1.0, None, 0.0]), (602, [float("nan"), 1.0, 0.0]), (603, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (604, []), (605, [1e308, 0.0, 0.0]), rows[0]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(balltree.top_k(df, "vec_id % 20 = 0", tasks=10)) == brute(rows, lambda q: q % 20 == 0, 20)


def test_huge_components(spark, small_shards):
    rng = random.Random(3)
    rows = [(i, [rng.choice([1e30, -1e30, 1e9, 3.0, 0.5]), rng.choice([1e20, -2.0, 7e15])]) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(balltree.top_k(df, "vec_id % 4 = 0", k=7, tasks=6)) == brute(rows, lambda q: q % 4 == 0, 7)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], SCHEMA)
    assert found(balltree.top_k(df, "vec_id = 0")) == {0: [(1, 64 * 128)]}
    assert balltree.top_k(df.limit(0), "vec_id = 0").count() == 0
    with pytest.raises(ValueError, match="lengths"):
        balltree.top_k(df.union(spark.createDataFrame([(2, [1.0, 2.0])], SCHEMA)), "vec_id = 0")
