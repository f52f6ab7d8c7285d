"""Links of a bucket: both ways of counting intersections give the same, and a brute force's components."""

import random

import numpy as np
import pytest

from quarrymill.llm import common, nearsets


def components(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        label = [label[a] if x == label[b] else x for x in label]
    return [min(i for i in range(n) if label[i] == label[k]) for k in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_both_ways_of_counting(seed, monkeypatch):
    rng = random.Random(seed)
    base = [rng.randrange(1 << 60) for _ in range(60)]
    sets = []
    for i in range(80):
        own = set(rng.sample(base, rng.randrange(45, 60))) | {rng.randrange(1 << 60) for _ in range(rng.randrange(6))}
        sets.append(np.array(sorted(own if i % 9 else {i}), np.uint64))
    fps = np.arange(len(sets)) * 7 - 100
    pairs = [(a, b) for a in range(80) for b in range(a) if len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b]))]
    want = components(80, pairs)
    by_bits = nearsets.set_links(fps, sets)
    monkeypatch.setattr(nearsets, "MOST_BITS", 0)
    by_places = nearsets.set_links(fps, sets)
    place = {int(f): i for i, f in enumerate(fps)}
    for links in (by_bits, by_places):
        assert components(80, [(place[u], place[v]) for u, v in links]) == want
    assert sorted(by_bits) == sorted(by_places)


def test_large_bucket_in_bounded_memory():
    """40,000 near copies of one text, whose bits would take 1.5 GB: their sets take 100 MB."""
    rng = np.random.default_rng(3)
    base = rng.integers(1 << 62, size=300, dtype=np.uint64)
    more = rng.integers(1 << 62, size=300_000, dtype=np.uint64)
    sets = [np.concatenate([base, more[rng.integers(len(more), size=10)]]) for _ in range(40_000)]
    assert len(sets) * (300_000 // 64) * 8 > nearsets.MOST_BITS
    links = nearsets.set_links(np.arange(40_000), sets)
    assert len(links) == 39_999 and len({v for _, v in links}) == 39_999


def shuffled(spark):
    """Bytes that all shuffles so far wrote, and the sizes of the files of those that are still there."""
    store = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    there = {files.apply(i).getName(): files.apply(i).length() for i in range(files.size())}
    return sum(store.apply(i).totalShuffleWrite() for i in range(store.size())), {k: n for k, n in there.items() if k.startswith("shuffle_")}


def test_texts_without_copies_stay(spark, tmp_path):
    """No shuffle moves the texts that share no bucket, nothing broadcast but the bitmap; no shuffle's files outlast a written table."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"{rng.randrange(1 << 32):08x}" for _ in range(2000))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(0, 300, 30)]
    docs = spark.createDataFrame([(None, "no id"), (None, "no id"), *rows], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved, held = shuffled(spark)
        near = nearsets.near_duplicates(docs)
        own = {k: n for k, n in shuffled(spark)[1].items() if k not in held}
        assert sum(own.values()) < 100_000, own
        assert near.where("doc_id <> component_id").count() == 10
        out = nearsets.deduplicated(docs)
        out.write.parquet(f"{tmp_path}/out")
        moved = shuffled(spark)[0] - moved
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted([(-1, "no id"), (-1, "no id"), *rows[:300]])
    assert moved < sum(len(t) for _, t in rows)  # in two runs; each text once was 18.7 MB of 5.6
    assert spark.conf.get(common._CLEANUP) == "false"


@pytest.mark.parametrize("bits", [1 << 25, 1 << 18, 64])
def test_parted(spark, bits, monkeypatch):
    """All wanted rows are in some and each row in one of the two, also where the bitmap is full."""
    monkeypatch.setattr(common, "SIEVE_BITS", bits)
    keys = [None, *range(-500, 500)]
    for kind, of in (("long", lambda k: k), ("string", lambda k: None if k is None else f"k{k}"), ("double", lambda k: None if k is None else k / 3)):
        rows = spark.createDataFrame([(of(k), n, n, n) for n, k in enumerate([*keys, *keys])], f"`a.b` {kind}, bits int, part int, at int")
        for wanted in ([], [7], [*range(-500, 500, 3), None]):
            some, rest = common.parted(rows, "a.b", spark.createDataFrame([(of(k),) for k in wanted], f"w {kind}"))
            assert some.columns == rest.columns == rows.columns
            ids = [sorted(r["at"] for r in x.collect()) for x in (some, rest)]
            assert sorted(ids[0] + ids[1]) == list(range(2 * len(keys)))
            must = {n for n, k in enumerate([*keys, *keys]) if k is not None and k in wanted}
            assert must <= set(ids[0])
            if bits == 1 << 25 and None not in wanted:
                assert len(ids[0]) < len(must) + 10


def test_swept(spark):
    """A write inside leaves no shuffle files, and the setting is as before."""
    before = set(shuffled(spark)[1])
    with common.swept(spark):
        table = common.written(spark.range(20_000).repartition(5, "id").groupBy((common.F.col("id") % 7).alias("k")).count(), "swept")
    assert set(shuffled(spark)[1]) <= before
    assert sum(r["count"] for r in table.collect()) == 20_000 and spark.conf.get(common._CLEANUP) == "false"
