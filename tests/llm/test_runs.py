"""Line runs and repeated windows against brute force, with hot keys and long texts."""

import random

import numpy as np
import pytest

from quarrymill.llm import common, lines, substrings


def brute_runs(rows, least):
    """(id -> kept text, id -> maximal runs) when later copies of runs of `least` lines go."""
    seen, kept, runs = set(), {}, {}
    for i, text in sorted(rows):
        every = text.split("\n")
        part = [k for k, x in enumerate(every) if x.strip()]
        gone = [False] * len(part)
        for s in range(len(part) - least + 1):
            key = tuple(every[k] for k in part[s : s + least])
            if key in seen:
                gone[s : s + least] = [True] * least
            seen.add(key)
        kept[i] = "\n".join(x for k, x in enumerate(every) if k not in {p for p, g in zip(part, gone, strict=True) if g})
        edges = [k for k in range(len(part) + 1) if (k < len(part) and gone[k]) != (k > 0 and gone[k - 1])]
        runs[i] = list(zip(edges[::2], edges[1::2], strict=True))
    return kept, runs


@pytest.fixture(scope="module")
def line_rows():
    """Texts of few different lines: many repeats of all lengths, copies, one very common line, empty lines."""
    rng = random.Random(11)
    texts = ["\n".join(rng.choice("abcdefg  ") for _ in range(rng.choice([0, 1, 3, 8, 20, 60]))) for _ in range(60)]
    texts += [texts[7]] * 30 + ["a\n" * 90, "\n".join(texts[k] for k in (3, 4, 5))]
    return list(enumerate(texts))


@pytest.mark.parametrize("least", [1, 2, 3, 8])
def test_line_runs(spark, line_rows, least):
    kept, runs = brute_runs(line_rows, least)
    docs = spark.createDataFrame(line_rows, "doc_id long, text string").repartition(7)
    assert {r["doc_id"]: r["text"] for r in lines.deduplicated(docs, least).collect()} == kept
    got = {}
    for r in lines.repeated_runs(docs, least).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["start"] + r["n_lines"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in runs.items() if v}


def test_line_names_and_nulls(spark):
    """Clashing and dotted names, a null id, an id with two texts."""
    rows = [(1, "a\nb", 1, 2), (2, "a\nb\nc", 3, 4), (None, "a\nb", 5, 6), (3, "x\ny", 7, 8), (3, "z\nx\ny", 9, 9), (4, None, 0, 0)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "a.b", "__starts"]).withColumnRenamed("text", "runs")
    out = lines.deduplicated(docs, text_col="runs")
    assert out.columns == docs.columns
    got = sorted(map(tuple, out.collect()), key=repr)
    assert (1, "a\nb", 1, 2) in got and (2, "c", 3, 4) in got and (None, "a\nb", 5, 6) in got and (4, None, 0, 0) in got
    assert sum(len(r[1] or "") for r in got if r[0] == 3) == 4  # x, y and z stay once


def brute_windows(rows, w):
    seen, out = set(), {}
    for i, text in sorted(rows):
        x = text.split()
        gone = [False] * len(x)
        for s in range(len(x) - w + 1):
            k = " ".join(x[s : s + w])
            if k in seen:
                gone[s : s + w] = [True] * w
            seen.add(k)
        out[i] = (len(x), sum(gone), " ".join(a for a, g in zip(x, gone, strict=True) if not g))
    return out


def test_windows_of_few_words(spark, monkeypatch):
    """Runs, periods and near copies, in slices shorter than the texts and batches of few texts."""
    rng = random.Random(5)
    texts = []
    for n in (0, 3, 19, 20, 21, 60, 300, 900):
        texts += [" ".join(rng.choice("ab") for _ in range(n)), " ".join(rng.choice(["x", "y", "zz", "w w w"]) for _ in range(n)), "ab " * n]
    base = [f"w{rng.randrange(400)}" for _ in range(500)]
    for _ in range(40):
        at = rng.randrange(400)
        texts.append(" ".join([*base[:at], f"q{rng.random()}", *base[at + rng.randrange(3) :]]))
    texts += [texts[-1]] * 20
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.deduplicated(docs).collect()}
    assert got == brute_windows(rows, 20)


def test_windows_leave_no_shuffles(spark):
    """What the tables of the repeats shuffled is gone once they are written; the setting is as before."""

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in (found.apply(i).getName() for i in range(found.size())) if x.startswith("shuffle_")}

    rows = [(i, " ".join(f"w{(i // 3) * k}" for k in range(60 + i))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "hash(text) AS v", "text").repartition(4)
    before = files()
    found = substrings.repeats(docs)
    assert files() <= before and spark.conf.get(common._CLEANUP, "false") == "false"
    assert len({r["doc_id"] for r in found.collect()}) == sum(n > 0 for _, n, _ in brute_windows(rows, 20).values())


def test_slices_overlap_by_a_window(monkeypatch):
    monkeypatch.setattr(substrings, "SLICE", 200)
    rng = random.Random(6)
    texts = ["", "one", " ".join("x" * rng.randrange(1, 60) for _ in range(400)), "  " + "y" * 900 + " \n z " * 300, "v" * 1000]
    seen = [[] for _ in texts]
    for numbers, parts, bases in substrings._slices([t.encode() for t in texts], 5):
        for k, part, base in zip(numbers, parts, bases, strict=True):
            w = part.split()
            seen[k] += [(base + s, b" ".join(w[s : s + 5])) for s in range(len(w) - 4)]
    for text, found in zip(texts, seen, strict=True):
        w = text.encode().split()
        assert found == [(s, b" ".join(w[s : s + 5])) for s in range(len(w) - 4)]


def test_anchor_depends_on_the_window_only():
    """A window of random words has the same anchor name, at the same offset, in all surroundings."""
    rng = random.Random(9)
    for size in (3, 50, 1000):
        for _ in range(200):
            window = [f"w{rng.randrange(size)}" for _ in range(20)]
            found = set()
            for _ in range(4):
                before = [f"w{rng.randrange(size)}" for _ in range(rng.randrange(9))]
                text = " ".join([*before, *window, *(f"w{rng.randrange(size)}" for _ in range(9))])
                name, full, _, at, count = substrings.anchor_rows(substrings.Words.of([text.encode()]), np.zeros(1, np.int64), 20, 2)
                row = int(np.flatnonzero((at <= len(before)) & (len(before) < at + count))[0])
                found.add(int(name[row]))
            assert len(found) == 1


def test_ranked(spark):
    """Ranks and later places over many ranges, with one common key."""
    rng = random.Random(4)
    rows = [(rng.choice([7, 7, 7, rng.randrange(400)]), rng.randrange(2), i // 3, 0, i % 3) for i in range(4000)]
    df = common.written(spark.createDataFrame(rows, "a long, b long, doc_id long, v int, i int").repartition(9), "ranked-test")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["doc_id"], r["v"], r["i"]): (r["rank"], r["later"]) for r in common.ranked(df, ("a", "b"), ["doc_id", "v", "i"], "ranked-test").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = {}
    for a, b, *place in rows:
        groups.setdefault((a, b), []).append(tuple(place))
    want = {p: (rank, p != min(places)) for rank, (_, places) in enumerate(sorted(groups.items())) if len(places) > 1 for p in places}
    assert {p: x[1] for p, x in got.items()} == {p: x[1] for p, x in want.items()}
    order = sorted({x[0] for x in got.values()})
    ours = {r: k for k, r in enumerate(order)}
    theirs = {r: k for k, r in enumerate(sorted({x[0] for x in want.values()}))}
    assert {p: ours[x[0]] for p, x in got.items()} == {p: theirs[x[0]] for p, x in want.items()}
