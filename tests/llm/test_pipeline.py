"""The pipeline's own stages against brute force."""

import random

import pytest

import corpus_pipeline
from quarrymill.llm import pieces, quality, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    x = (text or "").lower().split()
    return {tuple(x[j : j + 5]) for j in range(max(1, len(x) - 4))} if x else set()


def brute_near(rows, least=0.8):
    """The ids that stay: the first of each component of the pairs of Jaccard `least`."""
    sets = {i: shingles(text) for i, text in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                a, b = sets[i], sets[j]
                if root[j] < root[i] and (a == b or len(a & b) >= least * len(a | b)):
                    root[i], changed = root[j], True
    return {i for i in ids if root[i] == i}


@pytest.fixture(scope="module")
def near_rows():
    """40 texts with copies of 1 to 12 changed words (Jaccard 0.4 to 0.97), and odd texts."""
    rng = random.Random(7)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "two words"), (4, "Two  WORDS"), (5, "one more short text")]
    for base in range(40):
        text = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((len(rows), " ".join(text)))
        for changes in rng.sample(range(1, 13), 3):
            copy = list(text)
            for at in rng.sample(range(len(copy)), changes):
                copy[at] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_near_stage(spark, near_rows):
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in near_rows], DOCS)
    want = brute_near(near_rows)
    assert len(want) < len(near_rows) - 60
    assert {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()} == want
    assert corpus_pipeline.near_stage(spark, docs.limit(0), "").count() == 0


def test_near_stage_large_group(spark):
    """A group whose members are near its first text, but mostly not near each other."""
    rng = random.Random(8)
    text = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(text))]
    for i in range(1, 200):
        copy = list(text)
        for at in rng.sample(range(len(copy)), rng.randrange(1, 6)):
            copy[at] = f"x{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS)
    assert {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()} == brute_near(rows)


def brute_lines(rows, long_words=50):
    """Texts without later copies of runs of two lines, of long lines and of whole texts."""
    seen, texts, out = set(), set(), {}
    for i, text in rows:
        lines = (text or "").split("\n")
        part = [k for k, x in enumerate(lines) if x.strip()]
        long = [k for k in part if len(lines[k].split()) >= long_words]
        gone = set()
        if text in texts:
            gone.update(part if len(part) > 1 else long)
        else:
            for k in long:
                gone.update({k} if lines[k] in seen else ())
                seen.add(lines[k])
            for a, b in zip(part, part[1:], strict=False):
                gone.update({a, b} if (lines[a], lines[b]) in seen else ())
                seen.add((lines[a], lines[b]))
        texts.add(text)
        out[i] = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_line_stage(spark):
    passage, other = " ".join(f"p{i}" for i in range(50)), " ".join(f"q{i}" for i in range(49))
    rows = [
        (1, f"a\n{passage}\nb"), (2, f"c\n\n{passage}\nd"), (3, f"e\n{other}\nf"), (4, f"g\n{other}\nh"), (5, passage), (6, passage),
        (7, other), (8, other), (9, f"{passage}\nx\n{passage}\ny\nx"), (10, "c\nd\ne\na\nb\nx\ny"), (11, "x\ny\nx"), (12, "x\ny\nx"), (13, None), (14, ""), (15, "a"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], DOCS)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_stage(spark, docs, "").collect()}
    assert got == brute_lines(rows)
    assert passage not in got[2] and other in got[4] and got[6] == "" and got[8] == other


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """source -> target size: shares by weight, sources above their cap clamped and the rest shared anew."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over
    return target


def held_to_mix(taken, docs):
    """taken: doc_id -> times; docs: doc_id -> (text, source). Each source is at its target but for less than a document."""
    n = {i: len((t or "").split()) for i, (t, _) in docs.items()}
    sizes = {}
    for i, (_, source) in docs.items():
        sizes[source] = sizes.get(source, 0) + n[i]
    for source, target in brute_targets(sizes).items():
        own = [i for i in docs if docs[i][1] == source]
        rate = target / sizes[source] if sizes[source] else 0
        assert all(int(rate - 1e-9) <= taken.get(i, 0) <= int(rate + 1e-9) + 1 for i in own)
        assert abs(sum(taken.get(i, 0) * n[i] for i in own) - target) <= max(n[i] for i in own)


@pytest.fixture(scope="module")
def small(spark, near_rows, tmp_path_factory):
    """Planted near copies, passages, junk, nulls, a hot source and a null source, with labels of a third: junk is bad."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [*near_rows, *((1000 + i, f"head {i}\n{passage}\ntail {i} " + " ".join(f"z{i}x{k}" for k in range(30))) for i in range(20))]
    rng = random.Random(9)
    rows += [(2000 + i, " ".join(f"$$${rng.choice(['BUY', 'NOW', 'WIN', 'FREE'])}!!{rng.randrange(900)}###" for _ in range(60))) for i in range(60)]
    rows = [(i, t, "en", [None, "b", "c", "d", "e"][i % 5] if i % 3 == 0 else "a", len(t or "")) for i, t in rows]
    folder = str(tmp_path_factory.mktemp("small"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int(r[0] < 2000), 0) for r in rows if r[0] % 3 == 1]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def counted(rows):
    out = {}
    for r in rows:
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + 1
    return out


def test_quality_stage(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    scored = quality.score(docs, quality.train(docs, spark.read.parquet(f"{small}/labels.parquet"))).collect()
    drop = {r["doc_id"] for r in scored if r["keep"] is False}
    got = corpus_pipeline.quality_stage(spark, docs, small).collect()
    # The junk goes, and of the rest only what has next to no text may.
    assert drop >= set(range(2000, 2060)) and all(len(r["text"] or "") < 50 for r in docs.collect() if r["doc_id"] in drop and r["doc_id"] < 2000)
    assert drop and sorted(map(repr, got)) == sorted(repr(r) for r in docs.collect() if r["doc_id"] not in drop)


def test_mix_stage(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held_to_mix(counted(corpus_pipeline.mix_stage(spark, docs, small).collect()), {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect()})


def test_run(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = sorted(corpus_pipeline.quality_stage(spark, docs, small).collect(), key=lambda r: r["doc_id"])
    texts = brute_lines([(r["doc_id"], r["text"]) for r in kept])
    stay = brute_near(list(texts.items()))
    out = corpus_pipeline.run(spark, small)
    held_to_mix(counted(out.select("doc_id").collect()), {r["doc_id"]: (texts[r["doc_id"]], r["source"]) for r in kept if r["doc_id"] in stay})
    assert {r["doc_id"] for r in out.select("doc_id").collect()} <= stay
    assert all(r["text"] == texts[r["doc_id"]] for r in pieces.decode(out.select("doc_id", "ids")).collect())
    assert out.where("n_tokens <> size(ids)").count() == 0


def test_simhash_deduplicated(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r["doc_id"] for r in simhash.near_duplicates(docs).collect() if r["doc_id"] == r["component_id"]}
    assert {r["doc_id"] for r in simhash.deduplicated(docs).collect()} == want


def test_stages_keep_any_columns(spark, small):
    """Further columns with clashing and dotted names go through all stages; null ids, long texts and repeated rows too."""
    rows = [(None, "a b c\nd e f", "en", "s", 3), (1, None, None, None, None), (1, None, None, None, None), (2, "x y z\n" * 3, "en", "s", 9), (3, " ".join(f"w{i}" for i in range(60_000)), "de", "t", 9), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame([(*r, k, k, k, k) for k, r in enumerate(rows)], DOCS + ", `a.b` int, __near_id int, __q_id int, runs int")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns
        got = out.collect()
        assert all(r["a.b"] == r["__near_id"] == r["__q_id"] == r["runs"] for r in got)
    assert corpus_pipeline.line_stage(spark, docs, small).where("doc_id = 3").first()["text"] == rows[4][1]
    assert pieces.decode(corpus_pipeline.token_stage(spark, docs, small)).where("doc_id = 3").first()["text"] == rows[4][1]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), small).count() == 0
