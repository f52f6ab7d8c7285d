"""Co-training: counts against brute force, rounds that change the model without harm, views apart, odd rows."""

import random
import zlib

import numpy as np
import pytest

from quarrymill.llm import quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    """Good and bad texts by their words; the source tells the class most of the time, so that both views can teach."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        good = i % 2
        words = ["plain", "sensible", "writing", "here"] if good else ["zzxq", "!!buy", "$$$", "qqkw"]
        source = ("journal" if good else "spam") if rng.random() < 0.97 else "mixed"
        rows.append((i, " ".join(rng.choice(words + ["the", "of"]) for _ in range(40)), "en", source, 200))
        if i < 160:
            labels.append((i, good))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int")


def accuracy(out):
    return sum(r["keep"] == bool(r["doc_id"] % 2) for r in out) / len(out)


def test_rounds(corpus):
    docs, labels = corpus
    before, after = (quality.train(docs, labels, rounds=n, confident=0.8) for n in (0, 2))
    assert after.content.counts.sum() > before.content.counts.sum() and after.meta.counts.sum() > before.meta.counts.sum()
    a, b = (accuracy(quality.score(docs, m).where("doc_id >= 160").collect()) for m in (before, after))
    assert b >= a >= 0.95


def test_counts(corpus):
    """The labelled rows' trigram counts by class."""
    docs, labels = corpus
    model = quality.train(docs, labels, rounds=0)
    want = np.zeros((2, quality.CONTENT_DIM), np.int64)
    rows = quality._labelled(quality._picked(docs, "doc_id", "text", "source", "lang", "n_chars"), labels.withColumnRenamed("quality", "label"), 8000)
    for r in rows.collect():
        text = r["text"].encode()
        for k in range(len(text) - 2):
            code = int.from_bytes(text[k : k + 3], "big") * 2654435761 % (1 << 32) >> 17
            want[r["label"], code] += 1
    assert (model.content.counts == want).all()


def test_metadata_does_not_read_the_text(corpus):
    docs, labels = corpus
    model = quality.train(docs, labels)
    score = lambda d: {r["doc_id"]: r["metadata_logit"] for r in quality.score(d, model).collect()}
    assert score(docs) == score(docs.selectExpr("doc_id", "'other' AS text", "lang", "source", "n_chars"))
    assert {r["content_logit"] for r in quality.score(docs.selectExpr("doc_id", "'same' AS text", "lang", "source", "n_chars"), model).collect()} == {quality.score(docs.selectExpr("1L AS doc_id", "'same' AS text"), model).first()["content_logit"]}


def test_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fit, rest = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    out = quality.score(docs, quality.train(docs, fit)).join(rest.select("doc_id", "quality").withColumnRenamed("quality", "truth"), "doc_id").collect()
    assert sum(r["keep"] == bool(r["truth"]) for r in out) >= 0.9 * len(out)
    assert quality.score(docs, quality.train(docs, labels.limit(0))).where("NOT keep").count() == 0


@pytest.mark.parametrize("good", [2, 40, 60, 99])
def test_labels_without_meaning(spark, good):
    """Labels by chance teach nothing, whatever their share: no document goes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(good)
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    labels = spark.createDataFrame([(i, int(rng.random() * 100 < good)) for i in ids], "doc_id long, quality int")
    assert quality.train(docs, labels) is None
    assert quality.filtered(docs, labels).count() == len(ids)


def test_pseudo_labels_and_curves(corpus):
    """A round by hand: who is confident, whom that teaches, the counts that follow, and the curves of other folds' models."""
    docs, labels = corpus
    first, second = (quality.train(docs, labels, rounds=n, confident=0.8) for n in (0, 1))
    known, edge = {r["doc_id"] for r in labels.collect()}, np.log(0.8 / 0.2)
    scored = {r["doc_id"]: r for r in quality.score(docs, first).collect()}
    content, meta = first.content.counts.copy(), first.meta.counts.copy()
    taught = 0
    for r in docs.collect():
        if r["doc_id"] in known:
            continue
        c, m = scored[r["doc_id"]]["content_logit"], scored[r["doc_id"]]["metadata_logit"]
        if abs(m) > edge:
            np.add.at(content[int(m > 0)], quality.trigram_codes(r["text"].encode()), 1)
            taught += 1
        if abs(c) > edge:
            np.add.at(meta[int(c > 0)], quality.meta_features(r["source"], r["lang"], r["n_chars"]), 1)
    assert taught and (second.content.counts == content).all() and (second.meta.counts == meta).all()
    # The content's curve, fitted by hand on each labelled row's score without its own fold.
    rows = quality._labelled(quality._picked(docs, "doc_id", "text", "source", "lang", "n_chars"), labels.withColumnRenamed("quality", "label"), 8000).collect()
    own = np.zeros((quality.FOLDS, 2, quality.CONTENT_DIM), np.int64)
    for r in rows:
        np.add.at(own[r["fold"], r["label"]], quality.trigram_codes(r["text"].encode()), 1)
    raw = sorted((quality.View(quality.CONTENT_DIM, content - own[r["fold"]]).weights()[quality.trigram_codes(r["text"].encode())].mean(), r["label"]) for r in rows)
    view = quality.View(quality.CONTENT_DIM)
    view.calibrate(np.array([x for x, _ in raw]), np.array([float(y) for _, y in raw]))
    assert (second.content.a, second.content.b) == (pytest.approx(view.a, rel=1e-6), pytest.approx(view.b, rel=1e-6))


def test_long_text_in_slices(spark, corpus, monkeypatch):
    docs, labels = corpus
    model = quality.train(docs, labels, rounds=0)
    text = " ".join(["plain", "zzxq"] * 400)
    whole = model.content.weights()[quality.trigram_codes(text.encode())].mean()
    monkeypatch.setattr(quality, "SLICE", 100)
    parts = np.concatenate([quality.trigram_codes(x) for x in quality._slices(text.encode())])
    assert model.content.weights()[parts].mean() == pytest.approx(whole)


def test_odd_rows(spark, corpus):
    _, labels = corpus
    model = quality.train(*corpus)
    rows = [(1, None, None, None, None), (2, "", "en", "x", 0), (2, "", "en", "x", 0), (None, "plain", "en", "journal", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = quality.score(docs, model).collect()
    assert len(out) == 4 and all(np.isfinite(r["quality"]) for r in out)
    assert quality.filtered(docs.withColumnRenamed("lang", "a.b").limit(0), labels).count() == 0
    assert zlib.crc32(b"0:None") % quality.META_DIM == quality.meta_features(None, None, None)[0]
