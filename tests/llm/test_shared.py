"""What the operators share: scratch scopes of threads, trigram queries of patterns that ignore the case."""

import os
import threading

from quarrymill.llm import common, secrets


def test_scopes_are_a_threads_own(spark):
    begun, may_end, paths = threading.Event(), threading.Event(), {}

    def other():
        with common.scratch(spark):
            paths["other"] = common.scratch_path(spark, "other")
            spark.range(3).write.parquet(paths["other"])
            begun.set()
            may_end.wait(60)
            assert spark.read.parquet(paths["other"]).count() == 3
        paths["ended"] = True

    thread = threading.Thread(target=other)
    with common.scratch(spark):
        thread.start()
        begun.wait(60)
        paths["mine"] = common.scratch_path(spark, "mine")
        spark.range(2).write.parquet(paths["mine"])
        with common.scratch(spark):
            inner = common.scratch_path(spark, "inner")
            spark.range(1).write.parquet(inner)
        assert not os.path.exists(inner.removeprefix("file://"))
        assert spark.read.parquet(paths["mine"]).count() == 2
    assert os.path.exists(paths["other"].removeprefix("file://")) and not os.path.exists(paths["mine"].removeprefix("file://"))
    may_end.set()
    thread.join()
    assert paths["ended"] and not os.path.exists(paths["other"].removeprefix("file://"))


def test_case_beyond_ascii(spark):
    rules = {"key": (r"(?i)secret\d+", 0, 1), "plain": (r"(?ia)secret\d+", 0, 1)}
    assert secrets.trigram_query(rules["key"][0]) is True and secrets.trigram_query(rules["plain"][0]) is not True
    docs = spark.createDataFrame([(1, "ſecret42"), (2, "SECRET7"), (3, "none")], "doc_id long, text string")
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["secrets"]] for r in secrets.scan(docs, rules).collect()}
    assert found == {1: [("key", 0, 8)], 2: [("key", 0, 7), ("plain", 0, 7)], 3: []}


def test_common_texts_of_media(spark, monkeypatch):
    """A text that most rows have is joined apart from the others; every row gets what a brute force gives it."""
    from quarrymill.llm import media

    monkeypatch.setattr(media, "HOT_ROWS", 2)
    texts = ["same"] * 40 + ["twice"] * 2 + [f"own {i}" for i in range(30)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in media.media_columns(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        payload = media.payload_of((text or "").encode())
        assert (got[i]["n_bytes"], got[i]["payload_bytes"], got[i]["digest"]) == (len((text or "").encode()), len(payload), media.hashlib.sha256(payload).hexdigest())
    assert media.media_columns(docs.limit(0)).count() == 0
