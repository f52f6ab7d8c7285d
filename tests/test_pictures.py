"""Pictures of any shape scaled to samples, and descriptors matched in blocks."""

import numpy as np
from pyspark.sql import functions as F

from quarrymill.functions import images


def test_good_matches_in_blocks():
    rng = np.random.default_rng(0)
    p, q = rng.integers(0, 256, (700, 16)), rng.integers(0, 256, (300, 16))
    p[:50] = q[:50]
    d = np.sqrt(((p[:, None, :] - q[None, :, :]) ** 2).sum(axis=2).astype(float))
    two = np.sort(d, axis=1)[:, :2]
    assert images.good_matches(p, q) == images.good_matches(p, q, block=7) == int((two[:, 0] < 0.7 * two[:, 1]).sum()) >= 50


def test_resized(spark):
    gray = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert (images.resized(gray.repeat(5, axis=0).repeat(6, axis=1)[:, :24], 1) == round(gray.mean())).all()
    assert (images.resized(np.kron(gray[:3, :3], np.ones((4, 4), np.uint8)), 3) == gray[:3, :3]).all()
    assert images.resized(gray, 8).shape == (8, 8)
    rng = np.random.default_rng(1)
    picture = rng.integers(0, 256, (60, 90), dtype=np.uint8)
    rows = [(picture.tobytes(), 90, np.kron(picture, np.ones((2, 2), np.uint8)).tobytes(), 180), (None, 3, b"abc", 2), (b"", 1, b"ab", None)]
    t = spark.createDataFrame(rows, "a binary, wa int, b binary, wb int")
    scaled = t.select(images.grey_samples(32)("a", "wa").alias("a"), images.grey_samples(32)("b", "wb").alias("b"))
    got = scaled.withColumn("score", images.ssim_score(32)("a", "b")).collect()
    assert len(got[0]["a"]) == 1024 and got[0]["score"] > 0.999 and [r["score"] for r in got[1:]] == [None, None]
