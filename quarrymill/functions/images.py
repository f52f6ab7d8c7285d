"""Scores of pictures as pandas UDFs over 8-bit grey samples. Decoding pictures is the caller's: no image library is needed."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

# The window and constants of the index of structural similarity.
WINDOW, K1, K2, LEVELS = 7, 0.01, 0.03, 255.0


def _windows(x: np.ndarray) -> np.ndarray:
    """Means over all windows inside the picture, by sums of sums."""
    s = np.pad(x.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    w = WINDOW
    return (s[w:, w:] - s[:-w, w:] - s[w:, :-w] + s[:-w, :-w]) / (w * w)


def structural_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The mean index over all windows of two pictures of one shape, with sample covariances."""
    a, b = a.astype(float), b.astype(float)
    n = WINDOW * WINDOW
    ma, mb = _windows(a), _windows(b)
    unbiased = n / (n - 1)
    va, vb, cab = (unbiased * (_windows(x * y) - mx * my) for x, y, mx, my in ((a, a, ma, ma), (b, b, mb, mb), (a, b, ma, mb)))
    c1, c2 = (K1 * LEVELS) ** 2, (K2 * LEVELS) ** 2
    index = ((2 * ma * mb + c1) * (2 * cab + c2)) / ((ma**2 + mb**2 + c1) * (va + vb + c2))
    return float(index.mean())


def ssim_score(size: int = 256):
    """A UDF of two columns of size x size grey samples (bytes); null where one is null or of another length."""

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            if x is None or y is None or len(x) != size * size or len(y) != size * size:
                return None
            return structural_similarity(*(np.frombuffer(v, np.uint8).reshape(size, size) for v in (x, y)))

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return score


def good_matches(p: np.ndarray, q: np.ndarray, ratio: float = 0.7, block: int = 256) -> int:
    """Rows of p whose nearest row of q is nearer than `ratio` of the second nearest; distances of a block of rows at a time."""
    p, q = p.astype(float), q.astype(float)
    lengths, good = (q * q).sum(axis=1), 0
    for lo in range(0, len(p), block):
        own = p[lo : lo + block]
        d = (own * own).sum(axis=1)[:, None] + lengths[None, :] - 2 * own @ q.T
        two = np.sqrt(np.maximum(np.partition(d, 1, axis=1)[:, :2], 0))
        good += int((two[:, 0] < ratio * two[:, 1]).sum())
    return good


def resized(gray: np.ndarray, size: int) -> np.ndarray:
    """A grey picture of any shape as size x size samples: the mean of what each sample covers, edges by their share."""
    def shares(n: int) -> np.ndarray:
        edge = np.linspace(0, n, size + 1)
        lo, hi = edge[:-1, None], edge[1:, None]
        at = np.arange(n)[None, :]
        cover = np.clip(np.minimum(hi, at + 1) - np.maximum(lo, at), 0, None)
        return cover / cover.sum(axis=1, keepdims=True)

    return np.clip(np.rint(shares(gray.shape[0]) @ gray.astype(float) @ shares(gray.shape[1]).T), 0, 255).astype(np.uint8)


def grey_samples(size: int = 256):
    """A UDF of (bytes of grey samples by rows, width) -> bytes of size x size samples, as ssim_score takes them; null where the width doesn't fit."""

    @F.pandas_udf("binary")
    def scale(samples: pd.Series, width: pd.Series) -> pd.Series:
        def one(x, w):
            if x is None or w is None or w != w or w < 1 or not len(x) or len(x) % int(w):
                return None
            return resized(np.frombuffer(x, np.uint8).reshape(-1, int(w)), size).tobytes()

        return pd.Series([one(x, w) for x, w in zip(samples, width, strict=True)], dtype=object)

    return scale


def feature_score(describe):
    """A UDF of two columns of pictures (bytes): the ratio of good nearest descriptors; describe(bytes) -> rows of a matrix or null. Errors give 0."""

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            try:
                p, q = describe(x), describe(y)
                if p is None or q is None or len(p) < 2 or len(q) < 2:
                    return 0.0
                return good_matches(p, q) / min(len(p), len(q))
            except Exception:  # noqa: BLE001 - an error is no match
                return 0.0

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return score


def perceptual_hash(gray: np.ndarray, size: int = 16) -> np.ndarray:
    """size * size bits: low frequencies of a cosine transform against their median."""
    n = gray.shape[0]
    k = np.arange(size)[:, None] * (2 * np.arange(n)[None, :] + 1) * np.pi / (2 * n)
    low = 2 * np.cos(k) @ gray.astype(float) @ (2 * np.cos(k)).T
    return (low > np.median(low)).ravel()
