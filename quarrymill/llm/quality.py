"""Quality classifier by co-training on two views of a document.

The content view is the text's byte trigrams; the metadata view is what is known about the page without its text: source,
language, length as the table gives it, and each of these with the language. Each view has a naive Bayes model over hashed
features, whose score is the mean log ratio of its features, and a Platt curve fitted on the labelled documents' scores by
models of the other folds.

At first both are fitted on labelled rows, at most MAX_LABELLED of them in hash order. In a round Spark scores all other
documents; a document that one view is confident of teaches the other with that label, as summed feature counts, whose
size is the model's. In the end the calibrated log odds of both views are combined (the prior is counted once), and all
documents are scored. Where metadata says nothing about quality, its curve is flat: it then teaches nothing and the
combined odds are the content's. Where neither view says anything, nothing was learnt, and all documents stay.

Feature counts are summed in Spark, by class and fold; of the labelled rows only two scores each reach the driver.
A pass reads a text's trigrams as one array and looks their weights up, which costs less than reading written features.

Defined results: null text is empty; null metadata is a value of its own; null labels and labels of unknown
documents are ignored; without labels of both classes outside of each fold, or with labels that neither view can tell, every
document gets 0.5 and is kept; a document's score depends on its row only, so repeated rows agree; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import as_bytes, kept, pieces, written

CONTENT_DIM = 1 << 15
META_DIM = 1 << 12
#: The bound of the labelled sample.
MAX_LABELLED = 8000
#: Parts of the labelled sample: a part is scored by what the others teach.
FOLDS = 4
ROUNDS = 2
#: A view teaches the other where its probability is this far out.
CONFIDENT = 0.98
#: Log likelihood that a view's curve must gain to count.
GAIN = 2.0
#: Remembered features of metadata; the memory is emptied beyond it.
REMEMBERED = 1 << 16
#: Bytes of text that are scored at once; a longer text is read in slices of it.
SLICE = 1 << 20
_META = ["source", "lang", "length"]


def trigram_codes(text: bytes) -> np.ndarray:
    """The hashed feature of each byte trigram."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    return ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(17)


def _slices(text: bytes) -> Iterator[bytes]:
    """Slices that have each trigram once."""
    for lo in range(0, max(1, len(text) - 2), SLICE):
        yield text[lo : lo + SLICE + 2]


def meta_features(source: str | None, lang: str | None, length: int | None) -> np.ndarray:
    known, size = kept("metadata"), None if length is None else int(length).bit_length()
    if (source, lang, size) not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        values = [source, lang, size, (source, lang), (size, lang)]
        known[source, lang, size] = np.array([zlib.crc32(f"{i}:{v!r}".encode()) % META_DIM for i, v in enumerate(values)], np.int64)
    return known[source, lang, size]


@dataclass
class View:
    """Counts of features by class, and the Platt curve p = 1 / (1 + exp(-(a + b * score)))."""

    dim: int
    counts: np.ndarray = field(default=None)
    a: float = 0.0
    b: float = 1.0

    def __post_init__(self):
        if self.counts is None:
            self.counts = np.zeros((2, self.dim), np.int64)

    def weights(self) -> np.ndarray:
        # A feature's smoothing follows its share in both classes together.
        both = self.counts.sum(axis=0) + 0.5
        both = both / both.sum()
        p = (self.counts + 50.0 * both) / (self.counts.sum(axis=1, keepdims=True) + 50.0)
        return np.log(p[1] / p[0])

    def calibrate(self, scores: np.ndarray, labels: np.ndarray) -> None:
        """Newton steps of a logistic regression on the standardised score, with a penalty of 1 on its slope and Platt's softened labels.

        A curve that does not raise the log likelihood of the held-out labels by GAIN over that of their share is flat: its view says nothing.
        """
        n, up = len(labels), float(labels.sum())
        goal = np.where(labels > 0, (up + 1) / (up + 2), 1 / (n - up + 2))
        middle, spread = float(scores.mean()), float(scores.std()) or 1.0
        x = np.stack([np.ones(n), (scores - middle) / spread], axis=1)
        flat = float(np.log((up + 1) / (n - up + 1)))
        w, ridge = np.array([flat, 0.0]), np.diag([1e-6, 1.0])
        chance = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for _ in range(50):
            p = chance(x @ w)
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (goal - p) - ridge @ w)
            w = w + np.clip(step, -5, 5)
        likely = lambda z: float((labels * np.log(chance(z)) + (1 - labels) * np.log(1 - chance(z))).sum())
        if likely(x @ w) - likely(np.full(n, flat)) < GAIN:
            w = np.array([flat, 0.0])
        self.a, self.b = float(w[0] - w[1] * middle / spread), float(w[1] / spread)


@dataclass
class CoTrained:
    content: View
    meta: View
    prior: float

    def raw(self):
        """(part of a batch) -> mean weights by content and by metadata."""
        cw, mw = self.content.weights(), self.meta.weights()

        def score(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            by_content = np.zeros(part.num_rows)
            for i, text in enumerate(as_bytes(part, "text")):
                total, n = 0.0, 0
                for own in _slices(text):
                    w = cw[trigram_codes(own)]
                    total, n = total + float(w.sum()), n + len(w)
                by_content[i] = total / max(1, n)
            return by_content, np.array([mw[meta_features(*m)].mean() for m in _metadata(part)])

        return score

    def scorer(self):
        """(part of a batch) -> log odds by content, by metadata, and of both."""
        raw, c, m, prior = self.raw(), self.content, self.meta, self.prior

        def score(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rc, rm = raw(part)
            lc, lm = c.a + c.b * rc, m.a + m.b * rm
            return lc, lm, lc + lm - prior

        return score


def _metadata(part: pa.RecordBatch):
    return zip(*(part.column(c).to_pylist() for c in _META), strict=True)


def _picked(docs: DataFrame, id_col, text_col, source_col, lang_col, length_col) -> DataFrame:
    text = lambda c: F.col(f"`{c}`").cast("string") if c in docs.columns else F.lit(None).cast("string")
    length = F.col(f"`{length_col}`").cast("long") if length_col in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text(text_col).alias("text"), text(source_col).alias("source"), text(lang_col).alias("lang"), length.alias("length"))


def _labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """The labelled documents, at most `most` of them, with label and fold."""
    sample = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumnRenamed("doc_id", "s_id")
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("s_id").cast("string")), F.lit(FOLDS)).cast("int")
    # The broadcast is bounded by `most`.
    rows = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("s_id")).where("label IN (0, 1)")
    return written(rows.select(*docs.columns, F.col("label").cast("int").alias("label"), fold.alias("fold")), "quality-labelled")


def _summed(rows: DataFrame, pick, folds: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts (content, metadata) by fold and class. pick() makes a function from a part to the class of each row in both views, -1 for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = pick()
        sums = [np.zeros((folds, 2, dim), np.int64) for dim in (CONTENT_DIM, META_DIM)]
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                by_content, by_meta = classes(part)
                fold = part.column("fold").to_pylist() if folds > 1 else [0] * part.num_rows
                for text, k, f in zip(as_bytes(part, "text"), by_content.tolist(), fold, strict=True):
                    if k >= 0:
                        for own in _slices(text):
                            sums[0][f, k] += np.bincount(trigram_codes(own), minlength=CONTENT_DIM)
                for m, k, f in zip(_metadata(part), by_meta.tolist(), fold, strict=True):
                    if k >= 0:
                        np.add.at(sums[1][f, k], meta_features(*m), 1)
        for view, total in enumerate(sums):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), view, np.int32)), pa.array(at.astype(np.int32)), pa.array(total.ravel()[at])], ["view", "at", "n"])

    got = rows.mapInArrow(run, "view int, at int, n bigint").groupBy("view", "at").agg(F.sum("n").alias("n")).toArrow()
    view, at, n = (got.column(c).to_numpy() for c in ("view", "at", "n"))
    out = []
    for k, dim in enumerate((CONTENT_DIM, META_DIM)):
        total = np.zeros(folds * 2 * dim, np.int64)
        total[at[view == k]] = n[view == k]
        out.append(total.reshape(folds, 2, dim))
    return tuple(out)


def _own_labels():
    return lambda part: (part.column("label").to_numpy(),) * 2


def _calibrated(model: CoTrained, own: tuple[np.ndarray, np.ndarray], rows: DataFrame) -> None:
    """Fit both curves on the labelled rows, each scored without its own fold's counts."""
    others = [CoTrained(View(CONTENT_DIM, model.content.counts - own[0][f]), View(META_DIM, model.meta.counts - own[1][f]), 0.0) for f in range(FOLDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raws = [m.raw() for m in others]
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                for f in set(part.column("fold").to_pylist()):
                    mine = part.filter(pa.compute.equal(part.column("fold"), f))
                    yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in raws[f](mine)), mine.column("label")], ["content", "meta", "label"])

    got = rows.mapInArrow(run, "content double, meta double, label int").orderBy("content", "meta", "label").toArrow()
    y = got.column("label").to_numpy().astype(float)
    model.content.calibrate(got.column("content").to_numpy(), y)
    model.meta.calibrate(got.column("meta").to_numpy(), y)


def train(docs: DataFrame, labels: DataFrame, label_col="quality", rounds: int = ROUNDS, max_labelled: int = MAX_LABELLED, confident: float = CONFIDENT, id_col="doc_id", text_col="text", source_col="source", lang_col="lang", length_col="n_chars") -> CoTrained | None:
    """labels: (doc_id, label_col 0 or 1). None where there is nothing to learn: a fold's others lack a class, or both curves are flat."""
    picked = _picked(docs, id_col, text_col, source_col, lang_col, length_col)
    rows = _labelled(picked, labels.select(F.col("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")), max_labelled)
    sizes = {(r["label"], r["fold"]): r["count"] for r in rows.groupBy("label", "fold").count().collect()}
    if any(len({f for k, f in sizes if k == label}) < 2 for label in (0, 1)):
        return None
    positive, total = sum(n for (k, _), n in sizes.items() if k), sum(sizes.values())
    own = _summed(rows, _own_labels, FOLDS)
    model = CoTrained(View(CONTENT_DIM, own[0].sum(axis=0)), View(META_DIM, own[1].sum(axis=0)), float(np.log(positive / (total - positive))))
    _calibrated(model, own, rows)
    known = {r["doc_id"] for r in rows.select("doc_id").distinct().collect()}
    edge = float(np.log(confident / (1 - confident)))

    def taught():
        score = model.scorer()

        def classes(part: pa.RecordBatch):
            lc, lm, _ = score(part)
            new = np.array([i not in known for i in part.column("doc_id").to_pylist()], bool)
            # A flat curve repeats the share of good labels, however far out: it teaches nothing.
            return tuple(np.where(new & (view.b != 0) & (np.abs(x) > edge), (x > 0).astype(int), -1) for view, x in ((model.meta, lm), (model.content, lc)))

        return classes

    for _ in range(rounds):
        for_content, for_meta = _summed(picked, taught)
        model.content.counts, model.meta.counts = own[0].sum(axis=0) + for_content[0], own[1].sum(axis=0) + for_meta[0]
        _calibrated(model, own, rows)
    return model if model.content.b or model.meta.b else None


def score(docs: DataFrame, model: CoTrained | None, id_col="doc_id", text_col="text", source_col="source", lang_col="lang", length_col="n_chars") -> DataFrame:
    """doc_id, content_logit, metadata_logit, quality (probability), keep: one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.scorer() if model else lambda part: (np.zeros(part.num_rows),) * 3
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                lc, lm, both = rate(part)
                p = 1 / (1 + np.exp(-np.clip(both, -500, 500)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, (lc, lm, p, p >= 0.5))], ["doc_id", "content_logit", "metadata_logit", "quality", "keep"])

    picked = _picked(docs, id_col, text_col, source_col, lang_col, length_col)
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, content_logit double, metadata_logit double, quality double, keep boolean")


def filtered(docs: DataFrame, labels: DataFrame, id_col="doc_id", **kw) -> DataFrame:
    """docs without those that the classifier rejects; its columns are unchanged. A rejected row's id goes with all its rows."""
    drop = score(docs, train(docs, labels, id_col=id_col, **kw), id_col=id_col, **{k: v for k, v in kw.items() if k.endswith("_col") and k != "label_col"}).where("NOT keep").select(F.col("doc_id").alias("__q_id")).distinct()
    return docs.join(drop, docs[f"`{id_col}`"] == drop["__q_id"], "left_anti")
