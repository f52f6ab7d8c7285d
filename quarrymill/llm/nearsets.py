"""Near-duplicates by Jaccard similarity of word shingles: candidates by SimHash and by MinHash, verified exactly.

A text is the set of XXH64 of its `width` (5) words' shingles. Candidates come from two indexes. The SimHash of the
shingles is indexed by op10's deletion-variant signatures, at DISTANCE (3) bits, the most that halves allow. But 64 bits
put two sets of Jaccard 0.8 ten bits apart on average (arccos(8/9) / pi of 64), and only one such pair in a hundred lies
within 3; cut so fine that one of the segments differs by at most one bit at 15, segments have 8 bits and select nothing.
So BANDS bands of ROWS MinHash values find the others: a pair of Jaccard 0.8 shares none of the bands with probability
(1 - 0.8^6)^32 = 6e-5, a closer pair with less. Every candidate is verified by the Jaccard similarity of the whole sets.

Equal sets are one row before the indexes, and buckets of the same members are one bucket. A bucket's members meet
with their sets and are verified there: all pairs that a bound on their sizes allows and that the bucket has not
joined yet. A bucket emits a star for each of its clusters, not all pairs. Texts that share no bucket, and documents that
stay, are not shuffled: `parted` keeps them out of the joins by a bitmap, the joins decide about the rest.

Defined results as of simhash: ASCII letters are lower-cased; fewer words than a shingle has give one shingle
of all; no words (null, empty, white space) give the empty set, and empty sets are equal; repeated ids share a
component; an empty table gives an empty result; further columns are kept by `deduplicated`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import as_bytes, looked_up, parted, pieces, sorted_runs, swept, written
from quarrymill.llm.components import connected_components
from quarrymill.llm.simhash import fingerprint, fingerprint_links, shingle_hashes

WIDTH = 5
JACCARD = 0.8
DISTANCE = 3
BANDS = 32
ROWS = 6
#: Bytes of a bucket's bit matrix; a larger one's intersections are counted by shingles.
MOST_BITS = 128 << 20
#: Shingles that are hashed at once.
_CHUNK = 4096
_RNG = np.random.default_rng(42)
_FACTORS = _RNG.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64)
_MIX = _RNG.integers(1 << 63, size=(BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def name(hashes: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes())


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key per band, from the least of each of ROWS hash functions over a set that is not empty."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for lo in range(0, len(hashes), _CHUNK):
        h = hashes[lo : lo + _CHUNK]
        np.minimum(least, (h[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1), out=least)
    # The high bits of a product are its good ones.
    return ((least ^ least >> np.uint64(29)).reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64)


def set_links(fps: np.ndarray, sets: list[np.ndarray], least: float = JACCARD) -> list[tuple[int, int]]:
    """Links that keep all components of the pairs with a Jaccard similarity of at least `least`: one per joined root."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order.tolist()])
    rows = np.repeat(np.arange(len(sets)), sizes)
    _, cols, counts = np.unique(np.concatenate([sets[i] for i in order.tolist()]), return_inverse=True, return_counts=True)
    # What only one member has is in no intersection.
    rows, cols = rows[counts[cols] > 1], (np.cumsum(counts > 1) - 1)[cols[counts[cols] > 1]]
    width = int((counts > 1).sum())
    common = _by_bits(rows, cols, len(sets), width) if len(sets) * (width // 64 + 1) * 8 <= MOST_BITS else _by_places(rows, cols, len(sets), width)
    stop = np.searchsorted(sizes, sizes / least + 1e-9, "right")
    label, links = np.arange(len(sets)), []
    for i, end in enumerate(stop.tolist()):
        other = i + 1 + np.flatnonzero(label[i + 1 : end] != label[i])
        for part, both in common(i, other):
            for j in part[both >= least * (sizes[part] + sizes[i] - both) - 1e-9].tolist():
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    links.append((int(fps[order[i]]), int(fps[order[j]])))
    return links


def _by_bits(rows: np.ndarray, cols: np.ndarray, n: int, width: int):
    """(i, others) -> parts of the others with the sizes of their intersections with i: a bit for each member and shared shingle."""
    bits = np.zeros((n, width // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (rows, cols >> 6), np.uint64(1) << (cols & 63).astype(np.uint64))

    def common(i: int, other: np.ndarray):
        for lo in range(0, len(other), _CHUNK):
            part = other[lo : lo + _CHUNK]
            yield part, np.bitwise_count(bits[part] & bits[i]).sum(axis=1, dtype=np.int64)

    return common


def _by_places(rows: np.ndarray, cols: np.ndarray, n: int, width: int):
    """The same in memory that grows with the sets alone: each shared shingle's members, counted for the shingles of i."""
    own = np.searchsorted(rows, np.arange(n + 1))  # rows come sorted
    by_col = np.argsort(cols, kind="stable")
    members, edge = rows[by_col].astype(np.int32), np.searchsorted(cols[by_col], np.arange(width + 1))

    def common(i: int, other: np.ndarray):
        if not len(other):
            return
        both = np.zeros(n, np.int64)
        for c in cols[own[i] : own[i + 1]].tolist():
            both[members[edge[c] : edge[c + 1]]] += 1  # a member stands once with a shingle
        yield other, both[other]

    return common


def _named(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, fp, sim, keys: the name of every text's set, its SimHash, the set's band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                hashes = [shingle_hashes(t, width) for t in as_bytes(part, "text")]
                sets = [np.unique(h) for h in hashes]
                fps, sims = (np.array(x, np.uint64).view(np.int64) for x in ([name(s) for s in sets], [fingerprint(h) for h in hashes]))
                keys = pa.array([band_keys(s).view(np.int64) if len(s) else [] for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps), pa.array(sims), keys], ["doc_id", "fp", "sim", "keys"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint, sim bigint, keys array<bigint>")


def _buckets(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, int)
    big = np.diff(edge) > 1
    return zip(edge[:-1][big].tolist(), edge[1:][big].tolist(), strict=True)


def _shared(index: DataFrame) -> DataFrame:
    """bucket, fp: the members of buckets of two or more; a bucket is named by its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps in sorted_runs(batches):
            names, members = [], []
            for lo, hi in _buckets(keys):
                own = np.sort(fps[lo:hi])
                members.append(own)
                names.append(np.full(hi - lo, name(own), np.uint64))
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names).view(np.int64)), pa.array(np.concatenate(members))], ["bucket", "fp"])

    return index.repartition("key").sortWithinPartitions("key").mapInArrow(run, "bucket bigint, fp bigint").distinct()


def _similar(once: DataFrame) -> DataFrame:
    """bucket, fp: sets of one SimHash, and those of two that deletion-variant signatures link. once: fp, sim."""
    links = fingerprint_links(once.select(F.col("sim").alias("fp")).distinct(), DISTANCE).distinct()
    pairs = links.select(F.xxhash64("u", "v").alias("bucket"), F.explode(F.array("u", "v")).alias("m_sim"))
    many = once.groupBy("sim").agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64("sim").alias("bucket"), F.col("sim").alias("m_sim"))
    return pairs.unionByName(many).join(once, F.col("m_sim") == F.col("sim")).select("bucket", "fp")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """fp, s: the set of every text under its name, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = [shingle_set(t, width) for t in as_bytes(part, "text")]
                fps = np.array([name(s) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fps), pa.array([s.tobytes() for s in sets], pa.binary())], ["fp", "s"])

    return docs.mapInArrow(run, "fp bigint, s binary").dropDuplicates(["fp"])


def _links(members: DataFrame, least: float) -> DataFrame:
    """(u, v): verified links of every bucket. members: bucket, fp, s."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buckets, fps, sets in sorted_runs(batches):
            found: list[tuple[int, int]] = []
            for lo, hi in _buckets(buckets):
                found += set_links(fps[lo:hi], [np.frombuffer(x, np.uint64) for x in sets[lo:hi]], least)
            if found:
                uv = np.array(found, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(uv[:, 0].copy()), pa.array(uv[:, 1].copy())], ["u", "v"])

    return members.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", width: int = WIDTH, least: float = JACCARD) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id that links reach): one row per row of docs."""
    picked = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    with swept(docs.sparkSession):
        named = written(_named(picked, width), "near-named")
        once = written(named.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min("sim").alias("sim"), F.first("keys").alias("keys")), "near-distinct")
        shared = written(_shared(once.select(F.explode("keys").alias("key"), "fp")).unionByName(_similar(once.select("fp", "sim"))), "near-shared")
        # Most texts share no bucket with another; they stay where they are.
        wanted = written(once.join(shared.select(F.col("fp").alias("w_fp")), F.col("fp") == F.col("w_fp"), "left_semi").select("first").distinct(), "near-wanted")
        some, _ = parted(picked, "doc_id", wanted)
        sets = _sets(some.join(wanted, F.col("doc_id") == F.col("first"), "left_semi"), width).withColumnRenamed("fp", "s_fp")
        members = shared.join(sets, F.col("fp") == F.col("s_fp")).select("bucket", "fp", "s")
        labels = connected_components(_links(members, least))
        # Of every set its component's least doc_id; a set without links is its own component.
        tagged = once.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
        tops = tagged.groupBy("label").agg(F.min("first").alias("component_id")).withColumnRenamed("label", "top")
        owner = written(tagged.join(tops, F.col("label") == F.col("top")).select(F.col("fp").alias("o_fp"), "component_id"), "near-owners")
    # A set may be that of a third of all rows.
    return looked_up(named.select("doc_id", "fp"), owner, {"fp": "o_fp"}, "doc_id").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """docs without those that have a component of an earlier document; its columns are unchanged."""
    drop = near_duplicates(docs, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("__near_id")).distinct()
    with swept(docs.sparkSession):
        drop = written(drop, "near-drop")
    some, rest = parted(docs, id_col, drop)
    return rest.union(some.join(drop, some[f"`{id_col}`"] == drop["__near_id"], "left_anti"))
