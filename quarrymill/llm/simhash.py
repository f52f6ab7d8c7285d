"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits: a bit is 1 if over half of the shingles' XXH64 have it. Two fingerprints link at
`distance` (2) or fewer differing bits. Cut into SEGMENTS = 2 halves, one half differs by at most one bit;
each half is indexed under its 32 variants with one bit blanked, so that such halves share a variant.
Distinct fingerprints meet in a variant's bucket by an equality shuffle and are verified there.

Equal fingerprints are one row before the index, so copies never meet; a bucket emits for each of its
verified clusters a star, not all pairs. A bucket beyond SMALL fingerprints is linked by probing: each
fingerprint looks up all its neighbours within the distance, which is linear in the bucket and exact.

Defined results: ASCII letters are lower-cased; fewer words than a shingle has give one shingle of all; no
words (null, empty, white space) give fingerprint zero, which links like any other; repeated ids share a
component; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import as_bytes, looked_up, pieces, sorted_runs, written
from quarrymill.llm.components import connected_components

SHINGLE = 3
DISTANCE = 2
SEGMENTS = 2
SEED = 42
#: Above this a bucket's pairs are found by probing neighbours.
SMALL = 2048
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Bit matrix of a byte: row b, column k is bit k of b.
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def shingle_hashes(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of the shingles of an ASCII-lower-cased text."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - width].tolist()]
    stops = (ends[width - 1 :] - 1).tolist()
    view = memoryview(joined)
    return np.fromiter([digest(view[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64, len(stops))


def fingerprint(hashes: np.ndarray) -> int:
    """Majority bits as an unsigned integer; of no hashes, zero."""
    n = len(hashes)
    if not n:
        return 0
    planes = hashes.view(np.uint8).reshape(n, 8)  # little-endian: plane p has bits 8p..8p+7
    out = 0
    for p in range(8):
        votes = np.bincount(planes[:, p], minlength=256) @ _BITS
        out |= int(((2 * votes > n) << np.arange(8)).sum()) << (8 * p)
    return out


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", width: int = SHINGLE) -> DataFrame:
    """doc_id, fp long (the fingerprint's bits): one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                fps = np.array([fingerprint(shingle_hashes(t, width)) for t in as_bytes(part, "text")], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    picked = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, fp bigint")


def variants(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fp) for every fingerprint, half and blanked bit; a key holds the other 31 bits and their place."""
    half = 64 // SEGMENTS
    keys = []
    for segment in range(SEGMENTS):
        part = (fps >> np.uint64(segment * half)) & np.uint64((1 << half) - 1)
        for bit in range(half):
            low = part & np.uint64((1 << bit) - 1)
            high = (part >> np.uint64(bit + 1)) << np.uint64(bit)
            keys.append(high | low | np.uint64((segment * half + bit) << 32))
    return np.concatenate(keys), np.tile(fps, 64)


def _neighbours(distance: int) -> np.ndarray:
    """Masks of 1 to `distance` bits."""
    masks = [1 << i for i in range(64)]
    level = masks
    for _ in range(distance - 1):
        level = [m | 1 << i for m in level for i in range(m.bit_length(), 64)]
        masks = masks + level
    return np.array(masks, np.uint64)


def star_links(fps: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links between distinct fingerprints that keep all components of the verified pairs: one per joined root."""
    n = len(fps)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[b] = a
            links.append((int(fps[i]), int(fps[j])))

    if n <= SMALL:
        for i in range(n - 1):
            near = np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= distance)
            for j in near.tolist():
                join(i, i + 1 + j)
        return links
    order = np.argsort(fps)
    ranked = fps[order]
    for mask in _neighbours(distance):
        wanted = fps ^ mask
        at = np.minimum(np.searchsorted(ranked, wanted), n - 1)
        for i in np.flatnonzero((ranked[at] == wanted) & (wanted > fps)).tolist():
            join(i, int(order[at[i]]))
    return links


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v): verified links between the fingerprints of a one-column table of distinct fp."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                fps = batch.column("fp").slice(lo, 2000).to_numpy(zero_copy_only=False).view(np.uint64)
                keys, owners = variants(fps)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(owners.view(np.int64))], ["key", "fp"])

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps in sorted_runs(batches):
            yield from linked(keys, fps)

    def linked(keys, fps) -> Iterator[pa.RecordBatch]:
        if len(keys) < 2:
            return
        edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        sizes = np.diff(edge)
        found: list[tuple[int, int]] = []
        two = edge[:-1][sizes == 2]
        a, b = fps[two].view(np.uint64), fps[two + 1].view(np.uint64)
        close = np.bitwise_count(a ^ b) <= distance
        found += zip(a[close].tolist(), b[close].tolist(), strict=True)
        for lo, hi in zip(edge[:-1][sizes > 2].tolist(), edge[1:][sizes > 2].tolist(), strict=True):
            found += star_links(fps[lo:hi].view(np.uint64), distance)
        if found:
            uv = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(uv[:, 0].copy()), pa.array(uv[:, 1].copy())], ["u", "v"])

    rows = distinct.mapInArrow(index, "key bigint, fp bigint")
    # Every fingerprint stands once in a bucket, so no bucket is made hot by copies.
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(buckets, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id that links reach): one row per row of docs."""
    if not 0 < distance < 2 * SEGMENTS:
        raise ValueError("the halves guarantee distances of 1 to 3")
    fps = written(fingerprints(docs, id_col, text_col, width), "simhash-fps")
    least = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    labels = connected_components(fingerprint_links(least.select("fp"), distance))
    # Of every fingerprint its component's least doc_id; a fingerprint without links is its own component.
    tagged = least.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    tops = tagged.groupBy("label").agg(F.min("least").alias("component_id")).withColumnRenamed("label", "top")
    owner = written(tagged.join(tops, F.col("label") == F.col("top")).select(F.col("fp").alias("o_fp"), "component_id"), "simhash-owners")
    # A fingerprint may be that of a third of all rows.
    return looked_up(fps, owner, {"fp": "o_fp"}, "doc_id").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicated(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """docs without those that have a component of an earlier document; its columns are unchanged."""
    drop = near_duplicates(docs, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("__near_id")).distinct()
    return docs.join(drop, docs[f"`{id_col}`"] == drop["__near_id"], "left_anti")
