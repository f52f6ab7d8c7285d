"""Media columns: content-addressed payloads in tar shards.

Each task streams its payloads into one tar shard in the shared folder; a payload that the shard already
has is not stored again. A member's name is its payload's SHA-256. Rows carry digest, shard, offset and
length; the index is written only after its shards are closed, and of several places of one digest the
least is used by every row. A retried task writes another shard under another name, so that rows never point
at a shard that was left half written.

A payload is stored as an 8-bit grey PNG, 576 samples a line. `read_headers` fills metadata columns from
the first 33 bytes of each member; `read_payloads` reads whole members, checks their digest and computes
features. Shards are opened through pyarrow.fs, from the folder's URI.

Defined results: null text is the empty payload, one line of bytes 255; a payload of any length is one member,
compressed by lines; equal texts share one member and so equal values; repeated rows stay rows; an empty
table writes no shard; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import as_bytes, pieces, scratch_path, written

WIDTH = 576
#: Lines that are compressed at once; digests that a task remembers (beyond it a payload may be stored again, and one place is used).
LINES, REMEMBERED = 4096, 500_000
#: Signature and IHDR chunk.
HEADER_BYTES = 33
_PNG = b"\x89PNG\r\n\x1a\n"
#: A text of at most so many rows is never a common one.
HOT_ROWS = 1000
_PLACE = "digest string, shard string, offset bigint, length bigint"


def payload_of(text: bytes) -> bytes:
    """Bytes 255 are appended up to a positive multiple of WIDTH."""
    return text + b"\xff" * (max(1, -(-len(text) // WIDTH)) * WIDTH - len(text))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes, level: int = 5) -> bytes:
    """Lines are compressed some thousand at a time, each after its filter type 0."""
    n, packer, body = len(payload) // WIDTH, zlib.compressobj(level), []
    for lo in range(0, len(payload), LINES * WIDTH):
        lines = np.frombuffer(memoryview(payload)[lo : lo + LINES * WIDTH], np.uint8).reshape(-1, WIDTH)
        body.append(packer.compress(np.pad(lines, ((0, 0), (1, 0))).tobytes()))
    body.append(packer.flush())
    return _PNG + _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, n, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", b"".join(body)) + _chunk(b"IEND", b"")


def decode_header(head: bytes) -> tuple[int, int, int, int]:
    """(width, height, bit depth, colour type) from the first HEADER_BYTES bytes."""
    if head[:8] != _PNG or head[12:16] != b"IHDR":
        raise ValueError("not a PNG")
    return struct.unpack(">IIBB", head[16:26])


def decode_png(data: bytes) -> bytes:
    width, height, _, _ = decode_header(data)
    at, body = 8, []
    while at < len(data):
        n = struct.unpack(">I", data[at : at + 4])[0]
        if data[at + 4 : at + 8] == b"IDAT":
            body.append(data[at + 8 : at + 8 + n])
        at += n + 12
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    if raw[:, 0].any():
        raise ValueError("a filtered line")
    return raw[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Height, mean and spread in thousandths, counts in eight bins of 32 levels, mean step between samples."""
    x = np.frombuffer(payload, np.uint8)
    n = len(x)
    counts = np.bincount(x, minlength=256)
    levels = np.arange(256)
    total, squares = int((counts * levels).sum()), int((counts * levels * levels).sum())
    bins = counts.reshape(8, 32).sum(axis=1).tolist()
    step = sum(int(np.abs(np.diff(x[i : i + (1 << 20) + 1].astype(np.int16))).sum()) for i in range(0, n - 1, 1 << 20))
    return f"h={n // WIDTH};mean={1000 * total // n};var={1000 * (n * squares - total * total) // (n * n)};bins={','.join(map(str, bins))};step={1000 * step // max(1, n - 1)}"


def _open(root: str):
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"
    found, path = fs.FileSystem.from_uri(root.replace("file:///", "file:/").replace("file:/", "file:///"))
    return found, path


def store(docs: DataFrame, id_col="doc_id", text_col="text", root: str | None = None) -> DataFrame:
    """doc_id, n_bytes, digest, shard, offset, length: one row per row of docs. Writes the shards."""
    root = root or scratch_path(docs.sparkSession, "media-shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, tar, have, name = None, None, {}, ""
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = []
                for text in as_bytes(part, "text"):
                    payload = payload_of(text)
                    digest = hashlib.sha256(payload).hexdigest()
                    if digest not in have:
                        if tar is None:
                            where, path = _open(root)
                            where.create_dir(path, recursive=True)
                            name = f"shard-{uuid.uuid4().hex}.tar"
                            sink = where.open_output_stream(f"{path}/{name}")
                            tar = tarfile.open(fileobj=sink, mode="w|", format=tarfile.USTAR_FORMAT)
                        data = encode_png(payload)
                        info = tarfile.TarInfo(f"{digest[:2]}/{digest}.png")
                        info.size = len(data)
                        if len(have) >= REMEMBERED:
                            have.clear()
                        have[digest] = (name, tar.offset + 512, len(data))
                        tar.addfile(info, io.BytesIO(data))
                        tar.members = []
                    rows.append((len(text), digest, *have[digest]))
                cols = list(zip(*rows, strict=True))
                types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        if tar is not None:
            tar.close()
            sink.close()

    picked = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    key = picked.schema["doc_id"].dataType.simpleString()
    index = written(picked.mapInArrow(run, f"doc_id {key}, n_bytes bigint, {_PLACE}"), "media-index")
    return index.withColumn("shard", F.concat(F.lit(f"{root}/"), "shard"))


def places(index: DataFrame) -> DataFrame:
    """One place for each digest, and how many rows have it: digest, shard, offset, length, n."""
    least = index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at"), F.count("*").alias("n"))
    return least.select("digest", "at.shard", "at.offset", "at.length", "n")


def _ranged(at: DataFrame, read, schema: str, header_only: bool) -> DataFrame:
    """Apply read(digest, bytes) -> tuple to the members, in the order of each shard."""
    names = [x.split()[0] for x in schema.split(", ")]
    arrow = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    types = [arrow[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, source = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                rows = []
                for r in batch.slice(lo, 1000).to_pylist():
                    if r["shard"] != shard:
                        shard = r["shard"]
                        where, path = _open(shard)
                        source = where.open_input_file(path)
                    source.seek(r["offset"])
                    rows.append((r["digest"], *read(r["digest"], source.read(HEADER_BYTES if header_only else r["length"]))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    sorted_ = at.select("digest", "shard", "offset", "length").repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
    return sorted_.mapInArrow(run, schema)


def read_headers(at: DataFrame) -> DataFrame:
    """digest, width, height, bit_depth, colour: by header-only range reads."""
    return _ranged(at, lambda _, head: decode_header(head), "digest string, width bigint, height bigint, bit_depth int, colour int", True)


def _facts(digest: str, data: bytes) -> tuple:
    payload = decode_png(data)
    if (found := hashlib.sha256(payload).hexdigest()) != digest:
        raise ValueError(f"{digest} holds {found}")
    return len(payload), found, zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature_of(payload)


def read_payloads(at: DataFrame) -> DataFrame:
    """digest and what is computed from the whole stored member, read back."""
    return _ranged(at, _facts, "digest string, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string", False)


def media_columns(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Store every text and read all back: one row per row of docs."""
    index = store(docs, id_col, text_col)
    at = written(places(index), "media-places")
    facts = lambda at: at.drop("n").join(read_headers(at), "digest").join(read_payloads(at), "digest")
    # A text that more than a thousandth of all rows have is no key to shuffle by; there are less than a thousand such.
    bound = max(HOT_ROWS, (at.agg(F.sum("n")).first()[0] or 0) // 1000)
    hot, rest = at.where(F.col("n") > bound), at.where(F.col("n") <= bound)
    rows = index.select("doc_id", "n_bytes", "digest")
    common = rows.join(F.broadcast(facts(hot)), "digest")
    return rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(facts(rest), "digest").unionByName(common)
