"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

A text is its lines between newlines; lines of only ASCII white space take no part and always stay. A line's
ID is the rank of its digest. Suffixes (document, line) are ranked by their first k lines; the ranks of k
lines at i and at i + k, sorted together, give the rank of 2k lines. Each doubling is a range sort, whose
positions are the suffix array to that depth, ties in the order of places. A suffix whose rank is unique shares
no run of k lines and leaves the table; doubling ends when none is left, past the longest repeat.

At every depth the suffixes of one rank are an interval of the suffix array with a longest common prefix of at
least that depth. All of an interval but the first are later copies. The depths are min_lines times powers of
two: a repeat of m lines is covered by later copies of the greatest depth up to m, from its start and from its
end, so that the union of a document's copies are its maximal repeated runs. Their lines are deleted.

With `long_words`, a line of as many words is a run of its own: its later copies are deleted too.

Defined results: a null text stays null with 0 lines; empty text has none; a text loses the lines and the
newlines that end them; rows that repeat a doc_id and text are one document, of two texts under one doc_id
the one with the smaller hash is first; a null doc_id keeps its text and is no earlier place of another; an
empty table gives an empty result; further columns, of any name, are kept by `deduplicated`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import as_bytes, pieces, ranked, written

#: A run has at least as many lines.
MIN_LINES = 2
#: Words of a line that the pipeline takes for a passage by itself.
LONG_WORDS = 50
_PLACE = ["doc_id", "v", "i"]


def line_sequence(text: bytes) -> list[bytes]:
    """The lines that take part."""
    return [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]


def _is_long(line: bytes, long_words: int | None) -> bool:
    return long_words is not None and len(line) >= 2 * long_words - 1 and len(line.split()) >= long_words


def _line_digests(texts: DataFrame, long_words: int | None) -> DataFrame:
    """(doc_id, v, i, a, b, long): a row per line; a and b are its digest. texts: doc_id, v (the text's hash), text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for part in pieces(batch, "text"):
                lines = [line_sequence(t) for t in as_bytes(part, "text")]
                counts = [len(x) for x in lines]
                names = np.frombuffer(b"".join([digest(x) for doc in lines for x in doc]), np.int64).reshape(-1, 2)
                of = pa.array(np.repeat(np.arange(len(lines)), counts))
                at = np.concatenate([np.arange(n, dtype=np.int32) for n in counts]) if counts else np.empty(0, np.int32)
                long = pa.array([_is_long(x, long_words) for doc in lines for x in doc], pa.bool_())
                cols = [part.column("doc_id").take(of), part.column("v").take(of), pa.array(at), pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy()), long]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "v", "i", "a", "b", "long"])

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, v int, i int, a bigint, b bigint, long boolean")


def _doubled(table: DataFrame, step: int) -> DataFrame:
    """Pairs (a, b) of the ranks at i and at i + step."""
    ahead = table.select(F.col("doc_id").alias("a_id"), F.col("v").alias("a_v"), (F.col("i") - step).alias("a_i"), F.col("rank").alias("b"))
    met = (F.col("doc_id") == F.col("a_id")) & (F.col("v") == F.col("a_v")) & (F.col("i") == F.col("a_i"))
    return table.select(*_PLACE, F.col("rank").alias("a")).join(ahead, met).select(*_PLACE, "a", "b")


def later_copies(texts: DataFrame, min_lines: int = MIN_LINES, long_words: int | None = None) -> DataFrame:
    """(doc_id, v, i, n): places whose n lines also stand earlier; n is a depth, or 1 for a long line. texts: doc_id, v, text."""
    table = ranked(written(_line_digests(texts, long_words), "lines-digests"), ("a", "b"), _PLACE, "lines-ranks-1")
    found = [table.where("later AND long").select(*_PLACE, F.lit(1).alias("n"))] if long_words is not None else []
    depth = 1
    while True:
        ends = table.isEmpty()
        if ends or depth >= min_lines:
            found.append(table.where("later").select(*_PLACE, F.lit(depth).alias("n")))
        if ends:
            break
        step = depth if depth >= min_lines else min(depth, min_lines - depth)
        depth += step
        table = ranked(_doubled(table, step), ("a", "b"), _PLACE, f"lines-ranks-{depth}")
    return reduce(DataFrame.unionByName, found)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.hash(text).alias("v"), text.alias("text")).where("text IS NOT NULL AND doc_id IS NOT NULL")


def removals(docs: DataFrame, min_lines: int = MIN_LINES, id_col="doc_id", text_col="text", long_words: int | None = None) -> DataFrame:
    """(doc_id, v, runs array<bigint>): what a document loses, as first line * 2^32 + lines; documents that lose nothing have no row."""
    later = later_copies(_keyed(docs, id_col, text_col), min_lines, long_words)
    code = F.col("i").cast("long") * F.lit(1 << 32) + F.col("n")
    return written(later.groupBy("doc_id", "v").agg(F.collect_list(code).alias("runs")), "lines-removals")


def covered(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n lines the runs cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs >> 32, 1)
    np.add.at(change, (runs >> 32) + (runs & 0xFFFFFFFF), -1)
    return np.cumsum(change[:-1]) > 0


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, start, n_lines): the maximal runs of lines whose copies also start earlier."""
    gone = removals(docs, min_lines, id_col, text_col).select("doc_id", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, starts, sizes = [], [], []
            for k, runs in enumerate(batch.column("runs")):
                code = runs.values.to_numpy()
                edge = np.flatnonzero(np.diff(np.r_[False, covered(code, int(((code >> 32) + (code & 0xFFFFFFFF)).max())), False].astype(np.int8)))
                of += [k] * (len(edge) // 2)
                starts.append(edge[::2])
                sizes.append(edge[1::2] - edge[::2])
            flat = [pa.array(np.concatenate(x).astype(np.int32)) if x else pa.array([], pa.int32()) for x in (starts, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(of, pa.int64())), *flat], ["doc_id", "start", "n_lines"])

    return gone.mapInArrow(run, f"doc_id {gone.schema['doc_id'].dataType.simpleString()}, start int, n_lines int")


def without_lines(text: bytes, runs: np.ndarray) -> tuple[bytes, int, int]:
    """(kept text, lines that take part, removed ones)."""
    lines = text.split(b"\n")
    part = np.array([bool(x.strip(b" \t\n\v\f\r")) for x in lines])
    n = int(part.sum())
    if not len(runs):
        return text, n, 0
    gone = covered(runs, n)
    keep = np.ones(len(lines), bool)
    keep[np.flatnonzero(part)[gone]] = False
    return b"\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k]), n, int(gone.sum())


def deduplicated(docs: DataFrame, min_lines: int = MIN_LINES, id_col="doc_id", text_col="text", counts: bool = False, long_words: int | None = None) -> DataFrame:
    """docs with the later copies' lines deleted from the text; with counts also __n_lines, __n_removed."""
    gone = removals(docs, min_lines, id_col, text_col, long_words).select(F.col("doc_id").alias("g_id"), F.col("v").alias("g_v"), "runs")
    # Columns go by number, so that no name of theirs can clash.
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, own_text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    joined = rows.join(gone, (F.col(own_id) == F.col("g_id")) & (F.hash(F.col(own_text).cast("string")) == F.col("g_v")), "left").drop("g_id", "g_v")
    joined = joined.withColumn(own_text, F.col(own_text).cast("string"))
    names, more = rows.columns, ["__n_lines", "__n_removed"] if counts else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in batches:
            for part in pieces(batch, own_text):
                runs = [none if r.values is None else r.values.to_numpy() for r in part.column("runs")]
                done = [without_lines(t, r) for t, r in zip(as_bytes(part, own_text), runs, strict=True)]
                nulls = part.column(own_text).is_null().to_pylist()
                kept = pa.array([None if z else d[0] for d, z in zip(done, nulls, strict=True)], pa.binary()).cast(pa.string())
                cols = [kept if c == own_text else part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays(cols + [pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)][: len(more)], names + more)

    schema = ", ".join([f"{f.name} {'string' if f.name == own_text else f.dataType.simpleString()}" for f in rows.schema] + [f"{c} bigint" for c in more])
    return joined.mapInArrow(run, schema).toDF(*docs.columns, *more)
