"""Substring dedup by recompression: repeated windows of words are removed, but for their first place.

A text is a sequence of tokens, its words. A round of recompression names runs (a token and how often it stands in
a row) and then pairs: by a bit of its name a token is left or right, and a left one joins a right one that follows.
Names are digests of what they stand for: global, so that equal content has equal names in every task without a
table of names. Two rounds are made. What a token becomes depends on its next neighbours only, so that of a window
of WINDOW words the symbols of the second round are the same at every place where it stands, but for those within
a token of its ends at each step (the ends may cut a run or a pair). Those are its interior symbols.

The least chain of CHAIN interior symbols is the window's anchor; neighbouring windows share it. A row for each anchor
place goes to Spark: the anchor's name, the digest of all words of the windows that share the place, the place. A
range sort ranks them. Rows of one name and digest are one class: all but the first are later copies, with all their
windows. Classes of one anchor may still share some windows (at the ends of a long repeat): the first row of each
such class is revealed, its windows are named by a 128-bit digest of their words, and ranked in the same way. A window
without enough interior symbols (a few words that repeat) is an anchor of its own.

A batch sends the first place of each class only, so that a very common passage is a row a batch; its other places
are known to be later copies. A range sort cuts what is left of it over tasks.

Defined results: null and empty texts have no words and keep the empty text; texts under WINDOW words lose nothing;
rows that repeat a doc_id and text are one document, of two texts under one doc_id the one with the smaller hash is
first; rows without doc_id lose nothing and are no earlier place; long texts are read in slices that overlap by a
window; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import as_bytes, dropped, equal_neighbours, one_batch, pieces, ranked, swept, written

WINDOW = 20
CHAIN = 2
#: Bytes of text that are compressed at once.
SLICE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_PLACE = ["doc_id", "v", "at"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


@dataclass
class Words:
    """The words of some texts joined by one space, where each starts and ends, and the number of its text."""

    blob: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        space = _SPACE[raw]
        keep = ~space
        keep[1:] |= ~space[:-1]  # the first space after a word
        at = np.flatnonzero(keep)
        blob = np.where(space, np.uint8(32), raw)[at]
        ends = np.flatnonzero(blob == 32)
        starts = np.r_[0, ends[:-1] + 1][: len(ends)]
        edges = np.cumsum([len(t) + 1 for t in texts])
        return cls(blob, starts, ends, np.searchsorted(edges, at[starts], "right"))

    def names(self) -> np.ndarray:
        """A name of each word, from prefix sums of a polynomial of its bytes."""
        power, inverse = _powers(len(self.blob))
        sums = np.r_[np.uint64(0), np.cumsum((self.blob.astype(np.uint64) + np.uint64(1)) * power[: len(self.blob)])]
        return _mixed((sums[self.ends] - sums[self.starts]) * inverse[self.starts])


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, x in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            _POWERS[k] = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n + n // 4, x, np.uint64)])
    return _POWERS


def run_names(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, names) of the maximal runs of equal tokens."""
    starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]][: len(names)])
    times = np.diff(np.r_[starts, len(names)]).astype(np.uint64)
    own = names[starts]
    return starts, np.where(times > 1, _mixed(own * np.uint64(5) + times), own)


def pair_names(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, names) of left tokens joined with a right one that follows, and of single ones."""
    left = (_mixed(names) & np.uint64(1)).astype(bool)
    joins = np.r_[left[:-1] & ~left[1:], False][: len(names)]
    starts = np.flatnonzero(~np.r_[False, joins[:-1]][: len(names)])
    after = names[np.minimum(starts + 1, len(names) - 1)]
    return starts, np.where(joins[starts], _mixed(names[starts] * np.uint64(3) + _mixed(after)), names[starts])


def _before(starts: np.ndarray, n: int) -> np.ndarray:
    """For 0 to n + 1, how many symbols start before that token."""
    is_start = np.zeros(n + 2, np.int64)
    is_start[starts + 1] = 1
    return np.cumsum(is_start)


def anchors(names: np.ndarray, window: int = WINDOW, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """Of every window: the place of its anchor among the second round's chains (-1: it has none), and the names of the chains."""
    n = len(names) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    s0, r1 = run_names(names)
    s1, p1 = pair_names(r1)
    s2, r2 = run_names(p1)
    s3, p2 = pair_names(r2)
    # The first and last interior symbol of each window, step by step: a symbol is interior if it and its neighbours are inside.
    run_of = np.repeat(np.arange(len(s0)), np.diff(np.r_[s0, len(names)]))
    lo, hi = run_of[:n] + 1, run_of[window - 1 :] - 1
    for starts, tokens in ((s1, len(r1)), (s2, len(p1)), (s3, len(r2))):
        before = _before(starts, tokens)
        lo, hi = before[np.minimum(lo + 1, tokens)], before[np.maximum(hi + 1, 0)] - 2
    m = max(0, len(p2) - chain + 1)
    chains = np.zeros(m, np.uint64)
    for j in range(chain):
        chains = _mixed(chains + p2[j : j + m] + np.uint64(j + 1))
    count = hi - lo - chain + 2  # chains inside
    place = np.full(n, -1, np.int64)
    have = np.flatnonzero(count > 0)
    if len(have):
        # The least of a range of chains by the minima of 1, 2, 4, ... of them; a key's low bits are its place, so that the first of equals wins.
        low = np.uint64((1 << max(1, int(m).bit_length())) - 1)
        least = [(chains & ~low) | np.arange(m, dtype=np.uint64)]
        for k in range(int(count.max()).bit_length() - 1):
            prev, step = least[-1], 1 << k
            nxt = prev.copy()
            nxt[:-step] = np.minimum(prev[:-step], prev[step:])
            least.append(nxt)
        level = np.frexp(count[have].astype(float))[1] - 1
        table = np.stack(least)
        first, last = lo[have], lo[have] + count[have] - (1 << level)
        place[have] = (np.minimum(table[level, first], table[level, last]) & low).astype(np.int64)
    return place, chains


def anchor_rows(words: Words, base: np.ndarray, window: int, chain: int) -> tuple[np.ndarray, ...]:
    """(anchor name, digest of the words, text, first window, windows) for each anchor place. base: the words before each text's slice."""
    place, chains = anchors(words.names(), window, chain)
    inside = np.flatnonzero(words.text[: len(place)] == words.text[window - 1 :][: len(place)])
    if not len(inside):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    own = place[inside]
    head = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (own[1:] < 0) | (inside[1:] != inside[:-1] + 1)])
    count = np.diff(np.r_[head, len(inside)])
    first = inside[head]
    digest, blob = xxhash.xxh3_128_digest, memoryview(words.blob)
    spans = zip(words.starts[first].tolist(), words.ends[first + count + window - 2].tolist(), strict=True)
    sums = np.frombuffer(b"".join([digest(blob[a:b]) for a, b in spans]), np.int64).reshape(-1, 2)
    anchor = own[head]
    name = np.where(anchor >= 0, chains[np.maximum(anchor, 0)].view(np.int64) if len(chains) else 0, sums[:, 0])
    text = words.text[first]
    starts = np.searchsorted(words.text, np.arange(len(base)))
    return name, sums[:, 1].copy(), text, first - starts[text] + base[text], count


def _slices(texts: list[bytes], window: int) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """(numbers of the texts, texts or slices, words before each) of about SLICE bytes; slices of a text overlap by window - 1 words."""
    numbers, parts, bases, size = [], [], [], 0
    for k, text in enumerate(texts):
        base, at = 0, 0
        while True:
            end, part, tail = len(text), text[at:], []
            if end - at > 2 * SLICE:
                end = at
                while end < len(text) and len(tail) < window:
                    end = min(len(text), end + SLICE)
                    while end < len(text) and not _SPACE[text[end]]:
                        end += 1
                    part = text[at:end]
                    tail = part.rsplit(None, window - 1)
            if size and size + len(part) > SLICE:
                yield numbers, parts, bases
                numbers, parts, bases, size = [], [], [], 0
            numbers.append(k)
            parts.append(part)
            bases.append(base)
            size += len(part)
            if end >= len(text):
                break
            base += len(tail[0].split())
            at += len(tail[0])
    if parts:
        yield numbers, parts, bases


def _first_places(name, full, text, at, count, rank) -> tuple[np.ndarray, np.ndarray]:
    """Map-side combine: (rows that are the first of their class, later ones). rank: of each row's document."""
    order = np.lexsort((at, rank, full, name))
    new = np.r_[True, (name[order][1:] != name[order][:-1]) | (full[order][1:] != full[order][:-1])][: len(order)]
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    late = (rank[order] != rank[head]) | (at[order] != at[head])
    return order[new], order[late]


def _ranks(part: pa.RecordBatch) -> np.ndarray:
    """The order of a batch's documents by doc_id, then hash."""
    keys = pa.table({"a": part.column("doc_id"), "b": part.column("v")})
    order = pa.compute.sort_indices(keys, [("a", "ascending"), ("b", "ascending")]).to_numpy()
    sorted_ = one_batch([pa.RecordBatch.from_arrays([c.combine_chunks() for c in keys.take(pa.array(order)).columns], ["a", "b"])])
    out = np.empty(len(order), np.int64)
    out[order] = np.r_[0, np.cumsum(~equal_neighbours(sorted_, ["a", "b"]))][: len(order)]
    return out


def _batch(part: pa.RecordBatch, kind, a, b, text, at, n) -> pa.RecordBatch:
    of = pa.array(text)
    cols = [pa.array(kind), pa.array(a), pa.array(b), part.column("doc_id").take(of), part.column("v").take(of), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))]
    return pa.RecordBatch.from_arrays(cols, ["kind", "a", "b", *_PLACE, "n"])


#: Kinds of rows: n windows from a place on to compare, known later copies.
_OPEN, _LATER = 0, 1


def _compared(part: pa.RecordBatch, rank: np.ndarray, found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """The first row of each class, and the others as later copies."""
    name, full, text, at, count = found
    first, late = _first_places(name, full, text, at, count, rank[text])
    rows = np.r_[first, late]
    kind = np.r_[np.full(len(first), _OPEN, np.int8), np.full(len(late), _LATER, np.int8)]
    return _batch(part, kind, name[rows], full[rows], text[rows], at[rows], count[rows])


def repeats(texts: DataFrame, window: int = WINDOW, chain: int = CHAIN) -> DataFrame:
    """(doc_id, v, at, n): n windows from word `at` on that start earlier too. texts: doc_id, v (the text's hash), text."""
    key = texts.schema["doc_id"].dataType.simpleString()
    schema = f"kind tinyint, a bigint, b bigint, doc_id {key}, v int, at int, n int"

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                rank, found = _ranks(part), []
                for numbers, own, bases in _slices(as_bytes(part, "text"), window):
                    name, full, text, at, count = anchor_rows(Words.of(own), np.array(bases), window, chain)
                    found.append((name, full, np.array(numbers)[text], at, count))
                yield _compared(part, rank, tuple(np.concatenate(x) for x in zip(*found, strict=True)))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From sorted rows the later ones of each class, and as open ones the first of each class that shares its anchor.

        A range's first row, and its last anchor's first one, may share it with another range: they stay open.
        """
        last, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if last is None else one_batch([last, batch])
            anchor = np.r_[True, ~equal_neighbours(rows, ["a"])]
            new = anchor | np.r_[True, ~equal_neighbours(rows, ["b"])]
            head = np.flatnonzero(new)[np.cumsum(new) - 1]
            start = 0 if last is None else 1
            own = np.arange(rows.num_rows) >= start
            at = pa.array(head)
            place = np.logical_and.reduce([pa.compute.equal(rows.column(c), rows.column(c).take(at)).to_numpy(zero_copy_only=False) for c in _PLACE])
            if last is not None:
                # The class that goes on from the batch before: its first place is not here.
                going = head == 0
                place[going] = np.r_[True, np.logical_and.reduce([equal_neighbours(rows, [c]) for c in _PLACE])][going]
            late = own & ~new & ~place
            # The first of a class is open if its anchor's rows before or after it are of another class.
            firsts = np.flatnonzero(new & own)
            alone = anchor[firsts]  # the first class of its anchor: open only if a second class follows
            followed = np.r_[~anchor[firsts[1:]], False][: len(firsts)]
            opened = firsts[~alone | followed]
            if last is None:
                opened = np.union1d(opened, firsts[:1])
            if held is not None and len(firsts) and not anchor[firsts[0]]:
                yield flagged(held, _OPEN)
            if len(firsts):
                f = int(firsts[-1])
                held = rows.slice(f, 1) if alone[-1] and f not in opened[-1:] else None
            yield flagged(rows.take(pa.array(np.flatnonzero(late))), _LATER)
            yield flagged(rows.take(pa.array(opened)), _OPEN)
            last = rows.slice(rows.num_rows - 1)
        if held is not None:
            yield flagged(held, _OPEN)

    def flagged(rows: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, kind, np.int8)), *(rows.column(c) for c in (*_PLACE, "n"))], ["kind", *_PLACE, "n"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                rank, found = _ranks(part), []
                wanted = [x.values.to_numpy() for x in part.column("open")]
                for numbers, own, bases in _slices(as_bytes(part, "text"), window):
                    words = Words.of(own)
                    starts = np.searchsorted(words.text, np.arange(len(own) + 1))
                    blob = memoryview(words.blob)
                    for k, (number, base) in enumerate(zip(numbers, bases, strict=True)):
                        code = wanted[number]
                        at = np.repeat(code >> 32, code & 0xFFFFFFFF) + _counts(code & 0xFFFFFFFF) - base
                        at = at[(at >= 0) & (at + window <= starts[k + 1] - starts[k])]
                        lo, hi = words.starts[starts[k] + at].tolist(), words.ends[starts[k] + at + window - 1].tolist()
                        sums = np.frombuffer(b"".join([digest(blob[a:b]) for a, b in zip(lo, hi, strict=True)]), np.int64).reshape(-1, 2)
                        found.append((sums[:, 0], sums[:, 1], np.full(len(at), number), at + base, np.ones(len(at), np.int64)))
                yield _compared(part, rank, tuple(np.concatenate(x) for x in zip(*found, strict=True)))

    # No shuffle outlives the table that is written from it.
    with swept(texts.sparkSession):
        first = written(texts.mapInArrow(named, schema), "recompression-anchors")
        order = ["a", "b", *_PLACE]
        sorted_ = first.where(f"kind = {_OPEN}").drop("kind").repartitionByRange(*order).sortWithinPartitions(*order)
        second = written(sorted_.mapInArrow(classes, f"kind tinyint, doc_id {key}, v int, at int, n int"), "recompression-classes")
        known = written(first.where(f"kind = {_LATER}").select(*_PLACE, "n"), "recompression-known")
        dropped(first)
        code = F.col("at").cast("long") * F.lit(1 << 32) + F.col("n")
        revealed = second.where(f"kind = {_OPEN}").groupBy("doc_id", "v").agg(F.collect_list(code).alias("open")).select(F.col("doc_id").alias("o_id"), F.col("v").alias("o_v"), "open")
        met = texts.join(revealed, (F.col("doc_id") == F.col("o_id")) & (F.col("v") == F.col("o_v"))).drop("o_id", "o_v")
        third = written(met.mapInArrow(windows, schema), "recompression-windows")
        same = ranked(third.where(f"kind = {_OPEN}").select("a", "b", *_PLACE), ("a", "b"), _PLACE, "recompression-ranks")
    late = [known, *(t.where(f"kind = {_LATER}").select(*_PLACE, "n") for t in (second, third)), same.where("later").select(*_PLACE, F.lit(1).alias("n"))]
    return late[0].unionByName(late[1]).unionByName(late[2]).unionByName(late[3])


def _counts(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... anew for every size."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def without_words(text: bytes, runs: np.ndarray, window: int) -> tuple[bytes, int, int]:
    """(kept words joined by one space, words, removed words). runs: first window * 2^32 + windows."""
    words = Words.of([text])
    n = len(words.starts)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs >> 32, 1)
    np.add.at(change, (runs >> 32) + (runs & 0xFFFFFFFF) + window - 1, -1)
    out = np.cumsum(change[:-1]) > 0
    kept = words.blob[np.repeat(~out, words.ends - words.starts + 1)]
    return kept[:-1].tobytes(), n, int(out.sum())


def deduplicated(docs: DataFrame, id_col="doc_id", text_col="text", window: int = WINDOW, chain: int = CHAIN) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space): one row per row of docs."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.hash(text).alias("v"), text.alias("text"))
    code = F.col("at").cast("long") * F.lit(1 << 32) + F.col("n")
    gone = repeats(texts.where("doc_id IS NOT NULL"), window, chain).groupBy("doc_id", "v").agg(F.collect_list(code).alias("runs"))
    gone = gone.select(F.col("doc_id").alias("g_id"), F.col("v").alias("g_v"), "runs")
    joined = texts.join(gone, (F.col("doc_id") == F.col("g_id")) & (F.col("v") == F.col("g_v")), "left").select("doc_id", "text", "runs")
    key = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                runs = [none if r.values is None else r.values.to_numpy() for r in part.column("runs")]
                rows = [without_words(t, r, window) for t, r in zip(as_bytes(part, "text"), runs, strict=True)]
                kept = pa.array([r[0] for r in rows], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2)), kept], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, f"doc_id {key}, n_words bigint, n_removed bigint, kept string")
