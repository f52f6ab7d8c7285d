"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A model is a list of pieces with log scores; it is read, never trained. White space is marked as in
SentencePiece: one marker goes before the text and each space becomes a marker. The best segmentation has the
highest sum of scores, of equal sums the one whose last differing piece is longest. A character that starts
no piece costs the least score minus 10 and becomes its UTF-8 bytes' pieces.

No piece may hold a marker after another character (checked when a model is read). So a cut before each run
of markers is in every segmentation, the parts are solved on their own, and a short part's ids are remembered. Many
parts of about one length are solved together, a lone or long one by a plain walk of the trie, which lets go of what lies
before a place that no piece crosses (a stretch without such a place takes 16 bytes of memory a byte).

Defined results: null text has null ids, empty text no ids; a marker character that stands in the text
itself becomes byte pieces, so that decoding gives it back and the round trip is exact; texts of any length
are encoded whole; equal texts have equal ids; repeated rows stay rows; an empty table gives an empty result;
`encode` keeps no column but the id.
"""

from __future__ import annotations

import pickle
import re
from array import array
from collections import ChainMap
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarrymill.llm.common import kept, pieces

MARK = "▁"
#: Remembered parts; the memory is emptied beyond it.
REMEMBERED = 250_000
#: Cells (parts times the length of the longest) that are solved together.
CELLS = 1 << 18
#: Fewer parts than this, or parts of more bytes than LONG, are walked one by one; parts beyond LONG are not remembered.
TOGETHER, LONG = 200, 1 << 12
#: Characters of a text that are cut into parts at once.
SLICE = 1 << 20
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
_UNKNOWN_COST = 10.0
#: Stands for a marker of the text itself while parts are cut; no text can hold a lone surrogate.
_OWN_MARK = "\ud800"
_OWN_BYTES = _OWN_MARK.encode("utf-8", "surrogatepass")
#: Bytes of the character that a byte leads.
_CHAR_BYTES = np.array([1] * 192 + [2] * 32 + [3] * 16 + [4] * 16)


class DoubleArray:
    """A trie of byte strings in two arrays: state s has child s' = base[s] + byte + 1 if check[s'] = s."""

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for number, key in enumerate(keys):
            at = 0
            for c in key:
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    value.append(-1)
                at = children[at][c]
            value[at] = number
        # Nodes of several children are laid out one after another; those of one child then fill the gaps.
        base, slot, check, out = [0] * len(children), [0] * len(children), [0], [value[0]]
        check += [-1] * 256
        several = [i for i, c in enumerate(children) if len(c) > 1]
        owner: dict[int, int] = {}
        top = 257
        for i in several:
            codes = [c + 1 for c in children[i]]
            base[i] = top - min(codes)
            for c, child in children[i].items():
                slot[child] = base[i] + c + 1
                owner[slot[child]] = i
            top += max(codes) - min(codes) + 1
        free = 257
        for i, c in enumerate(children):
            if len(c) == 1:
                while free in owner:
                    free += 1
                ((byte, child),) = c.items()
                base[i], slot[child] = free - byte - 1, free
                owner[free] = i
        size = max(top, free + 1) + 257
        check += [-1] * (size - len(check))
        out += [-1] * (size - 1)
        bases = [0] * size
        for at, i in owner.items():
            check[at] = slot[i]
        for i in range(len(children)):
            bases[slot[i]], out[slot[i]] = base[i], value[i]
        self.arrays = bases, check, out

    def prefixes(self, text: bytes, at: int) -> Iterator[tuple[int, int]]:
        """(end, number of the key) for every key that text[at:] starts with, shortest first."""
        base, check, value = self.arrays
        state = 0
        for i in range(at, len(text)):
            to = base[state] + text[i] + 1
            if check[to] != state:
                return
            state = to
            if value[state] >= 0:
                yield i + 1, value[state]


@dataclass
class Model:
    pieces: list[str]
    scores: list[float]
    #: "piece", "byte", or "control" (unknown, control and unused ones)
    kinds: list[str]

    @classmethod
    def read(cls, path: str = MODEL_PATH) -> Model:
        """A SentencePiece model file, on the driver."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        kinds = ["byte" if sp.is_byte(i) else "control" if sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) else "piece" for i in ids]
        return cls([sp.id_to_piece(i) for i in ids], [sp.get_score(i) for i in ids], kinds)

    def __post_init__(self):
        for p, kind in zip(self.pieces, self.kinds, strict=True):
            if kind == "piece" and MARK in p.lstrip(MARK):
                raise ValueError(f"piece {p!r} has a marker after another character")


class Codec:
    def __init__(self, model: Model):
        numbers = [i for i, k in enumerate(model.kinds) if k == "piece"]
        self.trie = DoubleArray([model.pieces[i].encode() for i in numbers])
        self.tables = tuple(np.array(x, np.int32) for x in self.trie.arrays)
        self.longest = max((len(model.pieces[i].encode()) for i in numbers), default=0)
        self.numbers = np.array(numbers, np.int32)
        self.scores = np.array([model.scores[i] for i in numbers], float)
        self.score_list = self.scores.tolist()
        self.unknown = min(self.scores.tolist(), default=0.0) - _UNKNOWN_COST
        byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == "byte"}
        if len(byte_ids) != 256 or MARK not in model.pieces:
            raise ValueError("a model with all 256 byte pieces and the marker is needed")
        self.byte_ids = np.array([byte_ids[c] for c in range(256)], np.int32)
        self.bytes_of = pa.array([b"" if k == "control" else bytes([int(p[3:5], 16)]) if k == "byte" else p.replace(MARK, " ").encode() for p, k in zip(model.pieces, model.kinds, strict=True)], pa.large_binary())
        #: part without its first marker -> its ids as native 32-bit integers
        self.memory: dict[str, bytes] = {}

    def viterbi(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each part, all parts at once: a step takes every part from one place to one end."""
        base, check, value = self.tables
        n, size = len(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        width = int(size.max(initial=0))
        # Places past a part's end have code 0, which no state has a child for.
        codes = np.zeros((n, width), np.int32)
        codes[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32) + 1
        wide = width + 1
        best, back, piece = np.full(n * wide, -np.inf), np.zeros(n * wide, np.int32), np.full(n * wide, -1, np.int32)
        best[::wide] = 0.0
        for i in range(width):
            rows = np.flatnonzero((best[i::wide] > -np.inf) & (size > i))
            here = best[rows * wide + i]
            chars = _CHAR_BYTES[codes[rows, i] - 1]
            single = np.zeros(len(rows), bool)
            live, state = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for end in range(i + 1, min(width, i + self.longest) + 1):
                to = base[state] + codes[rows[live], end - 1]
                on = check[to] == state
                live, state = live[on], to[on]
                if not len(live):
                    break
                k = value[state]
                hit = np.flatnonzero(k >= 0)
                k, own = k[hit], live[hit]
                single[own] |= chars[own] == end - i
                score, cell = here[own] + self.scores[k], rows[own] * wide + end
                won = np.flatnonzero(score > best[cell])
                cell = cell[won]
                best[cell], back[cell], piece[cell] = score[won], i, k[won]
            lone = np.flatnonzero(~single)
            score, cell = here[lone] + self.unknown, rows[lone] * wide + i + chars[lone]
            won = np.flatnonzero(score > best[cell])
            best[cell[won]] = score[won]
            # An unknown character is left byte by byte; no piece ends inside it.
            first = rows[lone[won]] * wide + i
            for d in range(1, 5):
                inside = first[chars[lone[won]] >= d] + d
                back[inside], piece[inside] = i + d - 1, -1
        return self._traced(parts, size, back, piece, wide)

    def _traced(self, parts, size, back, piece, wide: int) -> list[bytes]:
        """From the ends back to the starts."""
        n = len(parts)
        raw = np.zeros((n, wide), np.uint8)
        own = [p.replace(_OWN_BYTES, MARK.encode()) for p in parts]
        raw[:, 1:][np.arange(wide - 1) < size[:, None]] = np.frombuffer(b"".join(own), np.uint8)
        raw = raw.ravel()
        out, many = np.zeros((n, wide), np.int32), np.zeros(n, np.int64)
        rows, at = np.arange(n), size.copy()
        for step in range(1, wide + 1):
            rows = rows[at[rows] > 0]
            if not len(rows):
                break
            cell = rows * wide + at[rows]
            k = piece[cell]
            ids = self.byte_ids[raw[cell]]
            known = k >= 0
            ids[known] = self.numbers[k[known]]
            out[rows, wide - step] = ids
            many[rows] += 1
            at[rows] = back[cell]
        flat = out.tobytes()
        return [flat[4 * (end - k) : 4 * end] for end, k in zip((wide * np.arange(1, n + 1)).tolist(), many.tolist(), strict=True)]

    def walk(self, part: bytes) -> bytes:
        """Ids of one part."""
        base, check, value = self.trie.arrays
        scores, unknown, sizes, none = self.score_list, self.unknown, _CHAR_BYTES.tolist(), float("-inf")
        n, out = len(part), bytearray()
        own = part.replace(_OWN_BYTES, MARK.encode())
        best, back, piece = array("d", [none]) * (n + 1), array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0], start, reach = 0.0, 0, 0
        for i in range(n):
            here = best[i]
            if here == none:
                continue
            if reach <= i and i - start >= LONG:
                out += self._back(own, start, i, back, piece)
                start, here = i, 0.0
            char = i + sizes[part[i]]
            state, j, single = 0, i, False
            while j < n:
                to = base[state] + part[j] + 1
                if check[to] != state:
                    break
                state, j = to, j + 1
                k = value[state]
                if k >= 0:
                    s = here + scores[k]
                    if s > best[j]:
                        best[j], back[j], piece[j] = s, i, k
                    single = single or j == char
                    reach = max(reach, j)
            if not single:
                s = here + unknown
                if s > best[char]:
                    best[char], back[char], piece[char] = s, i, -1
                reach = max(reach, char)
        return bytes(out + self._back(own, start, n, back, piece))

    def _back(self, own: bytes, start: int, at: int, back, piece) -> bytes:
        """The ids from place `at` back to start, in order; an unknown character is its bytes'."""
        ids = array("i")
        while at > start:
            k, before = piece[at], back[at]
            if k >= 0:
                ids.append(int(self.numbers[k]))
            else:
                ids.extend(self.byte_ids[np.frombuffer(own[before:at], np.uint8)][::-1].tolist())
            at = before
        ids.reverse()
        return ids.tobytes()

    def learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of parts; many of about one length are solved together."""
        coded = [(MARK + p.replace(" ", MARK)).encode("utf-8", "surrogatepass") for p in new]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        order = np.argsort(sizes, kind="stable")
        sizes, order = sizes[order], order.tolist()
        lo, found = 0, {}
        while lo < len(order):
            widest = max(8, int(sizes[lo]) * 5 // 4)
            hi = min(int(np.searchsorted(sizes, widest, "right")), lo + max(1, CELLS // widest))
            own = order[lo:hi]
            parts = [coded[i] for i in own]
            found.update(zip([new[i] for i in own], map(self.walk, parts) if len(own) < TOGETHER or widest > LONG else self.viterbi(parts), strict=True))
            lo = hi
        return found

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as native 32-bit integers."""
        out = []
        for text in texts:
            if text is None or len(text) <= SLICE:
                out.append([_parts(text) if text else []])
            else:
                out.append(_parts(x) if x else [""] for x in _slices(text))
        # Short texts together; the slices of a long one each on their own.
        short = [x for x in out if isinstance(x, list)]
        known = self._known(set().union(*(x[0] for x in short)) if short else set())
        done = []
        for x in out:
            if isinstance(x, list):
                done.append(b"".join(map(known.__getitem__, x[0])))
            else:
                done.append(b"".join(b"".join(map(self._known(set(parts)).__getitem__, parts)) for parts in x))
        return done

    def _known(self, parts: set[str]) -> dict[str, bytes]:
        """The ids of all these parts; short ones are remembered."""
        memory = self.memory
        new = parts.difference(memory)
        if len(memory) + len(new) > REMEMBERED:
            memory.clear()
            new = parts
        found = self.learn(list(new))
        long = {p: ids for p, ids in found.items() if len(p) > LONG}
        memory.update((p, ids) for p, ids in found.items() if len(p) <= LONG)
        return ChainMap(long, memory) if long else memory

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], np.int32).tolist()

    def decoded(self, ids: pa.ListArray) -> list[str | None]:
        """The texts of lists of ids."""
        raw = self.bytes_of.take(ids.flatten())
        ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset :] if len(raw) else np.zeros(1, np.int64)
        data = memoryview(raw.buffers()[2] or b"") if len(raw) else memoryview(b"")
        sizes = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        stops = ends[np.cumsum(sizes)].tolist()
        starts = [int(ends[0]), *stops[:-1]]
        nulls = ids.is_null().to_pylist()
        return [None if z else str(data[a:b], "utf-8", "replace")[1:] for a, b, z in zip(starts, stops, nulls, strict=True)]

    def decode(self, ids: list[int]) -> str:
        return self.decoded(pa.array([ids], pa.list_(pa.int32())))[0]


def _parts(text: str) -> list[str]:
    """What follows each marker that starts a run of markers, up to the next run."""
    text = text.replace(MARK, _OWN_MARK)
    if "  " not in text and text[0] != " ":
        return text.split(" ")
    return [p[1:] for p in re.findall(" +[^ ]*", " " + text)]


def _slices(text: str) -> Iterator[str]:
    """The text cut before runs of spaces, without the first space of each run that is cut at: it is the next part's marker."""
    lo = 0
    while True:
        # The run of spaces that a slice begins with is part of it.
        words = lo + len(text[lo : lo + SLICE]) - len(text[lo : lo + SLICE].lstrip(" "))
        hi = text.find(" ", max(words, lo + SLICE))
        while hi > words and text[hi - 1] == " ":
            hi -= 1
        if hi <= words:
            yield text[lo:]
            return
        yield text[lo:hi]
        lo = hi + 1


def _codec(pickled: bytes) -> Codec:
    """A Python worker keeps its codec, and what it remembers, from task to task."""
    codecs = kept("codecs")
    if pickled not in codecs:
        codecs.clear()
        codecs[pickled] = Codec(pickle.loads(pickled))
    return codecs[pickled]


def encode(docs: DataFrame, model: Model | None = None, id_col="doc_id", text_col="text", max_batch_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, ids array<int>: one row per row of docs. The model (its size is the vocabulary's) goes with the task."""
    sent = pickle.dumps(model or Model.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        for batch in batches:
            for part in pieces(batch, "text", max_batch_bytes):
                rows = codec.packed(part.column("text").to_pylist())
                sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
                ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(rows), np.int32)), mask=part.column("text").is_null())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    picked = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, model: Model | None = None, id_col="doc_id", ids_col="ids", keep_ids: bool = False) -> DataFrame:
    """doc_id, text: the texts back from their ids; with keep_ids also ids."""
    sent = pickle.dumps(model or Model.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ids = part.column("ids")
                more = [ids] if keep_ids else []
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(codec.decoded(ids), pa.string()), *more], ["doc_id", "text", "ids"][: 2 + len(more)])

    picked = coded.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids")
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, text string" + (", ids array<int>" if keep_ids else ""))
