"""Conversation structure repair by a forward Viterbi search over four grammar states.

A conversation is whole when the initials of its roles read `(s?(ua)+)?`. The states are: nothing yet, after a system turn,
after a user turn, after an assistant turn; the first and the last accept. A row is kept, reroled to the role that the state
wants, or deleted; after each row (and before the first) a layer is closed by inserting the wanted turns, at most one a state.
Each state carries its least (cost, audit), where the audit is the edits' initials D, I, K, R; so ties go to the ASCII-least
audit. Two audits of one state, layer and cost are never one the other's beginning (each row has one letter, and an insert too
many costs), so what is least stays least whatever follows.

Nothing needs a conversation in one task until its digest. Rows are sorted in ranges by (conversation, turn, role, text) and
packed into chunks of at most ROWS rows, fewer where texts are long. A chunk's rows give one symbol each (initial and fault), and the
chunk a 4 x 4 table of least (cost, audit) from state to state. These tables multiply like matrices, so a conversation's
chunks are multiplied in a balanced tree, and the audit of the whole is cut back into chunks. What one task holds of a
conversation is its symbols and its audit, a letter a row, which the result holds in one row too; its texts stay in chunks.
Rows seen earlier are found inside a chunk, and for conversations of several chunks by the digests of their rows.

Defined results: null role and null text are one space; null turn comes first; a null conversation is one of its own; rows of
one turn go by role, then text; repeated rows are duplicates; no rows, no result; any length of text; further columns ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import equal_neighbours, kept, looked_up, written

#: Rows of a chunk; so many bytes of text count as a row more.
ROWS = 64
BYTES = 4096
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTING = (START, ASSISTANT)
#: The state that the wanted turn leads to, and that turn's role.
WANTED = (USER, USER, ASSISTANT, USER)
_KEEPS = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}
_LEGAL = {"su", "ua", "au"}
#: Faults of a row; its symbol is an initial (x for others) and a fault.
FINE, BLANK, DUPLICATE, CUT = ".bdt"
#: Remembered tables of chunks.
REMEMBERED = 4096
_SPACE = b" \t\n\r\x0b\f"

#: state -> (cost, audit), or None where it can't be reached.
Layer = list


def _better(a, b):
    return b if a is None or (b is not None and b < a) else a


def closed(layer: Layer) -> Layer:
    """The layer with inserts: the wanted turn after each state, then the assistant's after an inserted user's."""
    out = list(layer)
    for state in (START, SYSTEM, ASSISTANT, USER):
        if out[state] is not None:
            cost, audit = out[state]
            out[WANTED[state]] = _better(out[WANTED[state]], (cost + INSERT, audit + "I"))
    return out


def step(layer: Layer, initial: str, fault: str) -> Layer:
    out: Layer = [None] * 4
    more = TRUNCATED if fault == CUT else 0
    for state in STATES:
        if layer[state] is None:
            continue
        cost, audit = layer[state]
        out[state] = _better(out[state], (cost + DELETE, audit + "D"))
        if fault in (BLANK, DUPLICATE):
            continue
        to = _KEEPS.get((initial, state))
        if to is not None:
            out[to] = _better(out[to], (cost + more, audit + "K"))
        out[WANTED[state]] = _better(out[WANTED[state]], (cost + REROLE + more, audit + "R"))
    return closed(out)


def table_of(symbols: str) -> list[Layer]:
    """Least (cost, audit) from each state to each state over a chunk's symbols."""
    out = []
    for state in STATES:
        layer: Layer = [None] * 4
        layer[state] = (0, "")
        for i in range(0, len(symbols), 2):
            layer = step(layer, symbols[i], symbols[i + 1])
        out.append(layer)
    return out


def product(a: list[Layer], b: list[Layer]) -> list[Layer]:
    out = []
    for row in a:
        layer: Layer = [None] * 4
        for mid in STATES:
            if row[mid] is not None:
                for to in STATES:
                    if b[mid][to] is not None:
                        layer[to] = _better(layer[to], (row[mid][0] + b[mid][to][0], row[mid][1] + b[mid][to][1]))
        out.append(layer)
    return out


def solved(chunks: list[str]) -> tuple[int, str]:
    """Least (cost, audit) of a conversation whose chunks have these symbols."""
    known = kept("repair-tables")
    tables = []
    for symbols in chunks:
        if symbols not in known:
            if len(known) >= REMEMBERED:
                known.clear()
            known[symbols] = table_of(symbols)
        tables.append(known[symbols])
    while len(tables) > 1:
        tables = [product(*tables[i : i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    first = closed([(0, ""), None, None, None])
    ends = product([first], tables[0])[0] if tables else first
    return min(ends[s] for s in ACCEPTING if ends[s] is not None)


def cut(audit: str, sizes: list[int]) -> list[str]:
    """The audit's letters for each chunk: of its rows, and of the inserts before the next one's."""
    at = np.flatnonzero(np.frombuffer(audit.encode(), np.uint8) != ord("I"))
    starts = np.cumsum([0, *sizes])[:-1]
    edges = [0, *at[starts[1:]].tolist(), len(audit)]
    return [audit[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def edited(audit: str, roles: list[str], texts: list[str], before: str) -> list[tuple[str, str, str]]:
    """(edit, role, text) of each letter; a deleted row has what it had. before: the initial of the last role, empty if none."""
    out, i, last = [], 0, before
    for letter in audit:
        wanted = "assistant" if last == "u" else "user"
        if letter == "I":
            out.append(("I", wanted, ""))
        else:
            out.append((letter, wanted if letter == "R" else roles[i], texts[i]))
            i += 1
        if letter != "D":
            last = out[-1][1][:1]
    return out


def ends_in(audit: str, initials: str, before: str) -> str:
    """The initial of the last role after the audit."""
    last, i = before, 0
    for letter in audit:
        if letter in "IR":
            last = "a" if last == "u" else "u"
        elif letter == "K":
            last = initials[i]
        i += letter != "I"
    return last


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults, by crc32 of `conv_id:turn`: one in twenty dropped, emptied, without sentence ends, repeated, made the user's."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(F.concat_ws(":", said("conv_id"), said("turn"))) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def _packed(turns: DataFrame, most: int) -> DataFrame:
    """Chunks in order: conv_id, chunk, roles, texts, symbols without duplicates of other chunks, digests of its rows, its turns, and whether it is surely the whole conversation."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), F.monotonically_increasing_id().alias("tie"))
    # Rows alike in all four columns may be many; the tie lets ranges cut them too.
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "tie")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", F.spark_partition_id().cast("long").alias("pid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            begins = np.r_[True, ~equal_neighbours(batch, ["conv_id"])]
            sizes = np.asarray(pa.compute.binary_length(batch.column("text")).to_pylist()) // BYTES + 1
            edges, weight = [], 0
            for i in range(n):
                if begins[i] or weight + sizes[i] > most:
                    edges.append(i)
                    weight = 0
                weight += int(sizes[i])
            edges.append(n)
            out: dict[str, list] = {k: [] for k in ("chunk", "roles", "texts", "symbols", "digests", "first_turn", "last_turn", "n_turns", "whole")}
            pid = batch.column("pid")[0].as_py()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                roles, texts, at = (part.column(c).to_pylist() for c in ("role", "text", "turn"))
                digests, symbols, seen = [], [], set()
                for role, text in zip(roles, texts, strict=True):
                    raw = text.encode()
                    digest, body = xxhash.xxh3_128_digest(f"{len(role)}:{role}".encode() + raw), raw.strip(_SPACE)
                    fault = BLANK if not body else DUPLICATE if digest in seen else FINE if body[-1] in b".!?" else CUT
                    seen.add(digest)
                    # A blank row needs no second fault, one seen inside the chunk none from outside.
                    digests.append(None if fault in (BLANK, DUPLICATE) else digest)
                    symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "x") + fault)
                known = [t for t in at if t is not None]
                row = (pid << 33 | number, roles, texts, "".join(symbols), digests, known[0] if known else None, known[-1] if known else None, len(set(known)), bool(0 < a and begins[a] and b < n and begins[b]))
                number += 1
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            conv = batch.column("conv_id").take(pa.array(edges[:-1]))
            yield pa.RecordBatch.from_arrays([conv, *(pa.array(v, t) for v, t in zip(out.values(), types, strict=True))], ["conv_id", *out])

    key = turns.schema["conv_id"].dataType.simpleString()
    return ranged.mapInArrow(run, f"conv_id {key}, chunk bigint, roles array<string>, texts array<string>, symbols string, digests array<binary>, first_turn bigint, last_turn bigint, n_turns bigint, whole boolean")


def _repeats(chunks: DataFrame) -> DataFrame:
    """r_chunk, places: a chunk's rows that stand in an earlier chunk of their conversation."""
    rows = chunks.where("NOT whole").select("conv_id", "chunk", F.posexplode("digests").alias("place", "digest")).where("digest IS NOT NULL")
    # A conversation of one chunk, and a digest of one, has nothing to look up.
    firsts = rows.groupBy(F.col("conv_id").alias("f_conv"), F.col("digest").alias("f_digest")).agg(F.min("chunk").alias("f_chunk"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = looked_up(rows, written(firsts, "repair-firsts"), {"conv_id": "f_conv", "digest": "f_digest"}, "chunk").where("chunk > f_chunk")
    return found.groupBy(F.col("chunk").alias("r_chunk")).agg(F.collect_set("place").alias("places"))


def _solved(chunks: DataFrame) -> DataFrame:
    """a_chunk, audit (its part), before (the initial that it follows), and on a conversation's first chunk its measures."""
    narrow = chunks.select("conv_id", "chunk", "symbols", "first_turn", "last_turn", "n_turns")
    marked = narrow.join(_repeats(chunks), F.col("chunk") == F.col("r_chunk"), "left").drop("r_chunk")
    names = ("a_chunk", "audit", "before", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def finished(rows: list[dict]) -> list[tuple]:
        chunks_ = []
        for r in rows:
            symbols = list(r["symbols"])
            for place in r["places"] or ():
                symbols[2 * place + 1] = DUPLICATE
            chunks_.append("".join(symbols))
        cost, audit = solved(chunks_)
        every = "".join(chunks_)
        initials, faults = every[::2], every[1::2]
        low = next((r["first_turn"] for r in rows if r["first_turn"] is not None), None)
        gaps, last = 0, None
        if low is not None:
            distinct = 0
            for r in rows:
                if r["first_turn"] is not None:
                    distinct += r["n_turns"] - (r["first_turn"] == last)
                    last = r["last_turn"]
            gaps = last - low + 1 - distinct
        illegal = sum(initials[i : i + 2] not in _LEGAL for i in range(len(initials) - 1))
        whole = (gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost)
        out, before = [], ""
        for r, own, part in zip(rows, chunks_, cut(audit, [len(c) // 2 for c in chunks_]), strict=True):
            out.append((r["chunk"], part, before, *(whole if not out else (None,) * 6)))
            before = ends_in(part, own[::2], before)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if held and row["conv_id"] != held[0]["conv_id"]:
                    done += finished(held)
                    held = []
                held.append(row)
            yield as_batch(done)
        yield as_batch(finished(held) if held else [])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.string(), pa.string(), *(pa.int64(),) * 6)
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], list(names))

    in_order = marked.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return in_order.mapInArrow(run, "a_chunk bigint, audit string, before string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint")


def repair(turns: DataFrame, rows: int = ROWS) -> DataFrame:
    """conv_id, chunk, edits array<struct<edit, role, text>>, audit, and on a conversation's first chunk gaps, blank, duplicate, truncated, illegal, cost.

    turns: conv_id, turn (whole number), role, text. A conversation's chunks in order, without deleted edits, are the repaired conversation.
    """
    chunks = written(_packed(turns, rows), "repair-chunks")
    both = chunks.select("conv_id", "chunk", "roles", "texts").join(_solved(chunks), F.col("chunk") == F.col("a_chunk")).drop("a_chunk")
    further = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                columns = [part.column(c).to_pylist() for c in ("audit", "roles", "texts", "before")]
                edits = [[dict(zip(("edit", "role", "text"), e, strict=True)) for e in edited(*r)] for r in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("chunk"), pa.array(edits, kind), *(part.column(c) for c in ("audit", *further))], ["conv_id", "chunk", "edits", "audit", *further])

    key = turns.schema["conv_id"].dataType.simpleString()
    return both.mapInArrow(run, f"conv_id {key}, chunk bigint, edits array<struct<edit:string,role:string,text:string>>, audit string, " + ", ".join(f"{c} bigint" for c in further))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """conv_id, chunk, place, edit, role, text: a row for each turn that the repair leaves."""
    return repaired.select("conv_id", "chunk", F.posexplode("edits").alias("place", "e")).select("conv_id", "chunk", "place", "e.*").where("edit <> 'D'")


def reports(repaired: DataFrame) -> DataFrame:
    """A row for each conversation: its measures, audit, and the digest of its repaired turns, whose texts stream by in chunks."""
    said = F.transform(F.filter("edits", lambda e: e["edit"] != "D"), lambda e: F.concat(e["role"], F.lit(":"), e["text"]))
    further = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    rows = repaired.select("conv_id", "chunk", F.array_join(said, "\n").alias("text"), F.size(said).alias("n"), "audit", *further)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key_type = None, None
        for batch in batches:
            done, key_type = [], batch.schema.field("conv_id").type
            for lo in range(0, batch.num_rows, 200):
                for r in batch.slice(lo, 200).to_pylist():
                    if state and r["conv_id"] != state[0]:
                        done.append(ended(state))
                        state = None
                    if state is None:
                        state = (r["conv_id"], tuple(r[c] for c in further), [], hashlib.sha256(), [False])
                    state[2].append(r["audit"])
                    if r["n"]:
                        state[3].update((("\n" if state[4][0] else "") + r["text"]).encode())
                        state[4][0] = True
            yield as_batch(done, key_type)
        if state:
            yield as_batch([ended(state)], key_type)

    def ended(state) -> tuple:
        return (state[0], *state[1], "".join(state[2]), state[3].hexdigest())

    def as_batch(rows: list[tuple], key_type) -> pa.RecordBatch:
        types = (key_type, *(pa.int64(),) * 6, pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["conv_id", *further, "audit", "repaired_sha256"])

    key = repaired.schema["conv_id"].dataType.simpleString()
    in_order = rows.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return in_order.mapInArrow(run, f"conv_id {key}, " + ", ".join(f"{c} bigint" for c in further) + ", audit string, repaired_sha256 string")
