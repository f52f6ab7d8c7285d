"""Chat formatting in budgeted windows.

Prefix sums of the turns' tokens place every turn: the line of a conversation's tokens is cut every `stride` tokens,
where the stride is the budget less the system turn that begins the conversation (half of the budget at least). The
turns that lie within one cell are a span, a turn that crosses a cut is a span of its own. Spans are so turn-aligned, at
most a stride long or one turn, and known from a turn's own prefix sum. A window is a span, before it the system turn,
and between them the whole turns that lie within `history` tokens and what is left of the budget, right before the span:
contiguous, none if the last one is too long. So system turn, history and span together keep within the budget, but for
what cannot be cut: a lone turn of more than a stride, a system turn of more than half of the budget. What a window
repeats is masked; of its own turns the assistant's texts carry the loss, each once.

Rows are sorted by (conv_id, turn) in ranges, which cut long conversations; a range's sums give the offsets
of the next, so that no conversation is gathered before it is packed into spans. Only reading back, which makes one
digest of a conversation's turns in order, streams its windows through one task.

The template is `<|role|>` newline text `</|>` newline. Control strings begin with one of `<`, `|` and `[`; inside
roles and texts a backslash follows each of these, whatever stands next, and each backslash is doubled. So no control
string remains, also none that overlaps another, and `unescape` gives every text back.

Defined results: null text and null role are empty; null turn comes first; a null conversation is one of its
own; ties of a turn go by role, then text; repeated rows are turns; empty table, empty result; further columns ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrymill.llm.common import looked_up, n_words, written

#: Tokens of a window, and of the history that it repeats.
BUDGET = 1280
HISTORY = 256
#: Tokens that the template adds to a turn.
TURN_TOKENS = 4
#: Control strings of common templates; each begins with one of OPENERS.
CONTROLS = ("<|", "|>", "</|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
OPENERS = "<|["
#: System turns of at most so many conversations are broadcast.
SYSTEMS = 2000
_END = "</|>\n"
_ESCAPE = str.maketrans({c: c + "\\" for c in OPENERS} | {"\\": "\\\\"})
_ESCAPED = re.compile(r"([<|\[])\\|\\\\")


def escape(text: str) -> str:
    return text.translate(_ESCAPE)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] or "\\", text)


def turn_text(role: str, text: str) -> tuple[str, int]:
    """(formatted turn, where its text starts)."""
    head = f"<|{escape(role)}|>\n"
    return f"{head}{escape(text)}{_END}", len(head)


def format_window(system: tuple | None, history: list, own: list) -> tuple[str, int, list[tuple[int, int]]]:
    """(text, number of repeated turns, loss spans in code points)."""
    out, at, loss = [], 0, []
    repeated = ([system] if system else []) + history
    for i, (role, text) in enumerate([*repeated, *own]):
        s, head = turn_text(role, text)
        if i >= len(repeated) and role == "assistant":
            loss.append((at + head, at + len(s) - len(_END)))
        out.append(s)
        at += len(s)
    return "".join(out), len(repeated), loss


def read_window(text: str, n_repeated: int, loss: list[tuple[int, int]]) -> tuple[list[tuple[str, str]], list[str]]:
    """(own turns, texts under the loss mask) back from a formatted window."""
    turns = []
    for s in text.split(_END)[n_repeated:-1]:
        stop = s.index("|>\n", 2)
        turns.append((unescape(s[2:stop]), unescape(s[stop + 3 :])))
    return turns, [unescape(text[a:b]) for a, b in loss]


def _placed(turns: DataFrame) -> DataFrame:
    """conv_id, seq, role, text, start, stop: tokens before and up to the end of each turn."""
    rows = turns.select(F.col("conv_id"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("conv_id", "role", "text", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("seq"), (n_words(F.col("text")) + TURN_TOKENS).alias("n"))
    ranged = written(ranged, "chat-turns")
    sums = ranged.groupBy("conv_id", "pid").agg(F.sum("n").alias("n"), F.min("seq").alias("low"))
    ahead = F.sum("n").over(W.partitionBy("conv_id").orderBy("pid").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select(F.col("conv_id").alias("o_conv"), F.col("pid").alias("o_pid"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inside = F.sum("n").over(W.partitionBy("conv_id", "pid").orderBy("seq"))
    placed = ranged.withColumn("upto", inside).join(sums, F.col("conv_id").eqNullSafe(F.col("o_conv")) & (F.col("pid") == F.col("o_pid")))
    return placed.select("conv_id", "seq", "role", "text", (F.col("ahead") + F.col("upto") - F.col("n")).alias("start"), (F.col("ahead") + F.col("upto")).alias("stop"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, span, text, n_repeated, loss: turns has conv_id, turn, role, text."""
    if not 0 <= history <= budget // 2:
        raise ValueError("the history must fit in half of the budget")
    placed = _placed(turns)
    opens = (F.col("start") == 0) & (F.col("role") == "system")
    begun = placed.where(opens).select(F.col("conv_id").alias("b_conv"), F.col("stop").alias("taken"))
    placed = looked_up(placed, written(begun, "chat-systems"), {"conv_id": "b_conv"}, "seq", "left").drop("b_conv")
    placed = placed.withColumn("taken", F.coalesce("taken", F.lit(0))).withColumn("stride", budget - F.least("taken", F.lit(budget // 2)))
    cell = F.floor(F.col("start") / F.col("stride"))
    crosses = F.col("stop") > (cell + 1) * F.col("stride")
    placed = written(placed.withColumn("own", cell * 2 + crosses.cast("long")), "chat-placed")
    # A window's start is that of its first own turn; the system turn is repeated in all but its own.
    begins = placed.groupBy("conv_id", "own").agg(F.min("start").alias("begin"), F.max("stop").alias("end"), F.first("taken").alias("room")).where("begin > 0")
    room = F.greatest(F.lit(0), F.least(F.lit(history), budget - F.col("room") - (F.col("end") - F.col("begin"))))
    begins = begins.select(F.col("conv_id").alias("w_conv"), F.col("own").alias("at"), "begin", (F.col("begin") - room).alias("since"))
    # A turn can be history in its own cell's crossing window, and in the cells that start within `history` after it.
    last = cell + 1 + F.floor(F.lit(history) / F.col("stride"))
    ahead = F.filter(F.sequence(cell + 1, last), lambda c: c * F.col("stride") - history <= F.col("start"))
    spans = F.concat(F.array(cell * 2 + 1), F.flatten(F.transform(ahead, lambda c: F.array(c * 2, c * 2 + 1))))
    tried = placed.where(~opens).withColumn("to", F.explode(spans)).where("`to` <> own")
    same = F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("to") == F.col("at"))
    late = tried.join(begins, same & (F.col("start") >= F.col("since")) & (F.col("stop") <= F.col("begin"))).select(*placed.columns, "at")
    placed = placed.withColumn("at", F.col("own")).unionByName(late)
    packed = placed.groupBy("conv_id", F.col("at").alias("span")).agg(F.sort_array(F.collect_list(F.struct("seq", (F.col("own") == F.col("at")).alias("mine"), (F.col("start") == 0).alias("opens"), "role", "text"))).alias("turns"))
    opening = F.element_at("turns", 1)
    packed = written(packed, "chat-spans")
    systems = packed.where((F.col("span") < 2) & opening["opens"] & (opening["role"] == "system") & opening["mine"]).select(F.col("conv_id").alias("s_conv"), opening["text"].alias("system"))
    joined = looked_up(packed, written(systems, "chat-openings"), {"conv_id": "s_conv"}, "span", "left", SYSTEMS).select("conv_id", "span", "turns", "system")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                rows = []
                for turns_, system in zip(part.column("turns").to_pylist(), part.column("system").to_pylist(), strict=True):
                    pick = lambda mine: [(t["role"], t["text"]) for t in turns_ if t["mine"] == mine and (mine or not (t["opens"] and t["role"] == "system"))]  # noqa: B023, E731
                    first = any(t["opens"] and t["mine"] for t in turns_)
                    rows.append(format_window(None if system is None or first else ("system", system), pick(False), pick(True)))
                loss = pa.array([[{"start": a, "stop": b} for a, b in r[2]] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("span"), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), loss], ["conv_id", "span", "text", "n_repeated", "loss"])

    key = turns.schema["conv_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"conv_id {key}, span bigint, text string, n_repeated bigint, loss array<struct<start:bigint,stop:bigint>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: by streaming the windows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        fresh = lambda: [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
        conv, state, begun, kind = None, fresh(), False, None
        for batch in batches:
            done, kind = [], batch.schema.field("conv_id").type
            for lo in range(0, batch.num_rows, 200):
                for r in batch.slice(lo, 200).to_pylist():
                    if begun and r["conv_id"] != conv:
                        done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                        state = fresh()
                    conv, begun = r["conv_id"], True
                    turns, loss = read_window(r["text"], r["n_repeated"], [(x["start"], x["stop"]) for x in r["loss"]])
                    for role, text in turns:
                        state[1].update(f"{role}\n{text}\n".encode())
                    for text in loss:
                        state[2] += len(text)
                        state[3].update(text.encode())
                    state[0] += len(turns)
                    state[4] += len(r["text"])
            yield _batch(done, kind, names)
        if begun:
            yield _batch([(conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])], kind, names)

    def _batch(rows, key, names):
        types = (key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    key = formatted.schema["conv_id"].dataType.simpleString()
    sorted_ = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "span")
    return sorted_.mapInArrow(run, f"conv_id {key}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
