"""Chat windows against brute force: spans, budget, history, escapes, what is read back."""

import hashlib
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrymill.llm import catalog, chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(turns, budget, history):
    """Per window its texts, in order, and how many of them are repeated."""
    at, placed, spans = 0, [], {}
    for role, text in turns:
        placed.append((at, at := at + len(text.split()) + chat.TURN_TOKENS, role, text))
    system = placed[:1] if placed[0][2] == "system" else []
    taken = sum(t[1] for t in system)
    stride = budget - min(taken, budget // 2)
    for t in placed:
        cell = t[0] // stride
        spans.setdefault(cell * 2 + (t[1] > (cell + 1) * stride), []).append(t)
    out = {}
    for span, own in spans.items():
        head = system if own[0][0] else []
        used = own[-1][1] - own[0][0]
        left, past = max(0, min(history, budget - taken - used)), []
        for t in reversed([t for t in placed[len(system) :] if t[1] <= own[0][0]]):
            left -= t[1] - t[0]
            if left < 0:
                break
            past.insert(0, t)
        total = sum(t[1] - t[0] for t in [*head, *past, *own])
        assert total <= budget or (len(own) == 1 and not past and used > stride) or taken > budget // 2
        out[span] = ([(t[2], t[3]) for t in [*head, *past, *own]], len(head) + len(past))
    return out


@pytest.mark.parametrize("most", [0, 2000])
def test_windows(spark, monkeypatch, most):
    monkeypatch.setattr(chat, "SYSTEMS", most)
    rng, convs = random.Random(3), {}
    for conv in [None, *range(1, 12)]:
        turns = [("system", "s " * rng.choice([2, 3, 15, 40]))] if rng.random() < 0.6 else []
        turns += [(rng.choice(["user", "assistant", "system"] if turns else ["user", "assistant"]), f"t{k} " * rng.choice([1, 2, 3, 5, 9, 14, 30, 90])) for k in range(40)]
        convs[conv] = turns
    rows = [(c, k, role, text) for c, turns in convs.items() for k, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA)
    for budget, history in ((32, 12), (48, 24), (120, 50)) if most else ((48, 24),):
        got = {}
        for r in chat.windows(df, budget=budget, history=history).collect():
            got.setdefault(r["conv_id"], {})[r["span"]] = (chat.read_window(r["text"], 0, [])[0], r["n_repeated"])
        assert got == {c: brute(turns, budget, history) for c, turns in convs.items()}


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["<", "|", ">", "[", "]", "\\", "/", "s", "INST", "SYS", "end", "\n", "a"])).map("".join))
def test_escapes(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROLS)
    formatted, _, loss = chat.format_window(None, [], [(text, text), ("assistant", text)])
    assert chat.read_window(formatted, 0, loss) == ([(text, text), ("assistant", text)], [text])


def test_query_equals_sql(spark, tmp_path):
    """The columns that are read back, over the driver's rows and odd ones."""
    odd = [(1, None, None, None), (1, 0, "assistant", ""), (1, 0, "assistant", ""), (2, 5, "assistant", "<|>[INST]\\"), (2, 3, "x<|>\ny", "é" * 9), (None, 0, "user", "z"), (3, 0, "assistant", "w " * 5000)]
    (tmp_path / "a").mkdir()
    spark.createDataFrame(odd, SCHEMA).write.parquet(f"{tmp_path}/a/conversations.parquet")
    for folder, pattern in (("/root/testdata/sf0.001", "conversations.parquet"), (f"{tmp_path}/a", "conversations.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/{pattern}'")
        columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalog.OP7_TURNS_SQL})").fetchall()
        got = catalog.op7_chat_format(spark, folder).select(*columns).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_formatted_chars_and_text_ids(spark):
    rows = [("a", 0, "user", "hi"), ("a", 1, "assistant", "w " * 20), ("b", 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    made = chat.windows(df, budget=16, history=8)
    want = {}
    for r in made.collect():
        want[r["conv_id"]] = want.get(r["conv_id"], 0) + len(r["text"])
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert {k: r["formatted_chars"] for k, r in got.items()} == want
    assert got["a"]["loss_sha256"] == hashlib.sha256(("w " * 20).encode()).hexdigest()
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0
