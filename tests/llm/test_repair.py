"""Conversation repair against all sequences of edits, over chunks of every size."""

import hashlib
import itertools
import random
import re

import pytest

from quarrymill.llm import catalog, repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def faults_of(rows):
    out = []
    for i, (role, text) in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("b" if not body else "d" if (role, text) in rows[:i] else "." if body[-1] in ".!?" else "t")
    return out


def brute(rows):
    """Least (cost, audit, repaired) over all edits with up to two inserts at a place (more can be left out in pairs)."""
    faults, best = faults_of(rows), None
    inserts = ["", "u", "a", "ua", "au"]
    full = {"u": "user", "a": "assistant"}
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product("KDua", repeat=len(rows)):
            if any(e != "D" and f in "bd" for e, f in zip(edits, faults, strict=True)):
                continue
            cost, audit, said = 0, "", []
            for gap, e, f, row in zip(gaps, [*edits, None], [*faults, None], [*rows, None], strict=True):
                cost, audit = cost + 3 * len(gap), audit + "I" * len(gap)
                said += [(full[x], "") for x in gap]
                if e:
                    cost += 4 if e == "D" else (f == "t") * 3 + (e != "K") * 3
                    audit += e if e in "KD" else "R"
                    said += [] if e == "D" else [(row[0] if e == "K" else full[e], row[1])]
            if GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in said)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, said)
    return best


def report(rows):
    """What the contract says of (turn, role, text) rows in order."""
    said = [(r, t) for _, r, t in rows]
    faults, initials = faults_of(said), [r[:1] for r, _ in said]
    cost, audit, fixed = brute(said)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)


def made(seed, conversations, longest=3):
    rng, out = random.Random(seed), []
    for c in range(conversations):
        for _ in range(rng.randint(1, longest)):
            out.append((c, rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), rng.choice(["Yes.", "No!", "cut off", "", " \n", "Yes. "])))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


@pytest.mark.parametrize("most", [1, 2, 64])
def test_every_edit(spark, most):
    rows = made(most, 25)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.reports(repair.repair(spark.createDataFrame(rows, SCHEMA), most)).collect()}
    for c in {r[0] for r in rows}:
        own = [(t, r, x) for _, t, r, x in in_order([r for r in rows if r[0] == c])]
        assert got[c] == report(own), own


def test_chunks_do_not_matter(spark):
    """One conversation of most rows, with common texts, in chunks of 3 and of 64."""
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.6 else rng.randint(1, 60), rng.randint(0, 900), rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", f"{i}.", f"{i}", ""])) for i in range(1500)]
    turns = spark.createDataFrame(rows, SCHEMA)
    few, many = (sorted(map(tuple, repair.reports(repair.repair(turns, n)).collect())) for n in (3, 64))
    assert few == many
    # Audits lead to whole conversations, and say what the repaired turns are.
    repaired = repair.repaired_turns(repair.repair(turns, 5)).orderBy("conv_id", "chunk", "place").collect()
    for c, _, _, _, _, _, _, audit, digest in many:
        own = [r for r in repaired if r["conv_id"] == c]
        assert GRAMMAR.fullmatch("".join(r["role"][:1] for r in own))
        assert "".join(r["edit"] for r in own) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in own).encode()).hexdigest() == digest


def test_tree_equals_row_by_row():
    rng = random.Random(3)
    for _ in range(300):
        symbols = "".join(rng.choice("suax") + rng.choice("..bdt") for _ in range(rng.randint(0, 40)))
        size = 2 * rng.randint(1, 7)
        chunks = [symbols[i : i + size] for i in range(0, len(symbols), size)]
        assert repair.solved(chunks) == repair.solved([symbols] if symbols else [])
        audit = repair.solved(chunks)[1]
        assert "".join(repair.cut(audit, [len(c) // 2 for c in chunks]) if chunks else [audit]) == audit


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, a null conversation, a text of over 1 MB, rows alike, further columns of odd and clashing names; an empty table."""
    long = "word " * 250_000 + "end."
    rows = [(None, 0, "user", "Hi."), (None, None, None, None), (1, 1, "user", long), (1, 2, "assistant", long[:-1]), (2, None, None, "x."), (3, 5, "user", "Same."), (3, 5, "user", "Same."), (3, 5, "user", "Same.")]
    plain = spark.createDataFrame(rows, SCHEMA)
    odd = plain.selectExpr("*", "1 AS chunk", "'a' AS symbols", "2 AS `a.b`", "3 AS pid")
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.reports(repair.repair(odd)).collect()}
    for c in (None, 1, 2, 3):
        own = [(t, " " if r is None else r, " " if x is None else x) for k, t, r, x in rows if k == c]
        assert got[c] == report([(t, r, x) for _, t, r, x in in_order([(c, *r) for r in own])])
    assert repair.reports(repair.repair(plain.limit(0))).count() == 0
    # Null keys and a conversation that loses all its rows.
    keys = [(c, t) for c in (None, *range(40)) for t in (None, 0, 1)]
    spark.createDataFrame([(c, t, None if t == 0 else "user", f"{c}?") for c, t in keys], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    against_sql(spark, str(tmp_path), ("conversations",), "op11_conversation_repair")


def against_sql(spark, folder, tables, *names):
    import duckdb

    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    for name in names:
        want = con.execute(catalog.ORACLES[name])
        columns = [c[0] for c in want.description]
        got = catalog.QUERIES[name](spark, folder)
        assert sorted(got.columns) == sorted(columns)
        assert sorted(repr(tuple(r)) for r in got.select(columns).collect()) == sorted(repr(tuple(r)) for r in want.fetchall()), name
