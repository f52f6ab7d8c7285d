"""Quality rules and fill-in-middle: odd rows, SQL, brute force, round trips."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quarrymill.llm import infill, rules

from test_repair import against_sql

ODD = [
    (None, None),
    (0, None),
    (1, ""),
    (2, " \n\t \n"),
    (3, "one two three"),
    (4, "a a a a a"),
    (5, "x y z\nx y z\n\nx y z\n"),
    (6, "äöü ÄÖÜ 日本語 😀😀 \x1f  no break\n"),
    (7, "<P> held"),
    (8, " lead and trail \r\n"),
    (9, "- a\n* b\n• c\n# d | e <S> $"),
    (10, "SHOUT!! " * 60),
    (11, "word " * 250_000),
    (12, "w" * 1_200_000),
    (13, "-- 12 == 34 ~~ " * 20),
    (13, "-- 12 == 34 ~~ " * 20),
    (14, " ".join(f"w{i}" for i in range(80))),
    (15, "<" * 30 + "S>" * 3),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    rows = ODD + [(100 + i, f" a{i}  b\tc{i} d<\ne>S {'x ' * (i % 7)}<") for i in range(150)]
    rows = spark.createDataFrame(rows, "doc_id long, text string")
    rows.selectExpr("*", "'x' AS n", "1 AS units", "2 AS fail_bits", "3 AS `a.b`").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_odd_rows(spark, odd):
    against_sql(spark, odd, ("documents",), "op12_quality_rules", "rule_ablations", "op13_fill_in_middle")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rules.decided(rules.ledger(none)).count() == 0 and infill.transformed(none).count() == 0
    assert {(r["n_failed"], r["n_alone"], r["n_kept"]) for r in rules.ablations(rules.patterns(rules.ledger(none))).collect()} == {(0, 0, 0)}


def measured(text):
    """The contract's four counts by brute force."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_measures(spark):
    rows = [r for r in ODD if len(r[1] or "") < 5000]
    got = rules.measures(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in got)) == sorted(measured(t or "") for _, t in rows)


def test_policies_from_the_ledger(spark, odd):
    entries = rules.ledger(spark.read.parquet(f"{odd}/documents.parquet")).cache()
    bits = [r["fail_bits"] for r in entries.collect()]
    counts = rules.patterns(entries)
    keeps = lambda p, b: not b & p.hard and (b & p.soft).bit_count() <= p.most
    for policy in rules.POLICIES.values():
        assert rules.decided(entries, policy).where("kept").count() == sum(keeps(policy, b) for b in bits)
        for r in rules.ablations(counts, policy).collect():
            bit = rules.mask(r["rule"])
            without = rules.Policy(0, policy.hard & ~bit, policy.soft & ~bit, policy.most)
            assert (r["n_failed"], r["n_alone"], r["n_kept"]) == (sum(b & bit > 0 for b in bits), sum(keeps(without, b) and not keeps(policy, b) for b in bits), sum(keeps(policy, b) for b in bits))
    first, last = rules.POLICIES[1], rules.POLICIES[2]
    assert sum(r["n"] for r in rules.changed(counts, first, last).collect() if r["kept_before"] != r["kept_after"]) == sum(keeps(first, b) != keeps(last, b) for b in bits)
    whole = rules.shared_failures(counts.withColumn("all", F.lit(1)), "all").first()
    assert whole["n"] == len(bits) and all((whole["any_bits"] >> r.bit & 1) == any(b >> r.bit & 1 for b in bits) for r in rules.RULES)
    entries.unpersist()


def test_rules_keep_their_bits():
    assert len({r.bit for r in rules.RULES}) == len(rules.RULES)
    assert rules.BASE == rules.mask("few_words", "repeated_words")


def test_infill_by_hand(spark, odd):
    rows = infill.transformed(spark.read.parquet(f"{odd}/documents.parquet")).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    texts = dict(spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text").collect())
    forms = set()
    for r in rows:
        text = texts[r["doc_id"]] or ""
        forms.add(r["form"])
        assert r["back"] == text
        units = re.findall(infill.UNIT, text)
        h = hashlib.sha256(f"42:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
        low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
        if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
            assert tuple(r)[1:6] == (len(units), "plain", None, None, text)
        else:
            form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
            assert tuple(r)[1:6] == (len(units), form, len(p), len(m), out)
    assert forms == {"plain", "psm", "spm"}
