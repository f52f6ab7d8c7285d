"""Quality rules as a ledger of bits.

`ledger` reads every text once: it measures it and evaluates every rule of RULES, whose failures are bits of one long. What
is kept is decided later, from the ledger alone: a policy is a version, a mask of rules that must hold, and a mask of rules of
which a number may fail. So a new policy, the difference between two and the ablation of each rule need no text again:
`ablations` counts documents by their failure bits (at most a row for each combination that occurs, summed before the shuffle)
and works on these. A rule keeps its bit for ever; one that changes gets another bit and RULES_VERSION goes up.

Nothing is shuffled but counts. A text's measures depend on that text only. Lengths are code points; words are longest runs of
characters other than ASCII white space; capitals and letters are told by ASCII (every byte beyond ASCII counts as a letter's).

Defined results: null text is an empty one; an empty text has measures of 0 and fails `few_words` alone; equal texts equal
measures; any length is read whole; an empty table gives an empty ledger, and ablations with counts of 0; further columns, of
whatever name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import as_bytes, pieces

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_capitals", "n_bullets", "longest_word")
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\f"
_CAPITALS = bytes(range(65, 91))
#: ASCII that is neither a letter nor white space.
_PLAIN = bytes(c for c in range(128) if not chr(c).isalpha() and c not in _SPACE)
_BULLETS = ("-", "*", "•", "◦", "‣")
_BULLET_BYTES = tuple(b.encode() for b in _BULLETS)
RULES_VERSION = 1


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    #: SQL over the measures, true where the rule fails.
    fails: str


#: Whole-number conditions, so that no rounding decides. Base rules first.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "few_letter_words", "100 * n_letter_words < 70 * n_words"),
    Rule(4, "short_words", "word_chars < 3 * n_words"),
    Rule(5, "long_words", "word_chars > 12 * n_words"),
    Rule(6, "capitals", "2 * n_capitals > word_chars"),
    Rule(7, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(8, "bullets", "100 * n_bullets > 90 * n_lines"),
    Rule(9, "endless_word", "longest_word > 1000"),
)
BASE = 0b11


@dataclass(frozen=True)
class Policy:
    version: int
    #: Rules that must hold.
    hard: int
    #: Rules of which at most `most` may fail.
    soft: int = 0
    most: int = 0

    def keeps(self, bits: Column) -> Column:
        return (bits.bitwiseAND(F.lit(self.hard)) == 0) & (F.bit_count(bits.bitwiseAND(F.lit(self.soft))) <= self.most)


def mask(*names: str) -> int:
    known = {r.name: 1 << r.bit for r in RULES}
    return sum(known[n] for n in names)


#: All versions stay, so that an earlier verdict can be had again.
POLICIES = {
    1: Policy(1, BASE | mask("symbols", "few_letter_words", "capitals")),
    2: Policy(2, BASE | mask("symbols", "few_letter_words", "capitals"), mask("short_words", "long_words", "repeated_lines", "bullets", "endless_word"), 1),
}
CURRENT = 2


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that stand twice or more, the first one's included."""
    if len(words) < 4:
        return 0
    names = dict(zip(dict.fromkeys(words), range(len(words))))  # noqa: B905
    ids = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    _, pair = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)
    _, at, count = np.unique(pair[:-1] * len(names) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[at] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def measured(text: bytes) -> tuple[int, ...]:
    """The MEASURES of a UTF-8 text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    joined = b"".join(words)
    begun = sum(x.lstrip(_SPACE).startswith(_BULLET_BYTES) for x in lines)
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(joined) - len(joined.translate(None, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(text.translate(None, _PLAIN).split()),
        len(joined) - len(joined.translate(None, _CAPITALS)),
        begun,
        max(map(len, words), default=0),
    )


def measures(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and the MEASURES (longs): one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = np.array([measured(t) for t in as_bytes(part, "text")], np.int64).reshape(-1, len(MEASURES))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(rows[:, i].copy()) for i in range(len(MEASURES)))], ["doc_id", *MEASURES])

    picked = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    key = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {key}, " + ", ".join(f"{m} bigint" for m in MEASURES))


def ledger(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, the MEASURES, fail_bits long, rules_version int."""
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measures(docs, id_col, text_col).withColumns({"fail_bits": bits, "rules_version": F.lit(RULES_VERSION)})


def decided(entries: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """The ledger with base_failed, kept, and the names of the failed rules."""
    bits = F.col("fail_bits")
    base = bits.bitwiseAND(F.lit(BASE)) != 0
    failed = F.filter(F.array(*(F.when(bits.bitwiseAND(F.lit(1 << r.bit)) != 0, r.name) for r in RULES)), lambda x: x.isNotNull())
    return entries.withColumns({"base_failed": base, "kept": ~base & policy.keeps(bits), "failed": failed, "policy_version": F.lit(policy.version)})


def patterns(entries: DataFrame, *by: str) -> DataFrame:
    """by..., fail_bits, n: documents by failure bits. All below works on this."""
    return entries.groupBy(*(F.col(f"`{c}`") for c in by), "fail_bits").agg(F.count("*").alias("n"))


def ablations(counts: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """rule, n_failed, n_alone (kept if only this rule went), n_kept: a row for each rule. counts: of `patterns`."""
    bits, keeps = F.col("fail_bits"), lambda without: Policy(0, policy.hard & ~without, policy.soft & ~without, policy.most).keeps(F.col("fail_bits"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    # One pass over the patterns: three sums a rule, then a row a rule.
    each = [F.struct(F.lit(r.name).alias("rule"), total(bits.bitwiseAND(F.lit(1 << r.bit)) != 0).alias("n_failed"), total(~policy.keeps(bits) & keeps(1 << r.bit)).alias("n_alone"), total(policy.keeps(bits)).alias("n_kept")) for r in RULES]
    return counts.agg(F.array(*each).alias("rules")).select(F.inline("rules"))


def shared_failures(counts: DataFrame, *by: str) -> DataFrame:
    """by..., n, any_bits, all_bits, odd_bits: rules that any, all and an odd number of patterns of a group fail."""
    return counts.groupBy(*by).agg(F.sum("n").alias("n"), F.bit_or("fail_bits").alias("any_bits"), F.bit_and("fail_bits").alias("all_bits"), F.bit_xor("fail_bits").alias("odd_bits"))


def changed(counts: DataFrame, before: Policy, after: Policy) -> DataFrame:
    """kept_before, kept_after, n: what another version of the policy does to the ledger's documents."""
    bits = F.col("fail_bits")
    return counts.groupBy(before.keeps(bits).alias("kept_before"), after.keeps(bits).alias("kept_after")).agg(F.sum("n").alias("n"))
