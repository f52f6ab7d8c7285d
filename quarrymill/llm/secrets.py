"""Secret scan by a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: a literal run gives the conjunction of
its trigrams, an alternation the disjunction of its branches. Documents are indexed in blocks: for every
trigram that a rule mentions, the block has the postings (the documents that hold it); a rule's query is
answered by intersecting and uniting postings, and only the candidates are verified with the pattern.
A rule that implies no trigram scans every document. Trigrams are taken from ASCII-lower-cased UTF-8, so
that they hold for patterns which ignore the case of ASCII letters.

Spans are code points, end exclusive. Defined results: null or empty text has no spans; equal texts equal
results; any length is scanned whole; an empty table gives an empty result; a document's row is
independent of all others, so ties and repeated rows need no rule; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarrymill.llm.common import as_bytes, pieces

try:
    from re import _parser as _sre
except ImportError:  # Python before 3.11
    import sre_parse as _sre


def any_case(word: str) -> str:
    """A pattern for word with ASCII letters in either case, without Unicode's case folding."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else re.escape(c) for c in word)


_KEYS = "|".join([any_case(w) for w in ("password", "passwd", "secret", "token")] + [any_case("api") + "_?" + any_case("key")])

#: kind -> (pattern, group that must be long enough, least length). The first three are the base rules.
RULES: dict[str, tuple[str, int, int]] = {
    "assign": (rf"({_KEYS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "private_key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    "vcs_token": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    "chat_token": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    "maps_key": (r"AIza[A-Za-z0-9_-]{35,}", 0, 1),
    "url_password": (r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{3,128}@", 0, 1),
}
BASE = ("assign", "access", "hex")

#: A character class of at most so many literals is expanded.
MOST_CHARS = 16
#: A query is True (no trigram follows), a trigram, or ("and" | "or", queries).
Query = object


def _all(parts) -> Query:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _literal(text: bytes) -> Query:
    return _all(text[i : i + 3] for i in range(len(text) - 2))


def _walk(parsed, found: list, run: bytes) -> bytes:
    """Append the queries that parsed implies; return the literal run that is still open at its end."""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            run += chr(arg).encode().lower()
            continue
        if name == "IN":
            chars = {chr(v).encode().lower() if str(k) == "LITERAL" else None for k, v in arg}
            if len(chars) == 1 and None not in chars:
                run += chars.pop()
                continue
            if None not in chars and len(chars) <= MOST_CHARS and len(run) >= 2:
                # A few characters after two that are known: one of so many trigrams.
                found += [_literal(run), _any(run[-2:] + c for c in sorted(chars) if len(c) == 1) if all(len(c) == 1 for c in chars) else True]
                run = b""
                continue
        if name == "SUBPATTERN" and not arg[1] and not arg[2]:
            run = _walk(arg[3], found, run)
            continue
        if name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            run = _walk(arg[2], found, run)
        found.append(_literal(run))
        run = b""
        if name == "BRANCH":
            found.append(_any(_query(b) for b in arg[1]))
    return run


def _query(parsed) -> Query:
    found: list = []
    found.append(_literal(_walk(parsed, found, b"")))
    return _all(found)


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every text with a match of pattern satisfies.

    Where the pattern as a whole ignores the case of letters beyond ASCII (s also matches U+017F), no trigram follows.
    """
    parsed = _sre.parse(pattern)
    return True if parsed.state.flags & re.IGNORECASE and not parsed.state.flags & re.ASCII else _query(parsed)


def trigrams(query: Query) -> set[bytes]:
    return set() if query is True else {query} if isinstance(query, bytes) else set().union(*map(trigrams, query[1]))


class BlockIndex:
    """Postings of the wanted trigrams in a block of texts."""

    def __init__(self, texts: list[bytes], wanted: set[bytes]):
        self.n = len(texts)
        blob = b"\xff".join(texts).lower()  # 255 is in no UTF-8 text
        b = np.frombuffer(blob, np.uint8)
        self.postings: dict[bytes, np.ndarray] = {}
        if len(b) < 3 or not wanted:
            return
        starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        # One hashed table lookup a byte finds the places where a wanted trigram may stand.
        table = np.zeros(1 << 16, bool)
        for t in wanted:
            table[t[0] << 8 | t[1]] = True
        at = np.flatnonzero(table[(b[:-2].astype(np.uint16) << 8) | b[1:-1]])
        code = (b[at].astype(np.int32) << 16) | (b[at + 1].astype(np.int32) << 8) | b[at + 2]
        for t in wanted:
            own = at[code == (t[0] << 16 | t[1] << 8 | t[2])]
            self.postings[t] = np.unique(np.searchsorted(starts, own, "right") - 1)

    def candidates(self, query: Query) -> np.ndarray:
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings.get(query, np.empty(0, np.int64))
        op, parts = query
        sets = [self.candidates(q) for q in parts]
        if op == "and":
            sets.sort(key=len)
            out = sets[0]
            for s in sets[1:]:
                out = np.intersect1d(out, s, assume_unique=True)
            return out
        return np.unique(np.concatenate(sets))


def scan_block(texts: list[bytes], rules=RULES, queries=None) -> list[list[tuple[int, int, int]]]:
    """For each text the (start, end, number of the rule), by start, then rule."""
    queries = queries or {k: trigram_query(p) for k, (p, _, _) in rules.items()}
    index = BlockIndex(texts, set().union(*map(trigrams, queries.values())))
    spans: list[list] = [[] for _ in texts]
    decoded: dict[int, str] = {}
    for number, (kind, (pattern, group, least)) in enumerate(rules.items()):
        # A quick look without captures at texts in full comes first where every document is a candidate.
        find = re.compile(pattern).finditer
        for i in index.candidates(queries[kind]).tolist():
            text = decoded.get(i)
            if text is None:
                text = decoded[i] = texts[i].decode("utf-8", "replace")
            spans[i] += [(m.start(), m.end(), number) for m in find(text) if m.end(group) - m.start(group) >= least]
    return [sorted(s, key=lambda x: (x[0], x[2], x[1])) for s in spans]


def scan(docs: DataFrame, rules: dict[str, tuple[str, int, int]] | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, secrets array<struct<kind, start, end>>: one row per row of docs."""
    rules = dict(rules or RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, names = {k: trigram_query(p) for k, (p, _, _) in rules.items()}, list(rules)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for part in pieces(batch, "text"):
                found = scan_block(as_bytes(part, "text"), rules, queries)
                rows = [[{"kind": names[k], "start": s, "end": e} for s, e, k in spans] for spans in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(kind))], ["doc_id", "secrets"])

    picked = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    key = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {key}, secrets array<struct<kind:string,start:bigint,end:bigint>>")
