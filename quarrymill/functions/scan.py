"""Titles, abstracts, prompts and small conversions as column expressions; all run inside the JVM."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrymill.functions.jsonx import let, stripped

# Results depend on them.
INFERENCE_CHARS, INFERENCE_MARK = 20_000, "\n\n[Content truncated...]"
EVAL_CHARS, EVAL_MARK = 4_000, "\n\n[... content truncated for length ...]"
POSTER_HEADING = "# Poster Content\n\n"
TITLE_LINES, NO_TITLE, UNTITLED = 20, "Research Paper", "Untitled"
INSTRUCTION = "Generate an academic poster for the following research paper."
MEDIA_TYPES = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp"}
MAX_BASE64 = 5 * 1024 * 1024
#: The body's end is consumed where a look-ahead would do: the captured group is the same, and RE2 has no look-ahead.
ABSTRACT_FORM = r"(?is)(?:^|\n)(?:abstract|summary)[:\s]*\n(.+?)(?:\n(?:#{1,2}\s|\d+\.?\s*introduction)|\n\n\n)"


def _opens(line: Column) -> Column:
    return F.contains(F.lower(line), F.lit("abstract")) & (F.length(line) < 50)


def _stops(line: Column) -> Column:
    return ~_opens(line) & F.lower(line).rlike(r"\A(?:#|introduction|1 |1\.)")


def title_and_abstract(content: Column) -> tuple[Column, Column]:
    """By a scan of the lines: the first of the first 20 that says something; what follows a short abstract line up to a heading."""
    head = F.transform(F.slice(F.split(content, "\n", TITLE_LINES + 1), 1, TITLE_LINES), stripped)
    first = F.element_at(F.filter(head, lambda x: (x != "") & ~F.startswith(F.lower(x), F.lit("abstract"))), 1)
    title = F.when(F.startswith(first, F.lit("#")), stripped(F.regexp_replace(first, r"\A#+", ""))).otherwise(first)
    lines = F.split(content, "\n", -1)
    kinds = F.transform(lines, lambda x: let(stripped(x), lambda t: F.when(_opens(t), "o").when(_stops(t), "s").otherwise("-")))
    body = lambda k, start, end: F.filter(lines, lambda x, i: (i > start) & (i < end) & (F.get(k, i) != "o"))
    # Positions count from 0; without an opening line there is no body, without a stop it goes to the end.
    opened = lambda k: F.array_position(k, "o") - 1
    stop = lambda k, start: F.coalesce(F.array_min(F.transform(k, lambda c, i: F.when((i > start) & (c == "s"), i))), F.size(k))
    whole = let(kinds, lambda k: let(opened(k), lambda at: let(stop(k, at), lambda end: F.when(at >= 0, F.array_join(body(k, at, end), " ")))))
    abstract = F.left(stripped(whole), F.lit(1000))
    none = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(none(title), F.lit(NO_TITLE)), F.coalesce(none(abstract), F.left(content, F.lit(500)))


def title_of(content: Column) -> Column:
    """The first first-level heading, else the first line, else a fixed word."""
    heading = F.nullif(F.regexp_extract(content, r"(?m)^#\s+(.+)$", 1), F.lit(""))
    line = F.nullif(F.regexp_extract(stripped(content), r"\A([^\n]+)", 1), F.lit(""))
    return F.coalesce(stripped(heading), stripped(line), F.lit(UNTITLED))


def abstract_of(content: Column) -> Column:
    return F.left(stripped(F.regexp_extract(content, ABSTRACT_FORM, 1)), F.lit(1500))


def capped(content: Column, most: int, mark: str) -> Column:
    return F.when(F.length(content) > most, F.concat(F.left(content, F.lit(most)), F.lit(mark))).otherwise(content)


def instruction(title: Column, abstract: Column) -> Column:
    empty = F.lit("")
    return F.concat(F.lit(f"{INSTRUCTION}\n\nTitle: "), F.coalesce(title, empty), F.lit("\n\nAbstract: "), F.coalesce(abstract, empty))


def inference_prompt(title: Column, abstract: Column, content: Column) -> Column:
    return F.concat(F.lit("<s>[INST] "), instruction(title, abstract), F.lit("\n\n"), capped(content, INFERENCE_CHARS, INFERENCE_MARK), F.lit(" [/INST]"))


def readme_prompt(instr: Column, body: Column, output: Column) -> Column:
    return F.concat(F.lit("### Instruction:\n"), instr, F.lit("\n\n### Input:\n"), F.left(body, F.lit(4000)), F.lit("\n\n### Response:\n"), output)


def filled(template: str, **values: Column) -> Column:
    """template with {name} filled by columns; {{ and }} are braces."""
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        parts += [F.lit(text)] + ([values[name]] if name else [])
    return F.concat(*parts)


def topics(text: Column) -> Column:
    """Split at commas, untrimmed; null gives none."""
    return F.coalesce(F.split(text, ",", -1), F.array().cast("array<string>"))


def year(text: Column) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(0))


def suffix(path: Column) -> Column:
    """Lower-case extension of the last part of a path, without its dot; empty without one."""
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)\z", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)\z", 1), r"(?<=.)\.[^.]+\z", "")


def relative(path: Column, root: Column) -> Column:
    """path below root; as it is where it lies elsewhere."""
    base = F.concat(F.regexp_replace(root, r"/+\z", ""), F.lit("/"))
    return F.when(F.startswith(path, base), F.substring(path, F.length(base) + 1, F.length(path))).otherwise(path)


def media_type(path: Column) -> Column:
    out = F.lit("image/png")
    for ext, kind in MEDIA_TYPES.items():
        out = F.when(suffix(path) == ext, kind).otherwise(out)
    return out


def base64_size(n_bytes: Column) -> Column:
    return (F.floor((n_bytes + 2) / 3) * 4).cast("long")


def backoff_seconds(attempt: int, status: int | None, retry_after: float | None = None, base: float = 1.0, most: float = 60.0) -> float | None:
    """Seconds to wait after a failed call; null for an error that no repetition mends."""
    if status == 429:
        return float(retry_after) if retry_after is not None else min(base * 2**attempt, most)
    if status is None or status >= 500:
        return base * (attempt + 1)
    return None


def iso(ts: Column) -> Column:
    """A time as text to microseconds, without a zone; whole seconds have no fraction."""
    whole = F.unix_micros(ts.cast("timestamp")) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def elapsed(start: Column, end: Column) -> Column:
    """Seconds between two times."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def poster_markdown(text: Column) -> Column:
    """Recognised text of a poster under its fixed heading."""
    return F.concat(F.lit(POSTER_HEADING), text)
