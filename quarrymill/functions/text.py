"""Scalar text functions as column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on them.
CHARS_PER_TOKEN = 4
PROMPT_TOKENS = 2000
CUT_MARK = "\n\n[Content truncated...]"
MORE_HEAD = "\n\n## Additional Content\n"
SYSTEM_TEXT = "You are an expert at creating academic posters from research papers."
SECTION_NAMES = {
    "introduction": "introduction|background|overview|motivation",
    "methods": r"method|approach|methodology|model|framework|proposed|our\s+approach|technique",
    "results": "result|experiment|evaluation|empirical|finding|analysis",
    "conclusion": r"conclusion|summary|discussion|future\s+work|closing",
}
SECTION_CHARS = {"abstract": 2000, "introduction": 4000, "methods": 3000, "results": 3000, "conclusion": 2000}
#: Header forms in the order they are tried; the body is the last group. The terminator is consumed where a look-ahead
#: would do, as SQL engines with RE2 have none; with one search the group is the same.
SECTION_FORMS = (
    r"(?is)(?:^|\n)#+\s*(?:\d+\.?\s*)?(?:{names})\s*\n(.*?)(?:\n#+|\n\d+\.?\s+[A-Z]|\z)",
    r"(?is)(?:^|\n)(?:\d+\.?\s+)(?:{names})\s*\n(.*?)(?:\n\d+\.?\s+[A-Z]|\n#+|\z)",
    r"(?is)(?:^|\n)(?:{upper})\s*\n(.*?)(?:\n[A-Z]{{4,}}|\n\d+\.?\s+[A-Z]|\z)",
    r"(?is)(?:^|\n)(?:{names})\s*\n(.*?)(?:\n[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s*\n|\n\d+|\z)",
)
ABSTRACT_FORMS = (
    r"(?is)(?:^|\n)(?:#+\s*)?Abstract\s*\n(.*?)\n(?:#+|\d+\.?\s+[A-Z]|Introduction)",
    r"(?is)(?:^|\n)ABSTRACT\s*\n(.*?)(?:\n[A-Z]{4,}|\n\d+)",
    r"(?is)Abstract\s*\n(.*?)\n\s*\n\s*\d+\.?\s+[A-Z]",
)


def section_patterns(section: str) -> tuple[str, ...]:
    if section == "abstract":
        return ABSTRACT_FORMS
    names = SECTION_NAMES[section]
    return tuple(form.format(names=names, upper=names.upper()) for form in SECTION_FORMS)


def section(text: Column, name: str) -> Column:
    """A section's text: the first header form that occurs decides, even with an empty body.

    A form is tried once: an empty list is no match, an empty text an empty body.
    """
    found = F.coalesce(*[F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0)) for pattern in section_patterns(name)], F.lit(""))
    return F.substring(F.regexp_replace(found, r"\A\s+|\s+\z", ""), 1, SECTION_CHARS[name])


def estimate_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / CHARS_PER_TOKEN).cast("long")


def max_chars(max_tokens: int) -> int:
    if max_tokens <= PROMPT_TOKENS:
        raise ValueError(f"max_tokens must be above {PROMPT_TOKENS}")
    return (max_tokens - PROMPT_TOKENS) * CHARS_PER_TOKEN


def truncated(text: Column, most: int, strategy: str = "smart", found: dict[str, Column] | None = None) -> tuple[Column, Column]:
    """(text, method) of a text cut to about `most` code points. found: sections that are columns already."""
    head = F.concat(F.left(text, F.lit(most)), F.lit(CUT_MARK))
    if strategy == "none":
        cut, method = text, "none"
    elif strategy == "head":
        cut, method = head, "head"
    elif strategy == "smart":
        found = found or {k: section(text, k) for k in SECTION_CHARS}
        caps = {"methods": 2000, "results": 2000}
        parts = [F.when(c != "", F.concat(F.lit(f"## {k.capitalize()}\n"), F.left(c, F.lit(caps.get(k, SECTION_CHARS[k]))))) for k, c in found.items()]
        joined = F.concat_ws("\n\n", *parts)
        room = F.lit(most) - F.length(joined) - 100
        more = F.concat(joined, F.lit(MORE_HEAD), F.substring(text, F.length(joined) + 1, room))
        cut = F.when(F.length(joined) > most, F.concat(F.left(joined, F.lit(most)), F.lit(CUT_MARK))).when((room > 1000) & (F.length(text) > F.length(joined)), more).otherwise(joined)
        method = "regex"
    else:
        cut, method = F.left(text, F.lit(most)), "fallback"
    fits = F.length(text) <= most
    return F.when(fits, text).otherwise(cut), F.when(fits, "none_needed").otherwise(method)


def chat_messages(instruction: Column, body: Column, output: Column) -> Column:
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(say("system", F.lit(SYSTEM_TEXT)), say("user", F.concat(instruction, F.lit("\n\n"), body)), say("assistant", output))


def llama_text(instruction: Column, body: Column, output: Column) -> Column:
    return F.concat(F.lit(f"<s>[INST] <<SYS>>\n{SYSTEM_TEXT}\n<</SYS>>\n\n"), instruction, F.lit("\n\n"), body, F.lit(" [/INST] "), output, F.lit(" </s>"))


def mistral_text(instruction: Column, body: Column, output: Column) -> Column:
    return F.concat(F.lit("<s>[INST] "), instruction, F.lit("\n\n"), body, F.lit(" [/INST] "), output, F.lit("</s>"))


def formatted(instruction: str, body: str, output: str, fmt: str = "alpaca") -> list[Column]:
    """The columns of a trainer's format; an unknown format is alpaca."""
    cols = F.col(instruction), F.col(body), F.col(output)
    if fmt == "chatml":
        return [chat_messages(*cols).alias("messages")]
    if fmt in ("llama", "mistral"):
        return [(llama_text if fmt == "llama" else mistral_text)(*cols).alias("text")]
    return [c.alias(n) for c, n in zip(cols, ("instruction", "input", "output"), strict=True)]


def training_rows(rows, fmt: str = "alpaca"):
    """instruction, input, output in a trainer's format."""
    return rows.select(*formatted("instruction", "input", "output", fmt))


def nonempty(*cols: Column) -> Column:
    """The first column that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def hamming_score(distance: Column, bits: int = 64) -> Column:
    return F.greatest(F.lit(0.0), F.lit(1.0) - distance / F.lit(float(bits)))
