"""JSON out of model responses, as column expressions over VARIANT; all run inside the JVM.

A text counts as JSON only as a whole: it is parsed between a key and a sentinel, so that neither trailing text nor a
second value passes. Objects with a repeated key and the bare words NaN and Infinity are refused.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts that stand for a response without one, and the markers of a response.
CONTENT_MARK, LAYOUT_MARK = "---CONTENT---", "---LAYOUT---"
POSTER_LAYOUT = (
    '{"poster":{"orientation":"landscape","aspect_ratio":"16:9","background":"#FFFFFF"},'
    '"header":{"height_pct":15,"background":"none","title_alignment":"center","logo_positions":[]},'
    '"footer":{"present":false,"height_pct":0,"content":""},'
    '"body":{"columns":3,"column_widths":["equal"],"gutter_pct":2},'
    '"sections":[],"figures":[],'
    '"color_scheme":{"primary":"#000000","secondary":"#333333","accent":"#0066CC","text":"#000000","background":"#FFFFFF"},'
    '"reading_order":"columns-left-to-right"}'
)
DESCRIBED_LAYOUT = (
    '{"poster":{"orientation":"landscape","aspect_ratio":"16:9","background":"#FFFFFF"},'
    '"header":{"height_pct":10,"background":"#FFFFFF","gradient_colors":null,"title_alignment":"center","logo_positions":[],'
    '"has_author_affiliation_superscripts":false},'
    '"footer":{"present":false,"height_pct":null,"background":"none","content":"none"},'
    '"body":{"columns":3,"column_widths":["equal"],"gutter_pct":2},'
    '"sections":[],"figures":[],"flowcharts":[],"special_elements":[],'
    '"color_scheme":{"primary":"#000000","secondary":"#FFFFFF","accent":"#0000FF"},'
    '"reading_order":"columns-left-to-right"}'
)
UNPARSED = "Failed to parse evaluation"
#: Keys of a layout with what stands for a missing one, in the order of its JSON form.
LAYOUT_DEFAULTS = {
    "orientation": "landscape", "aspect_ratio": "16:9", "background": "#FFFFFF", "header": "{}", "footer": "{}", "body": "{}",
    "sections": "[]", "figures": "[]", "flowcharts": "[]", "special_elements": "[]", "color_scheme": "{}", "reading_order": "columns-left-to-right",
}
_IN_POSTER = ("orientation", "aspect_ratio", "background")
_END = "\x1f~end"
_BLANK = r"[\s\x1c-\x1f\x85\p{Z}]+"


def let(value: Column, then) -> Column:
    """then(value) with value computed once: a column that is used again would be computed anew for each use."""
    return F.element_at(F.transform(F.array(value), then), 1)


def json_or_null(text: Column) -> Column:
    """The text if all of it is one JSON value, else null."""
    whole = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit(',"\\u001f~end":0}')))
    return F.when(F.try_variant_get(whole, f'$["{_END}"]', "int").isNotNull(), text)


def field(text: Column, path: str, kind: str = "string") -> Column:
    """A field of a JSON text; null where the text is no JSON or lacks it."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def _between(text: Column, fence: str) -> Column:
    inside = F.element_at(F.split(text, F.lit(fence), -1), 2)
    return F.element_at(F.split(inside, F.lit("```"), -1), 1)


def fenced(text: Column) -> Column:
    """What the first fence holds, else the text."""
    return F.when(F.contains(text, F.lit("```json")), _between(text, "```json")).when(F.contains(text, F.lit("```")), _between(text, "```")).otherwise(text)


def braces(text: Column) -> Column:
    """From the first { to the last }; null without them."""
    start = F.instr(text, "{")
    back = F.instr(F.reverse(text), "}")
    end = F.length(text) - back + 1
    return F.when((start > 0) & (back > 0) & (end >= start), F.substring(text, start, end - start + 1))


def response_layout(part: Column) -> Column:
    """Fence, then braces; bad braces give the default layout, none an empty object."""
    from_braces = lambda inner: let(braces(inner), lambda cut: F.when(cut.isNull(), F.lit("{}")).otherwise(F.coalesce(json_or_null(cut), F.lit(POSTER_LAYOUT))))
    return let(part, lambda p: let(fenced(p), lambda inner: F.coalesce(json_or_null(inner), from_braces(inner))))


def split_response(text: Column) -> tuple[Column, Column]:
    """(content, layout JSON) of a response in two parts; without both markers the text is content under a default layout."""
    both = F.contains(text, F.lit(CONTENT_MARK)) & F.contains(text, F.lit(LAYOUT_MARK))
    parts = F.split(text, F.lit(LAYOUT_MARK), -1)
    content = stripped(F.replace(F.element_at(parts, 1), F.lit(CONTENT_MARK), F.lit("")))
    layout = response_layout(stripped(F.element_at(parts, 2)))
    return F.when(both, content).otherwise(text), F.when(both, layout).otherwise(F.lit(POSTER_LAYOUT))


def described_layout(text: Column) -> Column:
    """The text, else its fence, else the widest braces, else the default layout."""
    fence = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*```", 1), F.lit(""))
    tried = [let(c, json_or_null) for c in (stripped(text), fence, braces(text))]
    return F.coalesce(*tried, F.lit(DESCRIBED_LAYOUT))


def verdict(text: Column) -> tuple[Column, Column, Column]:
    """(verdict, confidence, reasoning) of a comparison: the first braces without braces inside, else by words of the text."""
    low = F.lower(text)
    same = F.contains(low, F.lit("same")) & ~F.contains(low, F.lit("different"))
    by_words = F.when(same, "same").when(F.contains(low, F.lit("similar")), "similar").otherwise("different")
    plain = F.struct(by_words.alias("verdict"), F.lit(0.5).alias("confidence"), F.left(text, F.lit(200)).alias("reasoning"))
    sure = lambda f: F.coalesce(field(f, "$.confidence", "double"), F.when(field(f, "$.confidence").isNull(), 0.5))
    told = lambda f, c: F.struct(F.coalesce(field(f, "$.verdict"), F.lit("unknown")).alias("verdict"), c.alias("confidence"), F.coalesce(field(f, "$.reasoning"), F.lit("")).alias("reasoning"))
    braced = F.nullif(F.regexp_extract(text, r"\{[^}]+\}", 0), F.lit(""))
    # One struct for all three: what is found is parsed once.
    said = let(let(braced, json_or_null), lambda f: let(sure(f), lambda c: F.when(f.isNotNull() & c.isNotNull(), told(f, c)).otherwise(plain)))
    return said["verdict"], said["confidence"], said["reasoning"]


def judged(text: Column) -> tuple[Column, Column, Column]:
    """(evaluation JSON or null, error, raw text) of a judge's answer."""
    found = let(braces(text), json_or_null)
    return found, F.when(found.isNull(), UNPARSED), F.when(found.isNull(), text)


def leading_fence(text: Column) -> Column:
    """JSON of a stripped text that may begin with a fence; null where it is none."""
    inner = F.element_at(F.split(text, F.lit("```"), -1), 2)
    inner = F.when(F.startswith(inner, F.lit("json")), F.substring(inner, 5, 1 << 30)).otherwise(inner)
    return json_or_null(F.when(F.startswith(text, F.lit("```")), inner).otherwise(text))


def generated(text: Column) -> Column:
    """What follows the template's last closing tag, as JSON: itself or wrapped as raw_response."""
    answer = F.when(F.contains(text, F.lit("[/INST]")), stripped(F.element_at(F.split(text, F.lit(r"\[/INST\]"), -1), -1))).otherwise(text)
    return F.coalesce(json_or_null(answer), F.to_json(F.struct(answer.alias("raw_response"))))


def stripped(text: Column) -> Column:
    """Without white space of any script, and the separators U+001C to U+001F, at both ends."""
    return F.regexp_replace(text, rf"\A{_BLANK}|{_BLANK}\z", "")


def layout_fields(layout: Column) -> dict[str, Column]:
    """Key -> text of a layout's field, or what stands for a missing one; objects and lists as JSON."""
    out = {}
    for key, default in LAYOUT_DEFAULTS.items():
        path = f"$.poster.{key}" if key in _IN_POSTER else f"$.{key}"
        out[key] = F.coalesce(field(layout, path), F.lit(default))
    return out


def layout_json(paper_id: Column, poster_path: Column, layout: Column) -> Column:
    """The normalised layout in its fixed order of keys."""
    fields = layout_fields(layout)
    variant = lambda k: F.parse_json(fields[k]).alias(k) if LAYOUT_DEFAULTS[k] in ("{}", "[]") else fields[k].alias(k)
    poster = F.struct(*[fields[k].alias(k) for k in _IN_POSTER]).alias("poster")
    rest = [variant(k) for k in LAYOUT_DEFAULTS if k not in _IN_POSTER]
    return F.to_json(F.struct(paper_id.alias("paper_id"), poster_path.alias("poster_path"), poster, *rest))


def array_size(text: Column, path: str) -> Column:
    """Number of items of a list inside a JSON text, 0 without it."""
    return F.coalesce(F.json_array_length(field(text, path)), F.lit(0))


def python_json(indent: int | None = None):
    """A UDF that writes a JSON text as Python's json module does: spaces after separators, ASCII, keys as they stand; null stays null."""

    @F.pandas_udf("string")
    def write(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), indent=indent))

    return write
