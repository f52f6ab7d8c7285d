"""The six nested records as structs of columns, as JSON, and back.

A record is a struct with its fields in a fixed order; fields that are not given have their default. Its JSON keeps null fields,
as readers expect every key. A layout is the JSON form that `jsonx.layout_json` makes, held as VARIANT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIGURE = "struct<figure_id:string,source_doc:string,file_path:string,bbox:array<double>,caption:string,figure_type:string,page_number:int>"
_MATCH = f"struct<poster_figure:{_FIGURE},paper_figure:{_FIGURE},match_confidence:string,feature_score:double,vlm_verdict:string,vlm_confidence:double,vlm_reasoning:string>"
_DOCUMENT = f"struct<doc_id:string,doc_type:string,source_path:string,markdown_content:string,figures:array<{_FIGURE}>,tables:array<variant>,equations:array<string>,metadata:variant>"
_EXAMPLE = f"struct<paper_id:string,paper_markdown:string,paper_abstract:string,paper_title:string,poster_layout:variant,poster_markdown:string,figure_matches:array<{_MATCH}>,conference:string,year:int,topics:array<string>>"
_RESULT = f"struct<paper_id:string,success:boolean,error:string,parsed_poster:{_DOCUMENT},parsed_paper:{_DOCUMENT},figure_matches:array<{_MATCH}>,poster_layout:variant>"
#: Kind of record -> its type.
KINDS = {"figure": _FIGURE, "match": _MATCH, "document": _DOCUMENT, "layout": "variant", "example": _EXAMPLE, "result": _RESULT}
_DEFAULTS = {
    "figure": {"page_number": "1"},
    "document": {"figures": "array()", "tables": "array()", "equations": "array()", "metadata": "parse_json('{}')"},
    "example": {"figure_matches": "array()", "conference": "''", "year": "0", "topics": "array()"},
    "result": {"figure_matches": "array()"},
}


def _fields(kind: str) -> dict[str, str]:
    """Field -> type, in order."""
    out, depth, at, body = {}, 0, 0, KINDS[kind].removeprefix("struct<")[:-1] + ","
    for i, c in enumerate(body):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, _, of = body[at:i].partition(":")
            out[name], at = of, i + 1
    return out


def record(kind: str, **values: Column) -> Column:
    """A record's struct; an unknown field is an error, a missing one its default or null."""
    fields, defaults = _fields(kind), _DEFAULTS.get(kind, {})
    if unknown := set(values) - set(fields):
        raise ValueError(f"a {kind} has no {sorted(unknown)}")
    cast = lambda n, of: (values[n] if of == "variant" else values[n].cast(of)) if n in values else F.lit(None).cast(of)
    whole = lambda n, of: F.coalesce(cast(n, of), F.expr(defaults[n]).cast(of)) if n in defaults else cast(n, of)
    return F.struct(*(whole(n, of).alias(n) for n, of in fields.items()))


def as_json(value: Column) -> Column:
    """A record's JSON, null fields kept; python_json writes it as Python's json module does."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def loaded(kind: str, text: Column) -> Column:
    """A record's struct from its JSON; null where the text is none; missing lists and numbers have their defaults."""
    if kind == "layout":
        return F.try_parse_json(text)
    found = F.from_json(text, ", ".join(f"{n} {of}" for n, of in _fields(kind).items()))
    # from_json gives a struct of nulls for a text that is no JSON.
    fields = {n: found[n] for n in _fields(kind)}
    return F.when(F.try_parse_json(text).isNotNull(), record(kind, **fields))


def training_format(example: Column, instruction: Column) -> Column:
    """(instruction, input, output) of an example: the output holds layout, content and the mapping of figures."""
    mapping = F.transform(example["figure_matches"], lambda m: F.struct(m["paper_figure"]["figure_id"].alias("paper_figure"), m["poster_figure"]["figure_id"].alias("poster_position")))
    output = F.struct(example["poster_layout"].alias("layout"), example["poster_markdown"].alias("content"), mapping.alias("figure_mapping"))
    return F.struct(instruction.alias("instruction"), example["paper_markdown"].alias("input"), as_json(output).alias("output"))
