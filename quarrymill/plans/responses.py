"""Queries over model responses: splitting, JSON recovery, verdicts, layouts. The responses are put together from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.functions import jsonx as J
from quarrymill.plans.registry import query, sql_text, table

_STRIP = lambda x: f"regexp_replace({x}, '\\A\\s+|\\s+\\z', '', 'g')"
_BRACES = lambda x: f"CASE WHEN instr({x}, '{{') > 0 AND instr({x}, '}}') > 0 AND length({x}) - instr(reverse({x}), '}}') + 1 >= instr({x}, '{{') THEN substring({x}, instr({x}, '{{'), length({x}) - instr(reverse({x}), '}}') - instr({x}, '{{') + 2) END"
_JSON = lambda x: f"CASE WHEN json_valid({x}) THEN {x} END"
_FENCED = lambda x: f"CASE WHEN contains({x}, '```json') THEN string_split(string_split({x}, '```json')[2], '```')[1] WHEN contains({x}, '```') THEN string_split(string_split({x}, '```')[2], '```')[1] ELSE {x} END"

#: Layout parts by doc_id % 7: fenced, plain fence, plain, in prose, broken, without braces, with a second object.
_PARTS = (
    '```json\n{"poster": {"orientation": "portrait"}, "sections": [1, {"id": "@"}]}\n``` done',
    '```\n{"poster": {"aspect_ratio": "4:3"}, "reading_order": "@"}\n```',
    ' {"header": {"height_pct": 12, "t": "@"}} ',
    'Here it is: {"poster": {"background": "#@"}} thanks',
    'So {"poster": {"orientation": } and more',
    "no layout for @",
    '{"figures": [1, 2]} and {"figures": [3]}',
)


def _sql_case(parts, number: str, key: str) -> str:
    whens = " ".join(f"WHEN {number} % {len(parts)} = {i} THEN replace({sql_text(p)}, '@', {key}::VARCHAR)" for i, p in enumerate(parts))
    return f"CASE {whens} END"


def _case(parts, number, key):
    out = F.lit(None).cast("string")
    for i, p in enumerate(parts):
        out = F.when(number % len(parts) == i, F.replace(F.lit(p), F.lit("@"), key.cast("string"))).otherwise(out)
    return out


_RESPONSES = f"""(SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text ELSE '---CONTENT---' || chr(10) || text || chr(10) || '---LAYOUT---' || chr(10) || {_sql_case(_PARTS, 'doc_id', 'doc_id')} END AS response FROM documents)"""


def _responses(spark, sf_dir):
    marked = F.concat(F.lit("---CONTENT---\n"), "text", F.lit("\n---LAYOUT---\n"), _case(_PARTS, F.col("doc_id"), F.col("doc_id")))
    return table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.col("text")).otherwise(marked).alias("response"))


def _layout_sql(source: str) -> str:
    """Fields of a JSON column `layout`, with defaults for missing ones: texts, sizes of lists, numbers of keys of objects."""
    fields = []
    for key, default in J.LAYOUT_DEFAULTS.items():
        path = f"$.poster.{key}" if key in ("orientation", "aspect_ratio", "background") else f"$.{key}"
        found = f"coalesce(json_extract_string(layout, '{path}'), '{default}')"
        fields.append(f"{ {'[]': f'json_array_length({found})::INT', '{}': f'len(json_keys({found}))::INT'}.get(default, found)} AS {key}")
    return f"SELECT doc_id, {', '.join(fields)} FROM ({source})"


def _layout_row(found):
    fields = J.layout_fields(F.col("layout"))
    size = {"[]": F.json_array_length, "{}": lambda c: F.size(F.json_object_keys(c))}
    return found.select("doc_id", *[size.get(J.LAYOUT_DEFAULTS[k], lambda c: c)(c).alias(k) for k, c in fields.items()])


def _response_layout_sql() -> str:
    both = "contains(response, '---CONTENT---') AND contains(response, '---LAYOUT---')"
    part = f"SELECT doc_id, response, {both} AS two, {_STRIP('string_split(response, ' + chr(39) + '---LAYOUT---' + chr(39) + ')[2]')} AS part FROM {_RESPONSES}"
    inner = f"SELECT *, {_FENCED('part')} AS inner_part FROM ({part})"
    cut = f"SELECT *, {_BRACES('inner_part')} AS cut FROM ({inner})"
    layout = f"coalesce({_JSON('inner_part')}, CASE WHEN cut IS NULL THEN '{{}}' ELSE coalesce({_JSON('cut')}, '{J.POSTER_LAYOUT}') END)"
    content = _STRIP("replace(string_split(response, '---LAYOUT---')[1], '---CONTENT---', '')")
    return f"SELECT doc_id, CASE WHEN two THEN {content} ELSE response END AS content, CASE WHEN two THEN {layout} ELSE '{J.POSTER_LAYOUT}' END AS layout FROM ({cut})"


@query(f"SELECT doc_id, content FROM ({_response_layout_sql()})")
def response_split(spark, sf_dir):
    content, _ = J.split_response(F.col("response"))
    return _responses(spark, sf_dir).select("doc_id", content.alias("content"))


@query(_layout_sql(_response_layout_sql()))
def json_recover_response(spark, sf_dir):
    """The fields of each response's layout; of lists and objects the sizes."""
    _, layout = J.split_response(F.col("response"))
    return _layout_row(_responses(spark, sf_dir).select("doc_id", layout.alias("layout")))


def _described(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", _case(_PARTS, F.col("doc_id"), F.col("doc_id")).alias("answer"))


_DESCRIBED = f"(SELECT doc_id, {_sql_case(_PARTS, 'doc_id', 'doc_id')} AS answer FROM documents)"
_FENCE = "nullif(regexp_extract(answer, '(?s)```(?:json)?\\s*(.*?)\\s*```', 1), '')"
_DESCRIBED_LAYOUT = f"SELECT doc_id, coalesce({_JSON(_STRIP('answer'))}, {_JSON(_FENCE)}, {_JSON('cut')}, '{J.DESCRIBED_LAYOUT}') AS layout FROM (SELECT *, {_BRACES('answer')} AS cut FROM {_DESCRIBED})"


@query(_layout_sql(_DESCRIBED_LAYOUT))
def json_recover_described(spark, sf_dir):
    return _layout_row(_described(spark, sf_dir).select("doc_id", J.described_layout(F.col("answer")).alias("layout")))


@query("SELECT doc_id, kind, CASE kind WHEN 'response' THEN 15 ELSE 10 END AS header_height, CASE kind WHEN 'response' THEN 5 ELSE 3 END AS colours, CASE kind WHEN 'response' THEN 2 ELSE 4 END AS lists FROM documents, (VALUES ('response'), ('described')) t(kind)")
def layout_defaults(spark, sf_dir):
    """The layouts that both recoveries put in place of answers without one (whole texts): header height, number of colours, of empty lists."""
    text = F.col("text")
    kinds = F.array(F.struct(F.lit("response").alias("kind"), J.split_response(text)[1].alias("layout")), F.struct(F.lit("described").alias("kind"), J.described_layout(text).alias("layout")))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.inline(kinds))
    colours = F.size(F.json_object_keys(J.field(F.col("layout"), "$.color_scheme")))
    lists = sum((F.when(J.field(F.col("layout"), f"$.{k}") == "[]", 1).otherwise(0) for k in ("sections", "figures", "flowcharts", "special_elements")), F.lit(0))
    return rows.select("doc_id", "kind", J.field(F.col("layout"), "$.header.height_pct", "int").alias("header_height"), colours.alias("colours"), lists.alias("lists"))


@query(f"SELECT doc_id, coalesce(json_array_length(json_extract(layout, '$.sections')), 0)::INT AS sections, coalesce(json_array_length(json_extract(layout, '$.figures')), 0)::INT AS figures FROM ({_DESCRIBED_LAYOUT})")
def collection_sizes(spark, sf_dir):
    found = _described(spark, sf_dir).select("doc_id", J.described_layout(F.col("answer")).alias("layout"))
    return found.select("doc_id", *[J.array_size(F.col("layout"), f"$.{k}").alias(k) for k in ("sections", "figures")])


#: Answers of a comparison by (conv_id + turn) % 6, before the turn's text.
_VERDICTS = (
    'I see {"verdict": "same", "confidence": 0.9, "reasoning": "@"} here. ',
    '{"verdict": "similar", "confidence": "0.55"} ',
    '{"confidence": 0.7} ',
    "They look the same. ",
    "Not the same but similar, even different. ",
    '{"verdict": "same", "confidence": "high"} similar ',
)
_ANSWERS = f"(SELECT conv_id, turn, text, {_sql_case(_VERDICTS, '(conv_id + turn)', 'conv_id')} || text AS answer FROM conversations)"


def _answers(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(_case(_VERDICTS, F.col("conv_id") + F.col("turn"), F.col("conv_id")), "text").alias("answer"))


_VERDICT_SQL = f"""SELECT conv_id, turn,
  CASE WHEN usable THEN coalesce(json_extract_string(found, '$.verdict'), 'unknown') WHEN contains(low, 'same') AND NOT contains(low, 'different') THEN 'same' WHEN contains(low, 'similar') THEN 'similar' ELSE 'different' END AS verdict,
  CASE WHEN usable THEN confidence ELSE 0.5 END::DOUBLE AS confidence,
  CASE WHEN usable THEN coalesce(json_extract_string(found, '$.reasoning'), '') ELSE left(answer, 200) END AS reasoning
FROM (SELECT *, found IS NOT NULL AND confidence IS NOT NULL AS usable FROM (
  SELECT *, CASE WHEN json_extract_string(found, '$.confidence') IS NULL THEN 0.5::DOUBLE ELSE try_cast(json_extract_string(found, '$.confidence') AS DOUBLE) END AS confidence FROM (
    SELECT *, lower(answer) AS low, CASE WHEN json_valid(cut) THEN cut END AS found FROM (SELECT *, nullif(regexp_extract(answer, '\\{{[^}}]+\\}}', 0), '') AS cut FROM {_ANSWERS}))))"""


@query(_VERDICT_SQL)
def verdict_text_fallback(spark, sf_dir):
    v, confidence, reasoning = J.verdict(F.col("answer"))
    return _answers(spark, sf_dir).select("conv_id", "turn", v.alias("verdict"), confidence.alias("confidence"), reasoning.alias("reasoning"))


@query(
    f"SELECT verdict, level, count(*) AS n FROM (SELECT verdict, CASE WHEN verdict = 'same' AND confidence >= 0.6 THEN 'high' WHEN verdict = 'same' OR (verdict = 'similar' AND confidence >= 0.7) THEN 'medium' WHEN verdict = 'similar' THEN 'low' END AS level FROM ({_VERDICT_SQL})) WHERE level IS NOT NULL GROUP BY ALL"
)
def figure_match_vlm_rule(spark, sf_dir):
    from quarrymill.operators.tables import model_verdict

    found = verdict_text_fallback(spark, sf_dir).withColumn("level", model_verdict(F.col("verdict"), F.col("confidence")))
    return found.where("level IS NOT NULL").groupBy("verdict", "level").agg(F.count("*").alias("n"))


#: A judge's answers by item_id % 4.
_JUDGED = (
    'Scores: {"model_a": {"total": 30}, "model_b": {"total": 41.5}, "model_c": {"total": @}, "winner": "model_b"} end',
    '{"model_a": {"total": @}, "model_c": {"notes": "none"}, "winner": "model_a"}',
    '{"model_b": {"total": 20}, "winner": "nobody"}',
    "I cannot say @ {",
)
_EVALUATIONS = f"(SELECT item_id, answer, CASE WHEN json_valid(cut) THEN cut END AS evaluation FROM (SELECT *, {_BRACES('answer')} AS cut FROM (SELECT item_id, {_sql_case(_JUDGED, 'item_id', 'item_id')} AS answer FROM benchmark)))"


def _evaluations(spark, sf_dir):
    answers = table(spark, sf_dir, "benchmark").select("item_id", _case(_JUDGED, F.col("item_id"), F.col("item_id")).alias("answer"))
    found, error, raw = J.judged(F.col("answer"))
    return answers.select("item_id", found.alias("evaluation"), error.alias("error"), raw.alias("raw"))


@query(f"SELECT item_id, json_extract_string(evaluation, '$.winner') AS winner, CASE WHEN evaluation IS NULL THEN '{J.UNPARSED}' END AS error, CASE WHEN evaluation IS NULL THEN answer END AS raw FROM {_EVALUATIONS}")
def judge_recover(spark, sf_dir):
    return _evaluations(spark, sf_dir).select("item_id", J.field(F.col("evaluation"), "$.winner").alias("winner"), "error", "raw")


@query(
    f"""SELECT m AS model, (SELECT count(*) FROM {_EVALUATIONS} WHERE json_extract_string(evaluation, '$.winner') = m)::BIGINT AS wins,
  coalesce((SELECT avg(json_extract_string(evaluation, '$.' || m || '.total')::DOUBLE) FROM {_EVALUATIONS} WHERE json_extract_string(evaluation, '$.winner') IS NOT NULL), 0)::DOUBLE AS avg_score
FROM (VALUES ('model_a'), ('model_b'), ('model_c')) t(m)"""
)
def judge_avg_score(spark, sf_dir):
    """Wins and mean totals of the three models, zero where there are none; only evaluations with a winner count."""
    from quarrymill.operators.evaluate import judge_summary

    return judge_summary(_evaluations(spark, sf_dir), "evaluation", ["model_a", "model_b", "model_c"])


#: Extracted sections by doc_id % 5: JSON in a leading fence, in a plain one, bare, after words, broken.
_EXTRACTED = ('```json\n{"abstract": "a@"}\n``` rest', '```\n{"abstract": "b@"}\n```', '{"abstract": "c@"}', 'As asked: ```{"abstract": "d@"}```', "```json\n{broken @}\n```")


@query(
    f"""SELECT doc_id, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.abstract') END AS abstract, CASE WHEN json_valid(body) THEN 'llm' ELSE 'llm_fallback_regex' END AS method FROM (
  SELECT doc_id, CASE WHEN starts_with(answer, '```') THEN CASE WHEN starts_with(inner_part, 'json') THEN substring(inner_part, 5) ELSE inner_part END ELSE answer END AS body FROM (
    SELECT doc_id, answer, string_split(answer, '```')[2] AS inner_part FROM (SELECT doc_id, {_sql_case(_EXTRACTED, 'doc_id', 'doc_id')} AS answer FROM documents)))"""
)
def fence_strip(spark, sf_dir):
    """Sections by a model: the answer's JSON, else the fallback's tag."""
    rows = table(spark, sf_dir, "documents").select("doc_id", _case(_EXTRACTED, F.col("doc_id"), F.col("doc_id")).alias("answer"))
    found = rows.select("doc_id", J.leading_fence(F.col("answer")).alias("body"))
    return found.select("doc_id", J.field(F.col("body"), "$.abstract").alias("abstract"), F.when(F.col("body").isNotNull(), "llm").otherwise("llm_fallback_regex").alias("method"))


#: What a model gives back after its prompt, by conv_id % 3.
_GENERATED = ('{"poster": "p@"}', "just words @", ' {"poster": [@]} ')


@query(
    f"""SELECT conv_id, turn, json_extract_string(found, '$.poster') AS poster, json_extract_string(found, '$.raw_response') AS raw_response FROM (
  SELECT conv_id, turn, CASE WHEN json_valid(answer) THEN answer ELSE json_object('raw_response', answer)::VARCHAR END AS found FROM (
    SELECT conv_id, turn, {_STRIP("string_split('<s>[INST] ' || text || ' [/INST] ' || " + _sql_case(_GENERATED, 'conv_id', 'turn') + ", '[/INST]')[-1]")} AS answer FROM conversations))"""
)
def template_split(spark, sf_dir):
    prompt = F.concat(F.lit("<s>[INST] "), "text", F.lit(" [/INST] "), _case(_GENERATED, F.col("conv_id"), F.col("turn")))
    found = table(spark, sf_dir, "conversations").select("conv_id", "turn", J.generated(prompt).alias("found"))
    return found.select("conv_id", "turn", J.field(F.col("found"), "$.poster").alias("poster"), J.field(F.col("found"), "$.raw_response").alias("raw_response"))
