"""Queries over papers: titles, abstracts, prompts, caps, small conversions. The papers are put together from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.functions import scan as S
from quarrymill.functions import text as T
from quarrymill.plans.registry import query, sql_text, table

_STRIP = lambda x: f"regexp_replace({x}, '\\A\\s+|\\s+\\z', '', 'g')"

#: Openings of a paper by doc_id % 6; the whole text stands in for the body, its first 300 characters for the abstract.
_HEADS = (
    "# Title @\n\n## Abstract\n{cut}\n# Introduction\n",
    "\n\nTitle @\nAbstract\n{cut}\nabstract again\nmore\n1. Introduction\n",
    "Abstract: {cut}\n\n",
    "  ### Deep @ \nAbstract:  \n{cut}\n\n\nText\n",
    "\n \n",
    "abstract\n{cut}\nIntroduction and so on\n## Title @\n",
)


def _papers(spark, sf_dir):
    text = F.col("text")
    out = F.lit(None).cast("string")
    for i, head in enumerate(_HEADS):
        before, _, after = head.partition("{cut}")
        made = [F.replace(F.lit(before), F.lit("@"), F.col("doc_id").cast("string"))] + ([F.left(text, F.lit(300)), F.replace(F.lit(after), F.lit("@"), F.col("doc_id").cast("string"))] if after else []) + [text]
        out = F.when(F.col("doc_id") % len(_HEADS) == i, F.concat(*made)).otherwise(out)
    return table(spark, sf_dir, "documents").select("doc_id", out.alias("paper"))


def _papers_sql() -> str:
    whens = []
    for i, head in enumerate(_HEADS):
        before, _, after = head.partition("{cut}")
        made = f"replace({sql_text(before)}, '@', doc_id::VARCHAR)" + (f" || left(text, 300) || replace({sql_text(after)}, '@', doc_id::VARCHAR)" if after else "") + " || text"
        whens.append(f"WHEN doc_id % {len(_HEADS)} = {i} THEN {made}")
    return f"(SELECT doc_id, CASE {' '.join(whens)} END AS paper FROM documents)"


_PAPERS = _papers_sql()
_OPENS = "(contains(lower(x), 'abstract') AND length(x) < 50)"
_STOPS = "(starts_with(x, '#') OR starts_with(lower(x), 'introduction') OR starts_with(x, '1 ') OR starts_with(x, '1.'))"
_SCAN = f"""WITH p AS (SELECT doc_id, paper, string_split(paper, chr(10)) AS lines FROM {_PAPERS}),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM p),
s AS (SELECT *, {_STRIP('line')} AS x FROM l),
k AS (SELECT *, {_OPENS} AS opens, {_STOPS} AND NOT {_OPENS} AS stops FROM s),
b AS (SELECT doc_id, min(i) FILTER (opens) AS first FROM k GROUP BY 1),
e AS (SELECT k.doc_id, min(i) AS stop FROM k JOIN b ON k.doc_id = b.doc_id AND k.i > b.first WHERE stops GROUP BY 1),
a AS (SELECT k.doc_id, string_agg(line, ' ' ORDER BY i) AS body FROM k JOIN b ON k.doc_id = b.doc_id AND k.i > b.first LEFT JOIN e ON k.doc_id = e.doc_id WHERE NOT opens AND (stop IS NULL OR i < stop) GROUP BY 1),
t AS (SELECT doc_id, arg_min(x, i) AS first FROM s WHERE i < 20 AND x <> '' AND NOT starts_with(lower(x), 'abstract') GROUP BY 1)
SELECT p.doc_id, coalesce(nullif(CASE WHEN starts_with(t.first, '#') THEN {_STRIP("regexp_replace(t.first, '^#+', '')")} ELSE t.first END, ''), '{S.NO_TITLE}') AS title,
  coalesce(nullif(left({_STRIP('a.body')}, 1000), ''), left(paper, 500)) AS abstract FROM p LEFT JOIN t USING (doc_id) LEFT JOIN a USING (doc_id)"""


@query(_SCAN)
def title_abstract_linescan(spark, sf_dir):
    title, abstract = S.title_and_abstract(F.col("paper"))
    return _papers(spark, sf_dir).select("doc_id", title.alias("title"), abstract.alias("abstract"))


@query(f"SELECT doc_id, coalesce(nullif({_STRIP("regexp_extract(paper, '(?m)^#\\s+(.+)$', 1)")}, ''), nullif({_STRIP("regexp_extract(" + _STRIP('paper') + ", '\\A([^\\n]+)', 1)")}, ''), '{S.UNTITLED}') AS title FROM {_PAPERS}")
def title_regex(spark, sf_dir):
    return _papers(spark, sf_dir).select("doc_id", S.title_of(F.col("paper")).alias("title"))


@query(f"SELECT doc_id, left({_STRIP(f"regexp_extract(paper, '{S.ABSTRACT_FORM}', 1)")}, 1500) AS abstract FROM {_PAPERS}")
def abstract_regex(spark, sf_dir):
    return _papers(spark, sf_dir).select("doc_id", S.abstract_of(F.col("paper")).alias("abstract"))


def _cap_sql(text: str, most: int, mark: str) -> str:
    return f"CASE WHEN length({text}) > {most} THEN left({text}, {most}) || {sql_text(mark)} ELSE {text} END"


@query(f"SELECT doc_id, {_cap_sql('text', S.EVAL_CHARS, S.EVAL_MARK)} AS for_eval, {_cap_sql('text', S.INFERENCE_CHARS, S.INFERENCE_MARK)} AS for_inference FROM documents")
def content_cap(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", S.capped(t, S.EVAL_CHARS, S.EVAL_MARK).alias("for_eval"), S.capped(t, S.INFERENCE_CHARS, S.INFERENCE_MARK).alias("for_inference"))


@query("SELECT '### Instruction:' || chr(10) || 'Describe ' || source || chr(10) || chr(10) || '### Input:' || chr(10) || left(text, 4000) || chr(10) || chr(10) || '### Response:' || chr(10) || 'lang=' || lang AS text FROM documents")
def prompt_readme(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(S.readme_prompt(F.concat(F.lit("Describe "), "source"), F.col("text"), F.concat(F.lit("lang="), "lang")).alias("text"))


_INSTRUCTION = lambda title, abstract: f"{sql_text(S.INSTRUCTION)} || chr(10) || chr(10) || 'Title: ' || coalesce({title}, '') || chr(10) || chr(10) || 'Abstract: ' || coalesce({abstract}, '')"


@query(f"SELECT doc_id, '<s>[INST] ' || {_INSTRUCTION('source', 'left(text, 100)')} || chr(10) || chr(10) || {_cap_sql('text', S.INFERENCE_CHARS, S.INFERENCE_MARK)} || ' [/INST]' AS prompt FROM documents")
def prompt_inference(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.inference_prompt(F.col("source"), F.left("text", F.lit(100)), F.col("text")).alias("prompt"))


@query("SELECT item_id, 'Judge {this}: ' || item_id || ' by A=' || left(text, 50) || ' or B=' || right(text, 50) || '.' AS prompt FROM benchmark")
def prompt_judge(spark, sf_dir):
    filled = S.filled("Judge {{this}}: {title} by A={a} or B={b}.", title=F.col("item_id").cast("string"), a=F.left("text", F.lit(50)), b=F.right("text", F.lit(50)))
    return table(spark, sf_dir, "benchmark").select("item_id", filled.alias("prompt"))


#: Years and topics as they stand in manifests.
_YEAR = "CASE doc_id % 5 WHEN 0 THEN '2024' WHEN 1 THEN NULL WHEN 2 THEN 'soon' WHEN 3 THEN ' 1999 ' ELSE '' END"
_TOPICS = "CASE doc_id % 4 WHEN 0 THEN source || ', ' || lang WHEN 1 THEN NULL WHEN 2 THEN '' ELSE lang || ',,' || source END"


@query(f"SELECT doc_id, coalesce(try_cast({_YEAR} AS INT), 0) AS year FROM documents")
def year_coerce(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_YEAR} AS y").select("doc_id", S.year(F.col("y")).alias("year"))


@query(f"SELECT doc_id, unnest(string_split(t, ',')) AS topic, unnest(range(len(string_split(t, ',')))) AS i FROM (SELECT doc_id, {_TOPICS} AS t FROM documents) WHERE t IS NOT NULL")
def topics_split(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_TOPICS} AS t")
    return rows.select("doc_id", F.posexplode(S.topics(F.col("t"))).alias("i", "topic")).select("doc_id", "topic", F.col("i").cast("long").alias("i"))


#: Paths of pages: below the host of the url or elsewhere, with a suffix from the id; the stem is the url's last part.
_PATHS = """(SELECT page_id, split_part(url, '/', 3) AS host, CASE WHEN page_id % 7 = 0 THEN 'other/' ELSE host || '/' END || lang || '/' || stem || CASE page_id % 6 WHEN 0 THEN '.PNG' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.tar.gif' WHEN 3 THEN '' WHEN 4 THEN '.WebP' ELSE '.jpg' END AS path
  FROM (SELECT page_id, url, split_part(url, '/', 4) AS lang, CASE WHEN page_id % 9 = 0 THEN '.h' ELSE 'p' END || split_part(split_part(url, '?', 1), '/', -1) AS stem FROM pages))"""


@query(
    f"""SELECT page_id, CASE WHEN dots > 0 THEN lower(ext) ELSE '' END AS suffix, CASE CASE WHEN dots > 0 THEN lower(ext) ELSE '' END WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg' WHEN 'gif' THEN 'image/gif' WHEN 'webp' THEN 'image/webp' ELSE 'image/png' END AS media_type,
  CASE WHEN dots > 0 THEN left(name, length(name) - length(ext) - 1) ELSE name END AS stem, CASE WHEN starts_with(path, host || '/') THEN path[length(host) + 2:] ELSE path END AS below
FROM (SELECT *, split_part(name, '.', -1) AS ext, length(name[2:]) - length(replace(name[2:], '.', '')) AS dots FROM (SELECT *, split_part(path, '/', -1) AS name FROM {_PATHS}))"""
)
def mime_case(spark, sf_dir):
    """Suffix, media type, stem and path below a folder."""
    n, part = F.col("page_id"), lambda k: F.split_part(F.col("url"), F.lit("/"), F.lit(k))
    name = F.concat(F.when(n % 9 == 0, ".h").otherwise("p"), F.split_part(F.split_part(F.col("url"), F.lit("?"), F.lit(1)), F.lit("/"), F.lit(-1)))
    ends = F.lit("")
    for k, ext in enumerate((".PNG", ".jpeg", ".tar.gif", "", ".WebP", ".jpg")):
        ends = F.when(n % 6 == k, ext).otherwise(ends)
    path = F.concat(F.when(n % 7 == 0, "other/").otherwise(F.concat(part(3), F.lit("/"))), part(4), F.lit("/"), name, ends)
    rows = table(spark, sf_dir, "pages").select("page_id", path.alias("path"), part(3).alias("host"))
    p = F.col("path")
    return rows.select("page_id", S.suffix(p).alias("suffix"), S.media_type(p).alias("media_type"), S.stem(p).alias("stem"), S.relative(p, F.col("host")).alias("below"))


@query("SELECT doc_id, length(base64(encode(text)))::BIGINT AS size, length(base64(encode(text))) <= 2000 AS fits, md5(base64(encode(text))) AS encoded_md5 FROM documents")
def base64_size(spark, sf_dir):
    """Sizes from lengths alone, and the digest of what encoding the whole text gives."""
    size = S.base64_size(F.octet_length("text"))
    coded = F.replace(F.base64(F.encode("text", "UTF-8")), F.lit("\r\n"), F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", size.alias("size"), (size <= 2000).alias("fits"), F.md5(coded).alias("encoded_md5"))


@query(f"SELECT doc_id, CASE WHEN length(text) <= {T.max_chars(3500)} THEN text ELSE text END AS text, CASE WHEN length(text) <= {T.max_chars(3500)} THEN 'none_needed' ELSE 'none' END AS method FROM documents")
def truncate_none(spark, sf_dir):
    text, method = T.truncated(F.col("text"), T.max_chars(3500), "none")
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), method.alias("method"))


@query(f"SELECT doc_id, left(text, {T.max_chars(3500)}) AS text, CASE WHEN length(text) <= {T.max_chars(3500)} THEN 'none_needed' ELSE 'fallback' END AS method FROM documents")
def truncate_fallback(spark, sf_dir):
    text, method = T.truncated(F.col("text"), T.max_chars(3500), "other")
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), method.alias("method"))


@query("SELECT bool_and(length(text) // 4 <= 6000) AS all_fit, bool_or(length(text) // 4 <= 6000) AS any_fits, count(*) FILTER (length(text) // 4 > 6000) AS too_long FROM documents")
def fit_invariants(spark, sf_dir):
    fits = T.estimate_tokens(F.col("text")) <= 6000
    return table(spark, sf_dir, "documents").agg(F.bool_and(fits).alias("all_fit"), F.bool_or(fits).alias("any_fits"), F.count_if(~fits).alias("too_long"))
