"""Queries that put training examples together: documents are the manifest, pages and labels what was parsed."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.functions import scan as S
from quarrymill.operators import assemble as A
from quarrymill.plans.registry import query, sql_text, table

#: Papers: two versions for some pages (the later counts), empty ones; posters: labels, with errors.
_PAPERS = "(SELECT page_id AS paper_id, page_id AS pos, CASE WHEN page_id % 7 = 0 THEN '' ELSE 'paper ' || url END AS paper_markdown FROM pages UNION ALL SELECT page_id, page_id + 100000, 'again ' || url FROM pages WHERE page_id % 3 = 0)"
_POSTERS = "(SELECT doc_id AS paper_id, doc_id AS pos, CASE WHEN toxic = 1 THEN NULL ELSE 'poster ' || doc_id END AS poster_markdown, '{\"q\": ' || coalesce(quality, 0) || '}' AS layout, CASE WHEN toxic = 1 THEN CASE WHEN doc_id % 2 = 0 THEN 'call failed' ELSE '' END END AS error FROM labels)"


def _papers(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    first = pages.select(F.col("page_id").alias("paper_id"), F.col("page_id").alias("pos"), F.when(F.col("page_id") % 7 == 0, "").otherwise(F.concat(F.lit("paper "), "url")).alias("paper_markdown"))
    again = pages.where("page_id % 3 = 0").select("page_id", F.col("page_id") + 100000, F.concat(F.lit("again "), "url"))
    return first.union(again)


def _posters(spark, sf_dir):
    bad = F.col("toxic") == 1
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("paper_id"), F.col("doc_id").alias("pos"), F.when(~bad, F.concat(F.lit("poster "), "doc_id")).alias("poster_markdown"),
        F.concat(F.lit('{"q": '), F.coalesce("quality", F.lit(0)), F.lit("}")).alias("layout"), F.when(bad, F.when(F.col("doc_id") % 2 == 0, "call failed").otherwise("")).alias("error"),
    )


def _manifest(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), F.col("source").alias("paper_title"), F.left("text", F.lit(50)).alias("paper_abstract"))


_ASSEMBLED = f"""(WITH p AS (SELECT paper_id, nullif(nullif(trim(arg_max(paper_markdown, pos)), ''), '{{}}') AS paper_markdown FROM {_PAPERS} GROUP BY 1),
q AS (SELECT paper_id AS q_id, poster_markdown, layout, error AS poster_error FROM {_POSTERS})
SELECT d.doc_id AS paper_id, source AS paper_title, left(text, 50) AS paper_abstract, paper_markdown, poster_markdown, layout,
  paper_markdown IS NOT NULL AND poster_markdown IS NOT NULL AS success,
  CASE WHEN paper_markdown IS NULL OR poster_markdown IS NULL THEN CASE WHEN q_id IS NULL THEN '{A.NOT_PROCESSED}' ELSE coalesce(nullif(poster_error, ''), '{A.NO_PAPER}') END END AS error
FROM documents d LEFT JOIN p ON d.doc_id = p.paper_id LEFT JOIN q ON d.doc_id = q_id)"""


def _assembled(spark, sf_dir):
    return A.assembled(_manifest(spark, sf_dir), _papers(spark, sf_dir), _posters(spark, sf_dir))


@query(f"SELECT * FROM {_ASSEMBLED}")
def assemble_training_example(spark, sf_dir):
    return _assembled(spark, sf_dir)


@query(f"SELECT success, error, count(*) AS n FROM {_ASSEMBLED} GROUP BY ALL")
def assemble_errors(spark, sf_dir):
    return _assembled(spark, sf_dir).groupBy("success", "error").agg(F.count("*").alias("n"))


@query(
    f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '' ELSE url END AS paper FROM pages), l AS (SELECT doc_id, CASE WHEN quality = 1 THEN '{{"q": 1}}' ELSE ' {{}} ' END AS layout, 'poster ' || doc_id AS poster FROM labels),
m AS (SELECT vec_id // 32 AS pair, count(*) AS n FROM embeddings GROUP BY 1)
SELECT doc_id AS paper_id, coalesce(m.n, 0) AS matches, CASE WHEN nullif(paper, '') IS NULL OR poster IS NULL OR nullif(trim(layout), '{{}}') IS NULL THEN '{A.MISSING}' END AS error
FROM documents LEFT JOIN p ON doc_id = page_id LEFT JOIN l USING (doc_id) LEFT JOIN m ON doc_id = pair"""
)
def combine_components(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("paper_id"), F.when(F.col("page_id") % 7 == 0, "").otherwise(F.col("url")).alias("paper_markdown"))
    labels = table(spark, sf_dir, "labels")
    layouts = labels.select(F.col("doc_id").alias("paper_id"), F.when(F.col("quality") == 1, '{"q": 1}').otherwise(" {} ").alias("layout"))
    posters = labels.select(F.col("doc_id").alias("paper_id"), F.concat(F.lit("poster "), "doc_id").alias("poster_markdown"))
    # At most 32 figures a pair.
    matches = table(spark, sf_dir, "embeddings").groupBy(F.floor(F.col("vec_id") / 32).alias("paper_id")).agg(F.collect_list("vec_id").alias("figure_matches"))
    out = A.combined(_manifest(spark, sf_dir).select("paper_id"), posters, pages, layouts, matches)
    return out.select("paper_id", F.size("figure_matches").cast("long").alias("matches"), "error")


_INSTRUCTION = f"{sql_text(S.INSTRUCTION)} || chr(10) || chr(10) || 'Title: ' || coalesce(paper_title, '') || chr(10) || chr(10) || 'Abstract: ' || coalesce(paper_abstract, '')"


@query(f"SELECT {_INSTRUCTION} AS instruction, paper_markdown AS input, (replace(layout, ' ', ''))::VARCHAR AS layout, poster_markdown AS content FROM {_ASSEMBLED} WHERE success")
def export_instruction_rows(spark, sf_dir):
    """Rows for instruction tuning; the output's JSON is read back into its two parts."""
    rows = A.export_rows(_assembled(spark, sf_dir).where("success"))
    part = lambda p: F.try_variant_get(F.parse_json("output"), p, "string")
    return rows.select("instruction", "input", part("$.layout").alias("layout"), part("$.content").alias("content"))


_FIGURES = "(SELECT vec_id // 32 AS paper_id, list({'paper_figure': 'p' || vec_id, 'poster_position': 'q' || vec_id} ORDER BY vec_id) AS m FROM embeddings WHERE vec_id % 8 = 0 GROUP BY 1)"


@query(f"SELECT {_INSTRUCTION} AS instruction, to_json(m)::VARCHAR AS figure_mapping FROM {_ASSEMBLED} JOIN {_FIGURES} f USING (paper_id) WHERE success")
def export_with_figure_mapping(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").where("vec_id % 8 = 0")
    pair = F.struct("vec_id", F.concat(F.lit("p"), "vec_id").alias("paper_figure"), F.concat(F.lit("q"), "vec_id").alias("poster_figure"))
    figures = v.groupBy(F.floor(F.col("vec_id") / 32).alias("paper_id")).agg(F.array_sort(F.collect_list(pair)).alias("figure_matches"))
    rows = A.export_rows(_assembled(spark, sf_dir).where("success").join(figures, "paper_id"), figures=True)
    return rows.select("instruction", F.get_json_object("output", "$.figure_mapping").alias("figure_mapping"))


_META = "(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS title, lang AS abstract, CASE doc_id % 4 WHEN 0 THEN '2023' WHEN 1 THEN NULL ELSE 'nan' END AS year, CASE WHEN doc_id % 2 = 0 THEN lang || ',' || source END AS topics FROM documents)"


@query(
    f"""SELECT doc_id, 'simple' AS policy, coalesce(title, '') AS title, CASE WHEN doc_id % 4 = 0 THEN 2023 END AS year, topics, CASE WHEN doc_id % 4 <> 0 THEN 'year is no number' END AS error FROM {_META}
UNION ALL SELECT doc_id, 'original', coalesce(title, ''), CASE WHEN doc_id % 4 = 0 THEN 2023 ELSE 0 END, coalesce(replace(topics, ',', '|'), ''), NULL FROM {_META}
UNION ALL SELECT doc_id, 'staged', coalesce(title, ''), CASE WHEN doc_id % 4 = 0 THEN 2023 ELSE 0 END, NULL, NULL FROM {_META}"""
)
def metadata_policies(spark, sf_dir):
    n = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(n % 3 != 0, F.col("source")).alias("title"), F.col("lang").alias("abstract"), F.lit(None).cast("string").alias("conference"),
        F.when(n % 4 == 0, "2023").when(n % 4 != 1, "nan").alias("year"), F.when(n % 2 == 0, F.concat("lang", F.lit(","), "source")).alias("topics"),
    )
    empty = F.lit(None).cast("string")
    shown = {"simple": (F.col("topics"), F.col("error")), "original": (F.array_join("topics", "|"), empty), "staged": (empty, empty)}
    out = [A.metadata(rows, p).select("doc_id", F.lit(p).alias("policy"), "title", "year", t.alias("topics"), e.alias("error")) for p, (t, e) in shown.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])
