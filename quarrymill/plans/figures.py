"""Queries over figures and pages. A pair is 32 vectors in a row: its even ones stand for one side's figures, the odd ones for the other's."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.operators import figures as G
from quarrymill.operators import tables as O
from quarrymill.plans.registry import query, table

_PAIR = 32


def _sides(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    # The signs of all components stand for an image's hash.
    side = lambda odd, n: v.where(F.col("vec_id") % 2 == odd).select(F.floor(F.col("vec_id") / _PAIR).alias("pair"), F.col("vec_id").alias(f"{n}_id"), G.sign_words(F.col("embedding")).alias(f"{n}_hash"))
    return side(0, "l"), side(1, "r")


def _candidates(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return O.match_pairs(left, right, "pair", T.hamming_score(G.hash_distance(F.col("l_hash"), F.col("r_hash"))))


_SCORED = f"""(SELECT a.vec_id // {_PAIR} AS pair, a.vec_id AS l_id, b.vec_id AS r_id, greatest(0.0, 1 - list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: ((z[1] > 0) <> (z[2] > 0))::INT)) / 64.0)::DOUBLE AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id // {_PAIR} = b.vec_id // {_PAIR} AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1)"""
_MATCHES = f"(SELECT *, row_number() OVER (PARTITION BY pair ORDER BY score DESC, l_id, r_id) AS rank FROM {_SCORED} WHERE score >= 0.1)"
_VERDICT = "CASE WHEN score >= 0.5 THEN 'same' WHEN score >= 0.25 THEN 'similar' END"


@query(f"SELECT pair, l_id, r_id, score FROM {_SCORED}")
def phash_score(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return left.join(right, "pair").select("pair", "l_id", "r_id", T.hamming_score(G.hash_distance(F.col("l_hash"), F.col("r_hash"))).alias("score"))


@query(f"SELECT pair, l_id, r_id, score, rank FROM {_MATCHES}")
def match_rank(spark, sf_dir):
    return _candidates(spark, sf_dir).select("pair", "l_id", "r_id", "score", "rank")


@query(f"SELECT {_VERDICT} AS verdict, count(*) AS n FROM {_MATCHES} WHERE score >= 0.25 GROUP BY 1")
def match_counts(spark, sf_dir):
    v = _candidates(spark, sf_dir).select(O.feature_verdict(F.col("score")).alias("verdict")).where("verdict IS NOT NULL")
    return v.groupBy("verdict").agg(F.count("*").alias("n"))


def _feature_only(spark, sf_dir):
    return _candidates(spark, sf_dir).withColumn("verdict", O.feature_verdict(F.col("score"))).where("verdict IS NOT NULL")


@query(f"SELECT pair, l_id, r_id, {_VERDICT} AS verdict, CASE WHEN score >= 0.5 THEN 'high' ELSE 'medium' END AS confidence, score FROM {_MATCHES} WHERE score >= 0.25")
def figure_match_feature_only(spark, sf_dir):
    level = F.when(F.col("verdict") == "same", "high").otherwise("medium")
    return _feature_only(spark, sf_dir).select("pair", "l_id", "r_id", "verdict", level.alias("confidence"), "score")


@query(
    f"""WITH m AS (SELECT *, {_VERDICT} AS verdict FROM {_MATCHES} WHERE score >= 0.25), n AS (SELECT *, row_number() OVER (PARTITION BY pair, verdict ORDER BY rank) AS number FROM m)
SELECT pair, posters AS poster_figures_count, papers AS paper_figures_count, coalesce(found, 0) AS candidates_found, coalesce(matches, 0) AS matches, digest FROM
  (SELECT vec_id // {_PAIR} AS pair, count(*) FILTER (vec_id % 2 = 0) AS posters, count(*) FILTER (vec_id % 2 = 1) AS papers FROM embeddings GROUP BY 1)
  LEFT JOIN (SELECT pair, count(*) AS found FROM {_MATCHES} GROUP BY 1) USING (pair)
  LEFT JOIN (SELECT pair, count(*) AS matches, string_agg(l_id || '-' || r_id || ':' || verdict || number, ' ' ORDER BY rank) AS digest FROM n GROUP BY 1) USING (pair)"""
)
def match_report(spark, sf_dir):
    side = F.when(F.col("vec_id") % 2 == 0, "poster").otherwise("paper")
    figures = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / _PAIR).alias("pair"), side.alias("side"))
    out = G.match_report(_feature_only(spark, sf_dir), _candidates(spark, sf_dir), figures, "pair")
    said = F.array_join(F.transform("matches", lambda m: F.concat(m["l_id"].cast("string"), F.lit("-"), m["r_id"].cast("string"), F.lit(":"), m["verdict"], m["number"].cast("string"))), " ")
    return out.select("pair", "poster_figures_count", "paper_figures_count", "candidates_found", F.size("matches").cast("long").alias("matches"), F.nullif(said, F.lit("")).alias("digest"))


#: Three scores of a pair over all components: share of equal signs, how close their sums are, share of close components.
_THREE = f"""(SELECT pair, l_id, r_id, greatest(0.0, 1 - list_sum(list_transform(z, lambda e: ((e[1] > 0) <> (e[2] > 0))::INT)) / 64.0)::DOUBLE AS phash, 1 / (1 + abs(list_sum(list_transform(z, lambda e: floor(64 * e[1]::DOUBLE) - floor(64 * e[2]::DOUBLE))) / 64)) AS ssim,
  len(list_filter(z, lambda e: abs(floor(64 * e[1]::DOUBLE) - floor(64 * e[2]::DOUBLE)) <= 4)) / len(z) AS feature FROM (SELECT a.vec_id // {_PAIR} AS pair, a.vec_id AS l_id, b.vec_id AS r_id, list_zip(a.embedding, b.embedding) AS z
  FROM embeddings a JOIN embeddings b ON a.vec_id // {_PAIR} = b.vec_id // {_PAIR} AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1))"""


def _three(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    units = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64))
    side = lambda odd, n: v.where(F.col("vec_id") % 2 == odd).select(F.floor(F.col("vec_id") / _PAIR).alias("pair"), F.col("vec_id").alias(f"{n}_id"), G.sign_words(F.col("embedding")).alias(f"{n}_hash"), units.alias(f"{n}_v"))
    both = side(0, "l").join(side(1, "r"), "pair")
    apart = F.zip_with("l_v", "r_v", lambda a, b: a - b)
    total = F.aggregate(apart, F.lit(0).cast("long"), lambda s, x: s + x)
    scores = G.pair_scores(T.hamming_score(G.hash_distance(F.col("l_hash"), F.col("r_hash"))), 1 / (1 + F.abs(total / 64)), F.size(F.filter(apart, lambda x: F.abs(x) <= 4)) / F.size(apart))
    return both.select("pair", "l_id", "r_id", scores.alias("s"))


@query(f"SELECT pair, l_id, r_id, round(0.3 * phash + 0.3 * ssim + 0.4 * feature, 9) AS combined FROM {_THREE}")
def combined_score(spark, sf_dir):
    return _three(spark, sf_dir).select("pair", "l_id", "r_id", F.round("s.combined", 9).alias("combined"))


@query(
    f"""WITH v AS (SELECT vec_id // {_PAIR} AS pair, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings),
d AS (SELECT a.pair, a.vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY d) AS k FROM v a JOIN v b ON a.pair = b.pair AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
n AS (SELECT pair, vec_id, max(d) FILTER (k = 1) AS d1, max(d) FILTER (k = 2) AS d2 FROM d WHERE k <= 2 GROUP BY 1, 2),
g AS (SELECT pair, count(*) FILTER (d1 < 0.7 * 0.7 * d2) AS good FROM n GROUP BY 1),
s AS (SELECT pair, count(*) FILTER (vec_id % 2 = 0) AS nl, count(*) FILTER (vec_id % 2 = 1) AS nr FROM v GROUP BY 1)
SELECT pair, CASE WHEN nl >= 2 AND nr >= 2 THEN coalesce(good, 0) ELSE 0 END AS good, CASE WHEN nl >= 2 AND nr >= 2 THEN coalesce(good, 0) / least(nl, nr) ELSE 0 END::DOUBLE AS ratio FROM s LEFT JOIN g USING (pair) WHERE nl > 0 AND nr > 0"""
)
def knn_ratio_test(spark, sf_dir):
    """Whole numbers, so that equal distances are equal in both engines."""
    v = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / _PAIR).alias("pair"), F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("double")).alias("v"))
    return G.nearest_ratio(v.where("id % 2 = 0"), v.where("id % 2 = 1"), "pair")


#: Images of a document: pages of 25 records, sizes from the record's text.
_IMAGES = "(SELECT page_id // 25 AS doc, page_id % 25 // 5 AS page, page_id % 5 AS idx, length(url) * 4 AS width, length(html) % 400 AS height FROM pages)"


def _images(spark, sf_dir):
    p = F.col("page_id")
    return table(spark, sf_dir, "pages").select(F.floor(p / 25).alias("doc"), F.floor(p % 25 / 5).alias("page"), (p % 5).alias("idx"), (F.length("url") * 4).alias("width"), (F.length("html") % 400).alias("height"))


@query(f"SELECT doc, page, idx, (row_number() OVER (PARTITION BY doc ORDER BY page, idx))::INT AS number, doc || '_fig_' || row_number() OVER (PARTITION BY doc ORDER BY page, idx) AS figure_id FROM {_IMAGES} WHERE width >= 100 AND height >= 100")
def figure_numbering(spark, sf_dir):
    return G.numbered_figures(_images(spark, sf_dir), "doc", "page", "idx").select("doc", "page", "idx", "number", "figure_id")


@query(f"SELECT doc, string_agg('paper:' || doc || '_fig_' || k, ' ' ORDER BY k) AS figures FROM (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY page, idx) AS k FROM {_IMAGES} WHERE width >= 100 AND height >= 100) GROUP BY 1")
def figures_per_doc(spark, sf_dir):
    own = G.tagged_figures(G.numbered_figures(_images(spark, sf_dir), "doc", "page", "idx"), "doc", "paper")
    return own.select("doc", F.array_join(F.transform("figures", lambda f: F.concat(f["source_doc"], F.lit(":"), f["figure_id"])), " ").alias("figures"))


#: Elements of a page: turns of a conversation; every seventh fails, some are too small.
_ELEMENTS = """(SELECT conv_id AS page, turn, text, CASE (conv_id + turn) % 4 WHEN 0 THEN 'tab' WHEN 1 THEN 'equ' WHEN 2 THEN 'code' ELSE 'text' END AS label, (conv_id * 3 + turn) % 7 = 0 AS failed,
  length(text) % 10 AS width, 4 + turn AS height FROM conversations)"""
_ORDERED = f"(SELECT * FROM (SELECT *, count(*) FILTER (NOT failed) OVER (PARTITION BY page ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reading_order FROM {_ELEMENTS}) WHERE NOT failed AND width > 3 AND height > 3)"


def _elements(spark, sf_dir):
    n = (F.col("conv_id") + F.col("turn")) % 4
    label = F.when(n == 0, "tab").when(n == 1, "equ").when(n == 2, "code").otherwise("text")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page"), "turn", "text", label.alias("label"), ((F.col("conv_id") * 3 + F.col("turn")) % 7 == 0).alias("failed"), (F.length("text") % 10).alias("width"), (F.col("turn") + 4).alias("height"))
    return G.reading_order(rows, "page", "turn")


@query(f"SELECT page, turn, label, reading_order FROM {_ORDERED}")
def reading_order(spark, sf_dir):
    return _elements(spark, sf_dir).select("page", "turn", "label", "reading_order")


@query(f"SELECT page, string_agg(regexp_replace(text, '\\A\\s+|\\s+\\z', '', 'g'), chr(10) || chr(10) ORDER BY reading_order, regexp_replace(text, '\\A\\s+|\\s+\\z', '', 'g')) AS text FROM {_ORDERED} GROUP BY 1")
def reading_order_merge(spark, sf_dir):
    """Batches by label, merged in reading order."""
    rows = _elements(spark, sf_dir)
    return G.merged_page([rows.where(F.col("label") == k).select("page", "reading_order", "text") for k in ("tab", "equ", "code", "text")], "page")


@query("SELECT conv_id, turn, CASE WHEN text IS NULL OR turn = 0 OR NOT starts_with(l, '[') OR NOT ends_with(l, ']') OR (turn > 1 AND length(text) % 10 > 5) THEN 'distorted_page' ELSE l END AS layout FROM (SELECT *, CASE WHEN conv_id % 5 = 0 THEN left(text, 9) ELSE '[' || left(text, 9) || ']' END AS l FROM conversations)")
def layout_sanity(spark, sf_dir):
    layout = F.when(F.col("conv_id") % 5 == 0, F.left("text", F.lit(9))).otherwise(F.concat(F.lit("["), F.left("text", F.lit(9)), F.lit("]")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", G.sane_layout(layout, F.col("turn"), F.length("text") % 10 / 10).alias("layout"))


@query("SELECT conv_id, string_agg('## Page ' || (turn + 1) || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY turn, text) AS markdown FROM conversations WHERE regexp_matches(text, '\\S') GROUP BY 1")
def pages_markdown(spark, sf_dir):
    return G.pages_text(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("SELECT conv_id, turn, turn + 1 AS page_number FROM conversations")
def page_numbers(spark, sf_dir):
    return G.page_numbers(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "turn")


@query(f"SELECT pair, l_id, r_id, round(phash, 9) AS phash, round(ssim, 9) AS ssim, round(feature, 9) AS feature FROM {_THREE}")
def pair_scores(spark, sf_dir):
    """All scores of a pair apart."""
    return _three(spark, sf_dir).select("pair", "l_id", "r_id", *(F.round(f"s.{c}", 9).alias(c) for c in ("phash", "ssim", "feature")))


_FIGURE_SQL = "{'figure_id': 'f' || %s, 'source_doc': '%s', 'file_path': '/fig/' || %s || '.png', 'bbox': NULL, 'caption': NULL, 'figure_type': NULL, 'page_number': 1}"


@query(
    f"""SELECT pair, l_id, r_id, to_json({{'poster_figure': {_FIGURE_SQL % ('l_id', 'poster', 'l_id')}, 'paper_figure': {_FIGURE_SQL % ('r_id', 'paper', 'r_id')}, 'match_confidence': CASE WHEN score >= 0.5 THEN 'high' ELSE 'medium' END, 'feature_score': score,
  'vlm_verdict': {_VERDICT}, 'vlm_confidence': NULL, 'vlm_reasoning': NULL}})::VARCHAR AS record FROM {_MATCHES} WHERE score >= 0.25"""
)
def match_records(spark, sf_dir):
    """Each match as a record's JSON, with both figures inside."""
    from quarrymill.functions import records as R

    figure = lambda c, source: R.record("figure", figure_id=F.concat(F.lit("f"), c), source_doc=F.lit(source), file_path=F.concat(F.lit("/fig/"), c, F.lit(".png")))
    level = F.when(F.col("verdict") == "same", "high").otherwise("medium")
    record = R.record("match", poster_figure=figure(F.col("l_id"), "poster"), paper_figure=figure(F.col("r_id"), "paper"), match_confidence=level, feature_score=F.col("score"), vlm_verdict=F.col("verdict"))
    return _feature_only(spark, sf_dir).select("pair", "l_id", "r_id", R.as_json(record).alias("record"))


@query("SELECT doc_id, to_json({'doc_id': doc_id::VARCHAR, 'doc_type': 'paper', 'source_path': source, 'markdown_content': text, 'figures': [], 'tables': [], 'equations': [], 'metadata': {}})::VARCHAR IS NOT NULL AS whole, source AS source_path, md5(text) AS content_md5, 0 AS figures, '{}' AS metadata FROM documents")
def document_records(spark, sf_dir):
    """Documents as records' JSON over whole texts, read back."""
    from quarrymill.functions import records as R

    record = R.record("document", doc_id=F.col("doc_id"), doc_type=F.lit("paper"), source_path=F.col("source"), markdown_content=F.col("text"))
    said = table(spark, sf_dir, "documents").select("doc_id", R.as_json(record).alias("json"))
    back = said.select("doc_id", R.loaded("document", F.col("json")).alias("r"))
    return back.select("doc_id", F.col("r").isNotNull().alias("whole"), "r.source_path", F.md5("r.markdown_content").alias("content_md5"), F.size("r.figures").alias("figures"), F.to_json("r.metadata").alias("metadata"))
