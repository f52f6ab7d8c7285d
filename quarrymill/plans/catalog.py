"""The reference operators' queries over the driver tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.operators import tables as O
from quarrymill.plans import assembly, documents, evaluation, figures, pages, responses, tracking  # noqa: F401 - they register their queries
from quarrymill.plans.registry import ORACLES, QUERIES, query
from quarrymill.plans.registry import table as _t

MOST = T.max_chars(3500)
HEADS = ("abstract", "introduction", "method", "result", "conclusion")


def _rows(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Describe "), "source").alias("instruction"), F.col("text").alias("input"), F.concat(F.lit("lang="), "lang").alias("output"))


_ROWS = "(SELECT doc_id, 'Describe ' || source AS instruction, text AS input, 'lang=' || lang AS output FROM documents)"


@query("SELECT doc_id, length(text) // 4 AS tokens FROM documents")
def estimate_tokens(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.estimate_tokens(F.col("text")).alias("tokens"))


@query("SELECT min(length(text) // 4) AS low, max(length(text) // 4) AS high, (sum(length(text) // 4) // count(*))::BIGINT AS mean FROM documents")
def token_stats(spark, sf_dir):
    t = T.estimate_tokens(F.col("text"))
    return _t(spark, sf_dir, "documents").agg(F.min(t).alias("low"), F.max(t).alias("high"), F.expr("sum(length(text) div 4) div count(*)").alias("mean"))


@query("SELECT length(text) // 4 <= 1024 AS fits, count(*) AS n FROM documents GROUP BY 1")
def fits_in_context(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy((T.estimate_tokens(F.col("text")) <= 1024).alias("fits")).agg(F.count("*").alias("n"))


@query("SELECT length(text) >= 100 AS is_full, count(*) AS n FROM documents GROUP BY 1")
def partition_full_partial(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy((F.length("text") >= O.FULL_CHARS).alias("is_full")).agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, CASE WHEN length(text) <= {MOST} THEN text ELSE left(text, {MOST}) || chr(10) || chr(10) || '[Content truncated...]' END AS text, CASE WHEN length(text) <= {MOST} THEN 'none_needed' ELSE 'head' END AS method FROM documents")
def truncate_head(spark, sf_dir):
    text, method = T.truncated(F.col("text"), MOST, "head")
    return _t(spark, sf_dir, "documents").select("doc_id", text.alias("text"), method.alias("method"))


@query(f"SELECT CASE WHEN length(text) <= {MOST} THEN 'none_needed' ELSE 'head' END AS method, count(*) AS n FROM documents GROUP BY 1")
def extraction_method_hist(spark, sf_dir):
    return truncate_head(spark, sf_dir).groupBy("method").agg(F.count("*").alias("n"))


def _paper(spark, sf_dir) -> DataFrame:
    """The whole text over the headings: fifths of its length, the last one to the end."""
    fifth = F.floor(F.length("text") / len(HEADS)).cast("int")
    sizes = [fifth] * (len(HEADS) - 1) + [F.length("text")]
    parts = [F.concat(F.lit(f"\n## {h.capitalize()}\n"), F.substring("text", 1 + fifth * i, n)) for i, (h, n) in enumerate(zip(HEADS, sizes, strict=True))]
    return _t(spark, sf_dir, "documents").select("doc_id", F.concat(*parts).alias("paper"))


_SLICE = lambda i: f"substring(text, 1 + length(text) // {len(HEADS)} * {i}" + (f", length(text) // {len(HEADS)})" if i < len(HEADS) - 1 else ")")
_PAPER = "(SELECT doc_id, " + " || ".join(f"chr(10) || '## {h.capitalize()}' || chr(10) || {_SLICE(i)}" for i, h in enumerate(HEADS)) + " AS paper FROM documents)"


def _section_case(name: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(paper, '{p}') THEN regexp_replace(regexp_extract(paper, '{p}', 1), '\\A\\s+|\\s+\\z', '', 'g')" for p in T.section_patterns(name))
    return f"substring(CASE {whens} ELSE '' END, 1, {T.SECTION_CHARS[name]})"


def _section(name: str):
    @query(f"SELECT doc_id, {_section_case(name)} AS body FROM {_PAPER}")
    def sections(spark, sf_dir):
        return _paper(spark, sf_dir).select("doc_id", T.section(F.col("paper"), name).alias("body"))

    QUERIES[f"sections_{name}"], ORACLES[f"sections_{name}"] = QUERIES.pop("sections"), ORACLES.pop("sections")


for _name in T.SECTION_CHARS:
    _section(_name)

_SMART = 1500
_CUT = "chr(10) || chr(10) || '[Content truncated...]'"
_PARTS = ", ".join(f"CASE WHEN s_{k} <> '' THEN '## {k.capitalize()}' || chr(10) || left(s_{k}, {2000 if k in ('methods', 'results') else n}) END" for k, n in T.SECTION_CHARS.items())


@query(
    f"""WITH s AS (SELECT doc_id, paper, {', '.join(f'{_section_case(k)} AS s_{k}' for k in T.SECTION_CHARS)} FROM {_PAPER}),
j AS (SELECT doc_id, paper, concat_ws(chr(10) || chr(10), {_PARTS}) AS joined FROM s)
SELECT doc_id, CASE WHEN length(paper) <= {_SMART} THEN 'none_needed' ELSE 'regex' END AS method, CASE WHEN length(paper) <= {_SMART} THEN paper WHEN length(joined) > {_SMART} THEN left(joined, {_SMART}) || {_CUT}
  WHEN {_SMART} - length(joined) - 100 > 1000 AND length(paper) > length(joined) THEN joined || chr(10) || chr(10) || '## Additional Content' || chr(10) || substring(paper, length(joined) + 1, {_SMART} - length(joined) - 100) ELSE joined END AS text FROM j"""
)
def truncate_smart(spark, sf_dir):
    papers = _paper(spark, sf_dir)
    papers = papers.withColumns({f"s_{k}": T.section(F.col("paper"), k) for k in T.SECTION_CHARS})
    text, method = T.truncated(F.col("paper"), _SMART, "smart", {k: F.col(f"s_{k}") for k in T.SECTION_CHARS})
    return papers.select("doc_id", text.alias("text"), method.alias("method"))


@query(f"SELECT * EXCLUDE doc_id FROM {_ROWS}")
def format_alpaca(spark, sf_dir):
    return T.training_rows(_rows(spark, sf_dir), "alpaca")


@query(f"SELECT '<s>[INST] <<SYS>>' || chr(10) || '{T.SYSTEM_TEXT}' || chr(10) || '<</SYS>>' || chr(10) || chr(10) || instruction || chr(10) || chr(10) || input || ' [/INST] ' || output || ' </s>' AS text FROM {_ROWS}")
def format_llama(spark, sf_dir):
    return T.training_rows(_rows(spark, sf_dir), "llama")


@query(f"SELECT '<s>[INST] ' || instruction || chr(10) || chr(10) || input || ' [/INST] ' || output || '</s>' AS text FROM {_ROWS}")
def format_mistral(spark, sf_dir):
    return T.training_rows(_rows(spark, sf_dir), "mistral")


@query(f"SELECT unnest(['system', 'user', 'assistant']) AS role, unnest(['{T.SYSTEM_TEXT}', instruction || chr(10) || chr(10) || input, output]) AS content FROM {_ROWS}")
def format_chatml(spark, sf_dir):
    return T.training_rows(_rows(spark, sf_dir), "chatml").select(F.explode("messages").alias("m")).select("m.role", "m.content")


@query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor((SELECT count(*) FROM documents) * 0.9) THEN 'train' ELSE 'val' END AS split FROM documents")
def split_train_val(spark, sf_dir):
    return O.split_train_val(_t(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("WITH s AS (SELECT CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor((SELECT count(*) FROM documents) * 0.9) THEN 'train' ELSE 'val' END AS split FROM documents) SELECT split, count(*) AS n FROM s GROUP BY 1")
def split_counts(spark, sf_dir):
    return split_train_val(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


def _manifest(spark, sf_dir):
    labels = _t(spark, sf_dir, "labels")
    return _t(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left").select("doc_id", F.col("source").alias("image_path"), F.col("quality").alias("pdf_path"), F.when(F.col("toxic") == 1, "toxic").alias("error"))


_MANIFEST = "(SELECT d.doc_id, d.source AS image_path, quality AS pdf_path, CASE WHEN toxic = 1 THEN 'toxic' END AS error FROM documents d LEFT JOIN labels USING (doc_id))"
_VALID = "image_path IS NOT NULL AND pdf_path IS NOT NULL AND coalesce(error, '') = ''"


@query(f"SELECT doc_id FROM {_MANIFEST} WHERE {_VALID}")
def manifest_valid(spark, sf_dir):
    return O.valid_rows(_manifest(spark, sf_dir), "image_path", "pdf_path").select("doc_id")


@query(f"SELECT doc_id FROM (SELECT * FROM {_MANIFEST} ORDER BY doc_id LIMIT 100 OFFSET 10) WHERE {_VALID}")
def manifest_slice_then_filter(spark, sf_dir):
    return O.valid_rows(O.sliced(_manifest(spark, sf_dir), "doc_id", 10, 100), "image_path", "pdf_path").select("doc_id")


@query(f"SELECT doc_id FROM {_MANIFEST} WHERE {_VALID} ORDER BY doc_id LIMIT 100 OFFSET 10")
def manifest_filter_then_slice(spark, sf_dir):
    return O.sliced(O.valid_rows(_manifest(spark, sf_dir), "image_path", "pdf_path"), "doc_id", 10, 100).select("doc_id")


@query(f"SELECT count(*) FILTER (pdf_path IS NULL) AS no_pdf, count(*) FILTER (error IS NULL) AS no_error FROM {_MANIFEST}")
def null_counts(spark, sf_dir):
    return _manifest(spark, sf_dir).agg(F.count_if(F.col("pdf_path").isNull()).alias("no_pdf"), F.count_if(F.col("error").isNull()).alias("no_error"))


@query(f"SELECT count(*) FILTER (image_path IS NULL OR pdf_path IS NULL) AS skipped, count(*) FILTER (image_path IS NOT NULL AND pdf_path IS NOT NULL) AS kept FROM {_MANIFEST}")
def null_path_skips(spark, sf_dir):
    kept, skipped = O.skip_null_paths(_manifest(spark, sf_dir), "image_path", "pdf_path")
    return skipped.crossJoin(kept.agg(F.count("*").alias("kept")))


@query("SELECT min(tokens) AS low, max(tokens) AS high, (sum(tokens) // count(*))::BIGINT AS mean FROM (SELECT length(text) // 4 AS tokens FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100)")
def train_token_sample(spark, sf_dir):
    """Tokens of the first 100 training rows in their order: a check of their format, no statistic of the corpus."""
    train = O.split_train_val(_t(spark, sf_dir, "documents").select("doc_id", T.estimate_tokens(F.col("text")).alias("tokens")), "doc_id").where("split = 'train'")
    head = train.orderBy(F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))), "doc_id").limit(100)
    return head.agg(F.min("tokens").alias("low"), F.max("tokens").alias("high"), F.expr("sum(tokens) div count(*)").alias("mean"))


@query("SELECT doc_id FROM documents SEMI JOIN labels USING (doc_id)")
def required_files_semi(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels"), "doc_id", "left_semi")


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def skip_existing_anti(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("SELECT d.doc_id::VARCHAR AS doc_id, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def merge_tracking_left(spark, sf_dir):
    return O.merge_status(_t(spark, sf_dir, "documents").select("doc_id", "source"), _t(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source", "quality", "toxic")


@query("SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def tracker_latest(spark, sf_dir):
    return O.latest(_t(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value"), "user_id", ["ts", "event_id"]).select("user_id", "event_type", "value")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def stage_stats(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn, text) AS text FROM conversations WHERE regexp_matches(text, '\\S') GROUP BY 1")
def pages_concat(spark, sf_dir):
    return O.ordered_text(_t(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("SELECT page_id, regexp_extract(url, '/([^/?]*)(?:\\?|$)', 1) AS stem FROM pages")
def filename_title(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"/([^/?]*)(?:\?|$)", 1).alias("stem"))


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels WHERE quality = 1")
def intersect_ready(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id").intersect(_t(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels WHERE quality = 1")
def set_difference(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id").subtract(_t(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))


@query("SELECT m AS model, count(w)::BIGINT AS wins FROM (VALUES ('base'), ('tuned'), ('large')) t(m) LEFT JOIN (SELECT CASE item_id % 2 WHEN 0 THEN 'base' ELSE 'tuned' END AS w FROM benchmark) ON m = w GROUP BY 1")
def judge_wins_zero_fill(spark, sf_dir):
    judged = _t(spark, sf_dir, "benchmark").select(F.when(F.col("item_id") % 2 == 0, "base").otherwise("tuned").alias("winner"))
    return O.wins(judged, ["base", "tuned", "large"], "winner")
