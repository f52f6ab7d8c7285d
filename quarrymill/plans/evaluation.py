"""Queries over prepared training sets and over the comparison of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.functions import scan as S
from quarrymill.functions import text as T
from quarrymill.operators import evaluate as E
from quarrymill.operators import prepare as P
from quarrymill.plans.documents import _cap_sql
from quarrymill.plans.registry import query, table

_MOST = T.max_chars(3500)


@query(f"SELECT count(*) FILTER (length(text) >= 100 AND length(cut) < length(text)) AS truncated, count(*) FILTER (length(text) >= 100 AND length(cut) >= length(text)) AS kept_full, count(*) FILTER (length(text) < 100) AS partial FROM (SELECT text, CASE WHEN length(text) <= {_MOST} THEN text ELSE left(text, {_MOST}) || chr(10) || chr(10) || '[Content truncated...]' END AS cut FROM documents)")
def truncation_stats(spark, sf_dir):
    cut, _ = T.truncated(F.col("text"), _MOST, "head")
    return P.truncation_stats(table(spark, sf_dir, "documents"), F.col("text"), cut)


def _rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Describe "), "source").alias("instruction"), F.col("text").alias("input"), F.concat(F.lit("lang="), "lang").alias("output"))


@query(f"SELECT doc_id, 'Describe ' || source AS instruction, CASE WHEN length(text) <= {_MOST} THEN text ELSE left(text, {_MOST}) || chr(10) || chr(10) || '[Content truncated...]' END AS input, 'lang=' || lang AS output, CASE WHEN length(text) >= 100 THEN 'full' ELSE 'partial' END AS type, CASE WHEN length(text) >= 100 THEN length(text)::INT END AS original_len, CASE WHEN length(text) >= 100 THEN CASE WHEN length(text) <= {_MOST} THEN 'none_needed' ELSE 'head' END END AS method FROM documents")
def prepare_rows(spark, sf_dir):
    out = P.prepared(_rows(spark, sf_dir), 3500, "head")
    return out.select("doc_id", "instruction", "input", "output", F.col("_meta.type").alias("type"), F.col("_meta.original_len").alias("original_len"), F.col("_meta.extraction_method").alias("method"))


@query("SELECT doc_id, length(text) AS n, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor((SELECT count(*) FROM documents) * 0.9) THEN 0 ELSE 1 END AS set FROM documents")
def combined_union(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("n"))
    return P.split_sets(rows, "doc_id")[2]


_SAMPLES = f"(SELECT item_id, {_cap_sql('text', S.EVAL_CHARS, S.EVAL_MARK)} AS content FROM benchmark)"


def _outputs(spark, sf_dir):
    tasks = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("sample_id"), S.capped(F.col("text"), S.EVAL_CHARS, S.EVAL_MARK).alias("content"))
    small = F.when(F.col("sample_id") % 3 != 0, F.concat(F.lit("small: "), F.left("content", F.lit(20))))
    large = F.concat(F.lit("large: "), "content")
    return E.cross_models(tasks, {"tuned": small, "large": large, "gone": None})


@query(f"SELECT item_id AS sample_id, m AS model, CASE m WHEN 'gone' THEN '{E.NO_MODEL}' WHEN 'large' THEN 'large: ' || content ELSE CASE WHEN item_id % 3 = 0 THEN '[Error: no output]' ELSE 'small: ' || left(content, 20) END END AS output FROM {_SAMPLES}, (VALUES ('tuned'), ('large'), ('gone')) t(m)")
def cross_models(spark, sf_dir):
    return _outputs(spark, sf_dir).select("sample_id", "model", "output")


@query(f"SELECT item_id AS sample_id, length('{E.NO_MODEL}')::INT AS gone, (7 + length(content))::INT AS large, CASE WHEN item_id % 3 = 0 THEN 18 ELSE 7 + length(left(content, 20)) END::INT AS tuned FROM {_SAMPLES}")
def output_length_map(spark, sf_dir):
    out = E.output_lengths(_outputs(spark, sf_dir))
    return out.select("sample_id", *[F.element_at("lengths", m).alias(m) for m in ("gone", "large", "tuned")])


@query("SELECT item_id AS sample_id, CASE WHEN item_id % 3 = 0 THEN '[Error: no output]' ELSE 'small: ' || left(text, 20) END AS output_tuned, 'N/A' AS output_missing FROM benchmark WHERE item_id % 5 <> 0")
def eval_gate(spark, sf_dir):
    """Samples with all outputs; for every fifth one a model is not available."""
    outputs = _outputs(spark, sf_dir).where("model <> 'gone' OR sample_id % 5 = 0")
    return E.judgeable(outputs.select("sample_id", "model", "output"), ["tuned", "missing"])


@query("SELECT 'real_' || (row_number() OVER (ORDER BY item_id) - 1) AS id, left(text, 50) AS title, length(text) AS n FROM (SELECT * FROM benchmark ORDER BY item_id LIMIT 25)")
def eval_samples(spark, sf_dir):
    return E.named_samples(table(spark, sf_dir, "benchmark"), "item_id", "text", 25).select("id", "title", F.length("content").cast("long").alias("n"))


@query("SELECT doc_id, to_json({'id': doc_id, 'source': source, 'lang': lang, 'n': NULL})::VARCHAR AS record FROM documents")
def record_json(spark, sf_dir):
    """A record as JSON in a fixed order of keys, nulls kept."""
    row = F.struct(F.col("doc_id").alias("id"), "source", "lang", F.lit(None).cast("string").alias("n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.to_json(row, {"ignoreNullFields": "false"}).alias("record"))
