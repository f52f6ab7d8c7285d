"""The library's scalar functions under SQL names: temporary SQL functions, which the optimizer inlines like the column forms."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quarrymill.functions import scan as S
from quarrymill.functions import text as T
from quarrymill.operators import pages


def _said(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


#: name -> (parameters, type, body).
FUNCTIONS = {
    "estimate_tokens": ("t STRING", "BIGINT", f"CAST(floor(length(t) / {T.CHARS_PER_TOKEN}) AS BIGINT)"),
    "max_chars": ("max_tokens INT", "INT", f"CASE WHEN max_tokens <= {T.PROMPT_TOKENS} THEN raise_error('max_tokens must be above {T.PROMPT_TOKENS}') ELSE (max_tokens - {T.PROMPT_TOKENS}) * {T.CHARS_PER_TOKEN} END"),
    "truncate_head": ("t STRING, most INT", "STRING", f"CASE WHEN length(t) <= most THEN t ELSE concat(left(t, most), {_said(T.CUT_MARK)}) END"),
    "capped_content": ("t STRING", "STRING", f"CASE WHEN length(t) > {S.EVAL_CHARS} THEN concat(left(t, {S.EVAL_CHARS}), {_said(S.EVAL_MARK)}) ELSE t END"),
    "hash_score": ("a BIGINT, b BIGINT", "DOUBLE", "greatest(0.0D, 1.0D - bit_count(a ^ b) / 64.0D)"),
    "topics_of": ("t STRING", "ARRAY<STRING>", "coalesce(split(t, ',', -1), CAST(array() AS ARRAY<STRING>))"),
    "year_of": ("t STRING", "INT", "coalesce(try_cast(t AS INT), 0)"),
    "media_type_of": ("path STRING", "STRING", "CASE lower(regexp_extract(path, '[^/]\\\\.([^./]+)$', 1)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.MEDIA_TYPES.items()) + " ELSE 'image/png' END"),
    "instruction_of": ("title STRING, abstract STRING", "STRING", f"concat({_said(S.INSTRUCTION + chr(10) * 2 + 'Title: ')}, coalesce(title, ''), {_said(chr(10) * 2 + 'Abstract: ')}, coalesce(abstract, ''))"),
}


def register(spark: SparkSession) -> None:
    """All of FUNCTIONS, and the table functions of pages, for this session's SQL text."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    pages.register(spark)
