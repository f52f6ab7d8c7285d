"""Queries over pages and their layouts, and over artifacts, trackers and functions that SQL text calls."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from quarrymill import sql as Q
from quarrymill.operators import assemble as A
from quarrymill.operators import figures as G
from quarrymill.operators import pages as P
from quarrymill.operators.track import STAGES
from quarrymill.operators.trackstore import TrackerStore
from quarrymill.plans import assembly, tracking
from quarrymill.plans.registry import query, table
from quarrymill.sources import shared
from quarrymill.sources.artifacts import ArtifactStore

SIZE = 1000.0
_LABELS = ("text", "tab", "equ", "fig", "code")

#: 1 to 6 boxes of a page from its id and lengths; every eleventh page's layout lacks its last bracket.
_BOXES = """(SELECT page_id, html, e, (page_id * 37 + e * 211) % 700 AS x1, (page_id * 53 + e * 157) % 800 AS y1, x1 + 2 + (length(html) + e * 31) % 250 AS x2, y1 + 2 + (page_id + e * 71) % 160 AS y2,
  list_extract(['text', 'tab', 'equ', 'fig', 'code'], ((page_id + e) % 5 + 1)::INT) AS label FROM pages, (SELECT unnest(range(6)) AS e) WHERE e <= length(url) % 6)"""
_HITS = f"""(SELECT page_id, count(DISTINCT p) AS overlapping FROM (SELECT a.page_id, unnest([a.e, b.e]) AS p, least(a.x2, b.x2) - greatest(a.x1, b.x1) AS w, least(a.y2, b.y2) - greatest(a.y1, b.y1) AS h,
  (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS both_ FROM {_BOXES} a JOIN {_BOXES} b ON a.page_id = b.page_id AND a.e < b.e) WHERE w > 0 AND h > 0 AND w * h > 0.1::DOUBLE * (both_ - w * h) GROUP BY 1)"""
_OVERLAPS = f"(SELECT page_id, count(*) AS boxes, coalesce(any_value(overlapping), 0) AS overlapping FROM {_BOXES} LEFT JOIN {_HITS} USING (page_id) GROUP BY 1)"
_LAID = f"""(WITH good AS (SELECT b.*, e AS reading_order FROM {_BOXES} b JOIN {_OVERLAPS} o USING (page_id) WHERE page_id % 11 <> 0 AND overlapping::DOUBLE / boxes <= 0.25)
SELECT page_id, html, reading_order::INT AS reading_order, label, x1::DOUBLE AS x1, y1::DOUBLE AS y1, x2::DOUBLE AS x2, y2::DOUBLE AS y2 FROM good WHERE x2 - x1 > 3 AND y2 - y1 > 3
UNION ALL SELECT page_id, html, 0, 'distorted_page', 0, 0, 1000, 1000 FROM pages WHERE page_id NOT IN (SELECT page_id FROM good))"""


def _pages(spark, sf_dir):
    n, e = F.col("page_id"), F.col("e")
    rows = table(spark, sf_dir, "pages").select("page_id", F.length("html").alias("size"), F.explode(F.sequence(F.lit(0), F.length("url") % 6)).alias("e"))
    x1, y1 = (n * 37 + e * 211) % 700, (n * 53 + e * 157) % 800
    x2, y2 = x1 + 2 + (F.col("size") + e * 31) % 250, y1 + 2 + (n + e * 71) % 160
    label = F.element_at(F.array(*map(F.lit, _LABELS)), ((n + e) % 5 + 1).cast("int"))
    said = F.concat(F.lit("["), F.concat_ws(",", x1, y1, x2, y2), F.lit("]["), label, F.when((n % 11 == 0) & (e == F.lit(0)), "").otherwise("]"))
    # In reverse order the bracket that the first element lacks is the text's last.
    parts = F.transform(F.array_sort(F.collect_list(F.struct("e", said.alias("s")))), lambda p: p["s"])
    parts = F.when(n % 11 == 0, F.reverse(parts)).otherwise(parts)
    return rows.groupBy("page_id").agg(F.array_join(parts, "[PAIR_SEP]").alias("layout"))


@query(f"SELECT page_id, boxes, overlapping, round(overlapping::DOUBLE / boxes, 9) AS share FROM {_OVERLAPS}")
def page_overlap(spark, sf_dir):
    """How many of a page's boxes overlap another."""
    out = P.overlaps(P.elements(_pages(spark, sf_dir)), "page_id", SIZE, SIZE)
    return out.withColumn("share", F.round("share", 9))


@query(f"SELECT page_id, reading_order, label, x1, y1, x2, y2 FROM {_LAID}")
def page_elements(spark, sf_dir):
    """Elements of pages whose layout holds, the whole page of others."""
    return P.laid_out(_pages(spark, sf_dir), "page_id", SIZE, SIZE)


@query(f"SELECT page_id, string_agg(label || ': ' || trim(substring(html, reading_order * 40 + 1, 40), ' '), chr(10) || chr(10) ORDER BY reading_order) AS text FROM {_LAID} WHERE label <> 'fig' GROUP BY 1")
def page_parse(spark, sf_dir):
    """From layout to the page's text: elements, what is read of each kind as a batch of its own, merged in reading order."""
    found = P.laid_out(_pages(spark, sf_dir), "page_id", SIZE, SIZE)
    html = table(spark, sf_dir, "pages").select(F.col("page_id").alias("__page"), "html")
    crop = F.trim(F.substring("html", F.col("reading_order") * 40 + 1, F.lit(40)))
    read = found.where("label <> 'fig'").join(html, F.col("page_id") == F.col("__page")).select("page_id", "reading_order", "label", F.concat("label", F.lit(": "), crop).alias("text"))
    kinds = ("tab", "equ", "code")
    batches = [read.where(F.col("label") == k) for k in kinds] + [read.where(~F.col("label").isin(*kinds))]
    return G.merged_page([b.select("page_id", "reading_order", "text") for b in batches], "page_id")


@query("SELECT doc_id, i::INT AS page, substring(text, i * 500 + 1, 500) AS text FROM documents, (SELECT unnest(range(0, (SELECT max(length(text)) // 500 + 1 FROM documents))) AS i) WHERE i * 500 < length(text)")
def document_pages(spark, sf_dir):
    """A document's pages by a table function with LATERAL."""
    P.register(spark)
    return spark.sql("SELECT d.doc_id, s.page, s.text FROM {docs} AS d, LATERAL page_slices(d.text, 500) AS s", docs=table(spark, sf_dir, "documents"))


def _root(spark, sf_dir, name: str) -> str:
    """A folder of one name for one input: a later run replaces what an earlier one wrote."""
    return f"{shared.shared_root(spark)}/{name}-{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"


@query(f"SELECT paper_id::VARCHAR AS paper_id, paper_title, paper_markdown, poster_markdown, success, error FROM {assembly._ASSEMBLED}")
def assemble_stored(spark, sf_dir):
    """Assembly from artifacts that are stored by key: of papers and posters nothing is shuffled to join them."""
    store = ArtifactStore(spark, _root(spark, sf_dir, "artifacts"), buckets=16)
    store.write("papers", assembly._papers(spark, sf_dir))
    store.write("posters", assembly._posters(spark, sf_dir))
    manifest = assembly._manifest(spark, sf_dir).withColumn("paper_id", F.col("paper_id").cast("string"))
    out = A.assembled(manifest, store.read("papers"), store.read("posters"))
    return out.select("paper_id", "paper_title", "paper_markdown", "poster_markdown", "success", "error")


@query(f"SELECT paper_id::VARCHAR AS paper_id, {', '.join(STAGES)}, error_message, poster_figure_count, paper_figure_count, epoch_us(started_at) AS started_at, epoch_us(last_updated) AS last_updated FROM {tracking._STATUS}")
def tracker_incremental(spark, sf_dir):
    """The tracker after five batches of updates, in an order that is not that of time; a snapshot and deltas."""
    store = TrackerStore(spark, _root(spark, sf_dir, "tracker"), fields=("poster_figure_count", "paper_figure_count"), order=("ts", "event_id"), buckets=16, most_deltas=3)
    store.clear()
    log = tracking._log(spark, sf_dir)
    for number in range(5):
        store.add(log.where(F.col("event_id") % 5 == 4 - number), number)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias(c)
    return store.status().select("paper_id", *STAGES, "error_message", "poster_figure_count", "paper_figure_count", micros("started_at"), micros("last_updated"))


@query(
    """SELECT doc_id, length(text) // 4 AS tokens, CASE WHEN length(text) <= 6000 THEN text ELSE left(text, 6000) || chr(10) || chr(10) || '[Content truncated...]' END AS head,
  CASE WHEN length(text) > 4000 THEN left(text, 4000) || chr(10) || chr(10) || '[... content truncated for length ...]' ELSE text END AS capped, len(string_split(source || ',' || lang, ','))::INT AS topics, coalesce(try_cast(lang AS INT), 0) AS year, greatest(0, 1 - bit_count(xor(doc_id, doc_id * 7)) / 64.0)::DOUBLE AS score FROM documents"""
)
def sql_functions(spark, sf_dir):
    """Functions that SQL text calls."""
    Q.register(spark)
    return spark.sql(
        """SELECT doc_id, estimate_tokens(text) AS tokens, truncate_head(text, 6000) AS head, capped_content(text) AS capped, size(topics_of(concat(source, ',', lang))) AS topics, year_of(lang) AS year, hash_score(doc_id, doc_id * 7) AS score FROM {docs}""",
        docs=table(spark, sf_dir, "documents"),
    )


_FORMATS = ("jsonl", "parquet", "csv")


@query(f"SELECT fmt, doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents, (VALUES {', '.join(f'({chr(39)}{f}{chr(39)})' for f in _FORMATS)}) t(fmt)")
def exported_rows(spark, sf_dir):
    """Rows of each export format, written and read back over whole texts."""
    from quarrymill.sources import files

    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    schema = "doc_id long, lang string, n_chars long, text string"
    out = []
    for fmt in _FORMATS:
        path = f"{_root(spark, sf_dir, 'exports')}/{fmt}"
        shared.delete(spark, path)
        files.export(rows, path, fmt)
        back = {"jsonl": lambda p: files.read_jsonl(spark, p, schema), "parquet": spark.read.parquet, "csv": lambda p: spark.read.schema(schema).csv(p, header=True, multiLine=True, escape='"')}[fmt](path)
        out.append(back.select(F.lit(fmt).alias("fmt"), "doc_id", "lang", F.col("n_chars").cast("long").alias("n_chars"), F.md5("text").alias("text_md5")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT set, count(*) AS n, bit_xor(doc_id) AS ids FROM (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor((SELECT count(*) FROM documents) * 0.9) THEN 0 ELSE 1 END AS set FROM documents) GROUP BY 1")
def ordered_sets(spark, sf_dir):
    """Training and validation rows as ordered files, read back by the manifest."""
    from quarrymill.operators import prepare
    from quarrymill.sources import files

    rows = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"))
    path = f"{_root(spark, sf_dir, 'ordered')}/combined"
    manifest = files.write_ordered(prepare.split_sets(rows, "doc_id")[2], path, "set")
    found = spark.read.schema("doc_id long, n int, set int").json([f"{path}/{m['file']}" for m in manifest])
    return found.groupBy("set").agg(F.count("*").alias("n"), F.bit_xor("doc_id").alias("ids"))
