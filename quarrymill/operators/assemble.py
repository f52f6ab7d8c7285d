"""Training examples from a manifest, parsed papers, poster results, layouts and matches; export rows; run figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import scan as S

# Errors of rows that cannot be assembled, and a call's cost.
NOT_PROCESSED, NO_PAPER, MISSING = "Not processed", "Paper parsing failed", "Missing required components"
CALL_COST = 0.003


def nonempty(column: Column) -> Column:
    """The column, null where it is empty text or an empty JSON object."""
    return F.when(~F.trim(column).isin("", "{}"), column)


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key in order, by a partial aggregation."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def assembled(manifest: DataFrame, papers: DataFrame, posters: DataFrame, key: str = "paper_id", order: str = "pos") -> DataFrame:
    """manifest left-joined with papers(key, order, paper_markdown) and posters(key, order, poster_markdown, layout, error): + success, error.

    Of repeated keys in papers and posters the last counts. A row fails if its paper or poster is missing or empty: with the
    poster's error, else that of the paper; a poster that is not there at all was not processed.
    """
    p = last_of(papers, key, order).select(F.col(key).alias("__p"), nonempty(F.col("paper_markdown")).alias("paper_markdown"))
    q = last_of(posters, key, order).select(F.col(key).alias("__q"), nonempty(F.col("poster_markdown")).alias("poster_markdown"), "layout", F.col("error").alias("poster_error"))
    joined = manifest.join(p, F.col(key) == F.col("__p"), "left").join(q, F.col(key) == F.col("__q"), "left")
    error = F.when(F.col("__q").isNull(), NOT_PROCESSED).otherwise(F.coalesce(F.nullif("poster_error", F.lit("")), F.lit(NO_PAPER)))
    whole = F.col("paper_markdown").isNotNull() & F.col("poster_markdown").isNotNull()
    return joined.select(*manifest.columns, "paper_markdown", "poster_markdown", "layout", whole.alias("success"), F.when(~whole, error).alias("error"))


def combined(manifest: DataFrame, posters: DataFrame, papers: DataFrame, layouts: DataFrame, matches: DataFrame, key: str = "paper_id") -> DataFrame:
    """manifest with poster_markdown, paper_markdown, layout, and figure_matches ([] where there are none); error for rows that lack one of the first three."""
    parts = [(posters, "poster_markdown"), (papers, "paper_markdown"), (layouts, "layout"), (matches, "figure_matches")]
    out = manifest
    for k, (rows, column) in enumerate(parts):
        out = out.join(rows.select(F.col(key).alias(f"__{k}"), column), F.col(key) == F.col(f"__{k}"), "left").drop(f"__{k}")
    whole = F.lit(True)
    for _, column in parts[:3]:
        whole &= nonempty(F.col(column)).isNotNull()
    none = F.array().cast(out.schema["figure_matches"].dataType)
    return out.withColumns({"figure_matches": F.coalesce("figure_matches", none), "error": F.when(~whole, MISSING)})


def metadata(rows: DataFrame, policy: str = "original") -> DataFrame:
    """rows(title, abstract, conference, year, topics as text) with one of three rules of nulls: simple, original, staged.

    Texts that are null are empty. simple: topics stay as they are, a year that is no number is an error. original: topics are
    split, other years are 0. staged: as original, without topics.
    """
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in ("title", "abstract", "conference")}
    if policy == "simple":
        year = F.col("year").try_cast("int")
        return rows.withColumns(texts | {"error": F.when(year.isNull(), F.lit("year is no number")), "year": year})
    out = rows.withColumns(texts | {"year": S.year(F.col("year"))})
    return out.drop("topics") if policy == "staged" else out.withColumn("topics", S.topics(F.col("topics")))


def export_rows(examples: DataFrame, figures: bool = False) -> DataFrame:
    """instruction, input, output of examples(paper_title, paper_abstract, paper_markdown, layout, poster_markdown): output is JSON.

    With figures, figure_matches [{paper_figure, poster_figure}] become its figure_mapping.
    """
    content = F.coalesce("poster_markdown", F.lit("")).alias("content")
    layout = F.coalesce(F.try_parse_json("layout"), F.parse_json(F.lit("{}"))).alias("layout")
    more = []
    if figures:
        more = [F.transform("figure_matches", lambda m: F.struct(m["paper_figure"].alias("paper_figure"), m["poster_figure"].alias("poster_position"))).alias("figure_mapping")]
    return examples.select(S.instruction(F.col("paper_title"), F.col("paper_abstract")).alias("instruction"), F.coalesce("paper_markdown", F.lit("")).alias("input"), F.to_json(F.struct(layout, content, *more)).alias("output"))


def run_stats(results: DataFrame) -> DataFrame:
    """One row of results(success): total, completed, failed, skipped (never counted), cost of the completed."""
    ok = F.count_if(F.coalesce("success", F.lit(False)))
    return results.agg(F.count("*").alias("total"), ok.alias("completed"), (F.count("*") - ok).alias("failed"), F.lit(0).cast("long").alias("skipped"), F.round(ok * CALL_COST, 6).alias("cost"))


def cost_estimate(rows: DataFrame, n: str, start: str, limit: str) -> DataFrame:
    """+ items, cost: a limit of 0 or null is none."""
    asked = F.coalesce(F.nullif(F.col(limit), F.lit(0)), F.col(n))
    items = F.greatest(F.lit(0), F.least(asked, F.col(n) - F.col(start)))
    return rows.select(n, start, limit, items.alias("items"), F.round(items * CALL_COST, 6).alias("cost"))


def durations(log: DataFrame, key: str, ts: str, completed: Column) -> DataFrame:
    """key, completed, minutes from first to last, completed a minute (null where no time passed)."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    seconds = (F.max(micros(F.col(ts))) - F.min(micros(F.col(ts)))) / 1e6
    out = log.groupBy(key).agg(F.count_if(completed).alias("completed"), seconds.alias("__s"))
    rate = F.when(F.col("__s") > 0, F.round(F.col("completed") / (F.col("__s") / 60), 6))
    return out.select(key, "completed", F.round(F.col("__s") / 60, 6).alias("minutes"), rate.alias("per_minute"))
