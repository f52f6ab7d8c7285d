"""Figures and page elements: numbering, reading order, scores of pairs, reports of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrymill.functions.jsonx import stripped

# Weights of a pair's scores, the ratio of two distances, sizes below which a picture is dropped.
PHASH_WEIGHT, SSIM_WEIGHT, FEATURE_WEIGHT = 0.3, 0.3, 0.4
NEAREST_RATIO = 0.7
MIN_FIGURE, MIN_CROP = 100, 3
WHOLE_PAGE = "distorted_page"


def numbered_figures(images: DataFrame, doc: str, page: str, index: str) -> DataFrame:
    """Images of at least MIN_FIGURE by MIN_FIGURE, numbered in their document after that filter: + number, figure_id."""
    kept = images.where((F.col("width") >= MIN_FIGURE) & (F.col("height") >= MIN_FIGURE))
    number = F.row_number().over(W.partitionBy(doc).orderBy(page, index))
    return kept.withColumn("number", number).withColumn("figure_id", F.concat(F.col(doc).cast("string"), F.lit("_fig_"), "number"))


def tagged_figures(figures: DataFrame, doc: str, source: str) -> DataFrame:
    """One row per document: its figures in order, each with its source."""
    own = F.array_sort(F.collect_list(F.struct("number", "figure_id")))
    return figures.groupBy(doc).agg(F.transform(own, lambda f: f.withField("source_doc", F.lit(source))).alias("figures"))


def reading_order(elements: DataFrame, page: str, order: str) -> DataFrame:
    """elements(label, width, height, text, failed) of pages in their layout's order: + reading_order, without those that yield nothing.

    The counter goes on for crops that are too small, but not for elements that failed; both are left out.
    """
    ok = ~F.coalesce(F.col("failed"), F.lit(False))
    place = F.count_if(ok).over(W.partitionBy(page).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    numbered = elements.withColumn("reading_order", F.coalesce(place, F.lit(0)))
    return numbered.where(ok & (F.col("width") > MIN_CROP) & (F.col("height") > MIN_CROP))


def merged_page(batches: list[DataFrame], page: str) -> DataFrame:
    """One row per page: what batches(page, reading_order, text) hold, in reading order (none is 0), stripped and joined by blank lines."""
    rows = batches[0]
    for b in batches[1:]:
        rows = rows.unionByName(b)
    text = stripped(F.col("text"))
    parts = F.array_sort(F.collect_list(F.struct(F.coalesce("reading_order", F.lit(0)).alias("o"), text.alias("text"))))
    return rows.groupBy(page).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n").alias("text"))


def sane_layout(layout: Column, count: Column, overlap: Column, most: float = 0.5) -> Column:
    """The layout text, or the mark of one whole page where it is empty, not in brackets, or its boxes overlap too much."""
    bad = layout.isNull() | (F.coalesce(count, F.lit(0)) == 0) | ~F.startswith(layout, F.lit("[")) | ~F.endswith(layout, F.lit("]"))
    return F.when(bad | ((count > 1) & (overlap > most)), WHOLE_PAGE).otherwise(layout)


def pages_text(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """One row per document: its pages that are not blank, each under a heading with its number (from 1), joined by blank lines."""
    kept = pages.where(F.regexp_like(F.col(text), F.lit(r"\S")))
    parts = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t"))))
    said = F.transform(parts, lambda x: F.concat(F.lit("## Page "), (x["p"] + 1).cast("string"), F.lit("\n\n"), x["t"]))
    return kept.groupBy(doc).agg(F.array_join(said, "\n\n").alias("markdown"))


def hash_distance(left: Column, right: Column) -> Column:
    """Differing bits of two hashes given as arrays of longs."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))


def combined_score(phash: Column, ssim: Column, feature: Column) -> Column:
    return F.lit(PHASH_WEIGHT) * phash + F.lit(SSIM_WEIGHT) * ssim + F.lit(FEATURE_WEIGHT) * feature


def pair_scores(phash: Column, ssim: Column, feature: Column) -> Column:
    """All of a pair's scores: combined, phash, ssim, feature."""
    return F.struct(combined_score(phash, ssim, feature).alias("combined"), phash.alias("phash"), ssim.alias("ssim"), feature.alias("feature"))


def page_numbers(elements: DataFrame, index: str = "page") -> DataFrame:
    """+ page_number: pages count from 1."""
    return elements.withColumn("page_number", F.col(index) + 1)


def sign_words(vector: Column, word: int = 32) -> Column:
    """A vector's signs as an array of longs of `word` bits each."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(vector)), F.lit(word))
    return F.transform(starts, lambda s: F.aggregate(F.slice(vector, s, word), F.lit(0).cast("long"), lambda a, x: a * 2 + F.when(x > 0, 1).otherwise(0)))


def nearest_ratio(left: DataFrame, right: DataFrame, key: str, ratio: float = NEAREST_RATIO) -> DataFrame:
    """(key, good, ratio): descriptors of left (id, v) whose nearest of right in the key is nearer than `ratio` of the second nearest.

    The ratio is good / the smaller number of descriptors; keys with fewer than two on either side have 0. Of a descriptor's
    distances only the two least are kept, before the shuffle and after it (the rank's limit goes below both).
    """
    sizes = left.groupBy(key).agg(F.count("*").alias("nl")).join(right.groupBy(key).agg(F.count("*").alias("nr")), key)
    pairs = left.select(key, F.col("id").alias("l_id"), F.col("v").alias("l_v")).join(right.select(key, F.col("v").alias("r_v")), key)
    squared = F.aggregate(F.zip_with("l_v", "r_v", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    place = F.row_number().over(W.partitionBy(key, "l_id").orderBy("d"))
    two = pairs.select(key, "l_id", squared.alias("d")).withColumn("place", place).where("place <= 2")
    near = two.groupBy(key, "l_id").agg(F.min("d").alias("d1"), F.max(F.when(F.col("place") == 2, F.col("d"))).alias("d2"))
    good = near.groupBy(key).agg(F.count_if(F.col("d1") < ratio * ratio * F.col("d2")).alias("good"))
    enough = (F.col("nl") >= 2) & (F.col("nr") >= 2)
    out = sizes.join(good, key, "left")
    return out.select(key, F.when(enough, F.coalesce("good", F.lit(0))).otherwise(0).alias("good"), F.when(enough, F.coalesce("good", F.lit(0)) / F.least("nl", "nr")).otherwise(0.0).alias("ratio"))


def match_report(matches: DataFrame, candidates: DataFrame, figures: DataFrame, key: str) -> DataFrame:
    """One row per key of figures(key, side): counts of figures and candidates, and its matches in rank order, with their number in their verdict."""
    sides = figures.groupBy(key).agg(F.count_if(F.col("side") == "poster").alias("poster_figures_count"), F.count_if(F.col("side") == "paper").alias("paper_figures_count"))
    tried = candidates.groupBy(key).agg(F.count("*").alias("candidates_found"))
    number = F.row_number().over(W.partitionBy(key, "verdict").orderBy("rank"))
    own = F.struct("rank", "l_id", "r_id", "verdict", F.col("number"))
    listed = matches.withColumn("number", number).groupBy(key).agg(F.array_sort(F.collect_list(own)).alias("matches"))
    out = sides.join(tried, key, "left").join(listed, key, "left")
    none = F.array().cast(out.schema["matches"].dataType)
    return out.withColumns({"candidates_found": F.coalesce("candidates_found", F.lit(0)), "matches": F.coalesce("matches", none)})


def projection_buckets(vectors: DataFrame, dim: int, tables: int = 12, bits: int = 8, seed: int = 42) -> DataFrame:
    """vectors(id, v) with table, bucket for each of `tables` random sign projections of `bits` bits.

    The planes follow from the seed alone and are literals of the plan: tables * bits * dim numbers.
    """
    import numpy as np

    planes = np.random.default_rng(seed).standard_normal((tables, bits, dim))
    dot = lambda plane: F.aggregate(F.zip_with("v", F.array(*(F.lit(float(x)) for x in plane)), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    keys = []
    for t in range(tables):
        key = F.lit(0)
        for plane in planes[t]:
            key = key * 2 + F.when(dot(plane) > 0, 1).otherwise(0)
        keys.append(F.struct(F.lit(t).alias("table"), key.cast("int").alias("bucket")))
    return vectors.select(*vectors.columns, F.inline(F.array(*keys)))


def nearest_approximate(left: DataFrame, right: DataFrame, dim: int, k: int = 2, tables: int = 12, bits: int = 8, seed: int = 42, salts: int = 8) -> DataFrame:
    """(l_id, r_id, d, rank): of each left(id, v) the k nearest among right's that share a bucket with it; squared distances are exact.

    For sets whose pairs are too many for nearest_ratio. A bucket may be hot: right's rows are dealt over `salts` parts of it,
    and left's rows go to each. The exact way is a join without buckets; tests measure the recall against it.
    """
    a = projection_buckets(left.select(F.col("id").alias("l_id"), "v"), dim, tables, bits, seed).withColumnRenamed("v", "l_v").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    b = projection_buckets(right.select(F.col("id").alias("r_id"), "v"), dim, tables, bits, seed).withColumnRenamed("v", "r_v").withColumn("salt", F.pmod(F.xxhash64("r_id"), F.lit(salts)).cast("int"))
    squared = F.aggregate(F.zip_with("l_v", "r_v", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    met = a.join(b, ["table", "bucket", "salt"]).select("l_id", "r_id", squared.alias("d"))
    # A pair that meets in several tables counts once; of a part's rows only the nearest go on.
    near = met.groupBy("l_id", "r_id").agg(F.min("d").alias("d"))
    return near.withColumn("rank", F.row_number().over(W.partitionBy("l_id").orderBy("d", "r_id"))).where(F.col("rank") <= k)
