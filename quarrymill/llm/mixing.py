"""Mixing sources to target weights by capped water-filling.

Sources get shares of the whole size by weight; a source stops at `max_epochs` times its own size and the
excess goes to the others by weight until none is above its cap. A source's rate is target / size: every
document is taken floor(rate) times, and the fraction goes to documents in seeded hash order until the
source's target is reached, so that a source is off by less than one document.

The document at which a source's fraction ends is found by descending the hash's bits, 7 at a time: a histogram of
14 bits by source, then one of the next 14 bits of the rows in the bucket where the fraction ends; what is left is a
2^-28th of a source. No window has more rows than that or 128 a source, no source is sorted or gathered as a
whole, and texts are never shuffled. Only the water-filling itself is a window over all sources, a row each.

Defined results: null text has size 0; null source is a source of its own, last in order; a source
without words has target 0 and takes nothing; rows that repeat a doc_id share one decision; an empty
table gives an empty result; further columns, of any name, are kept by `mixed` and ignored by `mix_plan`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrymill.llm.common import looked_up, n_words, written

#: Bits of a source's hash order in one histogram, and in one step of the descent.
BITS, STEP = 14, 7
SEED = 2024


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """(source, size, weight) -> + target.

    With the sources ordered by cap / weight, the first k are clamped, where k is the least for which the
    level (total - clamped caps) / (weights left) is no higher than the next source's cap / weight. This is
    where repeated clamping and resharing ends.
    """
    caps = sources.withColumn("cap", F.col("size") * F.lit(max_epochs).cast("long"))
    order = [(F.col("cap").cast("double") / F.col("weight")).asc(), F.col("pos").asc()]
    before = W.partitionBy().orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    ranked = caps.withColumns(
        {
            "level": (F.sum("size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
            / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double"),
            "ratio": F.col("cap").cast("double") / F.col("weight"),
        }
    )
    final = ranked.withColumn("fits", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "pos", "level"))).over(whole))
    free = F.struct("ratio", "pos") >= F.struct("fits.ratio", "fits.pos")
    target = F.when(free, F.col("fits.level") * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return final.withColumn("target", F.coalesce(target, F.lit(0.0))).select("source", "size", "weight", "target")


def _weighted(stats: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Weights repeat over the sources in code point order (UTF-8 binary order), null last."""
    pos = F.row_number().over(W.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1
    arr = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    return stats.withColumn("pos", pos).withColumn("weight", F.element_at(arr, (F.col("pos") % len(weights) + 1).cast("int")))


def mix_plan(docs: DataFrame, weights=(1, 2, 3), max_epochs: int = 3, seed: int = SEED, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, repeats, taken."""
    sized = _sized(docs, seed, id_col, text_col, source_col)
    out = looked_up(sized, source_cuts(sized, weights, max_epochs), {"source": "c_source"}, "u").withColumn("repeats", _repeats(F.col("u")))
    return out.select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def mixed(docs: DataFrame, weights=(1, 2, 3), max_epochs: int = 3, seed: int = SEED, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """docs, each row as often as the mix takes it (not at all for 0); its columns are unchanged."""
    cuts = source_cuts(_sized(docs, seed, id_col, text_col, source_col), weights, max_epochs)
    # Columns go by number, so that no name of theirs can clash.
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, own_source = (f"c{docs.columns.index(c)}" for c in (id_col, source_col))
    placed = rows.withColumns({"u": _order(F.col(own_id), seed), "source": F.col(own_source).cast("string")})
    out = looked_up(placed, cuts, {"source": "c_source"}, "u").withColumn("n", _repeats(F.col("u")).cast("int")).where("n > 0")
    return out.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).select(*rows.columns).toDF(*docs.columns)


def _order(doc_id, seed: int):
    """Seeded place of a document in its source: 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(int(seed)).cast("long"), doc_id.cast("string")), 1)


def _sized(docs: DataFrame, seed, id_col, text_col, source_col) -> DataFrame:
    doc_id, source, text = (F.col(f"`{c}`") for c in (id_col, source_col, text_col))
    return written(docs.select(doc_id.alias("doc_id"), source.cast("string").alias("source"), n_words(text).alias("size"), _order(doc_id, seed).alias("u")), "mix-sizes")


def _repeats(u):
    """Times a document is taken, from its source's cut and its place u."""
    return F.col("whole") + F.coalesce(u <= F.col("cut_u"), F.lit(False)).cast("long")


def _reached(table: DataFrame, cuts: DataFrame, name: str) -> DataFrame:
    """cuts(e_source, rest, before, ...) one step further: the bucket k of table(source, k, size) in which `rest` is reached.

    table has a bounded number of rows a source.
    """
    upto = F.sum("size").over(W.partitionBy("source").orderBy("k"))
    met = looked_up(table.withColumn("upto", upto), cuts.select("e_source", "rest", "before"), {"source": "e_source"}, "k")
    low = F.col("before") + F.col("upto") - F.col("size")
    hit = met.where((F.col("rest") > low) & (F.col("rest") <= F.col("before") + F.col("upto")))
    return written(hit.select("e_source", "rest", low.alias("before"), F.col("k").alias("e_head")), name)


def source_cuts(sized: DataFrame, weights, max_epochs: int) -> DataFrame:
    """One row per source: c_source, source_size, target, whole repeats, and the last place that gets one more (cut_u)."""
    bucket = lambda u, bits: F.shiftright(u, 63 - bits)
    hist = written(sized.groupBy("source", bucket(F.col("u"), BITS).alias("b")).agg(F.sum("size").alias("size")), "mix-histogram")
    stats = hist.groupBy("source").agg(F.sum("size").alias("size"))
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    stats = water_fill(_weighted(stats, weights), max_epochs).withColumn("whole", F.floor(rate).cast("long"))
    stats = stats.select(F.col("source").alias("c_source"), F.col("size").alias("source_size"), "target", "whole", (F.col("target") - F.col("whole") * F.col("size")).alias("rest"))
    stats = written(stats, "mix-sources")
    cuts = written(stats.where("rest > 0").select(F.col("c_source").alias("e_source"), "rest", F.lit(0).cast("long").alias("before")), "mix-cuts-0")
    for level in (1, 2):
        if level > 1:
            inside = looked_up(sized.withColumn("head", bucket(F.col("u"), BITS)), cuts.select("e_source", "e_head"), {"source": "e_source", "head": "e_head"}, "u")
            hist = written(inside.groupBy("source", bucket(F.col("u"), level * BITS).alias("b")).agg(F.sum("size").alias("size")), "mix-histogram-2")
        coarse = F.shiftright("b", STEP)
        cuts = _reached(hist.groupBy("source", coarse.alias("k")).agg(F.sum("size").alias("size")), cuts, f"mix-cuts-{level}a")
        fine = looked_up(hist.withColumn("head", coarse), cuts.select("e_source", "e_head"), {"source": "e_source", "head": "e_head"}, "b")
        cuts = _reached(fine.select("source", F.col("b").alias("k"), "size"), cuts, f"mix-cuts-{level}b")
    inside = looked_up(sized.withColumn("head", bucket(F.col("u"), 2 * BITS)), cuts, {"source": "e_source", "head": "e_head"}, "u")
    # Rows of one u go together; they are taken if the target lies past the middle of what they add.
    places = inside.groupBy("source", "u").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    upto = F.sum("size").over(W.partitionBy("source").orderBy("u"))
    taken = places.withColumn("middle", F.col("before") + upto - F.col("size") / 2.0).where("middle <= rest")
    last = taken.groupBy(F.col("source").alias("l_source")).agg(F.max("u").alias("u"))
    first = F.shiftleft("e_head", 63 - 2 * BITS)
    ends = cuts.join(last, F.col("e_source").eqNullSafe(F.col("l_source")), "left").select("e_source", F.coalesce("u", first - 1).alias("cut_u"))
    return written(stats.join(ends, F.col("c_source").eqNullSafe(F.col("e_source")), "left").select("c_source", "source_size", "target", "whole", "cut_u"), "mix-cuts")
