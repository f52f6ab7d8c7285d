"""A page's layout to its elements: boxes out of a model's text, how much they overlap, reading order, the page's text.

The layout text of a page is `[x1,y1,x2,y2][label]` for each element, with `[PAIR_SEP]` between them. A layout that says
nothing, is not in brackets, or whose boxes overlap too much is one element, the whole page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators.figures import MIN_CROP, WHOLE_PAGE

_ELEMENT = re.compile(r"\[\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*\]\s*\[?(\w+)\]?")
#: Two boxes overlap where their common area is more than this share of their union; a page is given up where more than SHARE of its boxes overlap another.
UNION_SHARE = 0.1
SHARE = 0.25
#: A page is dealt into GRID x GRID cells to find pairs.
GRID = 8


class LayoutElements:
    """UDTF: the elements of a layout text in its order; none for null."""

    def eval(self, layout: str) -> Iterator[tuple]:
        for i, m in enumerate(_ELEMENT.finditer(layout or "")):
            yield (i, *map(float, m.groups()[:4]), m[5])


class PageSlices:
    """UDTF: a document's pages of `size` characters each, numbered from 0; none for null."""

    def eval(self, text: str, size: int) -> Iterator[tuple]:
        for i in range(0, len(text or ""), max(1, size)):
            yield (i // max(1, size), text[i : i + max(1, size)])


def register(spark: SparkSession) -> None:
    """The table functions under their SQL names: layout_elements(layout), page_slices(text, size)."""
    spark.udtf.register("layout_elements", F.udtf(LayoutElements, returnType="position int, x1 double, y1 double, x2 double, y2 double, label string"))
    spark.udtf.register("page_slices", F.udtf(PageSlices, returnType="page int, text string"))


def elements(pages: DataFrame, layout: str = "layout") -> DataFrame:
    """pages with position, x1, y1, x2, y2, label for each element; a page without any has no row."""
    spark = pages.sparkSession
    register(spark)
    return spark.sql(f"SELECT p.*, e.* FROM {{pages}} AS p, LATERAL layout_elements(p.`{layout}`) AS e", pages=pages)


def overlaps(boxes: DataFrame, page: str, width: float, height: float) -> DataFrame:
    """(page, boxes, overlapping, share): how many of a page's boxes overlap another by more than UNION_SHARE.

    Boxes meet in the cells of a grid that both touch, and only in the cell where their common part begins, so each pair
    is looked at once; then areas decide exactly. boxes: page, position, x1, y1, x2, y2.
    """
    cell = lambda v, size: F.least(F.greatest(F.floor(v / size * GRID), F.lit(0)), F.lit(GRID - 1)).cast("int")
    spread = boxes.select(page, "position", "x1", "y1", "x2", "y2", F.explode(F.sequence(cell(F.col("x1"), width), cell(F.col("x2"), width))).alias("cx")).withColumn("cy", F.explode(F.sequence(cell(F.col("y1"), height), cell(F.col("y2"), height))))
    a, b = spread.alias("a"), spread.alias("b")
    low = {v: F.greatest(f"a.{v}1", f"b.{v}1") for v in "xy"}
    high = {v: F.least(f"a.{v}2", f"b.{v}2") for v in "xy"}
    area = lambda s: (F.col(f"{s}.x2") - F.col(f"{s}.x1")) * (F.col(f"{s}.y2") - F.col(f"{s}.y1"))
    common = (high["x"] - low["x"]) * (high["y"] - low["y"])
    meets = (F.col(f"a.{page}") == F.col(f"b.{page}")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy")) & (F.col("a.position") < F.col("b.position"))
    begins = (cell(low["x"], width) == F.col("a.cx")) & (cell(low["y"], height) == F.col("a.cy"))
    real = (high["x"] > low["x"]) & (high["y"] > low["y"]) & (common > UNION_SHARE * (area("a") + area("b") - common))
    pairs = a.join(b, meets & begins & real).select(F.col(f"a.{page}").alias("__page"), F.array("a.position", "b.position").alias("two"))
    hit = pairs.select("__page", F.explode("two").alias("p")).groupBy("__page").agg(F.count_distinct("p").alias("overlapping"))
    sizes = boxes.groupBy(page).agg(F.count("*").alias("boxes"))
    out = sizes.join(hit, F.col(page) == F.col("__page"), "left").withColumn("overlapping", F.coalesce("overlapping", F.lit(0)))
    return out.select(page, "boxes", "overlapping", (F.col("overlapping") / F.col("boxes")).alias("share"))


def laid_out(pages: DataFrame, page: str, width: float, height: float, layout: str = "layout", share: float = SHARE) -> DataFrame:
    """(page, reading_order, label, x1, y1, x2, y2) of pages(page, layout): elements in the layout's order, or the whole page as one.

    The counter goes on for crops that are too small to read, which are left out.
    """
    found = elements(pages.select(page, layout), layout)
    boxes = found.select(page, "position", "x1", "y1", "x2", "y2", "label")
    crowded = overlaps(boxes, page, width, height).where(F.col("share") > share).select(F.col(page).alias("__page"))
    bracketed = F.startswith(F.col(layout), F.lit("[")) & F.endswith(F.col(layout), F.lit("]"))
    good = found.where(bracketed).join(crowded, F.col(page) == F.col("__page"), "left_anti").select(page, F.col("position").alias("reading_order"), "label", "x1", "y1", "x2", "y2")
    whole = pages.select(page).join(good.select(F.col(page).alias("__page")).distinct(), F.col(page) == F.col("__page"), "left_anti")
    whole = whole.select(page, F.lit(0).alias("reading_order"), F.lit(WHOLE_PAGE).alias("label"), *(F.lit(float(v)).alias(c) for c, v in (("x1", 0), ("y1", 0), ("x2", width), ("y2", height))))
    return good.where((F.col("x2") - F.col("x1") > MIN_CROP) & (F.col("y2") - F.col("y1") > MIN_CROP)).unionByName(whole)
