"""Layouts, overlaps and the functions of SQL text against brute force and column forms."""

import itertools
import random

from pyspark.sql import functions as F

from quarrymill import sql
from quarrymill.functions import scan, text
from quarrymill.operators import pages


def test_elements(spark):
    rows = [(1, "[0,0,10,10][text][PAIR_SEP][1.5, -2, 30,40] tab"), (2, None), (3, ""), (4, "nothing here"), (5, "[1,2,3][text]")]
    got = [tuple(r) for r in pages.elements(spark.createDataFrame(rows, "page int, layout string")).drop("layout").orderBy("page", "position").collect()]
    assert got == [(1, 0, 0.0, 0.0, 10.0, 10.0, "text"), (1, 1, 1.5, -2.0, 30.0, 40.0, "tab")]


def brute(boxes):
    hit = set()
    for (i, a), (j, b) in itertools.combinations(enumerate(boxes), 2):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        if w > 0 and h > 0:
            both = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1])
            if w * h > 0.1 * (both - w * h):
                hit |= {i, j}
    return len(hit)


def test_overlaps(spark):
    """Boxes over many cells, over the page's edge, without area, all alike."""
    rng, by_page = random.Random(1), {}
    for p in range(60):
        own = []
        for _ in range(rng.randrange(1, 12)):
            x, y = rng.randrange(-20, 110), rng.randrange(-20, 110)
            own.append((float(x), float(y), float(x + rng.choice([0, 3, 20, 90])), float(y + rng.choice([0, 3, 20, 90]))))
        by_page[p] = own
    by_page[60] = [(1.0, 1.0, 9.0, 9.0)] * 4
    rows = [(p, i, *b) for p, own in by_page.items() for i, b in enumerate(own)]
    out = pages.overlaps(spark.createDataFrame(rows, "page int, position int, x1 double, y1 double, x2 double, y2 double"), "page", 100.0, 100.0)
    got = {r["page"]: (r["boxes"], r["overlapping"], r["share"]) for r in out.collect()}
    assert got == {p: (len(own), brute(own), brute(own) / len(own)) for p, own in by_page.items()}


def test_laid_out(spark):
    rows = [
        (1, "[0,0,10,10][text][PAIR_SEP][20,20,22,40][tab][PAIR_SEP][50,50,90,90][fig]"),  # the second is too small to read, but counts
        (2, "[0,0,10,10][text][PAIR_SEP][1,1,10,10][tab]"),  # overlap
        (3, "text [0,0,10,10]"), (4, None), (5, "[]"), (6, "[0,0,10,10][text]"),
    ]
    got = sorted((r["page"], r["reading_order"], r["label"]) for r in pages.laid_out(spark.createDataFrame(rows, "page int, layout string"), "page", 100.0, 100.0).collect())
    assert got == [(1, 0, "text"), (1, 2, "fig"), *((p, 0, "distorted_page") for p in (2, 3, 4, 5)), (6, 0, "text")]
    assert pages.laid_out(spark.createDataFrame([], "page int, layout string"), "page", 100.0, 100.0).count() == 0


def test_sql_functions_equal_columns(spark):
    sql.register(spark)
    rows = [("", "a.PNG", 3), (None, None, None), ("x" * 7000, "d/b.jpeg", -1), ("a,b,,c", ".hidden", 1 << 40), ("2021", "f.tar.gif", 0), ("quote ' and \\ slash\n", "plain", 7)]
    t = spark.createDataFrame(rows, "t string, path string, n long")
    c = F.col
    columns = t.select(
        text.estimate_tokens(c("t")).alias("a"), text.truncated(c("t"), 6000, "head")[0].alias("b"), scan.capped(c("t"), scan.EVAL_CHARS, scan.EVAL_MARK).alias("c"), scan.topics(c("t")).alias("d"),
        scan.year(c("t")).alias("e"), scan.media_type(c("path")).alias("f"), scan.instruction(c("t"), c("path")).alias("g"), text.hamming_score(F.bit_count(c("n").bitwiseXOR(F.lit(5)))).alias("h"), F.lit(text.max_chars(3500)).alias("i"),
    )
    said = spark.sql("SELECT estimate_tokens(t) a, truncate_head(t, 6000) b, capped_content(t) c, topics_of(t) d, year_of(t) e, media_type_of(path) f, instruction_of(t, path) g, hash_score(n, 5) h, max_chars(3500) i FROM {t}", t=t)
    assert list(map(tuple, said.collect())) == list(map(tuple, columns.collect()))
    plan = said._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "estimate_tokens" not in plan
