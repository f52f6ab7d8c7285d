"""Fill-in-middle transformation in Spark's own functions.

A text is cut into units, each a word with the white space before it (or the white space at the end), so that the units
together are the text. SHA-256 of seed and id gives four 32-bit numbers: two cut the units into prefix, middle and suffix,
one decides whether the text is changed at all, one in which form:

    psm: <P>prefix<S>suffix<M>middle        spm: <S>suffix<P>prefix<M>middle

A text that holds a sentinel stays plain, so no sentinel inside a part can mislead `restored`. Two sentinels cannot overlap,
as `<` stands only at their beginnings; so a part that ends like the beginning of one doesn't either.

All of it is columns: no row meets another, nothing is shuffled, and a document's form depends on its id, text and the seed
alone. Defined results: null text is an empty one; an empty text is plain; a null id is hashed as an empty one; equal ids and
texts give equal rows; any length is cut whole; an empty table gives an empty result; further columns, of whatever name, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
SENTINELS = ("<P>", "<S>", "<M>")
#: Texts of a hundred that are changed, and changed ones of a hundred that take the form spm.
RATE = 50
SPM = 80
SEED = "42"


def _number(digest: str, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def transformed(docs: DataFrame, id_col="doc_id", text_col="text", rate: int = RATE, spm: int = SPM, seed: str = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per row of docs."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.withColumns({"units": F.regexp_extract_all("text", F.lit(UNIT), F.lit(0)), "digest": F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)})
    rows = rows.withColumn("n", F.size("units").cast("long"))
    ends = [F.pmod(_number("digest", k), F.col("n") + 1).cast("int") for k in (0, 1)]
    holds = F.lit(False)
    for s in SENTINELS:
        holds = holds | F.contains("text", F.lit(s))
    plain = (F.col("text") == "") | holds | (_number("digest", 2) % 100 >= rate)
    form = F.when(plain, "plain").when(_number("digest", 3) % 100 < spm, "spm").otherwise("psm")
    rows = rows.withColumns({"low": F.least(*ends), "high": F.greatest(*ends), "form": form})
    part = lambda start, length: F.array_join(F.slice("units", start, length), "")
    changed = F.col("form") != "plain"
    rows = rows.withColumns(
        {
            "prefix": F.when(changed, part(F.lit(1), F.col("low"))),
            "middle": F.when(changed, part(F.col("low") + 1, F.col("high") - F.col("low"))),
            "suffix": F.when(changed, part(F.col("high") + 1, F.col("n").cast("int") - F.col("high"))),
        }
    )
    p, s, m = map(F.lit, SENTINELS)
    output = F.when(F.col("form") == "psm", F.concat(p, "prefix", s, "suffix", m, "middle")).when(F.col("form") == "spm", F.concat(s, "suffix", p, "prefix", m, "middle")).otherwise(F.col("text"))
    return rows.select("doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form."""
    parts = F.split(output, "|".join(SENTINELS))
    # The first piece is what stands before the first sentinel: nothing.
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
