"""Readers and writers: manifests, trackers, JSON, markdown, pictures, PDFs, exports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions import jsonx as J
from quarrymill.functions import scan as S
from quarrymill.operators import track as K
from quarrymill.sources import shared

#: Columns of a manifest and of a status table; a file's other columns are dropped.
MANIFEST = ("paper_id", "local_image_path", "local_pdf_path", "title", "abstract", "conference", "year", "topics", "error")
SPLITS = ("train", "test", "validation")
_STATUS_TYPES = {"boolean": K.STAGES, "int": K.COUNTS, "string": ("paper_id", *K.PATHS, "started_at", "completed_at", "last_updated", "error_message"), "double": ("processing_time_seconds",)}


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, by the header; blanks are null."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)


def read_manifest(spark: SparkSession, folder: str, split: str = "train") -> DataFrame:
    """{folder}/{split}.csv with the columns of MANIFEST as text, null where the file lacks them; the three ids must be there."""
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}")
    rows = _csv(spark, f"{folder}/{split}.csv")
    if missing := [c for c in MANIFEST[:3] if c not in rows.columns]:
        raise ValueError(f"missing columns: {missing}")
    return rows.select([F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in MANIFEST])


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """A tracker's status table with its declared columns; unknown ones are dropped, a missing file is an empty table."""
    kinds = {c: kind for kind, names in _STATUS_TYPES.items() for c in names}
    if not shared.exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in kinds.items()))
    rows = _csv(spark, path)
    return rows.select([(F.col(c) if c in rows.columns else F.lit(None)).try_cast(k).alias(c) for c, k in kinds.items()]).where("paper_id IS NOT NULL")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; a malformed line stops the read."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def checked_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, refused): objects of a schema, a line each; refused has path, line and reason of every line that is none, so that none vanishes.

    A field of another type refuses its line; blank lines are no rows. Both tables read the files on their own.
    """
    kept = "__refused"
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")).where(F.regexp_like("line", F.lit(r"\S")))
    parsed = lines.withColumn("o", F.from_json("line", f"{schema}, {kept} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": kept}))
    reason = F.when(J.json_or_null(F.col("line")).isNull(), "no JSON").when(~F.startswith(F.ltrim("line"), F.lit("{")), "no object").otherwise("not of the schema")
    bad = F.col(f"o.{kept}").isNotNull() | ~F.startswith(F.ltrim("line"), F.lit("{"))
    return parsed.where(~bad).select("o.*").drop(kept), parsed.where(bad).select("path", "line", reason.alias("reason"))


def checked_json_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, refused): files of a record each as read_json_files gives them, and path and size of those that are no JSON."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    refused = _named(files, F.col("value")).where(J.json_or_null(F.col("value")).isNull() | F.col("value").isNull())
    return read_json_files(spark, path), refused.select("path", F.octet_length("value").cast("long").alias("length"))


def checked_status(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, refused): a status table, and paper_id, column and text of each value that its column's type refuses (null in rows)."""
    kinds = {c: kind for kind, names in _STATUS_TYPES.items() for c in names if kind != "string"}
    rows = read_status(spark, path)
    if not shared.exists(spark, path):
        return rows, spark.createDataFrame([], "paper_id string, column string, value string")
    raw = _csv(spark, path)
    wrong = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(k).isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))) for c, k in kinds.items() if c in raw.columns]
    found = raw.select("paper_id", F.explode(F.filter(F.array(*wrong), lambda x: x.isNotNull())).alias("r")) if wrong else raw.select("paper_id", F.lit(None).cast("struct<column:string,value:string>").alias("r")).limit(0)
    return rows, found.select("paper_id", "r.column", "r.value")


def read_splits(spark: SparkSession, train: str, validation: str, fmt: str = "mistral") -> dict[str, DataFrame]:
    """The two named splits of instruction rows in a trainer's format, without their other columns."""
    from quarrymill.functions.text import training_rows

    return {name: training_rows(read_jsonl(spark, path, "instruction string, input string, output string"), fmt) for name, path in (("train", train), ("validation", validation))}


def _named(files: DataFrame, value: Column) -> DataFrame:
    path = F.col("_metadata.file_path")
    return files.select(path.alias("path"), S.stem(path).alias("id"), value)


def read_json_files(spark: SparkSession, path: str) -> DataFrame:
    """A file per record as VARIANT; files that are no JSON are left out."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    return _named(files, F.try_parse_json(J.json_or_null(F.col("value"))).alias("record")).where("record IS NOT NULL")


def with_artifacts(rows: DataFrame, layouts: DataFrame, matches: DataFrame, key: str = "paper_id") -> DataFrame:
    """rows with layout (null where there is no file) and matches (an empty list): both tables from read_json_files, by id."""
    a, b = layouts.select(F.col("id").alias("__a"), F.col("record").alias("layout")), matches.select(F.col("id").alias("__b"), F.col("record").alias("matches"))
    out = rows.join(a, F.col(key) == F.col("__a"), "left").join(b, F.col(key) == F.col("__b"), "left").drop("__a", "__b")
    return out.withColumn("matches", F.coalesce(F.try_variant_get("matches", "$.matches", "variant"), F.parse_json(F.lit("[]"))))


def read_checkpoint(spark: SparkSession, path: str) -> dict:
    """stage, completed_ids, failed_ids, timestamp of a saved checkpoint; a fresh one where there is none."""
    fresh = {"stage": "poster_parsing", "completed_ids": [], "failed_ids": [], "timestamp": None}
    if not shared.exists(spark, path):
        return fresh
    row = spark.read.schema("stage string, completed_ids array<string>, failed_ids array<string>, timestamp string").json(path, multiLine=True).first()
    return fresh | {k: v for k, v in row.asDict().items() if v is not None} if row else fresh


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(id, path, text): of each folder the first markdown file by path; the folder's name is the id."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    named = files.withColumn("id", F.regexp_extract("path", r"([^/]+)/[^/]+\z", 1))
    return named.groupBy("id").agg(F.min_by(F.struct("path", "text"), "path").alias("f")).select("id", "f.path", "f.text")


def _binary(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)


def list_figures(spark: SparkSession, path: str, source: str = "paper") -> DataFrame:
    """PNG files in the order of their paths, with id (the stem), source and size; contents are not read."""
    files = _binary(spark, path, "*.png").select("path", "length")
    return files.select(S.stem(F.col("path")).alias("figure_id"), F.lit(source).alias("source_doc"), "path", "length").orderBy("path")


def read_pdfs(spark: SparkSession, path: str, parse) -> DataFrame:
    """(id, title, content, error) of each PDF: parse(bytes) -> text runs in Python workers, a file's failure is its error.

    A folder without PDFs is an error. The title is the stem with spaces for _ and -.
    """
    files = _binary(spark, path, "*.pdf")
    if files.select("path").isEmpty():
        raise ValueError(f"no PDF files in {path}")

    def run(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for p, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    out.append((p, parse(bytes(content)), None))
                except Exception as e:  # noqa: BLE001 - becomes data
                    out.append((p, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "content", "error"])

    parsed = files.select("path", "content").mapInPandas(run, "path string, content string, error string")
    stem = S.stem(F.col("path"))
    return parsed.select(stem.alias("id"), F.regexp_replace(stem, "[_-]", " ").alias("title"), "content", "error")


def read_paper(spark: SparkSession, path: str, parse_pdf=None) -> DataFrame:
    """(id, content) of papers, by suffix: text files as they are, PDFs by parse_pdf(bytes)."""
    if path.lower().endswith(".pdf"):
        if parse_pdf is None:
            raise ValueError("a PDF needs a parser")
        return read_pdfs(spark, path, parse_pdf).select("id", "content")
    return _named(spark.read.text(path, wholetext=True), F.col("value").alias("content")).select("id", "content")


def encoded_images(spark: SparkSession, path: str, shrink=None) -> DataFrame:
    """(path, data, media_type): base64 within the limit of an image call. A larger file goes through shrink(bytes) -> JPEG bytes."""
    files = _binary(spark, path, "*")
    small = S.base64_size(F.col("length")) <= S.MAX_BASE64
    code = lambda c: F.replace(F.base64(c), F.lit("\r\n"), F.lit(""))
    fits = files.where(small).select("path", code("content").alias("data"), S.media_type(F.col("path")).alias("media_type"))
    if shrink is None:
        return fits.unionByName(files.where(~small).select("path", F.lit(None).cast("string").alias("data"), S.media_type(F.col("path")).alias("media_type")))

    def run(frames):
        for frame in frames:
            yield frame.assign(content=[shrink(bytes(c)) for c in frame["content"]])

    cut = files.where(~small).select("path", "content").mapInPandas(run, "path string, content binary")
    return fits.unionByName(cut.select("path", code("content").alias("data"), F.lit("image/jpeg").alias("media_type")))


def existing(rows: DataFrame, listing: DataFrame, *paths: str) -> DataFrame:
    """Rows all of whose paths are in a listing(path)."""
    for i, p in enumerate(paths):
        known = listing.select(F.col("path").alias(f"__p{i}")).distinct()
        rows = rows.join(known, F.col(p) == F.col(f"__p{i}"), "left_semi")
    return rows


def peek(df: DataFrame, n: int = 5) -> dict:
    """Columns, numbers of rows and columns, and the first n rows."""
    return {"columns": df.columns, "shape": (df.count(), len(df.columns)), "head": [r.asDict() for r in df.limit(n).collect()]}


# Writers.


def write_jsonl(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_array(rows: DataFrame, path: str) -> None:
    """One JSON array of all rows. For exports that one file may hold: a task writes the rows as they come."""
    if rows.isEmpty():
        rows.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1).write.text(path)
    else:
        _write_objects(rows, path)


def _write_objects(rows: DataFrame, path: str) -> None:
    objects = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).coalesce(1)

    def run(frames):
        import pandas as pd

        first = True
        for frame in frames:
            for j in frame["j"]:
                yield pd.DataFrame({"value": [("[" if first else ",") + j]})
                first = False
        yield pd.DataFrame({"value": ["]"]})

    objects.mapInPandas(run, "value string").write.text(path)


def export(rows: DataFrame, path: str, fmt: str = "jsonl") -> int:
    """Write rows as jsonl, json, parquet or csv; returns how many, counted as they are written."""
    writers = {"jsonl": write_jsonl, "json": write_json_array, "parquet": lambda r, p: r.write.parquet(p), "csv": write_csv}
    if fmt not in writers:
        raise ValueError(f"format must be one of {sorted(writers)}")
    if fmt in ("json", "csv") and rows.isEmpty():
        writers[fmt](rows, path)
        return 0
    seen = Observation()
    # A look whether there are rows would end what is observed.
    once = writers | {"json": _write_objects, "csv": _write_lines}
    once[fmt](rows.observe(seen, F.count(F.lit(1)).alias("n")), path)
    return seen.get["n"]


def write_csv(rows: DataFrame, path: str) -> None:
    """With a header, without an index; nested columns as JSON; no file for no rows."""
    if not rows.isEmpty():
        _write_lines(rows, path)


def _write_lines(rows: DataFrame, path: str) -> None:
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = [F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in rows.schema]
    rows.select(flat).write.option("header", True).option("escape", chr(34)).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_records(rows: DataFrame, path: str, key: str, column: str, suffix: str = ".json") -> None:
    """A file {key}{suffix} for each row, holding the text of a column, written by the tasks through Hadoop's file systems of pyarrow; existing ones are replaced."""

    def run(part) -> None:
        from pyarrow import fs

        found, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        found.create_dir(root, recursive=True)
        for r in part:
            with found.open_output_stream(f"{root}/{r[0]}{suffix}") as f:
                f.write((r[1] or "").encode())

    # A key is one name below the folder, never a path; it must not name a hidden file either, which readers skip.
    name = F.col(key).cast("string")
    safe = F.when(name.isNull() | (name == "") | F.regexp_like(name, F.lit(r"[/\\\\\x00]|^[._]")), F.raise_error(F.concat(F.lit("no file name: "), F.coalesce(name, F.lit("null"))))).otherwise(name)
    rows.select(safe, F.col(column).cast("string")).foreachPartition(run)


def copy_matches(matches: DataFrame, path: str) -> None:
    """Copy both pictures of each match(verdict, number, poster_path, paper_path, reasoning) to same, similar or uncertain, by its number there."""

    def run(part) -> None:
        from pyarrow import fs

        found, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        for r in part:
            folder = f"{root}/{r['verdict'] if r['verdict'] in ('same', 'similar') else 'uncertain'}"
            found.create_dir(folder, recursive=True)
            for side, source in (("poster", r["poster_path"]), ("paper", r["paper_path"])):
                where, name = fs.FileSystem.from_uri(source if "://" in source or source.startswith("file:") else f"file://{source}")
                ext = name[name.rfind(".") :] if "." in name.rsplit("/", 1)[-1] else ""
                with where.open_input_stream(name) as a, found.open_output_stream(f"{folder}/match_{r['number']:02d}_{side}{ext}") as b:
                    b.write(a.read())
            if r["reasoning"] is not None:
                with found.open_output_stream(f"{folder}/match_{r['number']:02d}_reasoning.txt") as f:
                    f.write(r["reasoning"].encode())

    matches.select("verdict", "number", "poster_path", "paper_path", "reasoning").foreachPartition(run)


def write_checkpoint(spark: SparkSession, path: str, stage: str, completed: list[str], failed: list[str]) -> None:
    row = spark.createDataFrame([(stage, sorted(set(completed)), sorted(set(failed)))], "stage string, completed_ids array<string>, failed_ids array<string>")
    row.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).coalesce(1).write.mode("overwrite").json(path)


def write_ordered(rows: DataFrame, path: str, *order: str, fmt: str = "json", parts: int | None = None) -> list[dict]:
    """Write rows in order as numbered files, and `_manifest.json`: for each file its name, rows, and first and last values of the order.

    Rows are dealt in ranges of the order; a last key that tells rows apart at random cuts values that many rows share, so no
    file holds a whole set. Reading the files by name gives the order back. Returns the manifest.
    """
    spark = rows.sparkSession
    salt = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns if c not in order)))) if set(rows.columns) - set(order) else F.lit(0)
    salted = rows.withColumn("__salt", salt)
    keys = [*(F.col(f"`{c}`") for c in order), F.col("__salt")]
    dealt = (salted.repartitionByRange(parts, *keys) if parts else salted.repartitionByRange(*keys)).sortWithinPartitions(*keys).drop("__salt")
    dealt.write.mode("overwrite").format(fmt).option("ignoreNullFields", False).save(path)
    ends = [f(F.struct(*(F.col(f"`{c}`") for c in order))).alias(n) for f, n in ((F.min, "first"), (F.max, "last"))]
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\z", 1)
    # A row a file.
    found = spark.read.schema(rows.schema).format(fmt).load(path).groupBy(name.alias("file")).agg(F.count("*").alias("rows"), *ends).orderBy("file").collect()
    manifest = [r.asDict(recursive=True) for r in found]
    shared.write_text(spark, f"{path}/_manifest.json", json.dumps(manifest, default=str))
    return manifest


def write_sets(train: DataFrame, val: DataFrame, path: str) -> None:
    """train.jsonl, val.jsonl, combined.jsonl (training rows first, by the manifest's order of files), each a folder."""
    write_jsonl(train, f"{path}/train.jsonl", "overwrite")
    write_jsonl(val, f"{path}/val.jsonl", "overwrite")
    both = train.withColumn("set", F.lit(0)).unionByName(val.withColumn("set", F.lit(1)))
    write_ordered(both, f"{path}/combined.jsonl", "set")


def write_summary(summary: DataFrame, results: DataFrame, path: str) -> None:
    """An evaluation's results, a line for each sample, and its summary as one line."""
    results.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/samples")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def shown(record: Column, most: int = 2000) -> Column:
    """A record's JSON for a terminal: cut, with a note where it was."""
    text = F.to_json(record, {"pretty": "true"})
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("\n... [output truncated]"))).otherwise(text)
