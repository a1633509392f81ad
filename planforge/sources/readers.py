"""Sources: manifest, documents, layout files, folders, spreadsheets, caches.  All reads are Spark's."""

from __future__ import annotations

import csv
import io
import json
import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config, schemas
from ..functions import columns as C
from ..functions import grids as G
from ..operators import relational as R

#: Versions of derived results that are still good.
CACHE_VERSION = 3


def manifest(spark: SparkSession, path: str, need_md: bool = False) -> DataFrame:
    """Rows of a JSON-lines manifest whose status is success; blank lines and broken rows are skipped."""
    rows = spark.read.schema(schemas.MANIFEST).json(path).where("status = 'success'")
    return rows.where("md is not null and trim(md) <> ''") if need_md else rows


def whole_texts(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, text) of text files, one row each; ``glob`` keeps other files from being read."""
    df = spark.read.text(paths, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return df.select(F.regexp_replace(F.url_decode(F.col("_metadata.file_path")), "^file:/+", "/").alias("path"), F.col("value").alias("text"))


def documents(spark: SparkSession, manifest_path: str, root: str, need_md: bool = False) -> DataFrame:
    """(stem, source_path, md, middle, error) for every manifest row; a missing Markdown file is an error row.

    Texts are scanned once, Markdown and JSON only; the manifest's paths, which are small, go to the scan.
    """
    rows = manifest(spark, manifest_path, need_md).withColumn("row", F.xxhash64("stem", "source_pdf", "md", "json.middle"))
    place = lambda c: F.regexp_replace(F.concat(F.lit(root.rstrip("/") + "/"), F.replace(c, F.lit("\\"), F.lit("/"))), "^file:/+", "/")
    wanted = rows.select("row", F.explode(F.array(F.struct(F.lit("md").alias("kind"), place(F.col("md")).alias("path")), F.struct(F.lit("middle").alias("kind"), place(F.col("json.middle")).alias("path")))).alias("w")).select("row", "w.*").where("path is not null").distinct()
    texts = whole_texts(spark, root, "*.{md,markdown,txt,json}").join(wanted, "path")
    met = texts.groupBy("row").agg(F.max(F.when(F.col("kind") == "md", F.col("text"))).alias("md_text"), F.max(F.when(F.col("kind") == "middle", F.col("text"))).alias("middle_text"))
    error = F.when(F.coalesce("md", F.lit("")) == "", "no md in manifest").when(F.col("md_text").isNull(), "md file missing")
    return rows.join(met, "row", "left").select("stem", F.col("source_pdf").alias("source_path"), F.col("md_text").alias("md"), F.col("middle_text").alias("middle"), error.alias("error"))


def layouts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``texts`` with ``pages`` (array of text in reading order) and ``grids`` of layout JSON."""
    names = texts.columns
    schema = texts.select("*", F.lit(None).cast("array<string>").alias("pages"), F.lit(None).cast(f"array<{G.GRID}>").alias("grids")).schema
    grid = pa.list_(pa.list_(pa.list_(pa.string())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [G.layout_content(x) for x in b.column(names.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([f[0] for f in found], pa.list_(pa.string())), pa.array([f[1] for f in found], grid)], names=[*names, "pages", "grids"])

    return texts.mapInArrow(run, schema)


def files(spark: SparkSession, root: str, suffix: str = ".pdf", content: bool = False) -> DataFrame:
    """(path, length[, content]) of the files below a folder with the suffix in any case, each once, spreadsheets never."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    kept = df.where(F.lower("path").endswith(suffix) & ~F.lower("path").rlike(r"\.xls[xmb]?$"))
    return kept.select("path", "length", *(["content"] if content else [])).dropDuplicates(["path"])


def pdf_pages(pdfs: DataFrame, reader) -> DataFrame:
    """(path, page, text, grids JSON, error) by a plug-in ``reader(bytes) -> [(text, grids)]``: PDF libraries are optional."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                try:
                    out += [(path, i, t, json.dumps(g, ensure_ascii=False), None) for i, (t, g) in enumerate(reader(content))]
                except Exception as e:  # noqa: BLE001  a file's failure is a row
                    out.append((path, None, None, None, f"{type(e).__name__}: {e}"[:500]))
            cols = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()), strict=True)], names=["path", "page", "text", "grids", "error"])

    return pdfs.select("path", "content").mapInArrow(run, "path string, page int, text string, grids string, error string")


def plumber_reader(content: bytes) -> list[tuple[str, list]]:
    """Pages as (text, tables) by the optional library ``pdfplumber``."""
    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return [(page.extract_text() or "", page.extract_tables() or []) for page in pdf.pages]


def mupdf_lines(content: bytes) -> list[tuple[int, float, float, str]]:
    """Text lines as (page, y0, x0, text) by the optional library ``fitz``."""
    import fitz

    out = []
    with fitz.open(stream=content, filetype="pdf") as pdf:
        for number, page in enumerate(pdf):
            for block in page.get_text("dict").get("blocks", []):
                for line in block.get("lines", []):
                    x0, y0, *_ = line.get("bbox", (0, 0, 0, 0))
                    out.append((number, float(y0), float(x0), "".join(str(span.get("text", "")) for span in line.get("spans", []))))
    return out


def layout_lines(pdfs: DataFrame, reader=mupdf_lines) -> DataFrame:
    """(path, page, y0, x0, text, status): lines of a PDF's layout; one row without text where the library is absent
    (``unavailable``) or fails (``failed``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                try:
                    out += [(path, *line, "ok") for line in reader(content)]
                except ImportError:
                    out.append((path, None, None, None, None, "unavailable"))
                except Exception:  # noqa: BLE001  a file's failure is a row
                    out.append((path, None, None, None, None, "failed"))
            cols = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.string()), strict=True)], names=["path", "page", "y0", "x0", "text", "status"])

    return pdfs.select("path", "content").mapInArrow(run, "path string, page int, y0 double, x0 double, text string, status string")


def pdf_documents(pdfs: DataFrame, pages_reader=plumber_reader, lines_reader=mupdf_lines) -> DataFrame:
    """(source_path, pages, grids, layout, error) of PDF files: what ``sections.pdf_records`` takes."""
    pages = pdf_pages(pdfs, pages_reader)
    ordered = F.sort_array(F.collect_list(F.when(F.col("page").isNotNull(), F.struct("page", "text", "grids"))))
    tables = F.flatten(F.transform(ordered, lambda x: F.from_json(x["grids"], "array<array<array<string>>>")))
    met = pages.groupBy("path").agg(F.transform(ordered, lambda x: x["text"]).alias("pages"), F.to_json(tables).alias("grids"), F.max("error").alias("error"))
    layout = ordered_layout(layout_lines(pdfs, lines_reader).where("status = 'ok'")).withColumnRenamed("text", "layout")
    return met.join(layout, "path", "left").select(F.col("path").alias("source_path"), "pages", "grids", "layout", "error")


def ordered_layout(lines: DataFrame) -> DataFrame:
    """(path, text): lines (path, page, y0, x0, text) joined by page, then y, then x; a missing library gives no lines."""
    rows = F.sort_array(F.collect_list(F.struct("page", "y0", "x0", C.compact("text").alias("text"))))
    return lines.groupBy("path").agg(F.array_join(F.transform(F.filter(rows, lambda x: x["text"] != ""), lambda x: x["text"]), "\n").alias("text"))


def _cell(value: object) -> str | None:
    text = "" if value is None or value != value else str(value).strip()
    return text or None


def library_rows(table: list[list]) -> list[dict[str, str | None]]:
    """Course rows of a sheet: the header is the first of five rows that names the code, columns by label, rows without code go."""
    squeeze = lambda x: "".join(str(x or "").split())
    head = next((i for i, r in enumerate(table[:5]) if "课程编号" in map(squeeze, r)), 0)
    columns = {i: config.LIBRARY_FIELDS[squeeze(h)] for i, h in enumerate(table[head] if table else []) if squeeze(h) in config.LIBRARY_FIELDS}
    out = []
    for row in table[head + 1 :]:
        item = {k: None for k in dict.fromkeys(config.LIBRARY_FIELDS.values())}
        item |= {k: v for i, k in columns.items() if i < len(row) and (v := _cell(row[i]))}
        code = item["kcbh"] or ""
        item["kcbh"] = code[:-2] if code.endswith(".0") and code[:-2].isdigit() else code or None
        if item["kcbh"]:
            out.append(item)
    return out


def find_library(folder: str, explicit: str | None = None, default: str = "course_library.csv") -> Path:
    """The named file, else the default one, else the only spreadsheet or CSV of the folder."""
    if explicit:
        return Path(explicit)
    if (Path(folder) / default).exists():
        return Path(folder) / default
    found = sorted(p for p in Path(folder).iterdir() if p.suffix.lower() in (".xls", ".xlsx", ".xlsm", ".xlsb", ".csv"))
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} course libraries in {folder}")
    return found[0]


def library(spark: SparkSession, path: str, term: str | None = None) -> DataFrame:
    """Courses of a CSV or spreadsheet, the first row of a code wins.  A library is one sheet, read by the driver."""
    if path.lower().endswith(".csv"):
        # by the text: Spark's CSV reader takes the number of columns from the first line, which may be a title
        rows = list(csv.reader(io.StringIO(spark.read.text(path, wholetext=True).first()[0].lstrip("\ufeff"))))
    else:
        import pandas as pd  # needs the engine of the file's format

        rows = pd.read_excel(path, header=None, dtype=str).values.tolist()
    unique: dict[str, dict] = {}
    for item in library_rows(rows):
        unique.setdefault(item["kcbh"], item)
    fields = list(dict.fromkeys(config.LIBRARY_FIELDS.values()))
    df = spark.createDataFrame([tuple(r[f] for f in fields) for r in unique.values()], ", ".join(f"{f} string" for f in fields))
    now = F.current_timestamp()
    return df.withColumns({"import_term": F.lit(term), "source_file": F.lit(os.path.basename(path)), "imported_at": now, "created_at": now, "updated_at": now})


def subjects(extractions: DataFrame, latest_only: bool = True) -> DataFrame:
    """Audit subjects with their key: the latest extraction of each path, or all."""
    df = R.latest(extractions, ["source_path"], [F.desc("created_at"), F.desc("extraction_id")]) if latest_only else extractions
    return df.withColumn("subject_key", C.subject_key("extraction_id", "source_path"))


def cached_texts(wanted: DataFrame, cache: DataFrame, extractions: DataFrame) -> DataFrame:
    """(source_pdf, text): the cache's, else that of the latest PDF extraction with more than 50 characters."""
    pdf = R.members(extractions.where("extractor = 'pdfplumber' or extractor like 'pdfplumber%'").withColumnRenamed("source_path", "source_pdf"), wanted, ["source_pdf"]).where(F.length(F.trim(F.col("meta")["full_text"])) > 50)
    newest = R.latest(pdf, ["source_pdf"], [F.desc("created_at"), F.desc("extraction_id")]).select("source_pdf", C.normal_lines(F.col("meta")["full_text"]).alias("db_text"))
    out = wanted.select("source_pdf").join(cache.select("source_pdf", F.col("text").alias("cache_text")), "source_pdf", "left").join(newest, "source_pdf", "left")
    return out.select("source_pdf", F.coalesce(F.nullif("cache_text", F.lit("")), "db_text").alias("text"))


CACHE = "source_pdf string, text string, sections map<string,boolean>, cache_version int"


def fresh(cache: DataFrame) -> DataFrame:
    """Rows of a cache of derived results that are whole and of a good version."""
    return cache.where(F.col("cache_version") >= CACHE_VERSION).where("coalesce(text, '') <> '' and size(sections) > 0")


def stale(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """Keys whose derived result is missing, incomplete or of an old version."""
    return wanted.select("source_pdf").join(fresh(cache).select("source_pdf"), "source_pdf", "left_anti")


def refreshed(wanted: DataFrame, cache: DataFrame, derive) -> DataFrame:
    """The cache's rows of ``wanted`` where they are fresh, derived anew where not; ``derive`` takes rows of wanted."""
    missing = R.members(wanted, stale(wanted, cache), ["source_pdf"])
    new = derive(missing).withColumn("cache_version", F.lit(CACHE_VERSION))
    kept = R.members(fresh(cache), wanted, ["source_pdf"])
    return kept.select("source_pdf", "text", "sections", "cache_version").unionByName(new.select("source_pdf", "text", "sections", "cache_version"))


# --- fixed values: folders below a stem's where recognition puts its results, by precedence ---
PARSE_FOLDERS = ("hybrid_auto", "auto", "vlm", "office")


def raw_outputs(spark: SparkSession, root: str) -> DataFrame:
    """(stem, folder, has_md, files) of recognition's output tree ``root/<stem>/<folder>/...``; only names are read.

    The first of ``PARSE_FOLDERS`` that a stem has counts.  A folder without any file is not seen.
    """
    base = root.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.regexp_replace(F.url_decode("path"), "^file:/+", "/").alias("path"))
    rest = F.split(F.substr(F.col("path"), F.lit(len(base) + 1)), "/")
    parts = files.where(F.col("path").startswith(base)).select(rest.alias("p")).where(F.size("p") >= 2)
    named = parts.select(F.col("p")[0].alias("stem"), F.when(F.size("p") > 2, F.col("p")[1]).alias("folder"), F.element_at("p", -1).alias("file"), F.size("p").alias("depth"))
    ours = F.col("folder").isin(*PARSE_FOLDERS)
    md = ours & (F.col("depth") == 3) & (F.col("file") == F.concat("stem", F.lit(".md")))
    place = F.when(ours, F.array_position(F.array(*map(F.lit, PARSE_FOLDERS)), F.col("folder")))
    per = named.groupBy("stem", F.when(ours, F.col("folder")).alias("folder"), place.alias("place")).agg(F.max(F.coalesce(md, F.lit(False))).alias("has_md"), F.count("*").alias("files"))
    return R.latest(per, ["stem"], [F.asc_nulls_last("place")]).select("stem", "folder", "has_md", "files")


def raw_coverage(documents: DataFrame, outputs: DataFrame) -> DataFrame:
    """(stem, status) by exact stem: has_md, dir_only, empty_dir or missing; ``outputs`` (stem, has_md, files[, folder])."""
    parsed = F.col("folder").isNotNull() if "folder" in outputs.columns else F.col("files") > 0
    best = outputs.groupBy(F.col("stem").alias("_s")).agg(F.max(F.when(F.col("has_md"), 3).when(parsed, 2).otherwise(1)).alias("r"))
    status = F.when(F.col("r") == 3, "has_md").when(F.col("r") == 2, "dir_only").when(F.col("r") == 1, "empty_dir").otherwise("missing")
    return documents.select("stem").join(best, F.col("stem") == F.col("_s"), "left").select("stem", status.alias("status"))
