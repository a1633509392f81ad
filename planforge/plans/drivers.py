"""Drivers: prepare documents and the course library, audit a batch, report on quality; and the command line."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config, schemas
from ..functions import columns as C
from ..functions import grids as G
from ..operators import audit, judges, payload, report, sections
from ..operators import relational as R
from ..sources import readers
from ..sources.store import Store, logger, run_metrics, write_csv, write_json


def _finished(raw: DataFrame, extractor: str) -> DataFrame:
    done = payload.finish(payload.build(raw))
    meta = F.col("meta").withField("extractor", F.lit(extractor))
    return done.select(F.lit(None).cast("long").alias("extraction_id"), "course_code", "source_path", "payload", meta.alias("meta"), F.lit(extractor).alias("extractor"), "extraction_status")


def prepare_documents(documents: DataFrame) -> DataFrame:
    """Rows to append to extractions, of ``documents`` (source_path, md, middle); failures are rows of status failed."""
    return _finished(sections.raw_records(documents), "markdown")


def prepare(spark: SparkSession, store: Store, manifest: str, root: str, skip_existing: bool = False) -> dict[str, int]:
    """Manifest to extractions; the counts of rows by status."""
    return _append(store, lambda docs: prepare_documents(docs), readers.documents(spark, manifest, root), skip_existing)


def prepare_pdf(spark: SparkSession, store: Store, folder: str, skip_existing: bool = False, pages_reader: Callable | None = None, lines_reader: Callable | None = None) -> dict[str, int]:
    """PDF files below a folder to extractions, by the optional PDF libraries or other readers; a file that cannot be
    read is a row of status failed."""
    pdfs = readers.files(spark, folder, content=True).withColumn("path", C.relative_path(F.regexp_replace(F.url_decode("path"), "^file:/+", "/"), folder))
    docs = readers.pdf_documents(pdfs, pages_reader or readers.plumber_reader, lines_reader or readers.mupdf_lines)
    return _append(store, lambda docs: _finished(sections.pdf_records(docs), "pdfplumber"), docs, skip_existing)


def _append(store: Store, make: Callable[[DataFrame], DataFrame], docs: DataFrame, skip_existing: bool) -> dict[str, int]:
    if skip_existing:
        docs = R.pending(docs, store.succeeded(), ["source_path"])
    added = store.append_extractions(make(docs))
    counts = {r.extraction_status: r.n for r in R.status_counts(store.read("extractions"), "extraction_status").collect()}
    return counts | {"added": added}


def prepare_library(spark: SparkSession, store: Store, folder: str, explicit: str | None = None, term: str | None = None) -> int:
    store.upsert_courses(readers.library(spark, str(readers.find_library(folder, explicit)), term))
    return store.read("courses").count()


#: Subjects that are saved at a time.
BATCH = 50_000


def run_audit(spark: SparkSession, store: Store, auditors: list[str] | None = None, limit: int | None = None, resume: int | None = None, factory: Callable | None = None, latest_only: bool = True, batch: int = BATCH) -> int:
    """One run: subjects, the limit, matching, then rules and judges batch by batch, metrics.  A batch's results are saved
    before the next one begins, so a run that is lost keeps what it had saved, and a resumed one leaves that out.

    The limit comes before duplicates are looked for and before the resume, as the counts of a run expect.
    """
    auditors = auditors or list(config.DIMENSIONS)
    if wrong := config.problems({"auditors": auditors}):
        raise ValueError("; ".join(wrong))
    subjects = readers.subjects(store.read("extractions"), latest_only)
    if limit:
        subjects = R.newest(subjects, [F.desc("created_at"), F.desc("extraction_id")], limit)
    total, skipped = subjects.count(), 0
    matched = audit.match(subjects, store.read("courses"))
    if resume:
        done = store.completed_keys(resume)
        skipped = subjects.join(done, "subject_key", "left_semi").count()
        store.resume_run(resume, total, skipped, total - skipped)
        matched, run_id = R.pending(matched, done, ["subject_key"]), resume
    else:
        run_id = store.create_run(auditors, {"auditors": auditors, "limit": limit}, total)
    batches = max(1, -(-(total - skipped) // batch))
    try:
        if batches > 1:  # matched once for all batches
            matched = store.work(matched.withColumn("_batch", F.pmod(F.xxhash64("subject_key"), F.lit(batches)).cast("int")), f"matched-{run_id}", "_batch")
        for k in range(batches):
            _audit_batch(store, run_id, matched.where(F.col("_batch") == k).drop("_batch") if batches > 1 else matched, auditors, factory)
        if broken := [r.asDict() for r in schemas.violations({n: store.read(n).where(F.col("run_id") == run_id) for n in ("results", "findings", "field_findings")} | {"runs": store.read("runs")}).where("n > 0").collect()]:
            raise ValueError(f"the run breaks {broken}")
        store.complete_run(run_id, run_metrics(store.read("results"), store.read("findings"), store.read("field_findings"), run_id, list(config.DIMENSIONS)))
    except Exception as e:
        store.fail_run(run_id, f"{type(e).__name__}: {e}")
        raise
    finally:
        store.drop_work(f"matched-{run_id}")
    return run_id


def _audit_batch(store: Store, run_id: int, matched: DataFrame, auditors: list[str], factory: Callable | None) -> None:
    """Rules and judges of some matched subjects, saved as one batch."""
    rules = audit.evaluate(matched, tuple(a for a in auditors if a not in config.MODEL_DIMENSIONS)).persist()
    dims = audit.dimension_findings(rules).select("subject_key", "wd", F.lit("rule").alias("pdfs"), "status", "message", F.to_json(F.struct("reasons")).alias("details"))
    every, held = rules, [rules]
    asked = [judges.judged(rules, wd, factory, f"{store.root}/llm_answers") for wd in config.MODEL_DIMENSIONS if wd in auditors]
    if asked:
        found = reduce(DataFrame.unionByName, asked).persist()
        held.append(found)
        dims = dims.unionByName(found.select("subject_key", "wd", F.lit("direct_llm").alias("pdfs"), "status", "message", "suggestion", "details", "llm_trace"), allowMissingColumns=True)
        every = audit.with_findings(rules, found)
    res = audit.results(every).withColumn("kcbh", F.coalesce("match_code", "course_code")).withColumn("summary", F.to_json(F.struct("match_status", "match_method", "messages", F.col("reasons").alias("main_reasons"))))
    try:
        store.save_audits(run_id, res, dims.where(F.col("wd").isin(*config.DIMENSIONS)), audit.field_findings(every))
    finally:
        for df in held:
            df.unpersist()


def _cached(spark: SparkSession, store: Store, name: str, wanted: DataFrame, derive: Callable[[DataFrame], DataFrame], refresh: bool) -> DataFrame:
    """Rows of a derived table of the store that are fresh, others made and stored before they are used."""
    cache = store.derived(name, readers.CACHE)
    rows = readers.refreshed(wanted, cache.limit(0) if refresh else cache, derive)
    store.replace_derived(name, R.upsert(cache, rows, ["source_pdf"]))
    return R.members(store.derived(name, readers.CACHE), wanted, ["source_pdf"])


def quality_report(spark: SparkSession, store: Store, manifest: str, root: str, refresh: bool = False) -> dict[str, DataFrame]:
    """Coverage by section and layer, warnings by label and class, their false rates, the most frequent labels, samples."""
    docs = readers.documents(spark, manifest, root, need_md=True).withColumnRenamed("source_path", "source_pdf")
    read = lambda rows, md, middle: report.raw_flags(sections.raw_records(rows.select(F.col("source_pdf").alias("source_path"), md.alias("md"), middle.alias("middle"))))
    spans = lambda rows: readers.layouts(rows.select("source_pdf", F.col("middle").alias("text")))

    def of_layout(rows: DataFrame) -> DataFrame:
        told = spans(rows.where("middle is not null")).select("source_pdf", F.concat_ws("\n", F.array_join("pages", "\n"), F.array_join(F.transform("grids", G.html_of), "\n")).alias("md"))
        return read(told, F.col("md"), F.lit(None).cast("string"))

    middles = _cached(spark, store, "layout_cache", docs.select("source_pdf", "middle"), of_layout, refresh)
    markdown = read(docs.where("md is not null"), F.col("md"), F.col("middle"))
    pdf_cache = store.derived("text_cache", readers.CACHE)
    texts = readers.cached_texts(docs, pdf_cache.select("source_pdf", "text"), store.read("extractions"))
    known = texts.where("text is not null").select("source_pdf", "text", F.create_map().cast("map<string,boolean>").alias("sections"), F.lit(readers.CACHE_VERSION).alias("cache_version"))
    store.replace_derived("text_cache", R.upsert(pdf_cache, known, ["source_pdf"]))
    joined = report.layers(docs.select("source_pdf"), store.read("extractions"), middles, store.derived("text_cache", readers.CACHE).select("source_pdf", "text"), markdown)
    classes = report.warning_classes(joined, docs.select("source_pdf", F.col("md").alias("md_text")))
    return {
        "coverage": report.coverage_matrix(joined), "statuses": R.status_counts(joined.where("extraction_status is not null"), "extraction_status"), "warnings": R.warning_pivot(classes, "label", "class", list(report.CLASSES)),
        "false_rates": report.false_rates(classes), "false_alarms": report.most_frequent(classes, "false_alarm"), "truly_missing": report.most_frequent(classes, "truly_missing", 12), "samples": report.root_samples(classes),
    }


def raw_report(spark: SparkSession, manifest: str, raw: str, out: str) -> dict[str, int]:
    """Which documents of a manifest recognition has output for, as CSV, and how many of each status, as JSON."""
    found = readers.raw_coverage(readers.manifest(spark, manifest), readers.raw_outputs(spark, raw)).persist()
    write_csv(found.orderBy("status", "stem"), f"{out}/raw_coverage.csv")
    counts = R.status_counts(found, "status")
    write_json(counts, f"{out}/raw_counts.json")
    told = {r.status: r.n for r in counts.collect()}
    found.unpersist()
    return told


#: Other names of the commands.
ALIASES = {"prepare-mineru": "prepare", "prepare-courses": "prepare-library", "run-batch": "audit"}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="planforge")
    parser.add_argument("--store", required=True)
    sub = parser.add_subparsers(dest="command", required=True)
    commands = {
        "init": (), "prepare": ("manifest", "root"), "prepare-pdf": ("folder",), "prepare-library": ("folder",), "audit": (), "report": ("manifest", "root", "out"), "raw-coverage": ("manifest", "raw", "out"),
    }
    for name, options in commands.items():
        p = sub.add_parser(name, aliases=[a for a, of in ALIASES.items() if of == name])
        for o in options:
            p.add_argument(o)
        if name == "audit":
            p.add_argument("--limit", type=int)
            p.add_argument("--resume", type=int)
        if name.startswith("prepare") and name != "prepare-library":
            p.add_argument("--skip-existing", action="store_true")
        if name == "report":
            p.add_argument("--refresh", action="store_true")
    args = parser.parse_args(argv)
    command = ALIASES.get(args.command, args.command)
    spark = SparkSession.builder.appName("planforge").getOrCreate()
    store, log = Store(spark, args.store), logger()
    store.init()
    if command == "prepare":
        log.info("prepared", extra={"fields": prepare(spark, store, args.manifest, args.root, args.skip_existing)})
    elif command == "prepare-pdf":
        log.info("prepared", extra={"fields": prepare_pdf(spark, store, args.folder, args.skip_existing)})
    elif command == "prepare-library":
        log.info("library", extra={"fields": {"courses": prepare_library(spark, store, args.folder)}})
    elif command == "audit":
        run_id = run_audit(spark, store, limit=args.limit, resume=args.resume, factory=judges.client_from_env)
        log.info("audited", extra={"fields": {"run_id": run_id, "summary": store.run(run_id)["summary"]}})
    elif command == "raw-coverage":
        log.info("raw coverage", extra={"fields": raw_report(spark, args.manifest, args.raw, args.out)})
    elif command == "report":
        tables = quality_report(spark, store, args.manifest, args.root, args.refresh)
        Path(args.out).write_text(report.markdown_report("Data quality", tables), encoding="utf-8")
        Path(args.out).with_suffix(".json").write_text(report.summary(tables, total=readers.manifest(spark, args.manifest, True).count()), encoding="utf-8")
    else:
        log.info("tables", extra={"fields": {"tables": sorted(schemas.TABLES)}})
    return 0


if __name__ == "__main__":
    sys.exit(main())
