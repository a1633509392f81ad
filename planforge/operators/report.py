"""Data-quality report: sections present by layer, warnings verified against their source, root causes.

Layers are what recognition read (its layout's text), what the Markdown says, what the payload holds (loose: rows or an
overview; strict: rows or goals), and what another reader took from the PDF.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import columns as C
from ..functions import grids as G
from ..functions import text as T
from ..functions.udf import vectorised
from . import payload as payloads
from . import relational as R

# --- fixed values: sections of the report, titles by which text names them, classes of warnings ---
SECTIONS = ("kcbh", "kcmb", "jxnr", "jxap", "jxap_sz", "khfsb")
SECTION_LABELS = {"kcbh": "课程编号", "kcmb": "课程目标", "jxnr": "教学内容", "jxap": "教学安排", "jxap_sz": "教学安排·思政列", "khfsb": "考核方式"}
SECTION_TITLES = {"kcmb": ("课程目标", "教学目标"), "jxnr": ("教学内容", "课程内容"), "jxap": ("教学安排", "课程安排", "授课安排", "教学进度"), "khfsb": ("考核方式", "课程考核", "成绩评定"), "kcyq": ("课程要求", "学习要求")}
TABLE_SECTIONS = ("jxnr", "jxap", "khfsb")
CLASSES = ("truly_missing", "lost_in_conversion", "false_alarm", "review_content", "review_structure")
#: Counters of a section, in the order of the report.
COUNTERS = ("middle", "md", "loose", "strict", "pdf", "middle_md", "middle_md_loose", "middle_md_strict", "pdf_middle", "md_only", "middle_only")


def _substantive(text: str) -> bool:
    squeezed = "".join((text or "").split())
    return len(squeezed) >= 2 and squeezed.lower() not in config.EMPTY_MARKERS


def section_present(text: str, key: str) -> bool:
    """Whether a text has the section: the code's label near its beginning, or substantive lines below a title."""
    if not (text or "").strip() or key == "jxap_sz":
        return False
    if key == "kcbh":
        return T.flexible("课程编号").search(text[:8000]) is not None
    if key == "khfsb":
        return _substantive(T.assessment_section(text))
    for title in SECTION_TITLES[key]:
        body = T.section(text, (title,), ())
        at = text.find(title)
        if not body and at >= 0:
            body = text[at + len(title) : at + len(title) + 2000]
        lines = [x for x in (line.strip() for line in body.splitlines()) if x][:25]
        told = [x for x in lines if _substantive(x) and title not in x]
        if len(told) >= 2 or len("".join(told)) >= 8:
            return True
    return False


_FLAGS = "struct<" + ",".join(f"{k}:boolean" for k in SECTIONS) + ">"


@vectorised(_FLAGS)
def text_flags(text: pd.Series) -> pd.DataFrame:
    """A flag for each section of a text; null for null."""
    return pd.DataFrame([{k: section_present(t or "", k) for k in SECTIONS} for t in text], columns=list(SECTIONS))


def text_has(text: Column, key: str) -> Column:
    return F.coalesce(text_flags(text)[key], F.lit(False))


def raw_flags(raw: DataFrame) -> DataFrame:
    """(source_pdf, text, sections): raw records as their text to search and the sections that they have.

    Rows of a section's table count as the section, and so do a code, and a prose on assessment; other sections, where
    they have none, are looked for in the text.
    """
    values = lambda rows: F.flatten(F.transform(F.coalesce(rows, F.array().cast("array<map<string,string>>")), lambda r: F.map_values(r)))
    cn = F.coalesce("cn_data", F.create_map().cast("map<string,string>"))
    named = F.transform(F.map_entries(F.map_filter(cn, lambda k, v: F.coalesce(v, F.lit("")) != "")), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    parts = F.concat(F.array(F.coalesce("full_text", F.lit(""))), values(F.col("teaching_content")), values(F.col("course_schedule")), values(F.col("assessment_rows")), named)
    out = raw.where("error is null").select(F.col("source_path").alias("source_pdf"), C.normal_lines(F.array_join(parts, "\n")).alias("text"), "cn_data", "teaching_content", "course_schedule", "assessment_rows")
    flags = text_flags("text")
    own = {
        "kcbh": C.substantive(F.col("cn_data")["课程编号"]), "jxnr": F.size("teaching_content") > 0, "jxap": F.size("course_schedule") > 0,
        "jxap_sz": F.exists(payloads.promote_ideology(F.col("course_schedule")), lambda r: C.substantive(r["思政元素的融入和预期教学成效"])),
        "khfsb": (F.size("assessment_rows") > 0) | C.substantive(F.col("cn_data")["考核方式说明"]),
    }
    whole = ("jxap_sz", "khfsb")  # never by text alone
    flag = lambda k: F.coalesce(own[k], F.lit(False)) if k in whole else F.coalesce(own.get(k, F.lit(False)), F.lit(False)) | F.col("flags")[k]
    entries = F.map_from_arrays(F.array(*map(F.lit, SECTIONS)), F.array(*[flag(k) for k in SECTIONS]))
    return out.withColumn("flags", flags).select("source_pdf", "text", entries.alias("sections"))


def payload_has(p: Column, key: str, strict: bool = False) -> Column:
    """Loose: rows or overview; strict: rows, or a goal of its own."""
    if key == "kcbh":
        return C.substantive(p["jcxx"]["kcbh"])
    if key == "jxap_sz":
        return F.coalesce(F.exists(p["jxap"]["tm"], lambda r: C.substantive(r["szyqjxx"])), F.lit(False))
    if key == "kcmb":
        goals = C.substantive(p["kcmb"]["szmb"]) | C.substantive(p["kcmb"]["nlmb"]) | C.substantive(p["kcmb"]["zsmb"])
        return goals if strict else goals | C.substantive(p["kcmb"]["mbgs"])
    rows = F.coalesce(F.size(p[key]["tm"]) > 0, F.lit(False))
    return rows if strict else rows | C.substantive(p[key][payloads.OVERVIEW[key]])


def layers(manifest: DataFrame, extractions: DataFrame, middles: DataFrame, texts: DataFrame, markdown: DataFrame | None = None) -> DataFrame:
    """Manifest with the latest extraction, and text (and sections) of layout, Markdown and PDF, by ``source_pdf``.

    ``middles`` and ``markdown`` (source_pdf, text[, sections]); ``texts`` (source_pdf, text).
    """
    newest = R.latest(extractions, ["source_path"], [F.desc("created_at"), F.desc("extraction_id")]).select(F.col("source_path").alias("source_pdf"), "payload", "meta", "extraction_status")
    out = manifest.join(newest, "source_pdf", "left")
    for name, df in (("middle", middles), ("md", markdown), ("pdf", texts)):
        if df is not None:
            own = df if "sections" in df.columns else df.withColumn("sections", F.lit(None).cast("map<string,boolean>"))
            out = out.join(own.select("source_pdf", F.col("text").alias(f"{name}_text"), F.col("sections").alias(f"{name}_sections")), "source_pdf", "left")
    if markdown is None:
        out = out.withColumns({"md_text": F.lit(None).cast("string"), "md_sections": F.lit(None).cast("map<string,boolean>")})
    return out


def coverage_matrix(joined: DataFrame) -> DataFrame:
    """Section x counters over the layers and their agreements; sections in the report's order."""
    p = F.col("payload")
    for name in ("middle", "md", "pdf"):
        joined = joined.withColumn(f"{name}_flags", text_flags(f"{name}_text"))
    seen = lambda n: {k: F.coalesce(F.col(f"{n}_sections")[k], F.col(f"{n}_flags")[k], F.lit(False)) for k in SECTIONS}
    flags = {n: seen(n) for n in ("middle", "md", "pdf")}
    flags |= {"loose": {k: F.coalesce(payload_has(p, k), F.lit(False)) for k in SECTIONS}, "strict": {k: F.coalesce(payload_has(p, k, True), F.lit(False)) for k in SECTIONS}}
    both = lambda *names: {k: [f := flags[names[0]][k], *[f := f & flags[n][k] for n in names[1:]]][-1] for k in SECTIONS}
    flags |= {"middle_md": both("middle", "md"), "middle_md_loose": both("middle", "md", "loose"), "middle_md_strict": both("middle", "md", "strict"), "pdf_middle": both("pdf", "middle")}
    flags |= {"md_only": {k: flags["md"][k] & ~flags["middle"][k] for k in SECTIONS}, "middle_only": {k: flags["middle"][k] & ~flags["md"][k] for k in SECTIONS}}
    counted = R.coverage(joined, list(SECTIONS), {c: flags[c] for c in COUNTERS})
    return counted.orderBy(F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section")))


def layer_verdict(pdf: Column, md: Column, db: Column) -> Column:
    """How the layers agree on a thing; ``db`` null where there is no payload."""
    return (
        F.when(pdf & md & F.coalesce(db, F.lit(True)), "agree").when(pdf & md, "db_weaker").when(pdf & ~md & F.coalesce(db, F.lit(False)), "md_weaker")
        .when(pdf & ~md, "extraction_weak").otherwise("not_in_pdf")
    )


def verify(md: str | None, section: str, name: str, label: str, reason: str) -> str:
    """source_missing, extract_failure or uncertain: whether the section's part of the Markdown has what the warning misses."""
    structure = ("missing_required_columns", "unknown_columns", "continued_table_without_header", "suspiciously_few_rows", "text_row_low_confidence", "missing_teaching_method")
    if md is None:
        return "uncertain"
    titles = config.SECTION_HINTS.get(section, ()) + SECTION_TITLES.get(section, ())
    body = next((b for t in titles if (b := T.markdown_section(md, t))), "")
    told = G.body_has_content(body) or G.body_has_content(next((b for t in titles if (b := T.section(md, (t,)))), ""))
    either = lambda seen: "extract_failure" if seen else "source_missing"
    if reason in structure:
        return either(told or body.strip())
    if reason in ("validated_text_fallback_used", "empty_section"):
        return either(told)
    if reason != "missing_field":
        return "uncertain"
    names = (label, *config.LABEL_NAMES.get(label, ()))  # any of a field's names counts
    if section == "jcxx":
        return either(any(G.label_has_value(G.html_grids(body or md), n) for n in names))
    if section == "kcmb":
        return either(any(G.label_value_in_body(body or md, n) or G.label_has_value(G.html_grids(body), n) for n in names))
    if section in TABLE_SECTIONS:
        seen = any(G.column_has_data(G.html_grids(body), n) for n in names)
        return "extract_failure" if seen else "source_missing" if not told else "uncertain"
    return either(told) if section == "kcyq" else "uncertain"


@vectorised("string")
def verified(md: pd.Series, section: pd.Series, name: pd.Series, label: pd.Series, reason: pd.Series) -> pd.Series:
    return pd.Series([verify(*x) for x in zip(md, section.fillna(""), name.fillna(""), label.fillna(""), reason.fillna(""), strict=True)])


def root_cause(recognised: Column, verdict: Column) -> Column:
    """Class of a warning by what its source says and whether recognition has it."""
    return (
        F.when(verdict == "extract_failure", "false_alarm").when((verdict == "source_missing") & recognised, "lost_in_conversion").when(verdict == "source_missing", "truly_missing")
        .when(recognised, "review_content").otherwise("review_structure")
    )


def recognised_label(text: str | None, label: str, section: str) -> bool:
    """Whether recognised text names the label, by any of its names: in the head with a value for basic fields, else near a title."""
    return any(_recognised(text or "", n, section) for n in (label, *config.LABEL_NAMES.get(label or "", ())) if text and n)


def _recognised(text: str, label: str, section: str) -> bool:
    if section == "jcxx":
        head = text[:6000]
        return any(_substantive(head[m.end() : m.end() + 80]) for m in T.flexible(label).finditer(head) if head[m.end() :].lstrip()[:1] in ("：", ":"))
    titles = SECTION_TITLES.get(section, ())
    if not titles:
        return label in text
    for title in titles:
        at = text.find(title)
        near = text[at : at + 4000] if at >= 0 else ""
        if label in near:
            return _substantive(near[len(title) :]) if section in TABLE_SECTIONS else True
    return False


@vectorised("boolean")
def recognised(text: pd.Series, label: pd.Series, section: pd.Series) -> pd.Series:
    return pd.Series([recognised_label(*x) for x in zip(text, label.fillna(""), section.fillna(""), strict=True)])


def warning_classes(joined: DataFrame, markdown: DataFrame) -> DataFrame:
    """source_pdf, section, field, label, reason, verdict, class for every warning of a missing thing."""
    w = joined.select("source_pdf", "middle_text", F.explode(F.col("meta")["extraction_warnings"]).alias("w")).where(F.col("w.reason").isin("missing_field", "empty_section"))
    w = w.select("source_pdf", "middle_text", "w.section", "w.field", F.coalesce(F.nullif("w.label", F.lit("")), "w.field").alias("label"), "w.reason").join(markdown.select("source_pdf", "md_text"), "source_pdf", "left")
    w = w.withColumn("verdict", verified("md_text", "section", "field", "label", "reason"))
    return w.withColumn("class", root_cause(recognised("middle_text", "label", "section"), F.col("verdict"))).drop("middle_text", "md_text")


def warning_histogram(extractions: DataFrame) -> DataFrame:
    """(reason, severity, n) of all warnings."""
    return R.histogram(extractions.select(F.explode(F.col("meta")["extraction_warnings"]).alias("w")), reason=F.col("w.reason"), severity=F.col("w.severity"))


def false_rates(classes: DataFrame) -> DataFrame:
    """(reason, label, section) with its verdicts and the percent of false alarms, most frequent first."""
    kinds = ["source_missing", "extract_failure", "uncertain"]
    counted = classes.groupBy("reason", "label", "section").pivot("verdict", kinds).agg(F.count(F.lit(1)))
    counted = counted.select("reason", "label", "section", *[F.coalesce(F.col(k), F.lit(0)).alias(k) for k in kinds])
    total = F.col(kinds[0]) + F.col(kinds[1]) + F.col(kinds[2])
    return counted.withColumn("total", total).withColumn("false_rate", C.rate(F.col("extract_failure") * 100, "total", 1)).orderBy(F.desc("total"), "reason", "label", "section")


def most_frequent(classes: DataFrame, kind: str, n: int | None = None) -> DataFrame:
    """Labels of a class of warnings, most frequent first, ties by label, zeros dropped."""
    counted = classes.where(F.col("class") == kind).groupBy("label").agg(F.count("*").alias("n"))
    return R.newest(counted, [F.desc("n"), F.asc("label")], n)


def root_samples(classes: DataFrame, n: int = 3) -> DataFrame:
    """Classes with their number and the first documents of each."""
    return R.samples(classes.select("class", "source_pdf").distinct(), ["class"], "source_pdf", n)


def markdown_report(title: str, tables: dict[str, DataFrame]) -> str:
    """K9: Markdown tables of small aggregates: sections, classes and labels, all of their rows."""
    out = [f"# {title}"]
    for name, df in tables.items():
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in df.collect()]
    return "\n".join(out) + "\n"


def summary(tables: dict[str, DataFrame], **counts: int) -> str:
    """K9: the same aggregates and the report's counts as one JSON object."""
    rows = {name: [r.asDict(recursive=True) for r in df.collect()] for name, df in tables.items()}
    return json.dumps({"generated_at": datetime.now(UTC).strftime("%Y-%m-%d %H:%M UTC"), **counts, **rows}, ensure_ascii=False, indent=2, default=str)
