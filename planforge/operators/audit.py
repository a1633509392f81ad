"""Audit rules: one wide row for each subject, every rule an array of findings, exploded once.  No shuffle.

A finding: ord, section, field, path, status, reason, message, expected, actual, evidence, suggestion.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from contextvars import ContextVar
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import columns as C
from ..functions import places as L
from ..functions import text as T
from ..functions.weeks import schedule_weeks
from . import relational as R

FIELDS = ("section", "field", "path", "status", "reason", "message", "expected", "actual", "evidence", "suggestion")
#: Fields that the rules themselves ask for: what failed already, and which dimension a finding is of.
KEYS = ("section", "field", "path", "status")
#: Fields that are made while rules are written; the others are null.
_made: ContextVar[frozenset[str]] = ContextVar("made", default=frozenset(FIELDS))
#: Whether findings that pass are made; without them, rules give null in their place.
_passed: ContextVar[bool] = ContextVar("passed", default=True)
FINDING = "struct<section:string,field:string,path:string,status:string,reason:string,message:string,expected:string,actual:string,evidence:string,suggestion:string>"


class _Struct:
    """Fields of a struct column by name; the column is made on use, when there is a session."""

    def __init__(self, name: str):
        self.name = name

    def __getitem__(self, field: str) -> Column:
        return F.col(self.name)[field]


P, M = _Struct("payload"), _Struct("meta")


def _lit(x: Column | str | None) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def finding(section: Column | str, name: Column | str, path: Column | str, status: Column | str, message: Column | str, expected: Column | None = None, actual: Column | None = None, evidence: Column | None = None, suggestion: Column | str = "", reason: Column | None = None) -> Column:
    """The reason of what is not passed is the message, unless it is given."""
    message, none, made = _lit(message), F.lit(None).cast("string"), _made.get()
    unless = lambda x: F.when(status == "pass", "").otherwise(x) if isinstance(status, Column) else F.lit("") if status == "pass" else x
    values = {
        "section": _lit(section), "field": _lit(name), "path": _lit(path), "status": _lit(status), "reason": unless(message if reason is None else reason), "message": message,
        "expected": none if expected is None else expected.cast("string"), "actual": none if actual is None else actual.cast("string"), "evidence": none if evidence is None else evidence,
        "suggestion": unless(_lit(suggestion)),
    }
    return F.struct(*[(values[k] if k in made else none).alias(k) for k in FIELDS])


def judged(bad: Column, failed: Column, passed: Callable[[], Column]) -> Column:
    """One of two findings; null for the one that passes, where such are not made."""
    return F.when(bad, failed).otherwise(passed()) if _passed.get() else F.when(bad, failed)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: the expression does not grow with the number of its uses."""
    return F.transform(F.array(value), use)[0]


def each(items: list[dict], make: Callable[[dict], Column]) -> Column:
    """Array of one finding for each item.  Written out, not a ``transform`` of an array of structs: what is fixed of a finding
    is then a constant, and the rest has generated code."""
    return F.array(*[make(item) for item in items])


def presence(x: dict) -> Column:
    """Finding of x (section, field, path, label, value, blank): fails where the value is blank."""
    own = lambda status, message: finding(x["section"], x["field"], x["path"], status, message, actual=x["value"], suggestion=f"检查 PDF 中{x['label']}是否填写，或调整抽取模板。")
    return judged(x["blank"], own("fail", f"{x['label']}为空"), lambda: own("pass", f"{x['label']}已填写。"))


def _field(section: str, name: str, path: Column | str, label: str, value: Column, blank: Column | None = None) -> dict[str, Column | str]:
    value = value.cast("string")
    return {"section": section, "field": name, "path": path, "label": label, "value": value if "actual" in _made.get() else F.lit(None).cast("string"), "blank": C.is_blank(value) if blank is None else blank}


def compared(x: dict) -> Column:
    """Finding of x (own, other, label, a, b, alike, counts): both blank, blank here, blank there, equal (``alike``, or, where
    the field ``counts``, as numbers), unequal, or no course."""
    own, label = x["own"], x["label"]

    def of(a: Column, b: Column) -> Column:
        matched, equal = F.col("match_status") == "matched", a == b
        if x["alike"] is not None:
            equal = equal | x["alike"](a, b)
        if x["counts"]:
            equal = equal | F.coalesce(C.number(a) == C.number(b), F.lit(False))
        told = lambda status, message: finding("jcxx", own, f"payload.jcxx.{own}", status, message, expected=b, actual=a, evidence=F.lit(json.dumps({"course_field": x["other"]}, separators=(",", ":"))), suggestion=F.when(~matched, "先确认该 PDF 对应的课程库记录。").otherwise(f"请核对 PDF 和课程库中的{label}。"))
        message = (
            F.when(~matched, f"无法定位课程库记录，不能判断{label}是否一致").when((a == "") & (b == ""), f"PDF 和课程库中的{label}都为空").when(a == "", f"{label}为空")
            .when(b == "", f"课程库中{label}为空").otherwise(F.concat(F.lit(f"{label}与课程库不一致：课程库为 "), b, F.lit("，PDF 为 "), a))
        )
        return judged(~F.coalesce(matched & (a != "") & (b != "") & equal, F.lit(False)), told("fail", message), lambda: told("pass", f"{label}与课程库一致。"))

    return of(x["a"], x["b"])


def comparisons(exact: Callable[[str, Column], Column] | None = None) -> Column:
    """The 15 basic fields against the library's; numbers by value, names in their normal form.

    ``exact`` names the columns that hold the stripped values, where they are made before.
    """
    exact = exact or (lambda name, value: C.exact(value))

    def alike(form: Callable) -> Callable[[Column, Column], Column]:
        return lambda a, b: (form(a) != "") & (form(a) == form(b))

    items = []
    for own, other in config.COMPARED:
        same = alike(T.normal_english_name if own == "ywkcmc" else T.normal_name) if own in config.NAME_FIELDS else None
        items.append({"own": own, "other": other, "label": config.LABEL_OF[own], "a": exact(f"_own_{own}", P["jcxx"][own]), "b": exact(f"_library_{own}", F.col("course")[other]), "alike": same, "counts": own in config.NUMERIC_FIELDS})
    return each(items, compared)


def hours_formula() -> Column:
    """weekly hours x weeks = total; null where one of them is blank."""
    keys = ("zxs", "skzs", "zongxs")

    def of(x: Column) -> Column:
        text, n = x["t"], x["n"]
        product = n["zxs"] * n["skzs"]
        counts = n["zxs"].isNotNull() & n["skzs"].isNotNull() & n["zongxs"].isNotNull()
        parts = F.concat(F.lit("总学时为 "), text["zongxs"], F.lit("，周学时 "), text["zxs"], F.lit(" × 上课周数 "), text["skzs"])
        unread = F.concat(F.lit("总学时、周学时或上课周数不是可计算数字：总学时为 "), text["zongxs"], F.lit("，周学时为 "), text["zxs"], F.lit("，上课周数为 "), text["skzs"])
        right = counts & (product == n["zongxs"])
        message = F.when(~counts, unread).otherwise(F.concat(F.lit("总学时不等于周学时乘以上课周数："), parts, F.lit(" = "), C.number_text(product)))
        told = lambda status, message: finding("jcxx", "zongxs", "payload.jcxx.zongxs", status, message, expected=C.number_text(product), actual=text["zongxs"], suggestion="请核对 PDF 中总学时、周学时和上课周数是否一致。")
        filled = (text["zxs"] != "") & (text["skzs"] != "") & (text["zongxs"] != "")
        return F.when(filled, judged(~right, told("fail", message), lambda: told("pass", "总学时等于周学时乘以上课周数。")))

    texts = F.struct(*[C.exact(P["jcxx"][k]).alias(k) for k in keys])
    numbers = let(texts, lambda t: F.struct(t.alias("t"), F.struct(*[C.number(t[k]).alias(k) for k in keys]).alias("n")))
    return let(numbers, of)


def basic_info() -> Column:
    """The match, 15 compared fields, the hours formula and three contacts."""
    reason = C.labelled("match_status", config.MATCH_FAILURES)
    lost = F.when(F.col("match_status") != "matched", finding("jcxx", "course_match", "courses", "fail", reason, expected=F.col("match_status"), actual=F.col("source_path"), suggestion="请人工核对 PDF 文件名、课程编号、课程名称与课程库记录。"))
    contacts = each([_field("jcxx", k, f"payload.jcxx.{k}", config.LABEL_OF[k], P["jcxx"][k]) for k in config.CONTACT_FIELDS], presence)
    stripped = lambda name, value: F.col(name)
    return F.concat(F.array(lost), comparisons(stripped), F.array(hours_formula()), contacts)


def required() -> Column:
    """R2: top-level fields, section fields, requirements and every cell of the rows, with their positions in the path."""
    single = [_field("payload", k, f"payload.{k}", label, P[k]) for k, label in config.TOP_LEVEL.items()]
    single += [_field("kcmb", k, f"payload.kcmb.{k}", label, P["kcmb"][k]) for k, label in config.GOALS.items()]
    single += [_field(s, "tm", f"payload.{s}.tm", label, F.when(F.size(P[s]["tm"]) > 0, F.to_json(P[s]["tm"])), ~F.coalesce(F.size(P[s]["tm"]) > 0, F.lit(False))) for s, label in config.TABLE_ITEMS.items()]
    blank = C.is_blank(P["kcyq"])
    told = lambda status, message: finding("kcyq", "content", "payload.kcyq", status, message, actual=P["kcyq"], suggestion="补充课程要求，或检查 PDF 模板中课程要求章节是否可识别。", reason=F.lit("课程要求为空"))
    asked = judged(blank, told("fail", "课程要求为空，未抽取到文本。"), lambda: told("pass", "课程要求已填写。"))
    rows = [F.flatten(F.coalesce(F.transform(P[s]["tm"], _row_cells(s, fields)), F.array().cast(f"array<array<{FINDING}>>"))) for s, fields in config.ROW_REQUIRED.items()]
    return F.concat(each(single, presence), F.array(asked), *rows)


def _row_cells(section: str, fields: dict[str, str]):
    def cells(row: Column, i: Column) -> Column:
        path = lambda k: F.concat(F.lit(f"payload.{section}.tm["), i.cast("string"), F.lit(f"].{k}"))
        return _cells(row, fields, each([_field(section, k, path(k), label, row[k]) for k, label in fields.items()], presence))

    return cells


def _cells(row: Column, fields: Iterable[str], findings: Column) -> Column:
    """Findings of a row's cells; where those that pass are not made, none of a row without a blank cell."""
    if _passed.get():
        return findings
    return F.when(reduce(lambda a, b: a | b, [C.is_blank(row[k]) for k in fields]), findings).otherwise(F.array().cast(f"array<{FINDING}>"))


def extraction_warnings(existing: Column) -> Column:
    """Warnings as findings; a missing field that already failed, by path or by section and field, is not repeated."""
    failed = F.filter(existing, lambda f: f["status"].isin("fail", "error", "manual_review"))

    def one(w: Column, i: Column) -> Column:
        section, name = F.coalesce(F.nullif(w["section"], F.lit("")), F.lit("system")), F.coalesce(F.nullif(w["field"], F.lit("")), F.lit("warning"))
        reason = F.coalesce(F.nullif(w["reason"], F.lit("")), F.lit("extraction_warning"))
        path = F.coalesce(F.nullif(w["path"], F.lit("")), F.concat(F.lit("meta.extraction_warnings["), i.cast("string"), F.lit("]")))
        missing = reason.isin("missing_field", "empty_section")
        label = F.coalesce(F.nullif(w["label"], F.lit("")), name)
        message = F.coalesce(F.nullif(w["detail"], F.lit("")), F.concat(label, F.lit("存在抽取问题："), C.labelled(reason, config.WARNING_WORDS), F.lit("。")))
        seen = F.exists(failed, lambda f: (f["path"] == path) | ((f["section"] == section) & (f["field"] == name)))
        return F.when(~(missing & seen), finding(section, name, path, F.when(missing, "fail").otherwise("warning"), message, actual=F.to_json(w), suggestion="复核 PDF 原文和抽取结果。"))

    return F.coalesce(F.array_compact(F.transform(M["extraction_warnings"], one)), F.array().cast(f"array<{FINDING}>"))


def hour_consistency() -> list[Column]:
    """The two totals, and the rows' sum against the content's total."""
    basic, content = C.first_integer(P["jcxx"]["zongxs"]), C.first_integer(P["jxnr"]["zongxs"])
    numbers = F.filter(F.transform(P["jxnr"]["tm"], lambda r: C.first_integer(r["xs"])), lambda x: x.isNotNull())
    total = F.aggregate(numbers, F.lit(0), lambda a, x: a + x)
    text = lambda s, a, t, b: F.concat(F.lit(s), a.cast("string"), F.lit(t), b.cast("string"))
    return [
        F.when(basic != content, finding("jxnr", "zongxs", "payload.jxnr.zongxs", "fail", text("教学内容总学时与基础信息不一致：基础信息为 ", basic, "，教学内容为 ", content), basic, content, suggestion="核对课程总学时和教学内容章节的课时总计。")),
        F.when((F.size(numbers) > 0) & (total != content), finding("jxnr", "tm.xs", "payload.jxnr.tm[].xs", "fail", text("教学内容条目学时合计与总学时不一致：条目合计为 ", total, "，总学时为 ", content), content, total, suggestion="检查教学内容表是否有跨页漏录、合计行错位或学时填写错误。")),
    ]


def extraction_status() -> Column:
    """Partial is a warning, other states an error."""
    s = F.coalesce("extraction_status", F.lit(""))
    return F.when(~s.isin("", "success"), finding("system", "extraction_status", "extractions.extraction_status", F.when(s == "partial", "warning").otherwise("error"), F.concat(F.lit("PDF 抽取状态为 "), s), actual=s, suggestion="查看 meta.extraction_warnings 获取具体抽取问题。"))


def sources() -> Column:
    """M9: texts of the meta with their paths: full text, pages, unmapped segments."""
    labelled = lambda kind: lambda x, i: F.struct(F.concat(F.lit(f"meta.{kind}["), i.cast("string"), F.lit("]")).alias("source_path"), C.exact(x if kind == "raw_pages" else x["text"]).alias("text"))
    empty = F.array().cast("array<struct<source_path:string,text:string>>")
    every = F.concat(
        F.array(F.struct(F.lit("meta.full_text").alias("source_path"), C.exact(M["full_text"]).alias("text"))),
        F.coalesce(F.transform(M["raw_pages"], labelled("raw_pages")), empty), F.coalesce(F.transform(M["unmapped_segments"], labelled("unmapped_segments")), empty),
    )
    return F.filter(every, lambda s: s["text"] != "")


NUMBER = "struct<source:string,source_path:string,section_hint:string,raw_value:string,number:int,ambiguous:boolean,snippet:string>"


def semantic_numbers(asked: list[tuple[Column, Column, tuple[str, ...]]], sources: Column) -> Column:
    """R7, for each (payload's value, text around a section's hints, keywords): the payload's integer, else the first number
    behind a keyword near a hint, else, as ambiguous, behind one in a source's first 500 characters.

    Snippets go by source, hint and place; in a snippet the first keyword that has a number counts.
    """
    head = lambda s: F.struct(s["source_path"].alias("source_path"), F.lit("").alias("section_hint"), F.substring(s["text"], 1, 500).alias("snippet"), F.filter(s["places"], lambda p: p["at"] < 500).alias("places"))

    def one(value: Column, around: Column, keywords: tuple[str, ...]) -> Column:
        own, probe = C.first_integer(value), lambda s: L.numbered(s, L.words(keywords))
        payload = F.struct(F.lit("payload").alias("source"), F.lit(""), F.lit(""), C.exact(value), own, F.lit(False), F.lit("")).cast(NUMBER)
        told = lambda y, unsure: F.when(y.isNotNull(), F.struct(F.lit("payload" if unsure else "meta").alias("source"), y["source_path"], y["section_hint"], y["raw_value"], (F.lit(None).cast("int") if unsure else C.first_integer(y["raw_value"])).alias("number"), F.lit(unsure).alias("ambiguous"), y["snippet"]).cast(NUMBER))
        near = let(L.first_found(around, probe), lambda y: told(y, False))
        loose = let(L.first_found(F.transform(sources, head), probe), lambda y: told(y, True))
        return F.when(own.isNotNull(), payload).otherwise(F.coalesce(near, loose, payload))

    return F.array(*[one(v.cast("string"), n, w) for v, n, w in asked])


def _unsure(label: str, x: Column) -> Column:
    """Why a total found without a section around it is not taken."""
    quoted = F.concat(F.lit(f"{label}为空；原文中的“"), F.coalesce(F.nullif(x["raw_value"], F.lit("")), F.lit("总学时")), F.lit("”"))
    of_basics = "属于课程学时安排或基础信息，不是教学内容课时总计，因此不能判定学时匹配。" if label.startswith("教学内容") else "属于课程学时安排或基础信息，不能确认该字段已填写。"
    return F.when(x["ambiguous"], F.concat(quoted, F.when(x["snippet"].rlike("课程学时安排|周学时|上课周数"), of_basics).otherwise(f"没有明确归属，不能确认是{label}。")))


def _absent(label: str, x: Column) -> Column:
    return F.when(x["number"].isNull() & ~x["ambiguous"], F.when(x["raw_value"] == "", f"{label}为空").otherwise(f"{label}不是可计算数字"))


def content_hours() -> Column:
    """Total hours of content and basics, with where each was found."""
    a, b = F.col("_basic_total"), F.col("_content_total")
    same_place = (a["source"] == "meta") & (b["source"] == "meta") & (a["source_path"] == b["source_path"]) & (a["snippet"] == b["snippet"])
    issues = F.array_compact(F.array(_unsure("基础信息总学时", a), _unsure("教学内容总学时", b), _absent("基础信息总学时", a), _absent("教学内容总学时", b), F.when(same_place, "基础信息总学时和教学内容总学时引用了同一处原文数值，无法确认该数值同时代表教学内容课时总计，需人工复核。")))
    unequal = F.concat(F.lit("教学内容总学时与基础信息总学时不一致：基础信息为 "), a["number"].cast("string"), F.lit("，教学内容为 "), b["number"].cast("string"))
    reasons = let(issues, lambda i: F.when(F.size(i) > 0, i).when(a["number"] != b["number"], F.array(unequal)).otherwise(F.array().cast("array<string>")))
    return _dimension("jxnr", "zongxs", "payload.jxnr.zongxs", reasons, "教学内容总学时与基础信息总学时一致。", F.to_json(F.struct(a.alias("jcxx_zongxs"), b.alias("jxnr_zongxs"))), "请核对基础信息和教学内容中的总学时填写是否一致。")


def _dimension(section: str, name: str, path: str, reasons: Column, fine: str, evidence: Column, suggestion: str) -> Column:
    told = lambda status, message: finding(section, name, path, status, message, evidence=evidence, suggestion=suggestion)
    return let(reasons, lambda r: judged(F.size(r) > 0, told("fail", F.array_join(F.array_distinct(r), "；")), lambda: told("pass", fine)))


def weeks() -> Column:
    """The last scheduled week must be the number of weeks taught; gaps and repeats are evidence."""
    taught, found = F.col("_weeks_taught"), F.col("_weeks")
    last = F.array_max(found["weeks"])
    none = F.size(found["weeks"]) == 0
    unequal = F.concat(F.lit("教学安排最大周次为 "), last.cast("string"), F.lit("，基础信息上课周数为 "), taught["number"].cast("string"))
    issues = F.array_compact(F.array(F.when(taught["number"].isNull(), F.when(taught["raw_value"] == "", "基础信息上课周数为空").otherwise("基础信息上课周数不是可计算数字")), F.when(none, "教学安排周次为空，无法判断最大周次是否匹配")))
    reasons = F.concat(issues, found["errors"], F.array_compact(F.array(F.when(last != taught["number"], unequal))))
    gaps = C.missing_numbers(found["weeks"], F.coalesce(last, F.lit(0)))
    return _dimension("jxap", "zs", "payload.jxap.tm[].zs", reasons, "教学安排最大周次与基础信息上课周数一致。", F.to_json(F.struct(taught.alias("jcxx_skzs"), found.alias("schedule_weeks"), gaps.alias("missing_weeks"))), "请核对教学安排中的最大周次是否与基础信息上课周数一致。")


#: Words whose places in the sources are asked for.
WORDS = tuple(dict.fromkeys(w for group in (*config.SECTION_HINTS.values(), *config.TOTAL_KEYWORDS.values(), config.BASIC_FIELDS, config.TOP_LEVEL.values(), config.GOALS.values()) for w in group))


SECTIONS = tuple(config.SECTION_HINTS)


def _near(section: str) -> Column:
    """The text around the section's hints, from ``prepared``."""
    return F.col("_near")[SECTIONS.index(section)]


def _told(hit: Column, reason: Column | str) -> Column:
    """A hit as JSON, or, where no evidence is made, as a mark; null without."""
    if "evidence" not in _made.get():
        return F.when(hit.isNotNull(), "")
    return let(hit, lambda x: F.when(x.isNotNull(), F.to_json(F.struct(F.lit(True).alias("fallback_used"), x["source_path"].alias("source_path"), x["section_hint"].alias("section_hint"), x["raw_value"].alias("raw_value"), x["snippet"].alias("snippet"), _lit(reason).alias("reason")))))


def label_near(near: Column, labels: tuple[str, ...], with_value: bool) -> Column:
    """Where a label stands (with something behind it) near a hint of its section, as JSON; null if nowhere."""
    reason = "payload_empty_meta_found" if with_value else "payload_key_missing_meta_label_found"
    return _told(L.first_found(near, lambda s: L.labelled(s, L.words(labels), F.lit(with_value))), reason)


def _in_sources(words: Iterable[str]) -> Column:
    """Whether one of the words stands in a source at all: most do not, and are then not looked for near hints."""
    return reduce(lambda a, b: a | b, [F.contains(F.col("_whole"), F.lit(w)) for w in words])


def table_near(section: str, labels: tuple[str, ...]) -> Column:
    """Text near a hint of the section that looks like its table: two or three of its labels, and a numbered row."""
    least = max(2, min(len(labels), 3))

    def looks(s: Column) -> Column:
        named = F.filter(L.words(labels), lambda x: F.contains(s["snippet"], x))
        return let(named, lambda n: F.when((F.size(n) >= least) & s["snippet"].rlike(r"(?U)\d+\s*[、.．\s]|第|主题|授课"), F.array_join(n, "、")))

    return _told(L.first_found(_near(section), looks), "payload_empty_meta_found")


def section_content(section: str, least: int = 8) -> Column:
    """Text near a hint of the section that says more than its titles."""
    said = lambda s: let(C.without_titles(s["snippet"], config.SECTION_HINTS[section]), lambda t: F.when(F.length(t) >= least, t))
    return _told(L.first_found(_near(section), said), "payload_empty_meta_found")


def section_titles(sources: Column, hints: Column) -> Column:
    """R10, for each section's hints: the first source with a title of it, as JSON, or, where no evidence is made, a mark;
    null without."""
    if "evidence" not in _made.get():
        return F.array(*[F.when(_in_sources(config.SECTION_HINTS[k]), "") for k in SECTIONS])

    def one(own: Column) -> Column:
        hit = F.transform(sources, lambda s: F.struct(s["source_path"].alias("source_path"), L.first(F.filter(own, lambda h: F.size(L.of(s["places"], h)) > 0)).alias("section_hint")))
        return let(L.first(F.filter(hit, lambda x: x["section_hint"].isNotNull())), lambda x: F.when(x.isNotNull(), F.to_json(F.struct(F.lit(False).alias("fallback_used"), x["source_path"].alias("source_path"), x["section_hint"].alias("section_hint"), x["section_hint"].alias("snippet"), F.lit("meta_title_only").alias("reason")))))

    return F.transform(hints, one)


def element(x: dict) -> Column:
    """Finding of x (section, field, path, label, value, blank, near, labels, title): what the payload lacks may stand in the original."""
    blank, title, label = x["blank"], x["title"], x["label"]
    told = lambda status, message, evidence: finding(x["section"], x["field"], x["path"], status, message, actual=x["value"], evidence=evidence, suggestion=f"检查 PDF 中{label}是否填写，或调整抽取模板。")
    lacking = told("fail", F.when(title.isNotNull(), f"{label}为空；原文辅助信息中只有章节标题，没有该字段的填写内容").otherwise(f"{label}为空"), title)
    sought = let(label_near(x["near"], x["labels"], True), lambda rescue: judged(rescue.isNull(), lacking, lambda: told("pass", f"{label}在原文辅助信息中存在", rescue)))
    missed = F.when(_in_sources(x["labels"]), sought).otherwise(lacking)
    return judged(blank, missed, lambda: told("pass", f"{label}已填写", None))


def keyed(x: dict) -> Column:
    """Finding of x (field, path, label, value, here, near, labels): the key must be there, in the payload or in the original."""
    label = x["label"]
    finds = lambda status, message, evidence: finding("jcxx_template", x["field"], x["path"], status, message, actual=x["value"], evidence=evidence, suggestion=f"检查 PDF 课程基本信息中是否包含{label}字段。")
    lacking = finds("fail", f"{label}字段缺失", None)
    sought = let(label_near(x["near"], x["labels"], False), lambda told: judged(told.isNull(), lacking, lambda: finds("pass", f"{label}字段在原文辅助信息中存在，允许为空", told)))
    return judged(~x["here"], F.when(_in_sources(x["labels"]), sought).otherwise(lacking), lambda: finds("pass", f"{label}字段存在，允许为空", None))


def template() -> Column:
    """The template's elements: two summaries, then basic fields (four need their key only), top-level fields, goals,
    the two tables row by row, and the requirements.  A blank one passes where the original text has it."""
    def item(section: str, hints: str, name: str, path: str, label: str, value: Column, labels: tuple[str, ...] = ()) -> dict:
        return {**_field(section, name, path, label, value), "here": value.isNotNull(), "near": _near(hints), "labels": labels or (label,), "title": F.col("_titles")[SECTIONS.index(hints)]}

    jcxx = P["jcxx"]
    basics = [item("jcxx_template", "jcxx", k, f"payload.jcxx.{k}", label, jcxx[k]) for label, k in config.BASIC_FIELDS.items() if k not in config.KEY_PRESENT_FIELDS]
    may_be_empty = [item("jcxx_template", "jcxx", k, f"payload.jcxx.{k}", config.LABEL_OF[k], jcxx[k]) for k in config.KEY_PRESENT_FIELDS]
    rest = [item("payload", k, k, f"payload.{k}", label, P[k]) for k, label in config.TOP_LEVEL.items()]
    rest += [item("kcmb", "kcmb", k, f"payload.kcmb.{k}", label, P["kcmb"][k]) for k, label in config.GOALS.items()]
    rest.append(item("jxnr", "jxnr", "zongxs", "payload.jxnr.zongxs", "教学内容总学时", P["jxnr"]["zongxs"], ("总学时", "合计")))
    tables = []
    for section, fields in config.TEMPLATE_ROWS.items():
        rows, name = P[section]["tm"], config.TEMPLATE_TABLES[section]
        told = table_near(section, tuple(fields.values()))
        whole = lambda status, message, evidence, section=section, name=name, fields=fields: finding(section, "tm", f"payload.{section}.tm", status, message, evidence=evidence, suggestion=f"补齐{name}，至少包含{'、'.join(fields.values())}。")
        none = let(told, lambda t: judged(t.isNull(), whole("fail", f"{name}为空", None), lambda: whole("pass", f"{name}在原文辅助信息中存在。", t)))
        tables.append(F.when(F.size(rows) > 0, F.flatten(F.transform(rows, _template_row(section, fields)))).otherwise(F.array(none)))
    wanted = C.is_blank(P["kcyq"])
    asked = lambda status, message, evidence: finding("kcyq", "content", "payload.kcyq", status, message, evidence=evidence, suggestion="补齐课程要求文本。")
    sought = let(section_content("kcyq"), lambda t: judged(t.isNull(), asked("fail", "课程要求为空", None), lambda: asked("pass", "课程要求在原文辅助信息中存在。", t)))
    last = judged(wanted, sought, lambda: asked("pass", "课程要求已填写", None))
    return F.concat(each(basics, element), each(may_be_empty, keyed), each(rest, element), *tables, F.array(last))


#: Columns of the reasons that the two checks give.
CHECKS = {name: f"_check_{name}" for name in config.TEMPLATE_CHECKS}


def template_checks(found: Column) -> dict[str, Column]:
    """Reasons of the two checks over the template's findings: of all elements, and of both introductions."""
    failed = F.filter(found, lambda f: f["status"] == "fail")
    bad = {"mbxxyzwz": failed, "zywjj": F.filter(failed, lambda f: f["path"].isin("payload.kczwjj", "payload.kcywjj"))}
    return {CHECKS[k]: F.array_distinct(F.transform(v, lambda f: f["reason"])) for k, v in bad.items()}


def template_summary() -> Column:
    """The two checks, from ``template_checks``."""
    def check(name: str) -> Column:
        reasons = F.col(CHECKS[name])
        told = lambda status, message: finding("xxyzwzfhmb", name, f"audit_findings.xxyzwzfhmb.details.checks.{name}", status, message, expected=F.lit(config.TEMPLATE_CHECKS[name]))
        return judged(F.size(reasons) > 0, told("fail", F.array_join(reasons, "；")), lambda: told("pass", "是"))
    return F.array(check("mbxxyzwz"), check("zywjj"))


def _template_row(section: str, fields: dict[str, str]):
    def cells(row: Column, i: Column) -> Column:
        at = (i + 1).cast("string")
        out = []
        for k, label in fields.items():
            told = lambda status, message, k=k, label=label: finding(section, k, F.concat(F.lit(f"payload.{section}.tm["), i.cast("string"), F.lit(f"].{k}")), status, message, actual=row[k], suggestion=F.concat(F.lit(f"补齐{section}表第 "), at, F.lit(f" 行的{label}。")))
            out.append(judged(C.is_blank(row[k]), told("fail", F.concat(F.lit(f"{section}第 "), at, F.lit(f" 行{label}为空"))), lambda told=told, label=label: told("pass", f"{label}已填写")))
        return _cells(row, fields, F.array(*out))

    return cells


def prepared(matched: DataFrame) -> DataFrame:
    """Columns that several rules share: sources, the resolved numbers and the schedule's weeks."""
    df = matched.withColumn("_texts", sources())
    df = df.withColumns({"_sources": L.indexed(F.col("_texts"), WORDS), "_whole": F.array_join(F.col("_texts")["text"], "\n")})
    hints, words = config.SECTION_HINTS, config.TOTAL_KEYWORDS
    by_section = F.array(*[L.words(hints[k]) for k in SECTIONS])
    df = df.withColumns({"_near": F.transform(by_section, lambda h: L.around(F.col("_sources"), h)), "_titles": section_titles(F.col("_sources"), by_section)})
    numbers = semantic_numbers([(P["jcxx"]["zongxs"], _near("jcxx"), words["jcxx"]), (P["jxnr"]["zongxs"], _near("jxnr"), words["jxnr"]), (P["jcxx"]["skzs"], _near("jcxx"), words["skzs"])], F.col("_sources"))
    df = df.withColumn("_numbers", numbers).withColumns({"_basic_total": F.col("_numbers")[0], "_content_total": F.col("_numbers")[1], "_weeks_taught": F.col("_numbers")[2]})
    near = F.array_compact(F.transform("_sources", lambda s: F.nullif(F.regexp_extract(s["text"], rf"(?s)((?:{'|'.join(hints['jxap'])}).{{0,800}})", 1), F.lit(""))))
    cells = F.transform(P["jxap"]["tm"], lambda r: F.coalesce(r["zs"], F.lit("")))
    return df.withColumn("_weeks", schedule_weeks(cells, F.coalesce(P["jxap"]["apgs"], F.lit("")), near))


@dataclass(frozen=True)
class Auditor:
    """A plug-in.  ``run`` gives an array of findings over the prepared subjects' columns; the dimension fails if one does."""

    key: str
    run: Callable[[], Column]
    needs_model: bool = False


AUDITORS = {a.key: a for a in (Auditor("kcjbxxsfykckyz", basic_info), Auditor("jxnrsfyxspp", lambda: F.array(content_hours())), Auditor("jxapsfyzcpp", lambda: F.array(weeks())), Auditor("xxyzwzfhmb", template))}


def evaluate(subjects: DataFrame, auditors: tuple[str, ...] = tuple(AUDITORS), fields: Iterable[str] = FIELDS, passed: bool = True) -> DataFrame:
    """Matched subjects with ``findings`` (core rules in order) and ``dimensions`` (wd, status, message, reasons).

    ``fields`` names those of a finding that are read later; of the others only ``KEYS`` are made, and the rest are null.
    Reasons of dimensions need ``reason``.  Without ``passed`` the findings are those that do not pass, which is all that
    ``results`` and ``dimensions`` ask for.
    """
    made, kept = _made.set(frozenset((*KEYS, *fields))), _passed.set(passed)
    try:
        return _evaluated(subjects, auditors)
    finally:
        _made.reset(made)
        _passed.reset(kept)


def _evaluated(subjects: DataFrame, auditors: tuple[str, ...]) -> DataFrame:
    df = prepared(subjects)
    if "kcjbxxsfykckyz" in auditors:
        df = df.withColumns({**{f"_own_{own}": C.exact(P["jcxx"][own]) for own, _ in config.COMPARED}, **{f"_library_{own}": C.exact(F.col("course")[other]) for own, other in config.COMPARED}})
    by_wd = {k: AUDITORS[k].run() for k in auditors if k in AUDITORS}
    empty = F.array().cast(f"array<{FINDING}>")
    # arrays are made with places for findings that are not there; a filter in the same expression would keep it from having generated code
    df = df.withColumns({**{f"_f_{k}": v for k, v in by_wd.items()}, "_required": required()})
    core = [F.col(f"_f_{k}") for k in ("kcjbxxsfykckyz", "jxnrsfyxspp", "jxapsfyzcpp") if k in by_wd]
    df = df.withColumns({"_first": F.concat(*(core or [empty]), F.col("_required")), **(template_checks(F.col("_f_xxyzwzfhmb")) if "xxyzwzfhmb" in by_wd else {})})
    last = F.concat(template_summary(), F.col("_f_xxyzwzfhmb")) if "xxyzwzfhmb" in by_wd else empty
    every = F.array_compact(F.concat(F.col("_first"), extraction_warnings(F.col("_first")), F.array(*hour_consistency(), extraction_status()), last))
    def dimension(k: str) -> Column:
        own = F.filter(F.col(f"_f_{k}"), lambda f: (f["status"] != "pass") & (f["section"] != k))  # summaries repeat reasons
        def of(why: Column) -> Column:
            bad, all_ = F.size(why) > 0, F.concat("match_reasons", F.array("match_message"), why) if k == "kcjbxxsfykckyz" else why
            reasons = F.when(bad, F.array_distinct(F.filter(all_, lambda r: r != ""))).otherwise(F.array().cast("array<string>"))
            return F.struct(F.lit(k).alias("wd"), F.when(bad, "fail").otherwise("pass").alias("status"), F.when(bad, "否").otherwise("是").alias("message"), reasons.alias("reasons"))
        return let(F.transform(own, lambda f: f["reason"]), of)
    out = df.withColumn("findings", every).withColumn("dimensions", F.array(*[dimension(k) for k in by_wd]) if by_wd else F.array())
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def field_findings(evaluated: DataFrame) -> DataFrame:
    """One row for each finding, with its position.

    The outer form keeps the optimizer from pushing a filter on the array, with all rules in it, below every join.
    """
    return evaluated.select("subject_key", F.posexplode_outer("findings").alias("ord", "f")).where("f is not null").select("subject_key", "ord", "f.*")


def dimension_findings(evaluated: DataFrame) -> DataFrame:
    return evaluated.select("subject_key", F.explode_outer("dimensions").alias("d")).where("d is not null").select("subject_key", "d.*")


def with_findings(evaluated: DataFrame, judged: DataFrame) -> DataFrame:
    """``evaluated`` with the field findings of judged dimensions (subject_key, fields) behind its own."""
    more = judged.groupBy(F.col("subject_key").alias("_key")).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("wd", "fields"))), lambda x: x["fields"])).alias("_more"))
    joined = evaluated.join(more, F.col("subject_key") == F.col("_key"), "left")
    return joined.withColumn("findings", F.concat("findings", F.coalesce("_more", F.array().cast(f"array<{FINDING}>")))).drop("_key", "_more")


def results(evaluated: DataFrame) -> DataFrame:
    """Roll-up inside the row: fail_count, warning_count, overall_status, messages, reasons.

    Messages are the first 5 of what failed; reasons the first 20 of what failed or warned, repeated ones kept.
    """
    bad, told = F.filter("findings", lambda f: f["status"].isin("fail", "error", "manual_review")), F.filter("findings", lambda f: f["status"].isin("fail", "error", "manual_review", "warning") & (f["reason"] != ""))
    out = evaluated.withColumns({"_bad": bad, "_told": told, "_warned": F.size(F.filter("findings", lambda f: f["status"] == "warning"))})
    return out.select(
        "subject_key", "extraction_id", "course_code", "source_path", "match_status", "match_method", "match_code", F.size("_bad").alias("fail_count"), F.col("_warned").alias("warning_count"),
        R.verdict(F.col("extraction_status"), F.size("_bad"), F.col("_warned")).alias("overall_status"), F.slice("_bad", 1, 5)["message"].alias("messages"), F.slice("_told", 1, 20)["reason"].alias("reasons"),
    )


def match(subjects: DataFrame, courses: DataFrame) -> DataFrame:
    """Subjects with match columns, ``course``, the library's row of the matched code, and, as customers read them,
    ``match_message`` and ``match_reasons`` (J3, J4)."""
    named = subjects.withColumns({"_code": C.exact(F.coalesce(F.nullif(P["jcxx"]["kcbh"], F.lit("")), F.col("course_code"))), "_doc_name": C.exact(P["jcxx"]["zwkcmc"]), "_file_name": C.path_name("source_path")})
    found = R.match_cascade(R.shared_keys(named, "_code", "_shared"), courses, "_code", [("_doc_name", "document_name"), ("_file_name", "file_name")], "kcbh", "zwkcmc", duplicate="_shared")
    fields = [c for c in courses.columns if c != "course"]
    library = R.latest(courses, ["kcbh"], [F.col("kcbh")]).select(F.col("kcbh").alias("_k"), F.struct(*fields).alias("course"))
    out = found.join(library, F.col("match_code") == F.col("_k"), "left")
    filled = lambda text, name, value: F.concat(*[F.lit(x) if x != "\0" else value for x in text.replace(f"{{{name}}}", "\1\0\1").split("\1") if x])
    status, method, shared = F.col("match_status"), F.col("match_method"), F.col("match_shared")
    name = F.coalesce(F.nullif(C.exact(F.col("course.zwkcmc")), F.lit("")), C.exact(F.col("course.kcbh")))
    message = reduce(lambda c, x: c.when((status == "matched") & (method == x[0][0]) & (shared == x[0][1]), filled(x[1], "name", name)), config.MATCHED.items(), F.when(status == "ambiguous", config.MATCH_FAILURES["ambiguous"]).when(status == "not_found", config.MATCH_FAILURES["not_found"]))
    sought = F.array_compact(F.array(F.when(F.col("_code") == "", config.UNMATCHED["code"]), *[F.when(F.col(c) != "", filled(config.UNMATCHED[k], "query", F.col(c))) for c, k in (("_doc_name", "document_name"), ("_file_name", "file_name"))]))
    failed = F.when(status == "ambiguous", F.array(filled(config.AMBIGUOUS_NAME, "query", F.col("match_query")))).when(F.size(sought) == 0, F.array(F.lit(config.UNMATCHED["none"]))).otherwise(sought)
    reasons = F.when(status != "matched", failed).when(shared, F.array(F.when(method == "code", config.SHARED_CODE[False]).otherwise(config.SHARED_CODE[True]))).otherwise(F.array().cast("array<string>"))
    out = out.withColumns({"match_message": message, "match_reasons": reasons})
    return out.drop("_k", "_code", "_doc_name", "_file_name", "_shared")
