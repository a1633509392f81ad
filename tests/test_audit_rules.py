"""Rules that read the original text, against their statement in plain Python; reasons of matches as customers read them."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from planforge import config, schemas
from planforge.operators import audit

HINTS, WORDS = config.SECTION_HINTS, config.TOTAL_KEYWORDS


def snippets(sources, section):
    for path, text in sources:
        for hint in HINTS[section]:
            for m in re.finditer(re.escape(hint), text):
                yield path, hint, text[max(0, m.start() - 80) : m.end() + 800]


def number(value, section, words, sources):
    """(number, ambiguous, raw, path, snippet): rule R7."""
    own = re.search(r"\d+", value or "")
    if own:
        return int(own[0]), False, value, "", ""
    for pieces, unsure in ((snippets(sources, section), False), (((p, "", t[:500]) for p, t in sources), True)):
        for path, _, piece in pieces:
            for w in words:
                if m := re.search(rf"{w}\s*[:：]?\s*(\d+)", piece):
                    return (None if unsure else int(m[1])), unsure, m[0], path, piece[:500]
    return None, False, value or "", "", ""


def hours_reasons(basic, content, sources):
    """Rule R6."""
    out, found = [], []
    for label, value, section in (("基础信息总学时", basic, "jcxx"), ("教学内容总学时", content, "jxnr")):
        found.append((label, *number(value, section, WORDS[section], sources)))
    for label, _, unsure, raw, _, piece in found:
        if unsure:
            if re.search("课程学时安排|周学时|上课周数", piece):
                out.append(f"{label}为空；原文中的“{raw}”" + ("属于课程学时安排或基础信息，不是教学内容课时总计，因此不能判定学时匹配。" if label[0] == "教" else "属于课程学时安排或基础信息，不能确认该字段已填写。"))
            else:
                out.append(f"{label}为空；原文中的“{raw}”没有明确归属，不能确认是{label}。")
    out += [f"{label}为空" if not raw else f"{label}不是可计算数字" for label, n, unsure, raw, _, _ in found if n is None and not unsure]
    (_, a, _, _, p, s), (_, b, _, _, q, t) = found
    if p and q and p == q and s == t and not found[0][2] and not found[1][2]:
        out.append("基础信息总学时和教学内容总学时引用了同一处原文数值，无法确认该数值同时代表教学内容课时总计，需人工复核。")
    if not out and a != b:
        out.append(f"教学内容总学时与基础信息总学时不一致：基础信息为 {a}，教学内容为 {b}")
    return "；".join(out) or "教学内容总学时与基础信息总学时一致。"


def element(label, value, section, sources, labels=None):
    """(status, message): rules R9 and R10."""
    if (value or "").strip():
        return "pass", f"{label}已填写"
    for _, _, piece in snippets(sources, section):
        for w in labels or (label,):
            m = re.search(rf"{re.escape(w)}\s*[:：]?\s*([^\n\r；。]*)", piece)
            if m and m[1].strip():
                return "pass", f"{label}在原文辅助信息中存在"
    if any(h in t for _, t in sources for h in HINTS[section]):
        return "fail", f"{label}为空；原文辅助信息中只有章节标题，没有该字段的填写内容"
    return "fail", f"{label}为空"


def subjects():
    r = random.Random(8)
    bits = ["课程基本信息", "基本信息", "教学内容", "课程内容", "课程目标", "总学时", "课程总学时", "合计", "合计学时：", "小计", "上课周数 ", "周学时", "课程学时安排", "38", " 40", "：36", ":", "：", "\n", "；", "。", " ", "思政目标", "英文课程名称", "课程英文简介", "a" * 90, "b" * 300, "x" * 800, "课程要求", "认真听课不许迟到早退", "主题 知识点 序号 学时 1、", "序号", "授课内容", "教学安排", "授课方式"]
    rows = []
    for i in range(150):
        text = lambda: "".join(r.choice(bits) for _ in range(r.randint(0, 24)))
        basic, content = (r.choice([None, "", "38", "三十八", " 36 学时"]) for _ in range(2))
        payload = {"jcxx": {"zongxs": basic, "ywkcmc": r.choice([None, " ", "x"]), "zxs": r.choice(["2", "二", None]), "skzs": r.choice(["19", "18周", None])}, "jxnr": {"tm": [], "zongxs": content}, "jxap": {"tm": []}, "kcmb": {"szmb": r.choice([None, "a"])}, "kcyq": r.choice([None, "  ", "要求"])}
        meta = {"full_text": text(), "raw_pages": [text() for _ in range(r.randint(0, 2))], "unmapped_segments": [{"text": text()}]}
        rows.append((i, json.dumps(payload), json.dumps(meta)))
    two = "课程基本信息 总学时：38\n" + "x" * 900 + "教学内容 总学时：38"  # equal text at two places
    one = "课程基本信息与教学内容 总学时：38"
    rows += [(900, json.dumps({"jcxx": {}, "jxnr": {}}), json.dumps({"full_text": two})), (901, json.dumps({"jcxx": {}, "jxnr": {}}), json.dumps({"full_text": one})), (902, json.dumps({}), json.dumps({}))]
    rows.append((903, json.dumps({"jxnr": {}, "jcxx": {}}), json.dumps({"full_text": "教学内容 小计 5 合计：7 总学时 9 课程基本信息 课程总学时 8"})))
    return rows


@pytest.fixture(scope="module")
def found(spark):
    rows = subjects()
    df = spark.createDataFrame(rows, "id long, p string, m string").select("id", F.from_json("p", schemas.PAYLOAD).alias("payload"), F.from_json("m", schemas.META).alias("meta"))
    df = audit.prepared(df)
    out = df.select("id", audit.content_hours()["message"].alias("hours"), F.transform(audit.template(), lambda f: F.struct(f["path"], f["status"], f["message"], f["reason"], f["evidence"])).alias("elements"), audit.hours_formula()["message"].alias("formula"), "_near").collect()
    return {r.id: r for r in out}


def sources(meta):
    clean = lambda t: re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", t or "").strip()
    named = [("meta.full_text", meta.get("full_text"))] + [(f"meta.raw_pages[{i}]", t) for i, t in enumerate(meta.get("raw_pages", []))] + [(f"meta.unmapped_segments[{i}]", s["text"]) for i, s in enumerate(meta.get("unmapped_segments", []))]
    return [(p, clean(t)) for p, t in named if clean(t)]


def test_snippets_by_source_hint_and_place(found):
    for i, _, m in subjects():
        want = [list(snippets(sources(json.loads(m)), s)) for s in HINTS]
        assert [[(x.source_path, x.section_hint, x.snippet) for x in near] for near in found[i]._near] == want


def test_total_hours(found):
    for i, p, m in subjects():
        p = json.loads(p)
        assert found[i].hours == hours_reasons(p.get("jcxx", {}).get("zongxs"), p.get("jxnr", {}).get("zongxs"), sources(json.loads(m))), i
    assert "同一处原文" not in found[900].hours and "同一处原文" in found[901].hours
    assert found[903].hours.endswith("基础信息为 9，教学内容为 9") or "同一处" in found[903].hours  # the first keyword of the tuple, not of the text


def test_template_elements(found):
    for i, p, m in subjects():
        p, src = json.loads(p), sources(json.loads(m))
        got = {e["path"]: (e["status"], e["message"]) for e in found[i].elements}
        basic = p.get("jcxx", {})
        assert got["payload.jcxx.ywkcmc"] == element("英文课程名称", basic.get("ywkcmc"), "jcxx", src)
        assert got["payload.kcmb.szmb"] == element("思政目标", p.get("kcmb", {}).get("szmb"), "kcmb", src)
        assert got["payload.kcywjj"] == element("课程英文简介", None, "kcywjj", src)
        assert got["payload.jxnr.zongxs"] == element("教学内容总学时", p.get("jxnr", {}).get("zongxs"), "jxnr", src, ("总学时", "合计"))
        for section, name in config.TEMPLATE_TABLES.items():
            labels = config.TEMPLATE_ROWS[section].values()
            seen = any(sum(x in t for x in labels) >= 3 and (re.search(r"\d+\s*[、.．\s]", t) or any(k in t for k in ("第", "主题", "授课"))) for _, _, t in snippets(src, section))
            assert got[f"payload.{section}.tm"] == (("pass", f"{name}在原文辅助信息中存在。") if seen else ("fail", f"{name}为空"))
        body = [t for _, _, t in snippets(src, "kcyq") if len(t.replace("课程要求", "").strip()) >= 8]
        wanted = ("pass", "课程要求已填写") if (p.get("kcyq") or "").strip() else ("pass", "课程要求在原文辅助信息中存在。") if body else ("fail", "课程要求为空")
        assert got["payload.kcyq"] == wanted
        for e in found[i].elements:
            if e["evidence"] and json.loads(e["evidence"])["fallback_used"]:
                told = json.loads(e["evidence"])
                assert e["status"] == "pass" and told["snippet"] in [t[:500] for h in HINTS for _, _, t in snippets(src, h)] and told["source_path"] in dict(src)


def test_unreadable_hours(found):
    for i, p, _ in subjects():
        b = json.loads(p).get("jcxx", {})
        z, w, t = ((b.get(k) or "").strip() for k in ("zxs", "skzs", "zongxs"))
        if z and w and t and not all(re.fullmatch(r"\d+(\.\d+)?", x) for x in (z, w, t)):
            assert found[i].formula == f"总学时、周学时或上课周数不是可计算数字：总学时为 {t}，周学时为 {z}，上课周数为 {w}"


def test_reasons_of_matches(spark):
    empty = {f: None for f in schemas.struct(schemas.COURSES).names}
    library = [{**empty, "kcbh": k, "zwkcmc": n} for k, n in (("A1", "甲"), ("A2", "乙"), ("A3", "乙"), ("A4", ""))]
    courses = spark.createDataFrame([tuple(c.values()) for c in library], schemas.struct(schemas.COURSES))
    rows = [(1, "A1", "x", "丁.pdf"), (2, "Z", "甲", "丁.pdf"), (3, "", "乙", "丁.pdf"), (4, "", "丙", "甲.pdf"), (5, "S", "甲", "丁.pdf"), (6, "S", "", "甲.pdf"), (7, "A2", "丙", ""), (8, "A2", "", "丁.pdf"), (9, "", "丙", "丁.pdf"), (10, "", None, ""), (11, "A4", None, "")]
    df = spark.createDataFrame([(i, json.dumps({"jcxx": {"kcbh": c, "zwkcmc": n}}), p) for i, c, n, p in rows], "id long, p string, source_path string")
    df = df.select("id", "source_path", F.from_json("p", schemas.PAYLOAD).alias("payload"), F.lit("").alias("course_code"))
    got = {r.id: (r.match_message, r.match_reasons) for r in audit.match(df, courses).collect()}
    used = "本轮审核中存在多个 PDF 填写同一课程编号，已启用课程名称和文件名辅助定位审核对照课程。"
    assert got[1] == ("通过课程编号匹配到课程库课程：甲", []) and got[2] == ("通过 PDF 中的课程名称匹配到课程库课程：甲", []) and got[4] == ("通过文件路径匹配到课程库课程：甲", [])
    assert got[3] == ("文件路径或课程名称匹配到多条课程库记录，需人工复核", ["课程名称“乙”匹配到多条课程库记录，需人工复核"])
    assert got[5] == ("本轮审核中存在多个 PDF 填写同一课程编号，已根据 PDF 中的课程名称定位审核对照课程：甲", [used])
    assert got[6] == ("本轮审核中存在多个 PDF 填写同一课程编号，已根据文件名定位审核对照课程：甲", [used])
    kept = ("本轮审核中存在多个 PDF 填写同一课程编号，未能通过课程名称或文件名唯一定位其它课程，已按原课程编号定位审核对照课程：乙", ["本轮审核中存在多个 PDF 填写同一课程编号，但未能通过课程名称或文件名唯一定位其它课程，已按原课程编号进行审核。"])
    assert got[7] == kept and got[8] == kept
    assert got[9] == ("无法定位课程库记录", ["课程编号为空，已尝试通过课程名称和文件路径匹配课程库", "PDF 中的课程名称未能唯一匹配课程库：丙", "文件路径中的课程名称未能唯一匹配课程库：丁"])
    assert got[10] == ("无法定位课程库记录", ["课程编号为空，已尝试通过课程名称和文件路径匹配课程库"]) and got[11][0] == "通过课程编号匹配到课程库课程：A4"


def test_findings_that_do_not_pass(spark):
    """Without those that pass, findings are the others in their order, and results and verdicts are the same; also where the
    original text has what the payload lacks."""
    library = spark.createDataFrame([("A1", "甲")], "kcbh string, zwkcmc string")
    courses = library.select(*[F.col(c) if c in library.columns else F.lit(None).cast("string").alias(c) for c in schemas.struct(schemas.COURSES).names])
    warned = '{"extraction_warnings": [{"section": "kcmb", "field": "szmb", "reason": "missing_field"}], '
    rows = [(i, p, m.replace("{", warned, 1) if i % 3 == 0 and m != "{}" else m) for i, p, m in subjects()]
    tables = {"jxnr": {"tm": [{"xh": "1", "zt": " ", "xs": "2"}, {"xh": "2", "zt": "t", "zsd": "z", "xs": "3"}], "zongxs": "6"}, "jxap": {"tm": [{"zs": "1-3", "sknr": "s"}]}, "jcxx": {"kcbh": "A1", "zwkcmc": "甲 ", "zxs": "2", "skzs": "3", "zongxs": "6"}}
    rows.append((910, json.dumps(tables), json.dumps({"full_text": "课程基本信息 E-mail：a@b 实验学时"})))
    df = spark.createDataFrame(rows, "extraction_id long, p string, m string").select("extraction_id", F.from_json("p", schemas.PAYLOAD).alias("payload"), F.from_json("m", schemas.META).alias("meta"))
    df = df.withColumns({"subject_key": F.col("extraction_id").cast("string"), "course_code": F.lit(""), "source_path": F.lit("丁.pdf"), "extraction_status": F.when(F.col("extraction_id") % 2 == 0, "partial").otherwise("success")})
    matched = audit.match(df, courses)
    found = {passed: audit.evaluate(matched, fields=("reason", "message"), passed=passed).persist() for passed in (True, False)}
    every, few = ({r.subject_key: (r.findings, r.dimensions) for r in found[p].select("subject_key", "findings", "dimensions").collect()} for p in (True, False))
    assert every.keys() == few.keys() and any(f.status == "pass" for own, _ in every.values() for f in own)
    for k, (own, verdicts) in every.items():
        assert few[k] == ([f for f in own if f.status != "pass"], verdicts), k
    assert len({f.path for f in every["910"][0] if f.status == "pass"} & {"payload.jcxx.email", "payload.jcxx.syxs"}) == 2
    rolled = lambda p: sorted(map(str, audit.results(found[p]).collect()))
    assert rolled(True) == rolled(False)
