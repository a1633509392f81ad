"""Column functions, weeks, grids, text and section parsing on hand-made cases."""

import json

import pytest
from pyspark.sql import functions as F

from planforge.functions import columns as C
from planforge.functions import grids as G
from planforge.functions import text as T
from planforge.functions import weeks as W
from planforge.operators import judges, report, sections


def values(spark, rows, *cols):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], "v string" if not isinstance(rows[0], tuple) else "v string, w string")
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.coalesce(1).select(*cols).collect()]


def test_cleaning(spark):
    assert values(spark, ["　a\tb \x07", None], C.exact("v")) == ["a\tb", ""]
    assert values(spark, ["a \n\n\n\nb", "a\r\n b"], C.clean_text("v", True)) == ["a\n\nb", "a\n\nb"]
    assert values(spark, ["a \n b", " x\ty　 z \r"], C.clean_text("v")) == ["ab", "x y z"]
    assert values(spark, [" 不 填 ", "N/A", "有", None], C.marker_blank("v")) == ["", "", "有", ""]
    assert values(spark, ["a", "ab", "暂无", None], C.substantive("v")) == [False, True, False, False]
    assert values(spark, ["Course (A)：", "课 程"], C.normal_label("v")) == ["coursea", "课程"]
    assert values(spark, ["AB-12.3", "x", "课程编号：ABC123 等", None], C.course_code("v")) == ["AB-12.3", "", "ABC123", ""]
    assert values(spark, ["12 学时", "无", "３周"], C.first_integer("v"))[:2] == [12, None]
    assert values(spark, ["2", "2.50", "2a", None], C.strict_number("v")) == [2.0, 2.5, None, None]
    assert values(spark, ["a/b/01 数据（2024）课程方案.PDF", "x\\课程【新】.pdf"], C.path_name("v")) == ["数据", "课程"]
    assert values(spark, ["总学时：32 学时", "x", "学时 总"], C.label_value("v", "总学时")) == ["32 学时", None, None]
    assert values(spark, ["DeepLearning101intro"], C.english_spacing("v")) == ["Deep Learning 101 intro"]
    assert values(spark, ["课时总计：30 学时\n课时总计：36学时", "总学时: 40", ""], C.total_hours("v")) == ["36", "40", ""]
    assert values(spark, ["YES", "是的", "no", None], C.verdict("v")) == ["是", "是", "否", "否"]
    assert values(spark, ["1-3周", "第2讲", "abc", "3.1"], C.is_sequence("v")) == [True, True, False, True]
    assert values(spark, ["a  b|c\td"], C.split_columns("v")) == [["a", "b", "c", "d"]]


def test_keys_rates_and_maps(spark):
    df = spark.createDataFrame([(12, "p"), (0, "p")], "i long, p string")
    assert [r[0] for r in df.select(C.subject_key("i", "p")).collect()] == ["extraction:12", "source:516b9783fca517ee"]
    assert spark.range(1).select(C.rate(F.lit(1), F.lit(32)), C.rate(F.lit(1), F.lit(0)), C.percent_text(F.lit(1), F.lit(3))).first()[:] == (0.0312, 0.0, "33.3%")
    a, b = F.create_map(F.lit("x"), F.lit("1"), F.lit("y"), F.lit("2")), F.create_map(F.lit("y"), F.lit("3"))
    assert spark.range(1).select(C.merge_maps(a, b)).first()[0] == {"x": "1", "y": "3"}
    assert spark.range(1).select(C.missing_numbers(F.array(F.lit(1), F.lit(3)), F.lit(4)), C.missing_numbers(F.array(F.lit(1)), F.lit(0))).first()[:] == ([2, 4], [])


@pytest.mark.parametrize(("text", "weeks"), [("一", [1]), ("十四", [14]), ("第十四周", [14]), ("一至三", [1, 2, 3]), ("一、十四", [1, 14]), ("1, 3, 5-7", [1, 3, 5, 6, 7])])
def test_week_expressions(text, weeks):
    assert W.parse(text)[0] == weeks


def test_weeks_out_of_range_errors_and_prose(spark):
    assert W.parse("1,20,34,2025")[:2] == ([1], [20, 34, 2025])
    assert W.parse("5-3")[2] and W.parse("abc")[2]
    found = W.collect([("1-3", True), ("3", True)])
    assert (found["weeks"], found["duplicates"]) == ([1, 2, 3], [3])
    assert W.collect(W.from_prose("教学安排 第1周 导论 第2-3周 方法 2024 年 第14周 考试"), True)["weeks"] == [1, 2, 3, 14]
    assert W.from_overview("周次 1导论 2-3第二章 4复习") == ["1", "2-3", "4"]
    assert W.week_list(list(range(1, 13))).endswith("等")
    row = spark.createDataFrame([(["1", "2-4"], "", [])], "a array<string>, b string, c array<string>").select(W.schedule_weeks("a", "b", "c").alias("w")).first().w
    assert row.weeks == [1, 2, 3, 4] and row.source == "payload"


def test_names(spark):
    assert T.course_name("Ｄａｔａ （A） & B", True) == T.course_name("data(a)&b", True)
    assert T.course_name("《数据、结构》") == "数据,结构"


def test_html_grid_with_spans():
    html = "<table><tr><th>周</th><th colspan=2>内容</th></tr><tr><td rowspan=2>1</td><td>a</td><td>b</td></tr><tr><td>c</td><td>d<br>e</td></tr></table>"
    assert G.html_grids(html) == [[["周", "内容", None], ["1", "a", "b"], ["1", "c", "d e"]]]
    assert G.html_grids(None) == [] and G.html_grids("<p>x</p>") == []


def test_fill_from_donor_and_pairs():
    own, donor = [["序号", "主题"], ["1", ""], ["2", "x"]], [["序号", "主题"], ["1", "导论"], ["2", "yy"]]
    filled, n = G.fill_grids([own], [[["别的", "表"]], donor])
    assert (filled[0][1][1], filled[0][2][1], n) == ("导论", "x", 1)
    assert G.pair_fields([["课程编号", "ABC1", "总学时：32", None]]) == {"课程编号": "ABC1", "总学时": "32"}
    assert T.label_pairs(["课 程 编 号 X1 总学时 3"], ["课程编号", "总学时"]) == [("课程编号", "X1"), ("总学时", "3")]


def test_layout_json():
    text = '{"pdf_info":[{"para_blocks":[{"bbox":[0,20],"lines":[{"bbox":[0,20],"content":"second"}]},{"bbox":[0,1],"content":"first"},{"html":"<table><tr><td>a</td><td>b</td></tr></table>"}]}]}'
    assert G.layout_content(text) == (["first\nsecond"], [[["a", "b"]]])
    assert G.layout_content("<p>x</p>")[0] == ["x"]


def test_sections_of_text():
    text = "一、课程目标\n目标文字\n（四）教学内容\n1 导论 2\n（八）考核方式及成绩构成\n平时 30%\n"
    assert T.section(text, ("课程目标",)) == "目标文字"
    assert T.assessment_section(text) == "平时 30%"
    assert T.assessment_section("课程基本信息\n考核方式 考试\n") == ""
    assert [p for _, _, p in T.find_snippets("aaXbbXcc", ["X"], 1, 1)] == ["aXb", "bXc"]
    assert T.markdown_section("## （五）教学安排\n表\n## 其他\nx", "教学安排") == "表\n"
    assert T.sanitise({"a": ["x\x00"]}, "p") == ({"a": ["x"]}, ["p.a[0]"])


HEAD = ["序号", "主题", "知识点", "学时", "作业"]


def test_table_with_continuation_and_extra_column():
    first = [HEAD, ["1", "导论", "基础", "6", "h1"]]
    second = [["", "", "更多", "", ""], ["2", "方法", "推断", "9", ""]]
    found = sections.read_tables([first, second])
    assert [(r["序号"], r["知识点"]) for r in found.rows["teaching_content"]] == [("1", "基础\n更多"), ("2", "推断")]
    assert found.rows["teaching_content"][0]["kzzd"] == {"作业": "h1"} and found.continued == ["教学内容"]
    assert [w["reason"] for w in found.warnings] == ["unknown_columns"]


def test_summary_rows_and_practice_total():
    found = sections.read_tables([[HEAD[:4], ["1", "a", "b", "6"], ["2", "c", "d", "9"], ["课时总计", "", "", "15学时"]]])
    assert (len(found.rows["teaching_content"]), found.total) == (2, "15")
    found = sections.read_tables([[HEAD[:4], ["1", "a", "b\n36（课程教授与实践课）", "6"], ["2", "c", "d", "9"]]])
    assert found.total == "36"


def test_goals_table_is_no_schedule():
    assert not sections.read_tables([[["思政目标", "授课内容 很长"], ["能力目标", "x"]]]).rows["course_schedule"]


def test_weights():
    ratio = lambda rows: [r["占比"] for r in sections.weights(rows)]
    assert ratio([{"占比": "30%"}, {"占比": "70%"}]) == ["30%", "70%"]
    assert ratio([{"分值": "10"}, {"分值": "40"}, {"分值": "50"}]) == ["10%", "40%", "50%"]
    assert ratio([{"占比": "30"}, {"占比": "70"}]) == ["30%", "70%"]
    assert ratio([{"占比": "1"}, {"占比": "3"}]) == ["25%", "75%"]


class Fake:
    def __init__(self, *answers):
        self.answers = list(answers)

    def complete_json(self, prompt):
        return self.answers.pop(0)


def answers(dimension, client):
    items = judges.ITEMS if dimension == judges.GOALS_DIMENSION else [judges.FIELD]
    return {k: judges.call(client, "?") for k in items}


def test_judges_offline_and_with_fakes():
    ask = lambda dimension, client: judges.judge(dimension, answers(dimension, client))
    offline = ask(judges.IDEOLOGY_DIMENSION, None)
    assert (offline["status"], offline["message"]) == ("fail", "否") and "需人工复核" in offline["fields"][0]["reason"] and '"no_llm"' in offline["llm_trace"]
    checks = '"has_ideological_goal":{"result":"是"},"has_arrangement_integration":{"result":"yes"},"is_effectively_integrated":{"result":true}'
    assert ask(judges.IDEOLOGY_DIMENSION, Fake('```json\n{"result":"是","checks":{' + checks + "}}\n```"))["message"] == "是"
    lacking = ask(judges.IDEOLOGY_DIMENSION, Fake('{"result":"是","checks":{' + checks.replace("yes", "否") + "}}"))
    assert lacking["status"] == "fail" and lacking["reasons"] == ["教学安排中的思政融入未通过，模型未给出具体原因，需人工复核"]
    mixed = ask(judges.GOALS_DIMENSION, Fake('{"result":"是"}', '{"result":"否","reasons":["payload.jxnr 过简"]}', '{"result":"是"}'))
    assert (mixed["status"], mixed["reasons"]) == ("fail", ["教学内容 过简"]) and [f["status"] for f in mixed["fields"]] == ["pass", "fail", "pass"]
    broken = ask(judges.GOALS_DIMENSION, Fake("not json", "", '{"result":"是"}'))
    assert [c["status"] for c in json.loads(broken["llm_trace"])["calls"]] == ["parse_error", "empty_response", "parsed"]
    assert broken["status"] == "fail" and all("需人工复核" in f["reason"] for f in broken["fields"][:2])


def test_answers_are_asked_once(spark, tmp_path):
    asked = spark.createDataFrame([("s1", "q1", "k1"), ("s2", "q1", "k1"), ("s3", "q2", "k2")], "subject_key string, prompt string, key string")
    calls = tmp_path / "calls"
    calls.mkdir()

    def factory():
        class Client:
            def complete_json(self, prompt):
                (calls / f"{prompt}-{__import__('uuid').uuid4().hex}").touch()
                return '{"result":"是"}' if prompt == "q1" else ""

        return Client()

    for n in (2, 3):  # the second time only the question without a good answer is asked again
        got = {r.key: r.status for r in judges.answered(asked, factory, str(tmp_path / "cache")).collect()}
        assert got == {"k1": "parsed", "k2": "empty_response"} and len(list(calls.iterdir())) == n


def test_what_a_judge_is_shown(spark):
    from planforge import schemas

    payload = {"jcxx": {}, "kcmb": {"szmb": "培养学生的责任感与使命感", "kzzd": []}, "jxap": {"tm": [{"zs": "1", "szyqjxx": ""}, {"zs": "2", "szyqjxx": "诚信经营与社会责任"}], "apgs": ""}}
    meta = {"full_text": "课程目标 培养责任感 " + "x" * 900 + " 教学安排", "raw_pages": ["课程目标 培养责任感", "教学安排"], "extraction_warnings": [{"section": "other", "field": "f", "path": "payload.jxap.tm[0]", "reason": "r1"}, {"section": "jcxx", "reason": "r2"}], "unmapped_segments": []}
    df = spark.createDataFrame([("k", payload, meta)], schemas.struct(f"subject_key string, payload {schemas.PAYLOAD}, meta {schemas.META}"))
    one = judges.questions(df, judges.IDEOLOGY_DIMENSION).collect()
    assert len(one) == 1 and '"jxap_needs_meta":true' in one[0].flags and '"kcmb_needs_meta":false' in one[0].flags
    assert '"warnings":["r1"]' in one[0].prompt and "meta.raw_pages[0]" in one[0].prompt
    three = judges.questions(df, judges.GOALS_DIMENSION).collect()
    assert [r.item for r in three] == ["jxmb", "jxnr", "jxfs"] and len({r.key for r in three}) == 3 and '"page":0' in three[0].prompt


def test_verification_and_root_cause(spark):
    md = "## 教学内容\n<table><tr><td>主题</td><td>学时</td></tr><tr><td>a</td><td></td></tr></table>"
    assert report.verify(md, "jxnr", "xs", "学时", "missing_field") == "source_missing"
    assert report.verify(md, "jxnr", "zt", "主题", "missing_field") == "extract_failure"
    assert report.verify("x", "jxnr", "tm", "条目", "empty_section") == "source_missing"
    assert report.verify(None, "jxnr", "zt", "主题", "missing_field") == "uncertain"
    assert report.verify("## 教学安排\n一共十六周的课堂讲授与研讨", "jxap", "", "", "unknown_columns") == "extract_failure"
    df = spark.createDataFrame([(m, v) for v in ("source_missing", "extract_failure", "uncertain") for m in (True, False)], "m boolean, v string")
    assert [r[0] for r in df.coalesce(1).select(report.root_cause(F.col("m"), F.col("v"))).collect()] == ["lost_in_conversion", "truly_missing", "false_alarm", "false_alarm", "review_content", "review_structure"]


def test_any_name_of_a_label_counts():
    from planforge.operators import report

    md = "## （五）教学安排\n<table><tr><th>周次</th><th>讲授内容</th></tr><tr><td>1</td><td>导论</td></tr></table>\n## （一）课程基本信息\n<table><tr><td>电子邮箱</td><td>a@b.cn</td></tr></table>\n"
    assert report.verify(md, "jxap", "zs", "课程/周次", "missing_field") == "extract_failure"
    assert report.verify(md, "jxap", "sknr", "授课内容", "missing_field") == "extract_failure"
    assert report.verify(md, "jcxx", "email", "E-mail", "missing_field") == "extract_failure"
    assert report.verify(md, "jcxx", "lxdh", "联系电话", "missing_field") == "source_missing"
    assert report.recognised_label("主讲教师：张三丰", "任课教师姓名", "jcxx") and not report.recognised_label("教师：张三丰", "任课教师姓名", "jcxx")
    assert not report.recognised_label(None, "序号", "jxnr") and not report.recognised_label("x", None, "jxnr")


def test_sections_present():
    assert report.section_present("课程 编号：X", "kcbh") and not report.section_present("x" * 9000 + "课程编号", "kcbh")
    assert report.section_present("二、教学内容\n导论与历史沿革\n方法与推断\n", "jxnr") and not report.section_present("教学内容", "jxnr")
    assert not report.section_present("思政 思政", "jxap_sz") and not report.section_present("", "kcmb")
    assert report.recognised_label("课程编号：ABC", "课程编号", "jcxx") and not report.recognised_label("课程编号：", "课程编号", "jcxx")
    assert report.recognised_label("教学安排 授课方式 讲授", "授课方式", "jxap") and not report.recognised_label("授课方式", "授课方式", "jxap")


def test_customer_texts(spark):
    texts = ["payload.kcmb.szmb 为空", "meta原文 meta 与 payload_data", "无", None, "jxap.tm[0]"]
    expect = ["思政目标 为空", "meta原文 原文辅助信息 与 结构化抽取结果", "无", "", "教学安排.表格条目[0]"]
    assert values(spark, texts, C.customer_text("v")) == expect and [judges.customer(t) for t in texts] == expect


def test_numbered_first_row_continues_the_section():
    first = [HEAD[:4], ["1", "导论", "基础", "6"]]
    found = sections.read_tables([first, [["2", "主题", "知识点", "4"], ["3", "方法", "推断", "9"]]])
    assert [r["序号"] for r in found.rows["teaching_content"]] == ["1", "2", "3"]


def test_validated_texts():
    assert sections.validated_text("教学内容\n这里没有关键的词语但是很长很长\n", "课程要求") == ""
    assert sections.validated_text("课程要求\n按时提交作业\n", "课程要求") == "按时提交作业"


def test_unique_names_and_gaps(spark):
    from planforge.operators import relational as R

    df = spark.createDataFrame([(i, n) for i, n in enumerate(["a", "a ", "a", "b", "a_2", "c"])], "i int, n string")
    got = {r.i: r.new_name for r in R.unique_names(df, "n", [F.col("i")]).collect()}
    assert got == {0: "a", 1: "a_3", 2: "a_4", 3: "b", 4: "a_2", 5: "c"}
    rows = spark.createDataFrame([([("", [("k", "v")])],), ([("x", [("k", "v")])],), ([("", [])],), ([],)], "tm array<struct<f:string,kzzd:array<struct<bt:string,nr:string>>>>")
    assert [r[0] for r in rows.coalesce(1).select(C.gap_rows(F.col("tm"), "f")).collect()] == [True, False, False, False]


def test_plain_tags_need_no_general_parser(monkeypatch):
    plain = '<table class="a"><tbody><TR><td>序号</td><td rowspan="2">主题\n<br>x</td></tr><tr><td colspan="2">1</td></tr></table>尾<table><tr><th>a</th></tr><td>b > c'
    odd = ("<table><tr><td>a &amp; b</td></tr></table>", "<table><tr><td colspan=2>a<td>b</td x></tr></table>", "<table><tr><td>a < b<script><td>x</script></td></tr></table>", "<table><tr><td>a<", "<table><!-- <td>x</td> --><tr><td>y</td></tr>")

    def general(html):
        parser = G._Tables()
        parser.feed(html)
        return parser.tables

    for html in (plain, *odd, ""):
        assert G._Tables().read(html) == general(html)
    expect = G.html_grids(plain)
    assert expect == [[["序号", "主题 x"], ["1", None]], [["a", "b > c"]]]
    monkeypatch.setattr(G._Tables, "feed", lambda self, html: pytest.fail("general parser"))
    assert G.html_grids(plain) == expect


def test_without_a_client_no_prompt_is_made(spark, monkeypatch):
    from planforge import schemas

    rows = [(str(i), {"kcmb": {"szmb": g}, "jxap": {"tm": tm}} if g != "none" else None, {"full_text": "x"}) for i, (g, tm) in enumerate([("课程思政目标要明确写出", [{"szyqjxx": "诚信守时敬业"}]), ("a", [{"szyqjxx": ""}]), (None, []), ("none", None)])]
    df = spark.createDataFrame([(k, json.dumps(p, ensure_ascii=False) if p else None, json.dumps(m)) for k, p, m in rows], "subject_key string, p string, m string")
    df = df.select("subject_key", F.from_json("p", schemas.PAYLOAD).alias("payload"), F.from_json("m", schemas.META).alias("meta"))
    dimensions = (judges.GOALS_DIMENSION, judges.IDEOLOGY_DIMENSION)
    asked = {(r.subject_key, r.wd): r for d in dimensions for r in judges.judged(df, d, lambda: None).collect()}
    monkeypatch.setattr(judges, "questions", lambda *a: pytest.fail("a question"))
    offline = judges.unasked(df, *dimensions)
    assert {(r.subject_key, r.wd): r for r in offline.collect()} == asked and len(asked) == 8
    assert len({r.details for r in asked.values()}) >= 3
    assert sorted(judges.judged(df, dimensions[1]).collect()) == sorted(r for (_, d), r in asked.items() if d == dimensions[1])
    plan = offline._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Exchange" not in plan


def test_plain_tables_need_no_tag_handlers(monkeypatch):
    """Tables of rows and cells without attributes are read at once, as the handlers read them; all others by the handlers."""
    import random

    from planforge.functions import grids as G

    r = random.Random(4)
    bits = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "a", " ", "\n", "<td>b</td>", "<tr><td>c</td><td> d\n</td></tr>", "<table><tr><td>e</td></tr></table>", "<td colspan=\"2\">", "&amp;", "<br>", "<", ">", "<!-- x -->", "<TD>", "<tr></tr>"]
    whole = ["x > y <table><tr><td>1</td><td> </td></tr> <tr><td>　z</td></tr></table> t\n<table></table><table><tr></tr><tr><td>q</td></tr></table>", "<table>w<tr><td>1</td></tr></table>"]
    texts = whole + ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(20000)] + ["<table>" + "".join(r.choice(bits[9:12] + bits[6:9] + bits[-1:]) for _ in range(r.randint(0, 5))) + "</table>" for _ in range(5000)]
    plain = [G._plain_grids(t) for t in texts]
    monkeypatch.setattr(G, "_plain_grids", lambda html: None)
    for t, got in zip(texts, plain, strict=True):
        assert got is None or got == G.html_grids(t), t
    assert plain[0] == [[["1", None], ["z", None]], [[None], ["q"]]] and plain[1] is None
    assert sum(bool(g) for g in plain) > 500
