"""Documents to findings and metrics, end to end on a small corpus."""

import json

import pytest
from pyspark.sql import functions as F

from planforge import config, schemas
from planforge.operators import relational as R
from planforge.plans import drivers
from planforge.sources import readers
from planforge.sources.store import Store

MD = """# 课程方案
## （一）课程基本信息
<table><tr><td>课程编号</td><td>ABC101</td><td>中文课程名称</td><td>数据科学（上）</td></tr>
<tr><td>英文课程名称</td><td>Data Science</td><td>周学时</td><td>2</td></tr>
<tr><td>上课周数</td><td>{weeks}</td><td>总学时</td><td>{hours}</td></tr></table>
## （四）教学内容
<table><tr><th>序号</th><th>主题</th><th>知识点</th><th>学时</th></tr>
<tr><td>1</td><td>导论</td><td>历史</td><td>2</td></tr><tr><td>2</td><td>方法</td><td>推断</td><td>2</td></tr></table>
## （五）教学安排
<table><tr><th>周次</th><th>授课内容</th><th>授课方式</th><th>思政元素</th></tr>
<tr><td>1</td><td>导论</td><td>讲授</td><td>诚信</td></tr><tr><td>2</td><td>方法</td><td>讲授</td><td>责任</td></tr></table>
## （八）考核方式及成绩构成
<table><tr><th>考核形式</th><th>占比</th></tr><tr><td>平时成绩</td><td>40%</td></tr><tr><td>期末考试</td><td>60%</td></tr></table>
"""


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    rows = []
    for i, (weeks, hours) in enumerate([(2, 4), (3, 6)]):
        (root / f"d{i}.md").write_text(MD.format(weeks=weeks, hours=hours), encoding="utf-8")
        rows.append({"stem": f"d{i}", "source_pdf": f"pdf/d{i}.pdf", "md": f"d{i}.md", "status": "success", "json": {"middle": "" if i else "d0.json"}})
    blocks = [{"content": "（四）教学内容"}, {"html": "<table><tr><td>序号</td><td>主题</td><td>知识点</td><td>学时</td></tr><tr><td>1</td><td>导论</td><td>历史</td><td>2</td></tr></table>"}]
    (root / "d0.json").write_text(json.dumps({"pdf_info": [{"para_blocks": blocks}]}), encoding="utf-8")
    (root / "big.pdf").write_bytes(b"not read")
    rows += [{"stem": "bad", "source_pdf": "pdf/bad.pdf", "md": "none.md", "status": "success"}, {"stem": "f", "source_pdf": "pdf/f.pdf", "md": "", "status": "failed"}]
    (root / "index.jsonl").write_text("\n\n".join(json.dumps(r) for r in rows))
    (root / "lib.csv").write_text("标题,,,\n课程编号,中文课程名称,英文课程名称,周 学时,上课周数,总学时\nABC101,数据科学(上),DATA science,2,2,4\nABC101,重复,x,1,1,1\n123.0,其他,y,2,2,4\n,无编号,z,1,1,1\n", encoding="utf-8")
    return root


@pytest.fixture(scope="module")
def store(spark, corpus, tmp_path_factory):
    s = Store(spark, str(tmp_path_factory.mktemp("store")))
    assert s.init() == sorted(schemas.TABLES)
    return s


def test_library(spark, store, corpus):
    assert drivers.prepare_library(spark, store, str(corpus), str(corpus / "lib.csv")) == 2
    rows = {r.kcbh: r for r in store.read("courses").collect()}
    assert set(rows) == {"ABC101", "123"} and rows["ABC101"].zxs == "2" and rows["123"].zxs == "2"
    one = store.read("courses").where("kcbh = '123'").withColumn("zxs", F.lit(None).cast("string"))
    store.upsert_courses(spark.createDataFrame(one.collect(), one.schema))
    assert store.read("courses").where("kcbh = '123'").first().zxs is None and store.read("courses").count() == 2


def test_prepare_audit_resume_and_report(spark, store, corpus):
    counts = drivers.prepare(spark, store, str(corpus / "index.jsonl"), str(corpus))
    assert counts == {"partial": 2, "failed": 1, "added": 3}
    rows = {r.source_path: r for r in store.read("extractions").collect()}
    p = rows["pdf/d0.pdf"].payload
    assert (p.jcxx.kcbh, p.jcxx.zongxs, p.jxnr.zongxs, [r.zt for r in p.jxnr.tm], [r.zs for r in p.jxap.tm], [r.zb for r in p.khfsb.tm]) == ("ABC101", "4", "4", ["导论", "方法"], ["1", "2"], ["40%", "60%"])
    assert any(w.reason == "missing_field" and w.field == "szmb" for w in rows["pdf/d0.pdf"].meta.extraction_warnings)

    run = drivers.run_audit(spark, store)
    assert store.run(run)["status"] == "completed"
    res = {r.source_path: r for r in store.read("results").collect()}
    assert {k: r.overall_status for k, r in res.items()} == {"pdf/d0.pdf": "fail", "pdf/d1.pdf": "fail", "pdf/bad.pdf": "error"}
    wd = {(r.subject_key, r.wd): r.status for r in store.read("findings").collect()}
    key = {k: r.subject_key for k, r in res.items()}
    assert wd[key["pdf/d0.pdf"], "jxapsfyzcpp"] == "pass" and wd[key["pdf/d1.pdf"], "jxapsfyzcpp"] == "fail"
    assert wd[key["pdf/d0.pdf"], "jxnrsfyxspp"] == "pass" and wd[key["pdf/d1.pdf"], "jxnrsfyxspp"] == "fail"
    assert wd[key["pdf/d0.pdf"], "szysfyxrghj"] == "fail" and len({w for k, w in wd if k == key["pdf/d0.pdf"]}) == 6
    fields = store.read("field_findings")
    own = {(r.field, r.status): r.message for r in fields.where(F.col("subject_key") == key["pdf/d1.pdf"]).collect()}
    assert ("ywkcmc", "pass") in own and "课程库为 2，PDF 为 3" in own["skzs", "fail"] and "教学安排最大周次为 2" in own["zs", "fail"]
    metrics = {r.metric_key: r.metric_value for r in store.read("metrics").collect()}
    assert set(json.loads(metrics["dimension_pass_rates"])) == set(config.DIMENSIONS) and metrics["manual_review_course_count"] == "3" and set(metrics) == {"overall_pass_rate", "dimension_pass_rates", "reason_top10", "missing_field_top10", "manual_review_course_count", "llm_exception_count", "llm_status_counts"}
    assert json.loads(metrics["overall_pass_rate"])["pass_count"] == 0 and json.loads(metrics["llm_status_counts"]) == {"no_llm": 12} and metrics["llm_exception_count"] == "12"
    assert len(json.loads(metrics["reason_top10"])) == 10 and json.loads(metrics["reason_top10"])[0]["count"] == 9
    assert fields.where("section = 'szysfyxrghj' and status = 'fail' and message like '%需人工复核%'").count() == 3

    broken = {(r["table"], r["constraint"]): r.n for r in schemas.violations({n: store.read(n) for n in schemas.TABLES}).collect()}
    assert not any(broken.values()), broken
    with pytest.raises(ValueError, match="completed"):
        store.resume_run(run, 3, 0, 0)
    part = store.create_run(["xxyzwzfhmb"], {}, 3)
    done = store.read("results").where(F.col("source_path") == "pdf/d0.pdf")
    store.save_audits(part, done, store.read("findings").limit(0), fields.limit(0))
    with pytest.raises(ValueError, match="already"):
        store.save_audits(part, done, store.read("findings").limit(0), fields.limit(0))
    assert drivers.run_audit(spark, store, ["xxyzwzfhmb"], resume=part) == part
    assert store.completed_keys(part).count() == 3 and json.loads(store.run(part)["summary"])["skipped"] == 1

    found = drivers.quality_report(spark, store, str(corpus / "index.jsonl"), str(corpus))
    cover = {r.section: r for r in found["coverage"].collect()}
    assert cover["jxnr"].loose == 2 and cover["jxap_sz"].strict == 2 and cover["kcbh"].total == 3 and cover["jxnr"].md == 2 and cover["jxnr"].middle == 1 and cover["jxnr"].md_only == 1
    assert list(cover) == list(drivers.report.SECTIONS)
    assert "| section |" in drivers.report.markdown_report("q", {"coverage": found["coverage"]})
    assert json.loads(drivers.report.summary(found, total=3))["total"] == 3
    kept = store.derived("layout_cache", readers.CACHE).collect()
    assert [r.source_pdf for r in kept] == ["pdf/d0.pdf"] and kept[0].sections["jxnr"]
    again = drivers.quality_report(spark, store, str(corpus / "index.jsonl"), str(corpus))["coverage"].collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in cover.values()]
    assert drivers.prepare(spark, store, str(corpus / "index.jsonl"), str(corpus), skip_existing=True)["added"] == 3  # none succeeded


def test_match_cascade(spark):
    courses = spark.createDataFrame([("A1", "one"), ("A2", "two"), ("A3", "two")], "kcbh string, zwkcmc string")
    rows = [("s1", "A1", "x", "", False), ("s2", "Z", "one", "", False), ("s3", "", "two", "", False), ("s4", "", "no", "one", False), ("s5", "A2", "two", "one", True), ("s6", "A2", "", "", True), ("s7", None, None, None, False)]
    df = spark.createDataFrame(rows, "s string, code string, n1 string, n2 string, shared boolean")
    got = {r.s: (r.match_status, r.match_method, r.match_code) for r in R.match_cascade(df, courses, "code", [("n1", "doc"), ("n2", "file")], "kcbh", "zwkcmc", "shared").collect()}
    assert got == {"s1": ("matched", "code", "A1"), "s2": ("matched", "doc", "A1"), "s3": ("ambiguous", "doc", None), "s4": ("matched", "file", "A1"), "s5": ("matched", "file", "A1"), "s6": ("matched", "code", "A2"), "s7": ("not_found", None, None)}


def test_readers(spark, tmp_path):
    for name in ("a.PDF", "b.pdf", "c.xls", "d.txt"):
        (tmp_path / name).write_bytes(b"%PDF")
    found = readers.files(spark, str(tmp_path), content=True)
    assert sorted(r.path[-5:] for r in found.select("path").collect()) == ["a.PDF", "b.pdf"] or found.count() == 2
    pages = readers.pdf_pages(found, lambda b: [(b.decode(), [])]).collect()
    assert {p.text for p in pages} == {"%PDF"}
    lines = spark.createDataFrame([("p", 0, 2.0, 1.0, "b"), ("p", 0, 1.0, 5.0, "a")], "path string, page int, y0 double, x0 double, text string")
    assert readers.ordered_layout(lines).first().text == "a\nb"
    docs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "stem string")
    outs = spark.createDataFrame([("a", True, 3), ("b", False, 2), ("c", False, 0)], "stem string, has_md boolean, files int")
    assert dict(map(tuple, readers.raw_coverage(docs, outs).collect())) == {"a": "has_md", "b": "dir_only", "c": "empty_dir", "d": "missing"}


def test_pdf_documents(spark, tmp_path):
    """PDFs by readers that are handed in; without the layout's library its status is noted, a broken file fails alone."""
    folder = tmp_path / "pdfs"
    folder.mkdir()
    for name in ("a.pdf", "broken.pdf"):
        (folder / name).write_bytes(name.encode())
    text = "（四）教学内容\n1 导论 2\n2 方法 4\n"

    def pages(content):
        if content.startswith(b"broken"):
            raise ValueError("no pdf")
        return [(text, [[["课程编号", "AB1"], ["总学时", "6"], ["周学时", "2"]]])]

    def lines(content):
        raise ImportError("no library")

    store = Store(spark, str(tmp_path / "store"))
    store.init()
    assert drivers.prepare_pdf(spark, store, str(folder), pages_reader=pages, lines_reader=lines) == {"partial": 1, "failed": 1, "added": 2}
    rows = {r.source_path: r for r in store.read("extractions").collect()}
    assert rows["a.pdf"].payload.jcxx.kcbh == "AB1" and len(rows["a.pdf"].payload.jxnr.tm) == 2 and rows["a.pdf"].extractor == "pdfplumber"
    assert any(w.reason == "pymupdf_extract_failed" for w in rows["a.pdf"].meta.extraction_warnings) and any(w.reason == "alternative_candidate_selected" and w.source == "text_fallback" for w in rows["a.pdf"].meta.extraction_warnings)
    assert len({r.extraction_id for r in rows.values()}) == 2
    found = readers.layout_lines(readers.files(spark, str(folder), content=True), lambda b: [(0, 2.0, 1.0, "b"), (0, 1.0, 1.0, "a")])
    assert {r.text for r in readers.ordered_layout(found).collect()} == {"a\nb"}


def test_store_survives_a_lost_driver(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.init()
    run = store.create_run([], {}, 1)
    before = store.read("runs").collect()
    # a version that was written but never pointed to
    store.read("runs").withColumn("status", F.lit("failed")).write.parquet(f"{tmp_path}/runs/9")
    assert store.read("runs").collect() == before
    store.fail_run(run, "x")
    assert store.run(run)["status"] == "failed"
    rows = store.read("extractions")
    two = spark.createDataFrame([("a", "p", "success"), ("b", "p", "success")], "course_code string, source_path string, extraction_status string")
    for c in ("payload", "meta", "extractor"):
        two = two.withColumn(c, F.lit(None).cast(rows.schema[c].dataType))
    assert store.append_extractions(two) == 2 and len({r.extraction_id for r in store.read("extractions").collect()}) == 2
    store.clear()
    assert store.read("extractions").count() == 0


def test_a_batch_is_appended_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.init()
    rows = drivers.prepare_documents(spark.createDataFrame([("d", MD.format(weeks=2, hours=4), None)], "source_path string, md string, middle string"))
    # a driver that was lost between writing and marking
    store.read("extractions").write.parquet(f"{tmp_path}/batches/b1/extractions")
    assert store.read("extractions").count() == 0
    assert store.append_extractions(rows, "b1") == 1 and store.append_extractions(rows, "b1") == 0 and store.append_extractions(rows, "b2") == 1
    found = store.read("extractions").collect()
    assert [r.source_path for r in found] == ["d", "d"] and len({r.extraction_id for r in found}) == 2


def test_a_run_keeps_what_it_saved(spark, tmp_path, monkeypatch):
    """A run that is lost in its second batch resumes with the subjects of the first saved."""
    from planforge.operators import audit

    store = Store(spark, str(tmp_path))
    store.init()
    docs = spark.createDataFrame([(f"d{i}", MD.format(weeks=2, hours=4), None) for i in range(6)], "source_path string, md string, middle string")
    store.append_extractions(drivers.prepare_documents(docs))
    own, calls = audit.results, []

    def results(evaluated):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return own(evaluated)

    monkeypatch.setattr(audit, "results", results)
    rules = ["jxnrsfyxspp", "jxapsfyzcpp"]
    with pytest.raises(RuntimeError, match="lost"):
        drivers.run_audit(spark, store, rules, batch=3)
    run = store.read("runs").first().run_id
    assert store.run(run)["status"] == "failed"
    kept = {r.subject_key for r in store.completed_keys(run).collect()}
    assert 0 < len(kept) < 6 and not (tmp_path / "_work" / f"matched-{run}").exists()
    assert drivers.run_audit(spark, store, rules, resume=run, batch=2) == run and store.run(run)["status"] == "completed"
    rows = store.read("results").collect()
    assert len(rows) == len({r.subject_key for r in rows}) == 6 and json.loads(store.run(run)["summary"])["skipped"] == len(kept)
    assert store.read("findings").count() == 12


def test_stream(spark, tmp_path):
    from planforge.streaming import prepare_stream

    store = Store(spark, str(tmp_path / "store"))
    store.init()
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"source_path": f"d{k}", "md": MD.format(weeks=2, hours=4)}), encoding="utf-8")
        prepare_stream(spark, store, str(tmp_path / "in"), str(tmp_path / "check")).awaitTermination()
    assert sorted(r.source_path for r in store.read("extractions").collect()) == ["d0", "d1"]


def test_raw_outputs(spark, tmp_path):
    for name in ("a/auto/a.md", "a/hybrid_auto/x.json", "b/auto/b.md", "c/other/x.txt", "orphan/vlm/orphan.md"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    outs = readers.raw_outputs(spark, str(tmp_path))
    docs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "stem string")
    # the first folder by precedence decides, even without the file
    assert dict(map(tuple, readers.raw_coverage(docs, outs).collect())) == {"a": "dir_only", "b": "has_md", "c": "empty_dir", "d": "missing"}
    assert [r.stem for r in R.orphans(outs, docs, "stem").collect()] == ["orphan"]


def test_raw_coverage_as_files(spark, tmp_path):
    for name in ("a/auto/a.md", "b/auto/x.json"):
        (tmp_path / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name).write_text("x")
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps({"stem": s, "source_pdf": s, "md": "m", "status": "success"}) for s in "abc"))
    assert drivers.raw_report(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "raw"), str(tmp_path / "out")) == {"has_md": 1, "dir_only": 1, "missing": 1}
    text = next((tmp_path / "out/raw_coverage.csv").glob("part-*")).read_text(encoding="utf-8")
    assert text.startswith("\ufeffstem,status") and text.splitlines()[1:] == ["b,dir_only", "a,has_md", "c,missing"]


def test_settings(tmp_path):
    (tmp_path / "s.json").write_text('{"severity": {"missing_field": "warn"}}')
    assert config.load(str(tmp_path / "s.json"))["severity"]["missing_field"] == "warn" and config.load()["severity"]["missing_field"] == "error"
    assert config.problems({"auditors": ["nope"]}) == ["unknown dimension: nope"] and config.problems({"auditors": []})
