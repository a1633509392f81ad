"""Queries of the driver tables: the engine's operators applied to them, each with the SQL that must agree.

Names of columns are the same on both sides; doubles are rounded; nothing is sorted but top-k.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import relational as R
from ..sources import store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, read on use."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, path: f(Tables(spark, path))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _field_findings(t):
    """Field findings made of lines and parts: reasons of missing fields and of reviews, messages of another sort."""
    d = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand", "p_size"), "l_partkey")
    reason = F.when(F.col("l_quantity") < 10, "").when(F.col("p_size") > 20, F.concat("p_type", F.lit("为空"))).otherwise(F.concat("p_type", F.lit("需人工复核")))
    message = F.when((F.col("l_linestatus") == "F") & (F.col("l_tax") > 0.07), "无法定位课程库记录").otherwise(reason)
    return d.select(
        F.lit(1).alias("run_id"), F.col("l_orderkey").alias("result_id"), F.col("l_returnflag").alias("section"), F.col("l_linestatus").alias("field"), F.col("p_brand").alias("path"),
        F.when(F.col("l_quantity") >= 10, "fail").otherwise("pass").alias("status"), reason.alias("reason"), message.alias("message"),
    )


@query("""SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_per_key(t):
    return R.latest(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("""SELECT min(doc_id) AS doc_id, md5(k) AS text_md5 FROM (
  SELECT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS k FROM documents) GROUP BY k""".replace("\\\\", "\\"))
def first_wins_dedup(t):
    df = t.documents.select("doc_id", F.lower(C.compact("text")).alias("k"))
    return R.first_wins(df, F.col("k"), [F.col("doc_id")]).select("doc_id", F.md5("k").alias("text_md5"))


_CASCADE = """
WITH s AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN '' ELSE o_custkey::VARCHAR END AS code,
         CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') WHEN o_orderkey % 5 = 0 THEN '' ELSE 'nobody' END AS name1
  FROM orders
), card AS (SELECT c_name, count(*) AS n, min(c_custkey::VARCHAR) AS one FROM customer GROUP BY c_name)
SELECT o_orderkey, CASE WHEN c.c_custkey IS NOT NULL THEN 'matched' WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous' ELSE 'not_found' END AS match_status,
       CASE WHEN c.c_custkey IS NOT NULL THEN 'code' WHEN n >= 1 THEN 'name' END AS match_method,
       CASE WHEN c.c_custkey IS NOT NULL THEN code WHEN n = 1 THEN one END AS match_code
FROM s LEFT JOIN customer c ON c.c_custkey::VARCHAR = code LEFT JOIN card ON card.c_name = name1
"""


def _named_customers(t):
    return t.customer.select(F.col("c_custkey").cast("string").alias("kcbh"), F.col("c_name").alias("zwkcmc"))


@query(_CASCADE)
def match_cascade(t):
    blank = F.col("o_custkey") % 3 == 0
    name = F.when(blank & (F.col("o_orderkey") % 2 == 0), F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))).when(F.col("o_orderkey") % 5 == 0, "").otherwise("nobody")
    subjects = t.orders.select("o_orderkey", F.when(blank, "").otherwise(F.col("o_custkey").cast("string")).alias("code"), name.alias("name1"))
    found = R.match_cascade(subjects, _named_customers(t), "code", [("name1", "name")], "kcbh", "zwkcmc")
    return found.select("o_orderkey", "match_status", "match_method", "match_code")


@query("""
WITH s AS (SELECT c_custkey, c_nationkey::VARCHAR AS code, c_name, count(*) OVER (PARTITION BY c_nationkey) > 1 AS duplicate FROM customer)
SELECT c_custkey, duplicate,
  CASE WHEN duplicate AND c_custkey % 2 = 0 THEN 'name' WHEN c_nationkey IS NOT NULL THEN 'code' WHEN c_custkey % 2 = 0 THEN 'name' END AS match_method
FROM s JOIN (SELECT c_custkey, c_nationkey FROM customer) USING (c_custkey)""")
def duplicate_key_resolution(t):
    subjects = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("code"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("").alias("name1"))
    library = t.customer.select(F.col("c_nationkey").cast("string").alias("kcbh"), F.col("c_name").alias("zwkcmc"))
    found = R.match_cascade(R.shared_keys(subjects, "code"), library, "code", [("name1", "name")], "kcbh", "zwkcmc", duplicate="duplicate")
    return found.select("c_custkey", "duplicate", "match_method")


@query("""SELECT p_name AS name, n, CASE WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS verdict, first FROM (
  SELECT p_name, count(*) AS n, min(lpad(p_partkey::VARCHAR, 9, '0')) AS first FROM part GROUP BY p_name)
  UNION ALL SELECT c_name, n, CASE WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END, first FROM (
  SELECT c_name, count(*) AS n, min(lpad(c_custkey::VARCHAR, 9, '0')) AS first FROM customer GROUP BY c_name)""")
def name_cardinality(t):
    parts = t.part.select(F.col("p_name").alias("name"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("code"))
    people = t.customer.select(F.col("c_name").alias("name"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("code"))
    one = lambda df: R.name_cardinality(df, "name", "code").select("name", "n", "verdict", F.col("candidates")[0].alias("first"))
    return one(parts).unionByName(one(people))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')")
def resume_pending(t):
    done = t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.pending(t.orders.select("o_orderkey", "o_custkey"), done, ["o_orderkey"])


@query("""SELECT l_orderkey AS o_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1 HAVING count(*) = 2 AND count(*) FILTER (l_quantity >= 10) = 2""")
def all_dims_pass(t):
    findings = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("wd"), F.when(F.col("l_quantity") >= 10, "pass").otherwise("fail").alias("status"))
    return R.all_pass(t.orders, findings, "o_orderkey", ["A", "R"])


@query("""SELECT wd, coalesce(total, 0)::BIGINT AS total, coalesce(passed, 0)::BIGINT AS pass_count, coalesce(failed, 0)::BIGINT AS fail_count,
  CASE WHEN coalesce(total, 0) > 0 THEN round_even(passed / total, 4) ELSE 0.0 END AS pass_rate
  FROM (VALUES ('A'), ('N'), ('R'), ('X')) d(wd) LEFT JOIN (
    SELECT l_returnflag AS wd, count(*) AS total, count(*) FILTER (l_linestatus = 'O') AS passed, count(*) FILTER (l_linestatus <> 'O') AS failed FROM lineitem GROUP BY 1) USING (wd)""")
def dimension_rates(t):
    findings = t.lineitem.select(F.col("l_returnflag").alias("wd"), F.when(F.col("l_linestatus") == "O", "pass").otherwise("fail").alias("status"))
    return R.dimension_totals(findings, ["A", "N", "R", "X"])


@query("""SELECT CASE WHEN p_size > 20 THEN p_type || '为空' ELSE p_type || '需人工复核' END AS reason, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE l_quantity >= 10 GROUP BY 1 ORDER BY n DESC, reason LIMIT 10""")
def top_reasons(t):
    return store.top_reasons(_field_findings(t))


@query("""SELECT l_returnflag AS section, l_linestatus AS field, p_type || '为空' AS reason, p_brand AS path, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE p_size > 20 AND l_quantity >= 10 GROUP BY ALL ORDER BY n DESC, section, field, reason, path LIMIT 10""")
def top_missing_fields(t):
    return store.missing_fields(_field_findings(t))


@query("SELECT count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON p_partkey = l_partkey WHERE (p_size <= 20 AND l_quantity >= 10) OR l_linestatus = 'F' AND l_tax > 0.07")
def manual_review_count(t):
    return store.review_count(_field_findings(t))


@query("""WITH c AS (SELECT unnest([CASE (props->>'$.k')::INT % 3 WHEN 0 THEN 'parse_error' WHEN 1 THEN 'parsed' ELSE 'no_llm' END, CASE WHEN event_type = 'view' THEN 'empty_response' ELSE 'parsed' END]) AS status FROM events)
  SELECT status, count(*) AS n FROM c WHERE status <> 'parsed' GROUP BY status UNION ALL SELECT 'total', count(*) FROM c WHERE status <> 'parsed'""")
def json_call_status(t):
    """Calls in the findings' traces."""
    k = F.get_json_object("props", "$.k").cast("int") % 3
    call = lambda c: F.struct(c.alias("status"))
    calls = F.array(call(F.when(k == 0, "parse_error").when(k == 1, "parsed").otherwise("no_llm")), call(F.when(F.col("event_type") == "view", "empty_response").otherwise("parsed")))
    counts = store.model_calls(t.events.select(F.to_json(F.struct(calls.alias("calls"))).alias("llm_trace")))
    return counts.unionByName(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("total").alias("status"), "n"))


@query("""
WITH f AS (SELECT l_orderkey AS result_id, l_returnflag AS wd, l_quantity >= 10 AS ok FROM lineitem), p AS (SELECT result_id FROM f GROUP BY 1 HAVING count(*) = 3 AND count(*) FILTER (ok) = 3),
t AS (SELECT (SELECT count(*) FROM orders) AS total, (SELECT count(*) FROM p) AS ok),
d AS (SELECT wd, count(*) AS total, count(*) FILTER (ok) AS ok FROM f GROUP BY wd),
x AS (SELECT *, CASE WHEN p_size > 20 THEN p_type || '为空' ELSE p_type || '需人工复核' END AS reason FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity >= 10)
SELECT 'overall_pass_rate' AS metric_key, '' AS item, ok || '/' || total || '/' || (total - ok) || '/' || round_even(ok / total, 4)::DECIMAL(10, 4) AS metric_value FROM t
UNION ALL SELECT 'dimension_pass_rates', wd, ok || '/' || total || '/' || (total - ok) || '/' || round_even(ok / total, 4)::DECIMAL(10, 4) FROM d
UNION ALL SELECT 'reason_top10', reason, n::VARCHAR FROM (SELECT reason, count(*) AS n FROM x GROUP BY reason ORDER BY n DESC, reason LIMIT 10)
UNION ALL SELECT 'missing_field_top10', concat_ws('|', l_returnflag, l_linestatus, p_brand, reason), n::VARCHAR FROM (
  SELECT l_returnflag, l_linestatus, reason, p_brand, count(*) AS n FROM x WHERE p_size > 20 GROUP BY ALL ORDER BY n DESC, l_returnflag, l_linestatus, reason, p_brand LIMIT 10)
UNION ALL SELECT 'manual_review_course_count', '', count(DISTINCT l_orderkey)::VARCHAR FROM lineitem JOIN part ON p_partkey = l_partkey WHERE (p_size <= 20 AND l_quantity >= 10) OR l_linestatus = 'F' AND l_tax > 0.07
UNION ALL SELECT 'llm_exception_count', '', count(*)::VARCHAR FROM lineitem WHERE l_linenumber = 1
UNION ALL SELECT 'llm_status_counts', 'no_llm', count(*)::VARCHAR FROM lineitem WHERE l_linenumber = 1
""")
def run_metrics(t):
    """G3 to G9 of one run; the JSON values taken apart."""
    line = t.lineitem.where("l_linenumber is not null")
    trace = F.when(F.col("l_linenumber") == 1, F.lit('{"calls":[{"status":"no_llm"}]}'))
    results = t.orders.select(F.lit(1).alias("run_id"), F.col("o_orderkey").alias("result_id"), F.lit("fail").alias("overall_status"))
    findings = line.select(F.lit(1).alias("run_id"), F.col("l_orderkey").alias("result_id"), F.col("l_returnflag").alias("wd"), F.when(F.col("l_quantity") >= 10, "pass").otherwise("fail").alias("status"), trace.alias("llm_trace"))
    m = store.run_metrics(results, findings, _field_findings(t), 1, ["A", "N", "R"])
    rate = "struct<total:long,pass_count:long,fail_count:long,pass_rate:decimal(10,4)>"
    text = lambda r: F.concat_ws("/", *[r[k].cast("string") for k in ("pass_count", "total", "fail_count", "pass_rate")])
    of = lambda k: m.where(F.col("metric_key") == k)
    row = lambda df, item, value: df.select("metric_key", item.alias("item"), value.alias("metric_value"))
    exploded = lambda k, kind: of(k).select("metric_key", F.explode(F.from_json("metric_value", kind)))
    parts = [
        row(of("overall_pass_rate"), F.lit(""), text(F.from_json("metric_value", rate))), row(exploded("dimension_pass_rates", f"map<string,{rate}>"), F.col("key"), text(F.col("value"))),
        row(exploded("reason_top10", "array<struct<reason:string,count:long>>"), F.col("col.reason"), F.col("col.count").cast("string")),
        row(exploded("missing_field_top10", "array<struct<section:string,field:string,path:string,reason:string,count:long>>"), F.concat_ws("|", "col.section", "col.field", "col.path", "col.reason"), F.col("col.count").cast("string")),
        row(of("manual_review_course_count"), F.lit(""), F.col("metric_value")), row(of("llm_exception_count"), F.lit(""), F.col("metric_value")),
        row(exploded("llm_status_counts", "map<string,long>"), F.col("key"), F.col("value").cast("string")),
    ]
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


@query("""SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS fail_count, count(*) FILTER (l_returnflag = 'A') AS warning_count,
  CASE WHEN min(o_orderstatus) = 'P' THEN 'error' WHEN count(*) FILTER (l_returnflag = 'R') > 0 THEN 'fail' WHEN count(*) FILTER (l_returnflag = 'A') > 0 THEN 'partial' ELSE 'pass' END AS overall_status,
  coalesce(array_to_string((list(l_linestatus || l_linenumber ORDER BY l_linenumber, l_partkey, l_suppkey) FILTER (l_returnflag = 'R'))[1:5], ','), '') AS messages,
  coalesce(array_to_string((list(l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey) FILTER (l_returnflag <> 'N'))[1:20], ','), '') AS reasons
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey""")
def status_rollup(t):
    """Messages of failed findings, reasons of failed and warned ones with repeats."""
    status = F.when(F.col("l_returnflag") == "R", "fail").when(F.col("l_returnflag") == "A", "warning").otherwise("pass")
    lines = t.lineitem.select("l_orderkey", status.alias("status"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("message"), F.col("l_linestatus").alias("reason"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "P", "failed").alias("x"))
    out = R.rollup_subjects(lines.join(orders, "l_orderkey"), ["l_orderkey"], extraction=F.col("x"))
    return out.select("l_orderkey", "fail_count", "warning_count", "overall_status", F.array_join("messages", ",").alias("messages"), F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT l_orderkey, l_returnflag, count(*) FILTER (l_discount > 0.05) AS fail_count,
  CASE WHEN count(*) FILTER (l_discount > 0.05) > 0 THEN 'fail' ELSE 'pass' END AS status,
  coalesce(array_to_string(list_sort(list(l_linenumber::VARCHAR) FILTER (l_discount > 0.05))[1:20], ','), '') AS failed_paths FROM lineitem GROUP BY ALL""")
def section_rollup(t):
    lines = t.lineitem.select("l_orderkey", "l_returnflag", F.when(F.col("l_discount") > 0.05, "fail").otherwise("pass").alias("status"), F.col("l_linenumber").cast("string").alias("path"), F.lit("").alias("reason"), F.col("l_linenumber").alias("ord"))
    out = R.rollup_sections(lines, ["l_orderkey"], section="l_returnflag")
    return out.select("l_orderkey", "l_returnflag", "fail_count", "status", F.array_join("failed_paths", ",").alias("failed_paths"))


@query("""
WITH d AS (SELECT d.doc_id, d.n_chars, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels GROUP BY 1) l USING (doc_id))
SELECT section, count(*) AS total, count(*) FILTER (loose) AS loose, count(*) FILTER (strict) AS strict, count(*) FILTER (loose AND NOT strict) AS gap FROM (
  SELECT 'text' AS section, n_chars > 0 AS loose, n_chars > 500 AS strict FROM d UNION ALL
  SELECT 'label', quality IS NOT NULL, coalesce(quality = 1, false) FROM d UNION ALL
  SELECT 'clean', coalesce(toxic = 0, false), coalesce(toxic = 0 AND quality = 1, false) FROM d) GROUP BY section""")
def coverage_matrix(t):
    labels = t.labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("toxic").alias("toxic"))
    d = t.documents.select("doc_id", "n_chars").join(labels, "doc_id", "left")
    clean = F.coalesce(F.col("toxic") == 0, F.lit(False))
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    loose = {"text": F.col("n_chars") > 0, "label": F.col("quality").isNotNull(), "clean": clean}
    strict = {"text": F.col("n_chars") > 500, "label": good, "clean": clean & good}
    return R.coverage(d, list(loose), {"loose": loose, "strict": strict, "gap": {k: loose[k] & ~strict[k] for k in loose}})


@query("""
WITH d AS (SELECT lang, CASE WHEN quality IS NULL THEN 'uncertain' WHEN quality = 1 THEN 'found' ELSE 'missing' END AS k FROM documents LEFT JOIN labels USING (doc_id))
SELECT lang, count(*) FILTER (k = 'found') AS found, count(*) FILTER (k = 'missing') AS missing, count(*) FILTER (k = 'uncertain') AS uncertain,
  round(count(*) FILTER (k = 'missing') / count(*), 4) AS missing_rate FROM d GROUP BY lang""")
def warning_pivot(t):
    d = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    d = d.select("lang", F.when(F.col("quality").isNull(), "uncertain").when(F.col("quality") == 1, "found").otherwise("missing").alias("k"))
    out = R.warning_pivot(d, "lang", "k", ["found", "missing", "uncertain"])
    return out.withColumn("missing_rate", F.round(F.col("missing") / (F.col("found") + F.col("missing") + F.col("uncertain")), 4))


@query(r"""SELECT conv_id, coalesce(bool_or((role <> 'assistant' OR NOT regexp_matches(text, '\S')) AND length(text) > 200), false) AS gap FROM conversations GROUP BY conv_id""")
def bool_exists_array(t):
    """Rows with extra values beside a blank field."""
    extra = F.when(F.length("text") > 200, F.array(F.struct(F.lit("k").alias("bt"), F.lit("v").alias("nr")))).otherwise(F.array().cast("array<struct<bt:string,nr:string>>"))
    rows = t.conversations.groupBy("conv_id").agg(F.collect_list(F.struct(F.when(F.col("role") == "assistant", F.col("text")).otherwise("").alias("f"), extra.alias("kzzd"))).alias("tm"))
    return rows.select("conv_id", C.gap_rows(F.col("tm"), "f").alias("gap"))


@query("""SELECT s_suppkey AS id, s_name AS name, round(s_acctbal, 2) AS balance FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)
  UNION ALL SELECT c_custkey, c_name, round(c_acctbal, 2) FROM customer WHERE c_custkey % 2 = 0""")
def upsert_latest(t):
    old = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.round("s_acctbal", 2).alias("balance"))
    new = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.round("c_acctbal", 2).alias("balance"))
    return R.upsert(old, new, ["id"])


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'k=' || user_id || ';src=' || event_type ELSE 'k=' || (props->>'$.k') || ';src=' || event_type END AS merged FROM events""")
def json_merge(t):
    left = F.from_json("props", "map<string,string>")
    right = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("src"), F.col("event_type"), F.lit("k"), F.col("user_id").cast("string"))).otherwise(F.create_map(F.lit("src"), F.col("event_type")))
    entries = F.array_sort(F.map_entries(C.merge_maps(left, right)))
    return t.events.select("event_id", F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("merged"))


@query("""SELECT event_id, user_id, round(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value
  FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM events)""")
def forward_fill(t):
    df = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"))
    out = R.forward_fill(df, ["user_id"], [F.col("ts"), F.col("event_id")], "value")
    return out.select("event_id", "user_id", F.round("value", 6).alias("value"))


@query("""SELECT conv_id, segment, count(*) AS rows, md5(string_agg(text, chr(10) ORDER BY turn)) AS body_md5 FROM (
  SELECT *, (sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS segment FROM conversations) GROUP BY conv_id, segment""")
def segment_rows(t):
    out = R.segments(t.conversations, ["conv_id"], [F.col("turn")], F.col("role") == "user", "text", "turn")
    return out.select("conv_id", "segment", "rows", F.md5("body").alias("body_md5"))


@query("""SELECT p_partkey, CASE WHEN c.score >= b.score + 8.0 THEN 'alternative2' ELSE b.source END AS source, round(CASE WHEN c.score >= b.score + 8.0 THEN c.score ELSE b.score END, 6) AS score FROM (
  SELECT p_partkey, CASE WHEN a.score >= p_size + 8.0 THEN {'source': 'alternative1', 'score': a.score} ELSE {'source': 'current', 'score': p_size::DOUBLE} END AS b, {'score': (p_partkey % 50)::DOUBLE} AS c
  FROM (SELECT *, {'score': p_retailprice % 60} AS a FROM part))""")
def candidate_fold(t):
    cand = F.array(*[F.struct(F.lit(n).alias("source"), v.cast("double").alias("score")) for n, v in (("current", F.col("p_size")), ("alternative1", F.col("p_retailprice") % 60), ("alternative2", F.col("p_partkey") % 50))])
    best = t.part.select("p_partkey", R.choose_candidate(cand, 8.0).alias("b"))
    return best.select("p_partkey", F.col("b.source").alias("source"), F.round("b.score", 6).alias("score"))


@query("""SELECT doc_id, round((((n_chars > 0)::INT + (quality IS NOT NULL)::INT + (lang <> '')::INT + (source <> '')::INT) / 4.0 * 50 + (coalesce(toxic, 0) = 0)::INT * 30 + 1 - 5 * coalesce(toxic, 0)) / 2, 6) AS score
  FROM documents LEFT JOIN (SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id)""")
def completeness_score(t):
    """One row where two are wanted, so half of the score."""
    labels = t.labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("toxic").alias("toxic"))
    d = t.documents.select("doc_id", "n_chars", "lang", "source").join(labels, "doc_id", "left")
    clean = F.when(F.coalesce("toxic", F.lit(0)) == 0, "x")
    row = F.array(F.struct(F.when(F.col("n_chars") > 0, "x").alias("a"), F.col("quality").cast("string").alias("b"), F.col("lang").alias("c"), F.col("source").alias("d"), clean.alias("e")))
    return d.select("doc_id", F.round(C.row_score(row, ("a", "b", "c", "d"), {"e": 30}, 2, F.coalesce("toxic", F.lit(0))), 6).alias("score"))


@query("""SELECT l_orderkey, i, CASE WHEN x = round(x) THEN x::BIGINT::VARCHAR ELSE format('{:g}', x) END || '%' AS share FROM (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i, round_even(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey) * 100, 2) AS x FROM lineitem)""")
def ratio_normalise(t):
    """Scores as percents of their sum."""
    from ..operators import sections

    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    rows = F.transform(F.sort_array(F.collect_list(row)), lambda r: F.create_map(F.lit("考试形式"), F.lit("x"), F.lit("分值"), r["l_quantity"].cast("int").cast("string")))
    orders = t.lineitem.groupBy("l_orderkey").agg(rows.alias("rows")).select("l_orderkey", F.posexplode(sections.weighted_rows("rows")))
    return orders.select("l_orderkey", (F.col("pos") + 1).cast("bigint").alias("i"), F.col("col")["占比"].alias("share"))


@query("SELECT l_orderkey, sum(l_quantity::BIGINT)::BIGINT AS hours, count(*) AS rows FROM lineitem GROUP BY 1")
def array_hours_sum(t):
    rows = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_quantity").cast("bigint").cast("string").alias("xs"))).alias("tm"))
    return rows.select("l_orderkey", C.hours_sum(F.col("tm")).alias("hours"), F.size("tm").cast("bigint").alias("rows"))


@query(r"""SELECT doc_id, round(100 - CASE WHEN r > 0.35 THEN least(25, r * 40) ELSE 0 END, 1) AS score, r > 0.35 AS rerun FROM (
  SELECT doc_id, coalesce(len(list_filter(w, lambda v: length(v) <= 4)) / nullif(len(w), 0), 0) AS r FROM (
    SELECT doc_id, regexp_extract_all(regexp_replace(coalesce(text, ''), '[^ -~\n]', ' ', 'g'), '\b[A-Za-z]{2,5}\b') AS w FROM documents))""")
def ocr_quality(t):
    """G19 on the texts' ASCII part: short words among those of two to five letters.  Halves are rounded up, as SQL does."""
    from ..operators import sections

    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^ -~\n]", " ")
    q = t.documents.select("doc_id", sections.quality_of(text, F.lit(None).cast("array<array<array<string>>>")).alias("q"))
    return q.select("doc_id", (F.round(F.col("q.score") * 10) / 10).alias("score"), F.col("q.rerun").alias("rerun"))


@query("""SELECT l_orderkey, array_to_string(list_sort(list_filter(range(1, m + 1), lambda x: NOT list_contains(s, x::INT))), ',') AS missing FROM (
  SELECT l_orderkey, max(l_linenumber) AS m, list(l_linenumber) AS s FROM lineitem GROUP BY 1)""")
def missing_sequence(t):
    seen = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("s"), F.max("l_linenumber").alias("m"))
    return seen.select("l_orderkey", F.array_join(F.array_sort(C.missing_numbers(F.col("s"), F.col("m"))), ",").alias("missing"))


@query("SELECT p_partkey, list_has_any(string_split(p_name, ' '), ['red', 'ring', CASE WHEN p_size > 25 THEN 'widget' ELSE 'none' END]) AS meet FROM part")
def set_overlap(t):
    """Header rows that share a cell."""
    from ..functions import grids

    other = F.array(F.lit("r e d"), F.lit(" ring"), F.when(F.col("p_size") > 25, "widget").otherwise("none"))
    return t.part.select("p_partkey", grids.heads_meet(F.split("p_name", " "), other).alias("meet"))


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")
def orphan_keys(t):
    """U4."""
    return R.orphans(t.lineitem, t.part.where("p_size > 5").select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


@query("""WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), s AS (SELECT coalesce(n, 0) AS n FROM orders LEFT JOIN n ON l_orderkey = o_orderkey),
t AS (SELECT count(*) AS subjects, sum(n)::BIGINT AS rows, count(*) FILTER (n = 0) AS bare FROM s)
SELECT section, field, status, n FROM (
  SELECT unnest(['payload', 'payload', 'payload', 'payload', 'kcmb', 'kcmb', 'kcmb', 'khfsb', 'kcyq']) AS section, unnest(['kczwjj', 'kcywjj', 'ybzsyq', 'jcjydcl', 'szmb', 'nlmb', 'zsmb', 'tm', 'content']) AS field,
         unnest(['pass', 'fail', 'fail', 'fail', 'pass', 'fail', 'fail', 'fail', 'pass']) AS status, subjects AS n FROM t
  UNION ALL SELECT unnest(['jxnr', 'jxap']), 'tm', 'pass', subjects - bare FROM t UNION ALL SELECT unnest(['jxnr', 'jxap']), 'tm', 'fail', bare FROM t
  UNION ALL SELECT unnest(['jxnr', 'jxnr', 'jxnr', 'jxnr', 'jxap', 'jxap', 'jxap', 'jxap']), unnest(['xh', 'zt', 'zsd', 'xs', 'zs', 'sknr', 'skfs', 'szyqjxx']), unnest(['pass', 'pass', 'pass', 'pass', 'pass', 'pass', 'fail', 'fail']), rows FROM t) WHERE n > 0""")
def presence_findings(t):
    """R2: required fields, sections and row cells of every subject."""
    from ..operators import audit

    subjects, _ = _subjects(t)
    found = subjects.select(F.explode(audit.required()).alias("f"))
    return R.histogram(found, section=F.col("f.section"), field=F.col("f.field"), status=F.col("f.status"))


@query("""WITH s AS (SELECT o_orderkey, o_orderkey % 5 > 0 AS coded, o_orderkey % 19 + 1 AS weeks FROM orders)
SELECT 'extraction:' || (o_orderkey + 1) AS subject_key, unnest(['kcbh', 'kkyx', 'zwkcmc', 'ywkcmc', 'skyy', 'sfyxwxyxk', 'khfs', 'kcxz', 'kclb', 'zxs', 'skzs', 'zongxs', 'jxxs', 'kcxf', 'rkjsxm']) AS field,
  unnest([CASE WHEN coded THEN 'pass' ELSE 'fail' END, 'fail', 'pass', 'pass', 'fail', 'fail', 'fail', 'fail', 'fail', 'pass', CASE WHEN weeks = 10 THEN 'pass' ELSE 'fail' END, 'fail', 'fail', 'fail', 'fail']) AS status FROM s""")
def field_compare(t):
    """The 15 compared fields of matched subjects: codes, names in other case, numbers written otherwise, blanks."""
    from ..operators import audit

    subjects, library = _subjects(t)
    found = audit.match(subjects, library).select("subject_key", F.explode(audit.comparisons()).alias("f"))
    return found.select("subject_key", "f.field", "f.status")


@query(r"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN n_chars::INT ELSE try_cast(nullif(regexp_extract(text, '[0-9]+'), '') AS INT) END AS number,
  CASE WHEN doc_id % 2 = 0 THEN 'payload' WHEN try_cast(nullif(regexp_extract(text, '[0-9]+'), '') AS INT) IS NOT NULL THEN 'meta' ELSE 'none' END AS provenance FROM documents""")
def numeric_provenance(t):
    column, text = F.when(F.col("doc_id") % 2 == 0, C.first_integer(F.col("n_chars").cast("string"))), F.regexp_extract("text", "[0-9]+", 0).try_cast("int")
    return t.documents.select("doc_id", F.coalesce(column, text).alias("number"), F.when(column.isNotNull(), "payload").when(text.isNotNull(), "meta").otherwise("none").alias("provenance"))


@query(r"""SELECT doc_id, length(c) AS n, md5(c) AS text_md5, length(k) AS n_kept, md5(k) AS kept_md5 FROM (
  SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS c, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS k FROM documents)""")
def text_clean(t):
    c, k = C.compact(C.exact("text")), C.normal_lines("text")
    return t.documents.select("doc_id", F.length(c).cast("bigint").alias("n"), F.md5(c).alias("text_md5"), F.length(k).cast("bigint").alias("n_kept"), F.md5(k).alias("kept_md5"))


@query(r"""SELECT page_id, length(x) AS n, md5(x) AS text_md5 FROM (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '(?m)^#+\s*', '', 'g'), '\s+', ' ', 'g')) AS x FROM pages)""")
def html_to_text(t):
    x = C.strip_markup("html")
    return t.pages.select("page_id", F.length(x).cast("bigint").alias("n"), F.md5(x).alias("text_md5"))


@query("""SELECT page_id, split_part(url, '/', 3) AS goals, page_id::VARCHAR || ' x' AS content, CASE WHEN page_id % 2 = 0 THEN '平时 ' || page_id || '%' ELSE '' END AS assessment, CASE WHEN page_id % 3 = 0 THEN '表' ELSE '' END AS part FROM pages""")
def section_cut(t):
    """Bodies of sections by their titles."""
    from ..functions import text as T

    num, host = F.col("page_id").cast("string"), F.split("url", "/")[2]
    last = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("（八）考核方式及成绩构成\n平时 "), num, F.lit("%\n"))).otherwise("")
    text = F.concat(F.lit("一、课程目标\n"), host, F.lit("\n（四）教学内容\n"), num, F.lit(" x\n"), last)
    md = F.concat(F.lit("## 一、"), F.when(F.col("page_id") % 3 == 0, "教学安排").otherwise("其他"), F.lit("\n表\n## 二、尾\nx"))
    part = F.trim(F.regexp_replace(T.markdown_part(md, "教学安排"), "\n", ""))
    return t.pages.select("page_id", T.section_column(text, ("课程目标",)).alias("goals"), T.section_column(text, ("教学内容",)).alias("content"), T.assessment_section_column(text).alias("assessment"), part.alias("part"))


@query(r"""SELECT event_id, CASE WHEN regexp_matches(props, '"k"\s*:') THEN regexp_extract(props, '"k"\s*:\s*([^,}]*)', 1) END AS value FROM events""")
def label_value(t):
    return t.events.select("event_id", F.regexp_replace(C.label_value("props", '"k"'), r"[,}].*$", "").alias("value"))


@query(r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(list_last(string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/')), '\.html$', ''), '^[0-9._-]+', ''), '\s+', '', 'g') AS name FROM pages""")
def path_to_name(t):
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "/+$", ""), r"\.html$", "")
    return t.pages.select("page_id", C.path_name(path).alias("name"))


@query("SELECT page_id, 'source:' || substr(sha1(url), 1, 16) AS k0, CASE WHEN page_id > 0 THEN 'extraction:' || page_id ELSE 'source:' || substr(sha1(url), 1, 16) END AS k1 FROM pages")
def hash_keys(t):
    return t.pages.select("page_id", C.subject_key(F.lit(0), "url").alias("k0"), C.subject_key("page_id", "url").alias("k1"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '思政目标 为空' WHEN 1 THEN '教学安排.表格条目[0] ' || o_orderkey ELSE '原文辅助信息 与 结构化抽取结果' END AS shown FROM orders")
def customer_text(t):
    """Internal names as customers read them."""
    k = F.col("o_orderkey") % 3
    text = F.when(k == 0, "payload.kcmb.szmb 为空").when(k == 1, F.concat(F.lit("payload.jxap.tm[0] "), F.col("o_orderkey").cast("string"))).otherwise("meta 与 payload_data")
    return t.orders.select("o_orderkey", C.customer_text(text).alias("shown"))


@query("""SELECT doc_id, CASE WHEN n_chars > 1000 AND q THEN 'table_with_supplement' WHEN n_chars > 1000 THEN 'table_only' WHEN q THEN 'overview_only' ELSE 'empty' END AS layout
  FROM (SELECT doc_id, n_chars, coalesce(max(quality) = 1, false) AS q FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL)""")
def layout_class(t):
    from ..operators.payload import layout

    q = t.labels.groupBy("doc_id").agg((F.max("quality") == 1).alias("q"))
    d = t.documents.select("doc_id", "n_chars").join(q, "doc_id", "left")
    return d.select("doc_id", layout(F.col("n_chars") > 1000, F.coalesce("q", F.lit(False))).alias("layout"))


@query(r"""SELECT doc_id, c, length(regexp_replace(c, '\s+', '', 'g')) >= 2 AND c NOT IN ('null', 'none') AS substantive, length(c) < 4 OR lower(c) IN ('null', 'none') AS template FROM (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN '' ELSE substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 5) END AS c FROM documents)""")
def token_filter(t):
    raw = F.when(F.col("doc_id") % 7 == 0, "N/A").when(F.col("doc_id") % 7 == 1, " 暂无 ").otherwise(F.substring(C.compact("text"), 1, 5))
    d = t.documents.select("doc_id", raw.alias("raw")).select("doc_id", F.when(F.col("doc_id") % 7 < 2, C.marker_blank("raw")).otherwise(F.col("raw")).alias("c"))
    return d.select("doc_id", "c", C.substantive("c").alias("substantive"), C.template_like("c").alias("template"))


@query("""SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM orders""")
def status_counts(t):
    counts = R.status_counts(t.orders, "o_orderstatus").withColumnRenamed("o_orderstatus", "status")
    return counts.unionByName(t.orders.agg(F.count("*").alias("n")).select(F.lit("total").alias("status"), "n"))


@query("""SELECT event_type AS reason, CASE WHEN (props->>'$.k')::INT >= 50 THEN 'error' ELSE 'warn' END AS severity, 2 * count(*) AS n FROM events GROUP BY ALL""")
def severity_histogram(t):
    """Two equal warnings in each meta."""
    from ..operators import report

    severity = F.when(F.get_json_object("props", "$.k").cast("int") >= 50, "error").otherwise("warn")
    one = F.struct(F.col("event_type").alias("reason"), severity.alias("severity"))
    return report.warning_histogram(t.events.select(F.struct(F.array(one, one).alias("extraction_warnings")).alias("meta")))


@query("""SELECT c_nationkey, unnest(['name', 'segment', 'balance']) AS field, unnest([count(*) FILTER (c_custkey % 5 = 0), count(*) FILTER (c_mktsegment = 'BUILDING'), 0]) AS row_count FROM customer GROUP BY 1
  QUALIFY row_count > 0""".replace("SELECT c_nationkey", "SELECT * FROM (SELECT c_nationkey").replace("\n  QUALIFY", ") WHERE"))
def missing_counts(t):
    """Blank cells of each column of an array of rows."""
    d = t.customer.select("c_nationkey", F.struct(F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise(" ").alias("segment"), F.col("c_acctbal").cast("string").alias("balance")).alias("r"))
    rows = d.groupBy("c_nationkey").agg(F.collect_list("r").alias("tm"))
    found = rows.select("c_nationkey", F.explode(R.missing_columns(F.col("tm"), {"name": "n", "segment": "s", "balance": "b"})).alias("m"))
    return found.select("c_nationkey", "m.field", F.col("m.row_count").cast("bigint").alias("row_count"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 10)")
def member_filter(t):
    keys = t.part.where("p_size = 10").select(F.col("p_partkey").alias("l_partkey"))
    return R.members(t.lineitem, keys, ["l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT n_nationkey, 2 + (r_regionkey % 2 = 0)::INT AS rows, n_name AS mc, CASE WHEN r_regionkey % 2 = 0 THEN r_name END AS qy, '注：' || n_nationkey AS extra FROM nation JOIN region ON r_regionkey = n_regionkey""")
def rename_projection(t):
    """F1, M5: rows by label to short keys; an empty row goes, cells that mean empty are null, other columns are extras."""
    from ..operators import payload

    region = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    even = F.col("n_regionkey") % 2 == 0
    kzzd = F.concat(F.lit('{"注":"'), F.col("n_nationkey").cast("string"), F.lit('"}'))
    first = F.create_map(F.lit("名"), F.col("n_name"), F.lit("区"), F.when(even, F.col("r_name")).otherwise("暂 无"), F.lit("kzzd"), kzzd)
    blank, second = F.create_map(F.lit("名"), F.lit(" "), F.lit("区"), F.lit("N/A")), F.create_map(F.lit("名"), F.lit("b"), F.lit("区"), F.lit(""))
    rows = F.array(first, blank, second, F.when(even, second).otherwise(blank))
    d = t.nation.join(region, "n_regionkey").select("n_nationkey", payload.renamed(rows, {"名": "mc", "区": "qy"}).alias("tm"))
    return d.select("n_nationkey", F.size("tm").alias("rows"), F.col("tm")[0]["mc"].alias("mc"), F.col("tm")[0]["qy"].alias("qy"), C.flat_pairs(F.col("tm")[0]["kzzd"]).alias("extra"))


@query(r"""SELECT c_custkey, CASE WHEN regexp_full_match(s, '[A-Za-z0-9._-]{3,32}') THEN s ELSE '' END AS code FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment || c_custkey ELSE c_custkey || '.' END AS s FROM customer)""")
def code_validation(t):
    s = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, F.concat("c_mktsegment", F.col("c_custkey").cast("string"))).otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(".")))
    return t.customer.select("c_custkey", C.course_code(s).alias("code"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem w WHERE l_returnflag = 'N'
  AND NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_returnflag = 'R' AND f.l_quantity = 1 AND f.l_partkey = w.l_partkey) AND NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_returnflag = 'R' AND f.l_quantity = 1 AND f.l_orderkey = w.l_orderkey AND f.l_suppkey = w.l_suppkey)""")
def warning_dedup(t):
    line = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    failed = line.where("l_returnflag = 'R' and l_quantity = 1")
    return R.anti_either(line.where("l_returnflag = 'N'"), failed, [["l_partkey"], ["l_orderkey", "l_suppkey"]]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT doc_id, first_value(doc_id) OVER w AS canonical_id, CASE WHEN row_number() OVER w = 1 THEN 'canonical' ELSE 'duplicate' END AS role
  FROM documents WINDOW w AS (PARTITION BY rtrim(text) ORDER BY n_chars DESC, doc_id)""")
def canonical_pick(t):
    return R.canonical(t.documents.select("doc_id", "text", "n_chars"), F.rtrim("text"), [F.desc("n_chars")], "doc_id").select("doc_id", "canonical_id", "role")


@query("""WITH l AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1)
SELECT doc_id, CASE WHEN n_chars <= 300 THEN 'not_in_pdf' WHEN n_chars > 800 THEN CASE WHEN q IS NULL OR q = 1 THEN 'agree' ELSE 'db_weaker' END WHEN q = 1 THEN 'md_weaker' ELSE 'extraction_weak' END AS verdict,
  CASE WHEN q IS NULL THEN CASE WHEN n_chars > 800 THEN 'review_content' ELSE 'review_structure' END WHEN q = 1 THEN 'false_alarm' WHEN n_chars > 800 THEN 'lost_in_conversion' ELSE 'truly_missing' END AS cause
FROM documents LEFT JOIN l USING (doc_id)""")
def cross_layer_verdict(t):
    """J15, R12."""
    from ..operators import report

    q = t.labels.groupBy("doc_id").agg(F.max("quality").alias("q"))
    d = t.documents.select("doc_id", "n_chars").join(q, "doc_id", "left")
    said = F.when(F.col("q").isNull(), "uncertain").when(F.col("q") == 1, "extract_failure").otherwise("source_missing")
    return d.select("doc_id", report.layer_verdict(F.col("n_chars") > 300, F.col("n_chars") > 800, F.col("q") == 1).alias("verdict"), report.root_cause(F.col("n_chars") > 800, said).alias("cause"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'teaching_content' WHEN 1 THEN 'course_schedule' WHEN 2 THEN 'assessment_rows' END AS section, CASE WHEN p_partkey % 4 < 3 THEN (p_size > 25)::INT END AS header_row FROM part""")
def header_argmax(t):
    """The section that a table's header names, in its first or second row."""
    from ..operators import sections

    lit = lambda *c: F.array(*[F.lit(x) for x in c])
    k = F.col("p_partkey") % 4
    head = F.when(k == 0, lit("序号", "主 题", "知识点", "学时")).when(k == 1, lit("周次", "授课内容", "授课方式", "思政元素")).when(k == 2, lit("考核形式", "考核内容", "占比", "备注")).otherwise(lit("甲", "乙", "丙", "丁"))
    body = F.array(F.lit("1"), F.lit("x"), F.lit("y"), F.col("p_size").cast("string"))
    title = F.array(F.col("p_name"), F.lit(""), F.lit(""), F.lit(""))
    grid = F.when(F.col("p_size") > 25, F.array(title, head, body)).otherwise(F.array(head, body, body))
    return t.part.select("p_partkey", sections.header_of(grid).alias("h")).select("p_partkey", "h.section", F.col("h.row").alias("header_row"))


@query("""WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT 'extraction:' || (o_orderkey + 1) AS subject_key, 15 + (o_orderkey % 3 > 0 AND n > 0)::INT + 3 + 2 + 11 + 8 * n + (o_orderstatus = 'P')::INT + 2 + 18 + 4 + 4 + 3 + 1 + CASE WHEN n = 0 THEN 2 ELSE 8 * n END + 1 AS findings
FROM (SELECT o_orderkey, o_orderstatus, coalesce(n, 0) AS n FROM orders LEFT JOIN n ON l_orderkey = o_orderkey)""")
def finding_union(t):
    """The bag union of all rules' findings, numbered without gaps."""
    from ..operators import audit

    subjects, library = _subjects(t)
    found = audit.field_findings(audit.evaluate(audit.match(subjects, library), fields=()))
    counted = found.groupBy("subject_key").agg(F.count("*").alias("findings"), F.max("ord").alias("last"))
    return counted.where(F.col("last") + 1 == F.col("findings")).select("subject_key", "findings")


@query("""SELECT event_type, count(*) AS n, array_to_string((list(event_id ORDER BY ts DESC, event_id DESC))[1:5], ',') AS newest FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 500) GROUP BY event_type""")
def sorted_slices(t):
    """A batch of the newest, and first items of each group."""
    newest = R.newest(t.events.select("event_id", "event_type", "ts"), [F.desc("ts"), F.desc("event_id")], 500)
    ids = F.transform(F.slice(F.sort_array(F.collect_list(F.struct("ts", "event_id")), asc=False), 1, 5), lambda x: x["event_id"].cast("string"))
    return newest.groupBy("event_type").agg(F.count("*").alias("n"), F.array_join(ids, ",").alias("newest"))


@query("""WITH l AS (SELECT l_orderkey, sum(l_quantity)::INT AS h FROM lineitem GROUP BY 1)
SELECT 'extraction:' || (o_orderkey + 1) AS subject_key, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 3 > 0 THEN '教学内容总学时与基础信息不一致：基础信息为 ' || h || '，教学内容为 ' || (h + 1) END AS totals,
  CASE WHEN o_orderkey % 4 = 0 THEN '教学内容条目学时合计与总学时不一致：条目合计为 ' || h || '，总学时为 ' || (h + 1) END AS items FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def hour_consistency(t):
    """R4."""
    from ..operators import audit

    subjects, _ = _subjects(t)
    total = (F.col("payload.jxnr.zongxs").cast("int") + (F.col("extraction_id") % 4 == 1).cast("int")).cast("string")
    two = audit.hour_consistency()
    return subjects.withColumn("payload", F.col("payload").withField("jxnr.zongxs", total)).select("subject_key", two[0]["message"].alias("totals"), two[1]["message"].alias("items"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'extraction:' || page_id WHEN page_id % 3 = 1 THEN 'source:' || md5(url) ELSE 'result:' || page_id END AS k, CASE page_id % 2 WHEN 0 THEN 'even page' ELSE 'odd page' END AS label FROM pages""")
def backfill_key(t):
    e = F.when(F.col("page_id") % 3 == 0, F.col("page_id"))
    path = F.when(F.col("page_id") % 3 == 1, F.col("url")).otherwise("")
    return t.pages.select("page_id", C.backfill_key(e, path, "page_id").alias("k"), C.labelled((F.col("page_id") % 2).cast("string"), {"0": "even page", "1": "odd page"}).alias("label"))


@query("""SELECT event_id, (props->>'$.k') IS NOT NULL AS has_k, (props->>'$.z') IS NOT NULL AS has_z, 1::BIGINT AS n_keys, 'k：' || (props->>'$.k') AS flat FROM events""")
def json_shape(t):
    m = F.from_json("props", "map<string,string>")
    return t.events.select("event_id", F.map_contains_key(m, "k").alias("has_k"), F.map_contains_key(m, "z").alias("has_z"), F.size(m).cast("bigint").alias("n_keys"), C.flat_pairs(C.extras_rows(m)).alias("flat"))


@query(r"""SELECT conv_id, 'meta.raw_pages[' || i || ']' AS source_path, md5(x) AS text_md5 FROM (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS i, regexp_replace(regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '^\s+|\s+$', '', 'g') AS x FROM conversations) WHERE x <> ''""")
def source_flatten(t):
    """M9: texts of a meta's pages with their paths."""
    from .. import schemas
    from ..operators import audit

    pages = F.transform(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"])
    meta = F.from_json(F.lit("{}"), schemas.META).withField("raw_pages", F.col("pages"))
    metas = t.conversations.groupBy("conv_id").agg(pages.alias("pages")).select("conv_id", meta.alias("meta"))
    return metas.select("conv_id", F.explode(audit.sources()).alias("s")).select("conv_id", "s.source_path", F.md5("s.text").alias("text_md5"))


@query(r"""SELECT p_partkey, lower(regexp_replace(p_name, '[\s:;,()\[\]<>"''_-]+', '', 'g')) AS label, regexp_full_match(p_size::VARCHAR, '[0-9]+') AS seq FROM part""")
def label_normalise(t):
    return t.part.select("p_partkey", C.normal_label("p_name").alias("label"), C.is_sequence(F.col("p_size").cast("string")).alias("seq"))


@query("""SELECT l_orderkey, i, i::VARCHAR AS number, CASE WHEN i % 2 = 0 THEN l_returnflag ELSE l_returnflag || ' ' || l_linestatus END AS topic, CASE WHEN i % 2 = 0 THEN l_linestatus || ' w' ELSE l_returnflag || ' ' || l_linestatus END AS known, l_quantity::INT::VARCHAR AS hours,
  (count(*) FILTER (i % 2 = 1) OVER (PARTITION BY l_orderkey))::INT AS unsure FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i FROM lineitem)""")
def line_rows(t):
    """Rows that the lines of a text hold: of several columns the first is the topic, one column is both, with a
    warning; a header run together is noise."""
    from ..operators import text_rows

    rows = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")))
    two = lambda r, i: F.when(i % 2 == 1, F.concat(r["l_returnflag"], F.lit("  "), r["l_linestatus"], F.lit("\tw"))).otherwise(F.concat(r["l_returnflag"], F.lit(" "), r["l_linestatus"]))
    line = lambda r, i: F.concat((i + 1).cast("string"), F.lit("、 "), two(r, i), F.lit(" "), r["l_quantity"].cast("int").cast("string"), F.lit("学时"))
    text = F.concat(F.lit("序号 主题 知识点 学时\n\n"), F.array_join(F.transform(rows, line), "\n"))
    found = t.lineitem.groupBy("l_orderkey").agg(text.alias("text")).select("l_orderkey", text_rows.content(F.col("text")).alias("c"))
    found = found.select("l_orderkey", F.posexplode("c.rows"), F.size("c.warnings").alias("unsure"))
    return found.select("l_orderkey", (F.col("pos") + 1).cast("bigint").alias("i"), F.col("col")["序号"].alias("number"), F.col("col")["主题"].alias("topic"), F.col("col")["知识点"].alias("known"), F.col("col")["学时"].alias("hours"), "unsure")


@query("""SELECT o_orderkey, CASE WHEN x = floor(x) THEN x::BIGINT::VARCHAR ELSE x::VARCHAR END AS number, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS run FROM (SELECT *, (o_orderkey % 7) / 2 AS x FROM orders)""")
def number_format(t):
    x = (F.col("o_orderkey") % 7) / 2
    return t.orders.select("o_orderkey", C.number_text(x).alias("number"), F.date_format("o_orderdate", "yyyyMMdd_HHmmss").alias("run"))


# --- operators in Python: their inputs are made so that SQL can say what they must give ---
@query("""SELECT page_id, r, c, value FROM (SELECT page_id, unnest([0, 0, 0, 0, 1, 1, 1, 1]) AS r, unnest([0, 1, 2, 3, 0, 1, 2, 3]) AS c,
  unnest([page_id::VARCHAR, NULL, split_part(url, '/', 3), NULL, page_id::VARCHAR, page_id::VARCHAR, length(html)::VARCHAR, 'x y']) AS value FROM pages)""")
def html_grid(t):
    """H1: a cell over two rows and two columns, one over two columns, a line break; blank cells are null."""
    from ..functions.grids import grids_of

    table = F.concat(F.lit("<p>a</p><table><tr><td rowspan=2 colspan=2>"), F.col("page_id").cast("string"), F.lit("</td><td>"), F.split("url", "/")[2], F.lit("</td><td> </td></tr><tr><td>"), F.length("html").cast("string"), F.lit("</td><td> x<br> y</td></tr></table>"))
    grids = t.pages.select("page_id", grids_of(table).alias("g"))
    return grids.select("page_id", F.posexplode(F.col("g")[0]).alias("r", "cells")).select("page_id", "r", F.posexplode("cells").alias("c", "value"))


@query("""WITH p AS (SELECT doc_id, hint, text, string_split(text, hint) AS p FROM documents, (VALUES ('license'), ('token')) h(hint)),
o AS (SELECT doc_id, hint, text, p, unnest(range(1, len(p))) AS i FROM p), a AS (SELECT doc_id, hint, text, (list_sum(list_transform(p[1:i], lambda x: length(x))) + (i - 1) * length(hint))::INT AS pos FROM o)
SELECT doc_id, hint, greatest(0, pos - 20) AS start, substr(text, greatest(0, pos - 20) + 1, pos - greatest(0, pos - 20) + length(hint) + 40) AS snippet FROM a""")
def keyword_snippets(t):
    """C14."""
    from ..functions.text import snippets

    found = t.documents.select("doc_id", F.explode(snippets(F.col("text"), ("license", "token"), 20, 40)).alias("s"))
    return found.select("doc_id", "s.hint", "s.start", "s.snippet")


@query("""SELECT p_partkey, array_to_string(CASE p_partkey % 3 WHEN 0 THEN list_filter([p_size], lambda x: x <= 19) WHEN 1 THEN range(1, least(p_size, 19) + 1)::INT[] ELSE list_sort(list_distinct(list_filter([p_size, 14], lambda x: x <= 19))) END, ',') AS weeks,
  array_to_string(CASE WHEN p_size <= 19 THEN [] WHEN p_partkey % 3 = 1 THEN range(20, p_size + 1)::INT[] ELSE [p_size] END, ',') AS out_of_range, 0 AS errors FROM part""")
def week_parse(t):
    """N4, N5."""
    from ..functions.weeks import week_expression

    size = F.col("p_size").cast("string")
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("第"), size, F.lit("周"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("1-"), size)).otherwise(F.concat(size, F.lit("、十四周")))
    w = t.part.select("p_partkey", week_expression(text).alias("w"))
    return w.select("p_partkey", F.array_join("w.weeks", ",").alias("weeks"), F.array_join("w.out_of_range", ",").alias("out_of_range"), F.size("w.errors").alias("errors"))


@query("SELECT c_custkey, c_custkey % 4 <> 3 AS equal FROM customer")
def nfkc_name_equal(t):
    """C4: full-width letters, other case, spaces beside brackets; a name cut short differs."""
    from ..functions.text import normal_english_name

    wide = F.translate("c_name", "#0123456789", "＃０１２３４５６７８９")
    k = F.col("c_custkey") % 4
    other = F.when(k == 0, wide).when(k == 1, F.upper("c_name")).when(k == 2, F.concat(F.lit("《 "), F.col("c_name"), F.lit("》"))).otherwise(F.expr("substring(c_name, 1, length(c_name) - 1)"))
    return t.customer.select("c_custkey", (normal_english_name(other) == normal_english_name("c_name")).alias("equal"))


def _subjects(t):
    """Audit subjects and library made of orders and customers: totals, weeks and names that agree or not by rule."""
    from .. import schemas
    from ..functions.columns import subject_key

    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").cast("int").alias("hours"), F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("q")))).alias("items"))
    d = t.orders.join(lines, "o_orderkey", "left").join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", "left")
    text = lambda c: F.col(c).cast("string")
    basic = {"kcbh": F.when(F.col("o_orderkey") % 5 > 0, text("o_custkey")), "zwkcmc": F.col("c_name"), "ywkcmc": F.lower("c_name"), "zxs": F.lit("2"), "skzs": (F.col("o_orderkey") % 19 + 1).cast("string"), "zongxs": F.when(F.col("o_orderkey") % 3 > 0, text("hours")), "jsgh": text("o_custkey")}
    schema = schemas.struct(f"p {schemas.PAYLOAD}, m {schemas.META}")
    jcxx = F.struct(*[basic.get(f.name, F.lit(None).cast("string")).alias(f.name) for f in schema["p"].dataType["jcxx"].dataType])
    none = F.lit(None).cast("string")
    extra = F.array().cast("array<struct<bt:string,nr:string>>")
    content = F.transform("items", lambda r: F.struct(r["n"].cast("string").alias("xh"), F.lit("t").alias("zt"), F.lit("z").alias("zsd"), r["q"].cast("string").alias("xs"), extra.alias("kzzd")))
    plan = F.transform("items", lambda r: F.struct(r["n"].cast("string").alias("zs"), F.lit("c").alias("sknr"), none.alias("skfs"), none.alias("szyqjxx"), extra.alias("kzzd")))
    payload = F.struct(jcxx.alias("jcxx"), F.lit("简介").alias("kczwjj"), none.alias("kcywjj"), none.alias("ybzsyq"), none.alias("jcjydcl"), F.col("o_orderpriority").alias("kcyq"),
                       F.struct(F.lit("a").alias("szmb"), none.alias("nlmb"), none.alias("zsmb"), none.alias("mbgs"), extra.alias("kzzd")).alias("kcmb"),
                       F.struct(content.alias("tm"), text("hours").alias("zongxs"), none.alias("nrgs")).alias("jxnr"), F.struct(plan.alias("tm"), none.alias("apgs")).alias("jxap"),
                       F.lit(None).cast(schema["p"].dataType["khfsb"].dataType).alias("khfsb")).cast(schemas.PAYLOAD)
    meta = F.from_json(F.to_json(F.struct(F.concat(F.lit("课程基本信息 总学时："), text("hours")).alias("full_text"))), schemas.META)
    path = F.concat(F.lit("orders/"), F.col("c_name"), F.lit(".pdf"))
    subjects = d.select((F.col("o_orderkey") + 1).alias("extraction_id"), F.coalesce(basic["kcbh"], F.lit("")).alias("course_code"), path.alias("source_path"), payload.alias("payload"), meta.alias("meta"), F.when(F.col("o_orderstatus") == "P", "partial").otherwise("success").alias("extraction_status"), subject_key(F.col("o_orderkey") + 1, path).alias("subject_key"))
    library = t.customer.select(*[{"kcbh": F.col("c_custkey").cast("string"), "zwkcmc": F.col("c_name"), "ywkcmc": F.upper("c_name"), "zxs": F.lit("2.0"), "skzs": F.lit("10")}.get(c, none).alias(c) for c in schemas.struct(schemas.COURSES).names])
    return subjects, library


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS last, sum(l_quantity)::INT AS h FROM lineitem GROUP BY 1),
shared AS (SELECT o_custkey FROM orders WHERE o_orderkey % 5 > 0 GROUP BY 1 HAVING count(*) > 1),
s AS (SELECT o.o_orderkey AS o, o_orderkey % 5 = 0 AS blank, o_orderkey % 19 + 1 AS weeks, coalesce(n, 0) AS n, last, h, o_orderstatus = 'P' AS partial, s.o_custkey IS NOT NULL AND o_orderkey % 5 > 0 AS shared
  FROM orders o LEFT JOIN l ON l_orderkey = o_orderkey LEFT JOIN shared s ON s.o_custkey = o.o_custkey)
SELECT 'extraction:' || (o + 1) AS subject_key, 'matched' AS match_status, CASE WHEN blank OR shared THEN 'document_name' ELSE 'code' END AS match_method,
  40 + 2 * blank::INT + (weeks <> 10)::INT + coalesce(o % 3 > 0 AND 2 * weeks <> h, false)::INT + coalesce(last <> weeks, true)::INT + 4 * n + 7 * (n = 0)::INT AS fail_count, partial::INT AS warning_count, 'fail' AS overall_status,
  CASE WHEN blank THEN '课程编号为空' ELSE 'PDF 和课程库中的开课（院）系都为空' END AS message, 5 AS messages, 20 AS reasons FROM s""")
def audit_results(t):
    """Matching, rules and roll-up of every subject: J1 to J4, R1 to R9, G10, X1."""
    from ..operators import audit

    subjects, library = _subjects(t)
    out = audit.results(audit.evaluate(audit.match(subjects, library), fields=("reason", "message"), passed=False))
    return out.select("subject_key", "match_status", "match_method", "fail_count", "warning_count", "overall_status", F.col("messages")[0].alias("message"), F.size("messages").alias("messages"), F.size("reasons").alias("reasons"))


def _expected_reasons() -> str:
    """SQL of what the rules must say of ``_subjects``: of the match and the basic fields, and of the template."""
    from .. import config as c

    filled = {"kcbh": "coded", "zwkcmc": "true", "ywkcmc": "true", "zxs": "true", "skzs": "true", "zongxs": "total", "jsgh": "true"}
    unlike = {"kcbh": "课程编号为空", "skzs": "上课周数与课程库不一致：课程库为 10，PDF 为 ' || weeks || '", "zongxs": "课程库中总学时为空"}
    same = {"kcbh": "coded", "skzs": "weeks = 10", "zwkcmc": "true", "ywkcmc": "true", "zxs": "true"}
    compared = []
    for own, _ in c.COMPARED:
        label = c.LABEL_OF[own]
        both = f"'PDF 和课程库中的{label}都为空'"
        compared.append(both if own not in filled else f"CASE WHEN {filled[own]} THEN '{unlike[own]}' ELSE {both} END" if own == "zongxs" else f"CASE WHEN NOT ({same[own]}) THEN '{unlike.get(own, '')}' END")
    formula = "CASE WHEN total AND 2 * weeks <> h THEN '总学时不等于周学时乘以上课周数：总学时为 ' || h || '，周学时 2 × 上课周数 ' || weeks || ' = ' || 2 * weeks END"
    contacts = [f"'{c.LABEL_OF[k]}为空'" for k in c.CONTACT_FIELDS if k not in filled]
    match = f"CASE WHEN shared THEN '{c.SHARED_CODE[True]}' END", f"CASE WHEN shared THEN '{c.MATCHED['document_name', True]}' WHEN coded THEN '{c.MATCHED['code', False]}' ELSE '{c.MATCHED['document_name', False]}' END"
    basic = ", ".join([match[0], f"replace({match[1]}, '{{name}}', c_name)", *compared, formula, *contacts])
    titled = "CASE WHEN h IS NOT NULL THEN '；原文辅助信息中只有章节标题，没有该字段的填写内容' ELSE '' END"
    parts = [f"CASE WHEN NOT ({filled.get(k, 'false')}) {'AND h IS NULL ' if k == 'zongxs' else ''}THEN '{label}为空' || {titled} END" for label, k in c.BASIC_FIELDS.items() if k not in c.KEY_PRESENT_FIELDS]
    parts += [f"'{c.LABEL_OF[k]}字段缺失'" for k in c.KEY_PRESENT_FIELDS] + [f"'{label}为空'" for k, label in c.TOP_LEVEL.items() if k != "kczwjj"] + [f"'{label}为空'" for k, label in c.GOALS.items() if k != "szmb"]
    parts += ["CASE WHEN n = 0 THEN '教学内容总学时为空' END", "CASE WHEN n = 0 THEN '教学内容表为空' END"]
    rows = [f"jxap第 ' || i || ' 行{c.TEMPLATE_ROWS['jxap'][k]}为空" for k in ("skfs", "szyqjxx")]
    table = f"CASE WHEN n = 0 THEN ['教学安排表为空'] ELSE flatten(list_transform(range(1, n + 1), lambda i: ['{rows[0]}', '{rows[1]}'])) END"
    clean = lambda x: f"array_to_string(list_filter({x}, lambda r: r IS NOT NULL), '；')"
    return f"{clean(f'[{basic}]')} AS basic, {clean(f'list_concat([{', '.join(parts)}], {table})')} AS template"


@query(f"""WITH l AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS last, sum(l_quantity)::INT AS h FROM lineitem GROUP BY 1),
shared AS (SELECT o_custkey FROM orders WHERE o_orderkey % 5 > 0 GROUP BY 1 HAVING count(*) > 1),
s AS (SELECT o_orderkey, c_name, o_orderkey % 5 > 0 AS coded, o_orderkey % 19 + 1 AS weeks, coalesce(n, 0) AS n, last, h, o_orderkey % 3 > 0 AND h IS NOT NULL AS total, shared.o_custkey IS NOT NULL AND o_orderkey % 5 > 0 AS shared
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN l ON l_orderkey = o_orderkey LEFT JOIN shared ON shared.o_custkey = orders.o_custkey),
r AS (SELECT *, {_expected_reasons()} FROM s)
SELECT 'extraction:' || (o_orderkey + 1) AS subject_key, unnest(['kcjbxxsfykckyz', 'jxnrsfyxspp', 'jxapsfyzcpp', 'xxyzwzfhmb']) AS wd, unnest(['fail', CASE WHEN n = 0 THEN 'fail' ELSE 'pass' END, CASE WHEN last = weeks THEN 'pass' ELSE 'fail' END, 'fail']) AS status,
  unnest([basic, CASE WHEN n = 0 THEN '基础信息总学时为空；教学内容总学时为空' ELSE '' END,
    CASE WHEN last IS NULL THEN '教学安排周次为空，无法判断最大周次是否匹配' WHEN last = weeks THEN '' ELSE '教学安排最大周次为 ' || last || '，基础信息上课周数为 ' || weeks END, template]) AS reasons FROM r""")
def dimension_statuses(t):
    """Verdicts of the rules' dimensions, with every reason in its order."""
    from ..operators import audit

    subjects, library = _subjects(t)
    d = audit.dimension_findings(audit.evaluate(audit.match(subjects, library), fields=("reason",)))
    return d.select("subject_key", "wd", "status", F.array_join("reasons", "；").alias("reasons"))


@query("""SELECT event_id, CASE WHEN (props->>'$.k')::INT % 2 = 0 THEN 'fail' ELSE 'warning' END AS status, event_type || '存在抽取问题：' || CASE WHEN (props->>'$.k')::INT % 2 = 0 THEN '字段为空' ELSE '存在未知列' END || '。' AS message
  FROM events WHERE NOT ((props->>'$.k')::INT % 2 = 0 AND (event_type = 'view' OR user_id % 4 = 0))""")
def warning_findings(t):
    """Warnings as findings; of what failed already, by path or by section and field, only other reasons."""
    from .. import schemas
    from ..operators import audit

    k = F.get_json_object("props", "$.k").cast("int")
    w = F.struct(F.lit("jxnr").alias("section"), F.col("event_type").alias("field"), F.when(k % 2 == 0, "missing_field").otherwise("unknown_columns").alias("reason"), F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string")).alias("path"))
    meta = F.from_json(F.to_json(F.struct(F.array(w).alias("extraction_warnings"))), schemas.META)
    failed = F.array(audit.finding("jxnr", "view", "q", "fail", "x"), audit.finding("other", "f", "p0", "fail", "x"), audit.finding("jxnr", "click", "p9", "pass", "x"))
    found = t.events.select("event_id", meta.alias("meta"), failed.alias("failed")).select("event_id", F.explode(audit.extraction_warnings(F.col("failed"))).alias("f"))
    return found.select("event_id", "f.status", "f.message")


@query("""SELECT 'extraction:' || (o_orderkey + 1) AS subject_key, CASE WHEN o_orderstatus = 'P' THEN 'warning' END AS status, CASE WHEN o_orderstatus = 'P' THEN 'PDF 抽取状态为 partial' END AS message,
  CASE WHEN o_orderkey % 3 > 0 THEN 'payload' ELSE 'meta' END AS source, (o_orderkey + 7)::INT AS number FROM orders""")
def semantic_numbers(t):
    """A number from the payload, else from the text near a hint of its section."""
    from .. import config
    from ..functions import places as L
    from ..operators import audit

    number = (F.col("extraction_id") + 6).cast("string")
    value = F.when((F.col("extraction_id") - 1) % 3 > 0, F.concat(number, F.lit("学时")))
    told = F.array(F.struct(F.lit("meta.full_text").alias("source_path"), F.concat(F.lit("总学时 99\n" + "x" * 900 + "课程基本信息\n总学时："), number).alias("text")))
    subjects, _ = _subjects(t)
    hints, words = config.SECTION_HINTS["jcxx"], config.TOTAL_KEYWORDS["jcxx"]
    found = subjects.withColumn("_sources", L.indexed(told, (*hints, *words))).withColumn("_near", L.around(F.col("_sources"), L.words(hints)))
    found = found.select("subject_key", audit.extraction_status().alias("f"), audit.semantic_numbers([(value, F.col("_near"), words)], F.col("_sources"))[0].alias("n"))
    return found.select("subject_key", "f.status", "f.message", "n.source", "n.number")


@query("""
SELECT 'extraction:' || (o_orderkey + 1) AS subject_key, zxs * skzs = total AS formula_pass, CASE WHEN zxs * skzs = total THEN '总学时等于周学时乘以上课周数。' ELSE
  '总学时不等于周学时乘以上课周数：总学时为 ' || total || '，周学时 2 × 上课周数 ' || skzs || ' = ' || zxs * skzs END AS message
FROM (SELECT o_orderkey, 2 AS zxs, o_orderkey % 19 + 1 AS skzs, sum(l_quantity)::INT AS total FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 3 > 0 GROUP BY 1)""")
def audit_formula(t):
    """N9."""
    from ..operators import audit

    subjects, _ = _subjects(t)
    f = subjects.select("subject_key", audit.hours_formula().alias("f")).where("f is not null")
    return f.select("subject_key", (F.col("f.status") == "pass").alias("formula_pass"), F.col("f.message").alias("message"))


@query("""SELECT 'extraction:' || (o_orderkey + 1) AS subject_key, wd, 'fail' AS status, '否' AS message, n AS fields, 'no_llm' AS call, '未配置 LLM，无法审核' || label || '，需人工复核' AS reason
  FROM orders, (VALUES ('jxmbnrfsfhyq', 3, '教学目标、内容、方式是否符合要求'), ('szysfyxrghj', 1, '是否将思政元素有效融入各环节')) d(wd, n, label)""")
def llm_offline(t):
    """Judged dimensions without a client: every item is for manual review, with its trace."""
    from ..operators import judges

    subjects, _ = _subjects(t)
    out = judges.unasked(subjects, judges.GOALS_DIMENSION, judges.IDEOLOGY_DIMENSION)
    return out.select("subject_key", "wd", "status", "message", F.size("fields").alias("fields"), F.get_json_object("llm_trace", "$.calls[0].status").alias("call"), F.col("fields")[0]["reason"].alias("reason"))


@query("""WITH g AS (SELECT l_orderkey, l_linenumber, count(DISTINCT l_quantity) AS n, min(l_quantity)::INT AS q FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey::VARCHAR AS source_path, CASE WHEN l_orderkey >= 10 THEN 'K' || l_orderkey ELSE '' END AS course_code, count(*) AS rows, coalesce(sum(q) FILTER (n = 1)::VARCHAR, '') AS hours, 'partial' AS extraction_status,
  (l_orderkey < 10)::INT + (count(*) = 1)::INT AS code_and_rows FROM g GROUP BY l_orderkey""")
def section_tables(t):
    """Markdown with tables made of lines of orders, parsed, built to payloads and given their status.

    Lines of one number are one logical row, whose hours count only where they are one number.
    """
    from ..operators import payload, sections

    cell = lambda *c: F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", *c), F.lit("</td></tr>"))
    row = cell(F.col("l_linenumber").cast("string"), F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity").cast("int").cast("string"))
    rows = F.array_join(F.sort_array(F.collect_list(row)), "")
    head = "<table><tr><td>序号</td><td>主题</td><td>知识点</td><td>学时</td></tr>"
    md = t.lineitem.groupBy("l_orderkey").agg(F.concat(F.lit("课程编号：K"), F.col("l_orderkey").cast("string"), F.lit(f"\n## 教学内容\n{head}"), rows, F.lit("</table>")).alias("md"))
    raw = sections.raw_records(md.select(F.col("l_orderkey").cast("string").alias("source_path"), "md", F.lit(None).cast("string").alias("middle")), int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    done = payload.finish(payload.build(raw))
    warned = F.size(F.filter("meta.extraction_warnings", lambda w: (w["field"] == "kcbh") | (w["reason"] == "suspiciously_few_rows")))
    return done.select("source_path", "course_code", F.size("payload.jxnr.tm").cast("bigint").alias("rows"), F.col("payload.jxnr.zongxs").alias("hours"), "extraction_status", warned.alias("code_and_rows"))


# --- parts of the extraction, as column functions ---
@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN 'K' || p_partkey ELSE 'X1' END AS code, '3' || p_size AS hours, CASE WHEN p_size > 25 THEN 'a、b' ELSE 'a' END AS teachers, 'M' || p_partkey AS intro, CASE WHEN p_size % 2 = 0 THEN 'g' || p_partkey END AS goal FROM part""")
def pair_fields(t):
    """Fields of tables of labels and values, glued ones too, of teachers and of two columns."""
    from ..functions import grids

    lit, key = F.lit, F.col("p_partkey").cast("string")
    second = F.array(lit("任课教师姓名"), lit("教师工号")), F.array(lit("a"), lit("1")), F.array(F.when(F.col("p_size") > 25, "b").otherwise("a"), lit("2"))
    first = F.when(F.col("p_size") > 25, F.concat(lit("课 程 编 号"), key)).otherwise("")
    pairs = F.array(F.array(lit("课 程编号"), F.concat(lit("K"), key)), F.array(F.concat(lit("总学时：3"), F.col("p_size").cast("string")), F.when(F.col("p_size") > 25, "").otherwise("课程编号X1")))
    goals = F.array(F.array(F.when(F.col("p_size") % 2 == 0, "育人目标").otherwise("思政目标"), F.concat(lit("g"), key)), F.array(lit("课程中文简介"), F.concat(lit("M"), key)))
    d = t.part.select("p_partkey", first.alias("first"), grids.fields_of(pairs).alias("a"), grids.fields_of(F.array(*second)).alias("b"), grids.fields_of(goals).alias("c"), grids.extra_goals(goals).alias("e"))
    return d.select("p_partkey", F.col("a")["课程编号"].alias("code"), F.col("a")["总学时"].alias("hours"), F.col("b")["任课教师姓名"].alias("teachers"), F.col("c")["课程中文简介"].alias("intro"), F.col("e")["育人目标"].alias("goal"))


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN 'yy' ELSE '' END AS filled, 'own' AS kept, CASE WHEN p_size % 2 = 0 THEN 'presentation' ELSE 'presen' END AS head, 2 AS rows FROM part""")
def grid_fill(t):
    """A grid's blank cells from a donor of like header; a header word cut in two, and a phantom row."""
    from ..functions import grids

    lit = lambda *c: F.array(*[F.lit(x) for x in c])
    own = F.array(lit("序号", "主题"), lit("1", ""), lit("2", "own"))
    donor = F.array(F.when(F.col("p_size") > 25, lit("序 号", "主题")).otherwise(lit("甲", "乙")), lit("1", "yy"), lit("2", "other"))
    cut = F.array(lit("presen", "tation", "b"), lit(" ", "", ""), F.array(F.lit("1"), F.when(F.col("p_size") % 2 == 0, "").otherwise("x"), F.lit("2")))
    d = t.part.select("p_partkey", grids.filled(own, donor).alias("f"), grids.repaired(cut).alias("r"))
    return d.select("p_partkey", F.col("f")[1][1].alias("filled"), F.col("f")[2][1].alias("kept"), F.col("r")[0][0].alias("head"), F.size("r").alias("rows"))


@query("""SELECT p_partkey, p_size || '-' || (p_size + 1) AS weeks, 't' || p_partkey AS content, p_brand AS method, '诚信 守时' AS ideology, '讨论' AS told, '思政' || p_partkey AS said, 1 AS unsure, '平时' AS part, (p_size % 9 + 1) || '0%' AS share, 1 AS shares, 'g' || p_partkey || chr(10) || p_type AS goal, 'x' AS ability, '作业要求' AS kind FROM part""")
def text_sections(t):
    """A schedule's columns, or what its line tells; an assessment's parts (equal ones once), goals by their
    aliases and requirements, from text."""
    from ..operators import text_rows

    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    plan = F.concat(F.lit("周次 授课内容 授课方式\n第"), size.cast("string"), F.lit("-"), (size + 1).cast("string"), F.lit("周  t"), key, F.lit("  "), F.col("p_brand"), F.lit("  诚信 | 守时\n3 案导 讨论 思政"), key, F.lit("\n4 别的"))
    share = F.concat(F.lit("，平时成绩 占 "), (size % 9 + 1).cast("string"), F.lit("0%。"))
    d = t.part.select(
        "p_partkey", text_rows.schedule(plan).alias("s"), text_rows.assessment(F.concat(share, share))["rows"].alias("a"),
        text_rows.goals(F.concat(F.lit("价值目标：g"), key, F.lit("\n"), F.col("p_type"), F.lit("\n能力目标：x"))).alias("g"), text_rows.requirements(F.lit("作业要求：按时\n其他")).alias("r"),
    )
    first, second = F.col("s.rows")[0], F.col("s.rows")[1]
    return d.select(
        "p_partkey", first["序号"].alias("weeks"), first["授课内容"].alias("content"), first["授课方式"].alias("method"), first["思政元素的融入和预期教学成效"].alias("ideology"), second["授课方式"].alias("told"), second["思政元素的融入和预期教学成效"].alias("said"), F.size("s.warnings").alias("unsure"),
        F.col("a")[0]["考察内容"].alias("part"), F.col("a")[0]["占比"].alias("share"), F.size("a").alias("shares"), F.col("g")["思政目标"].alias("goal"), F.col("g")["能力目标"].alias("ability"), F.col("r")[0]["要求类型"].alias("kind"),
    )


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'mineru_text_fallback' WHEN 3 THEN 'mineru_text_fallback' END AS picked, CASE p_size % 4 WHEN 2 THEN 12 WHEN 3 THEN 2 ELSE 1 END AS rows, '2,1,3' AS merged, p_brand AS filled, CASE WHEN p_size % 4 = 0 THEN '案例' END AS method, CASE WHEN p_size % 4 = 0 THEN '思政' || p_partkey END AS ideology FROM part""")
def row_choice(t):
    """Rows of table or text: one row gives way to two, merged by number; twelve rows don't give way to two
    whole ones; of table rows with one number the last counts.  Methods told by the content."""
    from ..operators import text_rows

    row = lambda n, v, z=None: F.create_map(F.lit("序号"), F.lit(n), F.lit("主题"), F.lit(v) if isinstance(v, str) else v, F.lit("知识点"), F.lit(z or ""))
    k = F.col("p_size") % 4
    none = F.array().cast("array<map<string,string>>")
    table = F.when(k < 2, F.array(row("1", "a"))).when(k == 2, F.array(*[row(str(i), "a") for i in range(12)])).otherwise(none)
    text = F.when((k == 0) | (k == 3), F.array(row("1", "x"), row("2", "y"))).when(k == 2, F.array(row("21", "x", "z"), row("22", "y", "z"))).otherwise(none)
    merged = text_rows.merge(F.array(row("1", "a"), row("2", "first"), row("2", ""), row("3", "c")), F.array(row("2", F.col("p_brand")), row("1", "z"), row("9", "q")))
    plan = F.array(F.create_map(F.lit("授课内容"), F.when(k == 0, F.concat(F.lit("案例 思政"), F.col("p_partkey").cast("string"))).otherwise("x")))
    d = t.part.select("p_partkey", text_rows.pick(table, text, "teaching_content").alias("p"), merged.alias("m"), text_rows.infer(plan).alias("i"))
    return d.select("p_partkey", F.col("p.source").alias("picked"), F.size("p.rows").alias("rows"), F.array_join(F.transform("m", lambda r: r["序号"]), ",").alias("merged"), F.col("m")[0]["主题"].alias("filled"), F.col("i")[0]["授课方式"].alias("method"), F.col("i")[0]["思政元素的融入和预期教学成效"].alias("ideology"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Deep Learning ' || p_partkey || ' Presentation' ELSE '数据abc' END AS english, '尾' || p_partkey AS untitled, CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR ELSE '' END AS total, CASE WHEN p_size % 3 = 0 THEN '是' ELSE '否' END AS verdict,
  'a/' || p_partkey || '.pdf' AS path, p_size % 3 = 0 AS noise, '（四）教学内容' AS line, 'K' || p_partkey AS code, '（甲）' || p_partkey AS bracket, CASE WHEN p_size % 3 = 0 THEN 'yes' ELSE 'no' END AS coded FROM part""")
def text_repairs(t):
    """Repairs and readings of small texts."""
    from ..functions import text as T

    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    english = F.when(size % 2 == 0, F.concat(F.lit("DeepLearning"), key, F.lit("Presen"))).otherwise("数据abc")
    told = F.when(size % 2 == 0, F.concat(F.lit("总学时：1\n课时总计：9学时\n课时总计："), size.cast("string"), F.lit(" 学时"))).otherwise("")
    anchored = F.split(T.anchored(F.concat(F.lit("x（四）教学内容"), key)), "\n")
    return t.part.select(
        "p_partkey", C.english_spacing(english).alias("english"), C.without_titles(F.concat(F.lit("教学内容 尾"), key, F.lit("课程内容")), ("教学内容", "课程内容")).alias("untitled"), C.total_hours(told).alias("total"),
        C.verdict(F.when(size % 3 == 0, " Yes").otherwise("不是")).alias("verdict"), C.relative_path(F.concat(F.lit("/r\\a\\"), key, F.lit(".pdf")), "/r").alias("path"), C.noise_line(F.when(size % 3 == 0, "序号 主题 知识点 学时").otherwise("1 a 2")).alias("noise"),
        anchored[1].alias("line"), T.text_fields(F.concat(F.lit("课程编号： K"), key, F.lit(" 等")))["课程编号"].alias("code"), C.bracket_label(F.concat(F.lit("( 甲)"), key)).alias("bracket"),
        C.coded(F.when(size % 3 == 0, "是").otherwise("否"), {"yes": "是", "no": "否"}).alias("coded"),
    )


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 2 THEN 'meta' ELSE 'payload' END AS source, CASE p_partkey % 3 WHEN 0 THEN '1,2,3' WHEN 1 THEN '1,2,3,4' ELSE '5,6' END AS weeks, CASE WHEN p_partkey % 3 = 0 THEN '3' ELSE '' END AS duplicates FROM part""")
def week_evidence(t):
    """Weeks of the schedule's rows, else of its overview, else of the text."""
    from ..functions.weeks import schedule_weeks

    k, none = F.col("p_partkey") % 3, F.array().cast("array<string>")
    cells = F.when(k == 0, F.array(F.lit("1-3"), F.lit("第3周"))).otherwise(none)
    overview = F.when(k == 1, "周次 1导论 2-3第二章 4复习").otherwise("")
    near = F.when(k == 2, F.array(F.lit("教学安排 第5周 导论 第6周 考试"))).otherwise(none)
    w = t.part.select("p_partkey", schedule_weeks(cells, overview, near).alias("w"))
    return w.select("p_partkey", "w.source", F.array_join("w.weeks", ",").alias("weeks"), F.array_join("w.duplicates", ",").alias("duplicates"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'extract_failure' WHEN 1 THEN 'source_missing' WHEN 2 THEN 'uncertain' ELSE 'source_missing' END AS verdict, page_id % 4 <> 3 AS named, page_id % 2 = 0 AS coded, page_id % 4 < 2 AS told FROM pages""")
def verification(t):
    """Warnings against the Markdown, labels and sections in recognised text."""
    from ..operators import report

    k, num = F.col("page_id") % 4, F.col("page_id").cast("string")
    table = F.concat(F.lit("## 教学安排\n<table><tr><td>周次</td><td>"), F.when(k == 0, "授课方式").otherwise("内容"), F.lit("</td></tr><tr><td>1</td><td>讲授"), num, F.lit("课</td></tr></table>一共有很多次课程"))
    md = F.when(k == 0, table).when(k == 1, "## 其他\nx").when(k == 2, table).otherwise("")
    text = F.concat(F.when(k % 2 == 0, "课程编号：A1\n").otherwise("x\n"), F.when(k < 2, F.concat(F.lit("教学内容\n第一章导论与历史"), num, F.lit("\n第二章方法与推断\n"))).otherwise(""), F.when(k != 3, "教学安排 授课方式 讲授").otherwise("授课方式"))
    d = t.pages.select("page_id", report.verified(md, F.lit("jxap"), F.lit("skfs"), F.lit("授课方式"), F.lit("missing_field")).alias("verdict"), report.recognised(text, F.lit("授课方式"), F.lit("jxap")).alias("named"), report.text_flags(text).alias("f"))
    return d.select("page_id", "verdict", "named", F.col("f.kcbh").alias("coded"), F.col("f.jxnr").alias("told"))


@query("""WITH l AS (SELECT DISTINCT l_orderkey FROM lineitem), d AS (SELECT o_orderkey AS o, o_orderkey % 5 > 0 AND o_custkey >= 10 AS code, l_orderkey IS NOT NULL AS has FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
SELECT section, count(*) AS total, count(*) FILTER (middle) AS middle, count(*) FILTER (md) AS md, count(*) FILTER (db) AS loose, count(*) FILTER (db) AS strict, count(*) FILTER (middle AND md) AS middle_md, count(*) FILTER (middle AND md AND db) AS middle_md_loose,
  count(*) FILTER (md AND NOT middle) AS md_only, count(*) FILTER (middle AND NOT md) AS middle_only FROM (
  SELECT 'kcbh' AS section, o % 2 = 0 AS middle, o % 3 = 0 AS md, code AS db FROM d UNION ALL SELECT 'jxnr', o % 2 = 1, o % 3 > 0, has FROM d UNION ALL SELECT 'jxap', false, false, has FROM d
  UNION ALL SELECT unnest(['kcmb', 'jxap_sz', 'khfsb']), false, false, false FROM d) GROUP BY section""")
def layer_coverage(t):
    """Sections of text layers and payloads, joined and counted."""
    from ..operators import report

    subjects, _ = _subjects(t)
    code, body = F.lit("课程编号：X1"), F.lit("教学内容\n第一章导论与历史\n第二章方法与推断")
    key = F.col("extraction_id") - 1
    keyed = subjects.withColumn("source_path", key.cast("string"))
    pdf = F.col("source_path").alias("source_pdf")
    extractions = keyed.select("source_path", "payload", "meta", "extraction_status", "extraction_id", F.lit(None).cast("timestamp").alias("created_at"))
    middles, markdown = (keyed.select(pdf, F.when(key % n == 0, code).otherwise(body).alias("text")) for n in (2, 3))
    joined = report.layers(keyed.select(pdf), extractions, middles, keyed.select(pdf, F.lit(None).cast("string").alias("text")), markdown)
    return report.coverage_matrix(joined).select("section", "total", "middle", "md", "loose", "strict", "middle_md", "middle_md_loose", "md_only", "middle_only")


@query("""WITH k AS (SELECT *, (props->>'$.k')::INT % 3 AS k FROM events)
SELECT event_type AS label, count(*) FILTER (k = 0) AS source_missing, count(*) FILTER (k = 1) AS extract_failure, count(*) FILTER (k = 2) AS uncertain, count(*) AS total, round_even(100 * count(*) FILTER (k = 1) / count(*), 1) AS false_rate,
  coalesce(min(event_id) FILTER (k = 1), -1) AS first_event FROM k GROUP BY event_type""")
def false_rates(t):
    """Verdicts of warnings with the share of false alarms, and samples."""
    from ..operators import report

    k = F.get_json_object("props", "$.k").cast("int") % 3
    d = t.events.select(F.lit("missing_field").alias("reason"), F.col("event_type").alias("label"), F.lit("jxap").alias("section"), F.when(k == 0, "source_missing").when(k == 1, "extract_failure").otherwise("uncertain").alias("verdict"), "event_id")
    first = R.samples(d.where("verdict = 'extract_failure'"), ["label"], "event_id", 1).select("label", F.col("samples")[0].alias("first_event"))
    out = report.false_rates(d).join(first, "label", "left")
    return out.select("label", "source_missing", "extract_failure", "uncertain", "total", "false_rate", F.coalesce("first_event", F.lit(-1)).alias("first_event"))


@query("""SELECT conv_id, i AS page, text FROM (SELECT conv_id, i, regexp_replace('第' || i || '页 思政 ' || n, '\\s+', ' ', 'g') AS text FROM (SELECT conv_id, n, unnest(range(0, least(n, 12))) AS i FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1)))""")
def page_segments(t):
    """Segments around keywords, page by page, twelve at most."""
    from ..functions import text as T

    n = t.conversations.groupBy("conv_id").agg(F.count("*").alias("n"))
    pages = F.transform(F.sequence(F.lit(0), F.col("n").cast("int") - 1), lambda i: F.concat(F.lit("第"), i.cast("string"), F.lit("页  思政\n"), F.col("n").cast("string")))
    return n.select("conv_id", F.explode(T.page_segments(pages, ("思政",))).alias("s")).select("conv_id", F.col("s.page").cast("bigint").alias("page"), "s.text")


@query("""SELECT o_orderkey, CASE WHEN n = 1 THEN 'Clerk' || (o_custkey % 50) ELSE 'Clerk' || (o_custkey % 50) || '_' || n END AS name FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS n FROM orders)""")
def unique_names(t):
    """A name for each row that no other has."""
    name = F.concat(F.lit("Clerk"), (F.col("o_custkey") % 50).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise(""))
    out = R.unique_names(t.orders.select("o_orderkey", name.alias("n")), "n", [F.col("o_orderkey")], "name")
    return out.select("o_orderkey", "name")


@query("""SELECT doc_id, 'a' || doc_id || 'b' AS clean, CASE WHEN doc_id % 2 = 0 THEN 'jcxx.kcbh,jxnr.tm[0].zt' ELSE '' END AS paths FROM documents""")
def control_characters(t):
    """C11: control characters dropped anywhere in a JSON value, with the paths that changed."""
    from ..functions import text as T

    mark = F.when(F.col("doc_id") % 2 == 0, F.lit("\x07")).otherwise("")
    value = F.concat(F.lit("a"), mark, F.col("doc_id").cast("string"), F.lit("b"))
    j = F.to_json(F.struct(F.struct(value.alias("kcbh")).alias("jcxx"), F.struct(F.array(F.struct(F.concat(F.lit("x"), mark).alias("zt"))).alias("tm")).alias("jxnr")))
    s = t.documents.select("doc_id", T.sanitised(j).alias("s"))
    return s.select("doc_id", F.get_json_object("s.json", "$.jcxx.kcbh").alias("clean"), F.array_join("s.paths", ",").alias("paths"))
