"""Settings of the course-plan domain: labels, keys, patterns and thresholds.

All values here are fixed: results depend on them.  ``load`` lays a YAML or dict of overrides over them.
"""

from __future__ import annotations

import copy
from functools import lru_cache
from typing import Any

# --- fixed values: field keys by label ---
BASIC_FIELDS = {
    "课程编号": "kcbh", "开课（院）系": "kkyx", "中文课程名称": "zwkcmc", "英文课程名称": "ywkcmc", "授课语言": "skyy",
    "是否允许外学院选课": "sfyxwxyxk", "考核方式": "khfs", "课程性质": "kcxz", "课程类别": "kclb", "周学时": "zxs",
    "上课周数": "skzs", "总学时": "zongxs", "教学学时": "jxxs", "实验学时": "syxs", "实践学时": "sjxs", "其他学时": "qtxs",
    "自学学时": "zxxs", "课程学分": "kcxf", "任课教师姓名": "rkjsxm", "教师工号": "jsgh", "E-mail": "email", "联系电话": "lxdh",
}
CONTENT_FIELDS = {"序号": "xh", "主题": "zt", "知识点": "zsd", "学时": "xs"}
SCHEDULE_FIELDS = {"序号": "zs", "授课内容": "sknr", "授课方式": "skfs", "思政元素的融入和预期教学成效": "szyqjxx"}
ASSESSMENT_FIELDS = {"考试形式": "ksxs", "考察内容": "kcnr", "考察方式": "kcfs", "占比": "zb"}
LIBRARY_FIELDS = {
    "课程编号": "kcbh", "开课（院）系": "kkyx", "中文课程名称": "zwkcmc", "英文课程名称": "ywkcmc", "上课语言": "skyy",
    "允许学院外选课": "yxwxyxk", "是否允许外学院选课": "yxwxyxk", "考核方式": "khfs", "课程性质": "kcxz", "课程类别": "kclb",
    "周学时": "zxs", "上课周数": "skzs", "总学时": "zongxs", "教学学时": "jxxs", "实验学时": "syxs", "实践学时": "sjxs",
    "其他学时": "qtxs", "自学学时": "zxxs", "学分": "kcxf", "主讲教师姓名": "zjjsxm", "其他课程": "qtkc", "是否生效": "sfsx",
    "审核状态": "shzt",
}
# --- fixed values: audit dimensions ---
DIMENSIONS = {
    "kcjbxxsfykckyz": "课程基本信息是否与课程库一致",
    "jxnrsfyxspp": "教学内容是否与学时匹配",
    "jxapsfyzcpp": "教学安排是否与周次匹配",
    "jxmbnrfsfhyq": "教学目标、内容、方式是否符合要求",
    "szysfyxrghj": "是否将思政元素有效融入各环节",
    "xxyzwzfhmb": "信息要素完整、符合模板、是否有中英文简介",
}
MODEL_DIMENSIONS = ("jxmbnrfsfhyq", "szysfyxrghj")
# --- fixed values: comparison of basic fields with the library ---
# (field of the document, field of the library)
COMPARED = [
    ("kcbh", "kcbh"), ("kkyx", "kkyx"), ("zwkcmc", "zwkcmc"), ("ywkcmc", "ywkcmc"), ("skyy", "skyy"), ("sfyxwxyxk", "yxwxyxk"), ("khfs", "khfs"), ("kcxz", "kcxz"),
    ("kclb", "kclb"), ("zxs", "zxs"), ("skzs", "skzs"), ("zongxs", "zongxs"), ("jxxs", "jxxs"), ("kcxf", "kcxf"), ("rkjsxm", "zjjsxm"),
]
NUMERIC_FIELDS = ("zxs", "skzs", "zongxs", "jxxs", "kcxf")
NAME_FIELDS = ("zwkcmc", "ywkcmc")
CONTACT_FIELDS = ("jsgh", "email", "lxdh")
LABEL_OF = {v: k for k, v in BASIC_FIELDS.items()}
TOP_LEVEL = {"kczwjj": "课程中文简介", "kcywjj": "课程英文简介", "ybzsyq": "预备知识要求", "jcjydcl": "教材及阅读材料"}
GOALS = {"szmb": "思政目标", "nlmb": "能力目标", "zsmb": "知识目标"}
GOAL_NAMES = {"思政目标": ("思政目标", "价值目标", "育人目标", "课程思政目标"), "能力目标": ("能力目标",), "知识目标": ("知识目标",)}
SECTION_TITLES = {"teaching_content": ("教学内容", "课程内容"), "course_schedule": ("教学安排", "课程安排", "授课安排", "教学进度"), "course_goal": ("课程目标", "教学目标")}
TABLE_ITEMS = {"jxnr": "教学内容条目", "jxap": "教学安排条目", "khfsb": "考核方式条目"}
ROW_REQUIRED = {
    "jxnr": {"xh": "序号", "zt": "主题", "zsd": "知识点", "xs": "学时"},
    "jxap": {"zs": "周次/序号", "sknr": "授课内容", "skfs": "授课方式", "szyqjxx": "思政元素融入"},
    "khfsb": {"ksxs": "考试形式", "kcnr": "考察内容", "kcfs": "考察方式", "zb": "占比", "fz": "分值"},
}
KEY_PRESENT_FIELDS = ("syxs", "sjxs", "qtxs", "zxxs")
TEMPLATE_ROWS = {
    "jxnr": {"xh": "序号", "zt": "主题", "zsd": "知识点", "xs": "学时"},
    "jxap": {"zs": "序号", "sknr": "授课内容", "skfs": "授课方式", "szyqjxx": "思政元素的融入和预期教学成效"},
}
TEMPLATE_TABLES = {"jxnr": "教学内容表", "jxap": "教学安排表"}
TEMPLATE_CHECKS = {"mbxxyzwz": "模板信息要素是否完整", "zywjj": "是否有中英文简介"}
# fixed too: other names under which a document may have a field
LABEL_NAMES = {
    "课程编号": ("课 程 编 号",), "开课（院）系": ("开课院系", "开课(院)系"), "中文课程名称": ("中文名",), "英文课程名称": ("英文名",), "任课教师姓名": ("主讲教师",),
    "E-mail": ("Email", "电子邮箱", "邮箱"), "课程/周次": ("周次", "序号", "课程"), "思政元素的融入和预期教学成效": ("思政元素", "预期教学成效"), "课程要求": ("学习要求", "课堂要求"),
    "教学内容条目": ("教学内容", "课程内容"), "教学安排条目": ("教学安排", "课程安排", "授课安排", "教学进度"), "考核方式条目": ("考核方式", "课程考核", "成绩评定"),
    "序号": ("编号",), "主题": ("单元",), "知识点": ("教学内容", "讲授内容"), "学时": ("课时", "教学学时"), "授课内容": ("讲授内容",), "授课方式": ("教学方式",), "考试形式": ("考核形式",), "占比": ("比例", "权重"),
}
SECTION_HINTS = {
    "jcxx": ("课程基本信息", "基本信息", "课程信息"), "kczwjj": ("课程中文简介",), "kcywjj": ("课程英文简介",),
    "ybzsyq": ("预备知识要求", "预备知识"), "jcjydcl": ("教材及阅读材料", "教材", "阅读材料"), "kcmb": ("课程目标", "教学目标"),
    "jxnr": ("教学内容", "课程内容"), "jxap": ("教学安排", "课程安排", "授课安排", "教学进度"), "kcyq": ("课程要求",),
}
TOTAL_KEYWORDS = {"jcxx": ("总学时", "课程总学时"), "jxnr": ("总学时", "合计", "合计学时", "小计"), "skzs": ("上课周数", "授课周数", "教学周数")}
IDEOLOGY_KEYWORDS = ("思政", "立德树人", "价值引领", "价值观", "责任感", "使命感", "家国情怀", "职业伦理", "社会责任", "诚信", "法治", "职业道德")
GOAL_HINTS = ("课程目标", "教学目标", "思政目标", "课程思政目标", "价值目标", "育人目标")
ARRANGEMENT_HINTS = ("教学安排", "课程安排", "授课安排", "教学进度", "课程思政", "思政元素", "思政元素融入")
# --- fixed values: texts that metrics look for, and words of warnings' reasons ---
MATCH_FAILURES = {"ambiguous": "文件路径或课程名称匹配到多条课程库记录，需人工复核", "not_found": "无法定位课程库记录"}
# --- fixed values: what is said of a match, {name} and {query} filled in ---
MATCHED = {
    ("code", False): "通过课程编号匹配到课程库课程：{name}", ("document_name", False): "通过 PDF 中的课程名称匹配到课程库课程：{name}", ("file_name", False): "通过文件路径匹配到课程库课程：{name}",
    ("code", True): "本轮审核中存在多个 PDF 填写同一课程编号，未能通过课程名称或文件名唯一定位其它课程，已按原课程编号定位审核对照课程：{name}",
    ("document_name", True): "本轮审核中存在多个 PDF 填写同一课程编号，已根据 PDF 中的课程名称定位审核对照课程：{name}",
    ("file_name", True): "本轮审核中存在多个 PDF 填写同一课程编号，已根据文件名定位审核对照课程：{name}",
}
SHARED_CODE = {
    True: "本轮审核中存在多个 PDF 填写同一课程编号，已启用课程名称和文件名辅助定位审核对照课程。",
    False: "本轮审核中存在多个 PDF 填写同一课程编号，但未能通过课程名称或文件名唯一定位其它课程，已按原课程编号进行审核。",
}
AMBIGUOUS_NAME = "课程名称“{query}”匹配到多条课程库记录，需人工复核"
UNMATCHED = {"code": "课程编号为空，已尝试通过课程名称和文件路径匹配课程库", "document_name": "PDF 中的课程名称未能唯一匹配课程库：{query}", "file_name": "文件路径中的课程名称未能唯一匹配课程库：{query}", "none": "无法从 PDF 或文件路径中取得可用于匹配课程库的信息"}
MISSING_WORDS = ("为空", "字段缺失", "缺失")
REVIEW_WORDS = ("需人工复核", "无法定位课程库记录")
MODEL_FAILURES = ("parse_error", "no_llm", "empty_response")
FALLBACK_REASON = "模型未给出不通过原因，需人工复核"
EMPTY_REASON = "模型返回为空，需人工复核"
PARSE_REASON = "模型输出格式无法解析，需人工复核"
REVIEW_SUGGESTION = "配置 LLM 后重新审核，或进行人工复核。"
WARNING_WORDS = {
    "missing_field": "字段为空", "empty_section": "章节为空", "sanitized_control_chars": "已清理非法控制字符", "unknown_columns": "存在未知列", "fallback_used": "使用了兜底抽取",
}
# --- fixed values: names of internal fields as customers read them; whole words after them ---
CUSTOMER_NAMES = {
    "payload.kcmb.szmb": "思政目标", "payload.kcmb.nlmb": "能力目标", "payload.kcmb.zsmb": "知识目标", "payload.kcmb.mbgs": "课程目标概述",
    "payload.jxap.tm[].szyqjxx": "教学安排中的思政元素融入", "payload.jxap.tm[].sknr": "教学安排中的授课内容", "payload.jxap.tm[].skfs": "教学安排中的授课方式",
    "payload.jxap.apgs": "教学安排概述", "payload.jxap": "教学安排", "payload.khfsb": "考核方式", "payload.kcyq": "课程要求", "payload.jxnr": "教学内容", "payload.kcmb": "课程目标",
    "payload_data.kcmb.data.szmb": "思政目标", "payload_data.kcmb.data.mbgs": "课程目标概述",
    "audit_input.data.primary.szmb": "思政目标", "audit_input.data.primary.nlmb": "能力目标", "audit_input.data.primary.zsmb": "知识目标", "audit_input.data.supplement.mbgs": "课程目标概述",
    "audit_input.data.jxap.primary.tm[0].skfs": "教学安排中的授课方式", "audit_input.data.khfsb.primary.tm[0].kcfs": "考核方式中的考察方式", "audit_input.data.kcyq": "课程要求",
    "primary.szmb": "思政目标", "supplement.mbgs": "课程目标概述", "khfsb": "考核方式", "jxap": "教学安排", "jxnr": "教学内容", "kcmb": "课程目标", "kcyq": "课程要求",
    "szmb": "思政目标", "nlmb": "能力目标", "zsmb": "知识目标", "szyqjxx": "思政元素融入", "mbgs": "课程目标概述", "nrgs": "教学内容概述", "apgs": "教学安排概述", "khgs": "考核方式说明", "tm": "表格条目",
}
CUSTOMER_WORDS = {"audit_input": "审核材料", "meta_context": "原文辅助信息", "meta": "原文辅助信息", "payload_data": "结构化抽取结果", "payload": "结构化抽取结果"}
# --- fixed values: text that may fill a blank field, if it is long enough and has a keyword ---
VALIDATED_TEXTS = {
    "课程目标概述": {"titles": ("课程目标", "教学目标"), "keywords": ("思政", "能力", "知识", "价值", "育人", "责任", "使命", "目标"), "least": 8, "section": "course_goal"},
    "教学内容概述": {"titles": ("教学内容", "课程内容"), "keywords": ("学时", "知识点", "主题", "内容", "章节", "总学时", "合计"), "least": 10, "section": "jxnr"},
    "课程安排概述": {"titles": ("教学安排", "课程安排", "授课安排", "教学进度"), "keywords": ("周次", "授课内容", "授课方式", "思政", "教学方法", "安排"), "least": 10, "section": "jxap"},
    "考核方式说明": {"titles": ("考核方式", "课程考核", "成绩评定", "考核与评价", "评价方式"), "keywords": ("考试", "考核", "成绩", "平时", "期末", "闭卷", "开卷", "论文", "分值", "占比", "总计"), "least": 10, "section": "assessment_rows"},
    "课程要求": {"titles": ("课程要求", "学习要求", "课堂要求"), "keywords": ("作业", "阅读", "考勤", "出勤", "讨论", "预习", "提交", "课堂", "要求", "完成"), "least": 6, "section": "course_requirements"},
    "阅读材料": {"titles": ("教材及阅读材料", "教材", "阅读材料", "参考书", "参考文献"), "keywords": ("教材", "阅读材料", "参考书", "参考文献", "书目", "作者", "版次"), "least": 6, "section": "jcjydcl"},
}
METHOD_TOKENS = ("讲授", "研讨", "讨论", "案例", "课堂", "阅读", "线上")
NOISE_LINES = ("序号主题知识点学时", "周次授课内容授课方式")
ENGLISH_FRAGMENTS = {"presen": "Presentation", "senta": "Presentation", "tation": "Presentation"}
ITEM_KEYWORDS = ("课程目标", "教学目标", "教学内容", "教学安排", "课程要求", "考核方式", "教学方法", "授课方式", "课程思政")
# --- fixed values: cleaning ---
EMPTY_MARKERS = ("", "不填", "未填", "无", "暂无", "无特殊要求", "无特殊", "none", "null", "n/a", "na")
FILENAME_NOISE = ("课程方案完整版", "课程方案", "课程实施方案", "教学大纲", "完整版", "最终版", "修订版", "新版")
SEQUENCE = r"(?:第)?\d+(?:\.\d+)?(?:[-－—~～至]\d+(?:\.\d+)?)?(?:周|次|讲|节|课时)?"
SUMMARY_MARKERS = ("课时总计", "学时总计", "总学时", "合计")
TOTAL_HOURS = (r"课时总计[：:]\s*(\d+)\s*学时", r"学时总计[：:]\s*(\d+)\s*学时", r"课时总计[：:]\s*学时\s*(\d+)", r"总学时[：:]\s*(\d+)")
PRACTICE_LINE = r"\d+\s*[（(]课程教授与实践(?:课)?[）)]"
LABEL_PUNCTUATION = "[\\s:：；;，,、（）()【】\\[\\]《》<>“”\"''·\\-—_]+"
ANCHORS = ((r"（五）\s*教学安排", "教学安排"), (r"（四）\s*教学内容", "教学内容"), (r"（六）\s*课程要求", "课程要求"), (r"（八）\s*考核方式(?:及成绩构成)?", "考核方式"))
TITLE_PREFIX = r"(?:[（(]?[一二三四五六七八九十0-9]+[）)]?\s*[、.．-]?\s*)?"
FIELD_PATTERNS = (
    (r"课程编号\s*[：:]\s*(\S+)", "课程编号"), (r"课程名称\s*[：:]\s*(.+?)(?:\n|课程\s*ID|$)", "中文课程名称"),
    (r"中文课程名称\s*[：:]\s*(.+?)(?:\n|英文课程名称|$)", "中文课程名称"), (r"英文课程名称\s*[：:]\s*(.+?)(?:\n|课程性质|$)", "英文课程名称"),
    (r"开课[（(]院[）)]系\s*[：:]\s*(.+?)(?:\n|中文课程名称|$)", "开课（院）系"), (r"任课教师姓名\s*[：:]\s*(.+?)(?:\n|教师工号|$)", "任课教师姓名"),
)
CONTENT_LINE = r"^\s*(\d+(?:\.\d+)?)\s*[、.．-]?\s+(.+?)\s+(\d+(?:\.\d+)?)\s*(?:学时)?\s*$"
SCHEDULE_LINE = r"^\s*(?:第)?(\d+(?:\s*[-~～至,，、]\s*\d+)*)\s*(?:周|周次)?\s+(.+)$"
SCHEDULE_LINES = (SCHEDULE_LINE, r"^\s*(\d+)\s+(.+)$")
METHODS = ("讲授", "讨论", "案例", "实践", "翻转课堂", "实验")
MAX_WEEK = 19
# --- fixed values: scoring ---
ROW_WEIGHT, FIELD_WEIGHT, ROW_BONUS, WARNING_PENALTY, MIN_IMPROVEMENT = 50.0, 30.0, 20, 5, 8.0
FUSION = {
    "teaching_content": {"required": ("序号", "主题", "知识点", "学时"), "weighted": {}, "min_rows": 2, "min_improvement": 8.0},
    "course_schedule": {"required": ("序号", "授课内容"), "weighted": {"授课方式": 15, "思政元素的融入和预期教学成效": 25}, "min_rows": 3, "min_improvement": 5.0},
    "assessment_rows": {"required": ("考试形式", "占比"), "weighted": {"考察内容": 10, "考察方式": 10}, "min_rows": 2, "min_improvement": 3.0},
}
OCR = {
    "fragment": r"\b[A-Za-z]{2,5}\b(?!\w)", "short": 4, "threshold": 0.35, "factor": 40, "cap": 25, "glued_penalty": 3, "glued_cap": 15,
    "empty_penalty": 8, "rerun": 65, "fields": ("授课方式", "思政元素的融入和预期教学成效", "学时", "知识点"),
    "glued": ("中文课程名称[一-龥A-Za-z]", "英文课程名称[A-Za-z]", "任课教师姓名[一-龥]", "开课（院）系[一-龥]"),
}
SEVERITY = {
    "missing_field": "error", "empty_section": "error", "overview_used_instead_of_table": "info", "validated_text_fallback_used": "info",
    "continued_table_without_header": "info", "alternative_candidate_selected": "info", "unknown_columns": "warn",
    "missing_required_columns": "warn", "missing_teaching_method": "warn", "text_row_low_confidence": "warn",
    "suspiciously_few_rows": "warn", "sanitized_control_chars": "info", "pymupdf_extract_failed": "warn",
}
SCHEMA_VERSION = "1.0"

_DEFAULTS: dict[str, Any] = {"auditors": tuple(DIMENSIONS), "workers": 4, "schema_version": SCHEMA_VERSION, "severity": SEVERITY, "fusion": FUSION, "ocr": OCR}


def merged(base: dict, over: dict) -> dict:
    """``over`` laid over ``base``, dict by dict."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


@lru_cache(maxsize=8)
def _loaded(path: str | None) -> dict[str, Any]:
    if not path:
        return copy.deepcopy(_DEFAULTS)
    import json

    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        over = json.loads(text)
    except ValueError:
        import yaml

        over = yaml.safe_load(text) or {}
    return merged(_DEFAULTS, over)


def load(path: str | None = None) -> dict[str, Any]:
    """Settings, read once for each path; ``reload`` forgets them."""
    return copy.deepcopy(_loaded(path))


def reload() -> None:
    _loaded.cache_clear()


def problems(settings: dict[str, Any]) -> list[str]:
    """What is wrong with the auditors of the settings: unknown and missing dimensions."""
    named = list(settings.get("auditors") or ())
    out = [f"unknown dimension: {d}" for d in named if d not in DIMENSIONS]
    return out + ([] if named else ["no dimension is configured"])
