"""Column functions: cleaning, predicates, numbers, keys.  All run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

SPACE = r"(?U)\s"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: Column | str) -> Column:
    """Strip white space of any script (``trim`` knows only U+0020).  The input stands in the expression once."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+\z", "")


def exact(c: Column | str) -> Column:
    """Null as '', control characters but tab, LF and CR dropped, stripped."""
    return ustrip(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""))


def clean_text(c: Column | str, keep_newline: bool = False) -> Column:
    """Every CR as LF, runs of blanks as one, none beside a line's end; line ends dropped, or at most two in a row."""
    t = F.regexp_replace(F.translate(F.coalesce(col(c), F.lit("")), "\r", "\n"), r"[ \t　]+", " ")
    t = F.regexp_replace(t, r" *\n *", "\n" if keep_newline else "")
    return ustrip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def compact(c: Column | str) -> Column:
    """Runs of white space as one space."""
    return ustrip(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)\s+", " "))


def normal_lines(c: Column | str) -> Column:
    """Lines cleaned, empty ones dropped."""
    return F.array_join(F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), r"\r\n?|\n"), compact), lambda x: x != ""), "\n")


def normal_label(c: Column | str) -> Column:
    """Label without punctuation and white space, lower case."""
    return F.lower(F.regexp_replace(F.coalesce(col(c), F.lit("")), config.LABEL_PUNCTUATION, ""))


def bracket_label(c: Column | str) -> Column:
    """Label without white space, half-width parentheses as full-width ones."""
    return F.translate(F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACE + "+", ""), "()", "（）")


def is_blank(c: Column | str) -> Column:
    return F.coalesce(~col(c).rlike(r"(?U)\S"), F.lit(True))


def marker_blank(c: Column | str) -> Column:
    """'' for null and for the words that mean empty, else the stripped text."""
    t = F.coalesce(col(c), F.lit(""))
    return F.when(F.lower(F.regexp_replace(t, SPACE + "+", "")).isin(*config.EMPTY_MARKERS), F.lit("")).otherwise(ustrip(t))


def substantive(c: Column | str, least: int = 2) -> Column:
    """At least ``least`` characters that are not white space, and no empty marker."""
    t = F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACE + "+", "")
    return (F.length(t) >= least) & ~F.lower(t).isin(*config.EMPTY_MARKERS)


def template_like(c: Column | str) -> Column:
    """Blank, a placeholder word, or shorter than four characters."""
    t = compact(c)
    return (F.length(t) < 4) | F.lower(t).isin(*config.EMPTY_MARKERS)


def rows_substantive(rows: Column, fields: tuple[str, ...], extras: str | None = "kzzd") -> Column:
    """Whether any row has a field, or an extra value, that is not blank."""
    def one(r: Column) -> Column:
        hit = reduce(lambda a, b: a | b, [~is_blank(r[f]) for f in fields])
        return hit | F.coalesce(F.exists(r[extras], lambda e: ~is_blank(e["nr"])), F.lit(False)) if extras else hit

    return F.coalesce(F.exists(rows, one), F.lit(False))


def gap_rows(rows: Column, field: str, extras: str = "kzzd") -> Column:
    """Whether any row has extra values but a blank field: what a conversion put into the wrong place."""
    return F.coalesce(F.exists(rows, lambda r: is_blank(r[field]) & (F.size(r[extras]) > 0)), F.lit(False))


def course_code(c: Column | str) -> Column:
    """A valid code, a labelled one found inside, else ''."""
    t = marker_blank(c)
    good = t.rlike(r"^[A-Za-z0-9._-]{3,32}$")
    inner = F.regexp_extract(t, r"(?i)(?:课程编号|课程代码|code)\s*[:：]?\s*([A-Za-z0-9._-]{3,32})", 1)
    return F.when(good, t).otherwise(inner)


def first_integer(c: Column | str) -> Column:
    # a cast of '' that fails costs an exception
    return F.nullif(F.regexp_extract(F.coalesce(col(c), F.lit("")), r"(?U)\d+", 0), F.lit("")).try_cast("int")


def number(t: Column) -> Column:
    """The number that a stripped text is; null of others."""
    return F.when(t.rlike(r"^\d+(\.\d+)?$"), t.try_cast("double"))


def strict_number(c: Column | str) -> Column:
    return number(exact(c))


def number_text(c: Column | str) -> Column:
    """An integral number without its fraction, others as they print."""
    x = col(c)
    return F.when(x == F.floor(x), F.floor(x).cast("bigint").cast("string")).otherwise(x.cast("string"))


def rate(n: Column | str, d: Column | str, digits: int = 4) -> Column:
    """n / d rounded half to even, 0 where d is not positive."""
    return F.when(col(d) > 0, F.bround(col(n) / col(d), digits)).otherwise(F.lit(0.0))


def percent_text(n: Column | str, d: Column | str) -> Column:
    return F.when(col(d) > 0, F.format_string("%.1f%%", col(n) * 100.0 / col(d))).otherwise(F.lit("—"))


def subject_key(extraction_id: Column | str, source_path: Column | str) -> Column:
    return F.when(col(extraction_id) > 0, F.concat(F.lit("extraction:"), col(extraction_id).cast("string"))).otherwise(
        F.concat(F.lit("source:"), F.substring(F.sha1(F.coalesce(col(source_path), F.lit(""))), 1, 16))
    )


def backfill_key(extraction_id: Column | str, source_path: Column | str, row_id: Column | str) -> Column:
    """The key that older rows get: by extraction, else by MD5 of the path, else by row."""
    return (
        F.when(col(extraction_id).isNotNull(), F.concat(F.lit("extraction:"), col(extraction_id).cast("string")))
        .when(F.coalesce(col(source_path), F.lit("")) != "", F.concat(F.lit("source:"), F.md5(col(source_path))))
        .otherwise(F.concat(F.lit("result:"), col(row_id).cast("string")))
    )


def path_name(path: Column | str) -> Column:
    """Course name from a path: the file's stem without numbers, bracketed parts and noise words."""
    t = F.element_at(F.split(F.replace(col(path), F.lit("\\"), F.lit("/")), "/"), -1)
    t = ustrip(F.regexp_replace(t, r"(?i)\.pdf$", ""))
    for pattern in (r"(?U)^[\s\d._-]+", r"[（(][^）)]*[）)]", r"【[^】]*】", *config.FILENAME_NOISE, r"(?U)\s+"):
        t = F.regexp_replace(t, pattern, "")
    return F.regexp_replace(t, r"^[_\-— ]+|[_\-— ]+$", "")


def relative_path(path: Column | str, root: str) -> Column:
    t = F.replace(col(path), F.lit("\\"), F.lit("/"))
    return F.when(t.startswith(root.rstrip("/") + "/"), F.substr(t, F.lit(len(root.rstrip("/")) + 2))).otherwise(t)


def strip_markup(c: Column | str) -> Column:
    """Tags as spaces, heading marks dropped, white space squeezed."""
    t = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?s)<[^>]*>", " ")
    return compact(F.regexp_replace(t, r"(?m)^#+\s*", ""))


def english_spacing(c: Column | str) -> Column:
    """Spaces at camel-case and letter-digit borders that recognition lost, words put together again that it cut.

    Text without Latin letters, and Chinese text with fewer than eight of them, stays as it is.
    """
    c = col(c)
    t = F.regexp_replace(c, r"(?<=[a-z])(?=[A-Z])", " ")
    t = F.regexp_replace(t, r"(?<=[A-Za-z])(?=\d)|(?<=\d)(?=[A-Za-z])", " ")
    for part, word in config.ENGLISH_FRAGMENTS.items():
        t = F.regexp_replace(t, rf"(?i)\b{part}\b", word)
    few = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    return F.when((few == 0) | ((few < 8) & c.rlike("[一-龥]")), c).otherwise(ustrip(F.regexp_replace(t, " {2,}", " ")))


def label_value(c: Column | str, label: str) -> Column:
    """What follows a label up to the clause's end; null without the label."""
    p = rf"(?U)\Q{label}\E\s*[:：]?\s*([^\n\r；。]*)"
    return F.when(col(c).rlike(p), ustrip(F.regexp_extract(col(c), p, 1)))


def replace_all(c: Column | str, pairs: dict[str, str]) -> Column:
    """Literal replacements, longest first."""
    return reduce(lambda t, k: F.replace(t, F.lit(k), F.lit(pairs[k])), sorted(pairs, key=lambda k: (-len(k), k)), col(c))


def replace_words(c: Column | str, pairs: dict[str, str]) -> Column:
    """Replacements of whole words."""
    return reduce(lambda t, k: F.regexp_replace(t, rf"(?U)\b\Q{k}\E\b", pairs[k]), sorted(pairs), col(c))


def customer_text(c: Column | str) -> Column:
    """Internal names as customers read them; '' for null."""
    return replace_words(replace_all(F.coalesce(col(c), F.lit("")), config.CUSTOMER_NAMES), config.CUSTOMER_WORDS)


def without_titles(c: Column | str, titles: tuple[str, ...]) -> Column:
    return ustrip(reduce(lambda t, h: F.replace(t, F.lit(h), F.lit("")), titles, col(c)))


def join_parts(*parts: Column) -> Column:
    """Non-blank parts, each once, one a line."""
    return F.array_join(F.array_distinct(F.filter(F.array(*[exact(p) for p in parts]), lambda x: x != "")), "\n")


def flat_pairs(pairs: Column) -> Column:
    """array<struct<bt,nr>> as lines ``label：value``."""
    return F.array_join(F.transform(F.filter(pairs, lambda e: ~is_blank(e["nr"])), lambda e: F.concat(exact(e["bt"]), F.lit("："), exact(e["nr"]))), "\n")


def split_columns(line: Column | str) -> Column:
    """Cells of a text line: two or more spaces, tabs or bars part them."""
    return F.filter(F.transform(F.split(col(line), r"(?U)\s{2,}|\t+|\|"), ustrip), lambda x: x != "")


def noise_line(c: Column | str) -> Column:
    """A blank line, or a table's header run together."""
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACE + "+", "").isin("", *config.NOISE_LINES)


def is_sequence(c: Column | str) -> Column:
    return exact(c).rlike(rf"^{config.SEQUENCE}$")


def is_summary(c: Column | str) -> Column:
    return exact(c).rlike("|".join(config.SUMMARY_MARKERS))


def without_summary(c: Column | str) -> Column:
    """Lines that hold a total or the practice remark are dropped."""
    bad = "|".join(config.SUMMARY_MARKERS) + "|" + config.PRACTICE_LINE
    return F.array_join(F.filter(F.split(F.coalesce(col(c), F.lit("")), "\n"), lambda x: ~x.rlike(bad)), "\n")


def total_hours(*texts: Column | str) -> Column:
    """The last total that prose states, by the first pattern that matches."""
    return F.coalesce(*stated_totals(*texts), F.lit(""))


def stated_totals(*texts: Column | str) -> list[Column]:
    """The last total that prose states, by each pattern; null where it does not match."""
    t = F.concat_ws("\n", *[col(x) for x in texts])
    return [F.try_element_at(F.regexp_extract_all(t, F.lit(p), F.lit(1)), F.lit(-1)) for p in config.TOTAL_HOURS]


def labelled(c: Column | str, names: dict[str, str]) -> Column:
    """Code as its label; unknown codes stay."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, col(c)), col(c))


def coded(c: Column | str, names: dict[str, str]) -> Column:
    return labelled(c, {v: k for k, v in names.items()})


def verdict(c: Column | str) -> Column:
    """是 for the words that affirm, else 否."""
    t = F.lower(exact(c))
    return F.when(t.isin("是", "yes", "pass", "true", "1") | t.startswith("是"), F.lit("是")).otherwise(F.lit("否"))


def extras_rows(m: Column | str) -> Column:
    """Map of extra columns as array<struct<bt,nr>>, blank ones dropped."""
    return F.transform(F.filter(F.map_entries(col(m)), lambda e: ~is_blank(e["value"])), lambda e: F.struct(exact(e["key"]).alias("bt"), exact(e["value"]).alias("nr")))


def merge_maps(left: Column | str, right: Column | str) -> Column:
    """Keys of both, the right one's values win; any dedup policy of the session."""
    left, right = col(left), col(right)
    kept = F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def missing_numbers(seen: Column, most: Column) -> Column:
    """{1..most} without ``seen``; sequence(1, 0) would count down."""
    return F.when(most >= 1, F.array_except(F.sequence(F.lit(1), most), seen)).otherwise(F.array().cast("array<int>"))


def hours_sum(rows: Column, field: str = "xs") -> Column:
    """Sum of the integers that rows name first."""
    return F.aggregate(rows, F.lit(0).cast("long"), lambda a, r: a + F.coalesce(first_integer(r[field]), F.lit(0)))


def row_completeness(rows: Column, fields: tuple[str, ...]) -> Column:
    """Share of the required cells that are filled; 0 without rows."""
    filled = F.aggregate(rows, F.lit(0), lambda a, r: a + reduce(lambda x, y: x + y, [(~is_blank(r[f])).cast("int") for f in fields]))
    return F.when(F.size(rows) > 0, filled / (F.size(rows) * len(fields))).otherwise(F.lit(0.0))


def row_score(rows: Column, required: tuple[str, ...], weighted: dict[str, int] | None = None, min_rows: int = 1, warnings: Column | int = 0) -> Column:
    """completeness * 50 + filled share of weighted fields * 30 + rows up to 20 - 5 for each warning, scaled below min_rows."""
    n = F.size(rows)
    score = row_completeness(rows, required) * config.ROW_WEIGHT
    if weighted:
        share = reduce(lambda a, b: a + b, [row_completeness(rows, (f,)) * w for f, w in weighted.items()]) / sum(weighted.values())
        score = score + share * config.FIELD_WEIGHT
    score = score + F.least(n, F.lit(config.ROW_BONUS)) - (warnings if isinstance(warnings, Column) else F.lit(warnings)) * config.WARNING_PENALTY
    return F.when(n <= 0, F.lit(0.0)).when(n < min_rows, score * n / min_rows).otherwise(score)
