"""Relational operators: latest and first rows, matching, anti joins, roll-ups, forward fill, segmentation, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``.  The window's limit is pushed below the shuffle by Spark."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def first_wins(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """First row of each value of an expression, in input order."""
    return latest(df.withColumn("_key", key), ["_key"], order).drop("_key")


def name_cardinality(courses: DataFrame, name: str, code: str, shown: int = 10) -> DataFrame:
    """(name, n, verdict, candidates): a name of one course matches, of several is ambiguous."""
    found = courses.where(F.col(name).isNotNull() & (F.col(name) != "")).groupBy(name).agg(F.count("*").alias("n"), F.slice(F.sort_array(F.collect_set(code)), 1, shown).alias("candidates"))
    return found.withColumn("verdict", F.when(F.col("n") == 1, "matched").otherwise("ambiguous"))


def match_cascade(subjects: DataFrame, courses: DataFrame, code: str, names: list[tuple[str, str]], course_code: str, course_name: str, duplicate: str | None = None) -> DataFrame:
    """``subjects`` with match_status, match_method, match_code, match_candidates, match_query (the name or code that decided,
    null where none did) and match_shared (whether the code was shared).

    The order of methods: the subject's code, then each (column, method) of ``names``; the first that is matched or
    ambiguous ends the search.  Where ``duplicate`` is true for a subject, whose code others
    share, names come first and count only if matched; the code is what is left.  Each method is one left join.
    """
    codes = courses.select(F.col(course_code).alias("_by_code")).where("_by_code is not null and _by_code <> ''").distinct()
    cards = name_cardinality(courses, course_name, course_code).select(F.col(course_name).alias("_name"), F.struct("verdict", "candidates").alias("_card"))
    out = subjects.join(codes.withColumn("_hit", F.lit(True)), F.col(code) == F.col("_by_code"), "left").drop("_by_code")
    for i, (column, _) in enumerate(names):
        out = out.join(cards.select(F.col("_name").alias(f"_n{i}"), F.col("_card").alias(f"_c{i}")), F.col(column) == F.col(f"_n{i}"), "left").drop(f"_n{i}")
    none = F.array().cast("array<string>")
    made = lambda status, method, c, cand, query: F.struct(F.lit(status).alias("status") if isinstance(status, str) else status.alias("status"), F.lit(method).alias("method"), c.alias("code"), cand.alias("candidates"), F.col(query).alias("query"))
    by_code = F.when(F.col("_hit"), made("matched", "code", F.col(code), none, code))
    by_name, only_matched = [], []
    for i, (column, method) in enumerate(names):
        card = F.col(f"_c{i}")
        hit = made(card["verdict"], method, F.when(card["verdict"] == "matched", card["candidates"][0]), card["candidates"], column)
        by_name.append(F.when(card.isNotNull(), hit))
        only_matched.append(F.when(card["verdict"] == "matched", hit))
    missing = F.struct(F.lit("not_found").alias("status"), F.lit(None).cast("string").alias("method"), F.lit(None).cast("string").alias("code"), none.alias("candidates"), F.lit(None).cast("string").alias("query"))
    shared = F.coalesce(F.col(duplicate), F.lit(False)) if duplicate else F.lit(False)
    found = F.when(shared, F.coalesce(*only_matched, by_code, *by_name, missing)).otherwise(F.coalesce(by_code, *by_name, missing))
    out = out.withColumn("_m", found).withColumn("_s", shared)
    return out.select(*subjects.columns, *[F.col(f"_m.{x}").alias(f"match_{x}") for x in ("status", "method", "code", "candidates", "query")], F.col("_s").alias("match_shared"))


def shared_keys(df: DataFrame, key: str, flag: str = "duplicate") -> DataFrame:
    """``df`` with whether its non-empty key occurs more than once.  An aggregate and a join, so one key may be hot."""
    counts = df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias("_k")).agg((F.count("*") > 1).alias(flag))
    return df.join(counts, F.col(key) == F.col("_k"), "left").drop("_k").withColumn(flag, F.coalesce(flag, F.lit(False)))


def pending(subjects: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Subjects that are not done."""
    return subjects.join(done.select(*keys), keys, "left_anti")


def members(df: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is one of ``others``."""
    return df.join(others.select(*keys), keys, "left_semi")


def orphans(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` that ``others`` lacks."""
    return df.select(key).distinct().join(others.select(key), key, "left_anti")


def newest(df: DataFrame, order: list[Column], limit: int | None = None) -> DataFrame:
    """``df`` in order, its first ``limit`` rows where there is one: a partial sort, not a global one."""
    ordered = df.orderBy(*order)
    return ordered.limit(limit) if limit else ordered


def anti_either(df: DataFrame, others: DataFrame, keys: list[list[str]]) -> DataFrame:
    """Rows that agree with none of ``others`` on any of the key lists: one anti join for each list."""
    return reduce(lambda d, k: d.join(others.select(*k).distinct(), k, "left_anti"), keys, df)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All of ``new``, and the rows of ``existing`` whose key it does not have."""
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)


def forward_fill(df: DataFrame, keys: list[str], order: list[Column], column: str, where: Column | None = None) -> DataFrame:
    """Nulls of a column take the last value before them, where the row qualifies."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.last(column, ignorenulls=True).over(window)
    return df.withColumn(column, F.when(F.lit(True) if where is None else where, F.coalesce(F.col(column), filled)).otherwise(F.col(column)))


def segments(df: DataFrame, keys: list[str], order: list[Column], starts: Column, text: str, ordinal: str, joiner: str = "\n") -> DataFrame:
    """Gaps and islands: rows up to the next start are one segment, texts joined in order."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    grouped = df.withColumn("segment", F.sum(starts.cast("int")).over(window))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(ordinal, text))), lambda x: x[text]), joiner)
    return grouped.groupBy(*keys, "segment").agg(F.count("*").alias("rows"), body.alias("body"))


def choose_candidate(candidates: Column, margin: float) -> Column:
    """Fold over array<struct<source,score>>: a later candidate wins by ``margin`` or more, or over one without score."""
    better = lambda best, c: (c["score"] > 0) & ((best["score"] <= 0) | (c["score"] >= best["score"] + margin))
    return F.aggregate(F.slice(candidates, 2, F.greatest(F.size(candidates) - 1, F.lit(1))), candidates[0], lambda best, c: F.when(better(best, c), c).otherwise(best))


def status_counts(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("n"))


def dimension_totals(findings: DataFrame, dimensions: list[str], wd: str = "wd", status: str = "status") -> DataFrame:
    """wd, total, pass_count, fail_count, pass_rate for the fixed dimensions, zero where there is none."""
    spark = findings.sparkSession
    fixed = spark.createDataFrame([(d,) for d in dimensions], f"{wd} string")
    counted = findings.where(F.col(wd).isin(*dimensions)).groupBy(wd).agg(F.count("*").alias("total"), F.count_if(F.col(status) == "pass").alias("pass_count"), F.count_if(F.col(status) != "pass").alias("fail_count"))
    out = fixed.join(counted, wd, "left")
    out = out.select(wd, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "pass_count", "fail_count")])
    return out.withColumn("pass_rate", C.rate("pass_count", "total"))


def all_pass(results: DataFrame, findings: DataFrame, key: str, dimensions: list[str], wd: str = "wd", status: str = "status") -> DataFrame:
    """Keys of the results with a finding for each dimension, all passed."""
    own = findings.where(F.col(wd).isin(*dimensions)).groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col(status) == "pass").alias("ok"))
    return results.select(key).join(own.where((F.col("n") == len(dimensions)) & (F.col("ok") == len(dimensions))), key).select(key)


def top(df: DataFrame, keys: list[str], n: int = 10, where: Column | None = None) -> DataFrame:
    """The most frequent values, ties by the values; a partial sort, never a global one."""
    counted = (df if where is None else df.where(where)).groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), *keys).limit(n)


def rollup_subjects(findings: DataFrame, keys: list[str], status: str = "status", message: str = "message", reason: str = "reason", ordinal: str = "ord", extraction: Column | None = None) -> DataFrame:
    """fail_count, warning_count, overall_status, messages and reasons of each subject.

    Messages are the first 5 of what failed; reasons the first 20 of what failed or warned, blank ones left out,
    repeated ones kept.  Verdict by precedence: error where extraction failed, fail, partial for warnings, pass.
    """
    bad, warned = F.col(status).isin("fail", "error", "manual_review"), F.col(status) == "warning"
    extracted = F.first(extraction).alias("_x") if extraction is not None else F.first(F.lit(None).cast("string")).alias("_x")
    ordered = lambda c, cond: F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct(ordinal, c)))), lambda x: x[c])
    out = findings.groupBy(*keys).agg(
        F.count_if(bad).alias("fail_count"), F.count_if(warned).alias("warning_count"),
        F.slice(ordered(message, bad), 1, 5).alias("messages"), F.slice(ordered(reason, (bad | warned) & (F.coalesce(reason, F.lit("")) != "")), 1, 20).alias("reasons"), extracted,
    )
    return out.withColumn("overall_status", verdict(F.col("_x"), F.col("fail_count"), F.col("warning_count"))).drop("_x")


def verdict(extraction: Column, fails: Column, warnings: Column) -> Column:
    return F.when(extraction == "failed", "error").when(fails > 0, "fail").when((warnings > 0) | F.coalesce(extraction == "partial", F.lit(False)), "partial").otherwise("pass")


def rollup_sections(findings: DataFrame, keys: list[str], section: str = "section", path: str = "path", reason: str = "reason", status: str = "status", ordinal: str = "ord") -> DataFrame:
    """status, fail_count, failed paths (first 20) and distinct reasons of each section."""
    bad = F.col(status).isin("fail", "error", "manual_review")
    ordered = lambda c: F.transform(F.sort_array(F.collect_list(F.when(bad, F.struct(ordinal, c)))), lambda x: x[c])
    out = findings.groupBy(*keys, section).agg(
        F.count_if(bad).alias("fail_count"), F.count_if(F.col(status) == "warning").alias("warning_count"),
        F.slice(ordered(path), 1, 20).alias("failed_paths"), F.array_distinct(F.filter(ordered(reason), lambda x: x != "")).alias("reasons"),
    )
    return out.withColumn("status", F.when(F.col("fail_count") > 0, "fail").when(F.col("warning_count") > 0, "warning").otherwise("pass"))


def coverage(df: DataFrame, sections: list[str], flags: dict[str, dict[str, Column]]) -> DataFrame:
    """section x counter: how many rows have each flag; ``flags[counter][section]`` is a boolean column."""
    counters = list(flags)
    parts = [F.struct(F.lit(s).alias("section"), *[F.coalesce(flags[c][s], F.lit(False)).cast("long").alias(c) for c in counters]) for s in sections]
    long = df.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
    return long.groupBy("section").agg(F.count("*").alias("total"), *[F.sum(c).alias(c) for c in counters])


def histogram(df: DataFrame, **keys: Column) -> DataFrame:
    """Counts by expressions."""
    return df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(F.count("*").alias("n"))


def warning_pivot(df: DataFrame, label: str, kind: str, kinds: list[str]) -> DataFrame:
    """label x class counts."""
    counted = df.groupBy(label).pivot(kind, kinds).agg(F.count(F.lit(1)))
    return counted.select(label, *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(k) for k in kinds])


def samples(df: DataFrame, keys: list[str], item: str, n: int = 3) -> DataFrame:
    """Count of each group with its first ``n`` items; only ``n`` items of a group ever meet."""
    window = Window.partitionBy(*keys).orderBy(item)
    few = df.select(*keys, item).withColumn("_r", F.row_number().over(window)).where(F.col("_r") <= n).groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("samples"))
    return df.groupBy(*keys).agg(F.count("*").alias("n")).join(few, keys)


def missing_columns(rows: Column, fields: dict[str, str]) -> Column:
    """For each field: (field, label, blank rows), where any row is blank."""
    count = lambda f: F.coalesce(F.size(F.filter(rows, lambda r: C.is_blank(r[f]))), F.lit(0))
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(label).alias("label"), count(f).alias("row_count")) for f, label in fields.items()])
    return F.filter(each, lambda e: e["row_count"] > 0)


def canonical(df: DataFrame, key: Column, score: list[Column], ident: str) -> DataFrame:
    """``df`` with role: the best row of each key is canonical, the others are duplicates of it."""
    window = Window.partitionBy("_key").orderBy(*score, F.col(ident))
    out = df.withColumn("_key", key).withColumn("_rank", F.row_number().over(window)).withColumn("canonical_id", F.first(ident).over(window))
    return out.withColumn("role", F.when(F.col("_rank") == 1, "canonical").otherwise("duplicate")).drop("_key", "_rank")


def unique_names(df: DataFrame, name: str, order: list[Column], out: str = "new_name") -> DataFrame:
    """``df`` with a name that no other row has: rows whose name, blanks at its end aside, an earlier row has get a number.

    A proposed number that is taken already is passed over, so names that are unique stay as they are.
    """
    base = F.rtrim(F.col(name))
    ranked = df.withColumn("_base", base).withColumn("_n", F.row_number().over(Window.partitionBy("_base").orderBy(*order)))
    taken = df.select(base.alias("_t")).distinct()
    numbers = taken.select(F.regexp_extract("_t", r"(?s)^(.*)_(\d{1,9})$", 1).alias("_b"), F.regexp_extract("_t", r"(?s)^(.*)_(\d{1,9})$", 2).try_cast("int").alias("_k")).where("_k >= 2")
    held = numbers.groupBy("_b").agg(F.array_sort(F.collect_set("_k")).alias("_held"))
    joined = ranked.join(held, F.col("_base") == F.col("_b"), "left")
    # the n-th of a name takes the n-th number from 2 on that is free: skip one for each held number not above it
    number = F.aggregate(F.coalesce("_held", F.array().cast("array<int>")), F.col("_n"), lambda n, h: F.when(h <= n, n + 1).otherwise(n))
    return joined.withColumn(out, F.when(F.col("_n") == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("_"), number.cast("string")))).select(*df.columns, out)
