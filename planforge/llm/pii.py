"""Operator 5, PII: fixed patterns find seed entities, and bootstrapped lexical patterns find more.

Seeds are the matches of four patterns.  Each induces lexical patterns of two sorts: its contexts (the word before, the
two words before, the word after, looked for within ``_WINDOW`` characters) and its form (digits as their number,
letters as one sign, and whether a number of card length has a right check digit).  The graph of patterns and
identifier-like instances is scored in rounds: a pattern is trusted for a kind when enough distinct instances of the
kind stand in it and these are most of its instances; an instance is taken when its trusted patterns make it likely
enough; taken instances count as known in the next round, until a round finds nothing new.  The text is read once;
rounds work on the small table of mentions.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, pylists

KINDS = ("email", "ip", "card", "phone")
#: A trusted pattern: distinct known instances of a kind, and their share of its instances; a taken instance.
SUPPORT, TRUST, LIKELY = 3, 0.6, 0.75
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Groups of digits are taken whole: a start within one could not match either, and long runs of digits stay linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What makes a token identifier-like; the characters besides letters and digits that tokens are written with.
_MARK, _AT, _DIGIT = re.compile(r"\d+|@|\[at\]|\(at\)"), re.compile(r"@|\[at\]|\(at\)"), re.compile(r"\d")
_REST, _WIDE = re.compile(r"[\w.%+@()\[\]-]*"), frozenset("_.%+-@()[]")
_WINDOW = 60
#: Tokens of a run that may be an identifier by themselves; the whole run may, however long.
PARTS = 4
_FORM = re.compile(r"[0-9]+|[^\W\d_]+")
#: Instances longer than this go by their digest.
_NAME = 64
_TOKEN = re.compile(r"\w+|[^\w\s]")
MENTION = "array<struct<kind:string,s:int,e:int,instance:string,patterns:array<string>>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start; matches that fail their test are dropped."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def contexts(text: str, s: int, e: int) -> list[str]:
    """Lexical patterns of a span: one word before, two words before, one word after."""
    before = ["^", "^", *_TOKEN.findall(text[max(0, s - _WINDOW) : s].lower())]
    after = [*_TOKEN.findall(text[e : e + _WINDOW].lower()), "$"]
    return [f"{before[-1]} _", f"{before[-2]} {before[-1]} _", f"_ {after[0]}"]


def form(instance: str) -> str:
    """Lexical pattern of an identifier itself."""
    digits = instance.replace(" ", "").replace("-", "")
    checked = "!" if 16 <= len(digits) <= 19 and digits.isascii() and digits.isdigit() and _luhn(digits) else ""
    return "= " + _name(_FORM.sub(lambda m: f"9{{{len(m[0])}}}" if m[0][0].isdigit() else "a", instance)) + checked


def _candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens, runs of them and parts of runs; tokens that overlap the sorted spans ``taken`` are left out."""
    runs: list[list[tuple[int, int]]] = []
    last, joins, i, covered = 0, False, 0, 0
    for m in _MARK.finditer(text):
        if m.start() < last:
            continue
        s, low = m.start(), last
        while s > low and (text[s - 1] in _WIDE or text[s - 1].isalnum()):
            s -= 1
        last = _REST.match(text, m.end()).end()
        e = last
        while text[e - 1] in ".,-(":
            e -= 1
        while i < len(taken) and taken[i][0] < e:
            covered = max(covered, taken[i][1])
            i += 1
        if covered > s:
            joins = False
            continue
        digits = not _AT.search(text, s, e) and _DIGIT.search(text, s, e) is not None
        if joins and digits and s - runs[-1][-1][1] == 1 and text[s - 1] not in "\r\n":
            runs[-1].append((s, e))
        else:
            runs.append([(s, e)])
        joins = digits
    out = []
    for run in runs:
        out += [(run[i][0], run[k][1]) for i in range(len(run)) for k in range(i, min(i + PARTS, len(run)))]
        if len(run) > PARTS:
            out.append((run[0][0], run[-1][1]))
    return out


def _name(instance: str) -> str:
    return instance if len(instance) <= _NAME else "sha256:" + hashlib.sha256(instance.encode("utf-8", "surrogatepass")).hexdigest()


def _mentions(text: str) -> tuple[list[tuple[str, int, int]], list[dict]]:
    base = base_spans(text)
    found = [*base, *((None, s, e) for s, e in _candidates(text, sorted((s, e) for _, s, e in base)))]
    return base, [{"kind": k, "s": s, "e": e, "instance": _name(text[s:e]), "patterns": [*contexts(text, s, e), form(text[s:e])]} for k, s, e in found]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, at = TaskContext.get().partitionId() << 40, 0
    mention = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))
    for b in batches:
        ids, texts = pylists(b, ["doc_id", "text"])
        found = [_mentions(t or "")[1] for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(range(base + at, base + at + len(ids)), pa.int64()), pa.array(ids, pa.int64()), pa.array(found, mention)], names=["row", "doc_id", "mentions"])
        at += len(ids)


def bootstrap(edges: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """(instance, kind) that trusted patterns discover; ``edges`` (pattern, instance), ``known`` (instance, kind)."""
    fillers = scratch.table(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT), "fillers")
    rounds, seeds = 0, known
    while True:
        support = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("f")).where(F.col("f") >= SUPPORT)
        trusted = support.join(fillers, "pattern").withColumn("trust", F.col("f") / F.col("n")).where(F.col("trust") >= TRUST)
        # a table of its own, so that the join with the edges of a common pattern can be split
        trusted = scratch.table(trusted.select("pattern", "kind", "trust"), f"trusted{rounds}")
        likely = edges.join(trusted, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - 0.999 * F.col("trust"))))).alias("likely")).where(F.col("likely") >= LIKELY)
        new = likely.groupBy("instance").agg(F.max_by("kind", F.struct("likely", "kind")).alias("kind")).join(known.select("instance"), "instance", "left_anti")
        new = scratch.table(new, f"taken/{rounds}")
        # one read of all rounds: plans stay small however many there are
        found = edges.sparkSession.read.schema(new.schema).option("recursiveFileLookup", "true").parquet(f"{scratch.root}/taken")
        if not new.limit(1).count():
            return found
        known, rounds = seeds.unionByName(found), rounds + 1


def _apart(acc: Column, x: Column) -> Column:
    """A span of the sorted ones is kept where it begins at or after the end of the last one kept."""
    span = F.struct(x["kind"].alias("kind"), x["s"].alias("s"), (-x["o"]).alias("e"))
    kept = F.struct((-x["o"]).alias("end"), F.concat(acc["kept"], F.array(span)).alias("kept"))
    return F.when(x["s"] >= acc["end"], kept).otherwise(acc)


def find_pii(docs: DataFrame) -> DataFrame:
    """row, doc_id, base and spans: arrays of (kind, s, e) for each row of ``docs`` (doc_id, text).

    ``base`` holds the matches of the fixed patterns, ``spans`` those and the discovered ones, both by kind as listed,
    then start; offsets are code points, ends exclusive.  Discovered spans overlap neither base spans nor each other:
    of overlapping ones the leftmost stays, then the longest.  Null and empty texts have none.  Repeated rows and null
    doc_ids are kept as they are; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    scanned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan, f"row long, doc_id long, mentions {MENTION}")
    scanned = scratch.table(scanned, "scanned")
    mentions = scanned.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    edges = scratch.table(mentions.select(F.explode("patterns").alias("pattern"), "instance").distinct(), "edges")
    seeds = scratch.table(mentions.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind")), "seeds")
    taken = bootstrap(edges, seeds, scratch)
    more = mentions.where("kind is null").select("row", "s", "e", "instance").join(taken, "instance").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("s", (-F.col("e")).alias("o"), "kind"))).alias("found"))
    more = more.select("row", F.aggregate("found", F.struct(F.lit(0).alias("end"), F.expr("cast(array() as array<struct<kind:string,s:int,e:int>>)").alias("kept")), _apart)["kept"].alias("more"))
    order = lambda a, b: F.when(F.array_position(F.lit(list(KINDS)), a["kind"]) != F.array_position(F.lit(list(KINDS)), b["kind"]), F.array_position(F.lit(list(KINDS)), a["kind"]) - F.array_position(F.lit(list(KINDS)), b["kind"])).otherwise(a["s"] - b["s"]).cast("int")
    base = F.transform(F.filter("mentions", lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["kind"].alias("kind"), m["s"].alias("s"), m["e"].alias("e")))
    more = scratch.table(more, "more")
    scratch.keep("scanned", "more")
    return scanned.join(more, "row", "left").select("row", "doc_id", base.alias("base"), F.array_sort(F.concat(base, F.coalesce("more", F.expr("array()"))), order).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    text = lambda c: F.array_join(F.transform(c, lambda m: F.concat_ws(":", m["kind"], m["s"].cast("string"), m["e"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda m: m["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def digest(spans: list[tuple[str, int, int]]) -> str:
    """The digest of spans as the query gives it."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
