"""Operator 12, source divergence audit: how far the sources of a language differ from each other, term by term.

Tasks count the terms of their documents by (lang, source, term).  The counts are dealt by hash of lang and term into
shards, so that all that is known of a term of a language is in one shard however common it is, and a hot source or
language is spread over all of them.  Each shard is aggregated by DuckDB, first into the counts of the terms that enough
documents hold, then, with the groups' totals, into partial sums for each pair of sources and its own best terms.  Spark
merges the shards' sums and ranks.

A term that neither of two sources holds gives the same summand everywhere, so shards sum the difference to it over the
terms that one of both holds, and the merge adds it for all terms: a shard's work follows its counts, not sources squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, Scratch, chunks, distinct_words, outside, shards_for

#: Documents of a language that must hold a term.
LEAST_DOCS = 10
#: Terms reported for each group.
TOP = 10
#: Bytes of input for each shard that counts, and kept counts for each shard that compares: what fits in a task.
SHARD, ROWS = 32 << 20, 1 << 18
#: What separates terms: ASCII without letters.
SEPARATORS = outside((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
COUNTS = "lang string, source string, term string, n long, docs long"
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
OUT = "kind int, lang string, source string, item string, value long"
_OUT = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

#: A shard's terms that enough documents of their language hold, with their counts by source.
KEPT_SQL = """
WITH c AS (SELECT lang, source, term, sum(n)::BIGINT AS n, sum(docs)::BIGINT AS docs FROM counted GROUP BY ALL),
k AS (SELECT lang, term FROM c GROUP BY ALL HAVING sum(docs) >= {least})
SELECT lang, source, term, n, docs FROM c SEMI JOIN k USING (lang, term)
"""
#: p of a count: rows of totals are (lang, source, total, terms), the language's own with a null source; languages without
#: kept terms have no counts.
_P = "(1 + (1000000000::HUGEINT * ({n} + 2)) // greatest({t}.total + 2 * {t}.terms, 1))::BIGINT"
_F = "((({a} - {b})::HUGEINT * ({a} - {b})) // ({a} + {b}))::BIGINT"
SHARD_SQL = f"""
WITH t AS (SELECT *, {_P.format(n=0, t="totals")} AS zero FROM totals),
c AS (SELECT k.lang, k.source, k.term, {_P.format(n="k.n", t="t")} AS p, t.zero FROM kept k JOIN t ON t.lang = k.lang AND t.source = k.source),
q AS (SELECT k.lang, k.term, {_P.format(n="k.n", t="t")} AS q FROM (SELECT lang, term, sum(n) AS n FROM kept GROUP BY ALL) k JOIN t ON t.lang = k.lang AND t.source IS NULL),
pairs AS (
  SELECT c.lang, least(c.source, t.source) AS source, greatest(c.source, t.source) AS item,
    {_F.format(a="c.p", b="coalesce(o.p, t.zero)")} - {_F.format(a="c.zero", b="t.zero")} AS value
  FROM c JOIN t ON t.lang = c.lang AND t.source <> c.source
  LEFT JOIN c o ON o.lang = c.lang AND o.term = c.term AND o.source = t.source
  WHERE o.p IS NULL OR c.source < t.source),
best AS (
  SELECT c.lang, c.source, c.term AS item, {_F.format(a="c.p", b="q.q")} AS value FROM c JOIN q USING (lang, term) WHERE c.p > q.q
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.source ORDER BY value DESC, item) <= {{top}})
SELECT 0::INTEGER AS kind, lang, source, item, sum(value)::BIGINT AS value FROM pairs GROUP BY ALL
UNION ALL SELECT 1::INTEGER, lang, source, item, value FROM best
"""


def _sql(text: str, **tables: pa.Table | pa.RecordBatchReader) -> pa.Table:
    with duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": "", "preserve_insertion_order": False}) as con:
        for name, table in tables.items():
            con.register(name, table)
        return con.sql(text).to_arrow_table()


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by lang, source and term of each chunk: occurrences and documents."""
    for langs, sources, texts in chunks(batches, ["lang", "source", "text"], limit=CHUNK_BYTES):
        names: dict[tuple, int] = {}
        group = np.array([names.setdefault((a or "", b or ""), len(names)) for a, b in zip(langs, sources, strict=True)], dtype=np.int64)
        order = np.argsort(group, kind="stable")
        index, words, n, _ = distinct_words([texts[i] for i in order], SEPARATORS)
        if not len(index):
            continue
        # by term and document; documents are in the order of their groups, so groups are runs of a term's documents
        at = np.sort(index * len(order) + np.repeat(np.arange(len(order)), n))
        doc = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        key = at[doc] // len(order) * len(names) + group[order][at[doc] % len(order)]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        term, g = np.divmod(key[first], len(names))
        lang, source = (pa.array(list(x), pa.string()) for x in zip(*names, strict=True))
        lower = pa.array([w.lower() for w in words], pa.binary()).cast(pa.string())
        counts = [np.diff(np.append(doc[first], len(at))), np.diff(np.append(first, len(doc)))]
        yield pa.RecordBatch.from_arrays([lang.take(pa.array(g)), source.take(pa.array(g)), lower.take(pa.array(term)), *(pa.array(c.astype(np.int64)) for c in counts)], schema=_COUNTS)


def _kept(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = pa.RecordBatchReader.from_batches(_COUNTS, (pa.RecordBatch.from_arrays(b.columns, schema=_COUNTS) for b in batches))
        yield from _sql(KEPT_SQL.format(least=int(least)), counted=counted).cast(_COUNTS).to_batches()

    return run


def _sums(top: int):
    def run(kept: pa.Table, totals: pa.Table) -> pa.Table:
        return _sql(SHARD_SQL.format(top=int(top)), kept=kept, totals=totals).cast(_OUT)

    return run


def divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source).

    Part ``pair``: for each source of a language every other one and their divergence, summed over the language's kept
    terms.  Part ``term``: the ``top`` terms that are more frequent in the source than in its language.  Kept terms are
    those that ``least`` documents of the language hold.  Ranks count from 1 for each group and part, by falling value,
    then by the item's bytes.

    Null text, lang and source are ''; a document without terms makes its group occur.  A source alone in its language
    has no pairs; without kept terms pairs have value 0.  Repeated rows are documents of their own.  An empty table
    gives no rows; other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    scratch, shards = Scratch(spark, "divergence"), shards_for(docs, SHARD)
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    docs = docs.select(*named)
    counted = docs.mapInArrow(_terms, COUNTS).repartition(shards, "lang", "term")
    kept = scratch.table(counted.mapInArrow(_kept(least), COUNTS), "kept")
    shards = max(16, -(-kept.count() // ROWS))  # each gives a row for every pair of sources, so no more than needed
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("terms"))
    groups = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0, ["total", "terms"])
    groups = scratch.table(groups.select("lang", "source", "total", "terms"), "groups")
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.first("terms").alias("terms")).select("lang", F.lit(None).cast("string").alias("source"), "total", "terms")
    # a shard gets the totals of every group: as many rows as there are sources, where the result has sources squared
    dealt = groups.unionByName(whole).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    parts = kept.withColumn("shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int")).groupBy("shard").cogroup(dealt.groupBy("shard"))
    found = scratch.table(parts.applyInArrow(_sums(top), OUT), "found")
    rank = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    best = rank(found.where("kind = 1").drop("kind")).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    sums = found.where("kind = 0").groupBy("lang", F.col("source").alias("low"), F.col("item").alias("high")).agg(F.sum("value").alias("more"))
    zero = F.when(F.col("terms") > 0, F.expr("1 + cast(2000000000 div (total + 2 * terms) as bigint)")).otherwise(0)
    a, b = groups.withColumn("p", zero).alias("a"), groups.select("lang", F.col("source").alias("item"), F.col("total").alias("other"), "terms").alias("b")
    b = b.withColumn("q", F.when(F.col("terms") > 0, F.expr("1 + cast(2000000000 div (other + 2 * terms) as bigint)")).otherwise(0)).drop("terms", "other")
    both = a.join(b, "lang").where("source <> item").withColumn("low", F.least("source", "item")).withColumn("high", F.greatest("source", "item"))
    base = F.when(F.col("terms") > 0, F.expr("terms * (((p - q) * (p - q)) div (p + q))")).otherwise(0)
    pairs = both.join(sums, ["lang", "low", "high"], "left").select("lang", "source", "item", (base + F.coalesce("more", F.lit(0))).cast("long").alias("value"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return rank(pairs).withColumn("part", F.lit("pair")).select(columns).unionByName(best.select(columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
x AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM x GROUP BY ALL HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY ALL),
c AS (SELECT x.lang, x.source, x.term, count(*) AS n FROM x SEMI JOIN k ON x.lang = k.lang AND x.term = k.term GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * v.v)) AS p,
    (1 + (1000000000::HUGEINT * (k.n + 2)) // (v.total + 2 * v.v)) AS q
  FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= 10
"""
