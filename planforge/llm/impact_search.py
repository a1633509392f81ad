"""Operator 13, ranked lexical search over impact-ordered postings, score at a time.

One pass over the documents keeps, for the terms that the queries ask for, each document's occurrences and length, and
counts what the weights need (documents, terms, documents of each term).  A second pass builds impact-ordered indexes of
blocks of documents: a term's postings are grouped by their exact impact.  A query takes the groups of all its terms by
falling contribution (weight times impact) and adds them to its accumulators.  After each step every term's next group
bounds what a document may still get from it; the query stops only once the bounds prove that the k best are among a few
documents, whose scores are then completed from their own lists.  Each block gives its k best, which Spark merges.

Blocks are runs of documents in the order in which they are stored: nothing is dealt by a key, so no term, document or
group of copies makes a large task.  Queries are taken in groups of a bounded number of terms; each group reads the
documents again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import pack, unpack
from .common import U64, Scratch, chunks, outside, trim, word_hashes

TOP = 10
#: Rows (item, term) of a group of queries, which every task holds.
QUERY_TERMS = 1 << 18
#: Postings of a block, for which all queries of a group run in one task.
POSTINGS = 3 << 20
#: Documents, as a multiple of k, that may still qualify when a query stops; their scores are completed.
OPEN = 5
#: Terms times documents up to which a block notes what a document has got; a longer query has wider bounds, and may read
#: more of its postings.
SEEN = 64 << 20
#: Shares of a query's postings after which its bounds are looked at.
STEPS = (1 / 64, 1 / 32, 1 / 16, 1 / 8, 3 / 16, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 7 / 8)
#: What separates terms: ASCII but for digits and letters.
SEPARATORS = outside((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: Rows of a chunk's postings (data), or of what a task has counted (the other columns).
HELD = "data binary, docs long, total long, terms array<int>, counts array<long>"
_HELD = pa.schema([("data", pa.binary()), ("docs", pa.int64()), ("total", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
FOUND = "item_id long, doc_id long, score long, n_read long, n_postings long"
_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("n_read", pa.int64()), ("n_postings", pa.int64())])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, term as its hash, occurrences) of items' texts."""
    for ids, texts in chunks(batches, ["item_id", "text"]):
        h, n = word_hashes(texts, SEPARATORS)
        item = pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(ids)), n)))
        yield pa.RecordBatch.from_arrays([item, pa.array(h.view(np.int64)), pa.array(np.ones(len(h), np.int64))], names=["item_id", "term", "n"])


def _collect(terms: np.ndarray):
    """Postings of ``terms`` (sorted hashes) by document, chunk by chunk, and a task's counts at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, total, held_by = 0, 0, np.zeros(len(terms), np.int64)
        for ids, texts in chunks(batches, ["doc_id", "text"]):
            h, n = word_hashes(texts, SEPARATORS)
            n_docs, total = n_docs + int((n > 0).sum()), total + int(n.sum())
            at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
            hit = terms[at] == h
            key = np.sort(np.repeat(np.arange(len(n), dtype=np.int64), n)[hit] * len(terms) + at[hit])
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            tf = np.diff(np.append(first, len(key))).astype(np.uint32)
            doc, term = np.divmod(key[first], len(terms))
            held_by += np.bincount(term, minlength=len(terms))
            null = np.array([i is None for i in ids], dtype=np.uint8)
            ids = np.array([0 if i is None else i for i in ids], dtype=np.int64)
            has = np.bincount(doc, minlength=len(n)).astype(np.uint32)
            out = np.flatnonzero(has)  # documents with none of the terms are in no result
            data = pack(ids[out], null[out], n[out].astype(np.int64), has[out], term.astype(np.uint32), tf)
            yield pa.RecordBatch.from_arrays([pa.array([data]), *(pa.nulls(1, f.type) for f in list(_HELD)[1:])], schema=_HELD)
        some = np.flatnonzero(held_by)
        counted = [pa.nulls(1, pa.binary()), pa.array([n_docs]), pa.array([total]), pa.array([some.astype(np.int32)], _HELD.field("terms").type), pa.array([held_by[some]], _HELD.field("counts").type)]
        yield pa.RecordBatch.from_arrays(counted, schema=_HELD)

    return run


class Queries(NamedTuple):
    """Weights of the queries' terms: query q has ``term[first[q]:first[q+1]]`` with their ``weight`` (times repeats)."""

    items: list
    first: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    n_docs: int
    total: int
    n_terms: int


class Index:
    """Impact-ordered postings of a block of documents."""

    def __init__(self, data: list[bytes], n_docs: int, total: int, n_terms: int):
        parts = [unpack(d) for d in data]
        self.ids, self.null, n, has, term, tf = (np.concatenate([p[i] for p in parts]) for i in range(6))
        lengths, at = np.unique(n, return_inverse=True)
        m = np.array([25 + 75 * x * n_docs // total for x in lengths.tolist()], dtype=np.int64)[at] if len(n) else n
        self.doc, tf = np.repeat(np.arange(len(n)), has), tf.astype(np.int64)
        self.begin = np.concatenate([[0], np.cumsum(has, dtype=np.int64)])
        self.term = term.astype(np.int64)
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[self.doc])
        order = np.lexsort((-self.impact, self.term))
        self.posted, t, i = self.doc[order], self.term[order], self.impact[order]
        new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (i[1:] != i[:-1])])) if len(t) else np.zeros(0, np.int64)
        #: groups of equal term and impact: their impact and first posting; groups of term t from ``of[t]``
        self.group_impact, self.group_first = i[new], np.append(new, len(t))
        self.of = np.searchsorted(t[new], np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int, int]:
        """(documents, scores, postings read, postings): the ``k`` best documents with a score above 0, by falling
        score, then id.  ``dense``: zeros for each term, returned as such.  Documents below ``floor``, what the k-th best
        elsewhere has, may be left out."""
        counts = self.of[terms + 1] - self.of[terms]
        group = np.repeat(self.of[terms] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        own = np.repeat(np.arange(len(terms)), counts)
        gain = self.group_impact[group] * np.repeat(weights, counts)
        order = np.argsort(-gain, kind="stable")
        group, own, gain = group[order], own[order], gain[order]
        sizes = self.group_first[group + 1] - self.group_first[group]
        ends = np.cumsum(sizes)
        every = int(ends[-1]) if len(ends) else 0
        cuts = sorted({*(int(np.searchsorted(ends, s * every)) for s in STEPS), len(group)} - {0})
        acc, tight = np.zeros(len(self.ids), np.int64), len(terms) * len(self.ids) <= SEEN
        seen = np.zeros((len(terms), len(self.ids)) if tight else (0, 0), dtype=bool)
        at, exact = 0, True
        best = np.zeros(0, np.int64)
        for cut in cuts:
            k_of = sizes[at:cut]
            posting = np.repeat(self.group_first[group[at:cut]] - (np.cumsum(k_of) - k_of), k_of) + np.arange(int(k_of.sum()))
            docs = self.posted[posting]
            np.add.at(acc, docs, np.repeat(gain[at:cut], k_of))
            if tight:
                seen[np.repeat(own[at:cut], k_of), docs] = True
            at = cut
            if at == len(group) or len(acc) <= k:
                continue
            ahead, first = np.unique(own[at:], return_index=True)  # a term's next group is its largest left
            rest = np.zeros(len(terms), np.int64)
            rest[ahead] = gain[at:][first]
            kth = max(np.partition(acc, len(acc) - k)[len(acc) - k], floor)
            if kth <= rest.sum() and not acc.all():  # a document without any term so far
                continue
            reach = np.flatnonzero(acc + int(rest.sum()) >= kth)
            if tight:
                reach = reach[acc[reach] + rest @ ~seen[:, reach] >= kth]
            if len(reach) <= OPEN * k:
                best, exact = reach, False
                break
        if exact:
            best = np.flatnonzero(acc)
            if len(best) > k:
                kth = np.partition(acc[best], len(best) - k)[len(best) - k]
                best = best[acc[best] >= kth]
            scores = acc[best]
        else:
            dense[terms] = weights
            scores = np.array([int(dense[self.term[a:b]] @ self.impact[a:b]) for a, b in zip(self.begin[best].tolist(), self.begin[best + 1].tolist(), strict=True)], dtype=np.int64)
            dense[terms] = 0
        keep = np.lexsort((self.ids[best], self.null[best], -scores))[:k]
        return best[keep], scores[keep], int(ends[at - 1]) if at else 0, every


def _search(queries: Queries, k: int):
    best: list[list[int]] = [[] for _ in queries.items]  # of the task's blocks so far

    def block(data: list[bytes]) -> pa.RecordBatch:
        index, dense = Index(data, queries.n_docs, queries.total, queries.n_terms), np.zeros(queries.n_terms, np.int64)
        rows: list[list] = [[] for _ in range(5)]
        for q, item in enumerate(queries.items):
            a, b = queries.first[q], queries.first[q + 1]
            docs, scores, read, every = index.search(queries.term[a:b], queries.weight[a:b], dense, k, best[q][-1] if len(best[q]) == k else 0)
            best[q] = sorted([*best[q], *scores.tolist()], reverse=True)[:k]
            ids = [None if x else i for i, x in zip(index.ids[docs].tolist(), index.null[docs].tolist(), strict=True)]
            for c, x in zip(rows, ([item] * len(ids), ids, scores.tolist(), [read] * len(ids), [every] * len(ids)), strict=True):
                c += x
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _FOUND, strict=True)], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for data in b.column(0).to_pylist():
                held.append(data)
                n += len(unpack(data)[4])
                if n >= POSTINGS:
                    yield block(held)
                    held, n = [], 0
                    trim()
        if held:
            yield block(held)
        trim()

    return run


def weight(n_docs: int, held_by: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held_by + 1)))


def _group(docs: DataFrame, rows: list, k: int, scratch: Scratch, name: str) -> DataFrame:
    """Every block's results of the queries in ``rows`` (item_id, term, n)."""
    items = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i or 0))
    number = {i: q for q, i in enumerate(items)}
    terms = np.unique(np.array([r.term for r in rows], dtype=np.int64).view(U64))
    held = scratch.table(docs.mapInArrow(_collect(terms), HELD), name)
    counted = held.where("docs is not null")
    sums = counted.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    by_term = counted.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("n")).collect()
    held_by = dict(map(tuple, by_term))
    rows = sorted(rows, key=lambda r: (number[r.item_id], r.term))
    at = np.searchsorted(terms, np.array([r.term for r in rows], dtype=np.int64).view(U64)).astype(np.int64)
    own = np.array([weight(sums.docs, held_by.get(t, 0)) * r.n for t, r in zip(at.tolist(), rows, strict=True)], dtype=np.int64)
    first = np.searchsorted(np.array([number[r.item_id] for r in rows]), np.arange(len(items) + 1))
    return held.where("data is not null").select("data").mapInArrow(_search(Queries(items, first, at, own, sums.docs, sums.total, len(terms)), k), FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, query_terms: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score, n_read, n_postings): each item's ``k`` best documents with a score above 0.

    ``docs`` (doc_id, text), ``items`` (item_id, text).  Equal scores go by doc_id, null last; ranks count from 1.
    n_read and n_postings say how many of the item's postings its search read in the document's block, and how many the
    block has.  Terms are told apart by 64-bit hashes.  Texts that are null, empty or without terms are in no result,
    and such items have none.  Repeated documents are results of their own; items are told apart by item_id: repeated
    rows count once, and different texts of one item_id are one item with the terms of all.  Empty tables give no rows;
    other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "impact")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    asked = items.mapInArrow(_asked, "item_id long, term long, n long").groupBy("item_id", "term").agg(F.sum("n").alias("n"))
    asked = scratch.table(asked, "asked")
    groups = -(-asked.count() // query_terms)
    out = None
    for g in range(groups):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).collect()
        if not rows:
            continue
        found = _group(docs, rows, k, scratch, f"held{g}")
        own = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        part = ranked.select("item_id", "rank", "doc_id", "score", "n_read", "n_postings")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long, n_read long, n_postings long") if out is None else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("n_read", "n_postings")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
x AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d),
p AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM x WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY ALL),
c AS (SELECT q.item_id, p.r, p.doc_id, sum(q.times * floor(1000 * ln((2 * s.n_docs + 2) / (2 * f.df + 1)))::BIGINT * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * p.n * s.n_docs) // s.total))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN f USING (term) CROSS JOIN s GROUP BY ALL),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""
