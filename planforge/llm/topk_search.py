"""Operator 6, exact top-k search by no-random-access aggregation.

Each dimension of a block of candidates is a list.  A query reads the lists one after the other, by the weight of its
components, largest first, and keeps for every candidate the sum of what it has read.  What the unread lists can still
add is bounded twice: by the lists' heads (their largest and least entries), and by the products of what is left of
both vectors' norms, whichever is less.  So a candidate's score lies between a lower and an upper bound at any time.
Candidates whose upper bound is below the k-th best lower bound cannot qualify; when few are left the reading stops and
their final scores are resolved.  A query that has read all lists has exact sums, where both bounds meet.

Queries are taken together: the lists that each has read are a mask, so sums and norms of all queries and candidates of
a block pair are matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

TOP, SCALE, EVERY = 20, 64, 20
#: Candidates of a block, queries that meet one at a time, and queries that are sent with it.
CANDIDATES, QUERIES, SENT = 16384, 512, 16384
#: Shares of the lists that are read before the bounds are looked at; the last is all of them.
DEPTHS = (0.5, 0.625, 0.75, 0.875, 1.0)
#: Reading stops for a query when at most this share of the block can still qualify.
FEW = 0.05
#: What rounding may take from a bound.
SLACK = 1e-5
#: Integer inner products below this are exact in doubles.
EXACT = 1 << 53


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, dims, out = [], [], []
        for i, x in zip(b.column("vec_id").to_pylist(), b.column("embedding").to_pylist(), strict=True):
            if i is None or x is None or any(y is None for y in x):
                continue
            v = np.array(x, dtype=np.float64)
            if not np.isfinite(v).all():
                continue
            ids.append(i)
            dims.append(len(v))
            q = np.floor(SCALE * v)
            if not (np.abs(q) < 2.0**63).all():
                raise OverflowError(f"vec_id {i}: floor({SCALE} * x) is beyond 64 bits")
            out.append(q.astype(np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "dim", "q"])


def _pack(table: pa.Table) -> pa.Table:
    """One row for a block: ids, and components in the narrowest integers that hold them."""
    table = table.sort_by("vec_id")
    ids = table.column("vec_id").to_numpy().astype(np.int64)
    m = np.frombuffer(b"".join(table.column("q").to_pylist()), np.int64)
    width = next(w for w in (1, 2, 4, 8) if w == 8 or _most(m) < 1 << (8 * w - 1))
    return pa.table([table.column("dim")[:1], table.column("block")[:1], pa.array([width], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([m.astype(f"i{width}").tobytes()], pa.binary())], names=["dim", "block", "width", "ids", "m"])


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _most(x: np.ndarray) -> int:
    """The largest magnitude, also of the least integer."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


def _exact(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """As nra(), by full products in 64-bit or Python integers: for vectors whose products doubles can't hold."""
    kind = np.int64 if _most(q) * _most(x) * x.shape[1] < 1 << 63 else object
    x = x.astype(kind)
    for row, v in zip(q_ids.tolist(), q.astype(kind), strict=True):
        at = np.flatnonzero(x_ids != row)
        scores = x[at] @ v
        order = sorted(range(len(at)), key=lambda p: (-int(scores[p]), int(x_ids[at[p]])))  # noqa: B023
        for p in order[:k]:
            yield row, int(x_ids[at[p]]), int(scores[p])


def nra(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int = TOP) -> Iterator[tuple[int, int, int]]:
    """(query id, candidate id, score): the k best candidates of a block for each query, but rows of its own id.

    Where doubles can't hold a block's products, large rows are taken apart and the k best come from each part.
    """
    if len(q) and len(x) and _most(q) * _most(x) * x.shape[1] >= EXACT:
        least = int((EXACT / x.shape[1]) ** 0.5) - 1  # two rows within it have exact products
        large_q, large_x = (((y > least) | (y < -least)).any(axis=1) for y in (q, x))
        if not large_q.all() and not large_x.all():
            yield from nra(q[~large_q], q_ids[~large_q], x[~large_x], x_ids[~large_x], k)
        yield from _exact(q[~large_q], q_ids[~large_q], x[large_x], x_ids[large_x], k)
        yield from _exact(q[large_q], q_ids[large_q], x, x_ids, k)
        return
    for at in range(0, len(q), QUERIES):
        yield from _read_lists(q[at : at + QUERIES], q_ids[at : at + QUERIES], x, x_ids, k)[0]


def _read_lists(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Results as nra()'s, and the number of queries that stopped at each of ``DEPTHS``."""
    n, dim = x.shape
    most = max(_most(q), _most(x))
    kind = np.float32 if most * most * max(1, dim) < 1 << 24 else np.float64
    q, x = q.astype(kind), x.astype(kind)
    todo, out, stopped = np.arange(len(q)), [], []
    if not n:
        return out, [0] * len(DEPTHS)
    square, high, low = (x * x).T, x.max(axis=0), x.min(axis=0)
    order = np.argsort(-np.abs(q), axis=1, kind="stable")  # the lists that matter most to each query come first
    for share in DEPTHS:
        read = np.zeros((len(todo), dim), dtype=kind)
        np.put_along_axis(read, order[todo, : int(np.ceil(share * dim))], 1, axis=1)
        known, rest = q[todo] * read, q[todo] * (1 - read)
        sums = known @ x.T
        own = q_ids[todo, None] == x_ids[None, :]  # however many rows a query's id has, none of them counts
        if share < 1:
            left = np.sqrt((rest * rest).sum(axis=1)[:, None] * ((1 - read) @ square)) * (1 + SLACK) + SLACK
            heads = np.maximum(rest * high, rest * low).sum(axis=1)[:, None], np.minimum(rest * high, rest * low).sum(axis=1)[:, None]
            upper, lower = sums + np.minimum(left, heads[0]), sums + np.maximum(-left, heads[1])
        else:
            upper, lower = sums, sums.copy()
        lower[own] = -np.inf
        bound = np.partition(lower, n - k, axis=1)[:, n - k, None] if n > k else -np.inf
        open_ = (upper >= bound) & ~own
        ready = open_.sum(axis=1) <= (max(FEW * n, 4 * k) if share < 1 else n)
        for r in np.flatnonzero(ready).tolist():
            row, at = int(todo[r]), np.flatnonzero(open_[r])
            scores = x[at] @ q[row]
            out += [(int(q_ids[row]), int(x_ids[at[p]]), int(scores[p])) for p in _best(scores, x_ids[at], k)]
        stopped.append(int(ready.sum()))
        todo = todo[~ready]
    return out, stopped


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, qi, qw, qm, xi, xw, xm in zip(*(b.column(c).to_pylist() for c in ("dim", "q_ids", "q_width", "q_m", "ids", "width", "m")), strict=True):
                q_ids, x_ids = np.frombuffer(qi, np.int64), np.frombuffer(xi, np.int64)
                q, x = (np.frombuffer(y, f"i{w}").reshape(len(i), dim).astype(np.int64) for y, w, i in ((qm, qw, q_ids), (xm, xw, x_ids)))
                found = list(nra(q, q_ids, x, x_ids, k))
                cols = zip(*found, strict=True) if found else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, every: int = EVERY, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` (vec_id, embedding) for each query, exactly.

    Queries are the rows whose vec_id is divisible by ``every``; candidates all rows of other vec_ids and of the same
    length.  Components are floor(64 * x); components and scores beyond 64 bits raise an error, as in SQL.  Scores are
    integer inner products, ties go to the smaller vec_id.  Vectors that are null or hold null or non-finite components, and rows without vec_id, take no
    part; repeated candidate rows are ranked one by one, repeated query rows answered once.  Fewer candidates than k
    give fewer rows; an empty table gives none; other columns, whatever their names, are not read.  Query blocks hold
    many queries, so that a candidate block travels once for each ``SENT`` queries.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    quantised = scratch.table(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_quantise, "vec_id long, dim int, q binary"), "quantised")
    total = quantised.count()
    blocks, q_blocks = max(1, -(-total // CANDIDATES)), max(1, -(-total // (every * SENT)))
    packed = "dim int, block int, width int, ids binary, m binary"
    row = F.xxhash64("vec_id", F.monotonically_increasing_id())  # repeated vec_ids spread too
    candidates = quantised.withColumn("block", F.pmod(row, F.lit(blocks)).cast("int")).groupBy("dim", "block").applyInArrow(_pack, packed)
    queries = quantised.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "dim"])
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int")).groupBy("dim", "block").applyInArrow(_pack, packed)
    asked = queries.select("dim", F.col("ids").alias("q_ids"), F.col("width").alias("q_width"), F.col("m").alias("q_m"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    pairs = asked.join(candidates, ["dim", "block"]).repartition(max(1, min(blocks * q_blocks, 100_000)))
    found = pairs.select("dim", "q_ids", "q_width", "q_m", "ids", "width", "m").mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
