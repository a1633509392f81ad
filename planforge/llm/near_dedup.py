"""Operator 2, MinHash near-dedup with SetSketch registers.

A document's set is its distinct 5-word shingles.  Its sketch holds, for each of ``BANDS * ROWS`` hash functions, the
exponentially spaced, truncated minimum ``floor(1 - log_b(x))`` of exponential values x of the set's elements: sketches
of parts merge by their maxima, and the share of equal registers follows the Jaccard similarity.  Documents whose
registers agree in a band meet in a bucket.  A pair's similarity is estimated jointly: by the likelihood of the numbers
of larger, smaller and equal registers given both set sizes; pairs that it cannot rule out are verified on full sets.

Equal sets are one class with one representative, so copies are never compared.  Buckets are not expanded into pairs:

1. every class is compared with the bucket's centre, the same class in all bands where possible;
2. buckets that still hold several components: their classes against another centre, drawn for each bucket;
3. what is left: the classes outside the bucket's largest component against those of other components.  Buckets of
   at most ``SMALL`` classes give pairs; larger ones are compared in blocks, whose exact intersections are a matrix
   product over the shingles that both sides share, and give at most one link for each class and component.  Buckets
   of more than ``REBAND`` classes are dealt once more first, to buckets of classes that share two of them: what shares
   one of them and a smaller bucket is compared in the smaller one.

After the third step every two classes that share a bucket (of a large one: two bands) are linked through a path, or
were compared, or belong to one component, and the work falls on pairs of different components.  A pair at similarity
0.85 shares no band with a probability of about 4e-7, and fewer than two with about 1e-5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Scratch, chunks, mix64, partitions, word_hashes

WORDS, BANDS, ROWS = 5, 25, 5
SIMILARITY = (85, 100)
B, RATE, Q = 1.001, 20.0, 65534
#: Log-likelihood by which the best similarity must beat all linked ones to rule a pair out (over 5 deviations).
MARGIN = 14.0
#: Classes of a block in step 3; ids that a broadcast of wanted documents may hold.
BLOCK, BROADCAST_IDS = 256, 500_000
#: Largest bucket whose pairs are listed in step 3, and largest that is not dealt by a second band.
SMALL, REBAND = 16, 1024
#: Rows of blocks for each task of step 3: its work is the blocks' products, not their bytes.
TASK_ROWS = 1024
_RANDOM = mix64(np.arange(1, 3 * BANDS * ROWS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
_ADD, _MUL, _MUL2 = ((_RANDOM[k :: 3] >> U64(32)).astype(np.uint32) | np.uint32(1) for k in range(3))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of the 5-word shingles of each text; of all words where there are fewer; none without words."""
    h, counts = word_hashes(texts)
    if not len(h):
        return [h] * len(texts)
    rolled = np.zeros(max(0, len(h) - WORDS + 1), dtype=U64)
    for k in range(WORDS):
        rolled = rolled * U64(0x9E3779B97F4A7C15) + h[k : k + len(rolled)]
    rolled = mix64(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            out.append(np.unique(rolled[at : at + n - WORDS + 1]))
        elif n:
            short = U64(n)
            x = np.full(1, short, dtype=U64)
            for k in range(n):
                x = mix64(x * U64(0x9E3779B97F4A7C15) + h[at + k])
            out.append(x)
        else:
            out.append(h[:0])
        at += n
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers, a uint16 row for each non-empty set."""
    out = np.empty((len(sets), BANDS * ROWS), dtype=np.uint16)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 16):
            size += len(sets[end])
            end += 1
        x = (np.concatenate(sets[at:end]) >> U64(32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(s) for s in sets[at : end - 1])])
        least = np.empty((BANDS * ROWS, end - at), dtype=np.float64)
        for i in range(BANDS * ROWS):
            v = (x + _ADD[i]) * _MUL[i]
            v ^= v >> np.uint32(15)
            v *= _MUL2[i]
            least[i] = np.minimum.reduceat(v, starts)
        exponential = -np.log1p(-(least + 0.5) / 2**32) / RATE
        out[at:end] = np.clip(np.floor(1 - np.log(exponential) / np.log(B)), 0, Q + 1).T.astype(np.uint16)
        at = end
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def possible(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float = SIMILARITY[0] / SIMILARITY[1]) -> np.ndarray:
    """Whether the joint likelihood of two sketches (rows) leaves a similarity of ``least`` open."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    p = lambda x: -np.log(np.clip(1 - np.clip(x, 1e-12, 1) * (B - 1) / B, 1e-300, 1)) / np.log(B)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        return more * np.log(np.clip(up, 1e-9, 1)) + less * np.log(np.clip(down, 1e-9, 1)) + same * np.log(np.clip(1 - up - down, 1e-9, 1))

    grid = np.linspace(0, 1, 41)[None, :]
    best = likelihood(grid * top).max(axis=1)
    linked = likelihood(np.minimum(top, least + (top - least) * np.linspace(0, 1, 9)[None, :])).max(axis=1)
    return (top[:, 0] >= least - 1e-9) & (linked >= best - MARGIN)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, keys, texts in chunks(batches, ["doc_id", "key", "text"]):
        sets = shingle_sets(texts)
        full = [s for s in sets if len(s)]
        rows = iter(registers(full))
        sketch = [next(rows).tobytes() if len(s) else None for s in sets]
        prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        cols = [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(list(map(len, sets)), pa.int64()), pa.array(prints, pa.binary()), pa.array(sketch, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "key", "n_shingles", "print", "registers"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint16).reshape(-1, BANDS, ROWS)
        key = np.zeros((len(x), BANDS), dtype=U64) + np.arange(1, BANDS + 1, dtype=U64)[None, :]
        for k in range(ROWS):
            key = mix64(key * U64(0x9E3779B97F4A7C15) + x[:, :, k].astype(U64))
        keys = pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, BANDS, dtype=np.int32)), pa.array(key.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays([b.column(0), keys], names=["cid", "keys"])


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        ra, rb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1) for c in ("ra", "rb"))
        na, nb = (b.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
        keep = pa.array(possible(ra, rb, na, nb))
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True):
            x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
            both = np.sort(np.concatenate([x, y]))
            n = int((both[1:] == both[:-1]).sum())
            keep.append(SIMILARITY[1] * n >= SIMILARITY[0] * (len(x) + len(y) - n))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cids, prints, texts in chunks(batches, ["cid", "print", "text"]):
        sets = shingle_sets(texts)
        own = [i for i, s in enumerate(sets) if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == prints[i]]
        yield pa.RecordBatch.from_arrays([pa.array([cids[i] for i in own], pa.int64()), pa.array([sets[i].tobytes() for i in own], pa.binary())], names=["cid", "elements"])


def _blocks(key: tuple, table: pa.Table) -> pa.Table:
    """Possible pairs of one block: outsiders (side 0) against the block's classes (side 1) of other components."""
    side = table.column("side").to_numpy()
    cid, comp, n = (table.column(c).to_numpy() for c in ("cid", "comp", "n"))
    x = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(len(cid), -1)
    outside = table.column("outside").to_numpy(zero_copy_only=False)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    a, b = [], []
    for i in left:
        other = right[(comp[right] != comp[i]) & (~outside[right] | (cid[right] > cid[i]))]
        if len(other):
            ok = other[possible(np.broadcast_to(x[i], (len(other), x.shape[1])), x[other], np.full(len(other), float(n[i])), n[other].astype(float))]
            a += [cid[i]] * len(ok)
            b += cid[ok].tolist()
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def intersections(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``, sorted distinct elements each."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    shared = np.intersect1d(np.concatenate(a), np.concatenate(b))
    if not len(shared):
        return out

    def entries(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, x = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, x), len(shared) - 1)
        hit = shared[at] == x
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    sides = entries(a), entries(b)
    for low in range(0, len(shared), width):
        dense = []
        for (row, at), sets in zip(sides, (a, b), strict=True):
            begin, end = np.searchsorted(at, [low, low + width])
            m = np.zeros((len(sets), min(width, len(shared) - low)), dtype=np.float32)
            m[row[begin:end], at[begin:end] - low] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _block_links(key: tuple, table: pa.Table) -> pa.Table:
    """Links of outsiders (side 0) with a block's classes (side 1) of other components, one for each component."""
    side, (cid, comp) = table.column("side").to_numpy(), (table.column(c).to_numpy() for c in ("cid", "comp"))
    outside = table.column("outside").to_numpy(zero_copy_only=False)
    sets = [np.frombuffer(x, U64) for x in table.column("elements").to_pylist()]
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return pa.table([pa.array([], pa.int64())] * 2, names=["a", "b"])
    n = intersections([sets[i] for i in left], [sets[i] for i in right]).astype(np.int64)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    union = size[left][:, None] + size[right][None, :] - n
    ok = (SIMILARITY[1] * n >= SIMILARITY[0] * union) & (comp[left][:, None] != comp[right][None, :])
    ok &= ~outside[right][None, :] | (cid[left][:, None] < cid[right][None, :])
    i, j = np.nonzero(ok)
    _, first = np.unique(np.stack([i, comp[right][j]]), axis=1, return_index=True)
    return pa.table([pa.array(cid[left][i[first]]), pa.array(cid[right][j[first]])], names=["a", "b"])


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(cid, comp): the least node reachable, for the nodes of ``edges`` (a, b); label spreading with pointer jumps.

    Nothing is gathered on the driver; each round is a table in the shared folder.
    """
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")).distinct()
    both = scratch.table(both, f"{name}-edges")
    labels = scratch.table(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("comp")).withColumnRenamed("x", "cid"), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.withColumnRenamed("cid", "y"), "y").groupBy("x").agg(F.min("comp").alias("near"))
        low = labels.join(near, F.col("cid") == F.col("x")).select("cid", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("cid").alias("comp"), F.col("comp").alias("far"))
        new = scratch.table(low.join(jump, "comp", "left").select("cid", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp")), f"{name}-{step}")
        changed = new.where("old <> comp").limit(1).count()
        labels = new.select("cid", "comp")
        if not changed:
            return labels


def extend(labels: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``labels`` (cid, comp) after further links (a, b): components of the linked components, not of all edges again."""
    links = scratch.table(links.distinct(), f"{name}-links")
    nodes = links.select(F.col("a").alias("cid")).union(links.select("b")).distinct()
    known = scratch.table(labels.unionByName(nodes.join(labels, "cid", "left_anti").select("cid", F.col("cid").alias("comp"))), f"{name}-known")
    a, b = (known.select(F.col("cid").alias(k), F.col("comp").alias(f"c{k}")) for k in "ab")
    between = links.join(a, "a").join(b, "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = components(between, scratch, f"{name}-merged").select(F.col("cid").alias("comp"), F.col("comp").alias("new"))
    return scratch.table(known.join(merged, "comp", "left").select("cid", F.coalesce("new", "comp").alias("comp")), name)


def near_dedup(docs: DataFrame, reband: int = REBAND) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, key, n_shingles, component_id, leads.

    Documents are linked when 100 * intersection >= 85 * union of their shingle sets; component_id is the least doc_id
    reachable.  ``key`` is xxhash64 of the text; ``leads`` marks the row of least (doc_id, key) of its component, equal
    rows together, and rows that are linked with nothing.  Null and empty texts, and those of white space only, have an
    empty set and are linked with nothing.  Rows without doc_id are linked with nothing and have no component_id.
    Repeated rows share a component.  An empty table gives no rows; other columns, whatever their names, are not read.
    Elements are 64-bit hashes of shingles, sets are equal where 128-bit digests of their elements are.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = docs.withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    sketches = scratch.table(keyed.mapInArrow(_sketch, "doc_id long, key long, n_shingles long, print binary, registers binary"), "sketches")
    linked = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = linked.groupBy("print").agg(F.min(F.struct("doc_id", "key")).alias("lead"), F.min("doc_id").alias("gid"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
    # numbers, not hashes: they can't collide, and once written they stay
    classes = scratch.table(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    bands = classes.select("cid", "registers").mapInArrow(_bands, "cid long, keys array<long>").select("cid", F.explode("keys").alias("key"))
    bands = scratch.table(bands, "bands")
    # what joins the members of a key is a table of its own, so that the join of a large bucket can be split
    shared = bands.groupBy("key").agg(F.count("*").alias("k"), F.min(F.struct(F.xxhash64("cid").alias("h"), F.col("cid").alias("c"))).alias("m")).where("k > 1")
    shared = scratch.table(shared.select("key", F.col("m.c").alias("centre")), "shared")
    members = scratch.table(bands.join(shared, "key"), "members")
    info = classes.select("cid", "n", "registers")
    wanted = scratch.table(members.select("cid").distinct().join(classes.select("cid", "gid", "print"), "cid"), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    named = wanted.select(F.col("gid").alias("doc_id"), "cid", "print")
    texts = docs.join(F.broadcast(named) if few else named, "doc_id").select("cid", "print", "text")
    sets = scratch.table(texts.mapInArrow(_sets, "cid long, elements binary").dropDuplicates(["cid"]), "sets")

    def possible_pairs(pairs: DataFrame) -> DataFrame:
        a, b = (info.select(F.col("cid").alias(k), F.col("n").alias(f"n{k}"), F.col("registers").alias(f"r{k}")) for k in "ab")
        return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimate, "a long, b long")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (sets.select(F.col("cid").alias(k), F.col("elements").alias(f"s{k}")) for k in "ab")
        return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(_exact, "a long, b long")

    def several(named: DataFrame, name: str) -> DataFrame:
        """Members (key, cid, comp) of buckets that hold several components."""
        keys = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        return scratch.table(named.join(scratch.table(keys.select("key"), f"{name}-keys"), "key"), name)

    def placed(members: DataFrame, labels: DataFrame) -> DataFrame:
        return members.join(labels, "cid", "left").select("key", "cid", F.coalesce("comp", "cid").alias("comp"))

    pairs = members.where("cid <> centre").select(F.col("cid").alias("a"), F.col("centre").alias("b")).distinct()
    labels = components(verified(possible_pairs(pairs)), scratch, "comp1")

    left = several(placed(members, labels), "left1")
    centre = left.groupBy("key").agg(F.min(F.struct(F.xxhash64("cid", "key").alias("h"), F.col("cid").alias("b"), F.col("comp").alias("other"))).alias("m"))
    pairs = left.join(scratch.table(centre.select("key", "m.b", "m.other"), "centres"), "key").where("comp <> other").select(F.col("cid").alias("a"), "b").distinct()
    labels = extend(labels, verified(possible_pairs(pairs)), scratch, "comp2")

    left = several(placed(left.select("key", "cid"), labels), "left2")
    large = scratch.table(left.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > reband).select("key"), "large")
    if large.limit(1).count():
        # classes of two components that share a smaller bucket too meet in that one, which is in ``left``
        crowded = scratch.table(left.join(large, "key"), "crowded")
        second = crowded.select("cid", F.col("key").alias("second"))
        again = crowded.select(F.col("key").alias("first"), "cid", "comp").join(second, "cid").where("first < second").select(F.xxhash64("first", "second").alias("key"), "cid", "comp")
        left = several(left.join(large, "key", "left_anti").unionByName(again), "left3")
    sizes = left.groupBy("key", "comp").agg(F.count("*").alias("k"))
    main = sizes.groupBy("key").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("k"))
    held = scratch.table(left.join(scratch.table(main, "main"), "key").withColumn("outside", F.col("comp") != F.col("main")), "held")

    def facing(held: DataFrame, more: list[str]) -> DataFrame:
        """Blocks (key, i, j): part i of a bucket's outsiders (side 0) and part j of all its classes (side 1)."""
        blocks = F.ceil(F.col("k") / BLOCK).cast("int")
        part = F.pmod(F.xxhash64("cid"), blocks).cast("int")
        cols = ["key", "cid", "comp", "outside", "i", "j", "side", *more]
        out = held.where("outside").withColumn("i", part).withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("side", F.lit(0))
        parts = held.where("outside").select("key", part.alias("i")).distinct()
        return out.select(cols).unionByName(held.join(parts, "key").withColumn("j", part).withColumn("side", F.lit(1)).select(cols))

    rows = {r.small: r.n for r in held.groupBy((F.col("k") <= SMALL).alias("small")).agg(F.sum(F.ceil(F.col("k") / BLOCK)).alias("n")).collect()}
    tasks = lambda small: max(partitions(spark), int(rows.get(small) or 0) // TASK_ROWS)
    by = ["key", "i", "j"]
    few = facing(held.where(F.col("k") <= SMALL).join(info, "cid"), ["n", "registers"])
    pairs = scratch.table(few.repartition(tasks(True), *by).groupBy(*by).applyInArrow(_blocks, "a long, b long").distinct(), "pairs3")
    many = facing(held.where(F.col("k") > SMALL).join(sets, "cid"), ["elements"])
    links = many.repartition(tasks(False), *by).groupBy(*by).applyInArrow(_block_links, "a long, b long")
    labels = extend(labels, verified(pairs).union(links), scratch, "comp3")

    placed_classes = classes.join(labels, "cid", "left").select("print", "lead", F.coalesce("comp", "cid").alias("comp"))
    least = placed_classes.groupBy("comp").agg(F.min("lead").alias("first"))
    final = scratch.table(placed_classes.join(least, "comp").select("print", "first"), "final")
    scratch.keep("sketches", "final")
    rows = sketches.select("doc_id", "key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("print")).alias("print"))
    leads = F.coalesce(F.struct("doc_id", "key") == F.col("first"), F.lit(True))
    return rows.join(final, "print", "left").select("doc_id", "key", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"), leads.alias("leads"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), c AS (
  SELECT a AS doc_id, a AS reached FROM e UNION SELECT c.doc_id, e.b FROM c JOIN e ON e.a = c.reached
), m AS (SELECT doc_id, min(reached) AS component_id FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
