"""Operator 3, exact dedup: an extendible-hash index on shared files.

Every task turns its documents into index entries: a 64-bit key (the head of the SHA-256 of the normalised text),
the text's bytes once for each distinct text of the task, and the task's best row and row count for that text, so a
text that a third of all rows share reaches its owner once for each task.  The entries are files in the shared
folder.  The directory starts with one bucket; a bucket that holds more than ``capacity`` bytes is split in two, and
the directory doubles whenever a bucket's depth exceeds the directory's.  The splits are decided on the sizes of key
ranges before an entry is moved, so no bucket file is ever written twice.  Owner tasks take runs of neighbouring
buckets, chain the entries of equal keys and compare the texts' bytes; each chain slot is one distinct text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, partitions, pylists

WHITE = b" \t\n\x0b\x0c\r"
ENTRY = "kind int, row long, doc_id long, n_cp long, key long, sha binary, body binary, n long"
SLOT = "slot_sha binary, slot int, keep_row long, keep_id long, group_size long"
#: Distinct texts that a task aggregates before it passes its sums on.
HELD = 100_000
#: Longest prefix of a key that the directory looks at: it never exceeds 2**DEPTH rows.  Above 2**(DEPTH-1) buckets'
#: worth of bytes the buckets' capacity grows with the input instead (from 2 TB of distinct texts at 16 MB a bucket).
DEPTH = 18
#: Owner tasks at most, and bytes of neighbouring buckets that an owner takes, fewer where there are few bytes in all.
OWNERS, OWNED = 50_000, 64 << 20
#: Texts with more rows than 1 / HEAVY of all are joined by broadcast: there are fewer than HEAVY of them.
HEAVY = 4096


def _better(a: tuple, b: tuple) -> bool:
    """More code points, then the smaller doc_id (null last), then the earlier row."""
    return (-a[0], a[1] is None, a[1] or 0, a[2]) < (-b[0], b[1] is None, b[1] or 0, b[2])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, at = TaskContext.get().partitionId() << 40, 0
    held: dict[bytes, list] = {}
    schema = pa.schema([("kind", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_cp", pa.int64()), ("key", pa.int64()), ("sha", pa.binary()), ("body", pa.binary()), ("n", pa.int64())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def sums() -> list[tuple]:
        return [(1, best[2], best[1], best[0], int.from_bytes(sha[:8], "big", signed=True), sha, None, n) for sha, (n, best) in held.items()]

    for b in batches:
        rows, size = [], 0
        for doc_id, text in zip(*pylists(b, ["doc_id", "text"]), strict=True):
            text = text or ""
            raw = text.encode("utf-8", "surrogatepass").translate(None, WHITE)
            sha = hashlib.sha256(raw).digest()
            key, row = int.from_bytes(sha[:8], "big", signed=True), base + at
            at += 1
            rows.append((0, row, doc_id, len(text), key, sha, None, None))
            mine = (len(text), doc_id, row)
            if sha in held:
                held[sha][0] += 1
                if _better(mine, held[sha][1]):
                    held[sha][1] = mine
            else:
                held[sha] = [1, mine]
                rows.append((2, None, None, None, key, sha, raw, None))
                size += len(raw)
            if size > 8 << 20:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)
        if len(held) >= HELD:
            yield batch(sums())
            held = {}
    if held:
        yield batch(sums())


def directory(histogram: dict[int, int], depth: int, capacity: int) -> list[tuple[int, int]]:
    """Extendible hashing's directory for bytes counted by the keys' first ``depth`` bits.

    Returns the bucket (its first slot, at the directory's depth) of each slot: [(slot, bucket)].  Buckets with at
    most ``capacity`` bytes, or of ``depth`` bits, are not split.
    """
    size = np.zeros(1 << depth, dtype=np.int64)
    for k, v in histogram.items():
        size[k] = v
    total = np.concatenate([[0], np.cumsum(size)])
    buckets, todo, world = [], [(0, 0)], 0
    while todo:
        prefix, local = todo.pop()
        low, high = prefix << (depth - local), (prefix + 1) << (depth - local)
        if local < depth and total[high] - total[low] > capacity:
            world = max(world, local + 1)  # the directory doubles
            todo += [(2 * prefix, local + 1), (2 * prefix + 1, local + 1)]
        else:
            buckets.append((prefix, local))
    return [(s, p << (world - local)) for p, local in sorted(buckets, key=lambda b: b[0] << (depth - b[1])) for s in range(p << (world - local), (p + 1) << (world - local))]


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by key, bodies first: chains of slots (body, sha, rows, best)."""
    key, chain = None, []

    def out() -> pa.RecordBatch:
        cols = [[s[1] for s in chain], list(range(len(chain))), [s[3][2] for s in chain], [s[3][1] for s in chain], [s[2] for s in chain]]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["slot_sha", "slot", "keep_row", "keep_id", "group_size"])

    ready: list[pa.RecordBatch] = []
    for b in batches:
        for k, kind, row, doc_id, n_cp, sha, body, n in zip(*pylists(b, ["key", "kind", "row", "doc_id", "n_cp", "sha", "body", "n"]), strict=True):
            if k != key:
                if chain:
                    ready.append(out())
                key, chain = k, []
            if kind == 2:
                if not any(s[0] == body for s in chain):
                    chain.append([body, sha, 0, None])
                continue
            slot = next(s for s in chain if s[1] == sha)
            slot[2] += n
            if slot[3] is None or _better((n_cp, doc_id, row), slot[3]):
                slot[3] = (n_cp, doc_id, row)
        if len(ready) > 500:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
            ready = []
    if chain:
        ready.append(out())
    if ready:
        yield from pa.Table.from_batches(ready).combine_chunks().to_batches()


def owners(buckets: dict[int, int], tasks: int, most: int = OWNERS, each: int = OWNED) -> dict[int, int]:
    """The owner of each bucket: runs of neighbouring buckets of about equal bytes, for ``tasks`` owners at least where
    there are as many buckets; ``buckets``: bytes by first slot."""
    total = sum(buckets.values())
    each, out, at = max(1, -(-total // most), min(each, total // max(1, tasks))), {}, 0
    for bucket in sorted(buckets):
        out[bucket] = at // each
        at += buckets[bucket]
    return out


def exact_dedup(docs: DataFrame, capacity: int = 16 << 20) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): row, doc_id, keep_id, keep_row, group_size, kept, sha.

    Texts are equal when identical without the characters [\\x20\\x09-\\x0D]; null counts as empty, and all empty texts
    are one group.  Of equal texts the row with the most code points stays, then the smallest doc_id (null last),
    then, for repeated rows, the first read: exactly one row of each group is ``kept``.  An empty table gives no rows.
    Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-index")
    entries = scratch.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_entries, ENTRY), "entries")
    index = entries.where("kind > 0").select("kind", "row", "doc_id", "n_cp", "key", "sha", "body", "n")
    total, n = entries.agg(F.coalesce(F.sum(F.length("body")), F.lit(0)), F.count_if(F.col("kind") == 0)).first()
    # at least two buckets for each task, however few bytes there are
    capacity = max(min(capacity, int(total) // (2 * partitions(spark)) + 1), int(total) >> (DEPTH - 1))
    depth = min(DEPTH, max(2, int(total // capacity).bit_length() + 2))
    prefix = lambda bits: F.shiftrightunsigned(F.col("key"), 64 - bits).cast("long") if bits else F.lit(0).cast("long")
    counted = entries.where("kind = 2").groupBy(prefix(depth).alias("p")).agg(F.sum(F.length("body") + 64).alias("b")).toArrow()  # at most 2**depth rows
    histogram = dict(zip(counted["p"].to_pylist(), counted["b"].to_pylist(), strict=True))
    slots = directory(histogram, depth, capacity)
    world = len(slots).bit_length() - 1
    held = dict.fromkeys((b for _, b in slots), 0)
    for p, size in histogram.items():
        held[slots[p >> (depth - world)][1]] += size
    owner = owners(held, 2 * partitions(spark))
    table = spark.createDataFrame(pa.table([pa.array([s for s, _ in slots], pa.int64()), pa.array([owner[b] for _, b in slots], pa.int64())], names=["entry", "owner"]))
    owned = index.join(F.broadcast(table), prefix(world) == F.col("entry")).drop("entry")  # at most 2**DEPTH rows of two numbers
    owned = owned.repartition(max(partitions(spark), 1 + max(owner.values())), "owner").sortWithinPartitions("key", F.desc("kind"))
    found = owned.select("key", "kind", "row", "doc_id", "n_cp", "sha", "body", "n").mapInArrow(_owners, SLOT)
    found = scratch.table(found, "index")
    scratch.keep("entries", "index")
    rows = entries.where("kind = 0").select("row", "doc_id", "sha")
    heavy, light = (found.where((F.col("group_size") > F.lit(n // HEAVY + 1)) == x) for x in (True, False))
    out = ["row", "doc_id", "keep_id", "keep_row", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "sha"]
    same = F.col("sha") == F.col("slot_sha")
    common = F.broadcast(heavy)
    return rows.join(common, same).select(*out).unionByName(rows.join(common, same, "left_anti").join(light, same).select(*out))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT doc_id, norm, length(raw) AS n, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(raw) DESC, doc_id) AS keep_id
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""
