"""Operator 10, token-id output: best-fit-decreasing packing of documents into rows of a fixed number of ids.

Documents longer than a row are cut, without loss, into full rows, which need no packing, and a rest.  Rests and short
documents are dealt by hash into groups of about ``GROUP_TOKENS`` tokens; a group is packed longest first, each piece
into the fullest row that still holds it.  A segment tree over the free capacities, whose leaves count the open rows
of each capacity, finds that row in log2(length) steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import CHUNK, encode_here, runs, vocabulary
from .common import Scratch

LENGTH, PAD = 2048, 50256
#: Mean tokens of a packing group; a group is packed by one task.
GROUP_TOKENS = 1 << 21
PIECE = "doc_id long, piece int, start long, ids binary"
PACKED = "pack_group long, pack long, doc_ids array<long>, pieces array<int>, starts array<long>, cu_seqlens array<int>, resets array<int>, n_tokens int, ids binary"
_TYPES = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.binary()]
_NAMES = [x.split()[0] for x in PACKED.split(", ")]


class Capacities:
    """Segment tree over capacities 0..size: how many open rows have each; finds the least one that fits."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def least_fit(self, need: int) -> int:
        """The least capacity of at least ``need`` that an open row has, or -1."""
        i = need + self.leaves
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i + (not self.count[2 * i])
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of piece numbers; ties in length keep the given order, of rows equally full the latest is used."""
    tree, rows, open_rows = Capacities(size), [], [[] for _ in range(size + 1)]
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        free = tree.least_fit(lengths[i])
        if free < 0:
            free = size
            rows.append([])
            row = len(rows) - 1
        else:
            row = open_rows[free].pop()
            tree.add(free, -1)
        rows[row].append(i)
        free -= lengths[i]
        if free:
            open_rows[free].append(row)
            tree.add(free, 1)
    return rows


def _out(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)


def _row(group: int, pack: int, pieces: list[tuple], size: int, pad: int, dtype: type) -> tuple:
    """pieces: (doc_id, piece, start, ids)."""
    ids = np.full(size, pad, dtype=dtype)
    edges = [0]
    for p in pieces:
        ids[edges[-1] : edges[-1] + len(p[3])] = p[3]
        edges.append(edges[-1] + len(p[3]))
    return (group, pack, [p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces], edges, edges[:-1], edges[-1], ids.tobytes())


def pack(encoded: DataFrame, size: int = LENGTH, pad: int = PAD, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Packed rows of ``encoded`` (doc_id, n_tokens, ids): one row for each matrix row of ``size`` ids.

    pack_group and pack name the row; doc_ids, pieces and starts say what it holds (piece k of a document begins at
    token ``starts``); cu_seqlens are the cumulative lengths of its pieces from 0; resets are the places where
    positions begin anew; n_tokens counts ids before the padding; ids are little-endian uint16, or uint32 where ``pad``
    needs it; an id that doesn't fit raises.  Documents without ids (null or empty) are in no row; every other id of every row of the input,
    repeated rows too, is in exactly one.  Null doc_ids stay null in doc_ids.
    """
    cut = _cutter(size, pad)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from cut(b.column(0).to_pylist(), [np.frombuffer(x or b"", np.uint32) for x in b.column(1).to_pylist()])

    return _packed(encoded.select("doc_id", "ids").mapInArrow(run, PACKED), size, pad, group_tokens)


def pack_texts(docs: DataFrame, path: str | None = None, size: int = LENGTH, pad: int = PAD, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``pack`` of the ids of ``docs`` (doc_id, text), which each task encodes for itself and cuts in the same pass."""
    path, cut = path or vocabulary(), _cutter(size, pad)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for ids, texts in runs(batches, CHUNK):
            yield from cut(ids, encode_here(texts, path, known))

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _packed(docs.mapInArrow(run, PACKED), size, pad, group_tokens)


def _dtype(pad: int) -> type:
    return np.uint16 if pad < 1 << 16 else np.uint32


def _cutter(size: int, pad: int):
    """Documents to full rows, which are done (group -1 - task), and rests, rows of one piece without padding (group 0,
    ``pack`` their place)."""
    dtype, at, place = _dtype(pad), 0, 0

    def cut(doc_ids: list, encoded: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        nonlocal at, place
        own, rows = -1 - TaskContext.get().partitionId(), []
        for doc_id, ids in zip(doc_ids, encoded, strict=True):
            if len(ids) and int(ids.max()) > np.iinfo(dtype).max:
                raise OverflowError(f"an id of {int(ids.max())} doesn't fit {np.dtype(dtype).name}; a pad of 65,536 or more takes uint32")
            ids, place = ids.astype(dtype), place + 1
            full = len(ids) // size
            for k in range(full):
                rows.append(_row(own, at, [(doc_id, k, k * size, ids[k * size : (k + 1) * size])], size, pad, dtype))
                at += 1
                if len(rows) == 1000:
                    yield _out(rows)
                    rows = []
            if len(ids) % size:
                rest = ids[full * size :]
                rows.append((0, (TaskContext.get().partitionId() << 40) + place, [doc_id], [full], [full * size], [0, len(rest)], [0], len(rest), rest.tobytes()))
        if rows:
            yield _out(rows)

    return cut


def _packed(parts: DataFrame, size: int, pad: int, group_tokens: int) -> DataFrame:
    """Full rows as they are, and the rests packed group by group; the parts are written once, as both read them."""
    dtype = _dtype(pad)
    parts = Scratch(parts.sparkSession, "packing").table(parts, "parts")
    total = parts.where("pack_group = 0").agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_tokens))

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("first", "ascending"), ("n_tokens", "ascending")])
        docs, pieces, starts = (table.column(c).to_pylist() for c in ("doc_ids", "pieces", "starts"))
        ids = [np.frombuffer(x, dtype) for x in table.column("ids").to_pylist()]
        rows = best_fit_decreasing([len(x) for x in ids], size)
        group = key[0].as_py()
        return pa.Table.from_batches([_out([_row(group, n, [(docs[i][0], pieces[i][0], starts[i][0], ids[i]) for i in row], size, pad, dtype) for n, row in enumerate(rows)])])

    salt = F.xxhash64(F.col("doc_ids")[0], "pack")  # by id and place, so that equal rows spread like others
    rest = parts.where("pack_group = 0").withColumn("first", F.col("doc_ids")[0]).withColumn("pack_group", F.pmod(salt, F.lit(groups)))
    return parts.where("pack_group < 0").unionByName(rest.groupBy("pack_group").applyInArrow(fill, PACKED))


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet, one fixed-width id row each, beside their cumulative lengths and resets."""
    packed.write.mode("overwrite").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
