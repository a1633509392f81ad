"""Operator 11, shortest-pack-first histogram packing.

Documents become ids, each followed by an end id; those longer than a sequence are cut into full pieces and a rest.
Packing works on the histogram of the pieces' lengths alone, which has as many entries as a sequence has ids: lengths
are placed longest first, all pieces of a length together, into the packs with the most space left; packs of equal
content are one pattern with a count, and a pattern is split where a length runs out.  Each step uses up a length or a
pattern, so patterns stay a small multiple of the lengths.  The result is that of placing piece by piece.

The plan says which ranks of a length go to which sequences.  Pieces are ranked within their length over the whole
table without meeting in one task: by hash into buckets, ranks within a bucket after those of the buckets before it.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import AS_WRITTEN, CASELESS, Scratch, chunks, distinct_words, partitions

LENGTH, END, PAD = 2048, 1, 0
#: Words that a worker process keeps encoded between chunks and tasks; beyond it, those of the last chunk.
KNOWN = 300_000
#: Bytes beside which the tokenizer always cuts: ASCII letters (1) and marks (2).  An apostrophe may go with letters behind it,
#: and special tokens are written with angles and bars.
CUT = np.zeros(256, dtype=np.uint8)
CUT[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
CUT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in "'<|>"]] = 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SEQUENCES = "sequence_id long, n_tokens int, padded_length int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, ids binary"


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_KNOWN: dict[str, dict[bytes, bytes]] = {}


def encode(texts: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(all texts' ids in order, ids of each text), without special tokens at their ends.

    The tokenizer drops white space, lower-cases, and cuts between an ASCII letter and a mark; nothing that it does reaches
    over these places.  So texts are put together from the ids of the words between them, and each distinct one, without
    regard to case, is encoded once and kept between calls.  Only special tokens are found by case, so it counts where one may be.
    """
    value = AS_WRITTEN if any(b"<|" in t for t in texts) else CASELESS
    index, words, counts, _ = distinct_words(texts, value=value, cut=CUT)
    if value is CASELESS:
        words = [w.lower() for w in words]
    known = _KNOWN.setdefault(path, {})
    new = [w for w in words if w not in known]
    found = [e.ids for e in _tokenizer(path).encode_batch_fast([w.decode() for w in new], add_special_tokens=False)]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) * 4
    raw = np.fromiter(chain.from_iterable(found), np.uint32).tobytes()
    known.update(zip(new, [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], strict=True) if new else ())
    parts = [known[w] for w in words]
    if len(known) > KNOWN:
        _KNOWN[path] = dict(zip(words, parts, strict=True))
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    first, k = (np.cumsum(size) - size)[index], size[index]
    ids = np.frombuffer(b"".join(parts), np.uint32)[np.repeat(first - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
    ends = np.concatenate([[0], np.cumsum(k)])[np.cumsum(counts)]
    return ids, np.diff(ends, prepend=0)


class Plan(NamedTuple):
    """Where pieces go: those of a length with ranks from ``rank`` on go to the sequences from ``sequence`` on,
    ``times`` to each, from ``offset`` on.  Sorted by (length, rank); lengths' first entries are in ``of``."""

    of: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray
    n_sequences: int


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(count, ((length, times), ...)) of every pack, by shortest pack first; a pattern's lengths fall."""
    by_space: list[list[tuple[int, tuple]]] = [[] for _ in range(size + 1)]
    most = 0  # no open pack has more space

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        while left:
            while most and not by_space[most]:
                most -= 1
            if most < length:  # new packs: the emptiest is the one just opened until it is full
                full, rest = divmod(left, size // length)
                for count, times in ((full, size // length), (min(rest, 1), rest)):
                    if count:
                        by_space[size - times * length].append((count, ((length, times),)))
                        most = max(most, size - times * length)
                break
            space = most
            count, pattern = by_space[space].pop()
            if count > left:
                by_space[space].append((count - left, pattern))
                count = left
            times = pattern[-1][1] if pattern and pattern[-1][0] == length else 0
            by_space[space - length].append((count, (*(pattern[:-1] if times else pattern), (length, times + 1))))
            left -= count
    return [x for packs in by_space for x in packs]


def plan(histogram: dict[int, int], size: int) -> Plan:
    slots, sequence = [], 0
    used = dict.fromkeys(histogram, 0)
    for count, pattern in patterns(histogram, size):
        offset = 0
        for length, times in pattern:
            slots.append((length, used[length], sequence, times, offset))
            used[length] += count * times
            offset += length * times
        sequence += count
    slots.sort()
    columns = np.array(slots, dtype=np.int64).reshape(-1, 5).T
    return Plan(np.searchsorted(columns[0], np.arange(size + 2)), *columns[1:], sequence)


def place(p: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank."""
    if not len(length):
        return rank, rank
    # ranks start from 0 in each length, so one search over (length, rank) finds a piece's slot
    most = int(p.rank.max()) + int(rank.max()) + 1
    at = np.searchsorted(np.repeat(np.arange(len(p.of) - 1), np.diff(p.of)) * most + p.rank, length * most + rank, side="right") - 1
    k = rank - p.rank[at]
    return p.sequence[at] + k // p.times[at], p.offset[at] + k % p.times[at] * length


def pieces(docs: DataFrame, path: str, size: int, end: int, with_ids: bool) -> DataFrame:
    """Full pieces and rests of every document's ids with the end id behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in chunks(batches, ["doc_id", "text"]):
            flat, counts = encode(texts, path)
            every = np.full(len(flat) + len(texts), end, dtype="<u4")
            ends = np.cumsum(counts + 1)
            keep = np.ones(len(every), dtype=bool)
            keep[ends - 1] = False
            every[keep] = flat
            n = counts + 1
            cut = -(-n // size)
            doc = np.repeat(np.arange(len(n)), cut)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(cut) - cut, cut)) * size
            length = np.minimum(size, n[doc] - start)
            at = (ends - n)[doc] + start
            raw = [every[a:b].tobytes() for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            columns = [pa.array(doc_ids, pa.int64()).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array(n[doc])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(raw, pa.binary())] if with_ids else [])], names=names + ["ids"] * with_ids)

    return docs.mapInArrow(run, PIECES + ", ids binary" * with_ids)


def pack(docs: DataFrame, path: str | None = None, size: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """Each piece of ``docs`` (doc_id, text) with its place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, unless ``with_ids`` is off, ids (little-endian uint32).

    Ids are those of the tokenizer file at ``path`` without special tokens, then ``end``.  Null and empty texts are that
    one id.  Repeated rows and null doc_ids are packed like any other; an empty table gives no rows; other columns,
    whatever their names, are not read.  Sequence ids count from 0.  The same rows are packed alike however they are
    stored.
    """
    path, spark = path or vocabulary(), docs.sparkSession
    scratch, buckets = Scratch(spark, "histogram"), partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = scratch.table(pieces(docs, path, size, end, with_ids), "pieces").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = scratch.table(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = cut.withColumn("row", F.row_number().over(own)).join(first, ["length", "bucket"])
    columns = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids
    ranked = ranked.select(*columns, (F.col("before") + F.col("row") - 1).alias("rank"))
    made = plan(histogram, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = place(made, b.column(2).to_numpy(), b.column(len(columns)).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset), *b.columns[5 : len(columns)]], names=columns[:5] + ["sequence_id", "offset"] + columns[5:])

    return ranked.mapInArrow(run, PACKED + ", ids binary" * with_ids)


def sequences(packed: DataFrame, size: int = LENGTH, pad: int = PAD) -> DataFrame:
    """One row for each sequence of ``pack``'s result with ids: its ids, padded to ``size`` unless their number is a power of
    two, its documents and their pieces' starts, and cumulative lengths from 0, where positions begin anew."""

    def row(held: list[tuple]) -> tuple:
        edges = np.cumsum([0, *(x[3] for x in held)])
        n = int(edges[-1])
        width = n if n & (n - 1) == 0 else size
        ids = np.full(width, pad, dtype="<u4")
        ids[:n] = np.frombuffer(b"".join(x[5] for x in held), "<u4")
        return held[0][0], n, width, [x[2] for x in held], [x[4] for x in held], edges.tolist(), ids.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        names, held = [x.split()[0] for x in SEQUENCES.split(", ")], []
        for b in batches:
            rows = []
            for x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and held[0][0] != x[0]:
                    rows.append(row(held))
                    held = []
                held.append(x)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row(held), types, strict=True)], names=names)

    dealt = packed.select("sequence_id", "offset", "doc_id", "length", "start", "ids").repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return dealt.mapInArrow(run, SEQUENCES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), with_ids=False)
