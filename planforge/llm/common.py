"""Shared helpers of the training-data operators.

* ``Scratch``: tables written below the cluster's shared checkpoint folder.  They cut lineage, survive the loss
  of an executor and are visible to every node.
* ``chunks``: turns the Arrow batches of a task into bounded lists of whole documents.
* ``word_hashes``: vectorised tokeniser; 64-bit hashes of the ASCII-lower-cased words of UTF-8 texts.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
#: Bytes of text that one chunk holds; a longer document is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Bytes that the vectorised passes work on at a time (fits in a core's cache).
SEGMENT_BYTES = 1 << 19


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session in one process (tests) gets a temporary one; a cluster raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; executors need a folder that all of them see")
        found = "file://" + tempfile.mkdtemp(prefix="planforge-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Tables of one operator run, as Parquet in the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back; lineage ends here."""
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, *names: str) -> None:
        """Delete all tables of this run but the named ones, which a result still reads."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(conf)
        for found in fs.listStatus(root) if fs.exists(root) else ():
            if found.getPath().getName() not in names:
                fs.delete(found.getPath(), True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """Bytes of what ``df`` reads: of the files, for tables; 0 where Spark knows no size."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size if size < 1 << 60 else 0


def shards_for(df: DataFrame, each: int) -> int:
    """Shards of about ``each`` bytes of input, so that what one task holds is the same at every size; the shuffle's
    partitions at least."""
    return max(8, partitions(df.sparkSession), -(-input_bytes(df) // each))


@lru_cache(maxsize=1)
def _malloc_trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def trim() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if release := _malloc_trim():
        release(0)


def pylists(batch: pa.RecordBatch, names: list[str]) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def chunks(batches: Iterable[pa.RecordBatch], names: list[str], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[list[list]]:
    """Lists of the named columns for bounded runs of rows; the text column as bytes, null as empty."""
    held: list[list] = [[] for _ in names]
    at, size = names.index(text), 0
    for batch in batches:
        cols = pylists(batch, names)
        cols[at] = [b"" if x is None else x.encode("utf-8", "surrogatepass") for x in cols[at]]
        begin = 0
        for i, x in enumerate(cols[at]):
            size += len(x) + 16
            if size >= limit:
                for h, c in zip(held, cols, strict=True):
                    h.extend(c[begin : i + 1])
                yield held
                held, size, begin = [[] for _ in names], 0, i + 1
                trim()
        for h, c in zip(held, cols, strict=True):
            h.extend(c[begin:])
    if held[at]:
        yield held
    trim()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on a uint64 array."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _byte_values(lower: bool) -> np.ndarray:
    """A random odd 64-bit value for each byte; with ``lower``, A-Z share those of a-z."""
    v = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    if lower:
        v[65:91] = v[97:123]
    return v


CASELESS = _VALUE = _byte_values(True)
#: Values for words that are told apart by case.
AS_WRITTEN = _byte_values(False)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of P and of its inverse modulo 2**64, n of each."""
    if len(_POWERS[0]) < n:
        size = max(n, SEGMENT_BYTES + (1 << 16))
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            p = np.full(size, base, dtype=U64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def _segment(texts: list[bytes], space: np.ndarray, value: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Hashes and counts of the words, the joined texts, and each word's start and end in them.

    ``cut``: kinds of bytes; a byte of kind 1 and one of kind 2 beside it are never in one word.
    """
    buf = b"\n".join(texts) + b"\n"
    arr = np.frombuffer(buf, dtype=np.uint8)
    sp = np.empty(len(arr) + 1, dtype=bool)
    sp[0] = True
    sp[1:] = space[arr]
    begins, stops = sp[:-1], sp[1:]
    if cut is not None:
        kind = cut[arr]
        edge = np.zeros(len(arr), dtype=bool)
        edge[1:] = (kind[1:] + kind[:-1] == 3) & (kind[1:] != kind[:-1])
        begins, stops = begins | edge, stops | edge
    starts = np.flatnonzero(begins & ~sp[1:])
    ends = np.flatnonzero(~sp[:-1] & stops)
    power, inverse = _powers(len(arr))
    total = np.empty(len(arr) + 1, dtype=U64)
    total[0] = 0
    np.cumsum(value[arr] * power[: len(arr)], out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * inverse[starts])
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    return hashes, np.bincount(np.searchsorted(np.cumsum(lengths), starts, side="right"), minlength=len(texts)), buf, starts, ends


def word_hashes(texts: list[bytes], space: np.ndarray = _SPACE, value: np.ndarray = _VALUE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, number of words of each text).

    Words are the runs of bytes outside ``space``; equal words have equal hashes, and different ones collide with a
    probability of about 2**-64 a pair.
    """
    hashes, counts, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t) + 1
        if size >= SEGMENT_BYTES or i == len(texts) - 1:
            h, c, *_ = _segment(held, space, value)
            hashes.append(h)
            counts.append(c)
            held, size = [], 0
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def outside(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of separators: the bytes in the given ranges, ends included."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


def distinct_words(texts: list[bytes], space: np.ndarray = _SPACE, value: np.ndarray = _VALUE, cut: np.ndarray | None = None) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(index of every word of all texts in ``words``, ``words``: the distinct ones as first written, words of each
    text, the distinct ones' hashes in order)."""
    parts, held, size = [], [], 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t) + 1
        if size >= SEGMENT_BYTES or i == len(texts) - 1:
            parts.append(_segment(held, space, value, cut))
            held, size = [], 0
    if not parts:
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, U64)
    every = np.concatenate([p[0] for p in parts])
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(every)]
    index = np.empty(len(every), dtype=np.int64)
    index[order] = np.cumsum(new) - 1
    first = order[new]
    words: list[bytes] = [b""] * len(first)
    by, offset = np.argsort(first, kind="stable"), np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
    at = np.searchsorted(first[by], offset)
    for k, (_, _, buf, starts, ends) in enumerate(parts):
        mine = by[at[k] : at[k + 1]]
        where = first[mine] - offset[k]
        for w, s, e in zip(mine.tolist(), starts[where].tolist(), ends[where].tolist(), strict=True):
            words[w] = buf[s:e]
    return index, words, np.concatenate([p[1] for p in parts]), ranked[new]


def splits(sorted_hashes: np.ndarray, shards: int) -> np.ndarray:
    """Positions that cut sorted uint64 values into ``shards`` equal ranges of the 64-bit space."""
    step = (1 << 64) // shards
    edges = np.array([i * step for i in range(1, shards)], dtype=U64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges, side="left"), [len(sorted_hashes)]])


def merge_counts(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and the sums of their counts."""
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(c, first) if len(h) else c
