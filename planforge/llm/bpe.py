"""Operator 4, byte-level BPE encoding and decoding by a global distinct-word shuffle.

A task splits its chunk of documents into pre-tokens and keeps each document's positions as numbers of the chunk's
distinct words.  The words go, dealt by hash, to owners that encode each distinct word once; the ids come back to the
chunk that asked and meet its documents there, which are put together by position.  Nothing is broadcast and nothing
grows with a word's frequency: a word costs one row share for each chunk that holds it.  Decoding joins the ids, with
their positions, to the token-byte table: the table is dense by id, so the join in each worker is one take.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Scratch, shards_for, trim
from .pretokens import split

#: Bytes of text in a chunk: what one task holds at once.
CHUNK = 5 << 20
#: Bytes of input for each shard of words.
SHARD = 16 << 20
ROWS = "kind int, chunk long, shard int, data binary"
ENCODED = "doc_id long, n_tokens long, ids binary"
#: Words that a worker keeps encoded between chunks when it encodes without a shuffle.
KNOWN = 150_000
_FIELDS = [("kind", pa.int32()), ("chunk", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())]


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table by id: each token's first byte and length, and all bytes."""
    table = [b""] * (max(ranks(path).values()) + 1)
    for k, v in ranks(path).items():
        table[v] = k
    size = np.fromiter(map(len, table), np.int64, len(table))
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(table), np.uint8)


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays in one compressed block; integers by byte planes, which compress better."""
    out = []
    for a in arrays:
        if isinstance(a, bytes):
            raw, kind = a, 0
        else:
            kind = a.dtype.itemsize
            raw = np.ascontiguousarray(a).view(np.uint8).reshape(-1, kind).T.tobytes()
        out += [kind.to_bytes(1, "little"), len(raw).to_bytes(8, "little"), raw]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(block: bytes) -> list:
    raw, at, out = zstandard.ZstdDecompressor().decompress(block), 0, []
    types = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}
    while at < len(raw):
        kind, size = raw[at], int.from_bytes(raw[at + 1 : at + 9], "little")
        at += 9
        data = raw[at : at + size]
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind, -1).T).view(types[kind]).reshape(-1) if kind else data)
        at += size
    return out


def runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids.append(i)
            texts.append(t or "")
            size += len(texts[-1]) + 16
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
                trim()
    if ids:
        yield ids, texts
    trim()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(cols, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])


def _ask(shards: int, words_only: bool):
    """Chunks as rows: kind 0, the chunk's distinct words of a shard; or kind 1, its documents as numbers of words.

    Words are numbered by falling frequency, which compresses best; a shard is asked in that order, so the numbers'
    shards are all that is needed to place the answers.  A chunk's name is a hash of its ids and texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in runs(batches, CHUNK):
            index, words, counts, hashes = split(texts)
            name = xxhash.xxh64(repr(ids))
            name.update(hashes.tobytes())
            name.update(counts.tobytes())
            chunk = name.intdigest() - (1 << 63)
            order = np.argsort(-np.bincount(index, minlength=len(words)), kind="stable")
            shard = ((hashes >> U64(33)) % U64(shards)).astype(np.uint32)[order]
            if words_only:
                raw = [words[i].encode("utf-8", "surrogatepass") for i in order.tolist()]
                by, cut = np.argsort(shard, kind="stable").tolist(), np.searchsorted(np.sort(shard), np.arange(shards + 1)).tolist()
                asked = ((s, [raw[i] for i in by[cut[s] : cut[s + 1]]]) for s in range(shards) if cut[s] < cut[s + 1])
                yield _rows([(0, chunk, s, pack(np.fromiter(map(len, mine), np.uint32, len(mine)), b"".join(mine))) for s, mine in asked])
            else:
                number = np.empty(len(words), dtype=np.uint32)
                number[order] = np.arange(len(words), dtype=np.uint32)
                null = np.array([i is None for i in ids], dtype=np.uint8)
                docs = np.array([0 if i is None else i for i in ids], dtype=np.int64)
                yield _rows([(1, chunk, 0, pack(docs, null, counts.astype(np.uint32), shard, number[index] if len(index) else np.zeros(0, np.uint32)))])

    return run


def _answer(path: str):
    """For the words that chunks ask of a shard: each distinct word is encoded once, each chunk gets its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list[tuple[int, bytes]]] = {}
        for b in batches:
            for chunk, shard, data in zip(*(b.column(c).to_pylist() for c in ("chunk", "shard", "data")), strict=True):
                asked.setdefault(shard, []).append((chunk, data))
        enc = encoder(path) if asked else None
        for shard in list(asked):
            known: dict[bytes, list[int]] = {}
            for chunk, data in asked.pop(shard):
                lengths, raw = unpack(data)
                ends = np.cumsum(lengths, dtype=np.int64)
                words = [raw[s:e] for s, e in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                new = [w for w in words if w not in known]
                known.update(zip(new, map(enc.encode_ordinary, [w.decode("utf-8", "surrogatepass") for w in new]), strict=True))
                ids = list(map(known.__getitem__, words))
                yield _rows([(2, chunk, shard, pack(np.fromiter(map(len, ids), np.uint32, len(ids)), np.fromiter(chain.from_iterable(ids), np.uint32)))])

    return run


def _finished(then: Callable[[pa.Table], pa.Table] | None) -> Callable[[pa.Table], pa.Table]:
    return _assemble if then is None else lambda table: then(_assemble(table))


def _assemble(table: pa.Table) -> pa.Table:
    """A chunk's documents and its words' ids, by shard: the documents' ids in the order of their positions.

    Chunks of equal ids and texts have one name; each is put together with the answers of the first.
    """
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "shard", "data")), strict=True), key=lambda r: r[:2])
    answers = [unpack(data) for data in {shard: data for kind, shard, data in rows if kind == 2}.values()]
    n_ids = np.concatenate([a[0] for a in answers]).astype(np.int64) if answers else np.zeros(0, np.int64)
    ids = np.concatenate([a[1] for a in answers]) if answers else np.zeros(0, np.uint32)
    doc_ids, out = [], []
    for docs, null, counts, shard, number in (unpack(data) for kind, _, data in rows if kind == 1):
        if len(shard) != len(n_ids):
            raise ValueError("the documents changed between two reads")
        place = np.argsort(shard, kind="stable")  # the answers' words by shard, in the order of their numbers
        first, size = np.empty(len(n_ids), dtype=np.int64), np.empty(len(n_ids), dtype=np.int64)
        first[place], size[place] = np.cumsum(n_ids) - n_ids, n_ids
        ends = np.cumsum(counts, dtype=np.int64)
        for b, e in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            w = number[b:e]
            k = size[w]
            at = np.repeat(first[w] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
            out.append(ids[at].tobytes())
        doc_ids += [None if x else i for i, x in zip(docs.tolist(), null.tolist(), strict=True)]
    return pa.table([pa.array(doc_ids, pa.int64()), pa.array([len(x) // 4 for x in out], pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "n_tokens", "ids"])


def encode(docs: DataFrame, path: str | None = None, stored: bool = False, then: Callable[[pa.Table], pa.Table] | None = None, schema: str = ENCODED) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_tokens, ids (little-endian uint32).

    Ids are those of the rank file at ``path``, each match of the public pattern encoded by itself, no special tokens.
    Null and empty texts have no ids.  Repeated rows and null doc_ids are kept as they are; an empty table gives no
    rows; other columns, whatever their names, are not read.  The documents are read twice, once for their words and once for their positions;
    they are written to the shared folder first unless ``stored`` says that they come from files as they are.
    ``then`` turns each chunk's table into one of ``schema`` in the same worker.
    """
    spark = docs.sparkSession
    path = path or vocabulary()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not stored:
        docs = Scratch(spark, "bpe").table(docs, "docs")
    shards = shards_for(docs, SHARD)
    answers = docs.mapInArrow(_ask(shards, True), ROWS).repartition(shards, "shard").mapInArrow(_answer(path), ROWS)
    return docs.mapInArrow(_ask(shards, False), ROWS).unionByName(answers).groupBy("chunk").applyInArrow(_finished(then), schema)


def encode_here(texts: list[str], path: str, known: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Ids of each text, without a shuffle: every distinct word of the texts once, ``known`` keeps words between calls."""
    index, words, counts, _ = split(texts)
    enc = encoder(path)
    if len(known) > KNOWN:
        known.clear()
    for w in words:
        if w not in known:
            known[w] = np.array(enc.encode_ordinary(w), dtype=np.uint32)
    parts = [known[w] for w in words]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    first, k = (np.cumsum(size) - size)[index], size[index]
    flat = ids[np.repeat(first - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))] if len(index) else ids
    ends = np.cumsum(np.add.reduceat(np.append(k, 0), np.minimum(np.cumsum(counts) - counts, len(k))) * (counts > 0))
    return np.split(flat, ends[:-1]) if len(texts) else []


#: Ids that are decoded at a time.
_IDS = 1 << 20


def decoded(ids: bytes, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    """The bytes of ids, joined in order to the token-byte table; an id that it lacks raises."""
    first, size, raw = table
    out, every = [], np.frombuffer(ids, np.uint32)
    for at in range(0, len(every), _IDS):
        part = every[at : at + _IDS]
        n = size[part]
        place = np.repeat(first[part] - (np.cumsum(n) - n), n)
        place += np.arange(len(place))
        out.append(raw[place].tobytes())
    return b"".join(out)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids by the token-byte table; null for null."""
    path = path or vocabulary()
    names = [c for c in encoded.columns if c != "decoded"]
    encoded = encoded.select(*[F.col(f"`{c}`") for c in names])
    schema = encoded.select("*", F.lit(None).cast("binary").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for b in batches:
            out = [None if x is None else decoded(x, table) for x in b.column(names.index("ids")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    return encoded.mapInArrow(run, schema)


@lru_cache(maxsize=1)
def _decimals(n: int) -> list[bytes]:
    return [b"%d" % i for i in range(n)]


def _digest(path: str) -> Callable[[pa.Table], pa.Table]:
    def run(encoded: pa.Table) -> pa.Table:
        table = token_bytes(path)
        text, hashed, back = _decimals(len(table[0])), [], []
        for x in encoded.column("ids"):
            ids = x.as_py()
            hashed.append(hashlib.sha256(b" ".join(map(text.__getitem__, np.frombuffer(ids, np.uint32).tolist()))).hexdigest())
            back.append(hashlib.sha256(decoded(ids, table)).hexdigest())
        trim()
        return pa.table([encoded.column("doc_id"), encoded.column("n_tokens"), pa.array(hashed, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def digests(docs: DataFrame, path: str | None = None, stored: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids, as decimals joined by a space, and of the decoded bytes."""
    path = path or vocabulary()
    return encode(docs, path, stored, _digest(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), stored=True)
