"""Operator 1, language-model scoring with a log-frequency Bloom filter.

An n-gram's count c is kept as level q = 1 + floor(log_b(c)): the filter holds the pairs (n-gram, 1) .. (n-gram, q).
A lookup probes the levels upwards until one is missing and returns the level's expected count.  The filter is dealt
into shards by the n-grams' hashes.  Each shard has ``BITS`` for each level it holds, so the false rate is the same at
every size, and it stays in the task that builds it: nothing is gathered or broadcast.  Chunks of documents send their
distinct n-grams with their counts in training texts to the shards; a shard sums the counts, builds its filter and
answers each chunk with its bigrams' and trigrams' levels.  The documents, sent to their chunks' answers, are scored there.

Tokens themselves have exact counts: their shards answer with them, for the base score and as the model's unigrams, so
a chunk costs a shard one entry for each distinct token, however common the token is.

Smoothing, from single tokens up to three: P(w | h) = (c(h w) + m P(w | h')) / (c(h) + m) with h' the history without
its first token and m the length's prior mass, and P(w) = (c(w)+0.1)/(N+0.1(V+1)).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import pack, unpack
from .common import U64, Scratch, chunks, merge_counts, mix64, shards_for, splits, word_hashes

BASE = 1.5
BITS, PROBES = 10, 5
#: Prior mass of bigrams and trigrams: the likeliest on held-out documents of those tried (1 to 500, 1 to 300).
PRIOR_MASS = (200.0, 5.0)
END_TOKEN, START_TOKEN = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
#: Bytes of text in one chunk.
CHUNK = 6 << 20
#: Bytes of input for each shard.
SHARD = 8 << 20
BLOCK = "kind int, chunk long, shard int, data binary"
#: A shard's answers to chunks; and one row without chunk: its training tokens, distinct n-grams and share of set bits.
ANSWER = f"{BLOCK}, total long, held long, full double"
_FIELDS = [("kind", pa.int32()), ("chunk", pa.int64()), ("shard", pa.int32()), ("data", pa.binary()), ("total", pa.int64()), ("held", pa.int64()), ("full", pa.float64())]
#: Kinds of rows: n-grams asked or answered for, and a chunk's documents.
UNIGRAM, BIGRAM, TRIGRAM, TEXTS = 0, 1, 2, 3
KINDS = (UNIGRAM, BIGRAM, TRIGRAM)


def _table(rows: list[tuple], width: int = 4) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * width
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(cols, _FIELDS[:width], strict=True)], names=[n for n, _ in _FIELDS[:width]])


def levels(counts: np.ndarray, base: float = BASE) -> np.ndarray:
    """Quantised log-frequency: 1 + floor(log_b(c))."""
    return 1 + np.floor(np.log(counts) / np.log(base) + 1e-9).astype(np.int64)


def expected(base: float = BASE, most: int = 128) -> np.ndarray:
    """Mean count of a level by index: 0 at level 0, else of the integers in [b**(q-1), b**q)."""
    out = [0.0]
    for q in range(1, most + 1):
        low, high = int(np.ceil(base ** (q - 1) - 1e-9)), int(np.ceil(base**q - 1e-9)) - 1
        out.append((low + high) / 2 if high >= low else base ** (q - 0.5))
    return np.array(out)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words, each text's followed by the end token; tokens of each text."""
    words, counts = word_hashes(texts)
    out = np.full(len(words) + len(texts), END_TOKEN, dtype=U64)
    keep = np.ones(len(out), dtype=bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = words
    return out, counts + 1


#: Bits that tell the longer n-grams of a shard apart.  A shard holds a few million, so one lookup in some ten thousand
#: meets another's name, at every size, where one in a hundred is found falsely by the filter.
NAME_BITS = 36


def name_mask(shards: int) -> np.uint64:
    """The leading bits of a hash: those that say its shard, and ``NAME_BITS`` more."""
    drop = max(0, 64 - NAME_BITS - (shards - 1).bit_length())
    return U64((1 << 64) - (1 << drop))


def gaps(h: np.ndarray) -> np.ndarray:
    """Sorted hashes as their differences, which pack into fewer bytes."""
    return np.diff(h, prepend=U64(0)).view(np.int64)


def of_gaps(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x.view(U64), dtype=U64)


def longer(grams: np.ndarray, h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hash of each token and the n-gram that ends at the one before it, the start token before a text's first."""
    before = np.empty_like(h)
    before[1:] = grams[:-1]
    before[np.cumsum(counts) - counts] = START_TOKEN
    return mix64(before * U64(0x9E3779B97F4A7C15) + h)


def _held_out(doc_id: object) -> bool:
    import zlib

    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def splits_edges(shards: int) -> np.ndarray:
    step = (1 << 64) // shards
    return np.array([i * step for i in range(1, shards)], dtype=U64)


START_KEY = mix64(np.array([START_TOKEN], dtype=U64))[0]


def _positions(h: np.ndarray, level: int, bits: np.ndarray) -> Iterator[np.ndarray]:
    """Bit positions of (n-gram, level) in filters of ``bits`` bits, one array for each probe."""
    a = mix64(h + U64(level * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    b = mix64(a) | U64(1)
    for k in range(PROBES):
        yield (a + U64(k) * b) % bits


def build_filter(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bytes of the filter over n-grams with their counts: one-bit positions, ``BITS`` for each level held."""
    q = levels(counts)
    size = -(-max(64, BITS * int(q.sum())) // 8) * 8
    bits = np.zeros(size, dtype=bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        for at in _positions(h[q >= level], level, U64(size)):
            bits[at] = True
    return np.packbits(bits)


class Filter:
    """Shards of one order: concatenated bytes, with each shard's first byte and number of bits."""

    def __init__(self, blocks: list[bytes | None]):
        sizes = [len(b or b"") for b in blocks]
        self.data = np.frombuffer(b"".join(b or b"" for b in blocks), dtype=np.uint8)
        self.first = (np.cumsum(sizes) - sizes).astype(np.int64) * 8
        self.bits = np.array(sizes, dtype=U64) * U64(8)
        self.edges = splits_edges(len(blocks))

    def level(self, h: np.ndarray) -> np.ndarray:
        """Level of each n-gram: probes go upwards until a level is missing."""
        shard = np.searchsorted(self.edges, h, side="right")
        first, bits = self.first[shard], self.bits[shard]
        out = np.zeros(len(h), dtype=np.int64)
        live = np.flatnonzero(bits > 0)
        for level in range(1, 128):
            if not len(live):
                break
            hit = np.ones(len(live), dtype=bool)
            on = np.arange(len(live))
            a = mix64(h[live] + U64(level * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
            b = mix64(a) | U64(1)
            for k in range(PROBES):
                at = ((a[on] + U64(k) * b[on]) % bits[live[on]]).astype(np.int64) + first[live[on]]
                ok = (self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
                hit[on[~ok]] = False
                on = on[ok]
            live = live[hit]
            out[live] = level
        return out


class Model(NamedTuple):
    """The documents to learn from and the prior masses; counts and filters exist in the shards' tasks only."""

    docs: DataFrame
    mass: tuple[float, float]


def train(docs: DataFrame, mass: tuple[float, float] = PRIOR_MASS) -> Model:
    """The model of the texts whose crc32(doc_id as text) mod 10 is not 0 (null doc_ids learn too)."""
    return Model(docs, mass)


def _chunk_name(ids: list, texts: list[bytes]) -> int:
    name = xxhash.xxh64(repr(ids))
    for t in texts:
        name.update(len(t).to_bytes(8, "little"))
        name.update(t)
    return name.intdigest() - (1 << 63)


def _ask(shards: int, learns: bool, asks: bool):
    """A chunk's distinct n-grams of each shard with their training counts.  Texts' starts count as a token of their own."""

    mask = name_mask(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in chunks(batches, ["doc_id", "text"], limit=CHUNK):
            held = np.array([_held_out(i) for i in ids], dtype=bool)
            if not asks:
                ids, texts = ([x for x, out in zip(c, held.tolist(), strict=True) if not out] for c in (ids, texts))
                held = np.zeros(len(ids), dtype=bool)
                if not ids:
                    continue
            h, n = tokens(texts)
            chunk = _chunk_name(ids, texts) if asks else None
            counted = np.repeat(~held & learns, n)
            grams = h
            for kind in KINDS:
                grams = longer(grams, h, n) if kind else h
                named = grams & mask if kind else grams
                order = np.argsort(named, kind="stable")
                u = named[order]
                first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
                learnt, u = np.add.reduceat(counted[order].astype(np.uint32), first, dtype=np.uint32), u[first]
                if kind == UNIGRAM:
                    at = int(np.searchsorted(u, START_KEY))
                    u, learnt = np.insert(u, at, START_KEY), np.insert(learnt, at, (~held).sum() if learns else 0)
                cut = splits(u, shards).tolist()
                yield _table([(kind, chunk, s, pack(gaps(u[a:b]), learnt[a:b])) for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a])

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's documents, for the place where its answers meet."""
    for ids, texts in chunks(batches, ["doc_id", "text"], limit=CHUNK):
        docs = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        null = np.array([i is None for i in ids], dtype=np.uint8)
        yield _table([(TEXTS, _chunk_name(ids, texts), 0, pack(docs, null, np.array([len(t) for t in texts], dtype=np.int64), b"".join(texts)))])


def _answer(table: pa.Table) -> pa.Table:
    """For one shard of a kind: counts summed over all chunks, each asking chunk's answer, and the shard's totals.

    Tokens are answered with their counts, longer n-grams with the levels that the filter over the shard's counts gives.
    """
    kind, shard = table.column("kind")[0].as_py(), table.column("shard")[0].as_py()
    chunk, data = table.column("chunk").to_pylist(), table.column("data").to_pylist()
    parts = [unpack(d) for d in data]
    h, c = merge_counts([of_gaps(p[0]) for p in parts], [p[1].astype(np.int64) for p in parts])
    del parts
    seen = c > 0
    full, value = 0.0, c
    if kind != UNIGRAM:
        block = build_filter(h[seen], c[seen])
        full, value = float(np.unpackbits(block).mean()), Filter([block.tobytes()]).level(h).astype(np.uint8)
    else:
        seen &= h != START_KEY
    out = [(kind, None, shard, None, int(c[seen].sum()), int(seen.sum()), full)]
    for k, d in zip(chunk, data, strict=True):
        if k is not None:
            out.append((kind, k, shard, pack(value[np.searchsorted(h, of_gaps(unpack(d)[0]))]), None, None, None))
    return pa.Table.from_batches([_table(out, 7)])


def log10(h: np.ndarray, counts: np.ndarray, uni: np.ndarray, levels_of: list[np.ndarray], total: int, distinct: int, rates: list[float], mass: tuple[float, float], mask: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: log10 probability of its tokens, sum of log10(c + 0.1), known tokens.

    ``uni``: counts of the sorted distinct words with the start; ``levels_of``: levels of the sorted distinct bigrams and
    trigrams; ``rates``: false rates of their filters.  An n-gram counts no more often than the shorter ones in it.
    """
    table, begin = expected(), np.cumsum(counts) - counts
    _, index = np.unique(np.concatenate([h, [START_KEY]]), return_inverse=True)
    c, start = uni[index[:-1]].astype(np.float64), float(uni[index[-1]])
    p, grams, ends = (c + 0.1) / (total + 0.1 * (distinct + 1)), h, c
    for level, rate, m in zip(levels_of, rates, mass, strict=True):
        history = np.empty(len(h))
        history[1:] = ends[:-1]
        history[begin] = start
        grams = longer(grams, h, counts)
        _, at = np.unique(grams & mask, return_inverse=True)
        ends, true = np.minimum(table[level][at], np.minimum(ends, history)), 1 - rate
        p = (true * ends + m * p) / (true * history + m)
    return np.add.reduceat(np.log10(p), begin), np.add.reduceat(np.log10(c + 0.1), begin), np.add.reduceat(c > 0, begin, dtype=np.int64)


def _finish(total: int, distinct: int, rates: list[float], mass: tuple[float, float], mask: np.uint64):
    def run(table: pa.Table) -> pa.Table:
        """Chunks of equal ids and texts have one name; each takes the answers of the first."""
        rows = list(zip(*(table.column(c).to_pylist() for c in ("kind", "shard", "data")), strict=True))
        answers = {(kind, shard): data for kind, shard, data in rows if kind != TEXTS}
        own = [data for kind, _, data in rows if kind == TEXTS]
        uni, *more = (np.concatenate([unpack(answers[k])[0] for k in sorted(answers) if k[0] == kind]) for kind in KINDS)
        norm = np.log10(total + 0.1 * (distinct + 1))
        out = []
        for docs, null, lengths, texts in map(unpack, own):
            ends = np.cumsum(lengths)
            h, n = tokens([texts[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)])
            scores, base, known = log10(h, n, uni, more, total, distinct, rates, mass, mask)
            ids = [None if x else i for i, x in zip(docs.tolist(), null.tolist(), strict=True)]
            cols = [pa.array(ids, pa.int64()), pa.array([_held_out(i) for i in ids], pa.bool_()), pa.array(n), pa.array(known), pa.array(np.full(len(n), total, np.int64)), pa.array(base - n * norm), pa.array(scores)]
            out.append(pa.table(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)

    return run


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def score(docs: DataFrame, model: Model, stored: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text) with its exact unigram score and the model's score.

    Null and empty texts hold just the end token.  Null doc_ids and repeated rows are scored like any other and are
    never held out unless their doc_id says so.  An empty table gives no rows; other columns, whatever their names, are
    not read.  Without training texts every token has the same probability.  The documents are read twice, for their
    n-grams and for scoring; they are written to the shared folder first unless ``stored`` says that they come from
    files as they are.  Where the model learns from ``docs`` itself, counts and questions are one message; other
    training texts are read beside.
    """
    spark = docs.sparkSession
    own = docs.sameSemantics(model.docs)
    docs, scratch = _columns(docs), Scratch(spark, "lm")
    if not stored:
        docs = scratch.table(docs, "docs")
    shards = max(shards_for(docs, SHARD), 8 if own else shards_for(model.docs, SHARD))
    asked = docs.mapInArrow(_ask(shards, own, True), BLOCK)
    if not own:
        asked = asked.unionByName(_columns(model.docs).mapInArrow(_ask(shards, True, False), BLOCK))
    # dealt to as many tasks as there are shards of all kinds: a task's bytes stay the same at every size
    answers = scratch.table(asked.repartition(len(KINDS) * shards, "kind", "shard").groupBy("kind", "shard").applyInArrow(_answer, ANSWER), "answers")
    sums = {r.kind: r for r in answers.where("chunk is null").groupBy("kind").agg(F.sum("total").alias("total"), F.sum("held").alias("held"), F.avg(F.when(F.col("held") > 0, F.pow("full", F.lit(PROBES)))).alias("rate")).collect()}
    total, distinct = (sums[UNIGRAM].total, sums[UNIGRAM].held) if sums else (0, 0)
    rates = [(sums[k].rate or 0.0) if sums else 0.0 for k in (BIGRAM, TRIGRAM)]
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    met = docs.mapInArrow(_texts, BLOCK).unionByName(answers.where("chunk is not null").select("kind", "chunk", "shard", "data"))
    return met.groupBy("chunk").applyInArrow(_finish(total, distinct, rates, model.mass, name_mask(shards)), out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _columns(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return score(docs, train(docs), stored=True)
