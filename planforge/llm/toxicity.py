"""Operator 7, toxicity: non-negative positive-unlabelled learning on word features.

Confirmed toxic documents (P) and unlabelled text (U) train a logistic model in numpy; the risk
``pi * E_P[l(g, +)] + max(0, E_U[l(g, -)] - pi * E_P[l(g, -)])`` corrects for the share ``pi`` of toxic documents in U,
and where the bracket turns negative its gradient is reversed, so that the model does not fit U's hidden positives
as negatives.  Its features are chosen by the words' frequencies in all training rows, counted in a distributed
aggregate; the fit of their weights sees a sample of bounded size, of which only the features' numbers reach the driver;
every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _VALUE, U64, chunks, word_hashes

#: Bounds of the fitted sample: toxic rows, unlabelled rows, word features.  With them the driver gets at most
#: 18,000 * 1,500 four-byte numbers, and in practice a few of them a row.
MAX_TOXIC, MAX_UNLABELLED, MAX_FEATURES = 6_000, 12_000, 1_500
#: Deviations by which a word's share of toxic documents must exceed its share of unlabelled ones.
SIGNIFICANT = 4.0
_BREAK = np.ones(256, dtype=bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lower = [t.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass") for t in texts]
    return word_hashes(lower, _BREAK, _VALUE)


def _features(chosen: np.ndarray):
    """(toxic, numbers of the chosen words that it holds) of each row; ``chosen``: sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for toxic, texts in chunks(batches, ["toxic", "text"]):
            hashes, counts = _words(texts)
            out = []
            for part in np.split(hashes, np.cumsum(counts)[:-1]):
                at = np.minimum(np.searchsorted(chosen, part), max(0, len(chosen) - 1))
                out.append(np.unique(at[chosen[at] == part]).astype(np.uint32).tobytes() if len(chosen) else b"")
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(out, pa.binary())], names=["toxic", "words"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word hash, toxic documents with it, documents with it) of each chunk."""
    for toxic, texts in chunks(batches, ["toxic", "text"]):
        hashes, counts = _words(texts)
        words, at = np.unique(hashes, return_inverse=True)
        pair = np.unique(at * len(texts) + np.repeat(np.arange(len(texts)), counts))
        word, bad = pair // len(texts), np.array(toxic, dtype=np.int64)[pair % len(texts)]
        cols = [words.view(np.int64), np.bincount(word, weights=bad, minlength=len(words)).astype(np.int64), np.bincount(word, minlength=len(words))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["word", "p", "u"])


def choose(rows: DataFrame, most: int) -> np.ndarray:
    """Sorted hashes of the words that toxic rows of ``rows`` (toxic, text) hold significantly more often than rows at large."""
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        return np.zeros(0, U64)
    counted = rows.mapInArrow(_frequencies, "word long, p long, u long").groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    pooled = (F.col("p") + F.col("u")) / (toxic + n)
    z = (F.col("p") / toxic - F.col("u") / n) / F.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / n) + 1e-12)
    best = counted.where("p >= 3").withColumn("z", z).where(F.col("z") >= SIGNIFICANT).orderBy(F.desc("z"), "word").limit(most)
    return np.sort(np.array([r.word for r in best.select("word").collect()], dtype=np.int64).view(U64))


@dataclass
class Model:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of toxicity of each text."""
        hashes, counts = _words(texts)
        g = np.full(len(texts), self.bias)
        if len(self.hashes) and len(hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[at] == hashes)
            doc = np.repeat(np.arange(len(texts)), counts)[hit]
            pair = np.unique(doc * len(self.hashes) + at[hit])
            g += np.bincount(pair // len(self.hashes), weights=self.weights[pair % len(self.hashes)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def risk(w: np.ndarray, b: float, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Positive part of the PU risk, its bracket, and both gradients (weights, then bias).

    The loss is the logistic one: l(g, +) = -log s(g), l(g, -) = -log(1 - s(g)).
    """
    zp, zu = p @ w + b, u @ w + b
    gp, gu = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
    positive = prior * np.logaddexp(0, -zp).mean()
    bracket = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    grad = lambda dp, du: np.append(dp @ p + (du @ u if du is not None else 0), dp.sum() + (du.sum() if du is not None else 0))
    return positive, bracket, grad(prior * (gp - 1) / len(gp), None), grad(-prior * gp / len(gp), gu / len(gu))


def nn_pu_fit(p: np.ndarray, u: np.ndarray, prior: float, rounds: int = 600, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model under the non-negative PU risk, by Adam with full batches.

    A step follows the risk's gradient; where the bracket is negative, it climbs out along the bracket's own.
    """
    w, b = np.zeros(p.shape[1], np.float64), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        _, bracket, of_positive, of_bracket = risk(w, b, p, u, prior)
        grad = of_positive + of_bracket if bracket >= 0 else -of_bracket
        grad[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _matrix(rows: list[bytes], width: int) -> np.ndarray:
    x = np.zeros((len(rows), width), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r, np.uint32)] = 1
    return x


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES) -> Model:
    """Fit on the rows whose crc32(doc_id as text) mod 3 is not 1: features by all of them, weights by at most the given numbers, in hash order.

    ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); other columns, whatever their names, are not read.  A
    doc_id with several labels is toxic if one says so; null labels say nothing; null doc_ids are never learnt from.
    Repeated rows count one by one.  Without toxic labels every score is 0; without any text that bears one, or
    without a feature, every score is the share of toxic labels.
    """
    learn = F.expr("pmod(crc32(cast(cast(doc_id as string) as binary)), 3) <> 1 and doc_id is not null")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(learn)
    marked = labels.where(learn).where("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    n, toxic = marked.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        return Model(np.zeros(0, U64), np.zeros(0), -40.0)
    prior = min(0.9, (toxic + 0.5) / (n + 1))
    toxic_ids = marked.where("toxic = 1").select("doc_id", F.lit(1).alias("toxic"))
    # one kind of join at every size: the toxic ids grow with the labels
    rows = docs.join(toxic_ids.hint("merge"), "doc_id", "left").select(F.coalesce("toxic", F.lit(0)).alias("toxic"), "text")
    best = choose(rows, max_features)
    ids = toxic_ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_toxic)
    free = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(max_unlabelled).select("doc_id", F.lit(0).alias("toxic"))
    sample = docs.join(F.broadcast(ids.unionByName(free)), "doc_id").select("toxic", "text")  # at most max_toxic + max_unlabelled ids
    found = sample.mapInArrow(_features(best), "toxic int, words binary")
    # ids may repeat, rows of the sample may not exceed its bounds
    got = {t: [r[0] for r in found.where(F.col("toxic") == t).select("words").limit(most).collect()] for t, most in ((1, max_toxic), (0, max_unlabelled))}
    if not got[1] or not got[0]:
        return Model(np.zeros(0, U64), np.zeros(0), float(np.log(prior / (1 - prior))))
    w, b = nn_pu_fit(_matrix(got[1], len(best)), _matrix(got[0], len(best)), prior)
    return Model(best, w, b)


def score(docs: DataFrame, model: Model, column: str = "toxic_score") -> DataFrame:
    """``docs`` with the probability of toxicity in ``column``, replacing one of that name; all others stay.

    Null and empty texts get the score of no evidence.  Repeated rows and null doc_ids are scored like any other; an
    empty table gives no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast((model.hashes, model.weights, model.bias))  # at most MAX_FEATURES words
    names = [c for c in docs.columns if c != column]
    out = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*out.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*table.value)
        for b in batches:
            texts = [b"" if x is None else x.encode("utf-8", "surrogatepass") for x in b.column(names.index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.score(texts), pa.float64())], names=[*names, column])

    return out.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score.  Null doc_ids count as not held out and are never learnt from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model, "score")
    held = F.coalesce(F.expr("pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
