"""Corpus pipeline: toxicity, exact dedup, near dedup, source mixing, tokenising.

Each stage takes the documents its predecessor kept and returns the columns of documents, the last one digests of the
token ids.  ``run`` applies them in order, each stage's result written to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from planforge.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from planforge.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents at or above this probability of toxicity go.
REJECT = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.  Fitted on the stage's own documents and the labels.

    Repeated rows, null ids and texts without words are scored like any other and stay unless rejected.  Without toxic
    labels nothing is rejected; an empty table stays empty.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select(COLUMNS), model, "_toxic").where(F.col("_toxic") < REJECT).select(COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest as written, then the smallest doc_id, null last.

    Null, empty and blank texts are one group.  Of repeated rows one stays.  An empty table stays empty.
    """
    found = exact_dedup.exact_dedup(docs)
    # a kept row is named by its id and digest; of rows with both equal the longest stays
    kept = found.where("kept").select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"))
    white = r"[\x20\x09-\x0D]"
    named = docs.withColumn("_own", F.unhex(F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), white, ""), 256)))
    joined = named.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha")))
    first = Window.partitionBy("_id", "_sha").orderBy(F.desc(F.length(F.coalesce("text", F.lit("")))), "text", "source", "lang", "n_chars")
    return joined.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id, and of its texts one.

    Rows are told apart by doc_id and text, so a clean text stays although another one of its doc_id goes.  Rows
    without doc_id or without words are linked with nothing and stay.  Of repeated rows that are linked one stays.  An
    empty table stays empty.
    """
    found = near_dedup.near_dedup(docs)
    gone = found.where("not leads").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    left = docs.withColumn("_own", key).join(gone, (F.col("doc_id") == F.col("_id")) & (F.col("_own") == F.col("_key")), "left_anti")
    again = found.where("leads and n_shingles > 0 and doc_id is not null").groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1")
    # equal rows: rare, so only they are put in order
    again = Scratch(spark, "pipeline").table(again, "again")
    if again.limit(1).count():
        same = (F.col("doc_id") == F.col("_id")) & (F.col("_own") == F.col("_key"))
        order = Window.partitionBy("_id", "_key").orderBy("source", "lang", "n_chars")
        one = left.join(again, same).withColumn("_r", F.row_number().over(order)).where("_r = 1")
        left = left.join(again, same, "left_anti").select(COLUMNS).unionByName(one.select(COLUMNS))
    return left.select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the copies that the mix takes; those with none, and those without words, go.

    Null sources are one source.  Rows of equal source, doc_id and size share their copies evenly, the first by text
    taking what is left over.  An empty table stays empty.
    """
    copies = mixing.mix(docs).where("copies > 0").groupBy("source", "doc_id", "size").agg(F.sum("copies").cast("int").alias("n"))
    copies = copies.select(F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "n")
    sized = docs.withColumn("_words", mixing.n_words(F.col("text")))
    joined = sized.join(copies, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size")))
    same = Window.partitionBy("_id", "_source", "_size")
    ranked = joined.withColumn("_r", F.row_number().over(same.orderBy("text", "lang", "n_chars"))).withColumn("_k", F.count("*").over(same))
    own = F.floor(F.col("n") / F.col("_k")).cast("int") + (F.col("_r") <= F.col("n") % F.col("_k")).cast("int")
    return ranked.withColumn("_own", own).where("_own > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_own")))).select(COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every row's token ids and of the bytes they decode to; null and empty texts have no ids.

    Repeated rows and null ids are kept as they are.  An empty table stays empty.
    """
    return bpe.digests(docs, stored=True)  # a stage's documents are read from files


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Toxicity and mixing are fitted and drawn; SQL cannot express their decisions.
ORACLE_SQL = None
