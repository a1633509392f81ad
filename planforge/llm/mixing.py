"""Operator 8, mixing sources to target weights by pivotal dependent rounding.  DataFrame functions only.

A source's target gives each of its documents the same number of copies, a whole part and a fraction.  The fractions
are rounded in pairs: a pair moves words (copy fraction times size) from one document to the other until one fraction
is 0 or 1, in the direction drawn so that both expectations stay.  The pair's words are kept exactly, so a source ends
within one document's size of its target.  Documents meet in groups of about ``LEAF`` by a hash of their id; each
group leaves one fractional document, and these residuals meet in groups of at most ``FAN``, level by level, until one
is left for each source, which is drawn by itself.  What that draw leaves of the target is settled by turning the one
document round whose size is nearest, ``SETTLE`` times.  A source with a third of all rows just has more groups.

Sources are rows too: their order, weights and targets are computed without gathering them, and only sums, counts of
key ranges and the level of water-filling reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

WEIGHTS = (3, 1, 2)
LEAF, FAN, SETTLE = 48, 32, 2
#: Sources that one task puts in order; sources that a join may broadcast (five numbers and a name each).
RANKED, BROADCAST = 100_000, 10_000
WHITE = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Number of runs of ``[^\\x20\\x09-\\x0D]``; 0 for null."""
    return F.coalesce(F.length(F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), WHITE, "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sources`` (source, s: size, n: rows) with ``target``: by weight, ``share`` of all sizes in sum.

    Weights repeat over the sources by code point, null last.  None is above ``most`` times its source's size; what is
    over is shared by the others by weight.  The water level of that only rises, so each round is one aggregate.
    """
    first = F.col("source").asc_nulls_last()
    parts = max(1, -(-sources.count() // RANKED))
    ranged = sources.repartitionByRange(parts, first).select("*", F.spark_partition_id().alias("part"))
    ranked = scratch.table(ranged.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(first))), "ranked")
    before, at = {}, 0
    for r in ranked.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # one row for each 100,000 sources
        before[r.part], at = at, at + r.n
    offset = F.try_element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("part")) if before else F.lit(0)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((offset + F.col("place") - 1) % len(weights) + 1).cast("int"))
    weighted = scratch.table(ranked.select("source", "s", "n", weight.alias("w")), "weighted")
    level, left = 0.0, share * (weighted.agg(F.sum("s")).first()[0] or 0)
    over = lambda unit: F.lit(unit) * F.col("w") > most * F.col("s")
    while True:
        full, free = weighted.agg(F.coalesce(F.sum(F.when(over(level), F.col("s"))), F.lit(0)), F.coalesce(F.sum(F.when(~over(level), F.col("w"))), F.lit(0))).first()
        new = (left - most * full) / free if free else level
        if new <= level:
            break
        level = new
    return weighted.withColumn("target", F.when(over(level), most * F.col("s")).otherwise(F.lit(level) * F.col("w")))


def _uniform(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def _step(acc: Column, e: Column, seed: Column) -> Column:
    """One pairing: the accumulator's open document ``acc.u`` and the next one; what becomes whole joins ``acc.done``."""
    one = acc["u"]
    gain = F.least(one["size"] * (1 - one["x"]), e["size"] * e["x"])
    give = F.least(one["size"] * one["x"], e["size"] * (1 - e["x"]))
    to_one = _uniform(one["h"], e["h"], seed) * (gain + give) < give
    with_x = lambda u, x: F.struct(u["h"].alias("h"), u["doc_id"].alias("doc_id"), u["rep"].alias("rep"), u["size"].alias("size"), x.alias("x"))
    case = (
        F.when(to_one & (one["size"] * (1 - one["x"]) <= e["size"] * e["x"]), F.struct(with_x(e, e["x"] - gain / e["size"]).alias("u"), with_x(one, F.lit(1.0)).alias("d")))
        .when(to_one, F.struct(with_x(one, one["x"] + gain / one["size"]).alias("u"), with_x(e, F.lit(0.0)).alias("d")))
        .when(one["size"] * one["x"] <= e["size"] * (1 - e["x"]), F.struct(with_x(e, e["x"] + give / e["size"]).alias("u"), with_x(one, F.lit(0.0)).alias("d")))
        .otherwise(F.struct(with_x(one, one["x"] - give / one["size"]).alias("u"), with_x(e, F.lit(1.0)).alias("d")))
    )
    return F.transform(F.array(case), lambda c: F.struct(c["u"].alias("u"), F.concat(acc["done"], F.array(c["d"])).alias("done")))[0]


def _fold(units: DataFrame, seed: int) -> DataFrame:
    """(source, g, u, done): one open document of each group, and those that became whole."""
    grouped = units.groupBy("source", "g").agg(F.sort_array(F.collect_list(F.struct("h", "doc_id", "rep", "size", "x"))).alias("a"))
    none = F.expr("filter(a, e -> false)")
    folded = F.aggregate(F.slice("a", 2, F.greatest(F.size("a"), F.lit(1))), F.struct(F.col("a")[0].alias("u"), none.alias("done")), lambda acc, e: _step(acc, e, F.lit(seed)))
    return grouped.select("source", "g", folded.alias("f")).select("source", "g", "f.u", "f.done")


def _settle(done: DataFrame, scratch: Scratch, step: int, few: bool) -> DataFrame:
    """``done`` (source, h, doc_id, rep, size, part, x) after each source turned round the document that brings it nearest
    to the sum of its parts, if one does."""
    hint = F.broadcast if few else lambda d: d
    gap = scratch.table(done.groupBy("source").agg(F.sum(F.col("size") * (F.col("part") - F.col("x"))).alias("gap")).withColumnRenamed("source", "src"), f"gap{step}")
    near = F.abs(F.col("gap") - F.when(F.col("x") == 0, F.col("size")).otherwise(-F.col("size")))
    turned = done.join(hint(gap), F.col("source").eqNullSafe(F.col("src"))).where(near < F.abs("gap"))
    turned = turned.groupBy("source").agg(F.min(F.struct(near.alias("near"), "h", "doc_id", "rep", "size")).alias("m"))
    turned = scratch.table(turned.select(F.col("source").alias("src"), F.col("m.h").alias("_h"), F.col("m.doc_id").alias("_id"), F.col("m.rep").alias("_rep"), F.col("m.size").alias("_size")), f"turned{step}")
    same = (F.col("h") == F.col("_h")) & F.col("source").eqNullSafe(F.col("src")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("rep") == F.col("_rep")) & (F.col("size") == F.col("_size"))
    return done.join(hint(turned), same, "left").withColumn("x", F.when(F.col("_h").isNull(), F.col("x")).otherwise(1 - F.col("x"))).select(*done.columns)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 8) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source): source, doc_id, rep, size, source_size, target, copies.

    Sizes count words; null and empty texts have size 0 and no copies.  Null sources are one source, the last.  ``rep``
    numbers repeated rows (equal source, doc_id and size), which are rounded one by one; null doc_ids are kept as they
    are.  A document never has more than ``most`` copies, rounded up.  Reruns agree: all draws are hashes of ids.  An
    empty table gives no rows; other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), n_words(F.col("text")).alias("size"))
    rows = scratch.table(rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")), "rows")
    per = scratch.table(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s"), F.sum("n").alias("n")), "sources")
    rate = F.when(F.col("s") > 0, F.least(F.lit(most), F.col("target") / F.col("s"))).otherwise(F.lit(0.0))
    named = targets(per, scratch, weights, share, most).select(F.col("source").alias("src"), F.col("s").alias("source_size"), "target", rate.alias("rate"), F.ceil(F.col("n") / LEAF).alias("groups"))
    named = scratch.table(named, "targets")
    few, groups = (lambda r: (r[0] < BROADCAST, r[1] or 1))(named.agg(F.count("*"), F.max("groups")).first())
    whole = F.floor("rate").cast("int")
    units = (
        rows.select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("rep"))
        .join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("src")))
        .withColumn("whole", whole).withColumn("x", F.col("rate") - F.col("whole"))
        .withColumn("h", F.xxhash64("source", "doc_id", "size", "rep", F.lit(seed)))
        .withColumn("g", F.pmod("h", "groups"))
    )
    open_ = units.where("x > 0 and size > 0").select("source", "g", "h", "doc_id", "rep", "size", "x")
    done, level = [], 0
    while True:
        folded = scratch.table(_fold(open_, seed + level), f"level{level}")
        done.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        open_ = folded.select("source", F.floor(F.col("g") / FAN).alias("g"), "u.h", "u.doc_id", "u.rep", "u.size", "u.x")
        level += 1
        if groups == 1:
            break
        groups = -(-groups // FAN)
    done.append(open_.select("source", "h", "doc_id", "rep", "size", (_uniform(F.col("h"), F.lit(seed)) < F.col("x")).cast("double").alias("x")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = out.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("src")))
    out = scratch.table(out.select("source", "h", "doc_id", "rep", "size", (F.col("rate") - whole).alias("part"), "x", "source_size", "target", whole.alias("whole")), "drawn")
    for step in range(SETTLE):
        out = scratch.table(_settle(out, scratch, step, few), f"settled{step}")
    scratch.keep("rows", "targets", f"settled{SETTLE - 1}")
    out = out.withColumn("copies", F.col("whole") + F.col("x").cast("int"))
    rest = units.where("not (x > 0 and size > 0)").withColumn("copies", F.when(F.col("size") > 0, F.col("whole")).otherwise(F.lit(0)))
    cols = ["source", "doc_id", "rep", "size", "source_size", "target", "copies"]
    return out.select(cols).unionByName(rest.select(cols))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
