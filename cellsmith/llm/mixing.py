"""Mixing sources to target weights by capped water-filling.

The budget is ``share`` times all words. Every source's target is its weight
times a common level, clamped at ``max_epochs`` times its words; what the clamp
frees is shared out again by weight until no source is above its clamp. A
source is then repeated whole ``floor(target / size)`` times, and the rest is
drawn by a seeded hash of the document id: the documents with the smallest
hashes, up to the cutoff whose words come nearest to the rest.

Defined cases: a null or empty text has size 0; the null source is a source,
the last in order; rows with the same id in a source share a hash and are drawn
together; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsmith.llm.common import WORD, cut

_BUCKETS_BITS = 12


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def draw(id_col: Column, seed: int) -> Column:
    """A document's place in the seeded order of its source, 0 to 2**32 - 1: the front of the MD5 of seed and id."""
    text = F.concat_ws(":", F.lit(seed).cast("string"), id_col.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def water_level(sources: DataFrame, budget: float, max_epochs: float) -> float:
    """The level at which ``sum(least(weight * level, clamp)) = budget``.

    ``sources`` (source, size, weight) stays distributed; each round brings
    three sums to the driver: a round fixes the clamped sources and shares the
    rest by weight, and the level only rises, so it ends when no source is
    clamped anew.
    """
    clamp = F.col("size") * max_epochs
    level, clamped = 0.0, -1
    while True:
        over = F.col("weight") * level >= clamp
        r = sources.agg(F.sum(F.when(over, 1).otherwise(0)).alias("n"),
                        F.sum(F.when(over, clamp).otherwise(0.0)).alias("fixed"),
                        F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("w")).first()
        if r["n"] is None or r["n"] == clamped or not r["w"]:
            return level
        clamped = r["n"]
        level = max(level, (budget - r["fixed"]) / r["w"])


def mixing_plan(docs: DataFrame, *, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                max_epochs: float = 2.0, seed: int = 17, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents' sizes, plan). Sizes: id, source, size, u. Plan, a row a source:
    source, source_size, target, whole (repetitions of all), cutoff (u up to it: one more)."""
    sizes = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                            word_count(F.col(text_col)).alias("size"),
                            draw(F.col(id_col), seed).alias("u")), "sizes")
    per = sizes.groupBy("source").agg(F.sum("size").alias("size"))
    # one row a source; the rank is over sources, not documents
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    sources = cut(per.select("source", "size", weight.alias("weight")), "sources")
    total = sources.agg(F.sum("size")).first()[0] or 0
    level = water_level(sources, share * total, max_epochs)
    target = F.least(F.col("weight") * F.lit(level), F.col("size") * F.lit(float(max_epochs)))
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    sources = sources.withColumn("target", target).withColumn("whole", whole.cast("long")) \
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("size"))

    # words per (source, bucket of the draw): a hot source is summed before the shuffle
    b = F.shiftright("u", 32 - _BUCKETS_BITS)
    hist = sizes.groupBy("source", b.alias("b")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("b"))
    hist = hist.select(F.col("source").alias("s"), "b", "words", upto.alias("upto"))
    same = hist["s"].eqNullSafe(sources["source"])
    edge = hist.join(sources.select("source", "rest"), same) \
        .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest"))) \
        .groupBy("s").agg(F.min("b").alias("b"), F.min("rest").alias("rest"),
                          F.min_by(F.col("upto") - F.col("words"), "b").alias("below"))
    # the documents of the one bucket in which the rest ends, in the order of the draw
    e = edge.select(F.col("s").alias("es"), F.col("b").alias("eb"), "rest", "below")
    near = sizes.join(e, sizes["source"].eqNullSafe(e["es"]) & (b == F.col("eb")))
    so_far = F.col("below") + F.sum("size").over(Window.partitionBy("source").orderBy("u"))
    steps = near.select("source", "u", "rest", "eb", F.abs(so_far - F.col("rest")).alias("miss"),
                        F.abs(F.col("below") - F.col("rest")).alias("miss0"))
    best = steps.groupBy(F.col("source").alias("cs")).agg(
        F.min(F.struct("miss", "u")).alias("m"), F.min("miss0").alias("miss0"), F.min("eb").alias("eb"))
    before = F.shiftleft(F.col("eb"), 32 - _BUCKETS_BITS) - 1
    best = best.select("cs", F.when(F.col("miss0") <= F.col("m.miss"), before)
                       .otherwise(F.col("m.u")).alias("cutoff"))
    plan = sources.join(best, sources["source"].eqNullSafe(best["cs"]), "left").select(
        "source", F.col("size").alias("source_size"), "target", "whole",
        F.coalesce(F.col("cutoff"), F.lit(-1).cast("long")).alias("cutoff"))
    return sizes, cut(plan, "plan")


def copies(whole: Column, cutoff: Column, u: Column) -> Column:
    """How often the mix takes a document."""
    return (whole + F.when(u <= cutoff, 1).otherwise(0)).cast("long")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words)."""
    sizes, plan = mixing_plan(docs, **options)
    p = plan.withColumnRenamed("source", "ps")
    return sizes.join(p, sizes["source"].eqNullSafe(p["ps"])).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (copies(F.col("whole"), F.col("cutoff"), F.col("u")) * F.col("size")).alias("taken"))


def mix(docs: DataFrame, *, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", **options) -> DataFrame:
    """The mixed documents, all columns: each row as often as the mix takes it.

    Only the plan (a row a source) is joined, so no text is shuffled. The plan
    is broadcast when Spark finds it small enough.
    """
    _, plan = mixing_plan(docs, seed=seed, id_col=id_col, text_col=text_col,
                          source_col=source_col, **options)
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("s"),
                       draw(F.col(id_col), seed).alias("u"))
    p = plan.select(F.col("source").alias("ps"), "whole", "cutoff")
    n = copies(F.col("whole"), F.col("cutoff"), F.col("u")).cast("int")
    return rows.join(p, rows["s"].eqNullSafe(p["ps"])).where(n > 0) \
        .select("row", F.explode(F.array_repeat(F.lit(0), n)).alias("copy")).select("row.*")
