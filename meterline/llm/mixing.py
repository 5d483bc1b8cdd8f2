"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 60-bit hash. A source whose target is ``r`` times its size
gives each document ``floor(r)`` times, and once more the documents whose hash lies below
the source's threshold. The threshold comes from histograms: words are summed by source
and by the leading 12 bits, the bucket in which the budget ends is found, and only the
documents of that bucket go into the next histogram, until 60 bits are used up. Nothing
sorts the documents, and a larger budget only adds documents (nested selections).

Results: sizes are word counts (null texts 0). A null source is a source of its own, last
in order. Documents with equal ids share a hash and are taken or left together. A null id
hashes like the text ``null``. Empty tables give empty results; sources without words
have target and taken 0. Other columns pass through ``mix_rows`` and are ignored here.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import WORD, ranked
from meterline.session import stored

BITS, STEP = 60, 12


def key_hash(key: Column) -> Column:
    """The first 60 bits of the MD5 digest of the key as text."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.conv(F.left(F.md5(text), F.lit(15)), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(totals: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """source, source_size, target: shares of the whole by weight, none above ``cap`` sizes.

    A share above its cap stops there and its excess goes to the others by weight. The
    level R / W only rises, so each round is one sum over the sources.
    """
    order = totals.withColumn("_last", F.col("source").isNull())
    order = ranked(order, "_last", "source", name="mix-sources", column="place").drop("_last")
    picked = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = stored(order.withColumn("weight", picked.cast("long")), "mix-weights")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    whole = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight = int(whole[0] or 0), int(whole[1] or 0)
    left, share = total, weight
    while share:
        over = wide("weight") * F.lit(left).cast("decimal(18,0)") > wide("source_size") * F.lit(
            cap * share
        ).cast("decimal(18,0)")
        stopped = rows.where(over).agg(F.sum("source_size"), F.sum("weight")).first()
        now = total - cap * int(stopped[0] or 0), weight - int(stopped[1] or 0)
        if now == (left, share):
            break
        if now[1] == 0 or Fraction(now[0], now[1]) < Fraction(left, share):
            raise ValueError("the caps leave no room for the total")
        left, share = now
    if not share:
        return rows.select("source", "source_size", F.lit(0.0).alias("target"))
    even = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(share))
    most = (F.col("source_size") * cap).cast("double")
    return rows.select("source", "source_size", F.when(over, most).otherwise(even).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, threshold: hashes below it are within ``budget`` words, as near as whole documents go."""
    open_ = budgets.select("source", F.col("budget").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    found: DataFrame | None = None
    for level in range(BITS // STEP):
        shift = BITS - STEP * (level + 1)
        docs = sized.alias("d")
        if level:
            docs = docs.join(
                open_.alias("o"),
                F.col("d.source").eqNullSafe(F.col("o.source"))
                & (F.shiftright("d.hash", shift + STEP) == F.col("o.prefix")),
                "left_semi",
            )
        sums = docs.groupBy("d.source", F.shiftright("d.hash", shift).alias("prefix")).agg(
            F.sum("d.size").alias("words")
        )
        # At most 4,096 rows for each source meet in this window.
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("prefix"))
        crossed = (
            sums.withColumn("upto", upto)
            .alias("s")
            .join(open_.alias("o"), F.col("s.source").eqNullSafe(F.col("o.source")))
            .where("s.upto > o.rest")
            .groupBy("s.source")
            .agg(F.min(F.struct("s.prefix", "s.words", "s.upto", "o.rest")).alias("m"))
        )
        step = stored(
            crossed.select(
                "source", "m.prefix", (F.expr("m.rest - (m.upto - m.words)")).alias("rest"), "m.words"
            ),
            "mix-level",
        )
        if level == 0:
            # A budget that no bucket exceeds takes every document.
            found = budgets.join(step, budgets.source.eqNullSafe(step.source), "left_anti").select(
                "source", F.lit(1 << BITS).cast("long").alias("threshold")
            )
        open_ = step.select("source", "rest", "prefix")
    nearer = F.expr("words - rest < rest").cast("long")
    return found.union(step.select("source", F.col("prefix") + nearer))


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """key, source, size, source_size, target, times and taken of every document."""
    sized = stored(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            key_hash(F.col(key)).alias("hash"),
        ),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(totals, weights, cap)
    plan = stored(
        plan.withColumn(
            "times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        ).withColumn(
            "budget",
            F.greatest(F.lit(0).cast("long"), F.floor(F.col("target") - F.col("times") * F.col("source_size"))),
        ),
        "mix-plan",
    )
    cut = thresholds(sized, plan.select("source", "budget"))
    plan = stored(
        plan.alias("p")
        .join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")))
        .select("p.*", "c.threshold"),
        "mix-thresholds",
    )
    times = F.col("p.times") + (F.col("d.hash") < F.col("p.threshold")).cast("long") * (
        F.col("p.budget") > 0
    ).cast("long")
    return (
        sized.alias("d")
        .join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select(
            F.col("d.key").alias(key),
            F.col("d.source").alias("source"),
            "d.size",
            "p.source_size",
            "p.target",
            times.alias("times"),
            (times * F.col("d.size")).alias("taken"),
        )
    )


def mix_rows(
    docs: DataFrame, mixed: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The documents as often as the mix takes them; documents without words stay once.

    ``mixed`` is a result of ``mix`` for the same documents. How often a document is taken
    follows from its key and source, so rows that share them, null ones too, are each
    taken as often, and none more often for the others.
    """
    often = mixed.groupBy(F.col(key).alias("_mix_key"), F.col("source").alias("_mix_source")).agg(
        F.max("times").cast("int").alias("_mix_times")
    )
    same = docs[key].eqNullSafe(F.col("_mix_key")) & docs[source].eqNullSafe(F.col("_mix_source"))
    words = F.coalesce(docs[text].rlike(WORD), F.lit(False))
    joined = docs.join(often, same)
    joined = joined.withColumn("_mix_times", F.when(words, F.col("_mix_times")).otherwise(1)).where("_mix_times > 0")
    return joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), "_mix_times"))).select(
        *[docs[c] for c in docs.columns]
    )
