"""Mixing sources to target weights, none repeated more often than a limit.

Targets are filled like water: each source gets its weight's share of the whole, a source
whose share exceeds ``epochs`` times its size is clamped there, and the excess goes to the
others by weight until no share exceeds its limit. Each source then gives whole
repetitions of all its documents, and of one more repetition the documents that come first
in a seeded order, up to the target; the document on the border gives a part of its words.

The order is never sorted as a whole: sizes are added up for each of 4,096 ranges of the
order, then for as many ranges of the one with the border, and only the documents of the
range within it, one in 16 million of a source, are added up one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.storing import stored

WORD = r"[^\x20\x09-\x0D]+"
# Between a word and the white space after it.
WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
SEED = "mix"
# Hex digits of the seeded order that name a range.
RANGE_DIGITS = 3


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sizes: DataFrame, cycle: tuple[float, ...] = (3, 1, 2)) -> DataFrame:
    """``sizes`` (one row per source) with weights by the source's place in code-point order, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weights = F.array(*[F.lit(float(x)) for x in cycle])
    return sizes.withColumn("weight", F.element_at(weights, (place % len(cycle) + 1).cast("int")))


def targets(weighted: DataFrame, share: float, epochs: int) -> DataFrame:
    """``weighted`` (source, source_size, weight) with ``target``; together ``share`` times all sizes.

    A round clamps every source above its limit and spreads the rest by weight. Only the
    sums of a round reach the driver.
    """
    capped = stored(weighted.withColumn("cap", F.col("source_size") * epochs), "sources")
    whole, weight = capped.agg(F.sum("source_size"), F.sum("weight")).first()
    level, clamped = (share * whole / weight if weight else 0.0), 0
    while True:
        over = F.col("cap") < F.lit(level) * F.col("weight")
        n, caps, free = capped.agg(
            F.count(F.when(over, 1)),
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == clamped or not free:
            break
        clamped, level = n, (share * whole - caps) / free
    return capped.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame, weigh=cycled_weights, share: float = 1.5, epochs: int = 2, seed: str = SEED
) -> DataFrame:
    """``docs`` with size, source_size, target and taken; earlier columns of these names are replaced.

    ``size`` is the number of words of the text and ``taken`` the words that the mix takes
    of the document, repetitions counted; no document gives more than ``epochs`` times its
    size, and the sum of a source is its target rounded to a whole number. ``weigh`` adds
    ``weight`` to one row per source. Null and empty texts have size 0 and give nothing;
    a null source is a source; documents are ordered by a seeded hash of doc_id, then by
    doc_id, size and a hash of the text, so that reruns agree and only equal rows can
    change places. An empty table gives an empty result.
    """
    docs = docs.drop("size", "source_size", "target", "taken")
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    # the row as one column, so that no name of it meets a name used here
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "source", order.alias("place"))
    rows = rows.withColumn("range", F.substring("place", 1, RANGE_DIGITS))
    size = word_count("doc.text")
    sums = stored(rows.groupBy("source", "range").agg(F.sum(size).alias("range_size")), "range-sizes")
    wanted = targets(weigh(sums.groupBy("source").agg(F.sum("range_size").alias("source_size"))), share, epochs)
    plan = stored(_with_border(_plan(wanted), sums.select("source", "range", "range_size"), ""), "mix-plan")
    joined = rows.withColumnRenamed("source", "own").join(plan, F.col("own").eqNullSafe(F.col("source")))
    joined = joined.withColumn("inner_range", F.substring("place", RANGE_DIGITS + 1, RANGE_DIGITS)).drop("own")
    at_border = F.coalesce(F.col("range") == F.col("border"), F.lit(False))
    inner = joined.where(at_border).groupBy("source", F.col("inner_range").alias("range"))
    inner = stored(inner.agg(F.sum(size).alias("range_size")), "inner-sizes")
    borders = _with_border(plan.drop("source_size", "target", "whole"), inner, "inner_")
    borders = stored(borders.select(F.col("source").alias("own"), "inner_border", "inner_before"), "inner-plan")
    joined = joined.join(borders, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    in_inner = at_border & F.coalesce(F.col("inner_range") == F.col("inner_border"), F.lit(False))
    earlier = (F.col("range") < F.col("border")) | (at_border & (F.col("inner_range") < F.col("inner_border")))
    plain = joined.where(~in_inner).withColumn("size", size)
    plain = plain.withColumn("extra", F.when(earlier, F.col("size")).otherwise(0))
    running = F.sum("size").over(
        Window.partitionBy("source")
        .orderBy("place", "doc.doc_id", "size", F.xxhash64("doc.text"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    left = F.col("part") - F.col("inner_before") - F.coalesce(running, F.lit(0))
    near = joined.where(in_inner).withColumn("size", size)
    near = near.withColumn("extra", F.greatest(F.least(left, F.col("size")), F.lit(0)))
    return plain.unionByName(near).select(
        "doc.*", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("extra")).alias("taken")
    )


def _plan(wanted: DataFrame) -> DataFrame:
    """Per source its whole repetitions, and the words beyond them."""
    plan = wanted.select(
        "source",
        "source_size",
        "target",
        F.expr("CASE WHEN source_size > 0 THEN floor(target + 0.5) div source_size ELSE 0L END").alias("whole"),
    )
    return plan.withColumn("part", F.floor(F.col("target") + 0.5) - F.col("whole") * F.col("source_size"))


def _with_border(plan: DataFrame, sums: DataFrame, name: str) -> DataFrame:
    """``plan`` with the range in which a source's words end, and its words before that range.

    ``sums`` (source, range, range_size) are ranges in order; inner ones begin where the outer
    border's range does. The columns are ``border`` and ``before``, with ``name`` before them.
    """
    base = F.col("before") if name else F.lit(0)
    before = F.sum("range_size").over(
        Window.partitionBy("own").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    border = (
        sums.withColumnRenamed("source", "own")
        .withColumn("running", F.coalesce(before, F.lit(0)))
        .join(plan, F.col("own").eqNullSafe(F.col("source")))
        .withColumn("so_far", base + F.col("running"))
        .where("so_far < part and part <= so_far + range_size")
        .select("own", F.col("range").alias(f"{name}border"), F.col("so_far").alias(f"{name}before"))
    )
    return plan.join(border, F.col("source").eqNullSafe(F.col("own")), "left").drop("own")


def mixed_documents(mixture: DataFrame) -> DataFrame:
    """One row for each repetition: the document, or for a part of it the text up to its last word taken."""
    columns = [c for c in mixture.columns if c not in ("size", "source_size", "target", "taken")]
    wholes = F.array_repeat(F.col("size"), F.expr("int(taken div greatest(size, 1))"))
    part = F.expr("taken % greatest(size, 1)")
    each = F.when(part > 0, F.concat(wholes, F.array(part))).otherwise(wholes)
    rows = mixture.select(F.struct(*columns).alias("doc"), "size", F.explode(each).alias("words"))
    text = F.col("doc.text")
    cut = F.array_join(F.slice(F.split(text, WORD_END, -1), F.lit(1), F.col("words").cast("int")), "")
    whole = F.col("words") == F.col("size")
    return rows.select(F.col("doc").withField("text", F.when(whole, text).otherwise(cut)).alias("doc")).select("doc.*")
