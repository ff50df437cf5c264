"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight and a schedule: a piecewise linear curve over training
time 0 to 1 that says how strongly the source is drawn on. The integral of the
curve, scaled to the source's target, is its cumulative demand in words. Documents
of a source are laid out one after another in a fixed pseudo-random order; the time
at which demand reaches a document's place is its training position.

Defined results: a null text has size 0; a null source is a source, last in order; a
null doc_id is placed like an empty name. Rows that repeat a doc_id are laid out one
after the other. Empty tables give empty results. Columns other than doc_id, text
and source are ignored by ``mix``.

The table of sources (one row each) is ordered in one task; documents never are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
# Multipliers of the weight at given times: heavy sources fade, light ones rise.
CURVES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)))
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """source, source_size, rank, target: shares by weight, none above ``limit`` times its source.

    Sources are sorted by how soon they fill up. With the first k of them full,
    the others share what is left; the first source that this share does not fill
    sets the level for all.
    """
    named = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = named.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(limit))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * float(share) - (F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    level = left / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = filled.withColumn("level", level)
    open_level = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))
    # Levels rise up to that source and fall after it, where sources would be full that are not.
    chosen = F.max(open_level).over(everything)
    return levels.withColumn("chosen", chosen).select(
        "source",
        "source_size",
        "rank",
        F.coalesce(F.least("cap", F.col("chosen") * F.col("weight")), F.col("cap")).alias("target"),
    )


def laid_out(sized: DataFrame, hex_digits: int = 3) -> DataFrame:
    """Each document's place: the words of its source that come before it.

    Documents are ordered by the MD5 of their id. Running sums are taken inside
    buckets of the leading digits and shifted by the sums of earlier buckets, so a
    source of any size is spread over ``16**hex_digits`` groups.
    """
    coded = sized.withColumn("code", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    coded = coded.withColumn("bucket", F.substring("code", 1, hex_digits))
    sums = coded.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("code", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = coded.withColumn("until", F.sum("size").over(inside))
    match = F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    return placed.join(offsets, match).select(
        "doc_id", "source", "size", "code", (F.col("offset") + F.col("until") - F.col("size")).alias("place")
    )


def inverse_demand(share: Column, curve) -> Column:
    """The time at which the integral of ``curve``, scaled to 1, reaches ``share``."""
    done, pieces = 0.0, []
    for (t0, w0), (t1, w1) in zip(curve, curve[1:]):
        pieces.append((done, t0, w0, (w1 - w0) / (t1 - t0)))
        done += (w0 + w1) / 2 * (t1 - t0)
    need = share * done
    out = None
    for begin, t0, w0, slope in pieces:
        rest = need - begin
        # the positive root of slope/2 dt**2 + w0 dt = rest, in its stable form
        time = F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest, F.lit(0.0))))
        out = time if out is None else F.when(need >= begin, time).otherwise(out)
    return out


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, curves=CURVES) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, positions.

    ``positions`` has one training position (0 to 1) for every pass that takes words
    of the document. The mix takes whole passes over a source and, at its target,
    the first words of one more; so a source gives exactly its target, rounded down.
    """
    sized = materialize(sizes(docs), "sizes")
    quota = targets(sized, weights, share, limit).select(
        F.col("source").alias("s"), "source_size", "rank", "target", F.floor("target").cast("long").alias("whole")
    )
    rows = laid_out(sized).join(materialize(quota, "quota"), F.col("source").eqNullSafe(F.col("s")))
    passes = F.sequence(F.lit(0), F.lit(int(limit) - 1))
    words = F.transform(passes, lambda p: F.greatest(F.lit(0), F.least(F.col("size"), F.col("whole") - F.col("place") - p * F.col("source_size"))))
    starts = F.transform(F.filter(passes, lambda p: F.col("whole") > F.col("place") + p * F.col("source_size")), lambda p: (F.col("place") + p * F.col("source_size")) / F.col("target"))

    def timed(x: Column) -> Column:
        out = inverse_demand(x, curves[0])
        for k, curve in enumerate(curves[1:], 1):
            out = F.when(F.col("rank") % len(curves) == k, inverse_demand(x, curve)).otherwise(out)
        return out

    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.aggregate(words, F.lit(0).cast("long"), lambda a, b: a + b).alias("taken"),
        F.when(F.col("size") > 0, F.transform(starts, timed)).otherwise(F.array().cast("array<double>")).alias("positions"),
        "code",
    )


def ordered(mixed: DataFrame) -> DataFrame:
    """Documents range-sorted by their first training position, those not taken last."""
    first = F.get("positions", F.lit(0))
    return mixed.withColumn("position", F.floor(first * 1e6).cast("long")).orderBy(first.asc_nulls_last(), "code")
