"""Exact quantiles of groups, without gathering a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limpid.functions.scalars import finite
from limpid.runtime import Scratch

#: Ranges of a group's values in which ranks are counted, each by itself.
RANGES = 256


def group_quantiles(df: DataFrame, value: Column, shares: list[float], by: Column | None = None) -> DataFrame:
    """(g, n, q0, q1, ...) per value of ``by`` (g is null without): how many finite values, and their exact quantiles with
    linear interpolation.

    Equal values are counted before they are shuffled; ranks are counted within ranges of the values and offset by the
    ranges before, and only the counts that hold a wanted rank are kept. So neither a group nor all its distinct values
    are ever in one task's memory. Groups without values don't appear; NaN and infinities don't count. The counts and
    the result are written to the shared folder: what comes before is computed once, and plans stay short.
    """
    scratch = Scratch(df.sparkSession, "quantiles")
    g = F.lit(None).cast("int") if by is None else by
    counts = scratch.write(df.select(g.alias("g"), finite(value.cast("double")).alias("v")).where("v IS NOT NULL").groupBy("g", "v").agg(F.count("*").alias("k")))
    ends = counts.groupBy("g").agg(F.sum("k").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    same = F.col("g").eqNullSafe(F.col("eg"))
    slot = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * RANGES), F.lit(RANGES - 1))).otherwise(0).cast("int")
    placed = counts.join(ends.withColumnRenamed("g", "eg"), same).select("g", "v", "k", "n", slot.alias("b"))
    per = placed.groupBy("g", "b").agg(F.sum("k").alias("bk"))
    earlier = lambda *part: Window.partitionBy(*part)
    per = per.select(F.col("g").alias("pg"), F.col("b").alias("pb"), F.coalesce(F.sum("bk").over(earlier("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))  # RANGES rows per group
    inside = F.coalesce(F.sum("k").over(earlier("g", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.withColumn("inside", inside).join(per, F.col("g").eqNullSafe(F.col("pg")) & (F.col("b") == F.col("pb"))).select("g", "n", "v", (F.col("off") + F.col("inside")).alias("at"), "k")
    place = [(F.col("n") - 1) * F.lit(float(q)) for q in shares]
    holds = lambda r: (F.col("at") <= r) & (r < F.col("at") + F.col("k"))
    wanted = [(F.max(F.when(holds(F.floor(p)), F.col("v"))), F.max(F.when(holds(F.ceil(p)), F.col("v")))) for p in place]
    needed = F.lit(False)
    for p in place:
        needed = needed | holds(F.floor(p)) | holds(F.ceil(p))
    got = ranked.where(needed).groupBy("g").agg(F.max("n").alias("n"), *[c.alias(f"{e}{i}") for i, pair in enumerate(wanted) for e, c in zip(("lo", "hi"), pair)])

    def between(i: int, q: float) -> Column:
        p, low, high = (F.col("n") - 1) * F.lit(float(q)), F.col(f"lo{i}"), F.col(f"hi{i}")
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    out = scratch.write(got.select("g", "n", *[between(i, q).alias(f"q{i}") for i, q in enumerate(shares)]))
    scratch.drop(counts)
    return out
