"""Binning, balancing, weighting, grouped splits and folds. Random choices follow the order of md5(seed|id)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limpid.functions.scalars import finite, temperature_weight
from limpid.operators.quantiles import group_quantiles

#: Groups of one label are ranked in buckets of about this many.
RANK_BUCKET = 100_000


def seeded(seed: int, col: Column) -> Column:
    """Position in the seeded order."""
    return F.md5(F.concat(F.lit(f"{seed}|"), col.cast("string")))


def quantile_bins(df: DataFrame, column: str, bins: int) -> Column:
    """Label 0.. of the quantile bin, right-closed; equal edges fall together; null is -1."""
    x = finite(F.col(column))
    row = group_quantiles(df, x, [i / bins for i in range(bins + 1)]).first()
    inner = sorted(set(row[2:] if row else []))[1:-1]
    return F.when(x.isNull(), -1).otherwise(reduce(lambda acc, e: acc + (x > e).cast("int"), inner, F.lit(0)))


def temperature_label(temp_c: Column) -> Column:
    """(20,25] Ambient with 20 itself, (25,35] Normal, (35,40] Physio, (40,50] Hot, else null."""
    return F.when((temp_c >= 20) & (temp_c <= 25), "Ambient").when((temp_c > 25) & (temp_c <= 35), "Normal").when((temp_c > 35) & (temp_c <= 40), "Physio").when((temp_c > 40) & (temp_c <= 50), "Hot")


def strata(temp_c: Column | None, target_bin: Column | None, step: float = 5.0) -> Column:
    """'<temperature rounded half to even to the step>|<target bin>'; -999 and -1 for nulls, NoTemp, NoTarget or All without the column."""
    t = F.lit("NoTemp") if temp_c is None else F.coalesce((F.rint(temp_c / step) * step).cast("int").cast("string"), F.lit("-999"))
    if temp_c is None and target_bin is None:
        return F.lit("All")
    b = F.lit("NoTarget") if target_bin is None else F.coalesce(target_bin, F.lit(-1)).cast("string")
    return F.concat_ws("|", t, b)


def balance(df: DataFrame, key: str, limit: int = 30, size: float = 0.2, seed: int = 42, iterations: int = 1, value: str = "logS", temp: str = "temp_C") -> DataFrame:
    """Caps the crowded cells of the (value bin, temperature label) grid for each iteration; adds ``iter``.

    Only Ambient cells with more than ``limit`` rows are cut, to the first ``limit`` in the seeded order (the seed is
    seed + iteration); rows outside every bin go; a missing temperature counts as 25. The cap is the feature. All
    iterations are one plan; the ranking keeps only ``limit`` rows per task before the shuffle.
    """
    t = F.coalesce(F.col(temp), F.lit(25.0))
    cell = F.floor(F.col(value) / size).cast("int")
    rows = df.withColumn("bin_value", cell).withColumn("bin_temp", temperature_label(t)).where("bin_value IS NOT NULL AND bin_temp IS NOT NULL")
    rows = rows.withColumn("iter", F.explode(F.sequence(F.lit(1), F.lit(iterations))))
    order = F.md5(F.concat((F.lit(seed) + F.col("iter")).cast("string"), F.lit("|"), F.col(key).cast("string")))
    rest = rows.where("bin_temp <> 'Ambient'")
    rank = F.row_number().over(Window.partitionBy("iter", "bin_value").orderBy("_o", key))
    capped = rows.where("bin_temp = 'Ambient'").withColumn("_o", order).withColumn("_r", rank).where(F.col("_r") <= limit).drop("_o", "_r")
    return capped.unionByName(rest)


def sample_weights(df: DataFrame, value: str = "logS", temp: str = "temp_C", low: float = -12.0, high: float = 4.0, bins: int = 16, name: str = "weight") -> DataFrame:
    """Adds temperature weight x ln(1 + N / max(1, rows in the value's bin)); missing values count as -2.

    Values beyond the range look up the outermost bin but aren't counted in it. The counts are one small aggregate.
    """
    x = F.coalesce(finite(F.col(value)), F.lit(-2.0))
    width = (high - low) / bins
    slot = F.least(F.greatest(F.floor((x - low) / width), F.lit(0)), F.lit(bins - 1)).cast("int")
    inside = (x >= low) & (x <= high)
    counts = df.select(slot.alias("_b"), inside.cast("long").alias("_in")).groupBy("_b").agg(F.sum("_in").alias("_c"))
    total = df.agg(F.count("*").alias("_n"))
    look = counts.crossJoin(F.broadcast(total))  # one row
    rare = F.log1p(F.col("_n") / F.greatest(F.col("_c"), F.lit(1)))
    return df.withColumn("_b", slot).join(F.broadcast(look), "_b").withColumn(name, temperature_weight(F.col(temp)) * rare).drop("_b", "_c", "_n")  # at most ``bins`` rows


def random_split(key: Column, shares: dict[str, float], seed: int = 42) -> Column:
    """Name of the part that a key falls into: parts of the given shares, in their order, along md5(seed|key)."""
    place = F.conv(F.substring(seeded(seed, key), 1, 8), 16, 10).cast("double") / float(1 << 32)
    names, edge, out = list(shares), sum(shares.values()), None
    for name in reversed(names):
        edge -= shares[name]
        out = F.lit(name) if out is None else F.when(place < edge + shares[name], name).otherwise(out)
    return F.when(key.isNotNull(), out)


def group_labels(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label, size): the most frequent label of each group, ties to the smallest; two partial aggregates."""
    counts = df.where(F.col(group).isNotNull()).groupBy(group, label).agg(F.count("*").alias("_n"))
    return counts.groupBy(group).agg(F.min(F.struct((-F.col("_n")).alias("k"), F.col(label).alias("v"))).v.alias("label"), F.sum("_n").alias("size"))


def collapse_rare(groups: DataFrame, least: int, other: str | int, label: str = "label") -> DataFrame:
    """Labels that fewer than ``least`` groups have become ``other``."""
    few = groups.groupBy(label).agg(F.count("*").alias("_n")).where(F.col("_n") < least).select(label, F.lit(True).alias("_few"))
    return groups.join(few, label, "left").withColumn(label, F.when(F.col("_few"), F.lit(other)).otherwise(F.col(label))).drop("_few")


def group_folds(df: DataFrame, group: str, value: str, folds: int = 5, bins: int = 5, seed: int = 42) -> DataFrame:
    """(group, label, fold): every group in one fold, groups of one label spread evenly over the folds.

    A group's label is its most frequent quantile bin; labels of fewer than ``folds`` groups become -1. Within a label
    groups are dealt out in the seeded order, label by label from another fold on. Ranks are counted in buckets of the
    seeded order, so that a label most groups share is no single task.
    """
    labels = collapse_rare(group_labels(df.withColumn("_q", quantile_bins(df, value, bins)), group, "_q"), folds, -1)
    ranked = labels.withColumn("_h", seeded(seed, F.col(group)))
    ranked = bucket_rank(ranked, "label", "_h", group)
    return ranked.withColumn("fold", F.pmod(F.col("_at") - 1 + F.col("label"), F.lit(folds)).cast("int")).select(group, "label", "fold")


def bucket_rank(df: DataFrame, part: str, order: str, tie: str) -> DataFrame:
    """Adds _at, the row number by (order, tie) within ``part``, for a hexadecimal order column; ranks are counted in
    256 buckets of the order's first two digits and offset by the buckets before."""
    rows = df.withColumn("_bk", F.substring(order, 1, 2))
    counts = rows.groupBy(part, "_bk").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(part).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(part, "_bk").orderBy(order, tie))
    return rows.withColumn("_in", inside).join(before, [part, "_bk"]).withColumn("_at", F.col("_before") + F.col("_in")).drop("_bk", "_in", "_before")


def take_nearer(sizes: np.ndarray, taken: np.ndarray, at: int, goal: int) -> int:
    """Marks the sizes that one after the other bring ``at`` nearer to the goal; returns ``at`` with them."""
    lo = 0
    while lo < len(sizes) and at < goal:
        near = sizes[lo:] < 2 * (goal - at)  # nearer, if nothing else is taken before
        lo += int(near.argmax()) if near.any() else len(near)
        before = at + np.cumsum(sizes[lo:]) - sizes[lo:]
        fits = sizes[lo:] < 2 * (goal - before)
        n = len(fits) if fits.all() else int(fits.argmin())
        taken[lo : lo + n] = True
        at += int(sizes[lo : lo + n].sum())
        lo += n
    return at


def group_split(df: DataFrame, group: str, value: str, temp: str | None = None, share: float = 0.2, step: float = 5.0, bins: int = 5, seed: int = 42) -> DataFrame:
    """(group, stratum, size, split): groups whole in 'train' or 'test', stratum by stratum.

    In every stratum groups come in the seeded order; one goes to test if that brings the test rows nearer to
    int(rows x share), the first one always. The sweep is sequential by nature: it reads the strata one after the
    other in sorted order, a batch at a time with only the test rows so far as its state, so no stratum is gathered
    in memory; what is (group, stratum, size) is one row per group.
    """
    q = quantile_bins(df, value, bins)
    label = strata(F.col(temp) if temp else None, q, step)
    groups = collapse_rare(group_labels(df.withColumn("_l", label), group, "_l"), 2, "OTHER")
    rows = groups.groupBy("label").agg(F.sum("size").alias("_rows")).select("label", F.floor(F.col("_rows") * share).cast("long").alias("_goal"))
    kind = df.schema[group].dataType.simpleString()

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        label, at = None, 0
        for pdf in batches:
            split = np.zeros(len(pdf), bool)
            strata_, sizes = pdf["stratum"].to_numpy(), pdf["size"].to_numpy(np.int64)
            starts = np.flatnonzero(np.r_[True, strata_[1:] != strata_[:-1]]) if len(pdf) else []
            for lo, hi in zip(starts, [*starts[1:], len(pdf)]):
                goal = int(pdf["goal"].iloc[lo])
                if strata_[lo] != label:  # the first group is always taken
                    label, at, split[lo] = strata_[lo], int(sizes[lo]), True
                    lo += 1
                at = take_nearer(sizes[lo:hi], split[lo:hi], at, goal)
            yield pdf[[group, "stratum", "size"]].assign(split=np.where(split, "test", "train"))

    listed = groups.join(rows, "label").select(group, F.col("label").alias("stratum"), "size", F.col("_goal").alias("goal"), seeded(seed, F.col(group)).alias("_h"))
    ordered = listed.repartition("stratum").sortWithinPartitions("stratum", "_h", group).select(group, "stratum", "size", "goal")
    return ordered.mapInPandas(sweep, f"`{group}` {kind}, stratum string, size long, split string")
