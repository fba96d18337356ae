"""Outliers by z-scores within temperature bins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.scalars import finite
from limpid.operators.quantiles import group_quantiles


#: So many bins' statistics are broadcast at most; more are joined.
MOST_BINS = 10_000


def bin_edges(df: DataFrame, column: str, mode: str = "width", bins: int = 10, width: float | None = None) -> list[float]:
    """Edges of equal width (``bins`` of them, or of the given width) or quantile bins; distinct and ascending.

    Computed in one aggregate over finite values. Without values, or where all are equal, one bin around them.
    """
    x = finite(F.col(column))
    if mode == "quantile":
        row = group_quantiles(df, x, [i / bins for i in range(bins + 1)]).first()
        edges = sorted(set(row[2:] if row else []))
    else:
        low, high = df.agg(F.min(x).alias("a"), F.max(x).alias("b")).first()
        if low is None:
            edges = []
        elif width is not None:
            n = max(1, int(-(-(high - low) // width)))
            edges = [low + i * width for i in range(n + 1)]
            if edges[-1] < high:
                edges.append(edges[-1] + width)
        else:
            edges = [low + (high - low) * i / bins for i in range(bins)] + [high]
    if len(set(edges)) < 2:
        a = edges[0] if edges else 0.0
        return [a - 0.5, a + 0.5]
    return sorted(set(edges))


def bin_of(x: Column, edges: list[float]) -> Column:
    """Number of the right-closed bin (the lowest edge belongs to bin 0), null outside."""
    if len(edges) > 64:  # a search in one array instead of a long sum
        inner = F.array_size(F.filter(F.array(*[F.lit(e) for e in edges[1:-1]]), lambda e: x > e))
    else:
        inner = reduce(lambda acc, e: acc + (x > e).cast("int"), edges[1:-1], F.lit(0))
    return F.when((x >= edges[0]) & (x <= edges[-1]), inner)


def flag_outliers(df: DataFrame, value: str = "logS", by: str = "temp_C", mode: str = "width", bins: int = 10, width: float | None = None, method: str = "robust", limit: float = 3.0, least: int = 8) -> DataFrame:
    """Adds z and is_outlier (0/1): how far the value lies from others of similar temperature.

    robust: (x - median) / (1.4826 MAD); standard: (x - mean) / sd. Bins of fewer than ``least`` rows, or without
    spread, flag nothing; neither do rows without value or temperature. Medians come from (bin, value) counts ranked in
    ranges (see group_quantiles), joined back as one row per bin.
    """
    edges = bin_edges(df, by, mode, bins, width)
    ok = finite(F.col(value)).isNotNull() & finite(F.col(by)).isNotNull()
    slot = F.when(ok, bin_of(F.col(by), edges))
    rows = df.withColumn("_bin", slot)
    seen = rows.where("_bin IS NOT NULL")
    if method == "standard":
        stats = seen.groupBy("_bin").agg(F.count("*").alias("_n"), F.avg(value).alias("_mid"), F.stddev_samp(value).alias("_spread"))
    else:
        rename = lambda d, *names: d.select(F.col("g").alias("_bin"), *[F.col(a).alias(b) for a, b in names])
        mid = rename(group_quantiles(seen, F.col(value), [0.5], F.col("_bin")), ("n", "_n"), ("q0", "_mid"))
        off = seen.join(mid.select("_bin", "_mid"), "_bin")
        mad = rename(group_quantiles(off, F.abs(F.col(value) - F.col("_mid")), [0.5], F.col("_bin")), ("q0", "_mad"))
        stats = mid.join(mad, "_bin").withColumn("_spread", 1.4826 * F.col("_mad")).drop("_mad")
    z = F.when((F.col("_n") >= least) & (F.col("_spread") > 0), (F.col(value) - F.col("_mid")) / F.col("_spread"))
    # one row per bin; a given width leaves open how many bins there are, so only a bounded number is broadcast
    out = rows.join(F.broadcast(stats) if len(edges) <= MOST_BINS else stats, "_bin", "left").withColumn("z", z)
    return out.withColumn("is_outlier", F.coalesce((F.abs("z") > limit).cast("int"), F.lit(0))).drop("_bin", "_n", "_mid", "_spread")
