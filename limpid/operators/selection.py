"""Feature statistics and selection. One pass over many columns by unpivoting; p x p results are small."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.functions.scalars import finite
from limpid.operators import linear
from limpid.operators.quantiles import group_quantiles


def unpivot(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value) of the columns as doubles, without nulls, NaN and infinities."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), finite(F.col(f"`{c}`").cast("double")).alias("value")) for c in columns])).alias("e"))
    return long.select("e.*").where("value IS NOT NULL")


def dominance(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, n, distinct, top_share): how many values, distinct ones, and the share of the most frequent."""
    per = unpivot(df, columns).groupBy("feature", "value").agg(F.count("*").alias("k"))
    return per.groupBy("feature").agg(F.sum("k").alias("n"), F.count("*").alias("distinct"), (F.max("k") / F.sum("k")).alias("top_share"))


def varying(df: DataFrame, columns: list[str], most: float = 0.99) -> list[str]:
    """Columns that are neither constant nor held by one value to the share ``most``; in their given order."""
    keep = {r["feature"] for r in dominance(df, columns).where((F.col("distinct") > 1) & (F.col("top_share") < most)).collect()}
    return [c for c in columns if c in keep]


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) for every pair a before b: Pearson over the rows where both are finite; null where one is constant.

    Tasks add up, a batch at a time, the products of values, squares and presence masks as matrices; nothing per row is
    shuffled and only p x p sums reach the driver. Values are taken relative to the columns' means, so that large
    offsets cost no digits.
    """
    p = len(columns)
    cols = [finite(F.col(f"`{c}`").cast("double")) for c in columns]
    mid = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = np.array([m or 0.0 for m in mid])

    def blocks(x: np.ndarray) -> np.ndarray:
        there = (~np.isnan(x)).astype(float)
        x = np.where(np.isnan(x), 0.0, x - shift)
        return np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])

    got = linear.block_sums(df.select(F.array(*cols).alias("x")), p, blocks).get(None)
    n, s, ss, sab = got.reshape(4, p, p) if got is not None else np.zeros((4, p, p))
    with np.errstate(invalid="ignore", divide="ignore"):
        va, vb = n * ss - s**2, (n * ss - s**2).T
        r = np.where((va > 1e-12) & (vb > 1e-12), (n * sab - s * s.T) / np.sqrt(va * vb), np.nan)
    rows = [(columns[i], columns[j], None if np.isnan(r[i, j]) else float(r[i, j])) for i in range(p) for j in range(i + 1, p)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def correlated_groups(pairs: DataFrame, columns: list[str], limit: float = 0.99) -> list[list[str]]:
    """Groups of columns chained by |r| >= limit, single ones too, in the columns' order; columns are few."""
    up = {c: c for c in columns}

    def top(c: str) -> str:
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c

    place = {c: i for i, c in enumerate(columns)}
    for r in pairs.where(F.abs("r") >= limit).collect():
        a, b = sorted((top(r["a"]), top(r["b"])), key=place.get)
        up[b] = a
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(top(c), []).append(c)
    return list(groups.values())


def variance_importance(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, importance): each column's share of the total sample variance."""
    per = unpivot(df, columns).groupBy("feature").agg(F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("v"))
    total = per.agg(F.sum("v").alias("all"))
    return per.crossJoin(F.broadcast(total)).select("feature", F.when(F.col("all") > 0, F.col("v") / F.col("all")).otherwise(0.0).alias("importance"))  # one row


def spread_columns(df: DataFrame, columns: list[str], limit: float = 0.0) -> list[str]:
    """Columns whose sample variance is above the limit; in their given order."""
    got = {r["feature"] for r in unpivot(df, columns).groupBy("feature").agg(F.var_samp("value").alias("v")).where(F.col("v") > limit).collect()}
    return [c for c in columns if c in got]


def representatives(groups: list[list[str]], importance: dict[str, float]) -> list[str]:
    """The most important column of each group; ties go to the first."""
    return [max(g, key=lambda c: (importance.get(c, 0.0), -g.index(c))) for g in groups]


def select_features(df: DataFrame, columns: list[str], most: float = 0.99, limit: float = 0.99) -> list[str]:
    """Columns left after dropping near-constant ones and keeping one of each correlated group."""
    live = varying(df, columns, most)
    if len(live) < 2:
        return live
    importance = {r["feature"]: r["importance"] for r in variance_importance(df, live).collect()}
    return representatives(correlated_groups(correlations(df, live), live, limit), importance)


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """{column: exact median}; columns without a finite value are left out. All columns in one pass over counts of values."""
    return {r["g"]: r["q0"] for r in group_quantiles(unpivot(df, columns), F.col("value"), [0.5], F.col("feature")).collect()}


def median_impute(df: DataFrame, columns: list[str], fitted: DataFrame | dict[str, float] | None = None) -> DataFrame:
    """Columns with missing values filled by the exact median of ``fitted`` (medians, or a table; df itself if not given)."""
    mids = fitted if isinstance(fitted, dict) else medians(df if fitted is None else fitted, columns)
    return df.withColumns({c: F.coalesce(finite(F.col(f"`{c}`").cast("double")), F.lit(mids.get(c)).cast("double")) for c in columns})
