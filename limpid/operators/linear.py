"""Linear models from Gram sums: one aggregate over the rows, small solves on the driver (p x p)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.scalars import finite

ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0, 1000.0)


def block_sums(rows: DataFrame, width: int, blocks: Callable[[np.ndarray], np.ndarray], by: str | None = None) -> dict[object, np.ndarray]:
    """Per value of ``by``, the sum over Arrow batches of ``blocks(x)`` for the rows' (batch, width) matrix in column ``x``.

    Each task adds up its own sums; what is collected is one array per task and value, then added in a fixed order.
    """
    key = F.col(by).cast("string") if by else F.lit(None).cast("string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[object, np.ndarray] = {}
        for pdf in batches:
            whole = np.array(pdf["x"].tolist(), float).reshape(len(pdf), width)
            for k, rows in pdf.groupby("k", dropna=False).indices.items() if by else [(None, np.arange(len(pdf)))]:
                got, k = blocks(whole[rows]), None if k is None or k != k else k
                sums[k] = sums[k] + got if k in sums else got
        for k, total in sums.items():
            for i, row in enumerate(total.reshape(-1, total.shape[-1])):
                yield pd.DataFrame({"k": pd.Series([k], dtype=object), "i": [i], "row": [row]})

    found = rows.select(key.alias("k"), "x").mapInPandas(run, "k string, i int, row array<double>")
    # rows of the sums meet by number: what comes to the driver is one array, however many tasks there were
    added = found.groupBy("k", "i").agg(F.array_agg("row").alias("rows")).mapInPandas(_added, "k string, i int, row array<double>").collect()
    out: dict[object, dict[int, list]] = {}
    for r in added:
        out.setdefault(r["k"], {})[r["i"]] = r["row"]
    return {k: np.array([held[i] for i in sorted(held)]) for k, held in out.items()}


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf[["k", "i"]].assign(row=[np.sort(np.array(list(map(np.asarray, rows)), float), axis=0).sum(axis=0) for rows in pdf["rows"]])


#: Up to so many columns products are summed by expressions in the JVM, beyond as blocks of matrices.
FEW = 8


def gram(df: DataFrame, features: list[str], target: str, by: str | None = None) -> dict[object, np.ndarray]:
    """Sums of products of (1, features..., target) over rows where all are finite, per value of ``by`` (None: one)."""
    cols = [F.lit(1.0), *[finite(F.col(f"`{c}`").cast("double")) for c in [*features, target]]]
    if len(cols) > FEW:
        got = block_sums(df.select(F.array(*cols).alias("x"), *([by] if by else [])).where(~F.exists("x", lambda v: v.isNull())), len(cols), lambda x: x.T @ x, by)
        kind = {str(r[0]): r[0] for r in df.select(by).distinct().collect()} if by else {}
        return {kind.get(k, k) if by and k is not None else None: m for k, m in got.items()}
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols[1:]])
    names = [f"g{i}_{j}" for i in range(len(cols)) for j in range(i, len(cols))]
    aggs = [F.sum(cols[i] * cols[j]).alias(f"g{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))]
    rows = df.where(whole).groupBy(*([F.col(by).alias("_k")] if by else [])).agg(*aggs).collect()
    out = {}
    for r in rows:
        m = np.zeros((len(cols), len(cols)))
        for name in names:
            i, j = map(int, name[1:].split("_"))
            m[i, j] = m[j, i] = r[name] or 0.0
        out[r["_k"] if by else None] = m
    return out


def solve_ridge(m: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """(intercept, coefficients on the raw scale) of ridge on standardised features (population deviation) from a Gram
    matrix; constant features get 0."""
    n, k = m[0, 0], m.shape[0] - 2
    if n <= 0:
        return 0.0, np.zeros(k)
    mean = m[0, 1:] / n
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov)[:k], 0))
    scale = np.where(sd > 1e-12, sd, 1.0)
    xx = n * cov[:k, :k] / np.outer(scale, scale) + alpha * np.eye(k)
    w = np.linalg.solve(xx, n * cov[:k, k] / scale) / scale
    w = np.where(sd > 1e-12, w, 0.0)
    return float(mean[k] - w @ mean[:k]), w


def rss(m: np.ndarray, b: float, w: np.ndarray) -> float:
    """Sum of squared residuals of a linear model on the rows behind a Gram matrix."""
    v = np.concatenate([[-b], -w, [1.0]])
    return float(v @ m @ v)


def linear_score(features: list[str], w: np.ndarray | list[float], b: float) -> Column:
    """b + sum of w x, missing features counting as 0."""
    return reduce(lambda acc, fw: acc + F.coalesce(finite(F.col(f"`{fw[0]}`").cast("double")), F.lit(0.0)) * float(fw[1]), zip(features, w), F.lit(float(b)))


def choose_alpha(grams: dict[object, np.ndarray], alphas: tuple[float, ...] = ALPHAS) -> float:
    """The alpha with the least squared error on left-out folds, from the folds' Gram matrices alone."""
    total = sum(grams.values())
    if len(grams) < 2:
        return alphas[0]

    def loss(alpha: float) -> float:
        return sum(rss(g, *solve_ridge(total - g, alpha)) for g in grams.values())

    return min(alphas, key=loss)


def ridge_oof(df: DataFrame, features: list[str], target: str, fold: str = "fold", name: str = "y_pred") -> DataFrame:
    """Out-of-fold ridge predictions: for every fold a model of the other folds, its alpha chosen by cross-validation
    among those. One pass gathers the folds' Gram matrices; scoring is a projection."""
    grams = gram(df, features, target, fold)
    total = sum(grams.values()) if grams else np.zeros((len(features) + 2,) * 2)
    score = F.lit(None).cast("double")
    for k, g in sorted(grams.items(), key=lambda x: str(x[0])):
        rest = {j: h for j, h in grams.items() if j != k}
        b, w = solve_ridge(total - g, choose_alpha(rest))
        score = F.when(F.col(fold) == k, linear_score(features, w, b)).otherwise(score)
    return df.withColumn(name, score)


def ridge_full(df: DataFrame, features: list[str], target: str, fold: str = "fold") -> dict[str, float]:
    """Coefficients on the raw scale, with 'intercept', 'alpha' and 'n', of ridge on all rows; alpha by the folds."""
    grams = gram(df, features, target, fold)
    total = sum(grams.values()) if grams else np.zeros((len(features) + 2,) * 2)
    alpha = choose_alpha(grams)
    b, w = solve_ridge(total, alpha)
    return {"intercept": b, "alpha": alpha, "n": float(total[0, 0]), **{f: float(x) for f, x in zip(features, w)}}


def to_simplex(w: np.ndarray) -> np.ndarray:
    """Nearest weights that are at least 0 and sum to 1."""
    u = np.sort(w)[::-1]
    c = (np.cumsum(u) - 1) / np.arange(1, len(u) + 1)
    k = int(np.max(np.flatnonzero(u > c)))
    return np.maximum(w - c[k], 0)


def blend_weights(m: np.ndarray) -> np.ndarray:
    """Simplex weights of models from their Gram matrix (without intercept)."""
    z = m[1:-1, 1:-1] + 1e-8 * np.eye(m.shape[0] - 2)
    return to_simplex(np.linalg.solve(z, m[1:-1, -1]))


def nnls(m: np.ndarray) -> np.ndarray:
    """Non-negative least squares from a Gram matrix by an active set, scaled to sum 1 (equal weights if all are 0)."""
    a, y = m[1:-1, 1:-1], m[1:-1, -1]
    k = len(y)
    w, on = np.zeros(k), np.zeros(k, bool)
    for _ in range(10 * k):
        g = y - a @ w
        if on.all() or g[~on].max(initial=-1.0) <= 1e-9:
            break
        on[np.argmax(np.where(on, -np.inf, g))] = True
        while True:
            s = np.zeros(k)
            s[on] = np.linalg.lstsq(a[np.ix_(on, on)], y[on], rcond=None)[0]
            if s[on].min() > 0:
                w = s
                break
            bad = on & (s <= 0)
            step = np.min(w[bad] / np.maximum(w[bad] - s[bad], 1e-300))
            w = w + step * (s - w)
            on &= w > 1e-12
            w[~on] = 0
            if not on.any():
                break
    return w / w.sum() if w.sum() > 0 else np.full(k, 1.0 / k)


def blend_oof(wide: DataFrame, models: list[str], target: str = "y_true", fold: str = "fold", name: str = "oof_blend") -> DataFrame:
    """Out-of-fold simplex blend of the columns oof_<model>."""
    cols = [f"oof_{m}" for m in models]
    grams = gram(wide, cols, target, fold)
    total = sum(grams.values()) if grams else None
    score = F.lit(None).cast("double")
    for k, g in sorted(grams.items(), key=lambda x: str(x[0])):
        w = blend_weights(total - g) if len(grams) > 1 else np.full(len(cols), 1 / len(cols))
        score = F.when(F.col(fold) == k, linear_score(cols, w, 0.0)).otherwise(score)
    return wide.withColumn(name, score)


def stack_oof(wide: DataFrame, models: list[str], target: str = "y_true", fold: str = "fold", name: str = "oof_stack") -> DataFrame:
    """Out-of-fold ridge stack of the columns oof_<model>."""
    return ridge_oof(wide, [f"oof_{m}" for m in models], target, fold, name)


def blend_score(weights: dict[str, float]) -> Column:
    """Weighted sum of columns, weights scaled to sum 1 over the columns that hold a value; null if none does."""
    used = reduce(lambda a, b: a + b, [F.when(finite(F.col(c)).isNotNull(), w).otherwise(0.0) for c, w in weights.items()])
    return F.when(used > 0, reduce(lambda a, b: a + b, [F.coalesce(finite(F.col(c)), F.lit(0.0)) * w for c, w in weights.items()]) / used)


def ensemble(df: DataFrame, stack: tuple[dict[str, float], float] | None = None, blend: dict[str, float] | None = None, models: list[str] | None = None, name: str = "prediction") -> DataFrame:
    """The best combination at hand: stack, else blend, else the mean of the models; 0 without any."""
    if stack:
        w, b = stack
        return df.withColumn(name, linear_score(list(w), list(w.values()), b))
    if blend:
        return df.withColumn(name, blend_score(blend))
    if models:
        return df.withColumn(name, blend_score(dict.fromkeys(models, 1.0)))
    return df.withColumn(name, F.lit(0.0))
