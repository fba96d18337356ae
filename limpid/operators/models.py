"""Tree models by pyspark.ml: out-of-fold training, full fit, random search."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VarianceThresholdSelector, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.operators.quantiles import group_quantiles
from limpid.operators.selection import median_impute, medians, unpivot

# The three tree models and the ranges of their random search.
FLAVOURS = {
    "boost_deep": ("gbt", {"maxDepth": 5, "maxIter": 30, "stepSize": 0.1}),
    "boost_wide": ("gbt", {"maxDepth": 3, "maxIter": 50, "stepSize": 0.15, "subsamplingRate": 0.8}),
    "forest": ("rf", {"maxDepth": 8, "numTrees": 40}),
}
SEARCH = {"gbt": {"maxDepth": (3, 4, 5, 6), "maxIter": (20, 40), "stepSize": (0.05, 0.1, 0.2)}, "rf": {"maxDepth": (5, 8), "numTrees": (20, 40, 80)}}
#: Bins of a feature, as in pyspark.ml, and cells (fold and bin of every feature) up to which a search fits on sums.
BINS, MAX_CELLS = 32, 20_000


def estimator(kind: str, params: dict, target: str, weight: str | None, seed: int, valid: str | None = None):
    made = (GBTRegressor if kind == "gbt" else RandomForestRegressor)(featuresCol="_x", labelCol=target, seed=seed, **params)
    if weight:
        made = made.setWeightCol(weight)
    return made.setValidationIndicatorCol(valid) if valid and kind == "gbt" else made


def pipeline(features: list[str], kind: str, params: dict, target: str, weight: str | None = None, seed: int = 42, valid: str | None = None) -> Pipeline:
    """Assembler, removal of features that don't vary, and the trees."""
    steady = VarianceThresholdSelector(featuresCol="_all", outputCol="_x", varianceThreshold=0.0)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_all"), steady, estimator(kind, params, target, weight, seed, valid)])


def oof(df: DataFrame, features: list[str], target: str, key: str, fold: str = "fold", weight: str | None = None, flavours: dict = FLAVOURS, seed: int = 42) -> DataFrame:
    """(id, fold, model, y_true, y_pred): every row predicted by models of the other folds.

    Medians for missing features come from the training folds; boosting stops early on an inner sample of them (chosen
    by hash), never on the fold that is predicted. One fit per fold and flavour; rows stay distributed.
    """
    folds = [r[0] for r in df.select(fold).where(F.col(fold).isNotNull()).distinct().orderBy(fold).collect()]
    live = df.where(F.col(target).isNotNull() & ~F.isnan(target)).withColumn("_inner", F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(10)) == 0)
    out = None
    for k in folds:
        train = live.where(F.col(fold) != k)
        mids = medians(train, features)  # once per fold, for both sides
        train, test = median_impute(train, features, mids).persist(), median_impute(live.where(F.col(fold) == k), features, mids)
        for name, (kind, params) in flavours.items():
            model = pipeline(features, kind, params, target, weight, seed, "_inner").fit(train)
            got = model.transform(test).select(F.col(key).alias("id"), F.col(fold).alias("fold"), F.lit(name).alias("model"), F.col(target).alias("y_true"), F.col("prediction").alias("y_pred"))
            out = got if out is None else out.unionByName(got)
        train.unpersist()
    return out


def fit_full(df: DataFrame, features: list[str], target: str, flavour: str = "boost_deep", weight: str | None = None, params: dict | None = None, seed: int = 42) -> PipelineModel:
    """One model on all rows; save it with model.write()."""
    kind, usual = FLAVOURS[flavour]
    return pipeline(features, kind, usual | (params or {}), target, weight, seed).fit(median_impute(df, features))


def search(df: DataFrame, features: list[str], target: str, kind: str = "gbt", trials: int = 6, fold: str = "fold", seed: int = 42) -> list[tuple[float, dict]]:
    """(rmse, parameters) of random draws from SEARCH, each by cross-validation over the folds, the best first.

    Trees only see the bins of the features. Rows of one fold with equal bins are one cell, and the sums of its rows' targets
    give the same splits, leaves and losses as the rows do; so the rows are read once, and all fits run as tasks of one job
    on the cells. Bootstrap weights are drawn for every row and summed per cell and tree. The bins are cut once, at exact
    quantiles of all rows. Where the cells are more than MAX_CELLS (many features), every fit is one of pyspark.ml.
    """
    rng = random.Random(seed)
    tried = list({tuple(sorted(p.items())): p for p in ({k: rng.choice(v) for k, v in SEARCH[kind].items()} for _ in range(trials))}.values())
    data = median_impute(df, features).select(*dict.fromkeys([*features, target, fold])).persist()
    try:
        losses = _losses_by_cells(data, features, target, kind, tried, fold, seed)
        if losses is None:
            losses = _losses_by_rows(data, features, target, kind, tried, fold, seed)
    finally:
        data.unpersist()
    return sorted(zip(losses, tried), key=lambda x: x[0])


def _losses_by_rows(data: DataFrame, features: list[str], target: str, kind: str, tried: list[dict], fold: str, seed: int) -> list[float]:
    folds = [r[0] for r in data.select(fold).distinct().orderBy(fold).collect()]
    judge = RegressionEvaluator(labelCol=target, metricName="rmse")
    rmse = lambda params, k: judge.evaluate(pipeline(features, kind, params, target, None, seed).fit(data.where(F.col(fold) != k)).transform(data.where(F.col(fold) == k)))
    return [sum(rmse(params, k) for k in folds) / len(folds) for params in tried]


def _cuts(data: DataFrame, features: list[str]) -> list[list[float]]:
    """At most BINS - 1 ascending limits per feature, a value at a limit lies below it: midpoints of few values, else quantiles."""
    shares = [i / BINS for i in range(1, BINS)]
    found = {r["g"]: [r[f"q{i}"] for i in range(len(shares))] for r in group_quantiles(unpivot(data, features), F.col("value"), shares, F.col("feature")).collect()}
    for f in features:
        held = sorted(float(r[0]) for r in data.select(F.col(f"`{f}`")).distinct().limit(BINS + 1).collect())  # only to see whether they are few
        if len(held) <= BINS:
            found[f] = [(a + b) / 2 for a, b in zip(held, held[1:])]
    return [sorted(set(found[f])) for f in features]


def _losses_by_cells(data: DataFrame, features: list[str], target: str, kind: str, tried: list[dict], fold: str, seed: int) -> list[float] | None:
    cuts = _cuts(data, features)
    below = lambda f: lambda n, x: n + (F.col(f"`{f}`") > x).cast("int")
    bins = [F.aggregate(F.array(*map(F.lit, c)), F.lit(0), below(f)) if c else F.lit(0) for f, c in zip(features, cuts)]
    rows = data.select(F.col(fold).alias("fold"), F.array(*bins).alias("bins"), F.col(target).cast("double").alias("y")).where("fold IS NOT NULL AND y IS NOT NULL")
    mean = rows.agg(F.avg("y")).first()[0] or 0.0  # targets relative to their mean: sums of squares keep their digits
    rows = rows.withColumn("y", F.col("y") - mean)
    cells = rows.groupBy("fold", "bins").agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss")).limit(MAX_CELLS + 1).toPandas()
    if len(cells) > MAX_CELLS:
        return None
    cells = cells.assign(bins=cells["bins"].map(tuple)).sort_values(["fold", "bins"], ignore_index=True)
    x, of = np.array(cells["bins"].tolist(), np.int64), cells["fold"].to_numpy()
    n, s, ss = (cells[c].to_numpy(float) for c in ("n", "s", "ss"))
    folds = sorted(set(of))
    drawn = None if kind == "gbt" else _bootstrapped(rows, {key: i for i, key in enumerate(zip(of, cells["bins"]))}, max(p["numTrees"] for p in tried), seed)

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for trial, k in zip(pdf["trial"].tolist(), pdf["k"].tolist()):
                params, inside = tried[trial], of != folds[k]
                if kind == "gbt":
                    y = _boosted(x, n * inside, s * inside, params)
                else:
                    y = _forest(x, drawn[0] * inside, drawn[1] * inside, params, np.random.default_rng([seed, k]))
                test = ~inside
                out.append((trial, k, float(np.sqrt(max((ss - 2 * y * s + y * y * n)[test].sum(), 0.0) / n[test].sum()))))
            yield pd.DataFrame(out, columns=["trial", "k", "rmse"])

    fits = [(trial, k) for trial in range(len(tried)) for k in range(len(folds))]
    spark = data.sparkSession
    asked = spark.createDataFrame(spark.sparkContext.parallelize(fits, len(fits)), "trial int, k int")
    got = asked.mapInPandas(fitted, "trial int, k int, rmse double").toPandas()
    return [float(got.loc[got["trial"] == trial, "rmse"].mean()) for trial in range(len(tried))]


def _bootstrapped(rows: DataFrame, place: dict[tuple, int], trees: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(trees, cells) weights and weighted targets of bootstrap samples: every row counts in every tree as often as it is drawn."""

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        sums = np.zeros((2, len(place), trees))
        for pdf in batches:
            cell, y = np.array([place[k] for k in zip(pdf["fold"], map(tuple, pdf["bins"]))], np.int64), pdf["y"].to_numpy()
            order = np.argsort(cell, kind="stable")
            cell, y = cell[order], y[order]
            start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            w = rng.poisson(1.0, (len(cell), trees)).astype(float)
            sums[0, cell[start]] += np.add.reduceat(w, start, axis=0)
            sums[1, cell[start]] += np.add.reduceat(w * y[:, None], start, axis=0)
        held = np.flatnonzero(sums[0].any(axis=1))
        yield pd.DataFrame({"cell": held, "w": [v.tobytes() for v in sums[0, held]], "s": [v.tobytes() for v in sums[1, held]]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for cell, w, s in zip(pdf["cell"].tolist(), pdf["w"], pdf["s"]):
                total[cell] = total.get(cell, 0) + np.frombuffer(w + s)
        yield pd.DataFrame({"cell": list(total), "sums": [v.tobytes() for v in total.values()]})

    parts = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism).mapInPandas(draw, "cell int, w binary, s binary")
    got = parts.repartition("cell").mapInPandas(added, "cell int, sums binary").toLocalIterator()
    out = np.zeros((2, trees, len(place)))
    for r in got:
        out[:, :, r["cell"]] = np.frombuffer(r["sums"]).reshape(2, trees)
    return out[0], out[1]


def _tree(x: np.ndarray, w: np.ndarray, s: np.ndarray, depth: int, pick: Callable[[], Iterable[int]]) -> np.ndarray:
    """Prediction for each cell by a regression tree on weights and weighted targets; cells of no weight are only predicted."""
    out, todo = np.zeros(len(w)), [(np.arange(len(w)), 0)]
    while todo:
        at, level = todo.pop()
        total, sum_ = w[at].sum(), s[at].sum()
        out[at] = sum_ / total if total > 0 else 0.0
        if level == depth or total <= 0:
            continue
        best = (0.0, 0, 0)
        for f in pick():
            lw, ls = np.cumsum(np.bincount(x[at, f], w[at], BINS))[:-1], np.cumsum(np.bincount(x[at, f], s[at], BINS))[:-1]
            ok = np.flatnonzero((lw > 0) & (lw < total))
            if len(ok):
                # the loss of variance; what cells hold inside is the same on both sides
                gain = ls[ok] ** 2 / lw[ok] + (sum_ - ls[ok]) ** 2 / (total - lw[ok]) - sum_**2 / total
                best = max(best, (float(gain.max()), f, int(ok[gain.argmax()])), key=lambda b: b[0])
        if best[0] > 0:
            left = x[at, best[1]] <= best[2]
            todo += [(at[left], level + 1), (at[~left], level + 1)]
    return out


def _boosted(x: np.ndarray, n: np.ndarray, s: np.ndarray, params: dict) -> np.ndarray:
    """Gradient boosting of the squared error as in pyspark.ml: a first tree, then steps on twice the residuals."""
    every = list(range(x.shape[1]))
    y = _tree(x, n, s, params["maxDepth"], lambda: every)
    for _ in range(params["maxIter"] - 1):
        y = y + params["stepSize"] * _tree(x, n, 2 * (s - n * y), params["maxDepth"], lambda: every)
    return y


def _forest(x: np.ndarray, w: np.ndarray, s: np.ndarray, params: dict, rng: np.random.Generator) -> np.ndarray:
    """Mean of trees that look at a third of the varying features in each node, as in pyspark.ml."""
    vary = np.flatnonzero(x.max(axis=0) > x.min(axis=0))
    few = -(-len(vary) // 3)
    trees = [_tree(x, w[t], s[t], params["maxDepth"], lambda: rng.choice(vary, few, replace=False)) for t in range(params["numTrees"])]
    return np.mean(trees, axis=0)


def importances(model: PipelineModel, features: list[str]) -> dict[str, float]:
    """Gain of each feature; 0 for those that the variance threshold removed."""
    kept = model.stages[-2].selectedFeatures
    return dict.fromkeys(features, 0.0) | {features[i]: float(g) for i, g in zip(kept, model.stages[-1].featureImportances.toArray())}
