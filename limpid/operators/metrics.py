"""Metrics and report tables; every one is an aggregate, curves included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limpid.functions.scalars import finite


def _pairs(df: DataFrame, true: str, pred: str, by: list[str]) -> DataFrame:
    return df.select(*by, finite(F.col(true).cast("double")).alias("t"), finite(F.col(pred).cast("double")).alias("p")).where("t IS NOT NULL AND p IS NOT NULL")


def regression(df: DataFrame, true: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """(by..., n, rmse, mae, bias, r2) over finite pairs; r2 is null where the truth doesn't vary."""
    by = by or []
    x = _pairs(df, true, pred, by)
    e = F.col("p") - F.col("t")
    agg = x.groupBy(*by).agg(F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"), F.avg(e * e).alias("_mse"), F.var_pop("t").alias("_var"))
    return agg.withColumn("r2", F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.col("_var"))).drop("_mse", "_var")


def confusion(df: DataFrame, true: str, pred: str, limit: float = -4.0, by: list[str] | None = None) -> DataFrame:
    """(by..., tp, fp, tn, fn): a value above the limit is positive."""
    by = by or []
    x = _pairs(df, true, pred, by)
    t, p = F.col("t") > limit, F.col("p") > limit
    n = lambda c: F.sum(c.cast("long"))
    return x.groupBy(*by).agg(n(t & p).alias("tp"), n(~t & p).alias("fp"), n(~t & ~p).alias("tn"), n(t & ~p).alias("fn"))


def classification(df: DataFrame, true: str, pred: str, limit: float = -4.0, by: list[str] | None = None) -> DataFrame:
    """confusion() with accuracy, specificity, precision, recall, f1 and mcc; null where a ratio has no meaning."""
    c = confusion(df, true, pred, limit, by)
    tp, fp, tn, fn = (F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn"))
    part = lambda a, b: F.try_divide(a, b)
    root = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return c.select("*", part(tp + tn, tp + fp + tn + fn).alias("accuracy"), part(tn, tn + fp).alias("specificity"), part(tp, tp + fp).alias("precision"), part(tp, tp + fn).alias("recall"), part(2 * tp, 2 * tp + fp + fn).alias("f1"), part(tp * tn - fp * fn, root).alias("mcc"))


def score_steps(df: DataFrame, true: str, pred: str, limit: float = -4.0) -> DataFrame:
    """(p, pos, neg) per distinct score: ties are one step of every curve, and the curve has no more points than scores."""
    x = _pairs(df, true, pred, [])
    pos = (F.col("t") > limit).cast("long")
    return x.groupBy("p").agg(F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg"))


def curve(df: DataFrame, true: str, pred: str, limit: float = -4.0) -> DataFrame:
    """(score, tp, fp, tpr, fpr, precision) at every distinct score from the highest down.

    The cumulative sums run within ranges of the score and are offset by the ranges before, so they are no single task.
    """
    s = score_steps(df, true, pred, limit)
    lo, hi = s.agg(F.min("p"), F.max("p")).first()
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / 256 or 1.0
    s = s.withColumn("_b", F.least(F.floor((F.col("p") - lo) / width), F.lit(255)).cast("int"))
    per = s.groupBy("_b").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    up = Window.partitionBy(F.lit(0)).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)  # 256 rows
    per = per.select("_b", F.coalesce(F.sum("bp").over(up), F.lit(0)).alias("op"), F.coalesce(F.sum("bn").over(up), F.lit(0)).alias("on"))
    total = s.agg(F.sum("pos").alias("all_p"), F.sum("neg").alias("all_n"))
    w = Window.partitionBy("_b").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    out = s.withColumn("cp", F.sum("pos").over(w)).withColumn("cn", F.sum("neg").over(w)).join(F.broadcast(per), "_b").crossJoin(F.broadcast(total))  # 256 rows, one row
    tp, fp = F.col("op") + F.col("cp"), F.col("on") + F.col("cn")
    return out.select(F.col("p").alias("score"), tp.alias("tp"), fp.alias("fp"), F.try_divide(tp, F.col("all_p")).alias("tpr"), F.try_divide(fp, F.col("all_n")).alias("fpr"), (tp / (tp + fp)).alias("precision"), "pos", "neg")


def ranking(df: DataFrame, true: str, pred: str, limit: float = -4.0) -> DataFrame:
    """(positives, negatives, roc_auc, average_precision), exact with ties; null without both classes."""
    c = curve(df, true, pred, limit)
    # every positive step beats the negatives below it and half of those it is tied with
    wins = F.sum(F.col("pos") * (F.col("all_neg") - F.col("fp") + F.col("neg") / 2))
    total = c.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    got = c.crossJoin(F.broadcast(total)).agg(F.max("all_pos").alias("positives"), F.max("all_neg").alias("negatives"), wins.alias("w"), F.sum(F.col("pos") * F.col("precision")).alias("ap"))  # one row
    return got.select("positives", "negatives", F.try_divide(F.col("w"), F.col("positives") * F.col("negatives")).alias("roc_auc"), F.try_divide(F.col("ap"), F.col("positives").cast("double")).alias("average_precision"))


def histogram(df: DataFrame, column: str, bins: int = 50, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, low, high, n) of the bins that hold values; the last bin is closed."""
    x = finite(F.col(column).cast("double"))
    if low is None or high is None:
        a, b = df.agg(F.min(x), F.max(x)).first()
        low, high = (a if low is None else low), (b if high is None else high)
    if low is None or high is None or high <= low:
        low, high = (low or 0.0) - 0.5, (low or 0.0) + 0.5
    w = (high - low) / bins
    slot = F.least(F.floor((x - low) / w), F.lit(bins - 1)).cast("int")
    rows = df.select(slot.alias("bin"), x.alias("x")).where((F.col("x") >= low) & (F.col("x") <= high))
    return rows.groupBy("bin").agg(F.count("*").alias("n")).select("bin", (F.lit(low) + F.col("bin") * w).alias("low"), (F.lit(low) + (F.col("bin") + 1) * w).alias("high"), "n")


def residuals(df: DataFrame, true: str, pred: str, step: float = 0.2) -> DataFrame:
    """(bin, n, mean_error) of the prediction error in steps."""
    x = _pairs(df, true, pred, []).withColumn("e", F.col("p") - F.col("t"))
    return x.groupBy(F.floor(F.col("e") / step).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg("e").alias("mean_error"))


def scoped(df: DataFrame, scope: Column, name: str) -> DataFrame:
    """df once as 'Global' and, where the condition holds, once as the named scope; in one pass."""
    marks = F.when(scope, F.array(F.lit("Global"), F.lit(name))).otherwise(F.array(F.lit("Global")))
    return df.withColumn("scope", F.explode(marks))


def mean_by(df: DataFrame, key: str, drop: tuple[str, ...] = ("fold",)) -> DataFrame:
    """Mean of every numeric column per key; NaN and infinities don't count."""
    kinds = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    cols = [c for c, k in df.dtypes if k in kinds and c != key and c not in drop]
    return df.groupBy(key).agg(*[F.avg(finite(F.col(c).cast("double"))).alias(c) for c in cols])


def summary(metrics: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, <column>_mean, <column>_std...) over splits; std is the population's."""
    return metrics.groupBy(key).agg(*[f for c in columns for f in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))])


def best(metrics: DataFrame, key: str, column: str) -> DataFrame:
    """(key, column) of the smallest value; ties go to the smallest key."""
    return metrics.agg(F.min(F.struct(F.col(column), F.col(key))).alias("m")).select(f"m.{key}", f"m.{column}")


def ranked(metrics: DataFrame, key: str, column: str) -> DataFrame:
    """metrics with ``place``, 1 for the smallest value (ties by key). One row per model: a single window is no burden."""
    return metrics.withColumn("place", F.row_number().over(Window.orderBy(F.col(column).asc_nulls_last(), key)))


def model_card(name: str, kind: str, weights: dict[str, float], scores: dict[str, float], rows: int) -> dict:
    """What a stored ensemble says of itself, as a JSON document."""
    return {"name": name, "kind": kind, "models": sorted(weights), "weights": {k: round(float(weights[k]), 6) for k in sorted(weights)}, "scores": {k: round(float(v), 6) for k, v in sorted(scores.items())}, "rows": rows}


def consolidate(params: DataFrame, name: str = "name", value: str = "value") -> DataFrame:
    """(name, value) of text values: the rounded mean if all are whole numbers, the mean if all are numbers, else the
    most frequent text (ties: the smallest)."""
    rows = params.select(F.col(name).alias("k"), F.col(value).cast("string").alias("v")).where("k IS NOT NULL AND v IS NOT NULL")
    num = F.col("v").try_cast("double")
    whole = F.col("v").rlike(r"^[-+]?\d+$")
    per = rows.groupBy("k", "v").agg(F.count("*").alias("n"))
    text = per.groupBy("k").agg(F.min(F.struct((-F.col("n")).alias("o"), F.col("v"))).v.alias("mode"))
    stats = rows.groupBy("k").agg(F.avg(num).alias("mean"), F.bool_and(num.isNotNull()).alias("numbers"), F.bool_and(whole).alias("wholes"))
    out = F.when(F.col("wholes"), F.rint("mean").cast("long").cast("string")).when(F.col("numbers"), F.col("mean").cast("string")).otherwise(F.col("mode"))
    return stats.join(text, "k").select(F.col("k").alias(name), out.alias(value))


def param_median(params: DataFrame, name: str = "name", value: str = "value") -> DataFrame:
    """(name, value): the median of numeric parameters (rounded if all are whole), null for others."""
    rows = params.select(F.col(name).alias("k"), F.col(value).cast("string").alias("v")).where("k IS NOT NULL AND v IS NOT NULL")
    num = F.col("v").try_cast("double")
    got = rows.groupBy("k").agg(F.median(num).alias("m"), F.bool_and(F.col("v").rlike(r"^[-+]?\d+$")).alias("w"), F.bool_and(num.isNotNull()).alias("ok"))
    return got.select(F.col("k").alias(name), F.when(F.col("ok"), F.when(F.col("w"), F.rint("m")).otherwise(F.col("m"))).alias(value))
