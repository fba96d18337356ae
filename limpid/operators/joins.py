"""Joins of prediction and truth tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.functions.scalars import finite
from limpid.operators.schema import keep_first, normal_id


def oof_collapse(oof: DataFrame) -> DataFrame:
    """(id, fold, model, y_true, y_pred): one row per id, fold and model; the smallest truth and the mean prediction of
    its finite rows. Ids are stripped; null ids go."""
    x = oof.select(normal_id(F.col("id")).alias("id"), "fold", "model", finite(F.col("y_true")).alias("t"), finite(F.col("y_pred")).alias("p")).where("id IS NOT NULL")
    return x.groupBy("id", "fold", "model").agg(F.min("t").alias("y_true"), F.avg("p").alias("y_pred"))


def oof_wide(collapsed: DataFrame, models: list[str]) -> DataFrame:
    """(id, fold, y_true, oof_<model>...) of the ids that every model predicts in a fold: one aggregate in place of
    k - 1 joins."""
    per = [F.max(F.when(F.col("model") == m, F.col("y_pred"))).alias(f"oof_{m}") for m in models]
    got = collapsed.where(F.col("model").isin(models)).groupBy("id", "fold").agg(F.min("y_true").alias("y_true"), F.countDistinct("model").alias("_k"), *per)
    return got.where(F.col("_k") == len(models)).drop("_k")


def with_truth(pred: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Inner join of predictions and truth on a stripped id; columns that both have get the suffix _truth."""
    clash = [c for c in truth.columns if c in pred.columns and c != key]
    t = truth.withColumnsRenamed({c: f"{c}_truth" for c in clash}).withColumn(key, normal_id(F.col(key)))
    return pred.withColumn(key, normal_id(F.col(key))).join(t, key)


def inner_once(left: DataFrame, right: DataFrame, key: str, order: list[str], suffix: str) -> DataFrame:
    """Inner join of the first row per key of either side (by ``order``, where a side has it); the right side's columns
    that the left has too get the suffix."""
    first = lambda df: keep_first(df.where(F.col(key).isNotNull()), [key], [c for c in order if c in df.columns] or [key])
    left, right = first(left), first(right)
    return left.join(right.withColumnsRenamed({c: f"{c}{suffix}" for c in right.columns if c in left.columns and c != key}), key)


def with_all(base: DataFrame, others: list[DataFrame], key: str) -> DataFrame:
    """Left joins of further predictions to a base table."""
    for other in others:
        base = base.join(other, key, "left")
    return base


def iterations(df: DataFrame, n: int) -> DataFrame:
    """Every row once per iteration 1..n; all iterations are one plan."""
    return df.withColumn("iter", F.explode(F.sequence(F.lit(1), F.lit(n))))
