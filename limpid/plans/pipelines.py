"""The two pipelines: research (curate, split, train, evaluate) and execution (curate, score, correct for pH)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions import scalars as S
from limpid.operators import consensus, filters, linear, metrics, outliers, sampling
from limpid.runtime import Scratch


def curate(df: DataFrame, order: str, medium: str = "water", low: float = 24.0, high: float = 50.0, flag: bool = True) -> DataFrame:
    """Rows of one medium and temperature range, without outliers (if ``flag``), duplicates replaced by their consensus.

    The two filters fuse into one scan; only the columns used are read.
    """
    rows = filters.in_range(filters.equals(df, "solvent", medium), "temp_C", low, high)
    if flag:
        rows = filters.unflagged(outliers.flag_outliers(rows.drop("is_outlier")).drop("z"))
    return consensus.consensus(rows, [order])


def research(df: DataFrame, order: str, group: str = "InChIKey", target: str = "logS", seed: int = 42) -> DataFrame:
    """(fold, n, rmse, mae, bias, r2) of a cross-validated physical ridge model on curated, grouped, weighted data."""
    rows = Scratch(df.sparkSession, "research").write(curate(df, order))  # folds, weights and models read it
    folds = sampling.group_folds(rows, group, target, seed=seed).select(group, "fold")
    data = sampling.sample_weights(rows).join(folds, group).withColumn("inv_temp", S.inverse_temperature(F.col("temp_C"))).withColumn("mw", F.coalesce("mol_weight", F.lit(800.0)))
    scored = linear.ridge_oof(data, ["inv_temp", "mw"], target)
    out = metrics.regression(scored, target, "y_pred", ["fold"])
    return out.select("fold", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "bias", "r2")])


def execute(df: DataFrame, coefficients: dict[str, float], acid: Column, base: Column, ph: float = 7.4) -> DataFrame:
    """df with predicted_logS of a stored linear model and logS_ph, the prediction at a pH; rows stay as they are.

    A pure projection: it runs on batches and streams alike. Missing solvents and temperatures are taken as water at
    25 °C.
    """
    w = {k: v for k, v in coefficients.items() if k not in ("intercept", "alpha", "n")}
    x = df.withColumn("inv_temp", S.inverse_temperature(F.col("temp_C"))) if "inv_temp" in w else df
    x = x.withColumn("predicted_logS", linear.linear_score(list(w), list(w.values()), coefficients.get("intercept", 0.0)))
    acids, bases = (F.filter(F.array(c), lambda v: v.isNotNull()) for c in (acid, base))
    sat = S.saturation_ph(F.col("predicted_logS"), acids, bases)
    return x.withColumn("ph_saturated", sat).withColumn("logS_ph", S.effective_log_s(F.col("predicted_logS"), F.col("ph_saturated"), F.lit(ph), acid, base))
