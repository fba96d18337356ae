"""Consensus of duplicate measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPREAD = 0.7


def _keyed(df: DataFrame, key: str, solvent: str, temp: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).withColumn("_s", F.coalesce(F.col(solvent), F.lit("UNKNOWN"))).withColumn("_t", F.coalesce(F.col(temp), F.lit(-9999.0)))


def _medians(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.groupBy(key, "_s", "_t").agg(F.count("*").alias("_n"), F.count(value).alias("_held"), F.median(value).alias("_mid"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))


def consensus(df: DataFrame, order: list[str], key: str = "InChIKey", solvent: str = "solvent", temp: str = "temp_C", value: str = "logS", spread: float = SPREAD) -> DataFrame:
    """One row per (key, solvent, temperature): single rows as they are; of several, the values within ``spread`` of
    the median are averaged into the first row (by ``order``), and groups without such a value go.

    Null values neither count nor agree; a group of only nulls keeps its first row. Missing solvents and temperatures
    are groups of their own. The medians are one aggregate, the first row another (partial) one, so a hot key is no
    single task of whole rows.
    """
    rows = _keyed(df, key, solvent, temp)
    mid = _medians(rows, key, value)
    whole = rows.join(mid, [key, "_s", "_t"])
    near = F.abs(F.col(value) - F.col("_mid")) <= spread
    cols = [c for c in df.columns]
    first = F.min(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))).alias("_first")
    got = whole.groupBy(key, "_s", "_t").agg(first, F.avg(F.when(near, F.col(value))).alias("_mean"), F.first("_n").alias("_n"), F.first("_held").alias("_held"))
    got = got.where("_n = 1 OR _held = 0 OR _mean IS NOT NULL").select("_first._row.*", "_mean", "_n")
    return got.withColumn(value, F.when((F.col("_n") > 1) & F.col("_mean").isNotNull(), F.col("_mean")).otherwise(F.col(value))).drop("_mean", "_n")


def conflicts(df: DataFrame, key: str = "InChIKey", solvent: str = "solvent", temp: str = "temp_C", value: str = "logS", spread: float = SPREAD) -> DataFrame:
    """(key, solvent, temp, rows, median, low, high, kept) of every group of several rows whose values spread further
    than twice the limit."""
    rows = _keyed(df, key, solvent, temp)
    mid = _medians(rows, key, value)
    near = rows.join(mid, [key, "_s", "_t"]).groupBy(key, "_s", "_t").agg(F.sum((F.abs(F.col(value) - F.col("_mid")) <= spread).cast("long")).alias("kept"))
    wide = mid.where((F.col("_n") > 1) & (F.col("_hi") - F.col("_lo") > 2 * spread)).join(near, [key, "_s", "_t"])
    return wide.select(key, F.col("_s").alias("solvent"), F.col("_t").alias("temp_C"), F.col("_n").alias("rows"), F.col("_mid").alias("median"), F.col("_lo").alias("low"), F.col("_hi").alias("high"), F.coalesce("kept", F.lit(0)).alias("kept"))


def first_by(order: list[Column], *cols: str) -> Column:
    """Struct of the columns of the first row in an order; a partial aggregate."""
    return F.min(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *cols))


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by an order column."""
    rn = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")
