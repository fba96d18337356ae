"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.scalars import finite, strip


def equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose text is the value without regard to case and white space around it; nulls go."""
    return df.where(F.lower(strip(F.col(column))) == value.lower())


def in_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None, strict: bool = False, keep_null: bool = False) -> DataFrame:
    """Rows within [low, high], or within (low, high) if strict; missing bounds are open; what is no number counts as null."""
    x = finite(F.col(column).try_cast("double"))
    keep: Column = x.isNotNull()
    if low is not None:
        keep = keep & (x > low if strict else x >= low)
    if high is not None:
        keep = keep & (x < high if strict else x <= high)
    return df.where(keep | x.isNull() if keep_null else keep)


def unflagged(df: DataFrame, flag: str = "is_outlier") -> DataFrame:
    """Rows whose flag is 0 or false, without the flag; null flags go."""
    return df.where(F.col(flag).cast("int") == 0).drop(flag)


def below(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.where(finite(F.col(column)) < limit)


def both_finite(a: Column, b: Column) -> Column:
    return finite(a).isNotNull() & finite(b).isNotNull()


def members(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in other; a semi join, so repeated keys don't multiply rows."""
    return df.join(other.select(key), key, "left_semi")


def physiological(column: str = "temp_C") -> Column:
    """35 to 38 °C."""
    return F.col(column).between(35, 38)


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n rows in an order: the limit is the feature. Tasks keep n rows each; no full sort."""
    return df.orderBy(*order).limit(n)
