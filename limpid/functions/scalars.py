"""Column functions: clean-up, units, temperature, ionisation. All are built-in expressions that stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Concentration units as factors to mol/L, and mass units as factors to g/L.
MOLAR_UNITS = {"M": 1.0, "mM": 1e-3, "uM": 1e-6, "µM": 1e-6, "nM": 1e-9, "mol/L": 1.0, "mmol/L": 1e-3}
MASS_UNITS = {"ug.mL-1": 1e-3, "ug/mL": 1e-3, "mcg/mL": 1e-3, "ng/mL": 1e-6, "mg/mL": 1.0, "mg/L": 1e-3, "g/L": 1.0}
ASSUMED_CELSIUS = 25.0
# pKa of an acid and a base that never ionise in water.
INERT_ACID, INERT_BASE = 16.0, -2.0


def finite(col: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def to_number(col: Column) -> Column:
    """Double, null for what is no finite number."""
    return finite(col.try_cast("double"))


def strip(col: Column) -> Column:
    """Text without white space around it."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def blank_to_null(col: Column) -> Column:
    return F.when(col.rlike(r"\S"), col)


def parse_bool(col: Column) -> Column:
    """true/1/yes/y/t and false/0/no/n/f without regard to case; anything else is null."""
    word = F.lower(strip(col.cast("string")))
    return F.when(word.isin("true", "1", "yes", "y", "t", "1.0"), True).when(word.isin("false", "0", "no", "n", "f", "0.0"), False)


def celsius(kelvin: Column) -> Column:
    return kelvin - 273.15


def inverse_temperature(temp_c: Column) -> Column:
    """1000 / T in kelvin; a missing temperature counts as 25 °C."""
    return 1000.0 / (F.coalesce(temp_c, F.lit(ASSUMED_CELSIUS)) + 273.15)


def text_temperature(text: Column) -> Column:
    """First '<two or three digits> deg/degrees/°/C' of a text if within 0..100, else null."""
    found = F.regexp_extract(text, r"(?i)(\d{2,3})\s?(?:deg|degrees|°|C)\b", 1).try_cast("double")
    return F.when(found.between(0, 100), found)


def assumed_temperature(text: Column) -> Column:
    """(temp, assumed): the temperature that a text names, else ASSUMED_CELSIUS with assumed true."""
    found = text_temperature(text)
    return F.struct(F.coalesce(found, F.lit(ASSUMED_CELSIUS)).alias("temp"), found.isNull().alias("assumed"))


def numbered_label(prefix: str, number: Column) -> Column:
    """prefix and the whole part of a number; null without one."""
    return F.concat(F.lit(prefix), finite(number.cast("double")).cast("long").cast("string"))


def pka_or_inert(acid: Column, base: Column) -> Column:
    """(acid, base) with constants of groups that don't ionise in water where none is known."""
    return F.struct(F.coalesce(finite(acid), F.lit(INERT_ACID)).alias("acid"), F.coalesce(finite(base), F.lit(INERT_BASE)).alias("base"))


def log_solubility(value: Column, unit: Column, kind: Column, molar_mass: Column) -> Column:
    """log10 of mol/L from a value, its unit and the kind of measurement.

    Values of 0 or below and rows without molar mass give null; a kind that says 'log' with an empty unit passes the
    value through; mass units are divided by the molar mass; unknown units give null.
    """
    u = strip(F.coalesce(unit, F.lit("")))
    good = (value > 0) & (molar_mass > 0)
    out = F.when(good & F.lower(F.coalesce(kind, F.lit(""))).contains("log") & (u == ""), value)
    for name, k in MOLAR_UNITS.items():
        out = out.when(good & (u == name), F.log10(value * k))
    for name, k in MASS_UNITS.items():
        out = out.when(good & (u == name), F.log10(value * k / molar_mass))
    return out


def hash_mod(col: Column, n: int) -> Column:
    """SHA-1 of the text modulo n (null counts as the empty text); digits are folded, so any n is exact."""
    digits = F.split(F.sha1(F.coalesce(col.cast("string"), F.lit(""))), "")
    value = F.transform(F.filter(digits, lambda d: d != ""), lambda d: F.conv(d, 16, 10).cast("int"))
    return F.aggregate(value, F.lit(0), lambda acc, d: (acc * 16 + d) % n)


def temperature_weight(temp_c: Column, sigma: float = 5.0, centre: float = 37.0) -> Column:
    """(1 + 4 exp(-(T - centre)^2 / (2 sigma^2)))^2; a missing temperature counts as 25 °C."""
    t = F.coalesce(temp_c, F.lit(ASSUMED_CELSIUS))
    return F.pow(1 + 4 * F.exp(-F.pow(t - centre, 2) / (2 * sigma * sigma)), 2)


def neutral_fraction(ph: Column, acid: Column, base: Column) -> Column:
    """Share of the uncharged form at a pH, from the strongest acid (lowest pKa) and base (highest pKa); nulls don't ionise."""
    a = F.when(acid.isNotNull(), F.pow(F.lit(10.0), ph - acid)).otherwise(0.0)
    b = F.when(base.isNotNull(), F.pow(F.lit(10.0), base - ph)).otherwise(0.0)
    return 1 / (1 + a + b)


def pka_summary(pka: Column) -> Column:
    """(low, high, n) of a map atom -> pKa as text; what is empty, zero or no number doesn't count."""
    held = F.filter(F.transform(F.map_values(pka), lambda v: v.try_cast("double")), lambda v: v.isNotNull() & ~F.isnan(v) & (v != 0))
    return F.struct(F.array_min(held).alias("low"), F.array_max(held).alias("high"), F.when(pka.isNotNull(), F.size(held)).alias("n"))


def net_charge(ph: Column, acids: Column, bases: Column) -> Column:
    """Charge of a molecule with the given pKa arrays, with H+ and OH- of the solution; falls with the pH."""
    zero = F.lit(0.0)
    plus = F.aggregate(F.coalesce(bases, F.array().cast("array<double>")), zero, lambda acc, p: acc + 1 / (1 + F.pow(F.lit(10.0), ph - p)))
    minus = F.aggregate(F.coalesce(acids, F.array().cast("array<double>")), zero, lambda acc, p: acc + 1 / (1 + F.pow(F.lit(10.0), p - ph)))
    return plus - minus


def _padded(lists: pd.Series) -> np.ndarray:
    """Lists as rows of one matrix, NaN where a list is shorter; nulls in lists count as absent."""
    held = [[] if x is None else [v for v in x if v is not None] for x in lists]
    out = np.full((len(held), max(map(len, held), default=0)), np.nan)
    for i, x in enumerate(held):
        out[i, : len(x)] = x
    return out


def _saturation(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for log_s, acids, bases in batches:
        s, a, b = 10.0 ** log_s.to_numpy(float), _padded(acids), _padded(bases)
        lo, hi = np.full(len(s), -2.0), np.full(len(s), 16.0)
        with np.errstate(over="ignore", invalid="ignore"):
            for _ in range(40):
                ph = (lo + hi) / 2
                charge = np.nansum(1 / (1 + 10.0 ** (ph[:, None] - b)), axis=1) - np.nansum(1 / (1 + 10.0 ** (a - ph[:, None])), axis=1)
                up = s * charge + 10.0**-ph - 10.0 ** (ph - 14) > 0
                lo, hi = np.where(up, ph, lo), np.where(up, hi, ph)
        yield pd.Series(np.where(np.isnan(s), np.nan, (lo + hi) / 2)).astype("Float64").where(~np.isnan(s))


def saturation_ph(log_s: Column, acids: Column, bases: Column) -> Column:
    """pH of the saturated solution in -2..16, by bisection of the charge balance, which falls with the pH.

    40 halvings over whole Arrow batches: as higher-order functions they would be interpreted row by row.
    """
    none = F.array().cast("array<double>")
    return F.pandas_udf(_saturation, "double")(finite(log_s), F.coalesce(acids.cast("array<double>"), none), F.coalesce(bases.cast("array<double>"), none))


def effective_log_s(log_s: Column, ph_saturated: Column, ph: Column, acid: Column, base: Column) -> Column:
    """log10 of the solubility at a pH, from that of the saturated solution; floors keep the logarithm finite."""
    neutral = F.pow(F.lit(10.0), log_s) * neutral_fraction(ph_saturated, acid, base)
    return F.round(F.log10(F.greatest(neutral, F.lit(1e-15)) / F.greatest(neutral_fraction(ph, acid, base), F.lit(1e-12))), 3)


LN10 = math.log(10.0)
