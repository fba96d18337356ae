"""Problem 6: quantities recorded in different units, converted to one."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.runtime import Scratch, plain_source, usable

#: A unit that neither text nor source states is taken from its posterior; below this it is flagged as uncertain.
SURE = 0.95
#: Share of a source's rows that its usual unit is credited with before any are seen.
PRIOR = 0.05
#: So many sources' weights are broadcast at most; more are joined.
MOST_SOURCES = 10_000
_LN10 = math.log(10)


@dataclass(frozen=True)
class Unit:
    """A unit or scale: SQL of the value in the target unit (x: recorded value, mw: molar mass), and of |d target / dx|."""

    name: str
    to_target: str
    slope: str = "1.0"


@dataclass(frozen=True)
class Quantity:
    """A measured quantity; units[0] is the target unit. step: bin width of its density on the target scale."""

    units: tuple[Unit, ...]
    low: float
    high: float
    step: float


CELSIUS = Quantity((Unit("C", "x"), Unit("K", "x - 273.15"), Unit("F", "(x - 32) / 1.8", "1 / 1.8")), -50.0, 200.0, 0.5)
KELVIN = Quantity((Unit("K", "x"), Unit("C", "x + 273.15"), Unit("F", "(x - 32) / 1.8 + 273.15", "1 / 1.8"), Unit("K/10", "x / 10", "0.1"), Unit("K/100", "x / 100", "0.01")), 220.0, 480.0, 0.5)
LOG_MOLAR = Quantity(
    (
        Unit("log10 mol/L", "x"),
        Unit("ln mol/L", f"x / {_LN10}", f"1 / {_LN10}"),
        Unit("-log10 mol/L", "-x"),
        Unit("mol/L", "IF(x > 0, log10(x), NULL)", f"IF(x > 0, 1 / (x * {_LN10}), 0.0)"),
        Unit("log10 mmol/L", "x - 3"),
        Unit("log10 umol/L", "x - 6"),
        Unit("log10 g/L", "IF(mw > 0, x - log10(mw), NULL)"),
    ),
    -14.0,
    4.0,
    0.1,
)


# -- units stated by a text -------------------------------------------------------------------------------------

# The writings of scales and units, and words for what is done to a sample beside the measurement.
_SCALES = {
    "F": r"(?:degrees )?fahrenheit\b|deg(?:rees)?\.?\s*F\b|degF\b|°\s?F\b|℉",
    "C": r"(?:degrees )?celsius\b|centigrade\b|deg(?:rees)?\.?\s*C\b|degC\b|°\s?C\b|℃",
    "K": r"kelvins?\b|deg(?:rees)?\.?\s*K\b|°\s?K\b",
}
_HANDLING = re.compile(r"\b(?:dr(?:ied|y|ying)|oven|stored?|storage|kept|received|shipped|delivered at|melt(?:s|ed|ing)?|boil(?:s|ed|ing)?|quench(?:ed|ing)?|frozen|freez\w+|fridge|room|before|after|flash ?point)\b", re.I)
_STATEMENT = re.compile(r";|\.\s|\s/\s(?![^()]*\))|[\r\n]")
_NUMBERED = {u: re.compile(rf"(?<![\w.])(-?\d+(?:\.\d+)?)\s?(?:(?i:{w})|{u}\b)") for u, w in _SCALES.items()}
_EQUATED = re.compile(r"\bT(?:emp(?:erature)?)?\.?\s?\(\s?°?([FCK])\s?\)\s?[=:]\s?(-?\d+(?:\.\d+)?)")
_NAMED = {u: re.compile(rf"(?i:\b{w}|(?<!\w)(?:{w}))|\(°?{u}\)|\bT/{u}\b|\bin {u}\b" + (r"|(?i:\babs(?:olute|\.)? temp)" if u == "K" else "")) for u, w in _SCALES.items()}


def temperature_words(text: str) -> tuple[str | None, dict[str, list[float]]]:
    """(scale, {scale: numbers}) that a text states: the one scale named without a number, and numbers with a scale.

    A text is read statement by statement and clause by clause; clauses on what is done to the sample beside the
    measurement (storage, drying, melting) state nothing, whatever their numbers.
    """
    named, numbers = set(), {u: [] for u in _SCALES}
    for statement in _STATEMENT.split(text):
        for clause in statement.split(","):
            if _HANDLING.search(clause):
                continue
            for u, n in _EQUATED.findall(clause):
                numbers[u].append(float(n))
            clause = _EQUATED.sub(" ", clause)
            for u, marked in _NUMBERED.items():
                numbers[u] += [float(n) for n in marked.findall(clause)]
            for marked in _NUMBERED.values():
                clause = marked.sub(" ", clause)
            named |= {u for u, w in _NAMED.items() if w.search(clause)}
    return (next(iter(named)) if len(named) == 1 else None), numbers


# an amount ("5 mg/mL", "10 mM") is not the unit of the recorded value
_AMOUNT = re.compile(r"(?<![A-Za-z\d])\d+(?:\.\d+)?\s?(?:[munµμ]?M\b|[munµμ]?g\s?/\s?m?[lL]\b|[munµμ]?mol\s?/\s?[lL]\b)")
_NEGATIVE = re.compile(r"(?:^|[\s(=,:])[-−–]\s?(?:log|lg)|\b(?:minus|negative) (?:the |of )?(?:decadic |common |base-10 )?(?:log|lg)", re.I)
_P_SCALE = re.compile(r"\bpS\b|\bpM\b")
_NATURAL = re.compile(r"\bln\b|\bnapierian\b|\bnatural log|\blog\s?_?e\b", re.I)
_LOGGED = re.compile(r"\blog(?:10|arithm\w*|s)?\b|\blog(?=S\b)|\blg\b|\bdecadic\b", re.I)
_UNLOGGED = re.compile(r"\b(?:not|no|non|without|un)[- ]?(?:a )?log|\blinear\b|\bconcentration itself\b", re.I)
_UNITS = {
    "mass": re.compile(r"\bm?g\s?(?:/|per )\s?m?l\b|\b(?:milli)?grams? (?:/|per )|\bmass (?:conc|solub)", re.I),
    "micro": re.compile(r"[uµμ]M\b|(?i:[uµμ]mol|\bmicromol)"),
    "milli": re.compile(r"\bmM\b|(?i:\bmmol|\bmillimol)"),
    "molar": re.compile(r"\bM\b|(?i:\bmol\s?/\s?l|\bmol\s?(?:l|dm)\s?-|\bmol per |\bmolar)"),
}
_LOGGED_UNIT = {"mass": "log10 g/L", "micro": "log10 umol/L", "milli": "log10 mmol/L", "molar": "log10 mol/L"}


def solubility_words(text: str) -> str | None:
    """Name of the LOG_MOLAR unit that the text states, None if it states none.

    A statement counts if it names a unit of concentration without an amount before it, or a negative logarithm; what
    is taken the logarithm of is read from the same statement.
    """
    for statement in _STATEMENT.split(text):
        t = _AMOUNT.sub(" ", statement)
        unit = next((u for u, w in _UNITS.items() if w.search(t)), None)
        if _NEGATIVE.search(t) or _P_SCALE.search(t):
            return "-log10 mol/L"
        if unit is None:
            continue
        if _UNLOGGED.search(t):
            if unit == "molar":
                return "mol/L"
        elif _NATURAL.search(t):
            if unit == "molar":
                return "ln mol/L"
        elif _LOGGED.search(t):
            return _LOGGED_UNIT[unit]
        elif unit == "molar":
            return "mol/L"
    return None


def _per_text(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """What each text states; a text that occurs again is read once."""
    known: dict[str, tuple] = {}
    for texts in batches:
        out = []
        for t in texts:
            if t is None:
                out.append((None, None, None, None, None))
                continue
            got = known.get(t)
            if got is None:
                if len(known) > 100_000:
                    known.clear()
                scale, numbers = temperature_words(t)
                got = (scale, numbers["F"] or None, numbers["K"] or None, numbers["C"] or None, solubility_words(t))
                if len(t) <= 1000:
                    known[t] = got
            out.append(got)
        yield pd.DataFrame(out, columns=["scale", "f", "k", "c", "solubility"])


def stated(text: Column) -> Column:
    """Struct (scale, f, k, c, solubility) of what a text states; Arrow batches, each distinct text is read once a task."""
    return F.pandas_udf(_per_text, "scale string, f array<double>, k array<double>, c array<double>, solubility string")(text)


def stated_temperature(words: Column, x: Column) -> Column:
    """'F', 'C', 'K' or null: the scale that the text's words (see stated) give for the recorded value.

    A scale named for the measurement stands whatever numbers occur beside it. Else a number with a scale counts if it
    is the recorded value within rounding ('Run at 77 F' beside 77.0).
    """
    says = lambda u: F.coalesce(F.exists(words[u], lambda n: F.abs(n - x) < 0.51), F.lit(False))
    return F.coalesce(words["scale"], F.when(says("f"), "F").when(says("k"), "K").when(says("c"), "C"))


def stated_by_source(registry: DataFrame) -> DataFrame:
    """(source, temp_unit, logs_unit): what the remarks of a source registry say of its units; null where nothing."""
    w = stated(F.col("remark"))
    reg = registry.select(plain_source(F.col("source")).alias("source"), w.alias("w")).where("source IS NOT NULL")
    return reg.groupBy("source").agg(F.max("w.scale").alias("temp_unit"), F.max("w.solubility").alias("logs_unit"))


# -- units by posterior -----------------------------------------------------------------------------------------


def _edges(q: Quantity) -> int:
    return round((q.high - q.low) / q.step)


def _bin(q: Quantity, sql: str) -> str:
    """SQL of the density bin (from 1) of a target value; 0 outside."""
    return f"CASE WHEN ({sql}) >= {q.low} AND ({sql}) < {q.high} THEN CAST(floor((({sql}) - {q.low}) / {q.step}) AS INT) + 1 ELSE 0 END"


def _converted(q: Quantity, unit: str | Column) -> Column:
    return reduce(lambda acc, u: acc.when(unit == u.name, F.expr(u.to_target)), q.units, F.when(F.lit(False), F.lit(None).cast("double")))


def fit_mixture(q: Quantity, counts: DataFrame, usual: dict[str, str]) -> tuple[list[float], dict[str, list[float]]]:
    """(density per bin, {source: weight per unit}) of values whose unit is not stated.

    ``counts`` has (bin, src, bins, slopes, n): values of known unit by their bin of the target scale, the others by
    source and the bins that they fall into under every unit. Bins bound its size. All units share one density on the
    target scale, since they differ by known conversions only; it is estimated from the values of known unit (from the
    usual unit where there are few), and EM fits the weights of the units for each source, starting from its usual unit.
    """
    got = counts.collect()
    rows = [r for r in got if r["bin"] is None]
    nb, nu = _edges(q), len(q.units)
    base = np.zeros(nb + 1)
    for r in got:
        if r["bin"] is not None:
            base[r["bin"]] += r["n"]
    names = [u.name for u in q.units]
    if base[1:].sum() < 30:
        for r in rows:
            base[r["bins"][names.index(usual.get(r["src"], names[0]))]] += r["n"]
    dens = base[1:]
    total = max(dens.sum(), 1.0)
    near = np.convolve(dens, [0.05, 0.15, 0.6, 0.15, 0.05], "same")
    wide = np.convolve(dens, np.ones(41) / 41, "same")
    dens = (0.75 * near + 0.24 * wide) / total + 0.01 / nb
    dens = np.concatenate([[1e-12], dens / dens.sum()])
    weights: dict[str, list[float]] = {}
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["src"], []).append(r)
    for src, rs in by.items():
        n = np.array([r["n"] for r in rs], float)
        like = np.array([[dens[b] * s for b, s in zip(r["bins"], r["slopes"])] for r in rs]) + 1e-300
        prior = np.full(nu, PRIOR / nu)
        prior[names.index(usual.get(src, names[0]))] += 1.0
        w = prior / prior.sum()
        for _ in range(60):
            post = like * w
            post /= post.sum(axis=1, keepdims=True)
            new = (post * n[:, None]).sum(axis=0) + prior * max(PRIOR * n.sum(), 1.0)
            new /= new.sum()
            if np.abs(new - w).max() < 1e-6:
                w = new
                break
            w = new
        weights[src] = [float(x) for x in w]
    return [float(x) for x in dens], weights


def _usual_of(usual: dict[str, str], names: list[str]) -> Column:
    return reduce(lambda acc, su: F.when(F.col("_src") == su[0], su[1]).otherwise(acc), usual.items(), F.lit(names[0]))


def with_units(rows: DataFrame, q: Quantity, usual: dict[str, str] | None = None) -> DataFrame:
    """Adds unit, posterior, how ('text', 'source', 'value') and target to rows of (x, mw, src, stated, by_source, ...).

    Rows whose x is null keep null. The unit is what the text states, else what the source states, as long as the
    value can be in that unit at all (its target lies within the quantity's range, or is null for lack of a molar mass
    or because x is 0); else the source's usual unit unless its
    posterior under the fitted mixture is below 1 - SURE, then the unit of the highest posterior. Only counts by source
    and bin come to the driver.
    """
    usual = usual or {}
    names = [u.name for u in q.units]
    by_mass = [u.name for u in q.units if "mw" in u.to_target]
    fits = lambda unit: F.coalesce(_converted(q, unit).between(q.low, q.high), (F.col("x") == 0) | (unit.isin(by_mass) & F.col("mw").isNull()))
    live = rows.withColumn("_src", F.coalesce("src", F.lit(""))).withColumn("_text", F.when(fits(F.col("stated")), F.col("stated"))).withColumn("_reg", F.when(fits(F.col("by_source")), F.col("by_source")))
    bins = F.array(*[F.expr(_bin(q, u.to_target)) for u in q.units])
    # slopes that depend on the value are taken at the bin of the value itself, on a log scale
    slot = F.when(F.col("x").isNull(), None).otherwise(F.round(F.signum("x") * F.log1p(F.abs("x")) * 50) / 50)
    live = live.withColumn("_unit", F.coalesce("_text", "_reg"))
    at = F.when(F.lit(False), F.lit(0))
    for u in q.units:
        at = at.when(F.col("_unit") == u.name, F.expr(_bin(q, u.to_target)))
    free = lambda c: F.when(F.col("_unit").isNull(), c)
    counts = live.where("x IS NOT NULL").select(at.alias("bin"), free(F.col("_src")).alias("src"), free(bins).alias("bins"), free(slot).alias("slot"), "x")
    counts = counts.groupBy("bin", "src", "bins", "slot").agg(F.count("*").alias("n"), F.avg("x").alias("x")).withColumn("mw", F.lit(None).cast("double"))
    slopes = F.array(*[F.expr(f"CAST({u.slope} AS DOUBLE)") for u in q.units])
    counts = counts.select("bin", "src", "bins", "n", F.when(F.col("bin").isNull(), slopes).alias("slopes"))
    dens, weights = fit_mixture(q, counts, usual)
    table = F.array(*[F.lit(d) for d in dens])
    start = {s: [1.0 if n == usual.get(s, names[0]) else PRIOR / len(names) for n in names] for s in ("",)}
    fitted = rows.sparkSession.createDataFrame([(s, w) for s, w in (start | weights).items()], "_src string, _w array<double>")
    like = F.when(F.col("_unit").isNull() & F.col("x").isNotNull(), F.array(*[F.element_at(table, F.expr(_bin(q, u.to_target)) + 1) * F.expr(f"CAST({u.slope} AS DOUBLE)") for u in q.units]))
    got = live.join(F.broadcast(fitted) if len(weights) <= MOST_SOURCES else fitted, "_src", "left")  # one row per source, checked
    got = got.withColumn("_w", F.coalesce("_w", F.array(*[F.lit(x) for x in start[""]]))).withColumn("_l", F.zip_with(like, "_w", lambda a, b: a * b))
    total = F.aggregate("_l", F.lit(0.0), lambda a, b: a + b)
    got = got.withColumn("_p", F.transform("_l", lambda v: v / total))
    # the usual unit stands unless the value all but excludes it
    own = F.array_position(F.array(*[F.lit(n) for n in names]), _usual_of(usual, names)).cast("int")
    at = F.when(F.element_at("_p", own) >= 1 - SURE, own).otherwise(F.array_position("_p", F.array_max("_p")).cast("int"))
    got = got.withColumn("_at", at)
    best = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_at"))
    here = F.col("x").isNotNull()
    unit = F.when(here, F.coalesce("_unit", best))
    got = got.withColumn("unit", unit).withColumn("how", F.when(here, F.when(F.col("_text").isNotNull(), "text").when(F.col("_reg").isNotNull(), "source").otherwise("value")))
    got = got.withColumn("posterior", F.when(F.col("how") == "value", F.round(F.element_at("_p", F.col("_at")), 6)).when(here, 1.0))
    return got.withColumn("target", _converted(q, F.col("unit"))).drop("_src", "_text", "_reg", "_unit", "_w", "_l", "_p", "_at")


def _measured(unified: DataFrame, registry: DataFrame, scratch: Scratch) -> DataFrame:
    """(rec_key, src, mw, temp_C, logS, words, temp_unit, logs_unit), written once: both fields are read from it twice.

    Sources that the registry lacks are fitted as one: their names may be as many as the rows.
    """
    by = stated_by_source(registry)
    num = lambda c: F.when(usable(F.col(c)), F.col(c)).alias(c)
    base = unified.select(F.col("rec_id").alias("rec_key"), plain_source(F.col("source")).alias("_s"), F.when((F.col("mol_weight") > 0) & ~F.isnan("mol_weight"), F.col("mol_weight")).alias("mw"), num("temp_C"), num("logS"), stated(F.col("assay_description")).alias("words"))
    return scratch.write(base.join(by, base._s == by.source, "left").withColumnRenamed("source", "src").drop("_s"))


FIELDS = {"temp_C": (CELSIUS, lambda x: stated_temperature(F.col("words"), x), "temp_unit"), "logS": (LOG_MOLAR, lambda x: F.col("words.solubility"), "logs_unit")}


def convert_measurements(unified: DataFrame, registry: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(tab, rec_key, field, recorded, unit, how, posterior, uncertain, value) for temp_C and logS of unified.

    value is in °C and log10(mol/L). Placeholders, NaN, infinities and nulls have no unit and a null value; so has a
    mass concentration without a molar mass (its unit is still named). ``uncertain`` marks units got by a posterior
    under SURE. Repeated rows are converted alike; extra columns are ignored; an empty table gives an empty result.
    """
    base, out = _measured(unified, registry, scratch or Scratch(unified.sparkSession, "p6")), []
    for field, (q, says, by) in FIELDS.items():
        rows = base.select("rec_key", "src", "mw", F.col(field).alias("x"), F.when(F.col(field).isNotNull(), says(F.col(field))).alias("stated"), F.col(by).alias("by_source"))
        got = with_units(rows, q)
        out.append(got.select(F.lit("unified").alias("tab"), "rec_key", F.lit(field).alias("field"), F.col("x").alias("recorded"), "unit", "how", "posterior", (F.col("posterior") < SURE).alias("uncertain"), F.col("target").alias("value")))
    return out[0].unionByName(out[1])


def held_out_units(unified: DataFrame, registry: DataFrame, parts: int = 5, scratch: Scratch | None = None) -> DataFrame:
    """(field, unit, rows, right, sure, sure_right): how well the mixtures find units that are stated but hidden from them.

    Every ``parts``-th row by hash loses its text and its source's remark; the mixture fitted on all rows then gives
    its unit. ``sure`` counts those it doesn't flag as uncertain, ``sure_right`` the right ones among them.
    """
    base, out = _measured(unified, registry, scratch or Scratch(unified.sparkSession, "p6")), []
    hide = F.pmod(F.xxhash64("rec_key"), F.lit(parts)) == 0
    for field, (q, says, by) in FIELDS.items():
        truth = F.when(F.col(field).isNotNull(), says(F.col(field)))
        rows = base.withColumn("truth", truth).select("rec_key", "src", "mw", F.col(field).alias("x"), "truth", F.when(~hide, F.col("truth")).alias("stated"), F.when(~hide, F.col(by)).alias("by_source"), hide.alias("hidden"))
        got = with_units(rows, q).where("hidden AND truth IS NOT NULL AND x IS NOT NULL")
        right, sure = F.col("unit") == F.col("truth"), F.col("posterior") >= SURE
        count = lambda c: F.sum(c.cast("long"))
        out.append(got.groupBy(F.lit(field).alias("field"), F.col("truth").alias("unit")).agg(F.count("*").alias("rows"), count(right).alias("right"), count(sure).alias("sure"), count(right & sure).alias("sure_right")))
    return out[0].unionByName(out[1])


def convert_temperatures(challenge: DataFrame) -> DataFrame:
    """Like convert_measurements for temperature_K of the challenge table, in K. Here 0, -999 and 9999 are placeholders
    and numbers may exceed 900: tenths and hundredths of a kelvin occur."""
    t = F.col("temperature_K")
    x = F.when(~F.isnan(t) & (F.abs(t) != float("inf")) & ~t.isin(0.0, -999.0, 9999.0), t)
    rows = challenge.select(F.col("item_no").alias("rec_key"), F.lit(None).cast("string").alias("src"), F.lit(None).cast("double").alias("mw"), x.alias("x"), F.lit(None).cast("string").alias("by_source"), stated(F.col("remark")).alias("words"))
    rows = rows.withColumn("stated", F.when(F.col("x").isNotNull(), stated_temperature(F.col("words"), F.col("x")))).drop("words")
    got = with_units(rows, KELVIN)
    return got.select(F.lit("second_challenge_predict_aqueous_solubility").alias("tab"), "rec_key", F.lit("temperature_K").alias("field"), F.col("x").alias("recorded"), "unit", "how", "posterior", (F.col("posterior") < SURE).alias("uncertain"), F.col("target").alias("value"))


def foreign_units(converted: DataFrame) -> DataFrame:
    """(tab, rec_key, field) of every recorded number that is not in the target unit."""
    target = F.when(F.col("field") == "temp_C", "C").when(F.col("field") == "logS", LOG_MOLAR.units[0].name).otherwise("K")
    return converted.where(F.col("recorded").isNotNull() & (F.col("unit") != target)).select("tab", "rec_key", "field")
