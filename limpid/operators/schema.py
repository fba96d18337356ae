"""Schema operators: mapping to one schema, alignment, encodings, row ids, null handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from limpid.functions.scalars import blank_to_null, celsius, finite, hash_mod, parse_bool, strip, to_number

# Names under which a column of the unified schema may come, the first present one counts.
CANDIDATES = {
    "smiles_original": ("smiles_original", "canonical_smiles", "SMILES", "smiles", "SMILES_Solute"),
    "smiles_neutral": ("smiles_neutral",),
    "solvent": ("solvent", "Solvent", "Medium", "SMILES_Solvent", "Solvent (Solubility (MCS))"),
    "temp_c": ("temp_C", "Temperature_C", "T_C", "Temp_C"),
    "temp_k": ("temperature_K", "Temperature_K", "temp_K", "T_K", "T"),
    "logS": ("logS", "LogS", "logS_molL", "Solubility", "Y", "LogS(mol/L)"),
    "is_outlier": ("is_outlier", "outlier"),
    "source": ("source", "Source", "dataset", "origin"),
}


def first_present(df: DataFrame, names: tuple[str, ...] | list[str], kind: str = "string") -> Column:
    """The first of the names that df has (compared with case), else a null of the kind."""
    name = next((n for n in names if n in df.columns), None)
    return F.lit(None).cast(kind) if name is None else F.col(f"`{name}`")


def unify_schema(df: DataFrame, origin: str) -> DataFrame:
    """The seven unified columns of any measurement table; ``origin`` names the source where no row gives one.

    Temperature comes from a Celsius column, else from a kelvin one, rounded to 0.01; numbers that can't be read are
    null.
    """
    pick = lambda role, kind="string": first_present(df, CANDIDATES[role], kind)
    temp = F.round(F.coalesce(to_number(pick("temp_c")), celsius(to_number(pick("temp_k")))), 2)
    named = pick("source").cast("string")
    return df.select(
        *[pick(c).cast("string").alias(c) for c in ("smiles_original", "smiles_neutral", "solvent")],
        temp.alias("temp_C"),
        to_number(pick("logS")).alias("logS"),
        parse_bool(pick("is_outlier")).alias("is_outlier"),
        (named if _names_any(df, named) else F.lit(origin)).alias("source"),
    )


def _names_any(df: DataFrame, named: Column) -> bool:
    """Whether any row names its source; stops at the first."""
    return any(n in df.columns for n in CANDIDATES["source"]) and not df.where(named.isNotNull()).select(F.lit(1)).isEmpty()


def unify_all(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables under the unified schema, one below the other. Without any table there is no session to plan on: ValueError."""
    parts = [unify_schema(df, name) for name, df in tables.items()]
    if not parts:
        raise ValueError("no table given")
    return reduce(DataFrame.unionByName, parts)


def align_columns(test: DataFrame, train: DataFrame, zero_prefix: str = "solv_") -> DataFrame:
    """test with exactly the columns of train, in its order and types: extra ones go, missing ones are null; columns
    with the prefix are bytes whose nulls are 0."""
    cols = []
    for f in train.schema.fields:
        c = F.col(f"`{f.name}`") if f.name in test.columns else F.lit(None)
        cols.append((F.coalesce(c.cast("byte"), F.lit(0).cast("byte")) if f.name.startswith(zero_prefix) else c.cast(f.dataType)).alias(f.name))
    return test.select(*cols)


def model_features(df: DataFrame, names: list[str]) -> DataFrame:
    """Exactly the named features as doubles; missing columns and values are 0."""
    return df.select(*[(F.coalesce(to_number(F.col(f"`{n}`")), F.lit(0.0)) if n in df.columns else F.lit(0.0)).alias(n) for n in names])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def prefixed_columns(df: DataFrame, prefixes: tuple[str, ...], keep: tuple[str, ...] = ()) -> list[str]:
    """Columns whose name begins with one of the prefixes, and those to keep, in their order."""
    return [c for c in df.columns if c in keep or c.startswith(prefixes)]


def column_report(left: DataFrame, right: DataFrame) -> list[tuple[str, str]]:
    """(column, 'both' | 'left' | 'right') of two tables, by name."""
    a, b = set(left.columns), set(right.columns)
    return sorted((c, "both" if c in a & b else "left" if c in a else "right") for c in a | b)


def one_hot(df: DataFrame, column: str, prefix: str, most: int = 1000) -> DataFrame:
    """A byte column prefix + value for every distinct value of a column (null is 'nan'); at most ``most`` values."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
    values = sorted(r[0] for r in df.select(text.alias("v")).distinct().limit(most + 1).collect())
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values")
    return df.select("*", *[(text == v).cast("byte").alias(f"{prefix}{v}") for v in values])


def hash_one_hot(df: DataFrame, column: str, prefix: str, bins: int = 128) -> DataFrame:
    """bins byte columns prefix_000..., 1 in the one that SHA-1 of the value falls into."""
    slot = hash_mod(F.col(column), bins)
    return df.select("*", slot.alias("_slot")).select(*df.columns, *[(F.col("_slot") == i).cast("byte").alias(f"{prefix}_{i:03d}") for i in range(bins)])


def frequency_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Share of the rows that hold the row's value; null for null. Two aggregates and a join, no window over all rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    total = df.agg(F.count("*").alias("_all"))
    shares = counts.crossJoin(F.broadcast(total)).select("_v", (F.col("_n") / F.col("_all")).alias(name))  # one row
    return df.join(shares, df[column] == shares["_v"], "left").drop("_v")


def row_uid(key: Column, solvent: Column, temp_c: Column) -> Column:
    """key|solvent|temperature with one decimal; nulls become UNKNOWN and NA."""
    return F.concat_ws("|", F.coalesce(key, F.lit("UNKNOWN")), F.coalesce(solvent, F.lit("UNKNOWN")), F.when(temp_c.isNotNull(), F.format_string("%.1f", F.round(temp_c, 1))).otherwise("NA"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in the given order (ties are set by the remaining columns' order given)."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", first).where("_rn = 1").drop("_rn")


def concat_distinct(parts: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Parts one below the other without their fold column, one row per key: that of the earliest part, then by order."""
    out = None
    for i, part in enumerate(parts):
        part = part.drop("fold").withColumn("_part", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return keep_first(out, [key], ["_part", *order]).drop("_part")


def drop_null_rows(df: DataFrame, needles: tuple[str, ...] = ("smiles_neutral", "row_uid"), also: tuple[str, ...] = ()) -> DataFrame:
    """Infinities and NaN become null, blank texts too; then rows go that are null in a column whose name contains one
    of the needles, or in one of ``also``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = finite(c)
        elif isinstance(f.dataType, T.StringType):
            c = blank_to_null(c)
        cols.append(c.alias(f.name))
    must = [c for c in df.columns if any(n in c for n in needles) or c in also]
    out = df.select(*cols)
    return out.dropna(how="any", subset=must) if must else out


def normal_id(col: Column) -> Column:
    """Ids as text without white space around them."""
    return strip(col.cast("string"))


def expand_bits(df: DataFrame, words: str, bits: int, prefix: str) -> DataFrame:
    """Byte columns prefix0, prefix1, ... from an array of 64-bit words; only for consumers that need columns."""
    return df.select("*", *[F.shiftright(F.col(words)[i // 64], i % 64).bitwiseAND(1).cast("byte").alias(f"{prefix}{i}") for i in range(bits)])
