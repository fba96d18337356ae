"""Readers and writers of files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names by which a header is told to be of a measurement or a solvent table.
MEASUREMENT_HEADER = {"smiles_solute", "smiles_solvent", "solvent", "temperature_k", "logs(mol/l)", "solubility(mol/l)"}
SOLVENT_HEADER = {"solvent", "smiles_solvent", "density_g/cm^3", "cas", "boiling_point"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header; malformed rows become nulls. Give a schema to spare the pass that infers one."""
    r = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("encoding", encoding).option("quote", '"').option("escape", '"')
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The most frequent of , ; tab | in the first line."""
    first = spark.read.text(path).first()
    line = first[0] if first else ""
    return max(",;\t|", key=lambda d: (line.count(d), -",;\t|".index(d)))


def read_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet, JSON, CSV, TSV or text with a sniffed delimiter, by the suffix (.gz is looked through)."""
    name = path.rstrip("/").lower().removesuffix(".gz")
    if name.endswith((".parquet", ".pq")):
        return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    if name.endswith(".json"):
        return spark.read.schema(schema).json(path) if schema is not None else spark.read.json(path)
    if name.endswith((".tsv", ".tab")):
        return read_csv(spark, path, schema, "\t")
    if name.endswith(".csv"):
        return read_csv(spark, path, schema)
    if name.endswith(".txt"):
        return read_csv(spark, path, schema, sniff_delimiter(spark, path))
    raise ValueError(f"no reader for {path}")


def read_auto(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text whatever its delimiter; falls back to Latin-1 where UTF-8 leaves replacement characters in the header."""
    sep = sniff_delimiter(spark, path)
    df = read_csv(spark, path, sep=sep)
    return read_csv(spark, path, sep=sep, encoding="ISO-8859-1") if any("�" in c for c in df.columns) else df


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The file, or an empty table of the schema if there is none or it can't be read."""
    try:
        return read_any(spark, path, schema)
    except (AnalysisException, ValueError):
        return spark.createDataFrame([], schema)


def header_kind(columns: list[str]) -> str | None:
    """'main' for a measurement table, 'solvent' for a solvent table, None for neither."""
    names = {c.strip().lower() for c in columns}
    main, solvent = len(names & MEASUREMENT_HEADER), len(names & SOLVENT_HEADER)
    if main >= 3 and main >= solvent:
        return "main"
    return "solvent" if solvent >= 2 else None


def rank_files(files: list[tuple[str, int, list[str]]], kind: str = "main") -> list[str]:
    """File names (given as name, size, header), the best first: score by header (2 main, 1 solvent, -1 neither, and
    -1 where the kind asked for is another), then size, then name."""
    def score(header: list[str]) -> int:
        got = header_kind(header)
        return -1 if got is None or (kind != "auto" and got != kind) else 2 if got == "main" else 1

    return [n for n, _, _ in sorted(files, key=lambda f: (-score(f[2]), -f[1], f[0]))]


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, md5) of files, to verify downloads."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.md5("content").alias("md5"))


def write_any(df: DataFrame, path: str, single: bool = False) -> None:
    """Overwrites a Parquet, CSV, TSV or JSON output by suffix; ``single`` asks for one part file (small results)."""
    df = df.coalesce(1) if single else df
    w, name = df.write.mode("overwrite"), path.rstrip("/").lower()
    if name.endswith(".csv"):
        w.option("header", True).option("lineSep", "\n").csv(path)
    elif name.endswith(".tsv"):
        w.option("header", True).option("sep", "\t").option("lineSep", "\n").csv(path)
    elif name.endswith(".json"):
        w.json(path)
    else:
        w.parquet(path)


def write_empty(spark: SparkSession, schema: T.StructType, path: str) -> None:
    write_any(spark.createDataFrame([], schema), path)


def publish(spark: SparkSession, source: str, target: str) -> None:
    """Copies a table to a second place."""
    read_any(spark, source).write.mode("overwrite").parquet(target)


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """A small JSON document as one text file."""
    spark.createDataFrame([(json.dumps(metrics, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_sources(spark: SparkSession, paths: dict[str, str], skip: tuple[str, ...] = (), schema: T.StructType | str | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """({name: table}, {name: reason}) of the sources that are to be read: those skipped or without a file are named with
    the reason instead; a source that is there but can't be read is an error."""
    tables, left_out = {}, {}
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    for name, path in paths.items():
        at = jvm.org.apache.hadoop.fs.Path(path)
        if name in skip:
            left_out[name] = "skipped"
        elif not at.getFileSystem(conf).exists(at):
            left_out[name] = "missing"
        else:
            tables[name] = read_any(spark, path, schema)
    return tables, left_out
