"""Session helpers shared by all operators: table access, durable intermediate tables, scalar clean-up rules."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Readings whose absolute value reaches this are placeholders (-999, 9999), not measurements.
PLACEHOLDER_FROM = 900.0
_OWN_DIR: list[str] = []
_ROOTS: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or a temporary one where the session names none (local runs)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="limpid-"))
        atexit.register(shutil.rmtree, _OWN_DIR[0], ignore_errors=True)
    return f"file://{_OWN_DIR[0]}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clean_up() -> None:
    """Deletes all intermediate tables of this process; results that were not read by now can't be read afterwards.
    Runs when the process ends, as long as its session still lives."""
    while _ROOTS:
        spark, root = _ROOTS.pop()
        try:
            _delete(spark, root)
        except Exception:  # noqa: BLE001 - the session is gone, and nothing more can be done
            return


class Scratch:
    """Intermediate tables written to the shared folder: they cut lineage and survive the loss of executors.

    ``write`` materialises a frame as Parquet and returns the frame read back; ``drop`` deletes a table that no
    later step reads. Tables which the returned result still needs are deleted by ``clean_up`` at the end of the process.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._n = 0
        if not _ROOTS:
            atexit.register(clean_up)
        _ROOTS.append((spark, self.root))

    def write(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/t{self._n}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = path
        back._limpid_keep = self  # the id stays valid as long as the frame lives
        return back

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if path := self._paths.pop(id(df), None):
                _delete(self.spark, path)


def clean_key(col: Column) -> Column:
    """InChIKey in its one writing: upper case, no blanks around it, no leading ``InChIKey=``; blank becomes null."""
    bare = F.regexp_replace(F.upper(col), r"^\s*(INCHIKEY=)?\s*|\s+$", "")
    return F.when(bare != "", bare)


def spelled(col: Column) -> Column:
    """A structure that is really written: null for null, ``''`` and ``'nan'``."""
    return F.when(~col.isin("", "nan"), col)


def usable(col: Column) -> Column:
    """True for a number that is no null, NaN, infinity or placeholder; never null."""
    return F.coalesce(~F.isnan(col) & (F.abs(col) < PLACEHOLDER_FROM), F.lit(False))


def plain_source(col: Column) -> Column:
    """Source name as the registry writes it: lower case, no blanks around it; blank becomes null."""
    bare = F.regexp_replace(F.lower(col), r"^\s+|\s+$", "")
    return F.when(bare != "", bare)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones which clash with no column of df (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def as_double(df: DataFrame, name: str) -> Column:
    """Column as double, whatever its type; text that is no number becomes null."""
    return F.col(name) if isinstance(df.schema[name].dataType, T.DoubleType) else F.expr(f"try_cast(`{name}` AS DOUBLE)")
