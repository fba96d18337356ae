"""Problem 3: the best representative of each duplicate group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.runtime import clean_key, plain_source, usable

_NEVER = -(1 << 62)
#: A field more doubles the classes of completeness that a group can hold.
MAX_FIELDS = 8


def _has(df: DataFrame, field: str) -> Column:
    """True where the field holds something: a usable number, or text that is not blank."""
    kind = df.schema[field].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return usable(F.col(field).cast("double"))
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(field).rlike(r"\S"), F.lit(False))
    return F.col(field).isNotNull()


def fronts(records: DataFrame, registry: DataFrame, fields: list[str]) -> DataFrame:
    """(inchikey, rows, front) per clean InChIKey; front lists the group's candidates from the best to the worst.

    A candidate is (layer, trust, at, rec_id, mask, v_<field>...); its mask says which fields it holds. Records of
    one key, trust and mask only differ in recency, so the latest of each (ties: lowest rec_id) stands for all: a
    partial aggregation that leaves at most ranks x 2^fields candidates of any group, however hot. One candidate
    dominates another if it is at least as trusted, at least as recent and holds at least its fields. Layer 1 is the
    skyline of undominated candidates, layer 2 that of the rest, and so on. Order: layer, then trust, recency and
    rec_id. Sources the registry lacks come after all ranks, null sources last; a null ingested_at is oldest.
    """
    if len(fields) > MAX_FIELDS:
        raise ValueError(f"at most {MAX_FIELDS} fields")
    ranks = registry.select(plain_source(F.col("source")).alias("_src"), "trust_rank").where("_src IS NOT NULL").groupBy("_src").agg(F.min("trust_rank").alias("_rank"))
    mask = sum((F.when(_has(records, f), 1 << i).otherwise(0) for i, f in enumerate(fields)), F.lit(0))
    base = records.select(clean_key(F.col("InChIKey")).alias("inchikey"), plain_source(F.col("source")).alias("_src"), F.coalesce(F.unix_micros(F.col("ingested_at").cast("timestamp")), F.lit(_NEVER)).alias("at"), F.col("rec_id").cast("long").alias("rec_id"), mask.alias("mask"), *[F.when(_has(records, f), F.col(f)).alias(f"v_{f}") for f in fields])
    base = base.where("inchikey IS NOT NULL AND rec_id IS NOT NULL").join(ranks, "_src", "left")
    trust = F.coalesce(F.col("_rank").cast("long"), F.when(F.col("_src").isNotNull(), 1 << 40).otherwise(1 << 41))
    best = base.withColumn("trust", trust).groupBy("inchikey", "trust", "mask").agg(F.count("*").alias("n"), F.max(F.struct("at", (-F.col("rec_id")).alias("neg"), *[f"v_{f}" for f in fields])).alias("b"))
    one = F.struct("trust", (-F.col("b.at")).alias("back"), (-F.col("b.neg")).alias("rec_id"), (-F.col("mask")).alias("fewer"), "mask", *[F.col(f"b.v_{f}").alias(f"v_{f}") for f in fields])
    held = best.groupBy("inchikey").agg(F.sum("n").alias("rows"), F.array_sort(F.collect_list(one)).alias("c"))

    def dominates(y: Column, x: Column) -> Column:
        return (y.trust <= x.trust) & ((y.back < x.back) | ((y.back == x.back) & (y.rec_id <= x.rec_id))) & (y["mask"].bitwiseAND(x["mask"]) == x["mask"])

    def layered(x: Column, layer: Column) -> Column:
        return F.struct(layer.alias("layer"), *[x[k].alias(k) for k in ("trust", "back", "rec_id", "mask", *[f"v_{f}" for f in fields])])

    none = F.filter(F.transform("c", lambda x: layered(x, F.lit(1))), lambda x: F.lit(False))
    # whoever dominates a candidate comes before it in this order, so its layer is known by then
    peeled = F.aggregate("c", none, lambda acc, x: F.array_append(acc, layered(x, F.coalesce(F.array_max(F.transform(F.filter(acc, lambda y: dominates(y, x)), lambda y: y.layer)), F.lit(0)) + 1)))
    return held.select("inchikey", "rows", F.array_sort(peeled).alias("front"))


def _donor(i: int) -> Column:
    """The first candidate of the front that holds field number i."""
    return F.try_element_at(F.filter("front", lambda y: y["mask"].bitwiseAND(1 << i) != 0), F.lit(1))


def best_fields(records: DataFrame, registry: DataFrame, fields: list[str]) -> DataFrame:
    """(inchikey, field, rec_id): which record supplies each field of every key with two or more rows.

    A field comes from the first candidate of the front that holds it: from the skyline if any of its members does,
    else from the next layers. Fields that no record holds give no row. Copies count as rows. Extra columns are
    ignored, an empty table gives an empty result.
    """
    fr = fronts(records, registry, fields).where("rows >= 2")
    donors = F.array(*[F.struct(F.lit(f).alias("field"), _donor(i).rec_id.alias("rec_id")) for i, f in enumerate(fields)])
    return fr.select("inchikey", F.inline(donors)).where("rec_id IS NOT NULL")


def survivors(records: DataFrame, registry: DataFrame, fields: list[str]) -> DataFrame:
    """One row per clean InChIKey: rows, skyline (candidates in layer 1), rec_id of the best record, each field's value
    and, as <field>_rec_id, the record it was taken from (null where no record holds it)."""
    fr = fronts(records, registry, fields)
    cols = []
    for i, f in enumerate(fields):
        got = _donor(i)
        cols += [got[f"v_{f}"].alias(f), got.rec_id.alias(f"{f}_rec_id")]
    return fr.select("inchikey", "rows", F.size(F.filter("front", lambda y: y.layer == 1)).alias("skyline"), F.col("front")[0].rec_id.alias("rec_id"), *cols)
