"""Queries of the training-data operators: pN_... is problem N."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.llm import canonical, clusters, leaks, mixing, overlaps, splits, survivors, toxicity
from limpid.llm.oracles import ORACLES
from limpid.runtime import Scratch, table

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def _p1_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_groups(table(spark, d, "folds"), table(spark, d, "unified"), Scratch(spark, "p1"))


def _p1_assigned(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_splits(table(spark, d, "folds"), table(spark, d, "unified"), table(spark, d, "split_plan"), Scratch(spark, "p1"))


def _p1_report(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_report(_p1_assigned(spark, d), table(spark, d, "folds"), table(spark, d, "split_plan"))


def _p1_check(spark: SparkSession, d: str) -> DataFrame:
    return splits.broken_rules(_p1_assigned(spark, d), table(spark, d, "folds"), table(spark, d, "unified"), table(spark, d, "split_plan"), Scratch(spark, "p1"))


def _p2_found(spark: SparkSession, d: str) -> DataFrame:
    return clusters.similarity_clusters(table(spark, d, "unified"), Scratch(spark, "p2"))


def _p2_described(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "p2")
    return clusters.describe_clusters(clusters.similarity_clusters(table(spark, d, "unified"), scratch), scratch)


def _p3_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.best_fields(table(spark, d, "unified"), table(spark, d, "source_registry"), ["logS", "temp_C"])


def _p3_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(table(spark, d, "unified"), table(spark, d, "source_registry"), ["logS", "temp_C", "solvent", "mol_weight"])


def _p4_found(spark: SparkSession, d: str) -> DataFrame:
    return overlaps.cross_split_pairs(table(spark, d, "folds"), table(spark, d, "split_plan"), table(spark, d, "unified"), Scratch(spark, "p4"))


def _p4_report(spark: SparkSession, d: str) -> DataFrame:
    return overlaps.overlap_report(table(spark, d, "folds"), table(spark, d, "split_plan"), table(spark, d, "unified"), Scratch(spark, "p4"))


def _p5_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_values(table(spark, d, "unified"), table(spark, d, "solvent_ref"))


def _p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return canonical.unmatched_values(table(spark, d, "unified"), _p5_found(spark, d))


def _p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).withColumn("coverage", F.round("coverage", 6))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def _p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def _p8_items(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_items(_leaks(spark, d), table(spark, d, "eval_items"))


def _p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), Scratch(spark, "p9"))


def _p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_shares(_p9_mix(spark, d), table(spark, d, "mix_targets"))


def _p9_check(spark: SparkSession, d: str) -> DataFrame:
    return mixing.broken_rules(_p9_mix(spark, d), table(spark, d, "documents"), table(spark, d, "mix_targets"), Scratch(spark, "p9"))


def _p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "doc_labels"))


def _p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _p10_scores(spark, d).where("toxic").select("doc_id")


def _p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.toxic_rates(_p10_scores(spark, d))


QUERIES: dict[str, Query] = {
    "p1_found": _p1_found,
    "p1_assigned": _p1_assigned,
    "p1_report": _p1_report,
    "p1_check": _p1_check,
    "p2_found": _p2_found,
    "p2_described": _p2_described,
    "p3_found": _p3_found,
    "p3_survivors": _p3_survivors,
    "p4_found": _p4_found,
    "p4_report": _p4_report,
    "p5_found": _p5_found,
    "p5_unmatched": _p5_unmatched,
    "p8_found": _p8_found,
    "p8_leaks": _p8_leaks,
    "p8_items": _p8_items,
    "p9_mix": _p9_mix,
    "p9_shares": _p9_shares,
    "p9_check": _p9_check,
    "p10_found": _p10_found,
    "p10_scores": _p10_scores,
    "p10_rates": _p10_rates,
}
