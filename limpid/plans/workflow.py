"""Queries of the workflow's smaller steps: labels, defaults, joins of channels, model selection, sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.functions import scalars as S
from limpid.operators import filters, joins, linear, metrics, models, sampling, schema, selection
from limpid.plans.reference import C, M, P, bits, collapsed, measurements, model_names, physics, query, r6
from limpid.runtime import Scratch, table
from limpid.sources import files


@query(r"""SELECT rec_id, coalesce(t, 25.0) AS temp, t IS NULL AS assumed FROM (SELECT rec_id, CASE WHEN t BETWEEN 0 AND 100 THEN t END AS t
FROM (SELECT rec_id, try_cast(regexp_extract(assay_description, '(\d{2,3})\s?(?:deg|degrees|°|C)\b', 1, 'i') AS DOUBLE) AS t FROM unified))""")
def assumed_temperature(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "unified").select("rec_id", S.assumed_temperature(F.col("assay_description")).alias("t")).select("rec_id", "t.*")


@query("SELECT row_uid, fold, 'Phase_' || CAST(fold AS VARCHAR) AS label FROM folds")
def phase_label(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "folds").select("row_uid", "fold", S.numbered_label("Phase_", F.col("fold")).alias("label"))


@query(M + "SELECT rec_id, coalesce(logS, 16.0) AS acid, coalesce(temp_C, -2.0) AS base FROM m")
def pka_defaults(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d)
    return m.select("rec_id", S.pka_or_inert(F.col("logS"), F.col("temp_C")).alias("p")).select("rec_id", "p.*")


@query("SELECT rec_id, smiles_original, smiles_neutral FROM unified")
def select_by_prefix(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "unified")
    return u.select(*schema.prefixed_columns(u, ("smiles_",), ("rec_id",)))


@query("SELECT rec_id, temp_C, logS, mol_weight FROM (SELECT rec_id, CASE WHEN isnan(temp_C) THEN NULL ELSE temp_C END AS temp_C, CASE WHEN isnan(logS) THEN NULL ELSE logS END AS logS, CASE WHEN isnan(mol_weight) THEN NULL ELSE mol_weight END AS mol_weight FROM unified)")
def select_numeric(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "unified")
    return u.select(*schema.numeric_columns(u)).select("rec_id", *[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) for c in ("temp_C", "logS", "mol_weight")])


@query("""WITH a AS (SELECT column_name FROM (DESCRIBE SELECT * FROM unified)), b AS (SELECT column_name FROM (DESCRIBE SELECT * FROM folds))
SELECT coalesce(a.column_name, b.column_name) AS name, CASE WHEN b.column_name IS NULL THEN 'left' WHEN a.column_name IS NULL THEN 'right' ELSE 'both' END AS side FROM a FULL JOIN b USING (column_name)""")
def column_report(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(schema.column_report(table(spark, d, "unified"), table(spark, d, "folds")), "name string, side string")


@query("SELECT vec_id, " + ", ".join(f"CAST(embedding[{i + 1}] > 0 AS TINYINT) AS b{i}" for i in range(64)) + " FROM embeddings")
def expand_bits(spark: SparkSession, d: str) -> DataFrame:
    return schema.expand_bits(bits(spark, d).select("vec_id", "w"), "w", 64, "b").drop("w")


@query(C + """, t AS (SELECT row_uid AS id, min(CASE WHEN isfinite(logS) AND abs(logS) < 900 THEN logS END) AS y_true, count(*) AS n FROM unified WHERE row_uid IS NOT NULL GROUP BY 1)
SELECT c.id, c.fold, c.model, c.y_true, t.y_true AS y_true_truth, t.n FROM c JOIN t ON t.id = c.id""".replace("\n, t", ", t"))
def join_truth(spark: SparkSession, d: str) -> DataFrame:
    truth = measurements(spark, d).where("row_uid IS NOT NULL").groupBy(F.col("row_uid").alias("id")).agg(F.min("logS").alias("y_true"), F.count("*").alias("n"))
    return joins.with_truth(collapsed(spark, d).drop("y_pred"), truth, "id")


@query("""WITH a AS (SELECT row_uid, min(fold) AS fold FROM folds WHERE row_uid IS NOT NULL GROUP BY 1), b AS (SELECT row_uid, min(rec_id) AS rec_id FROM unified WHERE row_uid IS NOT NULL GROUP BY 1)
SELECT a.row_uid, a.fold, b.rec_id, b.rec_id % 5 AS fold_rec FROM a JOIN b USING (row_uid)""")
def join_inner_once(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "folds").select("row_uid", "fold")
    right = table(spark, d, "unified").select("row_uid", "rec_id", (F.col("rec_id") % 5).alias("fold"))
    firsts = right.groupBy("row_uid").agg(F.min("rec_id").alias("rec_id"), F.min_by("fold", "rec_id").alias("fold"))
    return joins.inner_once(left, firsts, "row_uid", ["fold"], "_rec").select("row_uid", "fold", "rec_id", "fold_rec")


@query("""WITH i AS (SELECT unnest([1, 2, 3]) AS iter), s AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), l AS (SELECT lang, count(*) AS k FROM documents GROUP BY 1)
SELECT CAST(iter AS INT) AS iter, s.source, s.n, l.k FROM i, s, (SELECT sum(k) AS k FROM l WHERE lang = 'en') l""".replace("l.k", "CAST(l.k AS BIGINT) AS k"))
def join_channels(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    tables_ = joins.iterations(docs.groupBy("source").agg(F.count("*").alias("n")), 3)
    other = joins.iterations(docs.where("lang = 'en'").agg(F.count("*").alias("k")), 3)
    return tables_.join(other, "iter").select("iter", "source", "n", "k")


@query("""SELECT rec_id, CASE WHEN CAST(('0x' || substr(md5('42|' || rec_id), 1, 8)) AS BIGINT) / 4294967296.0 < 0.8 THEN 'fit' ELSE 'check' END AS part FROM unified""")
def random_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "unified").select("rec_id", sampling.random_split(F.col("rec_id"), {"fit": 0.8, "check": 0.2}).alias("part"))


@query("SELECT rec_id, row_uid FROM unified ORDER BY rec_id DESC LIMIT 100")
def limit_rows(spark: SparkSession, d: str) -> DataFrame:
    return filters.first_rows(table(spark, d, "unified").select("rec_id", "row_uid"), 100, F.desc("rec_id"))


@query(M.rstrip() + """, w AS (SELECT logS, temp_C, 1.5 AS same, CAST(NULL AS DOUBLE) AS none FROM m), v AS (SELECT 'logS' AS feature, var_samp(logS) AS v FROM w UNION ALL SELECT 'temp_C', var_samp(temp_C) FROM w UNION ALL SELECT 'same', var_samp(same) FROM w UNION ALL SELECT 'none', var_samp(none) FROM w)
SELECT feature FROM v WHERE v > 0""")
def variance_threshold(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d).select("logS", "temp_C", F.lit(1.5).alias("same"), F.lit(None).cast("double").alias("none"))
    return spark.createDataFrame([(c,) for c in selection.spread_columns(m, m.columns)], "feature string")


RANKED_MODELS = P.rstrip() + ", s AS (SELECT model, count(*) AS n, sqrt(avg(pow(y_pred - y_true, 2))) AS rmse FROM p GROUP BY model)\n"


@query(RANKED_MODELS + "SELECT CAST(row_number() OVER (ORDER BY rmse, model) AS INT) AS place, model, n, round(rmse, 6) AS rmse FROM s")
def model_ranking(spark: SparkSession, d: str) -> DataFrame:
    per = metrics.regression(collapsed(spark, d), "y_true", "y_pred", ["model"])
    return metrics.ranked(per, "model", "rmse").select("place", "model", "n", *r6("rmse"))


@query(RANKED_MODELS + """SELECT name, value FROM (SELECT 'kind' AS name, 'mean' AS value UNION ALL SELECT 'models', string_agg(model, ',' ORDER BY model) FROM s UNION ALL SELECT 'rows', CAST(CAST(sum(n) AS BIGINT) AS VARCHAR) FROM s
UNION ALL SELECT 'weight of ' || model, CAST(round(1.0 / (SELECT count(*) FROM s), 6) AS VARCHAR) FROM s)""")
def model_card(spark: SparkSession, d: str) -> DataFrame:
    per = {r["model"]: r for r in metrics.regression(collapsed(spark, d), "y_true", "y_pred", ["model"]).collect()}
    card = metrics.model_card("ensemble", "mean", {m: 1 / len(per) for m in per}, {m: r["rmse"] for m, r in per.items()}, sum(r["n"] for r in per.values()))
    root = Scratch(spark, "card").root
    files.write_metrics(spark, card, f"{root}/card.json")
    card = files.read_metrics(spark, f"{root}/card.json")
    rows = [("kind", card["kind"]), ("models", ",".join(card["models"])), ("rows", str(card["rows"])), *((f"weight of {m}", str(w)) for m, w in card["weights"].items())]
    return spark.createDataFrame(rows, "name string, value string")


@query(C + """, w AS (SELECT id, fold, avg(y_pred) AS mean FROM c GROUP BY id, fold HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM c WHERE model IS NOT NULL))
SELECT id, fold, round(mean, 6) AS mean, 0.0::DOUBLE AS nothing FROM w""".replace("\n, w", ", w"))
def ensemble_fallback(spark: SparkSession, d: str) -> DataFrame:
    names = model_names(spark, d)
    w = joins.oof_wide(collapsed(spark, d), names)
    w = linear.ensemble(w, models=[f"oof_{m}" for m in names], name="mean")
    return linear.ensemble(w, name="nothing").select("id", "fold", *r6("mean"), "nothing")


@query("""SELECT 'folds' AS name, row_uid, fold FROM folds UNION ALL SELECT 'absent: missing', NULL, NULL UNION ALL SELECT 'left: skipped', NULL, NULL""")
def source_union(spark: SparkSession, d: str) -> DataFrame:
    f, root = table(spark, d, "folds").select("row_uid", "fold"), Scratch(spark, "sources").root
    files.write_any(f, f"{root}/folds.csv")
    files.write_any(f, f"{root}/left.csv")
    got, left_out = files.read_sources(spark, {"folds": f"{root}/folds.csv", "absent": f"{root}/absent.csv", "left": f"{root}/left.csv"}, skip=("left",), schema=f.schema)
    out = spark.createDataFrame([(f"{k}: {v}", None, None) for k, v in left_out.items()], "name string, row_uid string, fold int")
    for name, df in got.items():
        out = out.unionByName(df.select(F.lit(name).alias("name"), "row_uid", "fold"))
    return out


@query()
def gbt_importance(spark: SparkSession, d: str) -> DataFrame:
    x = physics(spark, d).where("NOT isnan(logS)").withColumn("same", F.lit(1.0))
    names = ["inv_temp", "mw", "same"]
    return spark.createDataFrame([(k, round(v, 6)) for k, v in models.importances(models.fit_full(x, names, "logS", "forest"), names).items()], "feature string, gain double")
