"""Queries of the core operators on the domain tables, each with the SQL that it is checked against."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.functions import chemistry
from limpid.functions import scalars as S
from limpid.operators import consensus, filters, joins, linear, metrics, models, outliers, sampling, schema, selection, similarity
from limpid.plans import pipelines
from limpid.runtime import Scratch, clean_key, plain_source, table, usable
from limpid.sources import files
from limpid.streaming import score

MODELS_SQL = "SELECT DISTINCT model FROM oof WHERE model IS NOT NULL"


def measurements(spark: SparkSession, d: str) -> DataFrame:
    """unified with one writing of key and source, and numbers that are no placeholders."""
    u = table(spark, d, "unified")
    num = lambda c: F.when(usable(F.col(c)), F.col(c)).alias(c)
    return u.select("rec_id", "row_uid", clean_key(F.col("InChIKey")).alias("InChIKey"), "smiles_original", "smiles_neutral", "solvent", num("temp_C"), num("logS"), "is_outlier", plain_source(F.col("source")).alias("source"), num("mol_weight"), "assay_description")


#: The same view for DuckDB.
M = r"""WITH m AS (SELECT rec_id, row_uid,
  nullif(regexp_replace(upper(InChIKey), '^\s*(INCHIKEY=)?\s*|\s+$', '', 'g'), '') AS InChIKey, smiles_original, smiles_neutral, solvent,
  CASE WHEN isfinite(temp_C) AND abs(temp_C) < 900 THEN temp_C END AS temp_C,
  CASE WHEN isfinite(logS) AND abs(logS) < 900 THEN logS END AS logS, is_outlier,
  nullif(regexp_replace(lower(source), '^\s+|\s+$', '', 'g'), '') AS source,
  CASE WHEN isfinite(mol_weight) AND abs(mol_weight) < 900 THEN mol_weight END AS mol_weight, assay_description FROM unified)
"""
WATER = r"lower(regexp_replace(solvent, '^\s+|\s+$', '', 'g')) = 'water'"


def collapsed(spark: SparkSession, d: str) -> DataFrame:
    return joins.oof_collapse(table(spark, d, "oof"))


def model_names(spark: SparkSession, d: str) -> list[str]:
    return sorted(r[0] for r in table(spark, d, "oof").select("model").where("model IS NOT NULL").distinct().collect())


C = r"""WITH c AS (SELECT regexp_replace(id, '^\s+|\s+$', '', 'g') AS id, fold, model,
  min(CASE WHEN isfinite(y_true) THEN y_true END) AS y_true, avg(CASE WHEN isfinite(y_pred) THEN y_pred END) AS y_pred
  FROM oof WHERE id IS NOT NULL GROUP BY 1, 2, 3)
"""
P = C.rstrip() + ", p AS (SELECT * FROM c WHERE y_true IS NOT NULL AND y_pred IS NOT NULL)\n"


def r6(*names: str) -> list:
    return [F.round(F.col(n), 6).alias(n) for n in names]


QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        name = f.__name__
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


# -- schema, projections, scalar functions ----------------------------------------------------------------------


@query("""SELECT smiles_original, smiles_neutral, solvent, round(temp_C, 2) AS temp_C, CASE WHEN isfinite(logS) THEN logS END AS logS, is_outlier, source
FROM (SELECT smiles_original, smiles_neutral, solvent, CASE WHEN isfinite(temp_C) THEN temp_C END AS temp_C, logS, is_outlier, source FROM unified)
UNION ALL SELECT smiles, NULL, solvent, round(CASE WHEN isfinite(temperature_K) THEN temperature_K END - 273.15, 2), CASE WHEN isfinite(logS) THEN logS END, NULL, 'challenge'
FROM second_challenge_predict_aqueous_solubility""")
def unify_schema(spark, d):
    return schema.unify_all({"unified": table(spark, d, "unified"), "challenge": table(spark, d, "second_challenge_predict_aqueous_solubility")})


@query(r"""SELECT rec_id, CASE WHEN lower(x) IN ('true','1','yes','y','t','1.0') THEN true WHEN lower(x) IN ('false','0','no','n','f','0.0') THEN false END AS flag,
try_cast(regexp_extract(row_uid, '(\d+)', 1) AS DOUBLE) AS number
FROM (SELECT rec_id, row_uid, CASE rec_id % 7 WHEN 0 THEN ' Yes' WHEN 1 THEN 'n ' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0' WHEN 4 THEN 'maybe' WHEN 5 THEN '' END AS t0, trim(CASE rec_id % 7 WHEN 0 THEN ' Yes' WHEN 1 THEN 'n ' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0' WHEN 4 THEN 'maybe' WHEN 5 THEN '' END) AS x FROM unified)""")
def coercions(spark, d):
    u = table(spark, d, "unified").withColumn("t", F.when(F.col("rec_id") % 7 < 6, F.try_element_at(F.array(*[F.lit(x) for x in (" Yes", "n ", "TRUE", "0", "maybe", "")]), (F.col("rec_id") % 7 + 1).cast("int"))))
    return u.select("rec_id", S.parse_bool(F.col("t")).alias("flag"), S.to_number(F.regexp_extract("row_uid", r"(\d+)", 1)).alias("number"))


@query(r"""SELECT rec_id, CASE WHEN t BETWEEN 0 AND 100 THEN t END AS text_temp FROM (SELECT rec_id, try_cast(regexp_extract(assay_description, '(\d{2,3})\s?(?:deg|degrees|°|C)\b', 1, 'i') AS DOUBLE) AS t FROM unified)""")
def extract_temperature(spark, d):
    return table(spark, d, "unified").select("rec_id", S.text_temperature(F.col("assay_description")).alias("text_temp"))


UNITS = ["M", "mM", "uM", "µM", "nM", "mol/L", "mmol/L", "ug.mL-1", "ug/mL", "mcg/mL", "ng/mL", "mg/mL", "mg/L", "g/L", " mM ", "", "furlong"]


@query(M + f"""SELECT rec_id, unit, kind, round(CASE WHEN v > 0 AND mol_weight > 0 THEN CASE WHEN u = '' AND contains(lower(kind), 'log') THEN v
  WHEN u IN ('M', 'mol/L') THEN log10(v) WHEN u IN ('mM', 'mmol/L') THEN log10(v * 1e-3) WHEN u IN ('uM', 'µM') THEN log10(v * 1e-6) WHEN u = 'nM' THEN log10(v * 1e-9)
  WHEN u IN ('mg/mL', 'g/L') THEN log10(v / mol_weight) WHEN u IN ('ug.mL-1', 'ug/mL', 'mcg/mL', 'mg/L') THEN log10(v * 1e-3 / mol_weight) WHEN u = 'ng/mL' THEN log10(v * 1e-6 / mol_weight) END END, 6) AS log_s
FROM (SELECT *, trim(unit) AS u FROM (SELECT rec_id, abs(logS) * 10 - 5 AS v, mol_weight, unnest({UNITS}) AS unit FROM m), (SELECT unnest(['Solubility', 'LogS']) AS kind))""")
def unit_to_logs(spark, d):
    m = measurements(spark, d).select("rec_id", (F.abs("logS") * 10 - 5).alias("v"), "mol_weight", F.explode(F.array(*[F.lit(x) for x in UNITS])).alias("unit"))
    m = m.withColumn("kind", F.explode(F.array(F.lit("Solubility"), F.lit("LogS"))))
    return m.select("rec_id", "unit", "kind", F.round(S.log_solubility(F.col("v"), F.col("unit"), F.col("kind"), F.col("mol_weight")), 6).alias("log_s"))


@query(M + "SELECT rec_id, round(1000.0 / (coalesce(temp_C, 25.0) + 273.15), 9) AS inv_temp, round(temp_C + 273.15, 6) AS temp_k FROM m")
def inv_temperature(spark, d):
    return measurements(spark, d).select("rec_id", F.round(S.inverse_temperature(F.col("temp_C")), 9).alias("inv_temp"), F.round(F.col("temp_C") + 273.15, 6).alias("temp_k"))


PKA_SQL = "CASE WHEN rec_id % 3 = 0 THEN NULL ELSE 3.0 + rec_id % 7 END"
PKB_SQL = "CASE WHEN rec_id % 4 = 0 THEN NULL ELSE 6.0 + rec_id % 5 END"


def with_pka(df: DataFrame) -> DataFrame:
    """Made-up dissociation constants: the engine takes them as columns."""
    return df.withColumn("pka", F.expr(PKA_SQL).cast("double")).withColumn("pkb", F.expr(PKB_SQL).cast("double"))


@query(f"""SELECT rec_id, round(1 / (1 + CASE WHEN a IS NULL THEN 0 ELSE pow(10, 7.4 - a) END + CASE WHEN b IS NULL THEN 0 ELSE pow(10, b - 7.4) END), 6) AS neutral
FROM (SELECT rec_id, CAST({PKA_SQL} AS DOUBLE) AS a, CAST({PKB_SQL} AS DOUBLE) AS b FROM unified)""")
def neutral_fraction(spark, d):
    return with_pka(table(spark, d, "unified")).select("rec_id", F.round(S.neutral_fraction(F.lit(7.4), F.col("pka"), F.col("pkb")), 6).alias("neutral"))


@query(M.replace("WITH m", "WITH RECURSIVE m", 1).rstrip() + f""", x AS (SELECT m.rec_id, logS, pow(10, logS) AS s, a, b FROM m JOIN (SELECT rec_id, CAST({PKA_SQL} AS DOUBLE) AS a, CAST({PKB_SQL} AS DOUBLE) AS b FROM unified) USING (rec_id) WHERE logS IS NOT NULL),
r AS (SELECT *, -2.0::DOUBLE AS lo, 16.0::DOUBLE AS hi, 0 AS i FROM x UNION ALL SELECT rec_id, logS, s, a, b, CASE WHEN f > 0 THEN mid ELSE lo END, CASE WHEN f > 0 THEN hi ELSE mid END, i + 1
  FROM (SELECT *, s * (coalesce(1 / (1 + pow(10, mid - b)), 0) - coalesce(1 / (1 + pow(10, a - mid)), 0)) + pow(10, -mid) - pow(10, mid - 14) AS f FROM (SELECT *, (lo + hi) / 2 AS mid FROM r WHERE i < 40))),
n AS (SELECT rec_id, (lo + hi) / 2 AS ph, logS, a, b FROM r WHERE i = 40)
SELECT rec_id, round(ph, 4) AS ph_sat, round(log10(greatest(pow(10, logS) / (1 + coalesce(pow(10, ph - a), 0) + coalesce(pow(10, b - ph), 0)), 1e-15) / greatest(1 / (1 + coalesce(pow(10, 7.4 - a), 0) + coalesce(pow(10, b - 7.4), 0)), 1e-12)), 3) AS logs_eff FROM n""")
def effective_solubility(spark, d):
    x = with_pka(measurements(spark, d)).where("logS IS NOT NULL")
    acids, bases = (F.filter(F.array(c), lambda v: v.isNotNull()) for c in ("pka", "pkb"))
    x = x.withColumn("ph_sat", S.saturation_ph(F.col("logS"), acids, bases))
    return x.select("rec_id", F.round("ph_sat", 4).alias("ph_sat"), S.effective_log_s(F.col("logS"), F.col("ph_sat"), F.lit(7.4), F.col("pka"), F.col("pkb")).alias("logs_eff"))


@query(M + r"""SELECT rec_id, concat_ws('|', coalesce(InChIKey, 'UNKNOWN'), coalesce(solvent, 'UNKNOWN'), coalesce(printf('%.1f', round(temp_C, 1)), 'NA')) AS uid FROM m""")
def row_uid(spark, d):
    return measurements(spark, d).select("rec_id", schema.row_uid(F.col("InChIKey"), F.col("solvent"), F.col("temp_C")).alias("uid"))


@query("""SELECT rec_id, """ + ", ".join(f"CAST(s = '{v}' AS TINYINT) AS \"src_{v}\"" for v in ("bigsol_compiled", "certified_ref", "challenge_round2", "chembl_extract", "inhouse_eln", "legacy_cards", "nan", "partner_cro", "reaxys_export", "student_course", "thermo_station", "web_scrape")) + r""" FROM (SELECT rec_id, coalesce(nullif(regexp_replace(lower(source), '^\s+|\s+$', '', 'g'), ''), 'nan') AS s FROM unified)""")
def one_hot(spark, d):
    return schema.one_hot(measurements(spark, d).select("rec_id", "source"), "source", "src_").drop("source")


@query("SELECT row_uid, fold, " + ", ".join(f"CAST(b = {i} AS TINYINT) AS ik_{i:03d}" for i in range(16)) + " FROM (SELECT row_uid, fold, ('0x' || right(sha1(coalesce(CAST(cluster_ecfp4_0p7 AS VARCHAR), '')), 1))::INT AS b FROM folds)")
def hash_one_hot(spark, d):
    return schema.hash_one_hot(table(spark, d, "folds").select("row_uid", "fold", "cluster_ecfp4_0p7"), "cluster_ecfp4_0p7", "ik", 16).drop("cluster_ecfp4_0p7")


@query(M + "SELECT rec_id, round(CASE WHEN InChIKey IS NULL THEN NULL ELSE CAST(count(*) OVER (PARTITION BY InChIKey) AS DOUBLE) / (SELECT count(*) FROM m) END, 9) AS freq FROM m")
def frequency_encode(spark, d):
    return schema.frequency_encode(measurements(spark, d).select("rec_id", "InChIKey"), "InChIKey", "freq").select("rec_id", F.round("freq", 9).alias("freq"))


@query("SELECT rec_id, CAST(NULL AS DOUBLE) AS rdkit, CAST(coalesce(CASE WHEN solvent = 'water' THEN 1 ELSE 0 END, 0) AS TINYINT) AS solv_water, CAST(0 AS TINYINT) AS solv_other, logS FROM unified")
def align_columns(spark, d):
    u = table(spark, d, "unified")
    test = u.select("logS", "rec_id", (F.col("solvent") == "water").cast("byte").alias("solv_water"), F.lit(1).alias("extra"))
    train = u.limit(0).select("rec_id", F.lit(None).cast("double").alias("rdkit"), F.lit(0).cast("byte").alias("solv_water"), F.lit(0).cast("byte").alias("solv_other"), "logS")
    return schema.align_columns(test, train)


@query("SELECT rec_id, smiles_neutral, row_uid, CASE WHEN isfinite(logS) THEN logS END AS logS FROM unified WHERE regexp_matches(smiles_neutral, '\\S') AND regexp_matches(row_uid, '\\S')")
def drop_null_rows(spark, d):
    return schema.drop_null_rows(table(spark, d, "unified").select("rec_id", "smiles_neutral", "row_uid", "logS"))


@query("SELECT rec_id, coalesce(CASE WHEN isfinite(logS) THEN logS END, 0.0) AS \"logS\", 0.0::DOUBLE AS absent FROM unified")
def model_features(spark, d):
    u = table(spark, d, "unified")
    return schema.model_features(u, ["rec_id", "logS", "absent"]).withColumn("rec_id", F.col("rec_id").cast("long"))


# -- filters ----------------------------------------------------------------------------------------------------


@query(f"SELECT rec_id, solvent FROM unified WHERE {WATER}")
def filter_water(spark, d):
    return filters.equals(table(spark, d, "unified").select("rec_id", "solvent"), "solvent", "water")


@query("SELECT rec_id, temp_C FROM unified WHERE isfinite(temp_C) AND temp_C BETWEEN 24 AND 50")
def filter_temperature(spark, d):
    return filters.in_range(table(spark, d, "unified").select("rec_id", "temp_C"), "temp_C", 24, 50)


@query("SELECT rec_id, temp_C FROM unified WHERE isfinite(temp_C) AND temp_C > 24 AND temp_C < 50")
def filter_temperature_strict(spark, d):
    return filters.in_range(table(spark, d, "unified").select("rec_id", "temp_C"), "temp_C", 24, 50, strict=True)


@query("SELECT rec_id FROM unified WHERE temp_C IS NULL OR NOT isfinite(temp_C) OR temp_C <= 37")
def filter_temperature_keep_null(spark, d):
    return filters.in_range(table(spark, d, "unified").select("rec_id", "temp_C"), "temp_C", None, 37, keep_null=True).select("rec_id")


@query("SELECT rec_id FROM unified WHERE is_outlier = false")
def filter_outlier(spark, d):
    return filters.unflagged(table(spark, d, "unified").select("rec_id", "is_outlier"))


@query("SELECT rec_id, logS FROM unified WHERE isfinite(logS) AND logS < -5.0")
def filter_threshold(spark, d):
    return filters.below(table(spark, d, "unified").select("rec_id", "logS"), "logS", -5.0)


@query("SELECT rec_id, row_uid FROM unified WHERE row_uid IN (SELECT row_uid FROM folds WHERE fold = 4)")
def filter_members(spark, d):
    return filters.members(table(spark, d, "unified").select("rec_id", "row_uid"), table(spark, d, "folds").where("fold = 4"), "row_uid")


# -- outliers, consensus ----------------------------------------------------------------------------------------


def _z_sql(slot: str, standard: bool = False, prefix: str = "") -> str:
    mid = "SELECT b, count(*) AS n, avg(logS) AS mid, stddev_samp(logS) AS spread FROM x WHERE b IS NOT NULL GROUP BY b" if standard else "SELECT b, max(n) AS n, max(mid) AS mid, 1.4826 * median(abs(logS - mid)) AS spread FROM x JOIN (SELECT b, count(*) AS n, median(logS) AS mid FROM x WHERE b IS NOT NULL GROUP BY b) USING (b) GROUP BY b"
    return M.rstrip() + f""", v AS (SELECT * FROM m), e AS (SELECT min(temp_C) AS lo, max(temp_C) AS hi FROM m), {prefix}
x AS (SELECT rec_id, logS, CASE WHEN logS IS NOT NULL AND temp_C IS NOT NULL THEN {slot} END AS b FROM m, e), s AS ({mid})
SELECT rec_id, CAST(coalesce(CASE WHEN n >= 8 AND spread > 0 AND abs((logS - mid) / spread) > 3 THEN 1 END, 0) AS INT) AS is_outlier FROM x LEFT JOIN s USING (b)"""


@query(_z_sql("CAST(greatest(least(ceil((temp_C - lo) / ((hi - lo) / 10)), 10), 1) AS INT)"))
def outlier_robust_width(spark, d):
    return outliers.flag_outliers(measurements(spark, d).select("rec_id", "logS", "temp_C")).select("rec_id", "is_outlier")


@query(_z_sql("CAST(greatest(least(ceil((temp_C - lo) / ((hi - lo) / 10)), 10), 1) AS INT)", True))
def outlier_standard(spark, d):
    return outliers.flag_outliers(measurements(spark, d).select("rec_id", "logS", "temp_C"), method="standard").select("rec_id", "is_outlier")


@query(_z_sql("(SELECT count(*) FROM q WHERE k > a AND k < z AND k < temp_C)", False, "q0 AS (SELECT quantile_cont(temp_C, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM m), q AS (SELECT DISTINCT unnest(q) AS k, q[1] AS a, q[6] AS z FROM q0),"))
def outlier_robust_quantile(spark, d):
    return outliers.flag_outliers(measurements(spark, d).select("rec_id", "logS", "temp_C"), mode="quantile", bins=5).select("rec_id", "is_outlier")


@query(_z_sql("CAST(greatest(ceil((temp_C - lo) / 25.0), 1) AS INT)"))
def outlier_fixed_width(spark, d):
    return outliers.flag_outliers(measurements(spark, d).select("rec_id", "logS", "temp_C"), width=25.0).select("rec_id", "is_outlier")


CONS = M.rstrip() + """, k AS (SELECT *, coalesce(solvent, 'UNKNOWN') AS s, coalesce(temp_C, -9999.0) AS t FROM m WHERE InChIKey IS NOT NULL),
g AS (SELECT InChIKey, s, t, count(*) AS n, count(logS) AS held, median(logS) AS mid, min(logS) AS lo, max(logS) AS hi FROM k GROUP BY ALL),
a AS (SELECT k.*, n, held, mid, lo, hi, abs(logS - mid) <= 0.7 AS near FROM k JOIN g USING (InChIKey, s, t)),
"""


@query(CONS + """f AS (SELECT InChIKey, s, t, min(rec_id) AS rec_id, max(n) AS n, max(held) AS held, avg(CASE WHEN near THEN logS END) AS mean FROM a GROUP BY ALL)
SELECT f.InChIKey, m.solvent, m.temp_C, f.rec_id, round(CASE WHEN f.n > 1 AND mean IS NOT NULL THEN mean ELSE m.logS END, 6) AS logS FROM f JOIN m USING (rec_id) WHERE f.n = 1 OR f.held = 0 OR mean IS NOT NULL""")
def consensus_dedup(spark, d):
    m = measurements(spark, d).select("rec_id", "InChIKey", "solvent", "temp_C", "logS")
    return consensus.consensus(m, ["rec_id"]).select("InChIKey", "solvent", "temp_C", "rec_id", F.round("logS", 6).alias("logS"))


@query(CONS + """w AS (SELECT InChIKey, s AS solvent, t AS temp_C, max(n) AS "rows", round(max(mid), 6) AS median, max(lo) AS low, max(hi) AS high, CAST(count(*) FILTER (near) AS BIGINT) AS kept FROM a GROUP BY ALL)
SELECT * FROM w WHERE "rows" > 1 AND high - low > 1.4""")
def dedup_conflicts(spark, d):
    m = measurements(spark, d).select("rec_id", "InChIKey", "solvent", "temp_C", "logS")
    return consensus.conflicts(m).withColumn("median", F.round("median", 6))


@query("SELECT row_uid, min(rec_id) AS rec_id FROM unified WHERE row_uid IS NOT NULL GROUP BY row_uid")
def keep_first(spark, d):
    return schema.keep_first(table(spark, d, "unified").where("row_uid IS NOT NULL").select("row_uid", "rec_id"), ["row_uid"], ["rec_id"])


@query("""SELECT row_uid, part, rec_id FROM (SELECT *, row_number() OVER (PARTITION BY row_uid ORDER BY part, rec_id) AS rn FROM (
SELECT row_uid, 'water' AS part, rec_id FROM unified WHERE solvent = 'water' UNION ALL SELECT row_uid, 'zother', rec_id FROM unified WHERE solvent <> 'water') WHERE row_uid IS NOT NULL) WHERE rn = 1""")
def concat_distinct(spark, d):
    u = table(spark, d, "unified").where("row_uid IS NOT NULL")
    a = u.where("solvent = 'water'").select("row_uid", F.lit("water").alias("part"), "rec_id", F.lit(1).alias("fold"))
    b = u.where("solvent <> 'water'").select("row_uid", F.lit("zother").alias("part"), "rec_id")
    return schema.concat_distinct([a, b], "row_uid", ["rec_id"])


# -- sampling, splitting ----------------------------------------------------------------------------------------


@query(M + """SELECT rec_id, CASE WHEN temp_C >= 20 AND temp_C <= 25 THEN 'Ambient' WHEN temp_C > 25 AND temp_C <= 35 THEN 'Normal' WHEN temp_C > 35 AND temp_C <= 40 THEN 'Physio' WHEN temp_C > 40 AND temp_C <= 50 THEN 'Hot' END AS label,
concat_ws('|', coalesce(CAST(CAST(round_even(temp_C / 5.0, 0) * 5 AS INT) AS VARCHAR), '-999'), CAST(CASE WHEN logS IS NULL THEN -1 ELSE CAST(logS > -4 AS INT) END AS VARCHAR)) AS stratum FROM m""")
def strat_labels(spark, d):
    m = measurements(spark, d)
    return m.select("rec_id", sampling.temperature_label(F.col("temp_C")).alias("label"), sampling.strata(F.col("temp_C"), F.when(F.col("logS").isNull(), -1).otherwise((F.col("logS") > -4).cast("int"))).alias("stratum"))


@query(M.rstrip() + """, b AS (SELECT rec_id, i AS iter, CAST(floor(logS / 0.2) AS INT) AS v, CASE WHEN t >= 20 AND t <= 25 THEN 'Ambient' WHEN t > 25 AND t <= 35 THEN 'Normal' WHEN t > 35 AND t <= 40 THEN 'Physio' WHEN t > 40 AND t <= 50 THEN 'Hot' END AS l
FROM (SELECT rec_id, logS, coalesce(temp_C, 25.0) AS t FROM m), (SELECT unnest([1, 2]) AS i))
SELECT rec_id, CAST(iter AS INT) AS iter FROM (SELECT *, row_number() OVER (PARTITION BY iter, v, l ORDER BY md5(CAST(42 + iter AS VARCHAR) || '|' || CAST(rec_id AS VARCHAR)), rec_id) AS rn FROM b WHERE v IS NOT NULL AND l IS NOT NULL) WHERE l <> 'Ambient' OR rn <= 30""")
def balance_2d(spark, d):
    return sampling.balance(measurements(spark, d).select("rec_id", "logS", "temp_C"), "rec_id", iterations=2).select("rec_id", "iter")


@query(M.rstrip() + """, x AS (SELECT rec_id, coalesce(temp_C, 25.0) AS t, coalesce(logS, -2.0) AS v FROM m), y AS (SELECT *, CAST(least(greatest(floor(v + 12.0), 0), 15) AS INT) AS b, (v >= -12 AND v <= 4) AS inside FROM x),
h AS (SELECT b, count(*) FILTER (inside) AS c FROM y GROUP BY b)
SELECT rec_id, round(pow(1 + 4 * exp(-pow(t - 37, 2) / 50.0), 2) * ln(1 + (SELECT count(*) FROM m) / CAST(greatest(c, 1) AS DOUBLE)), 6) AS weight FROM y JOIN h USING (b)""")
def sample_weights(spark, d):
    return sampling.sample_weights(measurements(spark, d).select("rec_id", "logS", "temp_C")).select("rec_id", F.round("weight", 6).alias("weight"))


QBIN = """, e AS (SELECT quantile_cont(logS, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM j),
q AS (SELECT DISTINCT unnest(q[2:5]) AS k FROM e), lab AS (SELECT j.*, CASE WHEN logS IS NULL THEN -1 ELSE (SELECT count(*) FROM q WHERE k < logS AND k > (SELECT q[1] FROM e) AND k < (SELECT q[6] FROM e)) END AS l FROM j),
cnt AS (SELECT grp, l, count(*) AS n FROM lab WHERE grp IS NOT NULL GROUP BY ALL),
maj AS (SELECT grp, l AS label, size FROM (SELECT *, sum(n) OVER (PARTITION BY grp) AS size, row_number() OVER (PARTITION BY grp ORDER BY n DESC, l) AS rn FROM cnt) WHERE rn = 1)
"""
J = M.rstrip() + ", j AS (SELECT rec_id, InChIKey AS grp, logS, temp_C FROM m)"


@query(J + QBIN + """, r AS (SELECT grp, CASE WHEN count(*) OVER (PARTITION BY label) < 5 THEN -1 ELSE label END AS label FROM maj)
SELECT grp, CAST(label AS BIGINT) AS label, CAST((((row_number() OVER (PARTITION BY label ORDER BY md5('42|' || grp), grp)) - 1 + label) % 5 + 5) % 5 AS INT) AS fold FROM r""")
def group_kfold(spark, d):
    m = measurements(spark, d).select(F.col("InChIKey").alias("grp"), "logS")
    return sampling.group_folds(m, "grp", "logS").withColumn("label", F.col("label").cast("long"))


@query(J + QBIN + "SELECT grp, CAST(CASE WHEN count(*) OVER (PARTITION BY label) < 5 THEN -1 ELSE label END AS BIGINT) AS label, CAST(size AS BIGINT) AS size FROM maj")
def majority_label(spark, d):
    m = measurements(spark, d).select(F.col("InChIKey").alias("grp"), "logS")
    g = sampling.group_labels(m.withColumn("_q", sampling.quantile_bins(m, "logS", 5)), "grp", "_q")
    return sampling.collapse_rare(g, 5, -1).select("grp", F.col("label").cast("long").alias("label"), F.col("size").cast("long").alias("size"))


@query(J.replace("WITH m", "WITH RECURSIVE m", 1).replace("FROM m)", "FROM m WHERE InChIKey IS NOT NULL)") + QBIN.split("cnt AS")[0] + """st AS (SELECT grp, concat_ws('|', coalesce(CAST(CAST(round_even(temp_C / 5.0, 0) * 5 AS INT) AS VARCHAR), '-999'), CAST(l AS VARCHAR)) AS s FROM lab),
cn AS (SELECT grp, s, count(*) AS n FROM st GROUP BY ALL), mj AS (SELECT grp, s, size FROM (SELECT *, sum(n) OVER (PARTITION BY grp) AS size, row_number() OVER (PARTITION BY grp ORDER BY n DESC, s) AS rn FROM cn) WHERE rn = 1),
gr AS (SELECT grp, CASE WHEN count(*) OVER (PARTITION BY s) < 2 THEN 'OTHER' ELSE s END AS stratum, CAST(size AS BIGINT) AS size FROM mj),
od AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('42|' || grp), grp) AS i, CAST(floor(sum(size) OVER (PARTITION BY stratum) * 0.2) AS BIGINT) AS goal FROM gr),
sw AS (SELECT stratum, i, size AS seen, grp, size, true AS take FROM od WHERE i = 1 UNION ALL
  SELECT o.stratum, o.i, CASE WHEN t THEN seen + o.size ELSE seen END, o.grp, o.size, t FROM (SELECT od.*, sw.seen, abs(sw.seen + od.size - od.goal) < abs(sw.seen - od.goal) AS t FROM sw JOIN od ON od.stratum = sw.stratum AND od.i = sw.i + 1) o)
SELECT grp, stratum, size, CASE WHEN take THEN 'test' ELSE 'train' END AS split FROM sw""")
def group_split(spark, d):
    m = measurements(spark, d).select(F.col("InChIKey").alias("grp"), "logS", "temp_C").where("grp IS NOT NULL")
    return sampling.group_split(m, "grp", "logS", "temp_C")


# -- statistics, selection --------------------------------------------------------------------------------------

FEATURES = ["logS", "temp_C", "mol_weight", "hour", "flat", "twin"]
FEAT_SQL = M.rstrip() + ", w AS (SELECT rec_id, logS, temp_C, mol_weight, CAST(rec_id % 24 AS DOUBLE) AS hour, CAST(rec_id % 1000 = 0 AS INT)::DOUBLE AS flat, logS * -2.0 + 1.0 AS twin FROM m)\n"


def features(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d)
    return m.select("rec_id", "logS", "temp_C", "mol_weight", (F.col("rec_id") % 24).cast("double").alias("hour"), (F.col("rec_id") % 1000 == 0).cast("double").alias("flat"), (F.col("logS") * -2.0 + 1.0).alias("twin"))


LONG = ", z AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM w WHERE {c} IS NOT NULL" for c in FEATURES) + ")\n"


@query(FEAT_SQL.rstrip() + LONG + "SELECT feature, CAST(sum(k) AS BIGINT) AS n, count(*) AS \"distinct\", round(max(k) / CAST(sum(k) AS DOUBLE), 9) AS top_share FROM (SELECT feature, value, count(*) AS k FROM z GROUP BY ALL) GROUP BY feature")
def nzv_filter(spark, d):
    return selection.dominance(features(spark, d), FEATURES).withColumn("top_share", F.round("top_share", 9))


@query(FEAT_SQL + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM w" for i, a in enumerate(FEATURES[:4]) for b in FEATURES[i + 1 : 4]))
def corr_pairs(spark, d):
    return selection.correlations(features(spark, d), FEATURES[:4]).withColumn("r", F.round("r", 6))


FEAT_PAIRS = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, corr({a}, {b}) AS r FROM w" for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if i != j)
FEAT_GROUPS = FEAT_SQL.replace("WITH m", "WITH RECURSIVE m", 1).rstrip() + LONG.rstrip() + f""", pr AS ({FEAT_PAIRS}), f AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(FEATURES))}) t(i, feature)),
rc AS (SELECT i, i AS j FROM f UNION SELECT rc.i, pr.j FROM rc JOIN pr ON pr.i = rc.j AND isfinite(r) AND abs(r) >= 0.99),
gp AS (SELECT i, min(j) AS top FROM rc GROUP BY i)
"""


@query(FEAT_GROUPS + "SELECT CAST(dense_rank() OVER (ORDER BY top) - 1 AS INT) AS grp, feature FROM gp JOIN f USING (i)")
def corr_clusters(spark, d):
    f = features(spark, d)
    groups = selection.correlated_groups(selection.correlations(f, FEATURES), FEATURES, 0.99)
    return spark.createDataFrame([(i, c) for i, g in enumerate(groups) for c in g], "grp int, feature string")


@query(FEAT_SQL.rstrip() + LONG + ", v AS (SELECT feature, var_samp(value) AS v FROM z GROUP BY feature) SELECT feature, round(v / (SELECT sum(v) FROM v), 6) AS importance FROM v")
def variance_importance(spark, d):
    return selection.variance_importance(features(spark, d), FEATURES).withColumn("importance", F.round("importance", 6))


@query(FEAT_GROUPS.rstrip() + """, dm AS (SELECT feature, max(k) / CAST(sum(k) AS DOUBLE) AS share, count(*) AS kinds FROM (SELECT feature, value, count(*) AS k FROM z GROUP BY ALL) GROUP BY feature),
vr AS (SELECT feature, var_samp(value) AS v FROM z GROUP BY feature)
SELECT feature FROM (SELECT feature, row_number() OVER (PARTITION BY top ORDER BY v DESC, i) AS rn FROM gp JOIN f USING (i) JOIN vr USING (feature) JOIN dm USING (feature) WHERE share < 0.99 AND kinds > 1) WHERE rn = 1""")
def select_features(spark, d):
    return spark.createDataFrame([(c,) for c in selection.select_features(features(spark, d), FEATURES)], "feature string")


@query(FEAT_SQL + "SELECT rec_id, round(coalesce(logS, (SELECT median(logS) FROM w)), 6) AS \"logS\", round(coalesce(mol_weight, (SELECT median(mol_weight) FROM w)), 6) AS mol_weight FROM w")
def median_impute(spark, d):
    return selection.median_impute(features(spark, d).select("rec_id", "logS", "mol_weight"), ["logS", "mol_weight"]).select("rec_id", *r6("logS", "mol_weight"))


@query(M + """SELECT least(CAST(floor((logS + 12) / 0.4) AS INT), 39) AS bin, count(*) AS n FROM m WHERE logS >= -12 AND logS <= 4 GROUP BY 1""")
def histogram(spark, d):
    return metrics.histogram(measurements(spark, d), "logS", 40, -12.0, 4.0).select("bin", "n")


# -- predictions ------------------------------------------------------------------------------------------------


@query(C + "SELECT id, fold, model, y_true, round(y_pred, 6) AS y_pred FROM c")
def oof_collapse(spark, d):
    return collapsed(spark, d).withColumn("y_pred", F.round("y_pred", 6))


@query(C + "SELECT id, fold, min(y_true) AS y_true, count(DISTINCT model) AS models, round(sum(y_pred), 6) AS total FROM c GROUP BY id, fold HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM c WHERE model IS NOT NULL)")
def oof_kway_join(spark, d):
    names = model_names(spark, d)
    w = joins.oof_wide(collapsed(spark, d), names)
    total = F.aggregate(F.filter(F.array(*[f"oof_{m}" for m in names]), lambda x: x.isNotNull()), F.lit(0.0), lambda a, x: a + x)
    some = F.coalesce(*[f"oof_{m}" for m in names]).isNotNull()
    return w.select("id", "fold", "y_true", F.lit(len(names)).cast("long").alias("models"), F.round(F.when(some, total), 6).alias("total"))


@query(P + "SELECT model, count(*) AS n, round(sqrt(avg(pow(y_pred - y_true, 2))), 6) AS rmse, round(avg(abs(y_pred - y_true)), 6) AS mae, round(avg(y_pred - y_true), 6) AS bias, round(1 - avg(pow(y_pred - y_true, 2)) / var_pop(y_true), 6) AS r2 FROM p GROUP BY model")
def regression_metrics(spark, d):
    return metrics.regression(collapsed(spark, d), "y_true", "y_pred", ["model"]).select("model", "n", *r6("rmse", "mae", "bias", "r2"))


@query(P + r""", t AS (SELECT row_uid AS id, min(CASE WHEN isfinite(temp_C) THEN temp_C END) AS temp FROM unified GROUP BY 1), s AS (SELECT p.*, temp, 'Global' AS scope FROM p LEFT JOIN t USING (id) UNION ALL SELECT p.*, temp, 'Physio' FROM p JOIN t USING (id) WHERE temp BETWEEN 35 AND 38)
SELECT scope, model, count(*) AS n, round(sqrt(avg(pow(y_pred - y_true, 2))), 6) AS rmse FROM s GROUP BY scope, model""")
def physio_metrics(spark, d):
    temp = table(spark, d, "unified").groupBy(F.col("row_uid").alias("id")).agg(F.min(S.finite(F.col("temp_C"))).alias("temp"))
    x = joins.with_all(collapsed(spark, d), [temp], "id")
    x = metrics.scoped(x, F.coalesce(filters.physiological("temp"), F.lit(False)), "Physio")
    return metrics.regression(x, "y_true", "y_pred", ["scope", "model"]).select("scope", "model", "n", *r6("rmse"))


CONF = ", k AS (SELECT model, count(*) FILTER (t AND q) AS tp, count(*) FILTER (NOT t AND q) AS fp, count(*) FILTER (NOT t AND NOT q) AS tn, count(*) FILTER (t AND NOT q) AS fn FROM (SELECT model, y_true > -4 AS t, y_pred > -4 AS q FROM p) GROUP BY model)\n"


@query(P.rstrip() + CONF + "SELECT * FROM k")
def confusion_matrix(spark, d):
    return metrics.confusion(collapsed(spark, d), "y_true", "y_pred", by=["model"])


@query(P.rstrip() + CONF + "SELECT model, round((tp + tn) / (tp + fp + tn + fn)::DOUBLE, 6) AS accuracy, round(tn / (tn + fp)::DOUBLE, 6) AS specificity, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / (tp + fn)::DOUBLE, 6) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1, round((tp::DOUBLE * tn - fp::DOUBLE * fn) / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc FROM k")
def classification_metrics(spark, d):
    return metrics.classification(collapsed(spark, d), "y_true", "y_pred", by=["model"]).select("model", *r6("accuracy", "specificity", "precision", "recall", "f1", "mcc"))


RANKED = P.rstrip() + ", x AS (SELECT y_true > -4 AS t, y_pred AS s FROM p), g AS (SELECT s, count(*) FILTER (t) AS pos, count(*) FILTER (NOT t) AS neg FROM x GROUP BY s), u AS (SELECT *, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM g)\n"


@query(RANKED + "SELECT CAST(max(np) AS BIGINT) AS positives, CAST(max(nn) AS BIGINT) AS negatives, round(CAST(sum(pos * (nn - fp + neg / 2.0)) / (max(np) * max(nn)) AS DOUBLE), 6) AS roc_auc, round(CAST(sum(pos * tp / (tp + fp)) / max(np) AS DOUBLE), 6) AS average_precision FROM u")
def roc_auc(spark, d):
    return metrics.ranking(collapsed(spark, d), "y_true", "y_pred").select(F.col("positives").cast("long").alias("positives"), F.col("negatives").cast("long").alias("negatives"), *r6("roc_auc", "average_precision"))


@query(RANKED + "SELECT round(s, 9) AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(CAST(tp / np AS DOUBLE), 6) AS tpr, round(CAST(fp / nn AS DOUBLE), 6) AS fpr FROM u")
def roc_curve(spark, d):
    return metrics.curve(collapsed(spark, d), "y_true", "y_pred").select(F.round("score", 9).alias("score"), "tp", "fp", *r6("tpr", "fpr"))


@query(P + "SELECT CAST(floor((y_pred - y_true) / 0.2) AS INT) AS bin, count(*) AS n, round(avg(y_pred - y_true), 6) AS mean_error FROM p GROUP BY 1")
def residual_histogram(spark, d):
    return metrics.residuals(collapsed(spark, d), "y_true", "y_pred").select("bin", "n", *r6("mean_error"))


@query(C + "SELECT id, round(avg(y_true), 6) AS y_true, round(avg(y_pred), 6) AS y_pred FROM c GROUP BY id")
def consensus_mean(spark, d):
    return metrics.mean_by(collapsed(spark, d).drop("model"), "id").select("id", *r6("y_true", "y_pred"))


CV = P.rstrip() + ", f AS (SELECT model, fold, sqrt(avg(pow(y_pred - y_true, 2))) AS rmse, 1 - avg(pow(y_pred - y_true, 2)) / var_pop(y_true) AS r2 FROM p GROUP BY model, fold)\n"


@query(CV + "SELECT model, round(avg(rmse), 6) AS rmse_mean, round(stddev_pop(rmse), 6) AS rmse_std, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std FROM f GROUP BY model")
def cv_summary(spark, d):
    per = metrics.regression(collapsed(spark, d), "y_true", "y_pred", ["model", "fold"])
    return metrics.summary(per, "model", ["rmse", "r2"]).select("model", *r6("rmse_mean", "rmse_std", "r2_mean", "r2_std"))


@query(CV + "SELECT model, round(rmse, 6) AS rmse FROM (SELECT model, avg(rmse) AS rmse FROM f GROUP BY model) ORDER BY rmse, model LIMIT 1")
def best_strategy(spark, d):
    per = metrics.regression(collapsed(spark, d), "y_true", "y_pred", ["model", "fold"]).groupBy("model").agg(F.avg("rmse").alias("rmse"))
    return metrics.best(per, "model", "rmse").select("model", *r6("rmse"))


PARAM_SQL = "WITH r AS (SELECT 'depth' AS name, CAST(3 + fold AS VARCHAR) AS value FROM split_plan UNION ALL SELECT 'rate', CAST(0.1 * (fold + 1) AS DECIMAL(4,1))::VARCHAR FROM split_plan UNION ALL SELECT 'loss', CASE WHEN fold < 3 THEN 'huber' ELSE 'square' END FROM split_plan)\n"


def params(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "split_plan")
    each = F.array(F.struct(F.lit("depth").alias("name"), (F.col("fold") + 3).cast("string").alias("value")), F.struct(F.lit("rate").alias("name"), ((F.col("fold") + 1) * 0.1).cast("decimal(4,1)").cast("string").alias("value")), F.struct(F.lit("loss").alias("name"), F.when(F.col("fold") < 3, "huber").otherwise("square").alias("value")))
    return p.select(F.inline(each))


@query(PARAM_SQL + "SELECT name, CASE name WHEN 'depth' THEN CAST(CAST(avg(try_cast(value AS DOUBLE)) AS BIGINT) AS VARCHAR) WHEN 'rate' THEN CAST(round(avg(try_cast(value AS DOUBLE)), 6) AS VARCHAR) ELSE mode(value) END AS value FROM r GROUP BY name")
def param_consolidate(spark, d):
    got = metrics.consolidate(params(spark, d))
    return got.withColumn("value", F.when(F.col("name") == "rate", F.round(F.col("value").try_cast("double"), 6).cast("string")).otherwise(F.col("value")))


@query(PARAM_SQL + "SELECT name, round(median(try_cast(value AS DOUBLE)), 6) AS value FROM r GROUP BY name")
def param_median(spark, d):
    return metrics.param_median(params(spark, d)).withColumn("value", F.round("value", 6))


@query(C + "SELECT id, fold, model, round(0.25 + 0.9 * coalesce(y_pred, 0), 6) AS score FROM c")
def linear_score(spark, d):
    return collapsed(spark, d).select("id", "fold", "model", F.round(linear.linear_score(["y_pred"], [0.9], 0.25), 6).alias("score"))


@query(C + "SELECT id, fold, round(sum(CASE model WHEN (SELECT min(model) FROM c) THEN 3 ELSE 1 END * y_pred) / sum(CASE WHEN y_pred IS NULL THEN 0 WHEN model = (SELECT min(model) FROM c) THEN 3 ELSE 1 END), 6) AS blend FROM c GROUP BY id, fold HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM c WHERE model IS NOT NULL)")
def blend_score(spark, d):
    names = model_names(spark, d)
    w = joins.oof_wide(collapsed(spark, d), names)
    return w.select("id", "fold", F.round(linear.blend_score({f"oof_{m}": 3.0 if i == 0 else 1.0 for i, m in enumerate(names)}), 6).alias("blend"))


@query()
def blend_oof(spark, d):
    names = model_names(spark, d)
    w = linear.blend_oof(joins.oof_wide(collapsed(spark, d), names), names)
    return linear.stack_oof(w, names).select("id", "fold", "y_true", *r6("oof_blend", "oof_stack"))


@query()
def nnls_blend(spark, d):
    names = model_names(spark, d)
    g = linear.gram(joins.oof_wide(collapsed(spark, d), names), [f"oof_{m}" for m in names], "y_true")
    return spark.createDataFrame([(m, round(float(x), 6)) for m, x in zip(names, linear.nnls(g[None]))] if None in g else [], "model string, weight double")


def physics(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d).where("logS IS NOT NULL AND InChIKey IS NOT NULL")
    return m.select("rec_id", "logS", S.inverse_temperature(F.col("temp_C")).alias("inv_temp"), F.coalesce("mol_weight", F.lit(800.0)).alias("mw"), (F.conv(F.substring(F.md5("InChIKey"), 25, 8), 16, 10).cast("long") % 5).cast("int").alias("fold"))


@query(M.rstrip() + ", w AS (SELECT 1000.0 / (coalesce(temp_C, 25.0) + 273.15) AS x, coalesce(mol_weight, 800.0) AS z, logS AS y FROM m WHERE logS IS NOT NULL AND InChIKey IS NOT NULL)\nSELECT count(*) AS n, round(sum(x), 4) AS sx, round(sum(x * x), 4) AS sxx, round(sum(x * z) / 1e3, 4) AS sxz, round(sum(x * y), 4) AS sxy, round(sum(y * y), 4) AS syy FROM w")
def ridge_gram(spark, d):
    g = linear.gram(physics(spark, d), ["inv_temp", "mw"], "logS").get(None)
    row = (0, None, None, None, None, None) if g is None else (int(g[0, 0]), *(round(float(v), 4) for v in (g[0, 1], g[1, 1], g[1, 2] / 1e3, g[1, 3], g[3, 3])))
    return spark.createDataFrame([row], "n long, sx double, sxx double, sxz double, sxy double, syy double")


# ridge of two standardised features in closed form: per left-out fold k and alpha, the loss over the other folds j, each
# predicted by the sums of the folds but k and j; then the fit of the folds but k at the best alpha
RIDGE = M.rstrip() + """, w AS (SELECT rec_id, 1000.0 / (coalesce(temp_C, 25.0) + 273.15) AS x, coalesce(mol_weight, 800.0) AS z, logS AS y, CAST(('0x' || substr(md5(InChIKey), 25, 8)) AS BIGINT) % 5 AS fold FROM m WHERE logS IS NOT NULL AND InChIKey IS NOT NULL),
g AS (SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(x) AS x, sum(z) AS z, sum(y) AS y, sum(x * x) AS xx, sum(x * z) AS xz, sum(z * z) AS zz, sum(x * y) AS xy, sum(z * y) AS zy, sum(y * y) AS yy FROM w GROUP BY fold),
k AS (SELECT fold AS k FROM g UNION ALL SELECT -1), al AS (SELECT unnest([0.01, 0.1, 1.0, 10.0, 100.0, 1000.0])::DOUBLE AS alpha),
q AS (SELECT k, j.fold AS j, sum(n) AS n, sum(x) AS x, sum(z) AS z, sum(y) AS y, sum(xx) AS xx, sum(xz) AS xz, sum(zz) AS zz, sum(xy) AS xy, sum(zy) AS zy FROM k, (SELECT fold FROM g UNION ALL SELECT -2) j, g WHERE g.fold <> k AND g.fold <> j.fold AND j.fold <> k GROUP BY k, j.fold),
sd AS (SELECT *, x / n AS mx, z / n AS mz, y / n AS my, sqrt(xx / n - pow(x / n, 2)) AS sx, sqrt(zz / n - pow(z / n, 2)) AS sz FROM q),
cf AS (SELECT k, j, alpha, n, mx, mz, my, sx, sz, n + alpha AS d, (xz - n * mx * mz) / (sx * sz) AS o, (xy - n * mx * my) / sx AS bx, (zy - n * mz * my) / sz AS bz FROM sd, al),
ft AS (SELECT k, j, alpha, n, (bx * d - o * bz) / (d * d - o * o) / sx AS wx, (bz * d - o * bx) / (d * d - o * o) / sz AS wz, mx, mz, my FROM cf),
fi AS (SELECT *, my - wx * mx - wz * mz AS b FROM ft),
ls AS (SELECT fi.k, alpha, sum(yy + g.n * b * b + wx * wx * xx + wz * wz * zz - 2 * b * g.y - 2 * wx * xy - 2 * wz * zy + 2 * b * wx * g.x + 2 * b * wz * g.z + 2 * wx * wz * xz) AS loss FROM fi JOIN g ON g.fold = fi.j GROUP BY fi.k, alpha),
be AS (SELECT k, arg_min(alpha, loss) AS alpha FROM ls GROUP BY k), md AS (SELECT fi.* FROM fi JOIN be USING (k, alpha) WHERE j = -2)
"""


@query(RIDGE + "SELECT rec_id, CAST(fold AS INT) AS fold, w.y AS \"logS\", round(b + wx * w.x + wz * w.z, 4) AS y_pred FROM w JOIN md ON md.k = w.fold")
def ridge_oof(spark, d):
    return linear.ridge_oof(physics(spark, d), ["inv_temp", "mw"], "logS").select("rec_id", "fold", "logS", F.round("y_pred", 4).alias("y_pred"))


@query(RIDGE + "SELECT unnest(['intercept', 'alpha', 'n', 'inv_temp', 'mw']) AS name, unnest([round(b, 6), round(alpha, 6), n, round(wx, 6), round(wz, 6)]) AS value FROM md WHERE k = -1")
def ridge_full(spark, d):
    return spark.createDataFrame([(k, round(v, 6)) for k, v in linear.ridge_full(physics(spark, d), ["inv_temp", "mw"], "logS").items()], "name string, value double")


@query()
def gbt_oof(spark, d):
    return models.oof(physics(spark, d), ["inv_temp", "mw"], "logS", "rec_id").withColumn("y_pred", F.round("y_pred", 6))


@query()
def gbt_search(spark, d):
    live = physics(spark, d).where("NOT isnan(logS)")
    got = [(kind, place, float(rmse), json.dumps(params, sort_keys=True)) for kind in models.SEARCH for place, (rmse, params) in enumerate(models.search(live, ["inv_temp", "mw"], "logS", kind), 1)]
    return spark.createDataFrame(got, "kind string, place int, rmse double, params string")


# -- vectors ----------------------------------------------------------------------------------------------------


def bits(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label", "embedding", similarity.bit_words(F.transform("embedding", lambda x: x > 0), 64).alias("w"))


@query("""WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS f FROM embeddings), o AS (SELECT vec_id, unnest(range(1, 65)) AS i, unnest(f) AS f FROM b), s AS (SELECT vec_id, i FROM o WHERE f), n AS (SELECT vec_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.vec_id AS a, y.vec_id AS b, count(*) AS k FROM s x JOIN s y ON x.i = y.i AND x.vec_id < y.vec_id GROUP BY 1, 2)
SELECT a, b, round(k / CAST(p.n + q.n - k AS DOUBLE), 6) AS similarity FROM c JOIN n p ON a = p.vec_id JOIN n q ON b = q.vec_id WHERE k / CAST(p.n + q.n - k AS DOUBLE) >= 0.6""")
def tanimoto_pairs(spark, d):
    return similarity.similar_pairs(bits(spark, d), "vec_id", "w", 0.6).withColumn("similarity", F.round("similarity", 6))


@query("""WITH RECURSIVE s AS (SELECT vec_id, unnest(range(1, 65)) AS i, unnest(list_transform(embedding, lambda x: x > 0)) AS f FROM embeddings), n AS (SELECT vec_id, count(*) AS n FROM s WHERE f GROUP BY 1),
c AS (SELECT x.vec_id AS a, y.vec_id AS b, count(*) AS k FROM s x JOIN s y ON x.i = y.i AND x.f AND y.f AND x.vec_id <> y.vec_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON a = p.vec_id JOIN n q ON b = q.vec_id WHERE k / CAST(p.n + q.n - k AS DOUBLE) >= 0.6), d AS (SELECT a, count(*) AS d, list(b) AS near FROM l GROUP BY a),
o AS (SELECT vec_id, coalesce(near, []) AS near, row_number() OVER (ORDER BY coalesce(d, 0) DESC, vec_id) AS i FROM n LEFT JOIN d ON a = vec_id),
w AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS founders UNION ALL SELECT o.i, CASE WHEN list_has_any(founders, near) THEN founders ELSE list_append(founders, vec_id) END FROM w JOIN o ON o.i = w.i + 1),
f AS (SELECT unnest(founders) AS founder, unnest(range(len(founders))) AS cluster FROM w WHERE i = (SELECT max(i) FROM w)),
t AS (SELECT o.vec_id, min(cluster) AS cluster FROM o JOIN f ON founder = o.vec_id OR list_contains(near, founder) GROUP BY 1)
SELECT vec_id, CAST(cluster AS BIGINT) AS cluster FROM t UNION ALL SELECT vec_id, -1 FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM n)""")
def butina_clusters(spark, d):
    return similarity.sphere_clusters(bits(spark, d), "vec_id", "w", 0.6)


@query()
def pca_2d(spark, d):
    return similarity.pca(table(spark, d, "embeddings"), "embedding", 64).select("vec_id", *r6("pc1", "pc2"))


@query()
def mahalanobis(spark, d):
    return similarity.mahalanobis(table(spark, d, "embeddings"), "embedding", 64).select("vec_id", *r6("distance"))


# -- molecules --------------------------------------------------------------------------------------------------


@query()
def molecule_properties(spark, d):
    x = chemistry.describe(table(spark, d, "unified"), "smiles_neutral").drop("bits")
    return x.withColumns({c: F.round(c, 4) for c in ("mol_weight", "polar_area")})


@query()
def fingerprint_pairs(spark, d):
    x = chemistry.describe(table(spark, d, "unified").where("smiles_neutral NOT IN ('', 'nan')"), "smiles_neutral").where("valid").select("smiles_neutral", "bits")
    return similarity.similar_pairs(x, "smiles_neutral", "bits", 0.7).withColumn("similarity", F.round("similarity", 6))


# -- files and streams ------------------------------------------------------------------------------------------


@query("SELECT row_uid, fold, cluster_ecfp4_0p7, suffix FROM folds, (SELECT unnest(['csv', 'json', 'parquet', 'tsv']) AS suffix)")
def file_round_trip(spark, d):
    f, out = table(spark, d, "folds").select("row_uid", "fold", "cluster_ecfp4_0p7"), None
    root = Scratch(spark, "files").root
    for suffix in ("csv", "json", "parquet", "tsv"):
        files.write_any(f, f"{root}/folds.{suffix}")
        back = files.read_any(spark, f"{root}/folds.{suffix}", f.schema).select(*f.columns).withColumn("suffix", F.lit(suffix))
        out = back if out is None else out.unionByName(back)
    return out


@query(M + f"SELECT rec_id, round(-3.0 - 0.25 * (1000.0 / (coalesce(temp_C, 25.0) + 273.15)), 6) AS predicted FROM m WHERE {WATER} AND (temp_C IS NULL OR temp_C BETWEEN 4 AND 60)")
def stream_score(spark, d):
    root = Scratch(spark, "stream").root
    rows = measurements(spark, d).select("rec_id", "solvent", "temp_C", "source")
    files.write_any(rows, f"{root}/in")
    got = score.score_stream(score.read_stream(spark, f"{root}/in", rows.schema), {"intercept": -3.0, "inv_temp": -0.25}, low=4.0, high=60.0)
    score.write_stream(got, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.schema("rec_id long, predicted_logS double").parquet(f"{root}/out").select("rec_id", F.round("predicted_logS", 6).alias("predicted"))


@query("""SELECT rec_id, CAST(list_min(v) AS DOUBLE) AS low, CAST(list_max(v) AS DOUBLE) AS high, CAST(len(v) AS INT) AS n FROM (SELECT rec_id, list_filter([CAST(rec_id % 7 AS DOUBLE), CAST(rec_id % 3 + 0.5 AS DOUBLE), NULL], lambda x: x IS NOT NULL AND x <> 0) AS v FROM unified)""")
def pka_summary(spark, d):
    pka = F.create_map(F.lit("1"), (F.col("rec_id") % 7).cast("string"), F.lit("2"), (F.col("rec_id") % 3 + 0.5).cast("string"), F.lit("3"), F.lit("none"))
    return table(spark, d, "unified").select("rec_id", S.pka_summary(pka).alias("p")).select("rec_id", "p.*")


# -- pipelines --------------------------------------------------------------------------------------------------

CURATE = M.rstrip() + f""", w AS (SELECT * FROM m WHERE {WATER} AND temp_C BETWEEN 24 AND 50), e AS (SELECT min(temp_C) AS lo, max(temp_C) AS hi FROM w WHERE temp_C IS NOT NULL),
x AS (SELECT w.*, CASE WHEN logS IS NOT NULL THEN CAST(greatest(least(ceil((temp_C - lo) / ((hi - lo) / 10)), 10), 1) AS INT) END AS b FROM w, e),
s AS (SELECT b, max(n) AS n, max(mid) AS mid, 1.4826 * median(abs(logS - mid)) AS spread FROM x JOIN (SELECT b, count(*) AS n, median(logS) AS mid FROM x WHERE b IS NOT NULL GROUP BY b) USING (b) GROUP BY b),
o AS (SELECT x.* FROM x LEFT JOIN s USING (b) WHERE NOT coalesce(n >= 8 AND spread > 0 AND abs((logS - mid) / spread) > 3, false) AND InChIKey IS NOT NULL),
g AS (SELECT InChIKey, solvent AS s, temp_C AS t, count(*) AS n, count(logS) AS held, median(logS) AS mid FROM o GROUP BY ALL),
f AS (SELECT InChIKey, solvent AS s, temp_C AS t, min(rec_id) AS rec_id, max(n) AS n, max(held) AS held, avg(CASE WHEN abs(logS - mid) <= 0.7 THEN logS END) AS mean FROM o JOIN g ON o.InChIKey = g.InChIKey AND o.solvent = g.s AND o.temp_C = g.t GROUP BY o.InChIKey, solvent, temp_C)
"""


@query(CURATE.replace("SELECT InChIKey, solvent AS s, temp_C AS t, min(rec_id)", "SELECT o.InChIKey AS InChIKey, solvent AS s, temp_C AS t, min(rec_id)") + "SELECT f.InChIKey, m.solvent, m.temp_C, f.rec_id, round(CASE WHEN f.n > 1 AND mean IS NOT NULL THEN mean ELSE m.logS END, 6) AS logS FROM f JOIN m USING (rec_id) WHERE f.n = 1 OR f.held = 0 OR mean IS NOT NULL")
def curate_pipeline(spark, d):
    return pipelines.curate(measurements(spark, d), "rec_id").select("InChIKey", "solvent", "temp_C", "rec_id", F.round("logS", 6).alias("logS"))


@query()
def research_pipeline(spark, d):
    return pipelines.research(measurements(spark, d), "rec_id")
