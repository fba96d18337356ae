"""Queries of problems 6 and 7: units and drifting schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from limpid.operators import drift, units
from limpid.runtime import table


def _p6_converted(spark: SparkSession, d: str) -> DataFrame:
    both = units.convert_measurements(table(spark, d, "unified"), table(spark, d, "source_registry"))
    return both.unionByName(units.convert_temperatures(table(spark, d, "second_challenge_predict_aqueous_solubility")))


def _p6_found(spark: SparkSession, d: str) -> DataFrame:
    return units.foreign_units(_p6_converted(spark, d))


def _p6_held_out(spark: SparkSession, d: str) -> DataFrame:
    return units.held_out_units(table(spark, d, "unified"), table(spark, d, "source_registry"))


def _p7_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(table(spark, d, "raw_records")).select("feed", "file_seq", "field", "change_kind")


def _p7_changes(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(table(spark, d, "raw_records"))


def _p7_table(spark: SparkSession, d: str) -> DataFrame:
    # maps have no order: given out as JSON text of the entries sorted by name
    t = drift.one_table(table(spark, d, "raw_records"))
    return t.selectExpr("raw_id", "feed", "file_seq", "line_no", "smiles_original", "solvent", "logS", "source", "to_json(map_from_entries(array_sort(map_entries(other)))) AS other")


QUERIES = {"p6_found": _p6_found, "p6_converted": _p6_converted, "p6_held_out": _p6_held_out, "p7_found": _p7_found, "p7_changes": _p7_changes, "p7_table": _p7_table}
P7_FOUND = r"""WITH x AS (SELECT feed, file_seq, payload, unnest(json_keys(payload)) AS k FROM raw_records WHERE feed IS NOT NULL AND file_seq IS NOT NULL),
y AS (SELECT feed, file_seq, k, json_type(json_extract(payload, '$."' || k || '"')) AS t FROM x),
z AS (SELECT feed, file_seq, k, CASE WHEN k IN ('smiles_original', 'canonical_smiles', 'SMILES', 'smiles', 'SMILES_Solute', 'smi', 'Structure (SMILES)') THEN 'smiles_original'
  WHEN k IN ('solvent', 'Solvent', 'Medium', 'medium_name', 'SMILES_Solvent', 'Solvent (Solubility (MCS))') THEN 'solvent'
  WHEN k IN ('logS', 'LogS', 'logS_molL', 'Solubility', 'Y', 'LogS(mol/L)', 'log_solubility') THEN 'logS' WHEN k IN ('source', 'Source', 'dataset', 'origin', 'data_origin') THEN 'source' ELSE k END AS field,
  CASE WHEN t = 'VARCHAR' THEN 'string' WHEN t = 'BOOLEAN' THEN 'boolean' WHEN t = 'ARRAY' THEN 'array' WHEN t = 'OBJECT' THEN 'object' WHEN t = 'NULL' THEN NULL ELSE 'number' END AS kind FROM y),
h AS (SELECT feed, file_seq, field, min(k) AS name, CASE WHEN count(DISTINCT kind) > 1 THEN 'string' ELSE min(kind) END AS kind FROM z GROUP BY ALL),
f AS (SELECT feed, file_seq, lag(file_seq) OVER (PARTITION BY feed ORDER BY file_seq) AS last FROM (SELECT DISTINCT feed, file_seq FROM raw_records WHERE feed IS NOT NULL AND file_seq IS NOT NULL)),
n AS (SELECT f.feed, f.file_seq, h.field, h.name, h.kind FROM f JOIN h ON h.feed = f.feed AND h.file_seq = f.file_seq WHERE last IS NOT NULL),
o AS (SELECT f.feed, f.file_seq, h.field, h.name, h.kind FROM f JOIN h ON h.feed = f.feed AND h.file_seq = f.last)
SELECT feed, file_seq, field, 'added' AS change_kind FROM n ANTI JOIN o USING (feed, file_seq, field) UNION ALL SELECT feed, file_seq, field, 'removed' FROM o ANTI JOIN n USING (feed, file_seq, field)
UNION ALL SELECT n.feed, n.file_seq, n.field, 'renamed' FROM n JOIN o USING (feed, file_seq, field) WHERE n.name <> o.name UNION ALL SELECT n.feed, n.file_seq, n.field, 'retyped' FROM n JOIN o USING (feed, file_seq, field) WHERE n.kind <> o.kind"""
P7_CHANGES = P7_FOUND[: P7_FOUND.index("SELECT feed, file_seq, field, 'added' AS change_kind FROM n")].rstrip() + """,
b AS (SELECT feed, file_seq, field, o.name AS old_name, o.kind AS old_kind, n.name, n.kind FROM n FULL JOIN o USING (feed, file_seq, field))
SELECT feed, file_seq, field, 'added' AS change_kind, NULL AS before, name AS after FROM b WHERE old_name IS NULL UNION ALL SELECT feed, file_seq, field, 'removed', old_name, NULL FROM b WHERE name IS NULL
UNION ALL SELECT feed, file_seq, field, 'renamed', old_name, name FROM b WHERE name <> old_name UNION ALL SELECT feed, file_seq, field, 'retyped', old_kind, kind FROM b WHERE kind <> old_kind"""
# units by wording and size, written apart from the operator from the statement of the problem: a temperature is foreign
# if it can't be a bath in °C at all, if the text names Fahrenheit for it, or gives it as a number in Fahrenheit without
# naming Celsius for the measurement; a solubility by the wording of its text, else of its source's remark
P6_FOUND = r"""WITH u AS (SELECT rec_id, temp_C AS t, logS AS l, regexp_replace(lower(source), '^\s+|\s+$', '', 'g') AS src, coalesce(assay_description, '') AS a FROM unified),
b AS (SELECT *, lower(regexp_replace(a, '(?:(?:stock|crude|limit|dose)\s+)[0-9.]+\s*(mM|uM|mg/mL)|log P [0-9.]+|ln k''|ln fit', ' ', 'gi')) AS w,
  CASE WHEN NOT regexp_matches(a, '(?i)\bcelsius\b|°C') THEN try_cast(regexp_extract(regexp_replace(a, '(?i)(?:dried at|room temp\.) [0-9.]+ ?(?:deg F|F\b)', ' ', 'g'), '([0-9.]+) ?(?:deg F|degrees Fahrenheit|F\b)', 1) AS DOUBLE) END AS f FROM u),
lg AS (SELECT rec_id, CASE
  WHEN regexp_matches(w, 'minus log|negative decadic|sign reversed|\bps\b|p-scale|(^|[ ;(])-log') THEN 'neg' WHEN regexp_matches(w, '\bln\b|ln-|ln\(|napierian|natural log|loge') THEN 'ln'
  WHEN regexp_matches(w, 'not log|no log|linear scale|concentration itself|plain mol|saturation conc') THEN 'lin' WHEN regexp_matches(w, 'mmol|\bmm\b|millimolar') THEN 'milli'
  WHEN regexp_matches(w, 'umol|µm|micromol|\bum\b conc|log um|log of the um') THEN 'micro' WHEN regexp_matches(w, 'log.*(mg/ml|mg per ml|g/l|milligram)|lg of grams') THEN 'mass' WHEN regexp_matches(w, 'log10 mol/l') THEN 'log' END AS k, src FROM b WHERE isfinite(l) AND abs(l) < 900)
SELECT 'unified' AS tab, rec_id AS rec_key, 'temp_C' AS field FROM b WHERE isfinite(t) AND abs(t) < 900 AND (t >= 200 OR abs(f - t) < 0.51 OR regexp_matches(a, 'degF|°F|(?i:fahrenheit readings)'))
UNION ALL SELECT 'unified', rec_id, 'logS' FROM lg WHERE k <> 'log' OR k IS NULL AND src IN (SELECT source FROM source_registry WHERE regexp_matches(remark, '(?i)negative.*logarithm'))
UNION ALL SELECT 'second_challenge_predict_aqueous_solubility', item_no, 'temperature_K' FROM second_challenge_predict_aqueous_solubility WHERE isfinite(temperature_K) AND temperature_K NOT IN (0, -999, 9999) AND temperature_K NOT BETWEEN 200 AND 450"""
ORACLES = {"p6_found": P6_FOUND, "p7_found": P7_FOUND, "p7_changes": P7_CHANGES}
