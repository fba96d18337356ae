"""DuckDB SQL for the training-data queries that SQL can express; written apart from the operators."""

from __future__ import annotations

KEY = r"nullif(regexp_replace(upper(InChIKey), '^\s*(INCHIKEY=)?\s*|\s+$', '', 'g'), '')"
SOURCE = r"nullif(regexp_replace(lower(source), '^\s+|\s+$', '', 'g'), '')"
SPELLED = "CASE WHEN smiles_neutral NOT IN ('', 'nan') THEN smiles_neutral END"


def _components(edges: str, nodes: str) -> str:
    """Recursive part: cc (node, root) with the smallest node of each component as root."""
    return f"""cc(node, root) USING KEY (node) AS (SELECT node, node FROM {nodes} UNION
  SELECT e.b, min(cc.root) FROM cc JOIN {edges} e ON e.a = cc.node JOIN recurring.cc AS u ON u.node = e.b WHERE cc.root < u.root GROUP BY e.b)"""


P1_FOUND = f"""WITH RECURSIVE k AS (SELECT DISTINCT row_uid, {KEY} AS k FROM unified),
raw AS (SELECT 'u' || row_uid AS u, 'c' || cluster_ecfp4_0p7 AS m FROM folds WHERE row_uid IS NOT NULL AND cluster_ecfp4_0p7 <> -1
  UNION SELECT 'u' || f.row_uid, 'k' || k FROM folds f JOIN k USING (row_uid) WHERE k IS NOT NULL),
e AS (SELECT u AS a, m AS b FROM raw UNION SELECT m, u FROM raw),
n AS (SELECT a AS node FROM e UNION SELECT 'u' || row_uid FROM folds WHERE row_uid IS NOT NULL),
{_components("e", "n")},
g AS (SELECT f.row_uid, f.fold, cc.root FROM folds f JOIN cc ON cc.node = 'u' || f.row_uid)
SELECT DISTINCT row_uid FROM g WHERE root IN (SELECT root FROM g GROUP BY root HAVING count(DISTINCT fold) > 1)"""

P2_FOUND = f"""WITH RECURSIVE v AS (SELECT DISTINCT {SPELLED} AS s FROM unified WHERE {SPELLED} IS NOT NULL),
q AS (SELECT DISTINCT s, substr(s, i, 10) AS g FROM v, range(1, 400) AS r(i) WHERE i <= length(s) - 9),
n AS (SELECT s, count(*) AS n FROM q GROUP BY s),
c AS (SELECT x.s AS a, y.s AS b, count(*) AS k FROM q x JOIN q y ON x.g = y.g AND x.s <> y.s GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n na ON a = na.s JOIN n nb ON b = nb.s WHERE 2 * k >= na.n + nb.n - k),
m AS (SELECT DISTINCT a AS node FROM e),
{_components("e", "m")}
SELECT node AS smiles_neutral, root AS cluster_key FROM cc"""

P3_FOUND = f"""WITH u AS (SELECT {KEY} AS inchikey, rec_id, ingested_at, logS, temp_C, coalesce(trust_rank, CASE WHEN {SOURCE.replace("source", "u.source")} IS NULL THEN 1e9 ELSE 1e6 END) AS t
  FROM unified u LEFT JOIN source_registry r ON {SOURCE.replace("source", "u.source")} = r.source),
k AS (SELECT * FROM u WHERE inchikey IN (SELECT inchikey FROM u GROUP BY 1 HAVING count(*) >= 2)),
f AS (SELECT inchikey, 'logS' AS field, rec_id, t, ingested_at FROM k WHERE isfinite(logS) AND abs(logS) < 900
  UNION ALL SELECT inchikey, 'temp_C', rec_id, t, ingested_at FROM k WHERE isfinite(temp_C) AND abs(temp_C) < 900)
SELECT inchikey, field, rec_id FROM (SELECT *, row_number() OVER (PARTITION BY inchikey, field ORDER BY t, ingested_at DESC NULLS LAST, rec_id) AS rn FROM f) WHERE rn = 1"""

P4_FOUND = f"""WITH r AS (SELECT DISTINCT u.row_uid, left({KEY}, 14) AS b, {SPELLED} AS s, p.split = 'train' AS t FROM unified u JOIN folds f USING (row_uid) JOIN split_plan p USING (fold)),
ab AS (SELECT x.row_uid AS a, y.row_uid AS b FROM r x JOIN r y ON x.b = y.b AND x.t AND NOT y.t),
st AS (SELECT DISTINCT s FROM r WHERE t AND s IS NOT NULL), se AS (SELECT DISTINCT s FROM r WHERE NOT t AND s IS NOT NULL),
sp AS (SELECT st.s AS a, se.s AS b FROM st JOIN se ON abs(length(st.s) - length(se.s)) <= 2 AND levenshtein(st.s, se.s) <= 2),
cd AS (SELECT x.row_uid AS a, y.row_uid AS b FROM sp JOIN r x ON x.s = sp.a AND x.t JOIN r y ON y.s = sp.b AND NOT y.t)
SELECT DISTINCT least(a, b) AS row_uid_a, greatest(a, b) AS row_uid_b FROM (SELECT * FROM ab UNION ALL SELECT * FROM cd) WHERE a <> b"""

P8_FOUND = r"""WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS t FROM documents),
i AS (SELECT item_id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS t FROM eval_items),
w AS (SELECT DISTINCT item_id, substr(t, k, 60) AS g FROM i, range(1, 5000) AS r(k) WHERE k <= length(t) - 59)
SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, substr(t, k, 60) AS g FROM d, range(1, 20000) AS r(k) WHERE k <= length(t) - 59) JOIN w USING (g)"""

SRC = SOURCE.replace("source", "u.source")

P2_DESCRIBED = P2_FOUND.split("SELECT node AS smiles_neutral")[0].rstrip() + """,
d AS (SELECT cc.root, cc.node AS s, n.n FROM cc JOIN n ON n.s = cc.node),
z AS (SELECT root, count(*) AS size FROM d GROUP BY root),
t AS (SELECT x.root, x.s, 1 + coalesce(sum(2.0 * k / (x.n + y.n)), 0) AS dice FROM d x LEFT JOIN (SELECT c.a, c.k, d.root, d.n FROM c JOIN d ON d.s = c.b) y ON y.a = x.s AND y.root = x.root GROUP BY x.root, x.s),
r AS (SELECT t.root, size, s, round(dice / size, 9) AS typicality FROM t JOIN z USING (root))
SELECT root AS cluster_key, size, CAST(place AS INT) AS place, s AS smiles_neutral, typicality FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY typicality DESC, s) AS place FROM r) WHERE place <= 3"""

# who supplies a field is the first by trust, recency and id of those that hold it; the skyline is counted over the
# latest record of each trust and set of held fields
P3_SURVIVORS = f"""WITH u AS (SELECT {KEY} AS inchikey, rec_id, ingested_at AS seen, logS, temp_C, solvent, mol_weight, coalesce(trust_rank, CASE WHEN {SRC} IS NULL THEN 1e9 ELSE 1e6 END) AS t,
  isfinite(logS) AND abs(logS) < 900 AS h0, isfinite(temp_C) AND abs(temp_C) < 900 AS h1, regexp_matches(solvent, '\\S') AS h2, isfinite(mol_weight) AND abs(mol_weight) < 900 AS h3
  FROM unified u LEFT JOIN source_registry r ON {SRC} = r.source),
k AS (SELECT * REPLACE (coalesce(h0, false) AS h0, coalesce(h1, false) AS h1, coalesce(h2, false) AS h2, coalesce(h3, false) AS h3, coalesce(seen, TIMESTAMP '0001-01-01') AS seen) FROM u WHERE inchikey IS NOT NULL),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY inchikey, t, h0, h1, h2, h3 ORDER BY seen DESC, rec_id) AS rn FROM k) WHERE rn = 1),
s AS (SELECT inchikey, count(*) AS skyline FROM c x WHERE NOT EXISTS (SELECT 1 FROM c y WHERE y.inchikey = x.inchikey AND y.rec_id <> x.rec_id AND y.t <= x.t AND (y.seen > x.seen OR y.seen = x.seen AND y.rec_id < x.rec_id)
  AND y.h0 >= x.h0 AND y.h1 >= x.h1 AND y.h2 >= x.h2 AND y.h3 >= x.h3) GROUP BY inchikey),
f AS (SELECT inchikey, count(*) AS rows, first(rec_id ORDER BY t, seen DESC, rec_id) AS rec_id,
  {", ".join(f"first({c} ORDER BY t, seen DESC, rec_id) FILTER (h{i}) AS {c}, first(rec_id ORDER BY t, seen DESC, rec_id) FILTER (h{i}) AS {c}_rec_id" for i, c in enumerate(("logS", "temp_C", "solvent", "mol_weight")))} FROM k GROUP BY inchikey)
SELECT inchikey, rows, CAST(skyline AS INT) AS skyline, rec_id, logS AS "logS", "logS_rec_id", temp_C AS "temp_C", "temp_C_rec_id", solvent, solvent_rec_id, mol_weight, mol_weight_rec_id FROM f JOIN s USING (inchikey)"""

P4_REPORT = f"""WITH pairs AS ({P4_FOUND}), a AS (SELECT DISTINCT row_uid, split FROM folds JOIN split_plan USING (fold) WHERE row_uid IS NOT NULL),
s AS (SELECT DISTINCT row_uid, {SOURCE} AS source FROM unified WHERE row_uid IS NOT NULL), e AS (SELECT a.row_uid, split, source FROM a LEFT JOIN s USING (row_uid) WHERE split <> 'train'),
t AS (SELECT row_uid_a AS row_uid, row_uid_b AS other FROM pairs UNION ALL SELECT row_uid_b, row_uid_a FROM pairs),
m AS (SELECT row_uid, count(*) AS k FROM t WHERE other IN (SELECT row_uid FROM a WHERE split = 'train') GROUP BY row_uid)
SELECT split, source, count(*) AS eval_rows, count(k) AS overlapping_rows, CAST(coalesce(sum(k), 0) AS BIGINT) AS pairs FROM e LEFT JOIN m USING (row_uid) GROUP BY split, source"""

# matched windows of 60 characters on one diagonal, one after the other, are one run; each adds what it covers beyond the one before
P8_RUNS = r"""WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS t FROM documents),
i AS (SELECT item_id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS t FROM eval_items),
w AS (SELECT item_id, length(t) AS n, k, substr(t, k, 60) AS g FROM i, range(1, 5000) AS r(k) WHERE k <= length(t) - 59),
h AS (SELECT doc_id, item_id, n, w.k AS k, x.k AS p FROM (SELECT doc_id, k, substr(t, k, 60) AS g FROM d, range(1, 20000) AS r(k) WHERE k <= length(t) - 59) x JOIN w USING (g)),
l AS (SELECT doc_id, item_id, 59 + max(c) AS run FROM (SELECT doc_id, item_id, count(*) AS c FROM (SELECT doc_id, item_id, p - k AS diag, k - row_number() OVER (PARTITION BY doc_id, item_id, p - k ORDER BY k) AS isle FROM h) GROUP BY doc_id, item_id, diag, isle) GROUP BY ALL),
v AS (SELECT doc_id, item_id, sum(least(60, coalesce(nxt - k, 60))) / CAST(max(n) AS DOUBLE) AS coverage FROM (SELECT doc_id, item_id, n, k, lead(k) OVER (PARTITION BY doc_id, item_id ORDER BY k) AS nxt FROM (SELECT DISTINCT doc_id, item_id, n, k FROM h)) GROUP BY ALL),
z AS (SELECT doc_id, item_id, CAST(run AS INT) AS run, coverage FROM l JOIN v USING (doc_id, item_id))
"""
P8_LEAKS = P8_RUNS + "SELECT doc_id, item_id, run, round(coverage, 6) AS coverage FROM z"
P8_ITEMS = P8_RUNS + """SELECT item_id, coalesce(documents, 0) AS documents, coalesce(longest_run, 0) AS longest_run, round(coalesce(coverage, 0.0), 6) AS coverage FROM (SELECT DISTINCT item_id FROM eval_items)
LEFT JOIN (SELECT item_id, count(DISTINCT doc_id) AS documents, max(run) AS longest_run, max(coverage) AS coverage FROM z GROUP BY item_id) USING (item_id)"""

# what must hold of any assignment and of any mix
P1_CHECK = "SELECT count(DISTINCT row_uid) AS rows, 0::BIGINT AS repeated, 0::BIGINT AS clusters_apart, 0::BIGINT AS keys_apart, 0::BIGINT AS splits_off FROM folds WHERE row_uid IS NOT NULL"
P9_CHECK = f"""SELECT count(DISTINCT {SOURCE}) AS sources, 0::BIGINT AS used_too_often, 0::BIGINT AS strange, 0::BIGINT AS shares_off FROM documents
WHERE text <> '' AND {SOURCE} IN (SELECT {SOURCE} FROM mix_targets WHERE target_share > 0 AND max_repeats > 0)"""

ORACLES = {
    "p1_found": P1_FOUND,
    "p1_check": P1_CHECK,
    "p2_found": P2_FOUND,
    "p2_described": P2_DESCRIBED,
    "p3_found": P3_FOUND,
    "p3_survivors": P3_SURVIVORS,
    "p4_found": P4_FOUND,
    "p4_report": P4_REPORT,
    "p8_found": P8_FOUND,
    "p8_leaks": P8_LEAKS,
    "p8_items": P8_ITEMS,
    "p9_check": P9_CHECK,
}
