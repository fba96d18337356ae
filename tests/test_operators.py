"""Core operators on small literal tables, with the traps of nulls, ties and edges."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from limpid.functions import scalars as S
from limpid.operators import consensus, filters, joins, linear, metrics, outliers, sampling, schema, selection, similarity

NAN, INF = float("nan"), float("inf")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_coercions(spark):
    df = spark.createDataFrame([(" Yes",), ("0",), ("maybe",), (None,), ("nan",), ("1e3",)], "t string")
    assert rows(df.select(S.parse_bool(F.col("t")), S.to_number(F.col("t")))) == [(True, None), (False, 0.0), (None, None), (None, None), (None, None), (None, 1000.0)]


def test_text_temperature(spark):
    df = spark.createDataFrame([("at 37 deg C",), ("37°C",), ("at 120 C",), ("none",), (None,), ("25 degrees and 30 C",)], "t string")
    assert rows(df.select(S.text_temperature(F.col("t")))) == [(37.0,), (37.0,), (None,), (None,), (None,), (25.0,)]


def test_log_solubility(spark):
    df = spark.createDataFrame([(1.0, "mM", "S", 100.0), (10.0, "mg/mL", "S", 100.0), (-3.0, "", "logS", 100.0), (2.0, "", "logS", 100.0), (1.0, "x", "S", 100.0), (1.0, "M", "S", None)], "v double, u string, k string, m double")
    got = [r[0] for r in rows(df.select(S.log_solubility(F.col("v"), F.col("u"), F.col("k"), F.col("m"))))]
    assert got[0] == pytest.approx(-3) and got[1] == pytest.approx(-1) and got[2:] == [None, 2.0, None, None]


def test_saturation_ph(spark):
    df = spark.createDataFrame([(-2.0, [4.0], []), (-2.0, [], [9.0]), (-2.0, None, None), (None, [4.0], [])], "s double, a array<double>, b array<double>")
    acid, base, none, missing = (r[0] for r in rows(df.select(S.saturation_ph(F.col("s"), F.col("a"), F.col("b")))))
    assert acid < 4 and base > 9 and none == pytest.approx(7.0, abs=1e-6) and missing is None


def test_hash_mod_is_exact(spark):
    import hashlib

    df = spark.createDataFrame([("a",), ("ß",), (None,)], "t string")
    want = [int(hashlib.sha1((t or "").encode()).hexdigest(), 16) % 100 for t in ("a", "ß", None)]
    assert [r[0] for r in rows(df.select(S.hash_mod(F.col("t"), 100)))] == want


def test_unify_schema(spark):
    a = spark.createDataFrame([("CCO", "water", 298.15, "-1.5")], "SMILES string, Medium string, T double, LogS string")
    b = spark.createDataFrame([("C", None, "lab")], "smiles string, solvent string, source string")
    got = schema.unify_all({"first": a, "second": b})
    assert got.columns == ["smiles_original", "smiles_neutral", "solvent", "temp_C", "logS", "is_outlier", "source"]
    assert sorted(rows(got), key=str) == sorted([("CCO", None, "water", 25.0, -1.5, None, "first"), ("C", None, None, None, None, None, "lab")], key=str)


def test_align_and_null_rows(spark):
    train = spark.createDataFrame([], "a double, solv_x byte, c string")
    test = spark.createDataFrame([("z", None, 1.0, 5)], "c string, solv_x int, a double, extra int")
    assert rows(schema.align_columns(test, train)) == [(1.0, 0, "z")]
    df = spark.createDataFrame([("CC", "u1", INF), (" ", "u2", 1.0), ("C", None, 1.0), ("C", "u4", NAN)], "smiles_neutral string, row_uid string, x double")
    assert rows(schema.drop_null_rows(df)) == [("CC", "u1", None), ("C", "u4", None)]


def test_encodings(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert sorted(rows(schema.frequency_encode(df, "k", "f")), key=str) == sorted([("a", 0.5), ("a", 0.5), (None, None), ("b", 0.25)], key=str)
    assert schema.one_hot(df, "k", "k_").columns == ["k", "k_a", "k_b", "k_nan"]
    assert rows(schema.hash_one_hot(df, "k", "h", 7).select(sum((F.col(f"h_{i:03d}") for i in range(7)), F.lit(0)))) == [(1,)] * 4


def test_filters(spark):
    df = spark.createDataFrame([(" Water\t", 24.0), ("water", 50.0), ("x", 30.0), (None, None), ("WATER", NAN)], "s string, t double")
    assert filters.equals(df, "s", "water").count() == 3
    assert filters.in_range(df, "t", 24, 50).count() == 3 and filters.in_range(df, "t", 24, 50, strict=True).count() == 1
    assert filters.in_range(df, "t", 24, 50, keep_null=True).count() == 5


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    edges = outliers.bin_edges(df, "x", bins=5)
    assert [r[0] for r in rows(df.select(outliers.bin_of(F.col("x"), edges)))] == [0, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    assert outliers.bin_edges(df.where("false"), "x") == [-0.5, 0.5]


@pytest.mark.parametrize(("n", "flagged"), [(8, 1), (7, 0)])
def test_outliers_need_enough_rows(spark, n, flagged):
    values = [0.1 * i for i in range(n - 1)] + [50.0]
    df = spark.createDataFrame([(v, 20.0) for v in values] + [(None, 20.0), (1.0, None)], "logS double, temp_C double")
    got = outliers.flag_outliers(df)
    assert got.count() == n + 2 and got.agg(F.sum("is_outlier")).first()[0] == flagged


def test_outliers_without_spread(spark):
    df = spark.createDataFrame([(1.0, 20.0)] * 9 + [(9.0, 20.0)], "logS double, temp_C double")
    assert outliers.flag_outliers(df).agg(F.sum("is_outlier")).first()[0] == 0
    assert outliers.flag_outliers(df.where("false")).count() == 0


def test_consensus(spark):
    data = [(1, "A", "w", 25.0, -1.0), (2, "A", "w", 25.0, -2.0), (3, "B", "w", 25.0, -1.0), (4, "B", "w", 25.0, -4.0), (5, "C", "w", None, -3.0), (6, "D", None, 1.0, -1.0), (7, "D", None, 1.0, -1.2), (8, "D", None, 1.0, -9.0), (9, None, "w", 1.0, 0.0), (10, "E", "w", 1.0, None), (11, "E", "w", 1.0, None)]
    df = spark.createDataFrame(data, "rec_id long, InChIKey string, solvent string, temp_C double, logS double")
    got = {r["InChIKey"]: (r["rec_id"], r["logS"]) for r in consensus.consensus(df, ["rec_id"]).collect()}
    assert got["A"] == (1, -1.5) and "B" not in got and got["C"] == (5, -3.0) and got["D"][0] == 6 and got["D"][1] == pytest.approx(-1.1) and got["E"] == (10, None)
    assert {r["InChIKey"] for r in consensus.conflicts(df).collect()} == {"B", "D"}


def test_balance_caps_only_crowded_ambient_cells(spark):
    df = spark.createDataFrame([(i, -1.05, 22.0) for i in range(50)] + [(100 + i, -1.05, 37.0) for i in range(50)] + [(200, None, 22.0), (201, -1.0, 99.0), (202, -1.05, None)], "id long, logS double, temp_C double")
    got = sampling.balance(df, "id", limit=30, iterations=2)
    assert {(r["iter"], r["bin_temp"]): r["count"] for r in got.groupBy("iter", "bin_temp").count().collect()} == {(1, "Ambient"): 30, (2, "Ambient"): 30, (1, "Physio"): 50, (2, "Physio"): 50}


def test_folds_and_split_keep_groups_whole(spark):
    df = spark.createDataFrame([(f"g{i % 40}", float(i % 13)) for i in range(400)] + [(None, 1.0)], "g string, y double")
    f = sampling.group_folds(df, "g", "y")
    assert f.count() == 40 and f.select("g").distinct().count() == 40
    per = f.groupBy("label", "fold").count().groupBy("label").agg((F.max("count") - F.min("count")).alias("d"))
    assert per.where("d > 1").count() == 0
    s = sampling.group_split(df, "g", "y")
    assert s.count() == 40 and 0.1 < s.where("split = 'test'").agg(F.sum("size")).first()[0] / 400 < 0.35


def test_sample_weights(spark):
    df = spark.createDataFrame([(-2.0, 37.0), (-2.0, 25.0), (None, None), (99.0, 37.0)], "logS double, temp_C double")
    got = {(r["logS"], r["temp_C"]): r["weight"] for r in sampling.sample_weights(df).collect()}
    assert got[(-2.0, 37.0)] == pytest.approx(25 * math.log1p(4 / 3)) and got[(99.0, 37.0)] == pytest.approx(25 * math.log1p(4))


def test_selection(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1, 7.0, float(i % 2), None if i % 3 else 1.0) for i in range(30)], "a double, b double, flat double, c double, thin double")
    assert selection.varying(df, df.columns) == ["a", "b", "c"]
    assert selection.select_features(df, df.columns) == ["b", "c"]
    r = {(x["a"], x["b"]): x["r"] for x in selection.correlations(df, ["a", "b", "flat"]).collect()}
    assert r[("a", "b")] == pytest.approx(1.0) and r[("a", "flat")] is None
    assert selection.median_impute(df, ["thin"]).where("thin IS NULL").count() == 0


def test_metrics(spark):
    df = spark.createDataFrame([(-3.0, -3.5), (-5.0, -3.0), (-2.0, -2.0), (-6.0, -6.5), (NAN, 1.0), (1.0, None)], "t double, p double")
    m = metrics.regression(df, "t", "p").first()
    assert m["n"] == 4 and m["rmse"] == pytest.approx(math.sqrt((0.25 + 4 + 0 + 0.25) / 4))
    c = metrics.classification(df, "t", "p").first()
    assert (c["tp"], c["fp"], c["tn"], c["fn"]) == (2, 1, 1, 0) and c["recall"] == 1.0
    assert metrics.ranking(df, "t", "p").first()["roc_auc"] == pytest.approx(3 / 4)
    one = metrics.classification(df.where("t > -4"), "t", "p").first()
    assert one["specificity"] is None and metrics.ranking(df.where("t > -4"), "t", "p").first()["roc_auc"] is None
    assert metrics.regression(df.where("false"), "t", "p").first()["n"] == 0


def test_auc_with_ties(spark):
    rng = np.random.default_rng(1)
    t, p = rng.normal(-4, 1, 200), rng.integers(-6, -2, 200).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(t, p)], "t double, p double")
    pos, neg = p[t > -4], p[t <= -4]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert metrics.ranking(df, "t", "p").first()["roc_auc"] == pytest.approx(want)


def test_params(spark):
    df = spark.createDataFrame([("d", "3"), ("d", "4"), ("r", "0.1"), ("r", "0.3"), ("k", "b"), ("k", "a"), ("k", "a")], "name string, value string")
    assert {r[0]: r[1] for r in metrics.consolidate(df).collect()} == {"d": "4", "r": "0.2", "k": "a"}
    assert {r[0]: r[1] for r in metrics.param_median(df).collect()} == {"d": 4.0, "r": pytest.approx(0.2), "k": None}


def test_oof_joins(spark):
    df = spark.createDataFrame([(" a", 0, 1.0, 1.0, "x"), ("a", 0, 1.0, 3.0, "x"), ("a", 0, 1.0, NAN, "y"), ("b", 1, 1.0, 2.0, "x")], "id string, fold int, y_true double, y_pred double, model string")
    c = joins.oof_collapse(df)
    assert {(r["id"], r["model"]): r["y_pred"] for r in c.collect()} == {("a", "x"): 2.0, ("a", "y"): None, ("b", "x"): 2.0}
    assert [r["id"] for r in joins.oof_wide(c, ["x", "y"]).collect()] == ["a"]


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(scale=0.1, size=300)
    df = spark.createDataFrame([(*map(float, r), float(v), int(i % 5)) for i, (r, v) in enumerate(zip(x, y))], "a double, b double, c double, y double, fold int")
    g = sum(linear.gram(df, ["a", "b", "c"], "y", "fold").values())
    b, w = linear.solve_ridge(g, 10.0)
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (y - y.mean())) / x.std(0)
    assert w == pytest.approx(want) and b == pytest.approx(y.mean() - want @ x.mean(0))
    assert metrics.regression(linear.ridge_oof(df, ["a", "b", "c"], "y"), "y", "y_pred").first()["r2"] > 0.99


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=1, max_size=6))
def test_simplex(w):
    got = linear.to_simplex(np.array(w))
    assert got.min() >= 0 and got.sum() == pytest.approx(1.0)


def test_nnls():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    y = x @ [0.5, 0.0, 0.5] - 0.2 * x[:, 1]
    m = np.column_stack([np.ones(200), x, y])
    w = linear.nnls(m.T @ m)
    assert w.min() >= 0 and w.sum() == pytest.approx(1.0) and w[1] == pytest.approx(0.0, abs=1e-9)


def test_blend_score_skips_missing(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (None, None)], "a double, b double")
    assert [r[0] for r in rows(df.select(linear.blend_score({"a": 1.0, "b": 3.0})))] == [2.5, 3.0, None]


def test_similar_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    v = rng.random((60, 96)) < 0.3
    v[1], v[2] = v[0], v[0] ^ (rng.random(96) < 0.03)
    df = spark.createDataFrame([(i, [bool(x) for x in r]) for i, r in enumerate(v)] + [(99, [False] * 96)], "id long, f array<boolean>").withColumn("w", similarity.bit_words(F.col("f"), 96))
    got = {(r["a"], r["b"]): r["similarity"] for r in similarity.similar_pairs(df, "id", "w", 0.3).collect()}
    want = {(i, j): s for i in range(60) for j in range(i + 1, 60) if (s := (v[i] & v[j]).sum() / (v[i] | v[j]).sum()) >= 0.3}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    clusters = {r["id"]: r["cluster"] for r in similarity.sphere_clusters(df, "id", "w", 0.3).collect()}
    assert len(clusters) == 61 and clusters[99] == -1 and clusters[0] == clusters[1]
    for c in set(clusters.values()) - {-1}:  # all members lie within the limit of one member
        ids = [i for i, k in clusters.items() if k == c]
        assert any(all(i == j or want.get((min(i, j), max(i, j)), 0) >= 0.3 for j in ids) for i in ids)


def test_similar_pairs_send_a_vector_once_a_block(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 16)
    rng = np.random.default_rng(6)
    v = rng.random((64, 192)) < 0.4
    v[7] = v[40] ^ (rng.random(192) < 0.04)
    df = spark.createDataFrame([(i, [bool(x) for x in r]) for i, r in enumerate(v)], "id long, f array<boolean>").withColumn("w", similarity.bit_words(F.col("f"), 192))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = similarity.similar_pairs(df, "id", "w", 0.7)
        assert (7, 40) in {(r["a"], r["b"]) for r in pairs.collect()}
        todo, sent = [pairs._jdf.queryExecution().executedPlan()], 0
        while todo:
            plan = todo.pop()
            if plan.nodeName() == "Exchange":
                sent += plan.metrics().apply("shuffleRecordsWritten").value()
            todo += [plan.children().apply(i) for i in range(plan.children().size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert 0 < sent <= 64 * 4  # four blocks; under rare bits 3,036 rows were sent


def test_mahalanobis_and_pca(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(100, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(100, None)], "id long, v array<double>")
    inv = np.linalg.pinv(np.cov(x.T))
    want = [math.sqrt((r - x.mean(0)) @ inv @ (r - x.mean(0))) for r in x]
    got = [r["distance"] for r in similarity.mahalanobis(df, "v", 4).orderBy("id").collect()]
    assert got == pytest.approx(want)
    p = similarity.pca(df, "v", 4).agg(F.var_pop("pc1"), F.var_pop("pc2"), F.corr("pc1", "pc2")).first()
    assert p[0] >= p[1] and abs(p[2]) < 1e-6
