"""Quantiles, sums, sweeps and the smaller workflow steps against brute force, with nulls, ties and empty tables."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from limpid.functions import scalars as S
from limpid.operators import filters, joins, linear, metrics, models, sampling, schema, selection, similarity
from limpid.operators.quantiles import group_quantiles
from limpid.sources import files

NAN, INF = float("nan"), float("inf")


def test_quantiles_equal_numpy(spark):
    rng = random.Random(1)
    rows = [("abc"[i % 3], rng.choice([rng.uniform(-5, 5), 1.5, -2.0, None, NAN, INF])) for i in range(400)] + [("one", 3.0), ("none", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("n", F.lit("x")).withColumn("k", F.lit(1))
    shares = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {r["g"]: r for r in group_quantiles(df, F.col("v"), shares, F.col("g")).collect()}
    for g in ("a", "b", "c", "one", None):
        held = [v for k, v in rows if k == g and v is not None and np.isfinite(v)]
        assert got[g]["n"] == len(held) and [got[g][f"q{i}"] for i in range(5)] == pytest.approx(np.quantile(held, shares).tolist())
    assert "none" not in got
    assert group_quantiles(df.where("false"), F.col("v"), shares).count() == 0
    whole = [v for _, v in rows if v is not None and np.isfinite(v)]
    assert group_quantiles(df, F.col("v"), [0.5]).first()["q0"] == pytest.approx(np.median(whole))


@given(st.lists(st.integers(1, 30), max_size=40), st.integers(0, 20), st.integers(0, 120))
@settings(max_examples=200, deadline=None)
def test_take_nearer_is_the_sequential_rule(sizes, at, goal):
    taken = np.zeros(len(sizes), bool)
    got = sampling.take_nearer(np.array(sizes, np.int64), taken, at, goal)
    want = []
    for s in sizes:
        want.append(abs(at + s - goal) < abs(at - goal))
        at += s * want[-1]
    assert taken.tolist() == want and got == at


def test_gram_blocks_equal_sums(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4))
    rows = [(*map(float, r), int(i % 3)) for i, r in enumerate(x)] + [(None, 1.0, 1.0, 1.0, 0), (1.0, NAN, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int").withColumn("x", F.lit(2)).withColumn("k", F.lit(2)).repartition(5)
    few = linear.gram(df, ["a", "b", "c"], "y", "fold")
    monkeypatch.setattr(linear, "FEW", 2)
    many = linear.gram(df, ["a", "b", "c"], "y", "fold")
    assert few.keys() == many.keys() == {0, 1, 2} and all(np.allclose(few[k], many[k]) for k in few)
    assert np.allclose(linear.gram(df, ["a", "b", "c"], "y")[None], sum(few.values()))


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(4)
    names = [f"c{i}" for i in range(60)]
    x = pd.DataFrame(rng.normal(size=(200, 60)) + 1e6, columns=names)
    x["c1"] = x["c0"] * -3 + 2
    x["c2"] = 7.0
    x = x.mask(rng.random(x.shape) < 0.05)
    df = spark.createDataFrame(x.astype(object).where(x.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in names))
    want = x.corr()
    got = selection.correlations(df, names).collect()
    assert len(got) == 60 * 59 // 2
    for r in got:
        w = want.loc[r["a"], r["b"]]
        assert r["r"] is None if np.isnan(w) else r["r"] == pytest.approx(w, abs=1e-6)
    assert selection.correlations(df.where("false"), names[:3]).where("r IS NOT NULL").count() == 0


@pytest.mark.parametrize("block", [4096, 4])
def test_pairs_in_blocks_and_the_sweep(spark, block, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rng = random.Random(9)
    rows = [(i, [rng.getrandbits(6) | 1 << rng.randrange(6), rng.getrandbits(4)]) for i in range(70)] + [(70, [0, 0]), (None, [1, 1]), (71, None)]
    df = spark.createDataFrame(rows, "id long, w array<long>").withColumn("k", F.lit("x")).withColumn("cell", F.lit(0))
    bit = lambda w: {(i, b) for i, x in enumerate(w) for b in range(8) if x >> b & 1}
    held = {i: bit(w) for i, w in rows if i is not None and w is not None}
    near = {(a, b): len(held[a] & held[b]) / len(held[a] | held[b]) for a in held for b in held if a < b and held[a] | held[b]}
    want = {k: v for k, v in near.items() if v >= 0.6}
    got = similarity.similar_pairs(df, "id", "w", 0.6).collect()
    assert len(got) == len(want) and {(r["a"], r["b"]): r["similarity"] for r in got} == pytest.approx(want)
    link = {i: {b if a == i else a for a, b in want if i in (a, b)} for i in held}
    order = sorted((i for i in held if held[i]), key=lambda i: (-len(link[i]), i))
    cluster, n = {70: -1}, 0
    for i in order:
        if i not in cluster:
            for j in {i} | link[i]:
                cluster.setdefault(j, n)
            n += 1
    assert {r["id"]: r["cluster"] for r in similarity.sphere_clusters(df.where("w IS NOT NULL"), "id", "w", 0.6).collect()} == cluster


def test_labels_and_defaults(spark):
    df = spark.createDataFrame([("at 37 C", 2.0, None), ("at 400 C", NAN, 3.5), (None, None, None)], "t string, a double, b double")
    got = df.select(S.assumed_temperature(F.col("t")).alias("t"), S.numbered_label("Phase_", F.col("a")).alias("p"), S.pka_or_inert(F.col("a"), F.col("b")).alias("k")).collect()
    assert [tuple(r["t"]) for r in got] == [(37.0, False), (25.0, True), (25.0, True)]
    assert [r["p"] for r in got] == ["Phase_2", None, None]
    assert [tuple(r["k"]) for r in got] == [(2.0, -2.0), (16.0, 3.5), (16.0, -2.0)]


def test_joins_splits_and_reports(spark, tmp_path):
    a = spark.createDataFrame([("x", 2, 1), ("x", 1, 9), ("y", 1, 1), (None, 0, 0)], "id string, fold int, v int")
    b = spark.createDataFrame([("x", 5), ("x", 4), ("z", 1)], "id string, v int")
    assert [tuple(r) for r in joins.inner_once(a, b, "id", ["fold", "v"], "_smi").select("id", "fold", "v", "v_smi").collect()] == [("x", 1, 9, 4)]
    assert joins.inner_once(a.where("false"), b, "id", ["v"], "_smi").count() == 0
    parts = spark.range(4000).select(sampling.random_split(F.col("id"), {"a": 0.5, "b": 0.3, "c": 0.2}).alias("p")).groupBy("p").count().collect()
    assert {r["p"]: round(r["count"] / 4000, 1) for r in parts} == {"a": 0.5, "b": 0.3, "c": 0.2}
    assert schema.column_report(a, b) == [("fold", "left"), ("id", "both"), ("v", "both")]
    assert schema.prefixed_columns(a, ("f",), ("id",)) == ["id", "fold"]
    assert [tuple(r) for r in filters.first_rows(a, 1, F.desc("v")).select("v").collect()] == [(9,)]
    ranked = metrics.ranked(spark.createDataFrame([("m", 2.0), ("k", 1.0), ("l", 1.0), ("n", None)], "model string, rmse double"), "model", "rmse")
    assert {r["model"]: r["place"] for r in ranked.collect()} == {"k": 1, "l": 2, "m": 3, "n": 4}
    assert metrics.model_card("e", "mean", {"b": 0.5, "a": 0.5}, {"rmse": 1}, 3)["models"] == ["a", "b"]
    files.write_any(b, f"{tmp_path}/b.csv")
    got, left = files.read_sources(spark, {"b": f"{tmp_path}/b.csv", "c": f"{tmp_path}/c.csv", "d": f"{tmp_path}/b.csv"}, skip=("d",), schema=b.schema)
    assert list(got) == ["b"] and got["b"].count() == 3 and left == {"c": "missing", "d": "skipped"}


def test_trees_without_constant_features(spark):
    df = spark.createDataFrame([(i, float(i % 7), 1.0, float(i % 7) * 2, i % 2) for i in range(80)], "id long, a double, same double, y double, fold int")
    model = models.fit_full(df, ["same", "a"], "y", "boost_wide", params={"maxIter": 3})
    assert models.importances(model, ["same", "a"]) == {"same": 0.0, "a": 1.0}
    out = models.oof(df, ["same", "a"], "y", "id", flavours={"quick": ("gbt", {"maxDepth": 3, "maxIter": 3})})
    assert out.count() == 80 and metrics.regression(out, "y_true", "y_pred").first()["rmse"] < 2
    found = models.search(df, ["a"], "y", "rf", trials=1)
    assert len(found) == 1 and found[0][0] >= 0
    wide = df.select("id", F.col("a").alias("oof_a"), F.col("y").alias("oof_b"))
    assert linear.ensemble(wide, blend={"oof_a": 1.0, "oof_b": 3.0}).where("id = 1").first()["prediction"] == pytest.approx(1.75)
    assert linear.ensemble(wide, stack=({"oof_a": 2.0}, 1.0), blend={"oof_a": 1.0}).where("id = 1").first()["prediction"] == pytest.approx(3.0)


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_search_on_cells_equals_fits_on_rows(spark, kind, monkeypatch):
    rng = random.Random(5)
    rows = [(i, i % 3, float(i // 3 % 9), float(i // 27 % 7), rng.gauss(0, 0.3) + (i // 3 % 9 > 4) * (i // 27 % 7)) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double, y double")
    monkeypatch.setattr(models, "SEARCH", {"gbt": {"maxDepth": (2, 3), "maxIter": (4,), "stepSize": (0.2,)}, "rf": {"maxDepth": (3,), "numTrees": (30,)}})
    fast = models.search(df, ["a", "b"], "y", kind, trials=2)
    monkeypatch.setattr(models, "MAX_CELLS", 0)  # cells beyond the bound: every fit is one of pyspark.ml
    slow = models.search(df, ["a", "b"], "y", kind, trials=2)
    assert [p for _, p in fast] == [p for _, p in slow]
    near = 1e-9 if kind == "gbt" else 0.08  # forests are drawn, boosting is not
    assert all(abs(x - y) < near for (x, _), (y, _) in zip(fast, slow))


def test_search_reads_the_rows_a_few_times(spark, monkeypatch):
    df = spark.createDataFrame([(i % 3, float(i % 90), float(i % 7)) for i in range(300)], "fold int, a double, y double")
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    before = jobs()
    models.search(df, ["a"], "y", "gbt", trials=1)
    assert jobs() - before < 60  # 3 fits by pyspark.ml are several hundred jobs
