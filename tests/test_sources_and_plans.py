"""Readers and writers, pipelines, streams and the entry points."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__
from limpid.operators import filters, models
from limpid.plans import catalogue, pipelines
from limpid.plans.reference import measurements
from limpid.sources import files
from limpid.streaming import score


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "i int, s string")
    for suffix in ("parquet", "csv", "tsv", "json"):
        path = f"{tmp_path}/x.{suffix}"
        files.write_any(df, path, single=True)
        assert sorted((r["i"], r["s"]) for r in files.read_any(spark, path).collect()) == [(1, "a,b"), (2, None)]
    with pytest.raises(ValueError):
        files.read_any(spark, f"{tmp_path}/x.xlsx")
    files.write_metrics(spark, {"rmse": 1.5}, f"{tmp_path}/m")
    assert files.read_metrics(spark, f"{tmp_path}/m") == {"rmse": 1.5}


def test_read_auto_and_empty(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x;y\n1;b\n")
    assert files.read_auto(spark, f"{tmp_path}/a.txt").columns == ["x", "y"]
    schema = T.StructType().add("x", T.IntegerType())
    assert files.read_or_empty(spark, f"{tmp_path}/none.parquet", schema).count() == 0
    files.write_empty(spark, schema, f"{tmp_path}/e.parquet")
    assert spark.read.parquet(f"{tmp_path}/e.parquet").schema == schema
    assert files.file_digests(spark, f"{tmp_path}/a.txt").first()["md5"] == __import__("hashlib").md5(b"x;y\n1;b\n").hexdigest()


def test_headers():
    assert files.header_kind(["SMILES_Solute", "Solvent", "Temperature_K"]) == "main"
    assert files.header_kind(["Solvent", "CAS"]) == "solvent" and files.header_kind(["a"]) is None
    assert files.rank_files([("s", 9, ["Solvent", "CAS"]), ("m", 1, ["SMILES_Solute", "Solvent", "Temperature_K"]), ("x", 99, ["a"])], "auto") == ["m", "s", "x"]


def test_execute_batch_and_stream(spark, sf, tmp_path):
    m = measurements(spark, sf).select("rec_id", "solvent", "temp_C", "logS", "source")
    m.write.parquet(f"{tmp_path}/in")
    coefficients = {"intercept": -3.0, "inv_temp": -0.1, "alpha": 1.0, "n": 9.0}
    stream = score.score_stream(score.read_stream(spark, f"{tmp_path}/in", m.schema), coefficients)
    q = score.write_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out")
    none = F.lit(None).cast("double")
    want = pipelines.execute(filters.equals(m, "solvent", "water"), coefficients, none, none)
    assert got.count() == want.count() > 0
    assert got.agg(F.round(F.sum("logS_ph"), 6)).first() == want.agg(F.round(F.sum("logS_ph"), 6)).first()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert o.keys() <= q.keys() and len(q) > 60


CORE = sorted(catalogue.ORACLES)


@pytest.mark.parametrize("name", CORE)
def test_queries_equal_sql(equal_sql, name):
    equal_sql(catalogue.QUERIES[name], catalogue.ORACLES[name])


def test_gbt_oof_runs_the_production_models(spark, sf, monkeypatch):
    asked = {}

    def oof(df, features, target, key, flavours=models.FLAVOURS):
        asked.update(flavours)
        return df.select("rec_id", "fold").withColumn("y_pred", F.lit(0.0))

    monkeypatch.setattr(models, "oof", oof)
    __spark_entry__.queries()["gbt_oof"](spark, sf)
    assert asked == models.FLAVOURS and len(asked) == 3
    monkeypatch.setattr(models, "search", lambda df, features, target, kind: [(0.5, {"maxDepth": 3}), (0.75, {"maxDepth": 4})])
    assert __spark_entry__.queries()["gbt_search"](spark, sf).where("place = 1 AND rmse = 0.5").count() == len(models.SEARCH)
