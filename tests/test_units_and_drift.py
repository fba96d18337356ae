"""Problems 6 and 7 on small tables: stated units, mixtures, drifting files, and the defined edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from limpid.operators import drift, units

NAN, INF = float("nan"), float("inf")
REGISTRY = [("plain", 1, "log10 mol/L, Celsius"), ("station", 2, "temperatures delivered in kelvin"), ("cards", 3, "written as negative decadic logarithm, mol/L"), ("course", 4, None)]
SCHEMA = "rec_id long, source string, temp_C double, logS double, mol_weight double, assay_description string"


def convert(spark, rows, extra=False):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    if extra:
        df = df.withColumn("unit", F.lit("x")).withColumn("x", F.lit(1)).withColumn("src", F.lit("y"))
    reg = spark.createDataFrame(REGISTRY, "source string, trust_rank int, remark string")
    return {(r["rec_key"], r["field"]): r for r in units.convert_measurements(df, reg).collect()}


TEXTS = {
    "ln of the molar solubility": "ln mol/L",
    "value = ln(c / mol L-1)": "ln mol/L",
    "Natural logarithm, mol/L": "ln mol/L",
    "log10 of mmol/L": "log10 mmol/L",
    "logS (mM)": "log10 mmol/L",
    "log c, c in µM": "log10 umol/L",
    "decadic log, mg/mL": "log10 g/L",
    "log of grams per litre": "log10 g/L",
    "-log10 S in mol/L": "-log10 mol/L",
    "given as pS": "-log10 mol/L",
    "plain mol/L, not logarithmic": "mol/L",
    "log10 mol/L, 3 replicates": "log10 mol/L",
    "Stock 10 mM in DMSO": None,
    "Dose 5 mg/mL in vehicle": None,
    "log P 2.1 by HPLC": None,
    "ln k' from retention": None,
    "": None,
    None: None,
}


def test_stated_solubility(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert {r["t"]: r["u"] for r in df.select("t", units.stated(F.col("t")).solubility.alias("u")).collect()} == TEXTS


def test_stated_temperature(spark):
    cases = [
        ("Run at 77 F", 77.0, "F"),
        ("dried at 212 F", 77.0, None),
        ("dried at 77 F", 77.0, None),
        ("readings in degF", 77.0, "F"),
        ("72 F in the room, cell in Celsius", 25.0, "C"),
        ("72 F in the room, cell in Celsius", 72.0, "C"),  # a number that happens to be the recorded one
        ("Bath 72 F outside, cell in Celsius", 72.0, "C"),
        ("kept at 298 K before, then at the value in °C", 298.0, "C"),
        ("T = 298.15 kelvin", 298.15, "K"),
        ("T(F)=77", 77.0, "F"),
        ("T/K from the logger; melts at 77 F", 298.0, "K"),
        ("Melts at 412 K", 25.0, None),
        ("", 25.0, None),
        (None, 25.0, None),
    ]
    df = spark.createDataFrame(cases, "t string, x double, want string").withColumn("w", units.stated(F.col("t")))
    assert [(r["want"], r["got"]) for r in df.select("want", units.stated_temperature(F.col("w"), F.col("x")).alias("got")).collect()] == [(w, w) for _, _, w in cases]


def test_held_out_units(spark, sf):
    got = units.held_out_units(spark.read.parquet(f"{sf}/unified.parquet"), spark.read.parquet(f"{sf}/source_registry.parquet"))
    rows = {(r["field"], r["unit"]): r for r in got.collect()}
    assert all(r["right"] <= r["rows"] and r["sure_right"] <= r["sure"] <= r["rows"] for r in rows.values())
    assert rows[("temp_C", "K")]["right"] == rows[("temp_C", "K")]["rows"]


@pytest.mark.parametrize("extra", [False, True])
def test_convert(spark, extra):
    usual = [("plain", 20.0 + i % 10, -3.0 - i % 4, 300.0, None) for i in range(60)]
    got = convert(spark, [*usual, ("plain", 298.15, -2.0, 300.0, None), ("station", 310.0, -2.0, None, None), (" CARDS ", 25.0, 3.5, None, None), ("course", 77.0, -1.0, 100.0, "Run at 77 F; log10(mg/mL)"), (None, -999.0, NAN, None, None), (None, INF, 9999.0, -1.0, ""), (None, None, None, None, None), ("course", 25.0, 1.0, None, "log of g/L"), ("plain", 25.0, -1.0, 1.0, "x " * 20000)], extra)
    t, s = (lambda i: got[(60 + i, "temp_C")]), (lambda i: got[(60 + i, "logS")])
    assert t(0)["unit"] == "K" and t(0)["how"] == "value" and t(0)["value"] == pytest.approx(25.0)
    assert t(1)["unit"] == "K" and t(1)["how"] == "source" and s(2)["unit"] == "-log10 mol/L" and s(2)["value"] == -3.5
    assert t(3)["value"] == pytest.approx(25.0) and s(3)["unit"] == "log10 g/L" and s(3)["value"] == pytest.approx(-3.0)
    assert all(got[(k, f)]["unit"] is None and got[(k, f)]["value"] is None for k in (64, 65, 66) for f in ("temp_C", "logS"))
    assert all(got[(i, f)]["unit"] == u for i in range(60) for f, u in (("temp_C", "C"), ("logS", "log10 mol/L")))
    assert got[(68, "logS")]["unit"] == "log10 mol/L" and len(got) == 2 * 69


def test_empty_and_repeated(spark):
    assert convert(spark, []) == {}
    df = spark.createDataFrame([(1, "plain", 300.0, -1.0, None, None)] * 2, SCHEMA)
    reg = spark.createDataFrame(REGISTRY, "source string, trust_rank int, remark string")
    found = units.foreign_units(units.convert_measurements(df, reg))
    assert [tuple(r) for r in found.collect()] == [("unified", 1, "temp_C")] * 2


def test_challenge(spark):
    data = [(i, 290.0 + i % 20, None) for i in range(50)] + [(100, 29815.0, None), (101, 2981.5, "x"), (102, 25.0, None), (103, 77.0, "77 F"), (104, 0.0, None), (105, NAN, None), (106, -999.0, None), (107, None, "25 °C"), (108, 298.15, "stored at 4 °C")]
    df = spark.createDataFrame(data, "item_no long, temperature_K double, remark string")
    got = {r["rec_key"]: r["unit"] for r in units.convert_temperatures(df).collect()}
    assert {k: got[k] for k in range(100, 109)} == {100: "K/100", 101: "K/10", 102: "C", 103: "F", 104: None, 105: None, 106: None, 107: None, 108: "K"}
    assert units.convert_temperatures(df.where("false")).count() == 0


def raw(spark, files):
    data = [(i, feed, seq, n, json.dumps(p) if not isinstance(p, (str, type(None))) else p) for i, (feed, seq, n, p) in enumerate((feed, seq, n, p) for (feed, seq), ps in files.items() for n, p in enumerate(ps))]
    return spark.createDataFrame(data, "raw_id long, feed string, file_seq int, line_no int, payload string").withColumn("received_at", F.current_timestamp()).withColumn("field", F.lit("clash")).withColumn("v", F.lit(0))


def test_drift(spark):
    files = {
        ("a", 1): [{"SMILES": "CC", "Solvent": "water", "logS": -1.5, "source": "x", "ph": 7}, {"SMILES": None, "logS": None}],
        ("a", 2): [{"SMILES": "CC", "Medium": "water", "logS": "-1,5", "ph": 7.5, "source": "x"}, {"new": True}],
        ("a", 4): [{"smi": ["CC"], "Medium": {"name": "water"}, "logS": {"value": -2.5}, "ph": None, "new": None}],
        ("a", 5): [None, "", "not json", "[1]"],
        ("b", 1): [{"x": 1}],
        (None, 1): [{"x": 1}],
    }
    df = raw(spark, files)
    got = {tuple(r)[:4] for r in drift.schema_changes(df.unionByName(df)).collect()}  # repeated records change nothing
    assert got == {
        ("a", 2, "solvent", "renamed"), ("a", 2, "logS", "retyped"), ("a", 2, "new", "added"),
        ("a", 4, "smiles_original", "renamed"), ("a", 4, "smiles_original", "retyped"), ("a", 4, "solvent", "retyped"), ("a", 4, "logS", "retyped"), ("a", 4, "source", "removed"),
        *{("a", 5, f, "removed") for f in ("smiles_original", "solvent", "logS", "ph", "new")},
    }
    t = {r["raw_id"]: r for r in drift.one_table(df).collect()}
    assert len(t) == df.count()
    assert (t[2]["smiles_original"], t[2]["solvent"], t[2]["logS"], t[2]["source"]) == ("CC", "water", -1.5, "x")
    assert (t[4]["smiles_original"], t[4]["solvent"], t[4]["logS"]) == ("CC", "water", -2.5) and t[4]["other"] == {"ph": None, "new": None}
    assert t[7]["smiles_original"] is None
    assert drift.schema_changes(df.where("false")).count() == 0


def test_two_names_of_one_role_and_long_values(spark):
    df = raw(spark, {("a", 1): [{"Solvent": "w", "solvent_medium": "x" * 100000}], ("a", 2): [{"solvent_medium": "y"}]})
    got = {tuple(r)[:4] for r in drift.schema_changes(df).collect()}
    assert got == {("a", 2, "solvent", "renamed"), ("a", 2, "solvent_medium", "removed")}


def test_roles_by_words():
    assert [drift.role_of(n) for n in ("SMILES_Solvent", "canonical smiles", "log_S_20C", "data_source", "stir_rpm", "resource")] == ["solvent", "smiles_original", "logS", "source", None, None]


def test_stated_unit_stands_without_a_target(spark):
    rows = [(1, "a", "logS in log10(mg/mL)", None, -2.0), (2, "a", "logS in log10(mg/mL)", float("nan"), -2.0), (3, "a", "solubility in mol/L, not log", 100.0, 0.0), (4, "a", "solubility in mol/L, not log", 100.0, -3.0)]
    df = spark.createDataFrame([(*r, None) for r in rows], "rec_id long, source string, assay_description string, mol_weight double, logS double, temp_C double")
    registry = spark.createDataFrame([], "source string, remark string")
    got = {r["rec_key"]: r for r in units.convert_measurements(df, registry).where("field = 'logS'").collect()}
    assert [got[k]["unit"] for k in (1, 2, 3)] == ["log10 g/L", "log10 g/L", "mol/L"] and all(got[k]["value"] is None and got[k]["how"] == "text" for k in (1, 2, 3))
    assert got[4]["how"] != "text"  # no concentration is negative
