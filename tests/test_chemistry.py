"""Molecules: known weights, rejected notations, fingerprints that don't depend on the writing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from limpid.functions import chemistry as X


@pytest.mark.parametrize(("smiles", "weight"), [("CCO", 46.069), ("c1ccccc1O", 94.113), ("CC(=O)Oc1ccccc1C(=O)O", 180.159), ("Cn1cnc2c1c(=O)n(C)c(=O)n2C", 194.194), ("C[N+](=O)[O-]", 61.040), ("ClCCl", 84.93), ("CS(C)=O", 78.13), ("c1cc[nH]c1", 67.091)])
def test_weights(smiles, weight):
    assert X.properties(X.parse(smiles))["mol_weight"] == pytest.approx(weight, abs=0.02)


@pytest.mark.parametrize("bad", [None, "", "nan", "NaN", " C", "CC.O", "C1CC", "C(", "C)", "(C)", "C==C", "Xx", "[Zz]", "C(C)(C)(C)(C)C", "1CC1", "C11"])
def test_rejected(bad):
    assert X.parse(bad) is None


def test_counts_and_rings():
    p = X.properties(X.parse("OC(=O)Cc1ccc(O)cc1CN"))
    assert (p["acids"], p["phenols"], p["amines"], p["rings"], p["donors"]) == (1, 1, 1, 1, 3)
    assert X.ring_atoms(X.parse("C1CC1CC2CC2")) == [True, True, True, False, True, True, True]


def test_fingerprints_ignore_the_writing():
    for a, b in (("OCC", "CCO"), ("c1ccccc1C", "Cc1ccccc1"), ("N(C)C=O", "CN(C=O)")):
        assert np.array_equal(X.circular_bits(X.parse(a)), X.circular_bits(X.parse(b)))
    assert not np.array_equal(X.circular_bits(X.parse("CCO")), X.circular_bits(X.parse("CCN")))


def test_describe(spark):
    df = spark.createDataFrame([("CCO",), ("CCO",), (None,), ("C.C",), ("C" * 3000,)], "s string").withColumn("valid", F.lit("clash"))
    got = {r["s"]: r for r in X.describe(df, "s").collect()}
    assert len(got) == 4 and got["CCO"]["heavy_atoms"] == 3 and not got["C.C"]["valid"] and got[None]["mol_weight"] is None and got["C" * 3000]["heavy_atoms"] == 3000
    assert X.describe(df.where("false"), "s").count() == 0
