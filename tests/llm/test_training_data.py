"""The training-data operators against brute force on small tables, with nulls, ties, repeats, long texts and clashing columns."""

import itertools
import random
import string
import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from limpid.llm import canonical, clusters, graph, leaks, mixing, overlaps, queries, splits, survivors, toxicity
from limpid.llm.shingles import code_points, grams, window_minima
from limpid.runtime import Scratch, clean_key


@pytest.fixture(scope="module")
def scratch(spark):
    return Scratch(spark, "test")


def roots(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


def test_clean_key(spark):
    df = spark.createDataFrame([(" abc-d ",), ("InChIKey=ABC-D",), ("inchikey= abc-d\t",), ("",), (" \t",), (None,), ("InChIKey=",)], "k string")
    assert [r[0] for r in df.select(clean_key(F.col("k"))).collect()] == ["ABC-D"] * 3 + [None] * 4


# -- components -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, scratch, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(200):03d}", f"n{rng.randrange(200):03d}") for _ in range(120)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)] + [("hub", f"h{i}") for i in range(40)] + [("self", "self")]
    df = spark.createDataFrame([*edges, (None, "n001"), *edges[:20]], "a string, b string")
    got = {r["node"]: r["root"] for r in graph.components(df, scratch).collect()}
    assert got == roots(edges)
    assert graph.components(df.where("false"), scratch).count() == 0


# -- 1 ----------------------------------------------------------------------------------------------------------

PLAN = [(0, "train", 0.2), (1, "train", 0.2), (2, "train", 0.2), (3, "validation", 0.2), (4, "test", 0.2)]


def fold_tables(spark, folds, unified):
    f = spark.createDataFrame(folds, "row_uid string, fold int, cluster_ecfp4_0p7 int").withColumn("node", F.lit("x")).withColumn("grp", F.lit(1))
    u = spark.createDataFrame(unified, "row_uid string, InChIKey string, smiles_neutral string, source string").withColumn("fold", F.lit(9)).withColumn("mark", F.lit("x"))
    return f, u, spark.createDataFrame(PLAN, "fold int, split string, target_share double")


def test_split_groups(spark, scratch):
    folds = [("a", 0, 1), ("b", 1, 1), ("c", 2, -1), ("d", 3, None), ("e", 4, None), ("f", 0, 2), ("f", 0, 2), ("g", 0, 2), ("h", 1, None), ("h", 2, None), ("i", None, 7), (None, 3, 7), ("j", 0, 8), ("k", 1, 9)]
    unified = [("c", "KEY1-x", None, None), ("d", " inchikey=key1-X", None, None), ("e", "", None, None), ("j", "K2", None, None), ("z", "K2", None, None), ("k", None, None, None), (None, "K2", None, None)]
    f, u, plan = fold_tables(spark, folds, unified)
    assert {r[0] for r in splits.split_groups(f, u, scratch).collect()} == {"a", "b", "c", "d", "h"}
    assert splits.split_groups(f.where("false"), u, scratch).count() == 0
    assert splits.split_groups(f, u.where("false"), scratch).count() == 3
    got = splits.assign_splits(f, u, plan, scratch)
    assert got.count() == 11 and got.groupBy("grp").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert splits.assign_splits(f, u, plan.where("false"), scratch).select("split").distinct().collect()[0][0] == "train"
    assert splits.assign_splits(f.where("false"), u, plan, scratch).count() == 0
    assert splits.split_report(got, f, plan).agg(F.sum("rows")).first()[0] == 13


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 30)), min_size=1, max_size=12, unique_by=lambda x: x[0]))
def test_choose_sizes(sizes):
    got = splits.choose_sizes(sizes, [("train", 0.6), ("validation", 0.2), ("test", 0.2)])
    total = sum(s * n for s, n in sizes)
    assert {s: sum(by.values()) for s, by in got.items()} == dict(sizes)
    reach = {0}
    for s, n in sizes:
        reach = {r + s * k for r in reach for k in range(n + 1)}
    goal = round(total * 0.2)
    first = sum(s * by.get("test", 0) for s, by in got.items())  # the first split served: as close as any subset sum
    assert abs(first - goal) == min(abs(r - goal) for r in reach)


# -- 2 ----------------------------------------------------------------------------------------------------------


def family(rng, n, length=90):
    base = "".join(rng.choice("CNOcn1()=S") for _ in range(length))
    out = [base]
    for _ in range(n - 1):
        at = rng.randrange(length - 10)
        out.append(base[:at] + "".join(rng.choice("CNOcn1()=S") for _ in range(rng.choice((2, 12)))) + base[at + rng.choice((0, 8)) :])
    return out


def similar(a, b):
    x, y = ({s[i : i + 10] for i in range(len(s) - 9)} for s in (a, b))
    return bool(x) and bool(y) and 2 * len(x & y) >= len(x | y)


@pytest.mark.parametrize("cell", [2048, 3])
def test_similarity_clusters(spark, scratch, cell, monkeypatch):
    monkeypatch.setattr(clusters, "CELL", cell)  # small cells are compared in blocks
    rng = random.Random(4)
    texts = [t for n, length in ((6, 90), (5, 90), (4, 50), (3, 22), (7, 200), (1, 90)) for t in family(rng, n, length)]
    texts += ["short", "C" * 9, "ab" * 5, "ab" * 5 + "a", "C" * 4000, "C" * 4001, "ÄÖ☃" * 12, "ÄÖ☃" * 12 + "x"]
    df = spark.createDataFrame([(t,) for t in [*texts, *texts[:9], None, "", "nan"]], "smiles_neutral string").withColumn("cell", F.lit(1)).withColumn("s", F.lit("y"))
    want = roots([(a, b) for a, b in itertools.combinations(texts, 2) if similar(a, b)])
    got = clusters.similarity_clusters(df, scratch)
    assert {tuple(r) for r in got.collect()} == set(want.items())
    assert clusters.similarity_clusters(df.where("false"), scratch).count() == 0
    d = clusters.describe_clusters(got, scratch, top=2)
    sizes = pd.Series(want).value_counts()
    assert {r["cluster_key"]: r["size"] for r in d.collect()} == sizes.to_dict()
    assert d.where("place > 2").count() == 0 and d.where("place = 1").count() == len(sizes)


def test_similar_values_in_many_short_runs(spark, scratch):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("CNOcn1()=S") for _ in range(n))
    runs = [text(23) for _ in range(3)]  # three common runs of 23 characters and no longer one: 42 of 82 shingles
    pair = [runs[0] + "Br" + runs[1] + "Cl" + runs[2], "".join(runs)]
    subs = []
    for _ in range(20):  # three evenly placed substitutions in 100 characters
        a = text(100)
        subs.append((a, "".join("#" if k in (25, 50, 75) else c for k, c in enumerate(a))))
    assert similar(*pair) and not any(pair[0][k : k + 24] in pair[1] for k in range(len(pair[0]) - 23))
    texts = pair + [t for ab in subs for t in ab]
    want = roots([(a, b) for a, b in itertools.combinations(texts, 2) if similar(a, b)])
    assert len(want) >= 40
    got = clusters.similarity_clusters(spark.createDataFrame([(t,) for t in texts], "smiles_neutral string"), scratch)
    assert {tuple(r) for r in got.collect()} == set(want.items())


def test_repetitive_values_of_unlike_length(spark, scratch):
    texts = ["C" * 18 + "(=O)O", "C" * 40 + "(=O)O"]
    assert similar(*texts)
    got = clusters.similarity_clusters(spark.createDataFrame([(t,) for t in texts], "smiles_neutral string"), scratch)
    assert {r[0] for r in got.collect()} == set(texts)


def test_repeated_motifs_of_all_lengths(spark, scratch):
    texts = [m * n for m in ("C", "OCC", "NCC(=O)") for n in range(3, 61)] + ["CC(=O)" + "OCC" * n for n in range(3, 60, 7)]
    want = roots([(a, b) for a, b in itertools.combinations(texts, 2) if similar(a, b)])
    got = clusters.similarity_clusters(spark.createDataFrame([(t,) for t in texts], "smiles_neutral string"), scratch)
    assert {tuple(r) for r in got.collect()} == set(want.items())


@pytest.mark.parametrize("whole", [clusters.WHOLE, 0])
def test_typicality_is_the_mean_dice_similarity(spark, scratch, whole, monkeypatch):
    monkeypatch.setattr(clusters, "WHOLE", whole)  # 0: every cluster by joins and sums
    rng = random.Random(3)
    text = "".join(rng.choice("CNOcn1()=S") for _ in range(49))
    texts = [text[:19], text[:29], text]  # nested sets of 10, 20 and 40 shingles
    got = clusters.describe_clusters(spark.createDataFrame([(t, text[:19]) for t in texts], "smiles_neutral string, cluster_key string"), scratch)
    want = {a: np.mean([2 * min(len(a) - 9, len(b) - 9) / (len(a) + len(b) - 18) for b in texts]) for a in texts}
    assert {r["smiles_neutral"]: r["typicality"] for r in got.collect()} == pytest.approx(want, abs=1e-8)
    assert [r["smiles_neutral"] for r in got.where("place = 1").collect()] == [texts[1]]


def test_window_minima_meet():
    rng = random.Random(1)
    run = "".join(rng.choice(string.ascii_lowercase) for _ in range(31))
    texts = ["xx" + run + "yyy", "q" * 40 + run]
    flat, offsets = code_points(texts)
    h, own = grams(flat, offsets, 24)
    low, whose, _, _ = window_minima(h, own, 8)
    assert set(low[whose == 0]) & set(low[whose == 1])


# -- 3 ----------------------------------------------------------------------------------------------------------


def test_survivors(spark):
    nan = float("nan")
    rows = [
        (1, "K1", "b", "2024-01-01", -1.0, None, "w"), (2, "k1 ", "A ", "2023-01-01", None, 25.0, " "), (3, "InChIKey=K1", "a", "2022-01-01", -3.0, nan, None),
        (4, "K2", None, "2024-01-01", -1.0, 20.0, "x"), (5, "K2", "zzz", "2020-01-01", -2.0, 21.0, "y"), (6, "K2", "zzz", None, -2.5, 22.0, "y"),
        (7, "K3", "a", "2024-01-01", 9999.0, None, None), (8, "K3", "a", "2024-01-01", None, -999.0, None),
        (10, "K4", "a", "2024-01-01", -1.0, 1.0, "t"), (9, "K4", "a", "2024-01-01", -2.0, None, "t"), (11, "K5", "a", "2024-01-01", -1.0, 1.0, "t"), (12, None, "a", "2024-01-01", -1.0, 1.0, "t"), (13, "", "a", "2024-01-01", -1.0, 1.0, "t"),
    ]
    df = spark.createDataFrame(rows, "rec_id long, InChIKey string, source string, at string, logS double, temp_C double, solvent string").withColumn("ingested_at", F.to_timestamp("at")).withColumn("trust", F.lit(1)).withColumn("mask", F.lit("x"))
    reg = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, 0)], "source string, trust_rank int")
    got = {tuple(r) for r in survivors.best_fields(df, reg, ["logS", "temp_C"]).collect()}
    assert got == {("K1", "logS", 3), ("K1", "temp_C", 2), ("K2", "logS", 5), ("K2", "temp_C", 5), ("K4", "logS", 9), ("K4", "temp_C", 10)}
    s = {r["inchikey"]: r for r in survivors.survivors(df, reg, ["logS", "temp_C", "solvent"]).collect()}
    assert len(s) == 5 and (s["K1"]["logS"], s["K1"]["temp_C"], s["K1"]["solvent"], s["K1"]["rows"]) == (-3.0, 25.0, "w", 3)
    assert s["K3"]["logS"] is None and s["K4"]["rec_id"] == 9
    assert survivors.best_fields(df.where("false"), reg, ["logS"]).count() == 0 and survivors.best_fields(df, reg.where("false"), ["logS"]).count() == 3


@pytest.mark.parametrize("seed", [0, 1])
def test_best_fields_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"K{rng.randrange(9)}", rng.choice(["a", "b", "c", None]), rng.randrange(5), rng.choice([None, -1.0, -2.0]), rng.choice([None, 25.0])) for i in range(150)]
    df = spark.createDataFrame(rows, "rec_id long, InChIKey string, source string, at int, logS double, temp_C double").withColumn("ingested_at", F.timestamp_seconds("at"))
    reg = spark.createDataFrame([("a", 2), ("b", 1)], "source string, trust_rank int")
    rank = {"a": 2, "b": 1, "c": 50, None: 99}
    want = set()
    for k in {r[1] for r in rows}:
        group = [r for r in rows if r[1] == k]
        for f, i in (("logS", 4), ("temp_C", 5)):
            held = [r for r in group if r[i] is not None]
            if len(group) > 1 and held:
                want.add((k, f, min(held, key=lambda r: (rank[r[2]], -r[3], r[0]))[0]))
    assert {tuple(r) for r in survivors.best_fields(df, reg, ["logS", "temp_C"]).collect()} == want


# -- 4 ----------------------------------------------------------------------------------------------------------


def levenshtein(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=9), st.text("ab", max_size=9))
def test_distance_within(a, b):
    d = levenshtein(a, b)
    assert overlaps.distance_within(a, b, 2) == (d if d <= 2 else None)


@pytest.mark.parametrize("shard", [20_000, 2])
def test_near_texts(spark, shard, monkeypatch):
    monkeypatch.setattr(overlaps, "SHARD", shard)
    monkeypatch.setattr(overlaps, "PART", shard * 3)
    rng = random.Random(shard)
    base = ["".join(rng.choice("CNO") for _ in range(rng.choice((1, 2, 3, 5, 12, 30)))) for _ in range(25)] + ["x" * 3000]

    def changed(t):
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(t) + 1)
            t = rng.choice((t[:i] + "N" + t[i:], t[:i] + t[i + 1 :], t[:i] + "C" + t[i + 1 :]))
        return t

    ev, tr = sorted(set(base)), sorted({changed(t) for t in base * 2} | {""})
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "s string")
    got = {(r["s_eval"], r["s_train"]): r["distance"] for r in overlaps.near_texts(frame(ev), frame(tr)).collect()}
    want = {(a, b): d for a in ev for b in tr if abs(len(a) - len(b)) <= 2 and (d := levenshtein(a, b)) <= 2}
    assert got == want
    assert overlaps.near_texts(frame([]), frame(tr)).count() == 0 and overlaps.near_texts(frame(ev), frame([])).count() == 0


def test_cross_split_pairs(spark, scratch):
    folds = [("a", 0, 1), ("b", 3, 1), ("c", 4, None), ("d", 1, 2), ("d", 4, 2), ("e", 0, 2), ("e", 0, 2), ("f", 4, None), ("g", 9, None), (None, 0, None)]
    unified = [("a", "ABCDEFGHIJKLMN-X", "CCCCCCCCCC", "s1"), ("b", "abcdefghijklmn-Y", None, " S2"), ("c", None, "CCCCCCCCCCO", None), ("d", "D", "nan", "s1"), ("e", "E", "NNNNNNNN", "s1"), ("f", None, "NNNNNNOO", "s2"), ("f", None, "", "s2"), ("g", "E", "NNNNNNNN", "s1"), ("h", "E", "NNNNNNNN", "s1")]
    f, u, plan = fold_tables(spark, folds, unified)
    assert {tuple(r) for r in overlaps.cross_split_pairs(f, plan, u, scratch).collect()} == {("a", "b"), ("a", "c"), ("e", "f")}
    rep = {(r["split"], r["source"]): (r["eval_rows"], r["overlapping_rows"], r["pairs"]) for r in overlaps.overlap_report(f, plan, u, scratch).collect()}
    assert rep == {("validation", "s2"): (1, 1, 1), ("test", None): (1, 1, 1), ("test", "s1"): (1, 0, 0), ("test", "s2"): (1, 1, 1)}
    for empty in (f.where("false"), u.where("false")):
        args = (empty, plan, u) if "cluster_ecfp4_0p7" in empty.columns else (f, plan, empty)
        assert overlaps.cross_split_pairs(*args, scratch).count() == 0


# -- 5 ----------------------------------------------------------------------------------------------------------

SOLVENTS = [(1, "water", "H2O", "aqua|distilled water|eau", "O"), (2, "methanol", "MeOH", "methyl alcohol", "CO"), (3, "1-propanol", "nPrOH", "propan-1-ol", "CCCO"), (4, "2-propanol", "IPA", "isopropanol", "CC(C)O"), (5, "ethyl acetate", None, None, None), (6, "methyl acetate", "MeOAc", "", "COC(C)=O")]
VALUES = {
    " water": 1, "WATER": 1, "Wattr": 1, "water (HPLC grade)": 1, "dry water, sieved": 1, "ddistilled waater": 1, "O ": 1, "o": -1, "Eau": 1, "h2o": 1, "meoh": 2, "CO": 2, "co": -1, "methyl  alcohol": 2, "2 propanol": 4, "1propanol": 3, "methly acetate": 6, "ethy acetate": 5,
    "water/methanol 1:1": -1, "methanol + water": -1, "unknown": -1, "N/A": -1, "???": -1, "olive oil": -1, "in methanol": 2, "solvent: Methanol; see page 4": 2, "x" * 50000: -1, "water" * 20: -1,
}


def test_map_values(spark):
    df = spark.createDataFrame([*enumerate(VALUES), (900, None), (901, ""), (902, " \t"), (903, "water"), (904, "H2O"), (905, "H2O")], "rec_id long, solvent string").withColumn("solvent_id", F.lit("x")).withColumn("k", F.lit(1))
    ref = spark.createDataFrame(SOLVENTS, "solvent_id long, canonical_name string, abbreviation string, synonyms string, smiles_solvent string")
    got = {r["rec_id"]: r["solvent_id"] for r in canonical.map_values(df, ref).collect()}
    assert {v: got[i] for i, v in enumerate(VALUES)} == VALUES and got[904] == got[905] == 1 and not got.keys() & {900, 901, 902, 903}
    assert canonical.map_values(df.where("false"), ref).count() == 0
    assert {r[1] for r in canonical.map_values(df, ref.where("false")).collect()} == {-1}
    assert canonical.unmatched_values(df.drop("solvent_id"), canonical.map_values(df, ref)).where("solvent = 'olive oil' AND rows = 1").count() == 1


@settings(max_examples=100, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_edit_distance_bounds(a, b):
    d, full = canonical.edit_distance(a, b, 3), levenshtein(a, b)
    assert d <= 4 and (d <= full or d == 4) and (d == 0) == (a == b)


def test_token_sets_have_no_order():
    m = canonical.Matcher([(1, "ethyl acetate", "EA", "acetic acid ethyl ester", None), (2, "isopropyl alcohol", None, "2-propanol", None), (3, "propyl alcohol", None, "1-propanol", None), (4, "N,N-dimethylformamide", "DMF", None, None)])
    cases = {"acetate ethyl": 1, "Acetate, ethyl (dry)": 1, "ester of ethyl acetic acid": 1, "ethyl ester acetic acid": 1, "alcohol isopropyl": 2, "alcohol, iso-propyl": 2, "alcohol propyl": 3, "alcohol, n propyl": 3, "acetaet ethyl": 1, "formamide N,N-dimethyl": -1, "propyl acetate": -1, "alcohol": -1}
    assert {v: m.match(v) for v in cases} == cases


@given(st.lists(st.text("abc", min_size=1, max_size=4), min_size=1, max_size=4), st.lists(st.text("abc", min_size=1, max_size=4), min_size=1, max_size=3))
@settings(max_examples=150, deadline=None)
def test_token_distance_is_the_best_assignment(a, b):
    x, y = (a, b) if len(a) >= len(b) else (b, a)
    full = min(sum(min(levenshtein_swaps(p, q), len(p) + len(q)) if p else len(q) for p, q in zip(order, y)) + sum(map(len, x)) - sum(map(len, order)) for order in itertools.permutations(x + [""] * len(y), len(y)))
    got = canonical.token_distance(tuple(a), tuple(b), 50)
    assert got == full == canonical.token_distance(tuple(reversed(a)), tuple(b), 50)


def levenshtein_swaps(a, b):
    return canonical.edit_distance(a, b, 50)


# -- 8 ----------------------------------------------------------------------------------------------------------


def test_leaks(spark, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(60)) for i in range(6)] + [(6, "too short"), (7, None), (8, ""), (0, None)]
    docs = [(100, text(200)), (101, text(20) + " " + items[0][1] + text(5)), (102, items[1][1][:90].upper().replace(" ", " - ")), (103, items[2][1][50:160].replace("e", "e\n> ")), (104, items[3][1][:40] + "x" + items[3][1][60:95]), (105, None), (106, ""), (107, text(20000) + items[4][1] + text(10)), (101, items[5][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(5)).withColumn("run", F.lit("x"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5))
    plain = lambda t: "".join(c for c in (t or "").lower() if c.isalnum())
    want = set()
    for doc, t in docs:
        t = plain(t)
        wins = {t[k : k + 60] for k in range(len(t) - 59)}
        want |= {(doc, k) for k, x in items if any(plain(x)[j : j + 60] in wins for j in range(len(plain(x)) - 59))}
    for size in (20_000_000, 300):  # items in memory, and a join of sketches
        monkeypatch.setattr(leaks, "PASS_CHARS", size)
        got = leaks.leaks(d, i)
        assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and {(101, 0), (107, 4)} <= want
    assert got.where("item_id = 0").first()["coverage"] == 1.0
    rep = {r["item_id"]: r["documents"] for r in leaks.leaked_items(got, i).collect()}
    assert len(rep) == 9 and rep[6] == 0 and rep[0] == 1
    assert leaks.leaks(d.where("false"), i).count() == 0 and leaks.leaks(d, i.where("false")).count() == 0


@given(st.text("ab", max_size=150), st.text("ab", max_size=150), st.integers(0, 80))
@settings(max_examples=150, deadline=None)
def test_leaks_of_repetitive_texts(a, b, n):
    item, doc = "ab" * n + b, a + "ab" * n + "ba" + b
    want = max((k for k in range(60, len(item) + 1) if any(item[i : i + k] in doc for i in range(len(item) - k + 1))), default=0)
    got = list(leaks.Items([(1, item)]).runs(["x", doc]))
    assert [(d, i, r) for d, i, r, _ in got] == ([(1, 1, want)] if want else [])


@pytest.mark.parametrize("size", [20_000_000, 1])
def test_leaks_of_repeated_ids(spark, size, monkeypatch):
    monkeypatch.setattr(leaks, "PASS_CHARS", size)
    rng = random.Random(2)
    t = "".join(rng.choice(string.ascii_lowercase) for _ in range(260))
    d = spark.createDataFrame([(1, t[:70]), (1, t[:250]), (1, t[:250]), (2, t[100:])], "doc_id long, text string")
    i = spark.createDataFrame([(7, t), (7, t[:240]), (7, None)], "item_id long, text string")
    assert {tuple(r)[:3] for r in leaks.leaks(d, i).collect()} == {(1, 7, 250), (2, 7, 160)}


# -- 9 ----------------------------------------------------------------------------------------------------------


@given(st.lists(st.tuples(st.sets(st.sampled_from("abcd"), min_size=1), st.integers(1, 60)), min_size=1, max_size=6), st.integers(1, 3), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_largest_total_is_the_least_cut(patterns, cap, other):
    patterns = [(tuple(sorted(n)), k) for n, k in patterns]
    names = sorted({n for p, _ in patterns for n in p})
    shares, caps = {n: 1 / len(names) for n in names}, {n: cap if n in "ab" else other for n in names}
    worst = min(
        sum(k * min(max(caps[n] for n in p), sum(caps[n] for n in p if n in some)) for p, k in patterns if set(p) & set(some)) / sum(shares[n] for n in some)
        for r in range(1, len(names) + 1)
        for some in itertools.combinations(names, r)
    )
    total = mixing.largest_total(patterns, shares, caps)
    assert abs(total - worst) <= len(names)
    got, flow, short = mixing.route(patterns, shares, caps, total)
    assert not short and flow == sum(round(s * total) for s in shares.values())
    assert all(sum(v for (p, n), v in got.items() if n == m) == round(shares[m] * total) for m in names)


def test_many_patterns_are_routed_in_seconds():
    rng = random.Random(5)
    names = [f"s{i}" for i in range(20)]
    patterns = list({tuple(sorted(rng.sample(names, rng.randrange(1, 7)))): rng.randrange(1, 10**6) for _ in range(10_000)}.items())
    shares, caps = {n: 1 / 20 for n in names}, {n: 1 + i % 4 for i, n in enumerate(names)}
    at = time.time()
    total = mixing.largest_total(patterns, shares, caps)
    _, flow, short = mixing.route(patterns, shares, caps, total)
    assert flow == sum(round(s * total) for s in shares.values()) and not short and time.time() - at < 60


def test_flow_prefers_first_uses():
    got, total, _ = mixing.route([(("a",), 100), (("a", "b"), 100)], {"a": 0.5, "b": 0.5}, {"a": 2, "b": 2}, 200)
    assert total == 200 and got == {(0, "a"): 100, (1, "b"): 100}
    assert mixing.largest_total([(("a",), 100), (("b",), 10)], {"a": 0.5, "b": 0.5}, {"a": 1, "b": 3}) == pytest.approx(60, abs=2)


def test_mix(spark, scratch):
    rng = random.Random(9)
    docs = [(i, f"text {rng.random()} of some words", "big" if i % 3 else " Small ") for i in range(300)] + [(900, "shared text", "big"), (901, "shared text", "small"), (902, "shared text", "small"), (903, None, "big"), (904, "", "big"), (905, "x", None), (906, "y", "unlisted")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("tokens", F.lit("x")).withColumn("key", F.lit(1))
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("absent", 0.1, 2), (None, 1.0, 1)], "source string, target_share double, max_repeats int")
    got = mixing.mix(d, t, scratch)
    assert got.where("repeats < 1 OR (source = 'big' AND repeats > 1) OR (source = 'small' AND repeats > 3)").count() == 0
    assert got.groupBy("doc_id", "source").count().where("count > 1").count() == 0 and not {903, 904, 905, 906} & {r[0] for r in got.collect()}
    shares = {r["source"]: r for r in mixing.mix_shares(got, t).collect()}
    assert shares["big"]["actual_share"] == pytest.approx(5 / 9, abs=0.01) and shares["small"]["actual_share"] == pytest.approx(4 / 9, abs=0.01) and shares["absent"]["tokens"] == 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mixing.mix(d.repartition(7), t, scratch).collect()))
    fixed = mixing.mix_shares(mixing.mix(d, t, scratch, total=500), t).agg(F.sum("tokens")).first()[0]
    assert 480 <= fixed <= 540
    assert mixing.mix(d.where("false"), t, scratch).count() == 0 and mixing.mix(d, t.where("false"), scratch).count() == 0


# -- 10 ---------------------------------------------------------------------------------------------------------


def words(text):
    return [w for w, _ in toxicity.plain_tokens(text)]


def test_disguises():
    plain = words("you worthless bastard")
    assert plain == ["you", "worthles", "bastard"]
    assert all(words(t) == plain for t in ("YOU w o r t h l e s s bastard", "you w0rthl3$$ b@st@rd", "you w0rthle$s ba$tard", "you wоrthlеss bаstаrd", "you wor​thless bastard", "you worthlesssss bastardddd"))
    assert words("@$k $h0uld") == ["ask", "should"] and words("a b****d") == ["a", "<*>"] and words("batch T4711 gave 3.5 mg") == ["batch", "<code>", "gave", "<number>", "<end>", "<number>", "mg"]


def test_classifier_held_out(spark):
    rng = random.Random(10)
    bad = ["you are a {} fool and a disgrace", "i will {} hurt you", "those {} folk are filth"]
    good = ["the {} sample was stirred", "we measured {} values", "the {} pump is a disgrace", "folk {} music played"]
    fill = [f"w{i}" for i in range(40)]

    def doc(kind):
        parts = [rng.choice(good).format(rng.choice(fill)) for _ in range(6)]
        if kind:
            parts[rng.randrange(6)] = rng.choice(bad).format(rng.choice(fill))
        return ". ".join(parts)

    data = [(i, doc(i % 4 == 0), "en" if i % 2 else "EN ", None if i % 5 else "src", float(i % 4 == 0)) for i in range(500)]
    docs = spark.createDataFrame([x[:4] for x in data] + [(1000, None, None, None), (1001, "", "en", "s"), (1002, "the sample " * 3000 + "you are a w3 fool and a disgrace", "en", "s")], "doc_id long, text string, lang string, source string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, "r", int(y if i % 37 else 1 - y)) for i, _, _, _, y in data if i < 300] + [(1, "q", 0), (None, "r", 1), (5, "r", None)], "doc_id long, rater string, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(got) == 503 and got[1000]["score"] == got[1001]["score"] == 0 and not got[1000]["toxic"] and got[1002]["toxic"]
    test = [(y, got[i]["toxic"]) for i, _, _, _, y in data if i >= 300]
    assert np.mean([bool(y) == p for y, p in test]) > 0.95
    rates = toxicity.toxic_rates(toxicity.score_documents(docs.where("false"), labels))
    assert rates.count() == 0


def test_unrated(spark):
    docs = spark.createDataFrame([(1, "you stupid idiot, go to hell", "en", "a"), (2, "the sample was stirred in water", "en", "a")], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([], "doc_id long, rater string, toxic int")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score_documents(docs, labels).collect()}
    assert got == {1: True, 2: False}


def test_thresholds_from_all_ratings(spark):
    counts = pd.DataFrame([("en", 900, 1, 40), ("en", 100, 0, 400), ("de", 400, 1, 5), ("de", 100, 0, 40)], columns=["lang", "bin", "toxic", "n"])
    got = toxicity.thresholds(counts)
    assert set(got) == {"", "en", "de"} and 0.2 < got[""] < got["de"] < 0.25 < got["en"] < 0.51  # few ratings move a cut a little
    tenfold = toxicity.thresholds(counts.assign(n=counts.n * 10))
    assert abs(tenfold["de"] - 0.25) < abs(got["de"] - 0.25)
    assert toxicity.thresholds(counts[counts.toxic == 0])["de"] == toxicity.PRIOR_CUT
    text = lambda i: f"the w{i} sample was stirred. " + (f"you are a w{i % 9} fool and a disgrace" if i % 4 == 0 else f"we measured w{i % 9} values")
    docs = spark.createDataFrame([(i, text(i), "de" if i % 5 == 0 else "en") for i in range(200)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, "r", int(i % 4 == 0)) for i in range(200)], "doc_id long, rater string, toxic int")
    sample = toxicity.rated_documents(docs, labels, 80)
    model = toxicity.train(sample)
    assert len(sample) == 80 == model.counts.n.sum() and {"en", "de"} < set(model.thresholds)
    assert toxicity.other_ratings(docs, labels, model, sample).n.sum() == 120


# -- queries ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(equal_sql, name):
    equal_sql(queries.QUERIES[name], queries.ORACLES[name])
