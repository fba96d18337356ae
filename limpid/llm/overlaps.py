"""Problem 4: same or near-same records across splits."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.runtime import Scratch, clean_key, plain_source, spelled

#: Near-same: at most so many inserted, deleted or replaced characters.
EDITS = 2
#: First characters of the InChIKey that name the same skeleton.
BLOCK = 14
#: Evaluation texts in one automaton, and training texts that one task scans with it; a length with more is spread
#: over several tasks.
SHARD, PART = 20_000, 250_000


def _lead(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def distance_within(a: str, b: str, k: int) -> int | None:
    """Edit distance of a and b if it is at most k, else None."""
    if abs(len(a) - len(b)) > k:
        return None
    i = _lead(a, b)
    a, b = a[i:], b[i:]
    if not a or not b:
        return len(a) + len(b)
    if k == 0:
        return None
    best = None
    for x, y in ((a[1:], b[1:]), (a[1:], b), (a, b[1:])):
        got = distance_within(x, y, (best - 2) if best is not None else k - 1)
        if got is not None:
            best = got + 1
            if best <= 1:
                break
    return best


def _scan(ev: pd.DataFrame, tr: pd.DataFrame) -> pd.DataFrame:
    """Pairs (evaluation text, training text, distance, coverage) of one shard; its evaluation texts are of one length.

    A text of length n falls into EDITS + 1 pieces; a text within EDITS edits holds one of them unchanged and moved by
    at most EDITS places. The automaton over all pieces finds those, and the merged intervals say how much of the
    evaluation text was met.
    """
    out: list[tuple[str, str, int, float]] = []
    texts = ev.s.tolist()
    if texts and len(tr):
        n, parts = len(texts[0]), EDITS + 1
        cuts = [n * i // parts for i in range(parts + 1)]
        pieces: dict[str, dict[int, list[int]]] = {}
        for j, t in enumerate(texts):
            for p in range(parts):
                pieces.setdefault(t[cuts[p] : cuts[p + 1]], {}).setdefault(p, []).append(j)
        everyone = pieces.pop("", None) is not None  # texts shorter than their pieces: compare with all
        auto = ahocorasick.Automaton()
        for piece, by in pieces.items():
            auto.add_word(piece, (len(piece), by))
        auto.make_automaton()
        ready = bool(pieces)
        for t in tr.t.tolist():
            met: dict[int, set[int]] = {j: set() for j in range(len(texts))} if everyone else {}
            if ready:
                for end, (size, by) in auto.iter(t):
                    for p, who in by.items():
                        if abs(end - size + 1 - cuts[p]) <= EDITS:
                            for j in who:
                                met.setdefault(j, set()).add(p)
            for j, ps in met.items():
                d = distance_within(texts[j], t, EDITS)
                if d is not None:
                    out.append((texts[j], t, d, sum(cuts[p + 1] - cuts[p] for p in ps) / n if n else 1.0))
    return pd.DataFrame(out, columns=["s_eval", "s_train", "distance", "coverage"])


def near_texts(evaluation: DataFrame, training: DataFrame) -> DataFrame:
    """(s_eval, s_train, distance, coverage): distinct texts (column ``s``) of both sides within EDITS edits.

    Automata are sharded by the length of the evaluation text; a training text is scanned by the shards of the
    lengths that EDITS edits can lead to, and by no others. Both sides of a task are bounded: lengths with many texts
    are spread over several automata and several parts of the training texts.
    """
    around = lambda n: F.explode(F.sequence(n - EDITS, n + EDITS))
    shards = evaluation.groupBy(F.length("s").alias("n")).agg(F.ceil(F.count("*") / F.lit(SHARD)).cast("int").alias("shards"))
    near = training.groupBy(F.length("s").alias("m")).agg(F.count("*").alias("k")).select(around(F.col("m")).alias("n"), "k")
    plan = shards.join(near.groupBy("n").agg(F.ceil(F.sum("k") / F.lit(PART)).cast("int").alias("parts")), "n")
    ev = evaluation.withColumn("n", F.length("s")).join(plan, "n").select("n", F.expr("CAST(pmod(xxhash64(s), shards) AS INT)").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "s")
    to = plan.select(F.col("n").alias("of"), F.col("shards").alias("ks"), F.col("parts").alias("kp"))
    tr = training.select(F.col("s").alias("t"), around(F.length("s")).alias("of")).join(to, "of")
    tr = tr.select("of", F.explode(F.sequence(F.lit(0), F.col("ks") - 1)).alias("to"), F.expr("CAST(pmod(xxhash64(t), kp) AS INT)").alias("at"), "t")
    return ev.groupBy("n", "shard", "part").cogroup(tr.groupBy("of", "to", "at")).applyInPandas(_scan, "s_eval string, s_train string, distance int, coverage double")


def placed_records(folds: DataFrame, plan: DataFrame, unified: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_uid, block, s, in_train, in_eval): the structures of every row of folds that has a split, and its sides."""
    side = plan.where("split IS NOT NULL").select("fold", (F.col("split") == "train").alias("t")).distinct()
    at = folds.select("row_uid", "fold").where("row_uid IS NOT NULL").join(side, "fold").groupBy("row_uid").agg(F.max("t").alias("in_train"), F.max(~F.col("t")).alias("in_eval"))
    marks = unified.where("row_uid IS NOT NULL").select("row_uid", F.substring(clean_key(F.col("InChIKey")), 1, BLOCK).alias("block"), spelled(F.col("smiles_neutral")).alias("s")).where("block IS NOT NULL OR s IS NOT NULL").distinct()
    return scratch.write(marks.join(at, "row_uid"))


def cross_split_pairs(folds: DataFrame, plan: DataFrame, unified: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_uid_a, row_uid_b), smaller first: a training row and an evaluation row with the same or almost the same structure.

    Same: clean InChIKeys with the same first block. Almost the same: spelled structures within EDITS edits. Texts are
    compared once per distinct structure and expanded to rows at the end; blocks and structures that only one side
    has are dropped before any rows meet, so a hot molecule of one side costs nothing. Folds that the plan doesn't
    list take no part. A row_uid listed on both sides counts on both. Repeated rows change nothing; empty tables give
    an empty result.
    """
    rec = placed_records(folds, plan, unified, scratch)
    blocks = rec.where("block IS NOT NULL").groupBy("block").agg(F.max("in_train").alias("t"), F.max("in_eval").alias("e")).where("t AND e").select("block")
    held = rec.select("row_uid", "block", "in_train", "in_eval").distinct().join(blocks, "block", "left_semi")
    same = held.where("in_train").select("block", F.col("row_uid").alias("u")).join(held.where("in_eval").select("block", F.col("row_uid").alias("v")), "block").select("u", "v")
    texts = scratch.write(rec.where("s IS NOT NULL").groupBy("s").agg(F.max("in_train").alias("t"), F.max("in_eval").alias("e")))
    near = scratch.write(near_texts(texts.where("e").select("s"), texts.where("t").select("s")))
    rows = rec.where("s IS NOT NULL").select("s", "row_uid", "block", "in_train", "in_eval").distinct()
    ev = rows.where("in_eval").select(F.col("s").alias("s_eval"), F.col("row_uid").alias("v"), F.col("block").alias("bv"))
    tr = rows.where("in_train").select(F.col("s").alias("s_train"), F.col("row_uid").alias("u"), F.col("block").alias("bu"))
    almost = near.join(ev, "s_eval").join(tr, "s_train").where("NOT (bu <=> bv) OR bu IS NULL").select("u", "v")
    return same.unionByName(almost).where("u <> v").select(F.least("u", "v").alias("row_uid_a"), F.greatest("u", "v").alias("row_uid_b")).distinct()


def overlap_report(folds: DataFrame, plan: DataFrame, unified: DataFrame, scratch: Scratch) -> DataFrame:
    """(split, source, eval_rows, overlapping_rows, pairs) per evaluation split and source (null: no source known).

    A row_uid of several splits or sources counts in each; pairs counts the training rows that its rows meet.
    """
    pairs = scratch.write(cross_split_pairs(folds, plan, unified, scratch))
    names = plan.where("split IS NOT NULL").select("fold", "split").distinct()
    at = folds.where("row_uid IS NOT NULL").select("row_uid", "fold").join(names, "fold").select("row_uid", "split").distinct()
    src = unified.where("row_uid IS NOT NULL").select("row_uid", plain_source(F.col("source")).alias("source")).distinct()
    ev = at.where("split <> 'train'").join(src, "row_uid", "left")
    train = at.where("split = 'train'").select(F.col("row_uid").alias("other"))
    turned = pairs.select(F.col("row_uid_a").alias("row_uid"), F.col("row_uid_b").alias("other")).unionByName(pairs.select(F.col("row_uid_b").alias("row_uid"), F.col("row_uid_a").alias("other")))
    met = turned.join(train, "other", "left_semi").groupBy("row_uid").agg(F.count("*").alias("k"))
    return ev.join(met, "row_uid", "left").groupBy("split", "source").agg(F.count("*").alias("eval_rows"), F.count("k").alias("overlapping_rows"), F.coalesce(F.sum("k"), F.lit(0)).alias("pairs"))
