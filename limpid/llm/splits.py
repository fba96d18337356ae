"""Problem 1: splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limpid.llm.graph import components
from limpid.runtime import Scratch, clean_key

#: Subset sums are kept as bitsets of at most so many bits, for at most so many (binary-split) largest groups; the
#: smaller groups fill what is left. 2^20 bits x 400 items = 50 MB on the driver, whatever the input.
SUM_BITS, SUM_ITEMS = 1 << 20, 400
#: Groups of one size are ranked inside buckets of about this many.
RANK_BUCKET = 50_000


def related_groups(folds: DataFrame, unified: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_uid, grp) for every non-null row_uid of ``folds``; grp names the related group.

    Rows are related by row_uid, by cluster (null and -1 relate nothing) or, through unified, by clean InChIKey.
    The graph is built on the attributes: a row_uid only links its other attributes to its smallest one, so a hot
    molecule, cluster or row_uid is one node or one star of distinct links, never a collected list. Repeated rows change
    nothing; a row_uid without any attribute is a group of its own. Extra columns are ignored.
    """
    uids = folds.where("row_uid IS NOT NULL").select("row_uid", F.col("cluster_ecfp4_0p7").alias("c")).distinct()
    ids = uids.select("row_uid").distinct()
    clustered = uids.where(F.col("c") != -1).select("row_uid", F.concat(F.lit("c"), F.col("c").cast("string")).alias("mark"))
    keys = unified.select("row_uid", clean_key(F.col("InChIKey")).alias("k")).where("row_uid IS NOT NULL AND k IS NOT NULL").distinct()
    keyed = keys.join(ids, "row_uid", "left_semi").select("row_uid", F.concat(F.lit("k"), "k").alias("mark"))
    marks = scratch.write(clustered.unionByName(keyed))
    low = marks.groupBy("row_uid").agg(F.min("mark").alias("low"))
    links = marks.join(low, "row_uid").where("mark <> low").select(F.col("low").alias("a"), F.col("mark").alias("b")).distinct()
    roots = components(links, scratch)
    named = ids.join(low, "row_uid", "left").select("row_uid", F.coalesce("low", F.concat(F.lit("r"), "row_uid")).alias("mark"))
    return named.join(roots, named.mark == roots.node, "left").select("row_uid", F.coalesce("root", "mark").alias("grp"))


def split_groups(folds: DataFrame, unified: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_uid) distinct, of folds whose related group lies in more than one fold."""
    groups = scratch.write(related_groups(folds, unified, scratch))
    at = folds.where("row_uid IS NOT NULL").groupBy("row_uid").agg(F.min("fold").alias("lo"), F.max("fold").alias("hi")).join(groups, "row_uid")
    torn = at.groupBy("grp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("grp")
    return groups.join(torn, "grp", "left_semi").select("row_uid").distinct()


def choose_sizes(sizes: list[tuple[int, int]], shares: list[tuple[str, float]]) -> dict[int, dict[str, int]]:
    """How many groups of each size every split takes: {size: {split: groups}}.

    ``sizes`` lists (size, groups). The splits are served from the smallest share up; each takes, by subset sums
    over the size multiplicities (kept as bitsets), the total closest to its target among what is left; the last
    and largest split takes the rest. Sizes beyond SUM_ITEMS binary-split items are filled in greedily.
    """
    left = {s: n for s, n in sizes if s > 0 and n > 0}
    total = sum(s * n for s, n in left.items())
    out: dict[int, dict[str, int]] = {s: {} for s in left}
    order = sorted(shares, key=lambda x: (x[1], x[0]))
    weight = sum(w for _, w in order) or 1.0
    for name, share in order[:-1]:
        target = round(total * share / weight)
        unit = max(1, -(-2 * target // SUM_BITS))
        items, big = [], sorted(left, reverse=True)
        for s in big:
            n, k = left[s], 1
            while n > 0 and len(items) < SUM_ITEMS:
                k = min(k, n)
                items.append((s, k))
                n, k = n - k, k * 2
            if len(items) >= SUM_ITEMS:
                break
        width = 2 * target // unit + 1
        mask, reach, steps = (1 << (width + 1)) - 1, 1, []
        for s, k in items:
            steps.append(reach)
            reach |= (reach << (s * k // unit)) & mask
        small = total_small(left, items)
        # closest sum; sums below the target by no more than the unlisted groups hold can be filled up with them
        goal = target // unit
        below = reach & ((1 << (goal + 1)) - 1)
        lo = below.bit_length() - 1
        above = reach >> (goal + 1)
        hi = goal + 1 + ((above & -above).bit_length() - 1) if above else None
        pick = lo if hi is None or goal - lo <= hi - goal or small > 0 else hi
        taken = 0
        for (s, k), before in zip(reversed(items), reversed(steps)):
            if (before >> pick) & 1:
                continue
            pick -= s * k // unit
            out[s][name] = out[s].get(name, 0) + k
            left[s] -= k
            taken += s * k
        for s in big:  # what the bitset left open
            if taken >= target:
                break
            k = min(left[s], (target - taken) // s)
            if k > 0:
                out[s][name] = out[s].get(name, 0) + k
                left[s] -= k
                taken += s * k
    for s, n in left.items():
        if n:
            out[s][order[-1][0]] = out[s].get(order[-1][0], 0) + n
    return out


def total_small(left: dict[int, int], items: list[tuple[int, int]]) -> int:
    """Rows in groups that are in no item."""
    return sum(s * n for s, n in left.items()) - sum(s * k for s, k in items)


def assign_splits(folds: DataFrame, unified: DataFrame, plan: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_uid, grp, split): one split per row_uid, related rows together, totals (in rows of folds) closest to the plan.

    The plan's shares are summed per split; null splits or shares are ignored and an empty plan sends all to
    'train'. Only the histogram of group sizes comes to the driver (at most sqrt(2 x rows) entries). Which groups
    of a size go where is set by the order of their hash, ranked in buckets so that a size which most groups share
    is no single task.
    """
    groups = scratch.write(related_groups(folds, unified, scratch))
    rows = folds.where("row_uid IS NOT NULL").groupBy("row_uid").count()
    sized = scratch.write(rows.join(groups, "row_uid").groupBy("grp").agg(F.sum("count").alias("size")).withColumn("h", F.xxhash64("grp")))
    hist = [(r["size"], r["n"]) for r in sized.groupBy("size").agg(F.count("*").alias("n")).collect()]
    shares = [(r["split"], r["share"]) for r in plan.where("split IS NOT NULL AND target_share > 0").groupBy("split").agg(F.sum("target_share").alias("share")).collect()]
    chosen = choose_sizes(hist, shares or [("train", 1.0)])
    most = max([n for _, n in hist] or [1])
    buckets = max(1, -(-most // RANK_BUCKET))
    cuts = []
    for s, by in chosen.items():
        at = 0
        for name, n in sorted(by.items()):
            cuts.append((s, name, at, at + n))
            at += n
    spark = folds.sparkSession
    cut = spark.createDataFrame(cuts, "size long, split string, lo long, hi long")
    placed = sized.withColumn("bucket", F.expr(f"CAST(floor((CAST(h AS DOUBLE) + 9.223372036854775808e18) / 1.8446744073709551616e19 * {buckets}) AS INT)"))
    per = placed.groupBy("size", "bucket").agg(F.count("*").alias("n"))
    per = per.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("size", "bucket").orderBy("h", "grp")) - 1
    ranked = placed.withColumn("r", rank).join(per, ["size", "bucket"]).withColumn("at", F.col("before") + F.col("r"))
    named = ranked.join(cut, "size").where("at >= lo AND at < hi").select("grp", "split")
    return groups.join(named, "grp").select("row_uid", "grp", "split")


def split_report(assigned: DataFrame, folds: DataFrame, plan: DataFrame) -> DataFrame:
    """(split, target_share, rows, actual_share, groups) per split of the plan."""
    rows = folds.where("row_uid IS NOT NULL").groupBy("row_uid").count().join(assigned, "row_uid")
    got = rows.groupBy("split", "grp").agg(F.sum("count").alias("rows")).groupBy("split").agg(F.sum("rows").alias("rows"), F.count("*").alias("groups"))
    want = plan.where("split IS NOT NULL").groupBy("split").agg(F.sum("target_share").alias("target_share"))
    total = got.agg(F.sum("rows").alias("all"))
    out = want.join(got, "split", "full").crossJoin(F.broadcast(total))  # one row
    return out.select("split", "target_share", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce(F.col("rows") / F.col("all"), F.lit(0.0)).alias("actual_share"), F.coalesce("groups", F.lit(0)).alias("groups"))


def broken_rules(assigned: DataFrame, folds: DataFrame, unified: DataFrame, plan: DataFrame, scratch: Scratch, near: float = 0.01) -> DataFrame:
    """(rows, repeated, clusters_apart, keys_apart, splits_off): how many row_uid are assigned, and how often a rule is
    broken: a row_uid with two splits, a cluster or a molecule in two splits, a split further than ``near`` from its share.

    Relations are checked one by one, without the groups that the assignment was made from.
    """
    assigned = scratch.write(assigned)
    apart = lambda df, key: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct("split").alias("n")).where("n > 1").agg(F.count("*"))
    by_cluster = folds.where("cluster_ecfp4_0p7 <> -1").select("row_uid", "cluster_ecfp4_0p7").distinct().join(assigned, "row_uid")
    by_key = unified.select("row_uid", clean_key(F.col("InChIKey")).alias("key")).distinct().join(assigned, "row_uid")
    off = split_report(assigned, folds, plan).where(F.abs(F.col("actual_share") - F.coalesce("target_share", F.lit(0.0))) > near).agg(F.count("*"))
    one = assigned.agg(F.countDistinct("row_uid").alias("rows"), (F.count("*") - F.countDistinct("row_uid")).alias("repeated"))
    for name, df in (("clusters_apart", apart(by_cluster, "cluster_ecfp4_0p7")), ("keys_apart", apart(by_key, "key")), ("splits_off", off)):
        one = one.crossJoin(df.toDF(name))  # one row each
    return one
