"""Connected components of an edge table by hooking and shortcutting of parent tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.runtime import Scratch

#: Rounds after which the graph is declared broken; every round at least halves the nodes that are no local minimum.
MAX_ROUNDS = 60


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; ``root`` is the smallest node of its component.

    Every round hooks each node to its smallest neighbour (parents only point to smaller nodes, so there is no
    cycle), shortcuts the parent table until all parents are roots, and contracts the edges to the roots. Edges and
    nodes shrink with every round; the rounds' parent tables are joined from the last to the first at the end. Rows
    with a null end and self-loops relate nothing; a node that only has self-loops is its own root. Each round is
    written to the shared folder, so lost executors cost one round at most. Hot nodes are met by partial
    aggregation (only minima and distinct pairs are shuffled). An empty table gives an empty result.
    """
    live = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    live = scratch.write(live.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    lone = live.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    first, levels = live, []
    live = live.where("a <> b")
    for _ in range(MAX_ROUNDS):
        if live.isEmpty():
            break
        # hook: b > a always holds, so a node's smallest neighbour is below it unless it is a local minimum
        up = live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        down = live.select(F.col("a").alias("node"), F.col("a").alias("parent"))
        parents = scratch.write(up.unionByName(down).groupBy("node").agg(F.min("parent").alias("parent")))
        while True:  # shortcut: parent := parent of parent, until nothing moves
            over = parents.select(F.col("node").alias("p"), F.col("parent").alias("pp"))
            jumped = scratch.write(parents.join(over, parents.parent == over.p).select("node", F.col("pp").alias("parent"), (F.col("pp") != F.col("parent")).alias("moved")))
            still = not jumped.where("moved").isEmpty()
            scratch.drop(parents)
            parents = jumped
            if not still:
                break
        parents = parents.drop("moved")
        levels.append(parents)
        pa, pb = (parents.select(F.col("node").alias(n), F.col("parent").alias(r)) for n, r in (("na", "ra"), ("nb", "rb")))
        met = live.join(pa, F.col("a") == F.col("na")).join(pb, F.col("b") == F.col("nb")).where("ra <> rb")
        live = scratch.write(met.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    else:
        raise RuntimeError("components did not converge")
    if not levels:
        return lone.distinct()
    found = levels[-1].select("node", F.col("parent").alias("root"))
    for level in reversed(levels[:-1]):
        top = found.select(F.col("node").alias("n"), F.col("root").alias("r"))
        # a node that is alone after contraction appears in no later level and keeps its parent
        found = level.join(top, level.parent == top.n, "left").select("node", F.coalesce("r", "parent").alias("root"))
    inside = first.where("a <> b").select(F.col("a").alias("node")).unionByName(first.where("a <> b").select(F.col("b").alias("node"))).distinct()
    return found.unionByName(lone.join(inside, "node", "left_anti").distinct())
