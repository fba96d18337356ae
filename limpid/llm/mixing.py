"""Problem 9: mixing sources to target weights."""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limpid.runtime import Scratch, plain_source

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: The seeded order of a pattern's documents is laid out in so many buckets, ranked each by itself.
BUCKETS = 4096
#: Distinct sets of sources that one text may stand in, and sources; the flow is solved over these. More raise an error.
MAX_PATTERNS = 100_000


def count_tokens(texts: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """Adds ``tokens``, the length of ``text`` under the tokenizer file at path (byte-level BPE, no special tokens)."""
    fields = [f for f in texts.schema.fields if f.name != "text"]
    if os.path.exists(path):  # executors get the file from the driver, else they need it at the same path
        texts.sparkSession.sparkContext.addFile(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(found if os.path.exists(found := SparkFiles.get(os.path.basename(path))) else path)
        tok.encode_special_tokens = True
        for pdf in batches:
            n: list[int] = []
            for at in range(0, len(pdf), 256):
                n += [len(e.ids) for e in tok.encode_batch(pdf["text"].iloc[at : at + 256].tolist(), add_special_tokens=False)]
            yield pdf.drop(columns="text").assign(tokens=pd.Series(n, index=pdf.index, dtype="int64"))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return texts.select(*[f"`{f.name}`" for f in fields], "text").mapInPandas(run, f"{schema}, tokens long")


class Flow:
    """Min-cost flow with integer costs of 0 or more: shortest distances under potentials (Dijkstra), and for each of
    them a blocking flow over the arcs on shortest paths. The rounds are as many as there are distances."""

    def __init__(self) -> None:
        self.to: list[int] = []
        self.cap: list[int] = []
        self.cost: list[int] = []
        self.out: list[list[int]] = []

    def arc(self, a: int, b: int, cap: int, cost: int = 0) -> int:
        k = len(self.to)
        while len(self.out) <= max(a, b):
            self.out.append([])
        for x, y, c, w in ((a, b, cap, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)
            self.cost.append(w)
        return k

    def _distances(self, s: int, up: list[int]) -> list[int | None]:
        dist: list[int | None] = [None] * len(self.out)
        dist[s], heap = 0, [(0, s)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for k in self.out[a]:
                b = self.to[k]
                if self.cap[k] > 0:
                    e = d + self.cost[k] + up[a] - up[b]
                    if dist[b] is None or e < dist[b]:
                        dist[b] = e
                        heapq.heappush(heap, (e, b))
        return dist

    def _levels(self, s: int, up: list[int]) -> list[int]:
        level, row = [-1] * len(self.out), [s]
        level[s] = 0
        while row:
            more = []
            for a in row:
                for k in self.out[a]:
                    b = self.to[k]
                    if self.cap[k] > 0 and level[b] < 0 and self.cost[k] + up[a] == up[b]:
                        level[b] = level[a] + 1
                        more.append(b)
            row = more
        return level

    def _block(self, s: int, t: int, up: list[int], level: list[int]) -> int:
        """A blocking flow over arcs of no reduced cost that lead one level on."""
        at, path, a, flow = [0] * len(self.out), [], s, 0
        while True:
            if a == t:
                push = min(self.cap[k] for k in path)
                for k in path:
                    self.cap[k] -= push
                    self.cap[k ^ 1] += push
                flow += push
                cut = next(i for i, k in enumerate(path) if not self.cap[k])
                a = self.to[path[cut] ^ 1]
                del path[cut:]
            out = self.out[a]
            while at[a] < len(out):
                k = out[at[a]]
                b = self.to[k]
                if self.cap[k] > 0 and level[b] == level[a] + 1 and self.cost[k] + up[a] == up[b]:
                    break
                at[a] += 1
            else:
                if not path:
                    return flow
                a = self.to[path.pop() ^ 1]
                at[a] += 1
                continue
            path.append(out[at[a]])
            a = b

    def run(self, s: int, t: int) -> tuple[int, int]:
        """(flow, cost) of a cheapest maximal flow from s to t."""
        flow = cost = 0
        up = [0] * len(self.out)
        while (dist := self._distances(s, up))[t] is not None:
            far = max(d for d in dist if d is not None)
            up = [u + (far if d is None else d) for u, d in zip(up, dist)]
            while (level := self._levels(s, up))[t] >= 0:
                pushed = self._block(s, t, up, level)
                flow, cost = flow + pushed, cost + pushed * (up[t] - up[s])
        return flow, cost

    def reached(self, s: int) -> set[int]:
        """Nodes to which more could still flow from s."""
        seen, todo = {s}, [s]
        while todo:
            for k in self.out[todo.pop()]:
                if self.cap[k] > 0 and self.to[k] not in seen:
                    seen.add(self.to[k])
                    todo.append(self.to[k])
        return seen


Patterns = list[tuple[tuple[str, ...], int]]


def route(patterns: Patterns, shares: dict[str, float], caps: dict[str, int], total: int, costs: bool = True) -> tuple[dict[tuple[int, str], int], int, set[str]]:
    """Tokens of each pattern that go to each source so that the sources get share x total, at least repetition.

    The r-th use of a pattern's tokens costs r - 1 (a convex cost), so second uses are only made where first uses run
    out; without ``costs`` any maximal flow will do. A source takes a pattern's tokens at most its own cap times, a
    pattern gives them at most its sources' highest cap times. Returns the flow by (pattern, source), the total
    routed, and the sources that limit it (none if all get their share).
    """
    g, s, t = Flow(), 0, 1
    source = {name: 2 + i for i, name in enumerate(sorted(shares))}
    arcs = {}
    for p, (names, tokens) in enumerate(patterns):
        node, most = 2 + len(source) + p, max(caps[n] for n in names)
        for r in range(most if costs else 1):
            g.arc(s, node, tokens if costs else tokens * most, r)
        for n in names:
            arcs[p, n] = g.arc(node, source[n], tokens * caps[n])
    for n, k in source.items():
        g.arc(k, t, round(shares[n] * total))
    flow, _ = g.run(s, t)
    more = g.reached(s)
    short = {n for n, k in source.items() if k not in more} if flow < sum(round(x * total) for x in shares.values()) else set()
    return {key: g.cap[k ^ 1] for key, k in arcs.items() if g.cap[k ^ 1] > 0}, flow, short


def largest_total(patterns: Patterns, shares: dict[str, float], caps: dict[str, int]) -> int:
    """The largest total (in tokens) at which every source still reaches its share.

    From an upper bound down: the minimum cut of a total that can't be reached names sources whose patterns hold too
    little, and the total at which just these would be served is the next to try. Each cut lowers the total for good,
    so a few maximal flows are enough.
    """
    total = sum(tokens * max(caps[n] for n in names) for names, tokens in patterns)
    while total > 0:
        _, flow, short = route(patterns, shares, caps, total, costs=False)
        if not short:
            return total
        served = flow - sum(round(shares[n] * total) for n in shares if n not in short)
        total = min(total - 1, int(served / sum(shares[n] for n in short)))
    return 0


def mix(documents: DataFrame, targets: DataFrame, scratch: Scratch, total: int | None = None, tokenizer: str = TOKENIZER, seed: int = 42) -> DataFrame:
    """(doc_id, source, repeats, tokens): which documents are used for which source, and how often.

    Copies of a text are one document that belongs to every source it stands in (its membership pattern); it is named
    by the smallest doc_id of that text in that source. Only the token sums of the patterns come to the driver, where
    a min-cost flow routes them to the sources' quotas. ``total`` defaults to the largest size at which every source
    that has documents reaches its share, the shares of sources without documents being spread over the others. A
    pattern's documents are then taken in an order set by the seed: full passes, and a last one up to the token at
    which the quota is met, so a source misses its quota by less than one document. A text is used at most
    max_repeats times for a source, and at most as often as the most generous of its sources allows in all.

    Null texts, null sources and sources that the targets don't list are left out; empty texts have no tokens and are
    never chosen. Nulls or negative numbers in targets count as 0; several rows of one source add up in share and the
    largest max_repeats holds. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    rows = targets.select(plain_source(F.col("source")).alias("s"), "target_share", "max_repeats").where("s IS NOT NULL AND target_share > 0 AND max_repeats > 0").groupBy("s").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("reps")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sources")
    want = {r["s"]: (r["share"], r["reps"]) for r in rows}
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", plain_source(F.col("source")).alias("source")).where("doc_id IS NOT NULL AND text IS NOT NULL AND source IS NOT NULL")
    docs = docs.where(F.col("source").isin(sorted(want))) if want else docs.where("false")
    # tokens are counted where the documents lie; no text is shuffled
    sized = count_tokens(docs.withColumn("key", F.md5("text")), tokenizer).where("tokens > 0")
    places = sized.groupBy("key", "source").agg(F.min("doc_id").alias("doc_id"), F.any_value("tokens").alias("tokens"))
    texts = places.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("source", "doc_id"))).alias("at"), F.any_value("tokens").alias("tokens"))
    texts = scratch.write(texts.withColumn("pattern", F.transform("at", lambda x: x.source)))
    sums = [(tuple(r["pattern"]), int(r["tokens"])) for r in texts.groupBy("pattern").agg(F.sum("tokens").alias("tokens")).orderBy("pattern").limit(MAX_PATTERNS + 1).collect()]
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sets of sources")
    there = {n for names, _ in sums for n in names}
    whole = sum(want[n][0] for n in there) or 1.0
    shares, caps = {n: want[n][0] / whole for n in there}, {n: int(want[n][1]) for n in there}
    routed: dict[tuple[int, str], int] = {}
    if sums:
        routed, _, _ = route(sums, shares, caps, largest_total(sums, shares, caps) if total is None else total)
    lines = []  # each source takes a stretch of the endless line of passes over the pattern's documents
    for p, (names, tokens) in enumerate(sums):
        at = 0
        for n in names:
            if flow := routed.get((p, n), 0):
                lines.append((list(names), tokens, n, at, at + flow))
                at += flow
    plan = spark.createDataFrame(lines, "pattern array<string>, whole long, source string, lo long, hi long")
    order = texts.select("key", "pattern", "at", "tokens", F.xxhash64("key", F.lit(seed)).alias("h"))
    order = order.withColumn("bucket", F.expr(f"CAST(shiftrightunsigned(h, 52) * {BUCKETS} / 4096 AS INT)"))
    per = order.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("n"))
    per = per.select("pattern", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("tokens").over(Window.partitionBy("pattern", "bucket").orderBy("h", "key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = order.withColumn("inside", inside).join(per, ["pattern", "bucket"]).withColumn("o", F.col("base") + F.col("inside"))
    # uses of the document: passes k with lo <= k * whole + o < hi
    uses = placed.join(plan, "pattern").withColumn("repeats", F.expr("CAST(greatest(ceil((hi - o) / whole), 0) - greatest(ceil((lo - o) / whole), 0) AS INT)")).where("repeats > 0")
    named = uses.withColumn("doc_id", F.filter("at", lambda x: x.source == F.col("source"))[0].doc_id)
    return named.select("doc_id", "source", "repeats", "tokens")


def mix_shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, documents, most_repeats, tokens, actual_share) for every source of the targets."""
    got = chosen.groupBy("source").agg(F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"))
    want = targets.select(plain_source(F.col("source")).alias("source"), "target_share", "max_repeats").where("source IS NOT NULL").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    total = got.agg(F.sum("tokens").alias("all"))
    out = want.join(got, "source", "left").crossJoin(F.broadcast(total))  # one row
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select("source", "target_share", "max_repeats", zero("documents"), zero("most_repeats"), zero("tokens"), F.coalesce(F.col("tokens") / F.col("all"), F.lit(0.0)).alias("actual_share"))


def broken_rules(chosen: DataFrame, documents: DataFrame, targets: DataFrame, scratch: Scratch) -> DataFrame:
    """(sources, used_too_often, strange, shares_off): how many sources are mixed, and how often a rule is broken: a
    document used more than max_repeats times, one that doesn't stand in the source it is chosen for, a source that
    misses its share (spread over the sources that have documents) by more than a document."""
    chosen = scratch.write(chosen)
    want = targets.select(plain_source(F.col("source")).alias("source"), "target_share", "max_repeats").where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("most"))
    often = chosen.join(want, "source", "left").where("repeats > coalesce(most, 0)").agg(F.count("*"))
    held = documents.select("doc_id", plain_source(F.col("source")).alias("source")).distinct()
    strange = chosen.join(held, ["doc_id", "source"], "left_anti").agg(F.count("*"))
    got = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("got"), F.max("tokens").alias("longest"))
    there = want.join(got, "source")
    total = there.agg(F.sum("got").alias("all"), F.sum("share").alias("whole"), F.max("longest").alias("most_tokens"))
    off = there.crossJoin(F.broadcast(total)).where("abs(got - share / whole * all) > 2 * most_tokens").agg(F.count("*"))  # one row
    one = there.agg(F.count("*").alias("sources"))
    for name, df in (("used_too_often", often), ("strange", strange), ("shares_off", off)):
        one = one.crossJoin(df.toDF(name))  # one row each
    return one
