"""Bit-vector similarity, clusters on it, and low-dimensional views of vectors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limpid.operators import linear
from limpid.runtime import Scratch


def bit_words(flags: Column, width: int) -> Column:
    """Array of 64-bit words from an array of booleans (true: bit set)."""
    n = -(-width // 64)

    def word(k: int) -> Column:
        part = F.slice(flags, k * 64 + 1, 64)
        return F.aggregate(F.transform(part, lambda b, i: F.when(b, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return F.array(*[word(k) for k in range(n)])


def bit_total(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda a, w: a + F.bit_count(w))


def tanimoto(a: Column, b: Column) -> Column:
    """Common bits over all bits of two word arrays; 0 for two empty vectors."""
    both = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, x: s + x)
    either = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(either > 0, both / either).otherwise(0.0)


#: Vectors are compared block against block: up to SPREAD blocks of at least BLOCK vectors, beyond that blocks of MOST.
BLOCK, SPREAD, MOST = 4096, 8, 131_072
#: Groups of bits whose parities are compared first, and rows and columns of a matrix product at a time.
FOLD, ROWS, COLS = 128, 256, 4096


def _parities(words: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """(rows, groups) of 0 and 1: whether a vector has an odd number of the bits of each group."""
    bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, np.argsort(group, kind="stable")]
    return np.bitwise_xor.reduceat(bits, np.searchsorted(np.sort(group), np.arange(groups)), axis=1)


def similar_pairs(df: DataFrame, key: str, words: str, limit: float) -> DataFrame:
    """(a, b, similarity) of all pairs with a < b and Tanimoto similarity of at least limit (> 0).

    Exact: of vectors with m and n bits as similar as the limit, at most (1 - limit) / (1 + limit) * (m + n) bits stand in
    one only, and so no more groups of bits differ in parity. Parities are compared by matrix products, the few pairs that
    pass bit by bit. Vectors are written once and sent once for each block that theirs meets, so what is shuffled doesn't
    grow with their bits, nor with how many share one. Empty vectors are similar to none; rows without key or vector are
    left out.
    """
    v = df.select(F.col(key).alias("k"), F.col(words).alias("w")).where("k IS NOT NULL AND w IS NOT NULL").where(bit_total(F.col("w")) > 0)
    v = Scratch(df.sparkSession, "pairs").write(v)
    count, length = v.agg(F.count("*"), F.max(F.size("w"))).first()
    length = length or 1

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(64 * length, np.int64)
        for pdf in batches:
            seen += np.unpackbits(_packed(pdf["w"], length).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        yield pd.DataFrame({"bit": np.arange(len(seen)), "f": seen})

    seen = v.select("w").mapInPandas(counted, "bit long, f long").groupBy("bit").agg(F.sum("f").alias("f")).toPandas()  # one row per bit
    often = np.zeros(64 * length, np.int64)
    often[seen["bit"].to_numpy(np.int64)] = seen["f"].to_numpy(np.int64)
    groups = min(FOLD, 64 * length)
    group = np.empty(64 * length, np.int64)  # bits that tell much, held by about half of the vectors, are spread over the groups
    group[np.argsort(-often * (count - often).astype(float), kind="stable")] = np.arange(64 * length) % groups
    blocks = max(min(SPREAD, -(-count // BLOCK)), -(-count // MOST), 1)
    margin = (1 - limit) / (1 + limit)
    kind = df.schema[key].dataType.simpleString()

    def compared(keys: np.ndarray, held: np.ndarray, side: np.ndarray) -> Iterator[pd.DataFrame]:
        n = np.bitwise_count(held).sum(axis=1, dtype=np.int64)
        order = np.lexsort((n, side))
        keys, held, n, side = keys[order], held[order], n[order], side[order]
        cut = int(np.searchsorted(side, side[0], "right"))
        lone = cut == len(side)
        if lone and side[0] >= 0:
            return  # the other block has no vectors
        odd = np.concatenate([_parities(held[lo : lo + COLS], group, groups).astype(np.float32) for lo in range(0, len(held), COLS)])
        need = ((odd.sum(axis=1) - margin * n) / 2).astype(np.float32)
        first, last = (0, len(n)) if lone else (cut, len(n))
        for lo in range(0, cut, ROWS):
            hi = min(lo + ROWS, cut)
            # sizes ascend in a block: columns that are too small or too large for all these rows are left out
            start = first + int(np.searchsorted(n[first:last], limit * n[lo] - 1e-6))
            end = first + int(np.searchsorted(n[first:last], n[hi - 1] / limit + 1e-6, "right"))
            out = []
            for c in range(max(start, lo) if lone else start, end, COLS):
                d = min(c + COLS, end)
                score = odd[lo:hi] @ odd[c:d].T
                score -= need[lo:hi, None]
                i, j = np.divmod(np.flatnonzero(score >= need[c:d] - np.float32(1e-2)), d - c)
                i, j = i + lo, j + c
                if lone:
                    i, j = i[i < j], j[i < j]
                both = np.bitwise_count(held[i] & held[j]).sum(axis=1, dtype=np.int64)
                either = n[i] + n[j] - both
                near = both >= limit * either - 1e-9
                i, j = i[near], j[near]
                out += [(*((p, q) if p < q else (q, p)), x / y) for p, q, x, y in zip(keys[i], keys[j], both[near].tolist(), either[near].tolist()) if p != q]
            if out:
                yield pd.DataFrame(out, columns=["a", "b", "similarity"])

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A task's rows come sorted by cell; a cell holds one block or two."""
        cell, parts = None, []
        for pdf in batches:
            at = pdf["cell"].to_numpy()
            ends = [*(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for lo, hi in zip([0, *ends[:-1]], ends):
                if hi == lo:
                    continue
                if at[lo] != cell and parts:
                    yield from compared(*map(np.concatenate, zip(*parts)))
                    parts = []
                cell = at[lo]
                parts.append((pdf["k"].to_numpy()[lo:hi], _packed(pdf["w"].iloc[lo:hi], length), pdf["side"].to_numpy()[lo:hi]))
        if parts:
            yield from compared(*map(np.concatenate, zip(*parts)))

    mine = F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int")
    sent = v.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cell = F.least("mine", "other") * blocks + F.greatest("mine", "other")
    sent = sent.select(cell.alias("cell"), F.when(F.col("mine") == F.col("other"), -1).otherwise(F.col("mine")).alias("side"), "k", "w")
    return sent.repartition(blocks * (blocks + 1) // 2, "cell").sortWithinPartitions("cell").mapInPandas(met, f"a {kind}, b {kind}, similarity double")


def _packed(words: pd.Series, length: int) -> np.ndarray:
    """(rows, length) of 64-bit words; shorter vectors are filled up with zeros."""
    out = np.zeros((len(words), length), np.uint64)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.asarray(w, np.int64).view(np.uint64)
    return out


def sphere_clusters(df: DataFrame, key: str, words: str, limit: float = 0.7, most_rounds: int = 10_000) -> DataFrame:
    """(key, cluster) by exclusion spheres: the row with the most neighbours founds cluster 0 with them,
    then the next, down to single rows; rows without bits get -1.

    The sweep is sequential by nature, but far rows don't touch: a row founds a cluster if no neighbour before it (by
    degree, then key) does. In every round all rows found one that come before each neighbour of theirs still open, and
    their neighbours are closed. At the end every row goes to the first founder among its neighbours, as in the sweep.
    The rounds are joins on the neighbour table. Cluster numbers follow the order.
    """
    scratch = Scratch(df.sparkSession, "spheres")
    pairs = similar_pairs(df, key, words, limit).select("a", "b")
    links = scratch.write(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    nodes = df.select(F.col(key).alias("k"), bit_total(F.col(words)).alias("n")).where("k IS NOT NULL")
    degree = links.groupBy(F.col("a").alias("k")).agg(F.count("*").alias("d"))
    order = scratch.write(nodes.where("n > 0").join(degree, "k", "left").select("k", F.coalesce("d", F.lit(0)).alias("d")))
    todo, centres = order, None
    for _ in range(most_rounds):
        if todo.isEmpty():
            break
        near = links.join(todo.select(F.col("k").alias("a"), F.col("d").alias("da")), "a").join(todo.select(F.col("k").alias("b"), F.col("d").alias("db")), "b")
        beaten = near.where("db > da OR (db = da AND b < a)").select(F.col("a").alias("k")).distinct()
        found = scratch.write(todo.join(beaten, "k", "left_anti"))
        closed = links.join(found.select(F.col("k").alias("a")), "a").select(F.col("b").alias("k")).unionByName(found.select("k")).distinct()
        centres = found if centres is None else centres.unionByName(found)
        left = scratch.write(todo.join(closed, "k", "left_anti"))
        scratch.drop(*([todo] if todo is not order else []))
        todo = left
    else:
        raise RuntimeError(f"rows are left after {most_rounds} rounds")
    lone = nodes.where("n = 0").select("k", F.lit(-1).cast("long").alias("cluster"))
    if centres is None:
        return lone.withColumnRenamed("k", key)
    numbered = _numbered(centres.withColumnRenamed("k", "centre"))
    # the number of a founder is its place in the order: the first founder is the smallest number
    taken = links.join(numbered, links.a == numbered.centre).select(F.col("b").alias("k"), "cluster").unionByName(numbered.select(F.col("centre").alias("k"), "cluster"))
    return taken.groupBy("k").agg(F.min("cluster").alias("cluster")).unionByName(lone).withColumnRenamed("k", key)


def _numbered(centres: DataFrame) -> DataFrame:
    """(centre, cluster): numbers by falling degree, then key; ranks within a degree are offset by those before."""
    per = centres.groupBy("d").agg(F.count("*").alias("n"))
    before = per.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")  # one row per degree
    inside = F.row_number().over(Window.partitionBy("d").orderBy("centre")) - 1
    return centres.withColumn("i", inside).join(before, "d").select("centre", (F.col("before") + F.col("i")).cast("long").alias("cluster"))


def moments(df: DataFrame, vector: str, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, population covariance) of an array column, from width x width sums of products of whole batches."""
    rows = df.where(F.size(vector) == width).select(F.concat(F.array(F.lit(1.0)), F.transform(vector, lambda v: v.cast("double"))).alias("x"))
    m = linear.block_sums(rows.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v))), width + 1, lambda x: x.T @ x).get(None)
    if m is None:
        return 0, np.zeros(width), np.zeros((width, width))
    mean = m[0, 1:] / m[0, 0]
    return int(m[0, 0]), mean, m[1:, 1:] / m[0, 0] - np.outer(mean, mean)


def _dot(vector: str, w: np.ndarray, shift: np.ndarray) -> Column:
    """Scalar product of w with the vector less the shift; the weights are an array literal, so plans stay small."""
    weights = F.array(*[F.lit(float(x)) for x in w])
    return F.aggregate(F.zip_with(vector, weights, lambda v, x: v.cast("double") * x), F.lit(0.0), lambda a, x: a + x) - float(shift @ w)


def pca(df: DataFrame, vector: str, width: int, k: int = 2, fitted: DataFrame | None = None) -> DataFrame:
    """Adds pc1..pck of the standardised vector. Signs are fixed by the largest loading being positive."""
    _, mean, cov = moments(df if fitted is None else fitted, vector, width)
    sd = np.sqrt(np.maximum(np.diag(cov), 0))
    scale = np.where(sd > 1e-12, sd, 1.0)
    values, vectors = np.linalg.eigh(cov / np.outer(scale, scale))
    cols = {}
    for c in range(k):
        v = vectors[:, -1 - c]
        v = v * np.sign(v[np.argmax(np.abs(v))] or 1.0)
        cols[f"pc{c + 1}"] = _dot(vector, v / scale, mean)
    return df.where(F.size(vector) == width).withColumns(cols)


def mahalanobis(df: DataFrame, vector: str, width: int, name: str = "distance") -> DataFrame:
    """Adds the Mahalanobis distance to the mean, by the pseudo-inverse of the sample covariance."""
    n, mean, cov = moments(df, vector, width)
    inv = np.linalg.pinv(cov * n / max(n - 1, 1))
    values, vectors = np.linalg.eigh(inv)
    rows = [vectors[:, i] * np.sqrt(max(values[i], 0)) for i in range(width) if values[i] > 1e-12]
    total = reduce(lambda a, r: a + F.pow(_dot(vector, r, mean), 2), rows, F.lit(0.0))
    return df.where(F.size(vector) == width).withColumn(name, F.sqrt(total))
