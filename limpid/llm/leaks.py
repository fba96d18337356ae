"""Problem 8: evaluation texts leaking into training text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.shingles import code_points, grams, places, window_minima

#: A leak is a run of at least so many letters and digits.
RUN = 60
#: Length of the shingles whose minima are the sketch of every RUN characters.
SHINGLE = 20
#: Evaluation items of so many characters together are held in memory by every task; beyond, sketches are joined.
PASS_CHARS = 20_000_000
#: Documents are read in runs of about so many characters.
RUN_CHARS = 2_000_000
_OTHER = re.compile(r"[\W_]+")


def normalise(text: str) -> str:
    """Lower case, letters and digits only."""
    return _OTHER.sub("", text.lower())


def sketches(texts: list[str]) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]]:
    """(MinHash, text, places): of every partition of RUN characters the smallest shingle hash, equal neighbours once;
    and a function that gives, for some of them, where their shingles stand in their texts: (which of them, place)."""
    flat, offsets = code_points(texts)
    h, own = grams(flat, offsets, SHINGLE)
    low, whose, first, count = window_minima(h, own, RUN - SHINGLE + 1)
    per = np.bincount(own, minlength=len(texts))
    start = np.cumsum(per) - per

    def where(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        which, at = places(h, first[some], count[some], RUN - SHINGLE + 1)
        return which, at - start[whose[some][which]]

    return low, whose, where


class Items:
    """Items held in memory: their normalised texts and where each MinHash of a RUN-sized partition stands."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, t) for i, t in items if len(t) >= RUN]
        self.at: dict[int, list[tuple[int, int]]] = {}
        low, whose, place = sketches([t for _, t in self.items])
        which, at = place(np.arange(len(low)))
        for m, k, p in zip(low[which].tolist(), whose[which].tolist(), at.tolist()):
            self.at.setdefault(m, []).append((k, p))
        self.keys = np.array(sorted(self.at), dtype=np.uint64)

    def runs(self, texts: list[str]) -> Iterator[tuple[int, int, int, float]]:
        """(text, item id, longest run, share of the item that such runs cover) for every text and item with a common run."""
        if not texts or not len(self.keys):
            return
        low, whose, place = sketches(texts)
        if not len(low):
            return
        slot = np.minimum(np.searchsorted(self.keys, low), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[slot] == low)
        found: dict[tuple[int, int], set[tuple[int, int]]] = {}
        which, at = place(hit)
        for m, d, p in zip(low[hit[which]].tolist(), whose[hit[which]].tolist(), at.tolist()):
            for k, q in self.at[m]:
                got = found.setdefault((d, k), set())
                if any(a <= q < b and s == p - q for a, b, s in got):
                    continue  # inside a run that is known
                if run := self._extend(texts[d], self.items[k][1], p, q):
                    got.add((*run, p - q))
        for (d, k), got in found.items():
            if got:
                covered, end = 0, 0
                for a, b, _ in sorted(got):
                    covered += max(0, b - max(a, end))
                    end = max(end, b)
                yield d, self.items[k][0], max(b - a for a, b, _ in got), covered / len(self.items[k][1])

    @staticmethod
    def _extend(text: str, item: str, p: int, q: int) -> tuple[int, int] | None:
        """The common run around the shingle at p of the text and q of the item, as (from, to) in the item; exact."""
        if text[p : p + SHINGLE] != item[q : q + SHINGLE]:
            return None
        a = q
        while a > 0 and p - (q - a) > 0 and item[a - 1] == text[p - (q - a) - 1]:
            a -= 1
        b = q + SHINGLE
        while b < len(item) and p + b - q < len(text) and item[b] == text[p + b - q]:
            b += 1
        return (a, b) if b - a >= RUN else None


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Rows with their normalised texts, in runs of about RUN_CHARS characters."""
    for pdf in batches:
        lo, held, size = 0, [], 0
        for k, t in enumerate(pdf["text"].tolist(), 1):
            held.append(normalise(t))
            size += len(held[-1])
            if size >= RUN_CHARS or k == len(pdf):
                yield pdf.iloc[lo:k], held
                lo, held, size = k, [], 0


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, run, coverage): documents and items that share a run of RUN or more letters and digits.

    Texts and items are cut into all their partitions of RUN characters; the MinHash of a partition's shingles is its
    sketch. Equal partitions have equal sketches, so a lookup of the documents' sketches in the items' loses no leak
    however long the document or short the passage, and the shingles around every hit are then compared exactly.
    run is the longest run, coverage the share of the item's letters and digits that lie in such runs, both the
    highest over the texts of a pair of ids. Documents are read once, whole, where they lie, against all items in
    memory; items of more than PASS_CHARS characters together are met by a shuffle join of sketches instead, with the
    same result. Items shorter than RUN can't leak; nulls and empty texts leak nothing; repeated rows change nothing.
    """
    docs = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    held = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    kind = documents.schema["doc_id"].dataType.simpleString()
    size = held.agg(F.sum(F.length("text"))).first()[0] or 0
    found = _by_memory(docs, held, kind) if size <= PASS_CHARS else _by_join(docs, held, kind)
    return found.groupBy("doc_id", "item_id").agg(F.max("run").alias("run"), F.max("coverage").alias("coverage"))


def _by_memory(docs: DataFrame, items: DataFrame, kind: str) -> DataFrame:
    known = Items([(r["item_id"], normalise(r["text"])) for r in items.orderBy("item_id", "text").collect()])  # at most PASS_CHARS characters

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, texts in _texts(batches):
            ids = pdf["doc_id"].tolist()
            yield pd.DataFrame([(ids[d], k, n, c) for d, k, n, c in known.runs(texts)], columns=["doc_id", "item_id", "run", "coverage"])

    return docs.mapInPandas(run, f"doc_id {kind}, item_id long, run int, coverage double")


def _by_join(docs: DataFrame, items: DataFrame, kind: str) -> DataFrame:
    """Sketches of both sides joined; the pairs of texts that meet are compared exactly."""

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, texts in _texts(batches):
            low, whose, _ = sketches(texts)
            yield pd.DataFrame({"low": low.astype(np.int64), "h": pdf["h"].to_numpy()[whose]}).drop_duplicates()

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(d, k, n, c) for d, t, i, u in pdf[["doc_id", "text", "item_id", "item"]].itertuples(index=False) for _, k, n, c in Items([(i, normalise(u))]).runs([normalise(t)])]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "run", "coverage"])

    sides = [x.withColumn("h", F.xxhash64("text")) for x in (docs, items)]  # a hash that two texts share only adds a comparison
    met = [x.select("h", "text").mapInPandas(sketched, "low long, h long").distinct() for x in sides]
    pairs = met[0].join(met[1].withColumnRenamed("h", "g").hint("merge"), "low").select("h", "g").distinct()
    both = pairs.join(sides[0].hint("merge"), "h").join(sides[1].select(F.col("h").alias("g"), "item_id", F.col("text").alias("item")).hint("merge"), "g")
    return both.select("doc_id", "text", "item_id", "item").mapInPandas(compared, f"doc_id {kind}, item_id long, run int, coverage double")


def leaked_items(found: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, documents, longest_run, coverage) for every item; 0 documents where it didn't leak."""
    per = found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("run").alias("longest_run"), F.max("coverage").alias("coverage"))
    return items.select("item_id").where("item_id IS NOT NULL").distinct().join(per, "item_id", "left").select("item_id", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("longest_run", F.lit(0)).alias("longest_run"), F.round(F.coalesce("coverage", F.lit(0.0)), 6).alias("coverage"))
