"""Problem 10: abusive, hateful or sexual content."""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.llm.seeds import seed_texts
from limpid.runtime import plain_source

#: The classifier is fitted on at most so many rated documents, and so many unrated ones as weak examples of ordinary
#: text (most documents are harmless), both taken in the order of a hash.
MAX_LABELLED, MAX_BACKGROUND = 10_000, 4_000
BACKGROUND_WEIGHT = 0.2
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 14, 16, 24, (1, 2, 3, 4, 5)
EPOCHS, BATCH, RATE, DECAY, DROP = 6, 64, 2e-3, 1e-4, 0.5
#: Fewer steps than this are not taken, however few the documents.
STEPS = 450
#: Ratings that classifiers fitted on the other folds contradict this surely are taken for errors of the rater.
FOLDS, DOUBT = 3, 0.15
#: Ordinary text that those classifiers score above this is left out as well: some of it is toxic.
ORDINARY = 0.3
#: Tokens at a time when features are taken; longer texts are read in such overlapping parts, to their end.
PART = 2048
#: The threshold without any toxic rating, and the toxic ratings that it counts for beside those there are.
PRIOR_CUT, PRIOR_TOXIC = 0.2, 10
#: A language's own cut and the common one weigh alike at so many toxic ratings of the language.
SHRINK_TOXIC = 25
#: Scores are counted in so many equal bins when thresholds are set.
BINS = 1000
# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOKALIKES = str.maketrans("абеорсухіјѕԁһӏкмнтвαοерνικτυ", "a6eopcyxijsdhlkmhtbaoepviktu")
LEET = str.maketrans("013457@$!|€", "oieastasiie")
_HIDDEN = re.compile("[​-‏⁠-⁤﻿­͏؜᠎]")
_SPACED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][ ._-]){3,}[^\W\d_](?![^\W\d_])")
_STRETCH = re.compile(r"([^\W\d_])\1+")
_TOKEN = re.compile(r"(?:[^\W_]|[@$](?=[\w@$]))(?:[^\s.,;:!?()\[\]\"„“”<>=/\\#]*[^\s.,;:!?()\[\]\"„“”<>=/\\#])?|[.!?]")
_INNER = re.compile(r"(?<=[\w$@])!(?=[\w$@])")
_MASKED = re.compile(r"^([^\W\d_]{1,3})\*+([^\W\d_]{0,3})$")


def undisguised(text: str) -> list[str]:
    """The tokens of a text in lower case without look-alike letters, hidden characters and spaced-out words."""
    t = text.lower()
    if not t.isascii():
        t = _HIDDEN.sub("", unicodedata.normalize("NFKC", t)).translate(LOOKALIKES)
        t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).translate({0x2019: "'", 0x2018: "'"})
    t = _SPACED.sub(lambda m: re.sub(r"[ ._-]", "", m[0]), t)
    if "!" in t:
        t = _INNER.sub("i", t)
    return _TOKEN.findall(t)


def plain_token(w: str) -> tuple[str, str] | None:
    """(word, hint) of a token: signs for letters and stretched letters undone. A masked word (``s****d``) is the word
    '<*>' with its outer letters as hint; numbers, codes and structures are each one word. Letters never stand
    doubled, so that a stretched word equals its plain form."""
    if w in ".!?":
        return "<end>", ""
    if hit := _MASKED.match(w):
        return "<*>", f"{hit[1][0]}*{hit[2][-1:]}"
    w = w.strip("*'_~`-")
    if not w.isalpha():
        letters, digits, signs = sum(c.isalpha() for c in w), sum(c.isdigit() for c in w), sum(c in "@$!|" for c in w)
        if not letters and digits:
            return "<number>", ""
        if digits + signs:
            if digits > letters + signs or len(w) > 24:
                return "<code>", ""
            w = w if "-" in w else w.translate(LEET)
        if re.search(r"[()=\[\]@+%]", w):
            return "<code>", ""
    if len(w) > 24:
        return "<code>", ""
    w = _STRETCH.sub(r"\1", w)
    return (w, w[:5]) if w else None


def plain_tokens(text: str) -> list[tuple[str, str]]:
    """(word, hint) of every token of a text."""
    return [t for w in undisguised(text) if (t := plain_token(w))]


def _bucket(word: str) -> int:
    h = 1469598103934665603
    for b in word.encode():
        h = ((h ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return 1 + (h ^ (h >> 31)) % (BUCKETS - 1)


@dataclass
class Classifier:
    """Convolutional text classifier: hashed word embeddings, filters of several widths, max pooling, one output."""

    seed: int = 7
    known: frozenset[int] | None = None  # buckets seen often enough in training; others are the unknown word
    thresholds: dict[str, float] = field(default_factory=dict)
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    counts: pd.DataFrame | None = None  # scored ratings by language and score
    _memo: dict[str, tuple[int, int] | None] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_memo": {}}

    def ids(self, text: str) -> np.ndarray:
        """(tokens, 2): the buckets of word and hint, padded to the widest filter."""
        memo, rows = self._memo, []
        for w in undisguised(text):
            if w not in memo:
                token = plain_token(w)
                if len(memo) > 500_000:
                    memo.clear()
                memo[w] = token and self._known(_bucket(token[0]), _bucket("^" + token[1]) if token[1] else 0)
            if got := memo[w]:
                rows.append(got)
        rows += [(0, 0)] * (max(WIDTHS) - len(rows))
        return np.array(rows, np.int32)

    def _known(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.known is None else (a if a in self.known else 0, b if b in self.known else 0)

    def _embed(self, ids: np.ndarray) -> np.ndarray:
        e = self.weights["E"]
        return e[ids[..., 0]] + e[ids[..., 1]]

    def _pooled(self, x: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Max-pooled features (batch, widths x filters) and where each maximum lies. live: token counts."""
        feats, places = [], []
        every = np.concatenate([self.weights[f"W{w}"].transpose(1, 0, 2).reshape(DIM, -1) for w in WIDTHS], axis=1)
        y = (x.reshape(-1, DIM) @ every).reshape(*x.shape[:2], -1)  # all filters' taps at all places, in one product
        at_tap = 0
        for w in WIDTHS:
            z = y[:, : x.shape[1] - w + 1, at_tap : at_tap + FILTERS].copy()
            for j in range(1, w):
                z += y[:, j : x.shape[1] - w + 1 + j, at_tap + j * FILTERS : at_tap + (j + 1) * FILTERS]
            at_tap += w * FILTERS
            beyond = np.arange(z.shape[1])[None, :] >= np.maximum(live - w + 1, 1)[:, None]
            z[beyond] = -1e9
            at = z.argmax(axis=1)
            feats.append(np.maximum(np.take_along_axis(z, at[:, None, :], 1)[:, 0] + self.weights[f"b{w}"], 0))
            places.append(at)
        return np.concatenate(feats, axis=1), places

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, steps: int = STEPS) -> None:
        """Trains on the ids of texts (as an untrained classifier gives them)."""
        rng = np.random.default_rng(self.seed)
        seen = np.zeros(BUCKETS, np.int64)
        for d in docs:
            seen[np.unique(d)] += 1
        known = np.flatnonzero(seen >= 3)
        self.known = frozenset(int(k) for k in known)
        self._memo.clear()
        mask = np.zeros(BUCKETS, bool)
        mask[known] = True
        docs = [np.where(mask[d], d, 0) for d in docs]
        f32 = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        p = self.weights = {"E": f32(BUCKETS, DIM, scale=0.1), "v": f32(len(WIDTHS) * FILTERS, scale=0.1), "c": np.array([-1.0], np.float32)}
        p["E"][0] = 0
        for w in WIDTHS:
            p[f"W{w}"] = f32(w, DIM, FILTERS, scale=(1 / (w * DIM)) ** 0.5)
            p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        m, s, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
        size = np.array([len(d) for d in docs])
        rounds = max(epochs, -(-steps * BATCH // max(len(docs), 1))) if docs else 0
        for epoch in range(rounds):
            order = np.argsort(size + rng.random(len(docs)) * 40, kind="stable")
            batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
            rng.shuffle(batches)
            rate = RATE * (1 - epoch / rounds)
            for b in batches:
                n = size[b].max()
                ids = np.zeros((len(b), n, 2), np.int32)
                for i, k in enumerate(b):
                    ids[i, : size[k]] = docs[k]
                ids[rng.random(ids.shape[:2]) < 0.08] = 0  # words are left out now and then
                x = self._embed(ids)
                h, places = self._pooled(x, size[b])
                drop = (rng.random(h.shape) >= DROP).astype(np.float32) / (1 - DROP)
                hd = h * drop
                prob = 1 / (1 + np.exp(-np.clip(hd @ p["v"] + p["c"], -30, 30)))
                err = ((prob - labels[b]) * weight[b] / len(b)).astype(np.float32)
                grad = {"v": hd.T @ err + DECAY * p["v"], "c": np.array([err.sum()], np.float32)}
                dh = err[:, None] * p["v"][None, :] * drop * (h > 0)
                rows, spots, parts = np.arange(len(b))[:, None], [], []
                for i, w in enumerate(WIDTHS):
                    dz = dh[:, i * FILTERS : (i + 1) * FILTERS]
                    grad[f"b{w}"] = dz.sum(axis=0)
                    gw = np.zeros_like(p[f"W{w}"])
                    for j in range(w):
                        at = places[i] + j
                        gw[j] = np.einsum("bf,bfd->fd", dz, x[rows, at]).T
                        spots.append(ids[rows, at].reshape(-1, 2))
                        parts.append((dz[:, :, None] * p[f"W{w}"][j].T[None]).reshape(-1, DIM))
                    grad[f"W{w}"] = gw + DECAY * p[f"W{w}"]
                spot, part = np.concatenate(spots), np.concatenate(parts)
                alive = np.abs(part).sum(axis=1) > 0
                spot, part = spot[alive], part[alive]
                used, where = np.unique(spot, return_inverse=True)
                where = where.reshape(spot.shape)
                ge = np.zeros_like(p["E"])
                for d in range(DIM):
                    ge[used, d] = np.bincount(where[:, 0], part[:, d], len(used)) + np.bincount(where[:, 1], part[:, d], len(used))
                ge[0] = 0
                grad["E"] = ge
                step += 1
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of toxic content per text; whole texts, in overlapping parts."""
        return self.scores_of([self.ids(t) for t in texts])

    def scores_of(self, docs: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(docs))
        order = np.argsort([len(d) for d in docs], kind="stable")
        for lo in range(0, len(order), BATCH):
            b = order[lo : lo + BATCH]
            best = None
            n = max(len(docs[k]) for k in b)
            for at in range(0, max(n - max(WIDTHS) + 1, 1), PART):
                part = [docs[k][at : at + PART + max(WIDTHS) - 1] for k in b]
                wide = max(max(len(d) for d in part), max(WIDTHS))
                ids = np.zeros((len(b), wide, 2), np.int32)
                for i, d in enumerate(part):
                    ids[i, : len(d)] = d
                live = np.array([len(d) for d in part])
                h, _ = self._pooled(self._embed(ids), np.maximum(live, max(WIDTHS)))
                h[live == 0] = 0
                best = h if best is None else np.maximum(best, h)
            out[b] = 1 / (1 + np.exp(-np.clip(best @ self.weights["v"] + self.weights["c"], -30, 30)))
        return out

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang or "", self.thresholds[""])


def _best_cut(counts: np.ndarray) -> float:
    """The cut of the highest F1 over counts (BINS, 2) of harmless and toxic by score; between equal ones the middle."""
    hit = np.cumsum(counts[::-1, 1])[::-1]  # toxic from each bin on
    f1 = 2 * hit / (np.cumsum(counts.sum(axis=1)[::-1])[::-1] + counts[:, 1].sum()).clip(1e-9)
    top = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float((top[0] + top[-1]) / 2 / BINS)


def score_bins(score: np.ndarray) -> np.ndarray:
    return np.minimum((np.asarray(score, float) * BINS).astype(np.int64), BINS - 1)


def thresholds(counts: pd.DataFrame) -> dict[str, float]:
    """{language: threshold} from counts (lang, bin, toxic, n) of all scored ratings; '' is the common one.

    Every language with a rating gets the cut of its own best F1, drawn towards the common cut by the weight of
    SHRINK_TOXIC toxic ratings; the common cut is drawn towards PRIOR_CUT likewise. Nothing switches at a count.
    """

    def table(rows: pd.DataFrame) -> np.ndarray:
        out = np.zeros((BINS, 2))
        np.add.at(out, (rows["bin"].to_numpy(np.int64), rows["toxic"].to_numpy(np.int64)), rows["n"].to_numpy(float))
        return out

    def drawn(rows: pd.DataFrame, to: float, weight: float) -> float:
        t = table(rows)
        toxic = t[:, 1].sum()
        return float((toxic * _best_cut(t) + weight * to) / (toxic + weight))

    common = drawn(counts, PRIOR_CUT, PRIOR_TOXIC)
    return {"": common} | {str(lang): drawn(rows, common, SHRINK_TOXIC) for lang, rows in counts[counts.lang != ""].groupby("lang")}


@dataclass
class Lessons:
    """What classifiers are fitted on: token ids, marks and weights of the examples and of the seed sentences."""

    docs: list[np.ndarray]
    toxic: np.ndarray
    weight: np.ndarray
    seed_docs: list[np.ndarray]
    seed_toxic: np.ndarray

    def fitted(self, seed: int, rows: np.ndarray, epochs: int, steps: int, ask: np.ndarray) -> tuple[Classifier, np.ndarray]:
        """A classifier fitted on some of the examples, and its scores of others."""
        one = Classifier(seed)
        one.fit([self.docs[i] for i in np.flatnonzero(rows)] + self.seed_docs, np.concatenate([self.toxic[rows], self.seed_toxic]), np.concatenate([self.weight[rows], np.full(len(self.seed_docs), 0.5)]), epochs, steps)
        known = np.zeros(BUCKETS, bool)
        known[list(one.known)] = True
        return one, one.scores_of([np.where(known[self.docs[i]], self.docs[i], 0) for i in np.flatnonzero(ask)])


Job = tuple[int, np.ndarray, int, int, np.ndarray]


def fit_here(lessons: Lessons, jobs: list[Job]) -> list[tuple[Classifier, np.ndarray]]:
    return [lessons.fitted(*job) for job in jobs]


def fit_in_tasks(spark: SparkSession) -> Callable[[Lessons, list[Job]], list[tuple[Classifier, np.ndarray]]]:
    """Fits each classifier in a task of its own; the bounded lessons are broadcast, the fixed-size weights come back."""

    def fit(lessons: Lessons, jobs: list[Job]) -> list[tuple[Classifier, np.ndarray]]:
        # plain arrays travel both ways, so that executors need no copy of the package
        sent = spark.sparkContext.broadcast((lessons.docs, lessons.toxic, lessons.weight, lessons.seed_docs, lessons.seed_toxic))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for i in pdf["id"]:
                    one, said = Lessons(*sent.value).fitted(*jobs[i])
                    yield pd.DataFrame({"id": [i], "got": [pickle.dumps((one.seed, one.known, one.weights, said))]})

        rows = spark.range(0, len(jobs), 1, len(jobs)).mapInPandas(run, "id long, got binary").collect()
        sent.unpersist()
        got = [pickle.loads(bytes(r["got"])) for r in sorted(rows, key=lambda r: r["id"])]
        return [(Classifier(number, known, weights=weights), said) for number, known, weights, said in got]

    return fit


def train(rated: pd.DataFrame, background: pd.DataFrame | None = None, seed: int = 7, fit: Callable[[Lessons, list[Job]], list[tuple[Classifier, np.ndarray]]] = fit_here) -> Classifier:
    """A classifier from rows (text, lang, toxic in 0..1), helped by seed sentences and by ordinary text.

    Raters err, and some ordinary text is not: examples that are contradicted by classifiers fitted on the other folds
    are left out of the fit. No rating is held out for the thresholds: ``model.counts`` has how often texts of a
    language were rated so at a score, each scored by a classifier that was fitted on the other folds (by hash, so
    copies stay together). A fixed seed makes the fit repeatable, wherever the classifiers are fitted.
    """
    seeds, kinds = seed_texts()
    given = rated.assign(weight=1.0)
    if background is not None and len(background):
        given = pd.concat([given, background.assign(toxic=0.0, weight=BACKGROUND_WEIGHT)], ignore_index=True)
    fold = (given.text.map(_bucket).to_numpy(np.int64) // 6) % FOLDS if len(given) else np.zeros(0, np.int64)
    toxic, weight, raw = given.toxic.to_numpy(float), given.weight.to_numpy(float), Classifier()
    lessons = Lessons([raw.ids(t) for t in given.text], toxic, weight, [raw.ids(t) for t in seeds], np.array(kinds, float))
    folds, by_rating = range(FOLDS if len(given) else 0), np.arange(len(given)) < len(rated)
    trusted = np.ones(len(given), bool)
    for k, (_, said) in enumerate(fit(lessons, [(seed + 1 + k, fold != k, max(2, EPOCHS // 2), STEPS * 2 // 3, fold == k) for k in folds])):
        most = np.where(weight[fold == k] < 1, ORDINARY, 1 - DOUBT)
        trusted[fold == k] = np.abs(said - toxic[fold == k]) < most
    last = [(seed, trusted, EPOCHS, STEPS, np.zeros(len(given), bool))]
    (model, _), *others = fit(lessons, last + [(seed + 11 + k, trusted & (fold != k), EPOCHS, STEPS, (fold == k) & by_rating) for k in (folds if len(rated) else ())])
    score = np.zeros(len(given))
    for k, (_, said) in enumerate(others):
        score[(fold == k) & by_rating] = said
    langs = rated.lang.map(plain_lang) if len(rated) else []
    model.counts = _counts(langs, score[: len(rated)], toxic[: len(rated)])
    model.thresholds = thresholds(model.counts)
    return model


def plain_lang(lang: object) -> str:
    return lang.strip().lower() if isinstance(lang, str) else ""


def _counts(langs, score: np.ndarray, toxic: np.ndarray) -> pd.DataFrame:
    rows = pd.DataFrame({"lang": np.asarray(langs, dtype=object), "bin": score_bins(score), "toxic": (np.asarray(toxic, float) >= 0.5).astype(np.int64)})
    return rows.groupby(["lang", "bin", "toxic"]).size().rename("n").reset_index()


def rated_documents(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> pd.DataFrame:
    """The bounded sample of rated documents: (text, lang, toxic), toxic being the mean of a document's ratings."""
    marks = _marks(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang").join(F.broadcast(marks), "doc_id")  # at most MAX_LABELLED rows
    return rows.orderBy("doc_id", "text").select("text", "lang", "toxic").limit(2 * most).toPandas()


def _marks(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.avg("toxic").alias("toxic"))


def other_ratings(documents: DataFrame, labels: DataFrame, model: Classifier, sample: pd.DataFrame) -> pd.DataFrame:
    """Counts (lang, bin, toxic, n) of the rated documents whose texts the model was not fitted on, scored where they lie."""
    spark = documents.sparkSession
    fitted = spark.createDataFrame(sample[["text"]], "text string").select(F.xxhash64("text").alias("h")).distinct()
    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang").join(_marks(labels), "doc_id").withColumn("h", F.xxhash64("text"))
    rows = rows.join(F.broadcast(fitted), "h", "left_anti").select("text", "lang", "toxic")  # at most 2 MAX_LABELLED rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _counts(pdf["lang"].map(plain_lang), model.scores(pdf["text"].tolist()), pdf["toxic"])

    got = rows.mapInPandas(run, "lang string, bin long, toxic long, n long").groupBy("lang", "bin", "toxic").agg(F.sum("n").alias("n"))
    return got.orderBy("lang", "bin", "toxic").toPandas()  # 2 BINS rows a language at most


def ordinary_documents(documents: DataFrame, labels: DataFrame, most: int = MAX_BACKGROUND) -> pd.DataFrame:
    """The bounded sample of unrated documents: (text, lang)."""
    rated = labels.where("doc_id IS NOT NULL").select("doc_id").distinct()
    ids = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").join(rated, "doc_id", "left_anti").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = documents.where("text IS NOT NULL").select("doc_id", "text", "lang").join(F.broadcast(ids.distinct()), "doc_id")  # at most MAX_BACKGROUND rows
    return rows.orderBy("doc_id", "text").select("text", "lang").limit(2 * most).toPandas()


def score_documents(documents: DataFrame, labels: DataFrame, seed: int = 7) -> DataFrame:
    """(doc_id, source, lang, score, toxic) for every document.

    The classifiers are trained in tasks from a bounded sample of rated documents (MAX_LABELLED) and
    unrated ones (MAX_BACKGROUND) and sent to the workers (its size is fixed, about 2 MB). Thresholds come from all
    ratings: those of the sample by cross-fitted scores, the others by scores taken where the documents lie. Every document is scored whole where it lies, without a shuffle. Null and
    empty texts score 0. Unknown languages use the common threshold. Conflicting ratings count with their mean;
    without any rating the seed sentences alone teach the classifier.
    """
    sample = rated_documents(documents, labels)
    model = train(sample, ordinary_documents(documents, labels), seed, fit_in_tasks(documents.sparkSession))
    model.thresholds = thresholds(pd.concat([model.counts, other_ratings(documents, labels, model, sample)], ignore_index=True))
    model.counts = None  # the workers don't need them
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = pdf["text"].fillna("").tolist()
            score = np.where([bool(t.strip()) for t in text], model.scores(text), 0.0)
            lang = pdf["lang"].map(lambda x: x.strip().lower() if isinstance(x, str) else None)
            cut = np.array([model.threshold(x) for x in lang])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "lang": lang, "score": score.round(6), "toxic": score >= cut})

    rows = documents.select("doc_id", "text", "lang", plain_source(F.col("source")).alias("source"))
    return rows.mapInPandas(run, f"doc_id {kind}, source string, lang string, score double, toxic boolean")


def toxic_rates(scored: DataFrame) -> DataFrame:
    """(source, documents, toxic, rate, mean_score) per source; the null source is one of them."""
    return scored.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("toxic").cast("long")).alias("toxic"), F.avg(F.col("toxic").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))
