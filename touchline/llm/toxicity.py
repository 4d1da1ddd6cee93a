"""Toxicity by a classifier chain of linear models.

Categories are predicted in the order of ``CATEGORIES``; each model sees the text features and the
probabilities of the categories before it. In training those probabilities are out of fold (a row's
come from models that have not seen it), in scoring they come from the final models.

Only ``toxic`` is labelled. The two categories before it are derived from the same labelled rows:
``marked``: a toxic row with one marker or more, ``dense``: a toxic row with two markers or more,
where the markers are the features found most typical of toxic rows.

Text features are whole words and word beginnings of 4 to 6 letters, present or absent, over the
whole text. For out-of-fold predictions features and markers are chosen anew without the fold, so
nothing of a row's label reaches its own. Training takes at most ``TRAIN_TOXIC`` toxic and
``TRAIN_CLEAN`` other labelled rows of ``SAMPLE_BYTES`` bytes in all, chosen by a hash of the id; their ids are
broadcast, so the corpus isn't shuffled. Scoring streams every document past the model (a few
hundred weights).

Null and empty texts score as texts without any feature. Null labels are no labels; of several
labels of one document the largest counts; of several texts of one doc_id training takes the smallest. Without both classes the model says 0 for all.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATEGORIES = ("marked", "dense", "toxic")
TRAIN_TOXIC = 2000
TRAIN_CLEAN = 3000
#: Bytes of all texts that are collected for training.
SAMPLE_BYTES = 48_000_000
FEATURES = 256
FOLDS = 3
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    return [word + "$", *(word[:k] for k in PREFIXES if len(word) >= k)]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Chain:
    """Feature numbers and one weight vector per category: bias, features, earlier probabilities."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)

    def matrix(self, sets: list[set[int]]) -> np.ndarray:
        x = np.zeros((len(sets), len(self.vocabulary)), dtype=np.float64)
        for i, s in enumerate(sets):
            x[i, list(s)] = 1
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        """(rows, categories) probabilities, each fed to the models after it."""
        out = np.zeros((len(x), 0))
        for w in self.weights:
            out = np.hstack([out, sigmoid(with_bias(x, out) @ w)[:, None]])
        return out if self.weights else np.zeros((len(x), len(CATEGORIES)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def with_bias(x: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(x), 1)), x, earlier])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 5) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        curve = np.maximum(p * (1 - p), 1e-5)
        w -= np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
    return w


def text_features(text: str | None) -> set[str]:
    return {f for w in words_of(text) for f in features_of(w)}


def choose_features(toxic: list[str | None], clean: list[str | None], limit: int) -> list[str]:
    """Features far more frequent in toxic rows: those that explain the most rows first.

    Rows are counted one at a time, and in clean rows only features that toxic rows have.
    """
    hot: Counter[str] = Counter()
    for t in toxic:
        hot.update(text_features(t))
    hot = Counter({f: n for f, n in hot.items() if n >= 3})
    cold: Counter[str] = Counter()
    for t in clean:
        cold.update(f for f in text_features(t) if f in hot)
    scored = []
    for f, n in hot.items():
        ratio = ((n + 0.1) / (len(toxic) + 1)) / ((cold[f] + 0.5) / (len(clean) + 1))
        if ratio >= 4:
            scored.append((-n * math.log(ratio), f))
    return [f for _, f in sorted(scored)[:limit]]


def train(rows: list[tuple[str | None, int]], limit: int = FEATURES, folds: int = FOLDS) -> Chain:
    """Fit a chain on (text, toxic) rows."""
    y = np.array([t for _, t in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Chain()
    texts = [t for t, _ in rows]
    # Each fold has a view of the rows by features chosen without it; the last view, of all rows, makes the chain.
    fold = np.arange(len(y)) % folds
    views = [_view(texts, y, fold != k, limit) for k in range(folds)]
    chain, x, targets = _view(texts, y, fold >= 0, limit)
    earlier = np.zeros((len(y), 0))
    for c in range(len(CATEGORIES)):
        out = np.zeros(len(y))
        for k, (_, own, wanted) in enumerate(views):
            data = with_bias(own, earlier)
            out[fold == k] = sigmoid(data[fold == k] @ fit_logistic(data[fold != k], wanted[c][fold != k]))
        chain.weights.append(fit_logistic(with_bias(x, earlier), targets[c]))
        earlier = np.hstack([earlier, out[:, None]])
    return chain


def _view(texts: list[str | None], y: np.ndarray, seen: np.ndarray, limit: int) -> tuple[Chain, np.ndarray, list[np.ndarray]]:
    """(chain without weights, features of all rows, target of each category), chosen by the rows in ``seen``."""
    toxic, clean = ([t for t, v, s in zip(texts, y, seen, strict=True) if s and v == k] for k in (1, 0))
    chosen = choose_features(toxic, clean, limit)
    chain = Chain({f: i for i, f in enumerate(chosen)})
    reader = Reader(chain)
    sets = [reader.features(t) for t in texts]
    marking = {i for i, f in enumerate(chosen) if f.endswith("$") or len(f) == PREFIXES[0]}
    markers = np.array([len(marking & s) for s in sets])
    return chain, chain.matrix(sets), [y * (markers >= 1), y * (markers >= 2), y]


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: dict[int, int], where: str = "true", limit: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """At most ``most[value]`` (text, value) rows per label value and about ``limit`` bytes in all, the same on every run.

    Chosen by a hash of the id among the labels alone; their ids (bounded by ``most``) are
    broadcast to the scan of the documents. Sizes come first; ids are taken in order of the hash, of
    every value the same share of ``limit``, as long as their texts fit.
    """
    once = labels.filter(f"doc_id is not null and {column} is not null and ({where})").groupBy("doc_id").agg(F.max(column).cast("int").alias("y"))
    picks = [once.filter(F.col("y") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for v, n in most.items()]
    chosen = picks[0]
    for p in picks[1:]:
        chosen = chosen.union(p)

    def texts(of: DataFrame, *columns) -> list:
        """One row per chosen id, of its smallest text."""
        of = of.withColumnRenamed("doc_id", "_id")
        found = docs.select("doc_id", "text").join(F.broadcast(of), F.col("doc_id") == F.col("_id"))
        return found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "y", *columns).collect()

    def mixed(key: int) -> int:
        return (key * 2654435761) % (1 << 32)

    sizes = sorted(texts(chosen, F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")), key=lambda r: (mixed(r["doc_id"]), r["doc_id"]))
    held, kept = dict.fromkeys(most, 0), []
    for r in sizes:
        if held[r["y"]] + r["n"] <= limit // len(most):
            held[r["y"]] += r["n"]
            kept.append((r["doc_id"], r["y"]))
    if not kept:
        return []
    found = {r["doc_id"]: (r["text"], r["y"]) for r in texts(docs.sparkSession.createDataFrame(kept, "doc_id long, y int"), "text")}
    return [found[k] for k, _ in kept]


class Reader:
    """Probabilities of texts; the features of a word are looked up once and reused."""

    def __init__(self, chain: Chain, keep: int = 300_000):
        self.chain, self.keep = chain, keep
        self.known: dict[str, tuple[int, ...]] = {}

    def features(self, text: str | None) -> set[int]:
        known, vocabulary = self.known, self.chain.vocabulary
        if len(known) > self.keep:
            known.clear()
        found: set[int] = set()
        for w in words_of(text):
            hit = known.get(w)
            if hit is None:
                hit = known[w] = tuple(vocabulary[f] for f in features_of(w) if f in vocabulary)
            if hit:
                found.update(hit)
        return found

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return self.chain.predict(self.chain.matrix([self.features(t) for t in texts]))


def score(docs: DataFrame, chain: Chain, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, one probability per category) for every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(chain)
    columns = [f"p_{c}" for c in CATEGORIES]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for batch in batches:
            p = reader.probabilities(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64")} | {c: p[:, i] for i, c in enumerate(columns)})

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, " + ", ".join(f"{c} double" for c in columns))


def fit(docs: DataFrame, labels: DataFrame) -> Chain:
    return train(labelled_sample(docs, labels, "toxic", {1: TRAIN_TOXIC, 0: TRAIN_CLEAN}))


def keep_clean(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text the chain does not call toxic, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(shared.value)
        for texts in batches:
            yield pd.Series(reader.probabilities(texts.tolist())[:, -1])

    return docs.filter(toxic(F.col("text")) < threshold)
