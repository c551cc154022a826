"""Toxicity by a classifier chain.

Categories are predicted one after the other. The model of a category is a logistic
regression on the presence of words and on the earlier categories' probabilities (as
log-odds). In training, those probabilities are out-of-fold: documents are split into
``FOLDS`` by a hash of their id, and each fold is predicted by models that have not
seen it, word selection included. In use, the models of all training rows follow each
other. The label table knows two categories, low quality and toxic; low quality comes
first in the chain. Any list of 0/1 label columns will do.

Training takes a sample of at most ``SAMPLE`` labelled documents, those with the
smallest id hash, in one task; only their distinct words go there. A model is at most
``WORDS`` words per category. Scoring covers every word of every document inside the
task that reads it, without a shuffle.

Defined results: null or wordless text has no words and gets the models' intercepts
(never toxic: a text without words is given probability 0); null ids and labels are
not trained on, the first of several labels per id by value (largest) counts; without
both classes in the sample a category's probability is its constant rate; each input
row gives one row; only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubstrata.llm.common import Scratch, map_frames, read_table, rows_of, ship_package, small

CATEGORIES = ("low_quality", "toxic")
SAMPLE, FOLDS, WORDS, RIDGE, THRESHOLD, MIN_DOCS = 8000, 5, 200, 0.1, 0.3, 4
_WORD = re.compile(r"[^\W\d_]+")


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression, the last one the unpenalised intercept (Newton steps)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def choose_words(words: list[set[str]], y: np.ndarray, limit: int = WORDS) -> list[str]:
    """The words whose document shares differ most between the classes, by z-score."""
    pos, neg = Counter(), Counter()
    for w, label in zip(words, y):
        (pos if label else neg).update(w)
    n1, n0 = max(1, int(y.sum())), max(1, int(len(y) - y.sum()))
    ranked = []
    for w in pos.keys() | neg.keys():
        a, b = pos[w], neg[w]
        if a + b >= MIN_DOCS:
            p = (a + b) / (n1 + n0)
            ranked.append((-abs(a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12), w))
    return [w for _, w in sorted(ranked)[:limit]]


def presence(words: list[set[str]], vocab: list[str]) -> np.ndarray:
    at = {w: i for i, w in enumerate(vocab)}
    x = np.zeros((len(words), len(vocab)))
    for r, ws in enumerate(words):
        x[r, [at[w] for w in ws if w in at]] = 1
    return x


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class Link:
    """One category's model: words, their weights, weights of the earlier categories, intercept."""

    def __init__(self, vocab, weights, earlier, intercept):
        self.vocab, self.weights, self.earlier, self.intercept = vocab, weights, earlier, intercept

    @classmethod
    def fit(cls, words, y, earlier: np.ndarray) -> "Link":
        if y.min() == y.max():
            return cls([], [], [0.0] * earlier.shape[1], float(log_odds(np.array([y[0]]))[0]))
        vocab = choose_words(words, y)
        w = logistic(np.hstack([presence(words, vocab), earlier]), y)
        n = len(vocab)
        return cls(vocab, w[:n].tolist(), w[n:-1].tolist(), float(w[-1]))

    def predict(self, words, earlier: np.ndarray) -> np.ndarray:
        at = dict(zip(self.vocab, self.weights))
        z = np.array([sum(at[w] for w in ws if w in at) for ws in words]) if words else np.zeros(0)
        z = z + earlier @ np.array(self.earlier) + self.intercept if earlier.shape[1] else z + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_chain(words: list[set[str]], labels: np.ndarray, folds: np.ndarray) -> tuple[list[Link], np.ndarray]:
    """Models of the columns of ``labels`` in order, and the out-of-fold probabilities."""
    chain, held = [], np.zeros(labels.shape)
    earlier = np.zeros((len(words), 0))
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        for f in np.unique(folds):
            train, test = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
            if len(train) == 0:
                held[test, c] = y.mean()
                continue
            link = Link.fit([words[i] for i in train], y[train], earlier[train])
            held[test, c] = link.predict([words[i] for i in test], earlier[test])
        chain.append(Link.fit(words, y, earlier))
        earlier = np.hstack([earlier, log_odds(held[:, [c]])])
    return chain, held


def apply_chain(chain: list[Link], words: list[set[str]]) -> np.ndarray:
    out, earlier = np.zeros((len(words), len(chain))), np.zeros((len(words), 0))
    for c, link in enumerate(chain):
        out[:, c] = link.predict(words, earlier)
        earlier = np.hstack([earlier, log_odds(out[:, [c]])])
    out[[i for i, w in enumerate(words) if not w]] = 0.0
    return out


def _fit(n_labels: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "fold"])
        words = [set(w) for w in pdf["words"]]
        labels = np.stack([pdf[f"y{c}"].to_numpy() for c in range(n_labels)], axis=1)
        chain, held = fit_chain(words, labels, pdf["fold"].to_numpy())
        model = [vars(link) for link in chain]
        return pd.DataFrame({"model": [json.dumps(model)], "held": [json.dumps([held.tolist(), labels.tolist()])]})
    return run


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(words=[sorted(text_words(t)) for t in pdf["text"]]).drop(columns="text")


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, categories=CATEGORIES, sample: int = SAMPLE) -> tuple[list[Link], list]:
    """The chain and [out-of-fold probabilities, labels] of the sample. ``labels``: doc_id and a 0/1 column per category."""
    full = [F.col(c).isNotNull() for c in categories]
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories])
    for test in full:
        known = known.where(test)
    known = known.select(F.col("doc_id").alias("l_id"), *[F.col(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories)])
    picked = scratch.cut(known.orderBy(F.xxhash64("l_id"), "l_id").limit(sample), "picked")
    rows = docs.join(small(picked, 24), F.col("doc_id") == F.col("l_id")).drop("l_id")
    schema = "doc_id long, " + ", ".join(f"y{i} int" for i in range(len(categories)))
    rows = rows.mapInPandas(_words, f"{schema}, words array<string>").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS)).cast("int"))
    # an id that many rows repeat is trained on once
    rows = rows.groupBy("doc_id").agg(*[F.first(c).alias(c) for c in rows.columns if c not in ("doc_id", "words")], F.min("words").alias("words"))
    fitted = rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(_fit(len(categories)), "model string, held string").collect()
    if not fitted:
        return [Link([], [], [0.0] * i, -9.0) for i in range(len(categories))], [[], []]
    return [Link(**m) for m in json.loads(fitted[0].model)], json.loads(fitted[0].held)


def score(docs: DataFrame, chain: list[Link], categories=CATEGORIES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, a probability p_<category> per category, and ``toxic`` for the chain's last one."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = {w for link in chain for w in link.vocab}
        for pdf in batches:
            all_words = [text_words(t) for t in pdf["text"]]
            p = apply_chain(chain, [w & vocab or ({""} if w else w) for w in all_words])
            out = {"doc_id": pdf["doc_id"]} | {f"p_{c}": p[:, i] for i, c in enumerate(categories)}
            yield pd.DataFrame(out | {categories[-1]: p[:, -1] >= threshold})

    schema = "doc_id long, " + "".join(f"p_{c} double, " for c in categories) + f"{categories[-1]} boolean"
    return map_frames(docs, run, schema)


def classify(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample: int = SAMPLE) -> DataFrame:
    ship_package(docs.sparkSession)
    d = rows_of(docs, "doc_id", "text")
    chain, _ = train(d, labels, Scratch(docs.sparkSession, "toxic"), categories, sample)
    return score(d, chain, categories)


def category_labels(labels: DataFrame) -> DataFrame:
    """The label table's two categories as 0/1 columns."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document of ``documents``: doc_id, p_low_quality, p_toxic, toxic."""
    return classify(read_table(spark, sf_dir, "documents"), category_labels(read_table(spark, sf_dir, "labels")))
