"""Toxicity categories by a classifier chain.

The categories are predicted in order. Each has a linear (logistic) model over the words of a text and a few figures of
its form; from the second on, the probabilities of the earlier categories are inputs too, as log odds. In training these come from
out-of-fold predictions: a row's earlier probabilities are those of models that did not see the row, so later models
learn how far the earlier ones can be trusted on new texts.

The models are fitted on the driver to at most ``most_rows`` labelled rows, chosen by a hash of their ids; this bound
is a parameter, and bounds what is collected and broadcast: only the ids of these rows and then their distinct words.
A word is a feature if it is in at least ``least_rows`` of them and its association with a category is significant
(chi-squared). Whole texts are scored, in time linear in their length, without any shuffle of texts.

A NULL text is scored as an empty one. Several labels of one id count as the largest. Rows with a NULL label are not
learned from. Without labelled rows, or with one class only, a category has a constant probability (of the smoothed
share). Rows are scored one by one: repeated rows get repeated results. A text is toxic from the
probability on that had the best F1 on the out-of-fold predictions. Empty tables give empty results. Columns other than id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table

_WORD = re.compile(r"[^\W\d_]+")
_FORM = 5


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def form_of(text: str | None) -> list[float]:
    """Figures of a text's form: log length, and shares of capitals, of other signs, of repeats among the words, of blanks."""
    if not text:
        return [0.0] * _FORM
    n = len(text)
    words = text.split()
    letters = len("".join(_WORD.findall(text)))
    capitals = sum(map(str.isupper, words)) / max(1, len(words))
    return [float(np.log1p(n)) / 10, capitals, 1 - letters / n, 1 - len(set(words)) / max(1, len(words)), len(words) / n]


@dataclass
class Linear:
    """Weights by word, of the form and earlier log odds (standardised), and the intercept."""

    words: dict[str, float]
    dense: np.ndarray
    bias: float


@dataclass
class Rows:
    """Sparse rows of words, as (row, column) pairs, and their dense inputs."""

    row: np.ndarray
    column: np.ndarray
    dense: np.ndarray

    def take(self, keep: np.ndarray) -> Rows:
        at = np.full(len(self.dense), -1)
        at[keep] = np.arange(len(keep))
        own = at[self.row] >= 0
        return Rows(at[self.row[own]], self.column[own], self.dense[keep])


def _logits(rows: Rows, sparse: np.ndarray, dense: np.ndarray, bias: float) -> np.ndarray:
    return bias + rows.dense @ dense + np.bincount(rows.row, sparse[rows.column], len(rows.dense))


def fit_linear(rows: Rows, y: np.ndarray, width: int, rounds: int = 120, ridge: float = 1.0, rate: float = 0.15) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression by Adam on the whole of the rows. One class only: a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    sparse, dense, bias = np.zeros(width), np.zeros(rows.dense.shape[1]), float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return sparse, dense, bias
    theta = np.concatenate([sparse, dense, [bias]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(_logits(rows, theta[:width], theta[width:-1], theta[-1]), -30, 30)))
        off = p - y
        gradient = np.concatenate([np.bincount(rows.column, off[rows.row], width), off @ rows.dense, [off.sum()]])
        gradient[:-1] += ridge * theta[:-1]
        gradient /= len(y)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:width], theta[width:-1], float(theta[-1])


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the best F1, half-way between two probabilities; one half if a class is missing."""
    if not len(y) or y.min() == y.max():
        return 0.5
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + y.sum())
    best = int(f1.argmax())
    return float((p[order[best]] + p[order[min(best + 1, len(y) - 1)]]) / 2)


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear]
    centre: np.ndarray
    scale: np.ndarray
    #: Per category the probability with the best F1 on the out-of-fold predictions.
    cuts: list[float]

    @classmethod
    def fit(cls, categories: Sequence[str], words: list[Sequence[str]], form: np.ndarray, y: np.ndarray, folds: int = 4, least_rows: int = 5, least_chi: float = 15.0) -> Chain:
        """``y`` has a column for each category; rows are dealt to folds by their order."""
        n = len(words)
        form = form.reshape(n, _FORM)
        centre, scale = (form.mean(0), form.std(0) + 1e-9) if n else (np.zeros(_FORM), np.ones(_FORM))
        ids: dict[str, int] = {}
        row = np.repeat(np.arange(n), [len(w) for w in words]) if n else np.empty(0, int)
        column = np.array([ids.setdefault(w, len(ids)) for own in words for w in own], int)
        names = list(ids)
        seen = np.bincount(column, minlength=len(names))
        models, cuts, odds = [], [], np.empty((n, 0))
        fold = np.arange(n) % folds
        for k in range(len(categories)):
            target = y[:, k].astype(float) if n else np.empty(0)
            hit = np.bincount(column, target[row], len(names)) if n else np.empty(0)
            share = target.mean() if n else 0.5
            expected = seen * share
            chi = (hit - expected) ** 2 / np.maximum(expected * (1 - share) * (1 - seen / max(1, n)), 1e-9)
            chosen = np.flatnonzero((seen >= least_rows) & (chi >= least_chi))
            at = np.full(len(names), -1)
            at[chosen] = np.arange(len(chosen))
            own = at[column] >= 0 if n else np.empty(0, bool)
            rows = Rows(row[own], at[column[own]] if n else row, np.hstack([(form - centre) / scale, odds]))
            out = np.empty(n)
            for f in range(folds):
                train, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                fitted = fit_linear(rows.take(train), target[train], len(chosen))
                out[test] = _logits(rows.take(test), *fitted)
            sparse, dense, bias = fit_linear(rows, target, len(chosen))
            models.append(Linear({names[c]: float(w) for c, w in zip(chosen, sparse, strict=True)}, dense, bias))
            p = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            cuts.append(best_cut(p, target))
            odds = np.hstack([odds, _log_odds(p)[:, None]])
        return cls(list(categories), models, centre, scale, cuts)

    def predict(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probabilities, a column for each category."""
        inputs = (np.array([form_of(t) for t in texts]).reshape(len(texts), _FORM) - self.centre) / self.scale
        sets = [words_of(t) for t in texts]
        out = np.empty((len(texts), len(self.models)))
        for k, model in enumerate(self.models):
            weights = model.words
            known = weights.keys()
            sums = np.array([sum(weights[w] for w in sorted(own & known)) for own in sets])
            logits = model.bias + inputs @ model.dense + sums if len(texts) else sums
            out[:, k] = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            inputs = np.hstack([inputs, _log_odds(out[:, k])[:, None]])
        return out


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    most_rows: int = 8_000,
) -> Chain:
    """``categories``: name and 0/1 column of ``labels``, in the order of the chain."""
    names = list(categories)
    known = labels.select(F.col(label_id).alias("id"), *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())])
    known = known.dropna().groupBy("id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))])
    drawn = known.withColumn("draw", F.xxhash64(F.lit("chain"), "id")).orderBy("draw", "id").limit(most_rows)

    def inputs(batches):
        for batch in batches:
            yield pd.DataFrame({
                "draw": batch["draw"],
                "y": batch[[f"y{i}" for i in range(len(names))]].to_numpy().tolist(),
                "form": [form_of(t) for t in batch["text"]],
                "words": [sorted(words_of(t)) for t in batch["text"]],
            })

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id")
    seen = rows.mapInPandas(inputs, "draw long, y array<int>, form array<double>, words array<string>")
    # Ids may repeat among the documents, so rows are bounded by the tasks too, before the driver gets any.
    seen = seen.withColumn("key", F.xxhash64("words", "form")).orderBy("draw", "key").limit(most_rows).drop("key")
    found = seen.toArrow().to_pylist()
    found.sort(key=lambda r: (r["draw"], r["words"], r["form"]))
    y = np.array([r["y"] for r in found]).reshape(len(found), len(names))
    return Chain.fit(names, [r["words"] for r in found], np.array([r["form"] for r in found]), y)


def score(spark: SparkSession, text: Column, chain: Chain) -> Column:
    """Probabilities of the categories as an array column."""
    shared = spark.sparkContext.broadcast(chain)

    def probabilities(texts: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.predict(list(texts))), dtype=object)

    return F.pandas_udf(probabilities, "array<double>")(text)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels table has two flags; low quality comes first, as it may tell something about toxicity."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    chain = train_chain(docs, labels, {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")})
    found = docs.select("doc_id", score(spark, F.col("text"), chain).alias("p"))
    return found.select(
        "doc_id", F.col("p")[0].alias("p_low_quality"), F.col("p")[1].alias("p_toxic"), (F.col("p")[1] >= chain.cuts[1]).alias("toxic")
    )
