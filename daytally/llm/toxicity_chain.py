"""Toxicity by a classifier chain: linear models for one category after another.

Categories are made of the labels (CATEGORIES); each model sees the words of a document and the
log-odds of all earlier categories. For training, those come out of fold: the training documents
are dealt into FOLDS parts, and a document's probabilities are those of models that didn't see its
part. The last category decides.

Everything that is fitted comes from a bounded sample of labelled documents (labelled.SAMPLE_ROWS):
the words most associated with the last category (counted by Spark; at most WORDS, at least
SURPRISE standard deviations off their expected count), and the models, fitted with numpy. Scoring reads every whole text; the broadcast is WORDS words and as many weights for
each category, whatever the size of the corpus.

Defined cases: a null text counts as empty and has probabilities; repeated rows are scored each; a
category without examples of both kinds gives its smoothed share; without labels nothing is toxic;
an empty table gives no rows; filtering keeps all columns of the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm import labelled
from daytally.llm.common import blocks, ids_back, python_docs, stored

#: Category names and how labels make them, in chain order; null labels leave a document out of a category.
CATEGORIES = (
    ("toxic_junk", "cast(toxic = 1 and quality = 0 as int)"),
    ("toxic_prose", "cast(toxic = 1 and quality = 1 as int)"),
    ("toxic", "cast(toxic = 1 as int)"),
)
WORDS, LEAST_DOCUMENTS, SURPRISE, FOLDS, STEPS, PENALTY, DECISION = 4096, 3, 4.0, 4, 300, 2e-5, 0.5
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


@dataclass
class Linear:
    """Weights of words, then of earlier categories' log-odds; and the intercept."""

    words: np.ndarray
    earlier: np.ndarray
    intercept: float


@dataclass
class Chain:
    vocabulary: dict[str, int]
    models: list[Linear] = field(default_factory=list)

    def found(self, text: str) -> list[int]:
        known = self.vocabulary
        return sorted(known[word] for word in words_of(text) if word in known)

    def log_odds(self, rows: list[list[int]]) -> np.ndarray:
        """One column for each category."""
        flat, owner = flattened(rows)
        out = np.zeros((len(rows), len(self.models)))
        for at, model in enumerate(self.models):
            out[:, at] = np.bincount(owner, model.words[flat], len(rows)) + out[:, :at] @ model.earlier + model.intercept
        return out


def flattened(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = [len(row) for row in rows]
    flat = np.fromiter((i for row in rows for i in row), np.int64, sum(counts))
    return flat, np.repeat(np.arange(len(rows)), counts)


def probability(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))


def fit_linear(rows: list[list[int]], earlier: np.ndarray, target: np.ndarray, words: int) -> Linear:
    """Logistic regression with a quadratic penalty by accelerated gradient steps with per-weight scaling."""
    share = (target.sum() + 0.5) / (len(target) + 1.0)
    start = float(np.log(share / (1 - share)))
    if not len(target) or target.min() == target.max():
        return Linear(np.zeros(words), np.zeros(earlier.shape[1]), start)
    flat, owner = flattened(rows)
    more = np.clip(earlier, -8, 8)
    weights = np.zeros(words + more.shape[1] + 1)
    weights[-1] = start
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        odds = np.bincount(owner, weights[flat], len(rows)) + more @ weights[words:-1] + weights[-1]
        error = (probability(odds) - target) / len(target)
        slope = np.concatenate([np.bincount(flat, error[owner], words), more.T @ error, [error.sum()]])
        slope[:-1] += PENALTY * weights[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        rate = 0.1 * (1 - step / (STEPS + 1))
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return Linear(weights[:words], weights[words:-1], float(weights[-1]))


def fit_chain(vocabulary: dict[str, int], rows: list[list[int]], targets: np.ndarray, fold: np.ndarray) -> Chain:
    """One model for each column of targets (NaN: unknown), fed with out-of-fold log-odds of earlier columns."""
    chain, size = Chain(vocabulary), len(vocabulary)
    earlier = np.zeros((len(rows), 0))
    for target in targets.T:
        known = ~np.isnan(target)
        fit = lambda own, t=target, e=earlier: fit_linear([rows[i] for i in own], e[own], t[own], size)
        unseen = np.zeros(len(rows))
        for part in range(FOLDS):
            model = fit(np.flatnonzero(known & (fold != part)))
            own = np.flatnonzero(fold == part)
            flat, owner = flattened([rows[i] for i in own])
            unseen[own] = np.bincount(owner, model.words[flat], len(own)) + np.clip(earlier[own], -8, 8) @ model.earlier + model.intercept
        chain.models.append(fit(np.flatnonzero(known)))
        earlier = np.hstack([earlier, unseen[:, None]])
    return chain


def vocabulary_of(examples: DataFrame, size: int = WORDS) -> dict[str, int]:
    """The words most associated with the last category, by a signed chi-square with one document of doubt."""
    kinds = "word string, hit int"

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in blocks(frames):
            found = [(w, int(hit)) for text, hit in zip(frame["text"], frame["hit"], strict=True) for w in words_of(text)]
            yield pd.DataFrame(found, columns=["word", "hit"])

    examples = examples.withColumn("hit", F.expr(CATEGORIES[-1][1])).where("hit is not null").select("text", "hit")
    whole = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits")).first()
    share = (whole.hits + 0.5) / (whole.n + 1.0)
    counts = examples.mapInPandas(words, kinds).groupBy("word").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"))
    surprise = (F.col("hits") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1.0)
    best = counts.where((F.col("n") >= LEAST_DOCUMENTS) & (F.abs(surprise) >= SURPRISE)).orderBy(F.abs(surprise).desc(), "word").limit(size)
    return {row.word: i for i, row in enumerate(best.select("word").collect())}  # at most ``size`` rows


def trained(docs: DataFrame, labels: DataFrame, held_out: int = 0, rows: int = labelled.SAMPLE_ROWS) -> Chain:
    """A chain from at most ``rows`` labelled documents outside the held-out fold."""
    chosen = labelled.sample(labels, ["toxic", "quality"], held_out, rows).where("toxic is not null")
    examples = stored(python_docs(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]))
    chain = Chain(vocabulary_of(examples))

    def indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in blocks(frames):
            targets = frame[[name for name, _ in CATEGORIES]].astype(float)
            yield targets.assign(doc_id=frame["doc_id"], found=[chain.found(text) for text in frame["text"]])

    made = examples.select("doc_id", "text", *[F.expr(rule).cast("double").alias(name) for name, rule in CATEGORIES])
    kinds = ", ".join(f"{name} double" for name, _ in CATEGORIES) + ", doc_id long, found array<int>"
    known = made.mapInPandas(indexed, kinds).orderBy("doc_id").collect()  # at most ``rows`` rows
    targets = np.array([[np.nan if row[name] is None else row[name] for name, _ in CATEGORIES] for row in known], float)
    fold = np.arange(len(known)) % FOLDS
    return fit_chain(chain.vocabulary, [row.found for row in known], targets.reshape(-1, len(CATEGORIES)), fold)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the probability of each category (p_<name>) and toxic (boolean) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels))
    names = [f"p_{name}" for name, _ in CATEGORIES]

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chain = shared.value
        for frame in blocks(frames):
            found = probability(chain.log_odds([chain.found(text) for text in frame["text"]]))
            out = pd.DataFrame(found, columns=names)
            yield out.assign(doc_id=frame["doc_id"].to_numpy(), toxic=found[:, -1] >= DECISION)

    kinds = "doc_id long, " + ", ".join(f"{name} double" for name in names) + ", toxic boolean"
    return ids_back(python_docs(docs).mapInPandas(score, kinds))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the documents that the chain calls toxic; all columns stay as they are.

    Texts are decided one by one, so rows that share a doc_id but not a text may part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels))

    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        chain = shared.value
        return pd.Series(probability(chain.log_odds([chain.found(text) for text in texts]))[:, -1] >= DECISION)

    return docs.where(~toxic(F.coalesce("text", F.lit(""))))
