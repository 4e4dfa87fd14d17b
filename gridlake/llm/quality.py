"""Quality scores by votes of the nearest labelled documents in a latent-semantic space.

A text is a bag of hashed terms of three kinds: its words, the shapes of its words (letter case, digits and signs, without
their lengths), and marks for words that repeat the one before and words that don't. Terms weigh by log frequency and
inverse document frequency, each kind brought to a fixed length; a truncated singular value decomposition of the labelled
sample gives the latent axes. The vectors of the labelled documents, a bounded number, go to every task. There each
document is compared with all of them by exact cosine, a block of documents at a time, and its nearest neighbours vote with
the power `SHARPNESS` of their similarity; neighbours as near as the last one vote as well, so ties don't matter.

Both labels are drawn up to a bound, so votes are weighted back to the shares that the labels have in the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import small_batches, with_type

# The model is fitted on at most so many documents of each label, whole texts.
SAMPLE = 1_500
AXES = 48
NEIGHBOURS = 25
SHARPNESS = 4
THRESHOLD = 0.3

# Number of hashed terms of each kind, and the length that its part of a vector gets.
KINDS = ((1_024, 0.5), (512, 1.0), (2, 1.0))
TERMS = sum(n for n, _ in KINDS)

_RUNS = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """Capitals as A, other letters as a, digits as 0; equal neighbours as one."""
    return _RUNS.sub(r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))


class Terms:
    """Counts the hashed terms of texts; what it remembers of words is bounded."""

    def __init__(self, most: int = 300_000):
        self.most, self.at, self.places = most, {}, []

    def counts(self, texts: list[str]) -> np.ndarray:
        """How often each term occurs in each text: one row for each text."""
        if len(self.at) > self.most:
            self.at, self.places = {}, []
        out = np.zeros((len(texts), TERMS), np.float32)
        for i, text in enumerate(texts):
            words = text.split()
            for word in set(words).difference(self.at):
                self.at[word] = len(self.places)
                self.places.append((_slot(word.lower(), KINDS[0][0]), KINDS[0][0] + _slot(shape(word), KINDS[1][0])))
            if words:
                own = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
                again = int((own[1:] == own[:-1]).sum())
                numbers, n = np.unique(own, return_counts=True)
                places = np.array([self.places[j] for j in numbers.tolist()])
                out[i] = np.bincount(places.ravel(), np.repeat(n, 2), TERMS)
                out[i, -2:] = again, len(words) - again
        return out


def _slot(text: str, n: int) -> int:
    return xxhash.xxh3_64_intdigest(text) % n


@dataclass
class Model:
    """Weights of terms, latent axes, and the labelled vectors with their labels and the weights of their votes."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    share: float = 0.5  # the score of a text without a word

    def latent(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors of texts; zero for one without a word."""
        return _unit(_weighted(counts, self.idf) @ self.axes)

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the votes of the nearest labelled texts."""
        if not len(self.labels):
            return np.full(len(counts), self.share)
        near = self.latent(counts) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        last = np.partition(near, -k, axis=1)[:, -k]
        power = np.where(near >= last[:, None] - 1e-6, np.clip(near, 0, 1), 0) ** SHARPNESS * self.votes
        total = power.sum(axis=1)
        return np.where(total > 0, np.minimum(1, power @ self.labels / np.where(total > 0, total, 1)), self.share)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out, begin = np.log1p(counts) * idf, 0
    for n, length in KINDS:
        out[:, begin : begin + n] = _unit(out[:, begin : begin + n]) * length
        begin += n
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def fit(counts: np.ndarray, labels: np.ndarray, share: float) -> Model:
    """A model from the term counts and labels (0, 1) of a sample; `share` is that of label 1 in the corpus."""
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
    x = _weighted(counts, idf)
    values, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, : min(AXES, int((values > 1e-9).sum()))]
    part = labels.mean() if len(labels) else 0.0
    votes = np.where(labels == 1, share / part if part else 0, (1 - share) / (1 - part) if part < 1 else 0)
    model = Model(idf.astype(np.float32), axes.astype(np.float32), np.zeros((0, 0), np.float32), labels.astype(float), votes, share)
    model.vectors = model.latent(counts)
    return model


def sample(docs: DataFrame, labels: DataFrame, column: str = "quality", most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Term counts and labels of different texts, at most `most` of each label in the order of a hash, and the share of label 1.

    Rows whose crc32(doc_id) mod 5 is 0 are held out. A doc_id with both labels counts as label 0.
    """
    doc_id, text = with_type(docs, "doc_id", "long"), with_type(docs, "text", "string")
    known = (
        labels.select(with_type(labels, "doc_id", "long").alias("doc_id"), with_type(labels, column, "int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    share = known.agg(F.avg("y")).first()[0]
    hashed = docs.filter(text.isNotNull()).select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    one = hashed.drop("text").join(known, "doc_id").groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.min("y").alias("y"))
    picked = [row for y in (0, 1) for row in one.filter(F.col("y") == y).orderBy("h").limit(most).collect()]
    if not picked:
        return np.zeros((0, TERMS), np.float32), np.zeros(0, int), 0.5
    # At most 2 * most short rows, whatever the size of the corpus; the terms are counted where the texts are.
    chosen = docs.sparkSession.createDataFrame([tuple(r) for r in picked], "h long, doc_id long, y int")
    found = hashed.join(F.broadcast(chosen), ["doc_id", "h"]).select("h", "y", "text").mapInPandas(_counted, "h long, y int, n binary")
    rows = found.groupBy("h").agg(F.min("y").alias("y"), F.min("n").alias("n")).orderBy("h").toLocalIterator()
    kept = [(np.frombuffer(row.n, np.float32), row.y) for row in rows]
    return np.array([n for n, _ in kept]), np.array([y for _, y in kept]), share


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    terms = Terms()
    for batch in batches:
        yield pd.DataFrame({"h": batch["h"], "y": batch["y"], "n": [row.tobytes() for row in terms.counts(batch["text"].tolist())]})


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` with `quality_score`: 0 to 1, higher where label 1 is likelier.

    Every whole text is scored. Null and empty texts, and texts without a word, get the share of label 1 in the corpus; so
    does every text if nothing is labelled (then 0.5). If only one label is known all texts get it. Equal texts get equal
    scores. A column of `docs` called quality_score is replaced. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms()
        for texts in batches:
            yield pd.Series(model.scores(terms.counts(texts.fillna("").tolist())))

    # Not to be repeated by a filter on the result.
    return docs.withColumn("quality_score", vote.asNondeterministic()(with_type(docs, "text", "string")))


def trained(docs: DataFrame, labels: DataFrame, column: str = "quality") -> Model:
    return fit(*sample(docs, labels, column))


def _held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(_held_out(with_type(docs, "doc_id", "long")), F.lit(False))
