"""Toxic spans by a linear-chain conditional random field.

Words are tagged toxic or not. The score of a word is the sum of the weights of its features (the word, and its first three
to eight letters); transitions between the two tags have weights of their own. Forward-backward marginals give
each word a probability; they aggregate to a document score (a logistic curve over the expected number of toxic words and
the three surest different words) and to the offsets of the offending spans.

Labels are given for documents, so the labelled words are made first, from the sample that the model is fitted on: in a
toxic document a word is toxic if one of its features occurs significantly more often in toxic documents. Occurrences are
counted by their different neighbours, so that copies of a document count once.

A chain of two tags is a chain of fractional linear maps of the odds. They are composed in blocks, for all documents of a
batch at a time, which gives exact marginals without a loop over words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import small_batches, with_type

# What the model is fitted on: so many documents of each label, none longer than that.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1_200, 1_500, 8_000
THRESHOLD = 0.3
SPAN_PROBABILITY = 0.5
LEAST_NEIGHBOURS = 5
FAINT = 0.1  # lower probabilities don't add up to a toxic word, however long the text
ROUNDS = 40

_WORD = re.compile(r"\w+")
RESULT = "score double, expected double, spans array<struct<begin: int, end: int, probability: double>>"


def features(word: str) -> list[str]:
    word = word.lower()
    return ["=" + word, *["<" + word[:n] for n in range(3, 9) if len(word) >= n]]


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, width: int = 64) -> np.ndarray:
    """x[t] = (a[t] x[t-1] + b[t]) / (c[t] x[t-1] + d[t]), x[-1] = 1, for positive coefficients."""
    n = len(a)
    rows = -(-n // width)
    pad = rows * width - n
    a, b, c, d = (np.concatenate([v, np.full(pad, p)]).reshape(rows, width).T.copy() for v, p in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    # The map of each row as a whole, then the value that each row begins with.
    p, q, r, s = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(width):
        p, q, r, s = a[t] * p + b[t] * r, a[t] * q + b[t] * s, c[t] * p + d[t] * r, c[t] * q + d[t] * s
        scale = 1 / (p + q + r + s)
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    first, x = np.empty(rows), 1.0
    for i, (pi, qi, ri, si) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        first[i] = x
        x = (pi * x + qi) / (ri * x + si)
    out = np.empty((width, rows))
    x = first
    for t in range(width):
        x = (a[t] * x + b[t]) / (c[t] * x + d[t])
        out[t] = x
    return out.T.reshape(-1)[:n]


@dataclass
class Model:
    """Feature weights, transition weights (start to toxic, into, out of, within) and the document curve."""

    weights: dict[str, float] = field(default_factory=dict)
    start: float = -9.0
    into: float = -9.0
    out: float = 0.0
    stay: float = -9.0
    curve: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0, 0.0)

    def emission(self, word: str) -> float:
        weights = self.weights
        return min(20.0, max(-20.0, sum(weights.get(f, 0.0) for f in features(word))))

    def marginals(self, emissions: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Probability of the toxic tag at each word; `begins` marks the first word of each document."""
        x, y = self.odds(np.exp(emissions), begins)
        return 1 - 1 / (1 + x * y)

    def odds(self, e: np.ndarray, begins: np.ndarray, most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
        """Odds of the toxic tag from the words up to each one and from those after it, some documents at a time."""
        parts = [self._odds(e[a:b], begins[a:b]) for a, b in _lots(begins, most)]
        return np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts])

    def _odds(self, e: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        into, out, stay, start = math.exp(self.into), math.exp(self.out), math.exp(self.stay), math.exp(self.start)
        one = np.ones(len(e))
        x = _scan(np.where(begins, 0.0, e * stay), np.where(begins, e * start, e * into), np.where(begins, 0.0, out), one)
        last = np.append(begins[1:], True)[::-1]
        after = np.append(e[1:], 1.0)[::-1]
        y = _scan(np.where(last, 0.0, stay * after), np.where(last, 1.0, out), np.where(last, 0.0, into * after), one)[::-1]
        return x, y

    def score(self, expected: np.ndarray, surest: np.ndarray) -> np.ndarray:
        """From the expected number of toxic words and the probabilities of the three surest different words."""
        return 1 / (1 + np.exp(-np.clip(_inputs(expected, surest) @ np.array(self.curve), -30, 30)))


def _lots(begins: np.ndarray, most: int = 100_000) -> list[tuple[int, int]]:
    """Ranges of whole documents of about so many words."""
    starts = np.flatnonzero(begins)
    cuts = sorted({0, len(begins), *starts[np.searchsorted(starts, np.arange(most, int(starts[-1]) + 1, most))].tolist()})
    return list(zip(cuts, cuts[1:]))


def _inputs(expected: np.ndarray, surest: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(expected)), np.log1p(expected), surest])


def _surest(p: np.ndarray, words: np.ndarray, n: int = 3) -> list[float]:
    """The highest probabilities of different words."""
    best: dict[int, float] = {}
    at = np.flatnonzero(p >= 0.02)
    for w, x in zip(words[at].tolist(), p[at].tolist()):
        best[w] = max(x, best.get(w, 0.0))
    return (sorted(best.values(), reverse=True) + [0.0] * n)[:n]


def sample(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN, chars: int = SAMPLE_CHARS):
    """Texts and labels that a model is fitted on: distinct texts in the order of a hash, a bounded number of each label.

    Rows whose crc32(doc_id) mod 4 is 2 are held out. Returns a frame (text, toxic) and the share of toxic documents.
    """
    doc_id = with_type(docs, "doc_id", "long")
    text = with_type(docs, "text", "string")
    known = (
        labels.select(with_type(labels, "doc_id", "long").alias("doc_id"), with_type(labels, "toxic", "int").alias("toxic"))
        .filter("toxic in (0, 1) and doc_id is not null and crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    narrow = docs.filter(text.isNotNull() & (F.char_length(text) <= chars)).select(doc_id.alias("doc_id"), F.xxhash64(F.lower(text)).alias("h"))
    one = narrow.join(known, "doc_id").groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    parts = [one.filter(F.col("toxic") == y).orderBy("h").limit(n) for y, n in ((1, toxic), (0, clean))]
    picked = parts[0].unionByName(parts[1]).collect()
    share = known.agg(F.avg("toxic")).first()[0]
    if not picked:
        return pd.DataFrame({"text": [], "toxic": []}), 0.0
    by_id = {row.doc_id: row.toxic for row in picked}
    # At most toxic + clean short rows, whatever the size of the corpus.
    ids = docs.sparkSession.createDataFrame([(i,) for i in by_id], "doc_id long")
    found = docs.filter(F.char_length(text) <= chars).select(doc_id.alias("doc_id"), text.alias("text")).join(F.broadcast(ids), "doc_id")
    rows = sorted((r.doc_id, r.text) for r in found.toLocalIterator() if r.text is not None)
    frame = pd.DataFrame({"text": [t for _, t in rows], "toxic": [by_id[i] for i, _ in rows]})
    return frame.drop_duplicates("text", ignore_index=True), share


def fit(frame: pd.DataFrame, share: float, rounds: int = ROUNDS) -> Model:
    """A model from texts with labels; without both labels, one that calls nothing toxic."""
    labels = frame["toxic"].to_numpy(int)
    if not len(labels) or labels.min() == labels.max():
        return Model()
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in _WORD.findall(text.lower())], np.int32) for text in frame["text"]]
    n_words = len(vocabulary)
    word_of, feature_of, names = _index(list(vocabulary))
    del vocabulary
    words = np.concatenate(docs)
    doc_of = np.repeat(np.arange(len(docs), dtype=np.int32), [len(doc) for doc in docs])
    if not len(words):
        return Model()
    begins = np.append(True, doc_of[1:] != doc_of[:-1])
    toxic_words, seen_with = _toxic_words(words, doc_of, begins, labels, word_of, feature_of, n_words, len(names))
    # A feature with few different neighbours would only learn its document by heart.
    common = seen_with >= LEAST_NEIGHBOURS
    word_of, feature_of = word_of[common[feature_of]], feature_of[common[feature_of]]
    target = (toxic_words[words] & (labels[doc_of] == 1)).astype(np.float32)

    # Gradient ascent with a step of its own for each weight.
    model, weights, trans = Model(), np.zeros(len(names)), np.array([-3.0, -3.0, 0.0, 0.0])
    seen, seen_trans = np.full(len(names), 1e-6), np.full(4, 1e-6)
    lots = _lots(begins)
    for _ in range(rounds):
        model.start, model.into, model.out, model.stay = trans
        odds = np.exp(np.clip(np.bincount(word_of, weights[feature_of], n_words), -20, 20))
        gap, step_trans = np.zeros(n_words), -0.02 * trans
        for first, end in lots:
            own, at = words[first:end], begins[first:end]
            more, moved = _slope(model, odds[own], target[first:end], at)
            gap += np.bincount(own, more, n_words)
            step_trans += moved
        step = np.bincount(feature_of, gap[word_of], len(names)) - 0.02 * weights
        seen += step**2
        seen_trans += step_trans**2
        weights += 0.8 * step / np.sqrt(seen)
        trans += 0.3 * step_trans / np.sqrt(seen_trans)
    model.start, model.into, model.out, model.stay = map(float, trans)
    model.weights = {names[i]: round(float(weights[i]), 4) for i in np.flatnonzero(np.abs(weights) >= 0.05)}
    e = np.bincount(word_of, weights[feature_of], n_words)[words]
    p = model.marginals(np.clip(e, -20, 20), begins)
    expected = np.bincount(doc_of, np.where(p >= FAINT, p, 0), len(docs))
    ends = np.cumsum([len(doc) for doc in docs])
    surest = np.array([_surest(p[end - len(doc) : end], words[end - len(doc) : end]) for doc, end in zip(docs, ends)])
    model.curve = _curve(_inputs(expected, surest), labels, share)
    return model


def _slope(model: Model, e: np.ndarray, target: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels less marginals of each word, and the same for the transitions (start, into, out, within)."""
    x, y = model.odds(e, begins)
    gap = target - 1 + 1 / (1 + x * y)
    inner = ~begins[1:]
    was, now = target[:-1][inner], target[1:][inner]
    # Expected transitions, unnormalised: from the odds before and after.
    before, after = x[:-1][inner], (e * y)[1:][inner]
    into, out, stay = np.exp(model.into) * after, np.exp(model.out) * before, np.exp(model.stay) * before * after
    total = 1 + into + out + stay
    moved = [gap[begins].sum(), ((1 - was) * now - into / total).sum(), (was * (1 - now) - out / total).sum(), (was * now - stay / total).sum()]
    return gap, np.array(moved)


class Names:
    """The names of features by their number, kept in parts."""

    def __init__(self, parts: list[np.ndarray]):
        self.parts, self.starts = parts, np.cumsum([0, *map(len, parts)])

    def __len__(self) -> int:
        return int(self.starts[-1])

    def __getitem__(self, i: int) -> str:
        part = int(np.searchsorted(self.starts, i, side="right")) - 1
        return str(self.parts[part][i - self.starts[part]])


def _index(words: list[str]) -> tuple[np.ndarray, np.ndarray, Names]:
    """The features of all words as pairs of numbers (word, feature), and the names of the features.

    Built from arrays of equal-sized texts: a table of text objects would take several times the memory.
    """
    heads, length = np.array(words, dtype="U8"), np.array([len(w) for w in words])
    word_of, feature_of = [np.arange(len(words), dtype=np.int32)], [np.arange(len(words), dtype=np.int32)]
    names, used = [np.array(["=" + w for w in words], dtype=object)], len(words)
    for n in range(3, 9):
        rows = np.flatnonzero(length >= n).astype(np.int32)
        found, which = np.unique(heads[rows].astype(f"U{n}"), return_inverse=True)
        word_of.append(rows)
        feature_of.append((used + which).astype(np.int32))
        names.append(np.char.add("<", found) if len(found) else np.array([], dtype="U9"))
        used += len(found)

    return np.concatenate(word_of), np.concatenate(feature_of), Names(names)


def _toxic_words(words, doc_of, begins, labels, word_of, feature_of, n_words, n_features) -> tuple[np.ndarray, np.ndarray]:
    """Which words of the vocabulary have a feature that marks toxic documents; how many neighbours each feature has."""
    before = np.append(0, words[:-1] + 1).astype(np.int64)
    before[begins] = 0
    # Different (label, word, word before it), each as one number.
    pairs = np.unique((labels[doc_of].astype(np.int64) * n_words + words) * (n_words + 1) + before) // (n_words + 1)
    n = len(np.unique(words))
    seen = [np.bincount(pairs[pairs // n_words == y] % n_words, minlength=n_words) for y in (0, 1)]
    clean, bad = (np.bincount(feature_of, s[word_of], n_features) for s in seen)
    rate = seen[1].sum() / max(1, seen[0].sum() + seen[1].sum())
    total = clean + bad
    share = bad / np.maximum(total, 1)

    def part(count, p, q):
        return np.where(count > 0, count * np.log(np.maximum(p, 1e-12) / q), 0)

    evidence = 2 * (part(bad, share, rate) + part(clean, 1 - share, 1 - rate))
    marks = (share >= 0.9) & (evidence >= 2 * math.log(max(n, 2) / 0.05))
    found = np.zeros(n_words, bool)
    found[word_of[marks[feature_of]]] = True
    # A toxic document in which nothing is marked: its most telling word is, if it is telling at all.
    best = np.zeros(len(found))
    np.maximum.at(best, word_of, np.where((share >= 0.9) & (bad >= 3), evidence, 0)[feature_of])
    marked = np.bincount(doc_of, found[words], len(labels)) > 0
    for doc in np.flatnonzero((labels == 1) & ~marked):
        own = words[doc_of == doc]
        if len(own) and best[own].max() > 6:
            found[own[np.argmax(best[own])]] = True
    return found, total


def _curve(x: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, ...]:
    """Logistic curve by Newton steps; the labels are weighted to the share that the corpus has."""
    share = min(max(share, 0.01), 0.99)
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    theta, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (labels - p)) - ridge @ theta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        theta = theta + np.linalg.solve(bend, slope)
    return tuple(float(t) for t in theta)


class Tagger:
    """Applies a model to texts; what it remembers of words is bounded."""

    def __init__(self, model: Model, most: int = 300_000):
        self.model, self.most, self.at, self.known = model, most, {}, []

    def tag(self, texts: list[str]) -> pd.DataFrame:
        if len(self.at) > self.most:
            self.at, self.known = {}, []
        at, known, places = self.at, self.known, []
        for text in texts:
            words = _WORD.findall(text)
            for word in set(words).difference(at):
                at[word] = len(known)
                known.append(self.model.emission(word))
            places.append(np.fromiter(map(at.__getitem__, words), dtype=np.int64, count=len(words)))
        counts = np.array([len(p) for p in places])
        ends = np.cumsum(counts)
        p = np.zeros(0)
        if len(ends) and ends[-1]:
            begins = np.zeros(ends[-1], bool)
            begins[(ends - counts)[counts > 0]] = True
            p = self.model.marginals(np.array(known)[np.concatenate(places)], begins)
        expected, surest, spans = np.zeros(len(texts)), np.zeros((len(texts), 3)), []
        for i, (text, n, end) in enumerate(zip(texts, counts.tolist(), ends.tolist())):
            own = p[end - n : end]
            if n:
                expected[i], surest[i] = own[own >= FAINT].sum(), _surest(own, places[i])
            spans.append(_spans(text, own) if n and surest[i, 0] >= SPAN_PROBABILITY else [])
        return pd.DataFrame({"score": self.model.score(expected, surest), "expected": expected, "spans": spans})


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of toxic words, as offsets in code points."""
    out: list[dict] = []
    hits = set(np.flatnonzero(p >= SPAN_PROBABILITY).tolist())
    last = -2
    for i, match in enumerate(_WORD.finditer(text)):
        if i not in hits:
            continue
        if last == i - 1:
            out[-1] |= {"end": match.end(), "probability": max(out[-1]["probability"], float(p[i]))}
        else:
            out.append({"begin": match.start(), "end": match.end(), "probability": float(p[i])})
        last = i
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` with `toxicity`: score (0 to 1), expected number of toxic words, and spans (code points).

    Every whole text is tagged. Null and empty texts, and texts without a word, get the score of a document in which no
    word is toxic, and no spans. A column of `docs` called toxicity is replaced. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(model)
        for texts in batches:
            yield tagger.tag(texts.fillna("").tolist())

    # Not to be repeated by a filter on the result.
    return docs.withColumn("toxicity", tag.asNondeterministic()(with_type(docs, "text", "string")))


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(*sample(docs, labels))


def held_out(docs: DataFrame):
    return F.coalesce(F.crc32(with_type(docs, "doc_id", "long").cast("string").cast("binary")) % 4 == 2, F.lit(False))
