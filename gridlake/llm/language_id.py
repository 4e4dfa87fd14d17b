"""Languages of texts and of their parts.

A word is a run of letters of one script, of at most 64 letters: longer runs, as in scripts without blanks, and runs that
change their script are cut into several, which all count. Each word has a score for each language: the log probability of its letters in threes and of the word as a whole, under
counts learnt from labelled documents. The script of a word, found by ranges of code points, narrows the languages to those that were
seen in that script. A Viterbi path over the words, with a penalty for each change of language, labels spans; the language
that covers most letters is the document's.

Most texts are in one language throughout. A constant path is the best one if no run of words gains more than half of the
penalty by going over to any one other language, which sums over all runs at once show: m changes leave at most m + 1 runs
in other languages, so they gain at most (m + 1) / 2 penalties and cost m. Only other texts need the path itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import small_batches, with_type
from gridlake.workspace import materialise

SAMPLE_DOCS, SAMPLE_CHARS = 1_000, 5_000  # the model is fitted on so many documents of each language, and on so much of each
PENALTY = 12.0
UNKNOWN = "und"

# Ranges of code points by script, as in the Unicode standard. Letters outside of them are "other".
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
LONGEST = 64  # letters that are scored at once
_RUN = re.compile(r"[^\W\d_]+")
# Letters of one script, at most LONGEST at a time: each script, then those outside of all ranges.
_IN_SCRIPT = {name: "".join(f"{chr(low)}-{chr(high)}" for own, low, high in SCRIPTS if own == name) for name, _, _ in SCRIPTS}
_LETTER = r"[^\W\d_]"
_WORD = re.compile(
    "|".join(rf"(?:(?=[{own}]){_LETTER}){{1,{LONGEST}}}" for own in _IN_SCRIPT.values())
    + rf"|(?:(?![{''.join(_IN_SCRIPT.values())}]){_LETTER}){{1,{LONGEST}}}"
)
# Number signs (halves, superscripts, Roman numerals) that a regular expression takes for letters. Those of the first
# plane and those beyond it are apart: a set of the former is one table, the latter are hardly ever met.
_SIGNS = [c for c in map(chr, range(128, 0x110000)) if c.isnumeric() and not c.isalpha() and not c.isdecimal()]
_NUMBERS, _FAR_NUMBERS = (re.compile(f"[{''.join(c for c in _SIGNS if (c > '\uffff') == far)}]") for far in (False, True))
_FAR = re.compile("[\U00010000-\U0010ffff]")
RESULT = "lang string, score double, spans array<struct<begin: int, end: int, lang: string>>"


def script_of(word: str) -> str:
    """Script of the first letter; words are in one script throughout."""
    at = ord(word[0])
    return next((name for name, low, high in SCRIPTS if low <= at <= high), "other")


_ONE_SCRIPT = {name: re.compile(f"[{own}]+") for name, own in _IN_SCRIPT.items()}


def without_numbers(text: str) -> str:
    """The text with a blank for each number sign."""
    if text.isascii():
        return text
    text = _NUMBERS.sub(" ", text)
    return _FAR_NUMBERS.sub(" ", text) if _FAR.search(text) else text


def split_run(run: str) -> list[str]:
    """A run of letters, cut where the script changes and after every `LONGEST` letters."""
    if len(run) <= LONGEST and (run.isascii() or (one := _ONE_SCRIPT.get(script_of(run))) and one.fullmatch(run)):
        return [run]
    return _WORD.findall(run)


def words_of(text: str) -> list[str]:
    """All letters of a text, which has no number signs any more, in pieces of one script."""
    runs = _RUN.findall(text)
    if text.isascii() and max(map(len, runs), default=0) <= LONGEST:
        return runs
    cut = {run: split_run(run) for run in set(runs)}
    if all(len(pieces) == 1 for pieces in cut.values()):
        return runs
    return [piece for run in runs for piece in cut[run]]


def grams(word: str) -> list[str]:
    padded = f"^{word.lower()}$"
    return [padded, *[padded[i : i + 3] for i in range(len(padded) - 2)]]


@dataclass
class Model:
    """Languages in order, the row of each gram in the table of scores (its last row: unseen), the languages of a script."""

    languages: list[str] = field(default_factory=list)
    scores: dict[str, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((1, 0)))
    scripts: dict[str, np.ndarray] = field(default_factory=dict)

    def words(self, words: list[str]) -> np.ndarray:
        """Log scores of words for each language; languages that a word's script rules out are far behind."""
        at, missing = self.scores, len(self.table) - 1
        places, counts = [], []
        for word in words:
            own = [at.get(g, missing) for g in grams(word)]
            places += own
            counts.append(len(own))
        n = np.array(counts)
        total = np.add.reduceat(self.table[places], np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None]
        total = np.clip(total - total.max(axis=1, keepdims=True), -8.0, 0.0)
        kinds = [script_of(word) for word in words]
        for script in set(kinds):
            allowed = self.scripts.get(script)
            if allowed is not None and not allowed.all():
                rows = np.array([kind == script for kind in kinds])
                total[np.ix_(rows, ~allowed)] = -40.0
        return total


def sample(docs: DataFrame, most: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(lang, text) that a model is fitted on: per language, a bounded number of documents in the order of a hash.

    All languages take part. Of a longer document a window of `chars` characters, drawn by the hash, enters. Rows whose
    crc32(doc_id) mod 5 is 0 are held out. The share of each language that is looked at follows from its count, so no
    language, however frequent, is gathered in one place.
    """
    text, lang = with_type(docs, "text", "string"), with_type(docs, "lang", "string")
    doc_id = with_type(docs, "doc_id", "long")
    known = docs.filter(lang.isNotNull() & text.isNotNull() & doc_id.isNotNull() & ~held_out(docs)).select(lang.alias("lang"), F.xxhash64(text, doc_id).alias("h"), text.alias("text"))
    # A fifth more than wanted, so that chance doesn't leave too few.
    counts = materialise(known.groupBy("lang").agg((1.2 * most / F.count("*")).alias("share")), "languages")
    picked = known.join(counts, "lang").filter(F.pmod("h", F.lit(1_000_000)) < F.col("share") * 1_000_000)
    spare = F.greatest(F.char_length("text") - chars, F.lit(0))
    window = F.substring("text", F.pmod(F.xxhash64("h"), spare + 1).cast("int") + 1, F.lit(chars))
    rows = sorted((r.lang, r.h, r.text) for r in picked.select("lang", "h", window.alias("text")).collect())
    seen: Counter = Counter()
    out = []
    for lang_, _, text_ in rows:
        seen[lang_] += 1
        if seen[lang_] <= most:
            out.append((lang_, text_))
    return out


def fit(rows: list[tuple[str, str]]) -> Model:
    """Counts of grams by language, smoothed; each different word of a document counts once."""
    counts: dict[str, Counter] = {}
    scripts: dict[str, Counter] = {}
    for lang, text in rows:
        words = Counter(words_of(without_numbers(text).lower()))
        own, by_script = counts.setdefault(lang, Counter()), scripts.setdefault(lang, Counter())
        for word in words:
            by_script[script_of(word)] += 1
            own.update(grams(word))
    model = Model(languages=sorted(counts))
    if not model.languages:
        return model
    totals = np.array([sum(counts[lang].values()) + 1.0 for lang in model.languages])
    names = set().union(*counts.values())
    scale = len(names) + 1.0
    # Grams that were seen less than three times tell little and count as unseen.
    kept = sorted(g for g in names if sum(counts[lang][g] for lang in model.languages) >= 3)
    n = np.array([[counts[lang][g] for lang in model.languages] for g in kept], float).reshape(len(kept), len(totals))
    seen = np.log((n + 0.5) / (totals + 0.5 * scale))
    unseen = np.full((1, len(totals)), np.log(0.5 / (totals + 0.5 * scale)).mean())
    model.scores, model.table = {g: i for i, g in enumerate(kept)}, np.concatenate([seen, unseen])
    for script in {s for by in scripts.values() for s in by}:
        share = np.array([scripts[lang][script] / max(1, sum(scripts[lang].values())) for lang in model.languages])
        model.scripts[script] = share >= min(0.01, share.max())
    return model


def best_path(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The labels with the highest sum of scores less `penalty` for each change."""
    n, k = scores.shape
    if k == 1:
        return np.zeros(n, int)
    home = int(scores.sum(axis=0).argmax())
    # The most that a run of words gains by each other language: rise of the running sum over its lowest point before.
    sums = np.cumsum(np.delete(scores, home, axis=1) - scores[:, [home]], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, k - 1)), sums]), axis=0)[:-1]
    if (sums - low).max() <= penalty / 2:
        return np.full(n, home)
    back, best, any_best = np.empty((n, k), np.int32), scores[0].copy(), np.arange(k)
    back[0] = any_best
    for t in range(1, n):
        top = int(best.argmax())
        change = best < best[top] - penalty
        back[t] = np.where(change, top, any_best)
        best = np.where(change, best[top] - penalty, best) + scores[t]
    path, at = np.empty(n, int), int(best.argmax())
    for t in range(n - 1, -1, -1):
        path[t] = at
        at = int(back[t, at])
    return path


class Labeler:
    """Applies a model to texts; what it remembers of words is bounded."""

    def __init__(self, model: Model, penalty: float = PENALTY, most: int = 300_000):
        self.model, self.penalty, self.most, self.at, self.known = model, penalty, most, {}, np.zeros((0, 1))

    def label(self, texts: list[str]) -> pd.DataFrame:
        if len(self.at) > self.most:
            self.at, self.known = {}, np.zeros((0, 1))
        at, places, sizes, new = self.at, [], [], []
        texts = [without_numbers(text) for text in texts]
        for text in texts:
            words = words_of(text)
            for word in set(words).difference(at):
                at[word] = len(at)
                new.append(word)
            places.append(np.fromiter(map(at.__getitem__, words), dtype=np.int64, count=len(words)))
            sizes.append(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        if new and self.model.languages:
            scores = self.model.words(new)
            self.known = np.concatenate([self.known, scores]) if len(self.known) else scores
        table = self.known
        rows = [self._one(text, table, place, size) for text, place, size in zip(texts, places, sizes)]
        return pd.DataFrame(rows, columns=["lang", "score", "spans"])

    def _one(self, text: str, table: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple:
        languages = self.model.languages
        if not len(place) or not languages:
            return UNKNOWN, 0.0, []
        scores = table[place]
        path = best_path(scores, self.penalty)
        letters = np.bincount(path, size, len(languages))
        lang = int(letters.argmax())
        # Share of its letters, times how sure the words in it are on average.
        own = scores[path == lang].mean(axis=0)
        sure = 1 / np.exp(np.clip(own - own[lang], -40, 0) * math.sqrt(min(len(place), 25))).sum()
        score = float(letters[lang] / letters.sum() * sure)
        return languages[lang], min(1.0, max(0.0, score)), self._spans(text, path)

    def _spans(self, text: str, path: np.ndarray) -> list[dict]:
        """Runs of words in one language as offsets in code points."""
        change = np.flatnonzero(np.diff(path)) + 1
        first = np.concatenate([[0], change])
        last = np.concatenate([change, [len(path)]]) - 1
        if len(first) == 1:
            found = _RUN.search(text)
            stop = len(text)
            while stop and not text[stop - 1].isalpha():
                stop -= 1
            return [{"begin": found.start(), "end": stop, "lang": self.model.languages[path[0]]}]
        spans = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        return [{"begin": spans[a][0], "end": spans[b][1], "lang": self.model.languages[path[a]]} for a, b in zip(first, last)]


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """The rows of `docs` with `language`: lang, score (0 to 1) and spans (code points, one for each run of a language).

    Every whole text is read. A text that is null or has no letter is `und` with score 0 and no spans; so is every text
    if the model has no language. A column of `docs` called language is replaced. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeler = Labeler(model, penalty)
        for texts in batches:
            yield labeler.label(texts.fillna("").tolist())

    return docs.withColumn("language", label.asNondeterministic()(with_type(docs, "text", "string")))


def trained(docs: DataFrame) -> Model:
    return fit(sample(docs))


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(F.crc32(with_type(docs, "doc_id", "long").cast("string").cast("binary")) % 5 == 0, F.lit(False))
