"""Phrase collocations from one FM-index per shard over word ids.

The words of a shard (some documents of one language) become numbers, and pieces are kept apart by the number 0. The
shard is indexed in both directions by a Burrows-Wheeler transform whose suffixes are sorted by their first `max_words`
words only; deeper order never matters for phrases that short. A phrase is an interval of both orders. It grows by a word
to the right with the reverse transform, and to the left with the forward one, while the other interval is narrowed by the
number of smaller neighbours. All intervals of a depth grow at once, in numpy.

Indexes are built once and written to the shared workspace; counts of shards are summed by Spark. First come the words, then
for each length a survey: the phrases of a shard are counted by places of a hash, as many as four times the words of the
corpus, and the sums of all shards that reach the least count leave a bitmap of fixed size. Last, phrases are counted
themselves, where the bitmaps say that they and all their parts can be frequent; shards send them as compressed lists, one
for each range of places, and a task sums the lists of a range. A bitmap has false positives but misses
nothing. With a corpus so large that a bitmap fills up, more phrases are counted, and the result stays the same.

A phrase is dropped if a longer one that holds it occurs at least half as often. Its score compares its count with the
counts of the two parts of its weakest cut.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.llm.common import small_batches, with_type
from gridlake.llm.shingles import mix
from gridlake.workspace import materialise, scratch_path

MAX_WORDS = 3
LEAST = 10  # occurrences of a candidate
TOP = 2_000
HELD = 50  # percent of its occurrences that lie in one longer phrase: then a phrase is dropped
SHARD_WORDS = 250_000
BITS = 24  # a bitmap has 2^24 bits
PLACE_BITS = 22  # a survey counts in ranges of 2^22 places
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

INDEX = "lang string, size long, words binary, starts binary, before binary, after binary"
_SPLIT = bytes.maketrans(b"\t.,;:!?\n\x0b\x0c\r", b" " + b"\n" * 10)


def tokens(text: str) -> list[bytes]:
    """Words in order, pieces ended by a line feed; empty words may occur. Only A-Z is put in lower case."""
    return text.encode().lower().translate(_SPLIT).replace(b"\n", b" \n ").split(b" ")


class Index:
    """Both transforms of a shard. Word 0 ends a piece; `starts[w]` is the first place of word w in either order."""

    def __init__(self, words: list, starts: np.ndarray, before: np.ndarray, after: np.ndarray):
        self.words, self.starts, self.before, self.after = words, starts, before, after
        self._steps: dict[str, np.ndarray] = {}

    @classmethod
    def build(cls, words: list, ids: np.ndarray, depth: int = MAX_WORDS) -> Index:
        """From the ids of all words in order, with a 0 before, between and after pieces."""
        ids = np.concatenate([[0], ids, [0]])
        ids = ids[np.append(True, (ids[1:] != 0) | (ids[:-1] != 0))].astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(words)))])
        forward, backward = (_order(ids, len(words), depth, step) for step in (1, -1))
        return cls(words, starts, ids[forward - 1].astype(np.int32), np.append(ids[1:], 0)[backward].astype(np.int32))

    def step(self, side: str) -> np.ndarray:
        """Where each place of an order is in it once the word beside it is put in front (LF mapping)."""
        if side not in self._steps:
            column = self.before if side == "left" else self.after
            places = np.empty(len(column), np.int64)
            places[np.argsort(column, kind="stable")] = np.arange(len(column))
            self._steps[side] = places
        return self._steps[side]

    def single(self) -> Phrases:
        """All words as intervals."""
        ids = np.arange(1, len(self.words))
        return Phrases(ids[:, None], self.starts[1:-1], self.starts[1:-1], np.diff(self.starts)[1:])

    def extend(self, phrases: Phrases, side: str) -> Phrases:
        """All phrases that are longer by one word on the given side."""
        column = self.before if side == "left" else self.after
        near, far = (phrases.at, phrases.back) if side == "left" else (phrases.back, phrases.at)
        ends = np.cumsum(phrases.count)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(near - ends + phrases.count, phrases.count)
        owner = np.repeat(np.arange(len(near)), phrases.count)
        word = column[place].astype(np.int64)
        order = np.argsort(owner * len(self.words) + word, kind="stable")
        own, word = owner[order], word[order]
        first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (word[1:] != word[:-1]))) if total else np.zeros(0, np.int64)
        n = np.diff(np.append(first, total))
        inside = word[first] != 0
        first, n = first[inside], n[inside]
        own, word = own[first], word[first]
        # The step of the first place that holds the word is C[word] + rank; smaller neighbours come before it.
        moved = self.step(side)[place[order[first]]]
        beside = far[own] + first - (ends - phrases.count)[own]
        joined = (word[:, None], phrases.ids[own]) if side == "left" else (phrases.ids[own], word[:, None])
        at, back = (moved, beside) if side == "left" else (beside, moved)
        return Phrases(np.hstack(joined), at, back, n)

    def neighbours(self, phrases: Phrases, side: str) -> np.ndarray:
        """How many occurrences of each phrase have a word on that side."""
        column, at = (self.before, phrases.at) if side == "left" else (self.after, phrases.back)
        seen = np.append(0, np.cumsum(column != 0))
        return seen[at + phrases.count] - seen[at]


class Phrases:
    """Phrases of one length: word ids, first places in the forward and the reverse order, counts."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, back: np.ndarray, n: np.ndarray):
        self.ids, self.at, self.back, self.count = ids, at, back, n

    def where(self, mask: np.ndarray) -> Phrases:
        return Phrases(self.ids[mask], self.at[mask], self.back[mask], self.count[mask])


def _order(ids: np.ndarray, n_words: int, depth: int, step: int) -> np.ndarray:
    """Places sorted by the words from there on, read forward (1) or backward (-1), as far as `depth` words."""
    key, top = ids, n_words
    for k in range(1, depth):
        if top > 2**62 // n_words:
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max()) + 1
        beside = np.zeros(len(ids), np.int64)
        if step > 0:
            beside[:-k or None] = ids[k:]
        else:
            beside[k:] = ids[:-k]
        key, top = key * n_words + beside, top * n_words
    return np.argsort(key, kind="stable")


def _shards(depth: int, most: int):
    """Map batches of (lang, text) to index rows of at most about `most` words; a longer text is a shard of its own."""

    def row(lang: str, names: dict[bytes, int], parts: list[np.ndarray]) -> pd.DataFrame:
        ids = np.concatenate(parts)
        # Numbers 0 and 1 are the end of a piece and the empty word.
        ids = ids[ids != 1]
        known = list(names)[2:]
        index = Index.build([b"\n", *known], np.where(ids > 0, ids - 1, 0), depth)
        arrays = [index.starts.astype(np.int32).tobytes(), *(a.astype(_width(len(known) + 1)).tobytes() for a in (index.before, index.after))]
        return pd.DataFrame([(lang, int((ids > 0).sum()), b"\n".join(known), *arrays)], columns=["lang", "size", "words", "starts", "before", "after"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_shards: dict[str, tuple[dict, list, list]] = {}
        waiting = 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                if lang not in open_shards:
                    open_shards[lang] = (defaultdict(count(2).__next__, {b"\n": 0, b"": 1}), [], [0])
                names, parts, n = open_shards[lang]
                words = tokens(text)
                parts.append(np.fromiter(map(names.__getitem__, words), np.int32, len(words)))
                parts.append(np.zeros(1, np.int32))
                n[0] += len(words)
                waiting += len(words)
                if n[0] >= most:
                    yield row(lang, names, parts)
                    waiting -= n[0]
                    del open_shards[lang]
                elif waiting >= 2 * most:
                    # Many languages side by side: the fullest one makes room.
                    lang = max(open_shards, key=lambda x: open_shards[x][2][0])
                    names, parts, n = open_shards.pop(lang)
                    yield row(lang, names, parts)
                    waiting -= n[0]
        for lang, (names, parts, _) in open_shards.items():
            yield row(lang, names, parts)

    return run


def _width(words: int) -> type:
    """Small vocabularies take two bytes a word."""
    return np.uint16 if words <= 1 << 16 else np.int32


def _opened(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Index]]:
    for batch in batches:
        for lang, words, starts, *columns in zip(*(batch[c] for c in ("lang", "words", "starts", "before", "after"))):
            names = ["\n", *bytes(words).decode().split("\n")] if len(words) else ["\n"]
            yield lang, Index(names, np.frombuffer(starts, np.int32), *(np.frombuffer(c, _width(len(names))) for c in columns))


def _hashes(lang: str, index: Index) -> np.ndarray:
    """64-bit hashes of the words of a shard, different for each language."""
    seed = xxhash.xxh3_64_intdigest(lang)
    return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in index.words], np.uint64)


def _word_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        h = [xxhash.xxh3_64_intdigest(w, xxhash.xxh3_64_intdigest(lang)) for lang, w in zip(batch["lang"], batch["phrase"])]
        yield pd.DataFrame({"h": np.array(h, np.uint64).view(np.int64)})


def _hash(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = hashes[ids[:, 0]]
    for k in range(1, ids.shape[1]):
        out = mix(out) + hashes[ids[:, k]] * np.uint64(0x9E3779B97F4A7C15)
    return out


def _places(hashes: np.ndarray, ids: np.ndarray, ranges: int) -> np.ndarray:
    return (_hash(hashes, ids) & np.uint64((ranges << PLACE_BITS) - 1)).astype(np.int64)


class Bitmap:
    """Which hashes may belong to frequent phrases."""

    def __init__(self, slots: np.ndarray, words: np.ndarray):
        self.words = np.zeros(1 << (BITS - 6), np.uint64)
        self.words[slots] = words

    def __contains__(self, item) -> bool:
        return bool(self.has(np.array([item], np.uint64))[0])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & np.uint64((1 << BITS) - 1)
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(hashes: DataFrame) -> Bitmap:
    """Of a column `h` of any length; at most 2^(BITS - 6) rows come to the driver."""
    slot = F.col("h").bitwiseAND((1 << BITS) - 1)
    rows = hashes.select(F.shiftright(slot, 6).alias("slot"), F.expr(f"shiftleft(1L, int(h & 63))").alias("bit"))
    found = rows.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    return Bitmap(found["slot"].to_numpy(), found["bits"].to_numpy().view(np.uint64))


def enumerate_phrases(index: Index, hashes: np.ndarray, depth: int, bitmaps: list[Bitmap]) -> Iterator[Phrases]:
    """Phrases of 1 to `depth` words, one length at a time; bitmap k thins out the phrases of k + 1 words, all parts included.

    Phrases grow to the right and to the left in turn.
    """
    phrases, sides = index.single(), ("right", "left")
    for size in range(1, depth + 1):
        if size > 1:
            phrases = index.extend(phrases, sides[size % 2])
        for k in range(min(size, len(bitmaps))):
            for first in range(size - k):
                phrases = phrases.where(bitmaps[k].has(_hash(hashes, phrases.ids[:, first : first + k + 1])))
        if not len(phrases.count):
            return
        yield phrases


def _survey(depth: int, bitmaps: list[Bitmap], ranges: int, least: int):
    """Map indexes to (range, seen): places of hashes of the phrases of `depth` words, and counts up to `least`, as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, index in _opened(batches):
            hashes = _hashes(lang, index)
            for phrases in enumerate_phrases(index, hashes, depth, bitmaps):
                if phrases.ids.shape[1] == depth:
                    at = _places(hashes, phrases.ids, ranges)
                    order = np.argsort(at)
                    at, first = np.unique(at[order], return_index=True)
                    n = np.minimum(np.add.reduceat(phrases.count[order], first), least)
                    part = at >> PLACE_BITS
                    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist()
                    seen = [_packed(at[i:j] & ((1 << PLACE_BITS) - 1), n[i:j]) for i, j in zip(cuts, [*cuts[1:], len(at)])]
                    yield pd.DataFrame({"range": part[cuts], "seen": seen})

    return run


def _packed(at: np.ndarray, n: np.ndarray) -> bytes:
    """Steps between rising places, and counts, lowest bytes first: most of the other bytes are zero and compress well."""
    return np.stack([np.diff(at, prepend=0), n]).astype("<u4").view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes()


def _unpacked(seen: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, n = np.frombuffer(seen, np.uint8).reshape(2, 4, -1).transpose(0, 2, 1).copy().view("<u4")[..., 0].astype(np.int64)
    return np.cumsum(steps), n


def _frequent(least: int):
    """Map surveys sorted by range to the places (as the low bits of a hash) whose counts sum up to `least` or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, sums = None, np.zeros(1 << PLACE_BITS, np.int64)

        def found() -> pd.DataFrame:
            return pd.DataFrame({"h": (own << PLACE_BITS) + np.flatnonzero(sums >= least)})

        for batch in batches:
            for part, seen in zip(batch["range"].tolist(), batch["seen"]):
                if part != own:
                    if own is not None:
                        yield found()
                    own, sums[:] = part, 0
                at, n = _unpacked(seen)
                sums[at] += n
        if own is not None:
            yield found()

    return run


def _counted(sizes: list[int], bitmaps: list[Bitmap], ranges: int):
    """Map indexes to (lang, range, seen): phrases of the given lengths with their counts, as compressed lists."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, index in _opened(batches):
            hashes = _hashes(lang, index)
            for phrases in enumerate_phrases(index, hashes, max(sizes), bitmaps):
                if phrases.ids.shape[1] not in sizes:
                    continue
                # Eight ranges of a survey make one list: long ones compress better.
                part = _places(hashes, phrases.ids, ranges) >> (PLACE_BITS + 3)
                order = np.argsort(part, kind="stable")
                texts = [" ".join([index.words[i] for i in ids]) for ids in phrases.ids[order].tolist()]
                numbers = np.stack([phrases.count, *(index.neighbours(phrases, side) for side in ("left", "right"))])[:, order]
                cuts = np.flatnonzero(np.append(True, np.diff(part[order]) != 0)).tolist()
                seen = [_listed(texts[i:j], numbers[:, i:j]) for i, j in zip(cuts, [*cuts[1:], len(texts)])]
                yield pd.DataFrame({"lang": lang, "range": part[order][cuts], "seen": seen})

    return run


def _listed(texts: list[str], numbers: np.ndarray) -> bytes:
    """Numbers by their bytes, lowest first: the high ones are zero and compress to nothing."""
    planes = np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(3, -1, 8).transpose(0, 2, 1)
    return zlib.compress(len(texts).to_bytes(8, "little") + planes.tobytes() + "\n".join(texts).encode(), 1)


def _unlisted(seen: bytes) -> tuple[list[str], np.ndarray]:
    raw = zlib.decompress(seen)
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(raw, np.uint8, 24 * n, 8).reshape(3, 8, n).transpose(0, 2, 1)
    return raw[8 + 24 * n :].decode().split("\n"), planes.copy().view("<i8")[..., 0]


def _summed(least: int):
    """Map lists sorted by language and range to (lang, phrase, a, before, after) of at least `least` occurrences."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, sums = None, Sums()
        for batch in batches:
            for lang, part, seen in zip(batch["lang"], batch["range"].tolist(), batch["seen"]):
                if (lang, part) != own:
                    yield from sums.found(own, least)
                    own, sums = (lang, part), Sums()
                sums.add(*_unlisted(seen))
        yield from sums.found(own, least)

    return run


class Sums:
    """Counts of different phrases, added up."""

    def __init__(self):
        self.at, self.numbers = defaultdict(count().__next__), np.zeros((3, 0), np.int64)

    def __len__(self) -> int:
        return len(self.at)

    def add(self, texts: list[str], numbers: np.ndarray) -> None:
        """Each phrase once."""
        at = np.fromiter(map(self.at.__getitem__, texts), np.int64, len(texts))
        if len(self.at) > self.numbers.shape[1]:
            self.numbers = np.hstack([self.numbers, np.zeros((3, len(self.at)), np.int64)])
        self.numbers[:, at] += numbers

    def found(self, own: tuple | None, least: int) -> Iterator[pd.DataFrame]:
        keep = np.flatnonzero(self.numbers[0, : len(self)] >= least)
        if len(keep):
            texts = list(self.at)
            a, before, after = self.numbers[:, keep]
            yield pd.DataFrame({"lang": own[0], "phrase": [texts[i] for i in keep.tolist()], "a": a, "before": before, "after": after})


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows of an index are large: few go to Python at a time. The session's own setting comes back."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, "8m")
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def indexes(docs: DataFrame, max_words: int = MAX_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row for each shard: the transforms of its documents, written to the shared workspace."""
    small_batches(docs.sparkSession)
    lang = F.coalesce(with_type(docs, "lang", "string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), with_type(docs, "text", "string").alias("text")).filter("text is not null")
    rows = texts.mapInPandas(_shards(max_words, shard_words), INDEX)
    path = scratch_path(docs.sparkSession, "phrase_index")
    # Neighbours of equal words are much alike, which a slower codec makes use of.
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def phrases(index: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The words, and the phrases of 2 to `max_words` words, with at least `least` occurrences.

    Columns are (lang, phrase, a, before, after, words); before and after are the occurrences that have a word on the left
    and on the right within their piece.
    """
    narrow = index.select("lang", "words", "starts", "before", "after")
    # A bitmap is made of the low BITS bits of a hash, so there are at least as many places.
    places = 4 * (index.agg(F.sum("size")).first()[0] or 0)
    ranges = 1 << max(BITS - PLACE_BITS, (places >> PLACE_BITS).bit_length())

    def counted(sizes: list[int], maps: list[Bitmap], name: str) -> DataFrame:
        lists = narrow.mapInPandas(_counted(sizes, maps, ranges), "lang string, range long, seen binary")
        dealt = lists.repartition("lang", "range").sortWithinPartitions("lang", "range")
        found = dealt.mapInPandas(_summed(least), "lang string, phrase string, a long, before long, after long")
        return materialise(found.withColumn("words", F.size(F.split("phrase", " ", -1))), name)

    with _small_batches(index.sparkSession):
        words = counted([1], [], "words")
        maps = [bitmap(words.mapInPandas(_word_hashes, "h long"))]
        for depth in range(2, max_words + 1):
            seen = narrow.mapInPandas(_survey(depth, maps, ranges, least), "range long, seen binary")
            dealt = seen.repartition("range").sortWithinPartitions("range")
            maps.append(bitmap(dealt.mapInPandas(_frequent(least), "h long")))
        return words, counted(list(range(2, max_words + 1)), maps, "phrases")


def first_rows(df: DataFrame, group: str, order: list[Column], key: Column, n: int, rows: int) -> DataFrame:
    """The first `n` rows of each group with `rank`, by rounds: no task ever holds more than about 16 n rows of a group."""
    buckets = -(-rows // (16 * n))
    while buckets > 1:
        window = Window.partitionBy(group, F.pmod(F.xxhash64(key), F.lit(buckets))).orderBy(*order)
        df = df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n).drop("rank")
        buckets = -(-buckets // 8) if buckets > 8 else 1
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("rank") <= n)


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, max_words: int = MAX_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The `top` phrases of each language: (lang, rank, phrase, a, l, r, n, score, before, after).

    Text is split into pieces at `.,;:!?` and line ends, and pieces into words at blanks and tabs; phrases do not leave a
    piece, and overlapping occurrences count. `a` is the number of occurrences, at least `least`; n all words of the
    language; l and r the counts of the parts of the cut with the lowest score, 10^6 a^2 / (l r) rounded down, of equal
    ones the first cut. A phrase held in a longer one of at least half its occurrences is left out. Ranks go by score,
    then a, both falling, then the bytes of the phrase.

    Null texts count as empty, a null lang as `und`. Texts without a word give nothing; a language without a frequent
    phrase is not in the result; an empty table gives an empty one. Repeated rows count each. Other columns don't matter.
    """
    index = indexes(docs, max_words, shard_words)
    words, found = phrases(index, max_words, least)
    # Written with a number for each phrase: of what follows, only one step carries texts.
    found = materialise(found.withColumn("id", F.monotonically_increasing_id()), "numbered")
    split = found.withColumn("w", F.split("phrase", " ", -1))
    piece = "named_struct('k', {k}, 'side', '{side}', 'phrase', array_join(slice(w, {at}, {n}), ' '))"
    cuts = [piece.format(k="k", side=side, at=at, n=n) for side, at, n in (("l", "1", "k"), ("r", "k + 1", "words - k"))]
    asked = f"flatten(transform(sequence(1, words - 1), k -> array({', '.join(cuts)})))"
    # Phrases inside that are no part of a cut: from the second word at the earliest to the last but one.
    inner = "transform(sequence(2, words - n), i -> " + piece.format(k="0", side="i", at="i", n="n") + ")"
    inner = f"if(words < 4, cast(array() as array<struct<k: int, side: string, phrase: string>>), flatten(transform(sequence(2, words - 2), n -> {inner})))"
    asked = split.select("lang", "id", F.col("a").alias("asker"), "words", F.inline(F.concat(F.expr(asked), F.expr(inner))))
    known = words.select("lang", "phrase", "a", F.lit(None).cast("long").alias("own")).unionByName(found.select("lang", "phrase", "a", F.col("id").alias("own")))
    met = materialise(asked.join(known, ["lang", "phrase"]).select("id", "k", "side", "a", "own", "asker"), "parts")

    sides = [F.max(F.when(F.col("side") == side, F.col("a"))).alias(side) for side in ("l", "r")]
    both = met.filter("k > 0").groupBy("id", "k").agg(F.max("asker").alias("a"), *sides)
    exact = "cast(1000000 as decimal(38,0)) * cast(a as decimal(19,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    weakest = both.withColumn("score", F.expr(exact)).groupBy("id").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    held = met.filter("own is not null").groupBy(F.col("own").alias("id")).agg(F.max("asker").alias("in_longer"))
    scored = found.join(weakest, "id").join(held, "id", "left")
    scored = scored.filter(F.coalesce(100 * F.col("in_longer") < HELD * F.col("a"), F.lit(True)))
    scored = materialise(scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "before", "after"), "scored")
    best = first_rows(scored, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], F.col("phrase"), top, scored.count())
    total = index.groupBy("lang").agg(F.sum("size").alias("n"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "before", "after")
