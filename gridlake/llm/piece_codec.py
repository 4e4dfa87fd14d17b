"""Encoding and decoding with a SentencePiece merge model, with seeded merge-dropout.

Adjacent symbols are merged in the order of the scores of the merged pieces, ties from the left. With dropout each candidate
that comes up is skipped with some probability, decided by a hash that is keyed by the seed, the document, the place in
it and the piece. The same seed and document give the same pieces at any time and on any machine, another seed or document
other ones, and all of them decode to the text, byte for byte. Every occurrence of a word has draws of its own.

No piece continues past the end of a word, so stretches of blanks and the word after them are encoded for themselves. For
each different stretch the merges without dropout are remembered. An occurrence that skips none of them ends as the
remembered pieces; any other one is encoded for itself, many at a time: the agendas of all stretches of a batch advance
together. Long stretches have an agenda of their own, and are not remembered where there is dropout.

Characters without a piece become byte pieces. So does U+2581, which stands for a blank in pieces, and that makes decoding
lossless for every text.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import small_batches, with_type
from gridlake.llm.shingles import mix

DROPOUT = 0.1
LONGEST = 48  # characters of a stretch that is encoded together with others
_STRETCH = re.compile(r" *[^ ]+| +")
_TOGETHER = 200_000  # occurrences whose draws are looked at together
_BLANK = "▁"
_NEVER = np.iinfo(np.int32).max
RESULT = "ids array<int>, lossless boolean"


class Vocabulary:
    """Pieces, merges and their order, read from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(size)]
        self.size, self.unknown = size, model.unk_id()
        self.bytes_of = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_BLANK, " ").encode() if plain[i] else b"" for i, p in enumerate(pieces)]
        self.byte_id = {b[0]: i for i, b in enumerate(self.bytes_of) if model.is_byte(i)}
        ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        self.of_point = np.full(0x110000, -1, np.int32)
        self.first = {p.replace(_BLANK, " "): i for p, i in ids.items() if len(p) == 1}
        for c, i in self.first.items():
            self.of_point[ord(c)] = i
        scores = np.array([model.get_score(i) for i in range(size)])
        order = np.unique(-scores, return_inverse=True)[1]
        found = [(ids[p[:k]] * size + ids[p[k:]], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        found.sort()
        self.keys = np.array([key for key, _ in found] or [-1], dtype=np.int64)
        self.merged = np.array([i for _, i in found] or [0], dtype=np.int32)
        self.ranks = order[self.merged].astype(np.int32)
        self.rank_of = order.astype(np.int32)
        self.pairs = dict(found)

    def candidates(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; pairs that don't merge have the rank `_NEVER`."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        fits = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(fits, self.ranks[at], _NEVER), self.merged[at]

    def symbols(self, stretch: str) -> list[int]:
        """First symbols: pieces of one character, -1 for characters without one."""
        return [self.first.get(c, -1) for c in stretch]

    def in_bytes(self, char: str) -> list[int]:
        return [self.byte_id.get(b, self.unknown) for b in char.encode()]


_PLACE, _PIECE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_ALL = 2**64 - 1


def _limit(dropout: float) -> int:
    """Draws below it are skipped."""
    return int(min(dropout, 1.0) * (2**64 - 1025))


def _skips(key: np.ndarray, place: np.ndarray, piece: np.ndarray, dropout: float) -> np.ndarray:
    """Whether each candidate is skipped: a keyed hash against the dropout."""
    if dropout <= 0:
        return np.zeros(len(key), bool)
    drawn = mix(key + place.astype(np.uint64) * np.uint64(_PLACE) + piece.astype(np.uint64) * np.uint64(_PIECE))
    return drawn < np.uint64(_limit(dropout))


def _draw(key: int, place: int, piece: int) -> int:
    """The draw of one candidate, as `_skips` makes it."""
    x = (key + place * _PLACE + piece * _PIECE) & _ALL
    x = ((x ^ x >> 32) * 0xD6E8FEB86659FD93) & _ALL
    x = ((x ^ x >> 32) * 0xD6E8FEB86659FD93) & _ALL
    return x ^ x >> 32


def encode_together(
    vocabulary: Vocabulary, stretches: list[str], keys: np.ndarray, dropout: float, merges: list[tuple] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of many short stretches, one after the other, and how many each has; `keys` is the hash key of each.

    The merges that take place are appended to `merges` as arrays (stretch, place, piece). While merging, a character without a piece is a negative number made from its code point.
    """
    length = np.fromiter(map(len, stretches), np.int64, len(stretches))
    n, width = len(stretches), int(length.max()) + 2
    symbol = np.full((n, width), -1, np.int32)  # the last two columns stay empty
    points = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol[np.arange(width)[None, :] < length[:, None]] = np.where(vocabulary.of_point[points] >= 0, vocabulary.of_point[points], -2 - points.astype(np.int32))
    following = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1))
    before = np.tile(np.arange(-1, width - 1, dtype=np.int32), (n, 1))
    alive = np.arange(width)[None, :] < length[:, None]
    rank = np.full((n, width), _NEVER, np.int32)
    piece = np.zeros((n, width), np.int32)
    rank[:, :-1], piece[:, :-1] = vocabulary.candidates(symbol[:, :-1], symbol[:, 1:])
    live = np.arange(n)
    while len(live):
        at = rank[live].argmin(axis=1)
        best = rank[live, at]
        live, at = live[best < _NEVER], at[best < _NEVER]
        if not len(live):
            break
        skip = _skips(keys[live], at, piece[live, at], dropout)
        rank[live[skip], at[skip]] = _NEVER
        rows, left = live[~skip], at[~skip]
        if not len(rows):
            continue
        if merges is not None:
            merges.append((rows, left, piece[rows, left]))
        right = following[rows, left]
        after = following[rows, right]
        symbol[rows, left] = piece[rows, left]
        alive[rows, right] = False
        rank[rows, right] = _NEVER
        following[rows, left] = after
        inside = after < width
        before[rows[inside], after[inside]] = left[inside]
        right_symbol = np.where(inside & (after < length[rows]), symbol[rows, np.minimum(after, width - 1)], -1)
        rank[rows, left], piece[rows, left] = vocabulary.candidates(symbol[rows, left], right_symbol)
        has = before[rows, left] >= 0
        rows, left = rows[has], left[has]
        back = before[rows, left]
        rank[rows, back], piece[rows, back] = vocabulary.candidates(symbol[rows, back], symbol[rows, left])
    flat, count = symbol[alive], alive.sum(axis=1)
    lacking = flat < 0
    if lacking.any():
        values, which = np.unique(flat[lacking], return_inverse=True)
        in_bytes = [vocabulary.in_bytes(chr(-2 - int(v))) for v in values]
        wide = np.ones(len(flat), np.int64)
        wide[lacking] = np.array([len(b) for b in in_bytes])[which]
        count = np.bincount(np.repeat(np.arange(n), count), wide, n).astype(np.int64)
        begin = (np.cumsum(wide) - wide)[lacking]
        flat = np.repeat(flat, wide)
        for k in range(max(map(len, in_bytes))):
            has = np.array([len(b) > k for b in in_bytes])[which]
            flat[begin[has] + k] = np.array([b[k] if len(b) > k else 0 for b in in_bytes])[which[has]]
    return flat, count


def _with_bytes(vocabulary: Vocabulary, symbols: list[int], places: list[int], stretch: str) -> np.ndarray:
    out: list[int] = []
    for symbol, place in zip(symbols, places):
        out += [symbol] if symbol >= 0 else vocabulary.in_bytes(stretch[place])
    return np.array(out, np.int32)


def encode_alone(vocabulary: Vocabulary, stretch: str, key: int, dropout: float) -> np.ndarray:
    """Pieces of one stretch of any length, by an agenda in a heap; the same pieces as `encode_together` finds."""
    symbol = vocabulary.symbols(stretch)
    n, pairs, ranks, size = len(symbol), vocabulary.pairs, vocabulary.rank_of, vocabulary.size
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def propose(left: int) -> None:
        right = following[left] if left >= 0 else n
        if left >= 0 and right < n and symbol[left] >= 0 and symbol[right] >= 0:
            piece = pairs.get(symbol[left] * size + symbol[right])
            if piece is not None:
                heapq.heappush(agenda, (int(ranks[piece]), left, piece, symbol[left], symbol[right]))

    for left in range(n):
        propose(left)
    gone, limit = bytearray(n), _limit(dropout)
    while agenda:
        _, left, piece, a, b = heapq.heappop(agenda)
        if gone[left] or symbol[left] != a or following[left] >= n or symbol[following[left]] != b:
            continue
        if dropout > 0 and _draw(key, left, piece) < limit:
            continue
        right = following[left]
        symbol[left], gone[right] = piece, 1
        following[left] = following[right]
        if following[right] < n:
            before[following[right]] = left
        propose(left)
        propose(before[left])
    places = [i for i in range(n) if not gone[i]]
    return _with_bytes(vocabulary, [symbol[i] for i in places], places, stretch)


class Lists:
    """Lists of numbers, one after the other, found by their number."""

    def __init__(self, *kinds: type):
        self.flat = [np.zeros(0, kind) for kind in kinds]
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, length: np.ndarray, *flat: np.ndarray) -> None:
        self.begin = np.concatenate([self.begin, len(self.flat[0]) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = [np.concatenate([old, new.astype(old.dtype)]) for old, new in zip(self.flat, flat)]

    def of(self, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """How long the lists `at` are, and what they hold, in this order."""
        n = self.length[at]
        index = np.repeat(self.begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return n, *[flat[index] for flat in self.flat]


class Codec:
    """Encodes and decodes texts. What it remembers is bounded."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 0, dropout: float = DROPOUT, most: int = 250_000):
        self.vocabulary, self.seed, self.dropout, self.most = vocabulary, seed, dropout, most
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.pieces, self.merges = Lists(np.int32), Lists(np.int32, np.int32)

    def encode(self, texts: list[str], keys: list[str]) -> list[np.ndarray]:
        """Piece ids of each text; `keys` names the document, and with the seed decides what is skipped."""
        if len(self.at) > self.most:
            self._forget()
        cut = [_STRETCH.findall(" " + text) if text else [] for text in texts]
        new = list(set().union(*cut).difference(self.at))
        self._learn(new)
        out = []
        for stretches, key in zip(self._lots(cut), self._lots([self._drawn_for(own, len(c)) for own, c in zip(keys, cut)])):
            out.append(self._encode([w for some in stretches for w in some], np.concatenate(key)))
        ids = np.concatenate([flat for flat, _ in out]) if out else np.zeros(0, np.int32)
        n = np.concatenate([n for _, n in out]) if out else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *map(len, cut)])]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def _drawn_for(self, key: str, occurrences: int) -> np.ndarray:
        """The hash key of each occurrence in a document."""
        return mix(np.uint64(xxhash.xxh3_64_intdigest(key, seed=self.seed)) + np.arange(occurrences, dtype=np.uint64))

    @staticmethod
    def _lots(parts: list) -> Iterator[list]:
        """The parts in order, in lots of at most `_TOGETHER` items; longer parts are cut."""
        lot, size = [], 0
        for part in parts:
            while size + len(part) > _TOGETHER:
                room = _TOGETHER - size
                yield [*lot, part[:room]]
                lot, size, part = [], 0, part[room:]
            lot.append(part)
            size += len(part)
        if size:
            yield lot

    def _encode(self, stretches: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all occurrences, one after the other, and how many each has."""
        place = np.fromiter(map(self.at.__getitem__, stretches), np.int64, len(stretches))
        if self.dropout <= 0:
            n, flat = self.pieces.of(place)
            return flat, n
        merges, left, piece = self.merges.of(place)
        owner = np.repeat(np.arange(len(place)), merges)
        own = np.zeros(len(place), bool)
        own[owner[_skips(keys[owner], left, piece, self.dropout)]] = True
        own |= self.pieces.length[place] == 0  # long ones
        rows = np.flatnonzero(own)
        if not len(rows):
            n, flat = self.pieces.of(place)
            return flat, n
        found = Lists(np.int32)
        order = self._all(found, [stretches[i] for i in rows.tolist()], keys[rows], self.dropout)
        at = np.empty(len(rows), np.int64)
        at[order] = np.arange(len(rows))
        # Remembered lists first, then those of this call.
        both = Lists(np.int32)
        both.flat = [np.concatenate([self.pieces.flat[0], found.flat[0]])]
        both.begin = np.concatenate([self.pieces.begin, found.begin + len(self.pieces.flat[0])])
        both.length = np.concatenate([self.pieces.length, found.length])
        place[rows] = len(self.pieces.begin) + at
        n, flat = both.of(place)
        return flat, n

    def _all(self, out: Lists, stretches: list[str], keys: np.ndarray, dropout: float, merges: Lists | None = None) -> np.ndarray:
        """Add the pieces of each stretch to `out`, in the order that is returned; long ones come last."""
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        order = []
        for low, high in ((0, 6), (6, 9), (9, 13), (13, 20), (20, LONGEST)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for first in range(0, len(rows), 20_000):
                some = rows[first : first + 20_000]
                done: list[tuple] = []
                ids, n = encode_together(self.vocabulary, [stretches[i] for i in some.tolist()], keys[some], dropout, None if merges is None else done)
                out.add(n, ids)
                if merges is not None:
                    row, left, piece = (np.concatenate(part) for part in zip(*done)) if done else [np.zeros(0, np.int64)] * 3
                    sorted_ = np.argsort(row, kind="stable")
                    merges.add(np.bincount(row, minlength=len(some)), left[sorted_], piece[sorted_])
                order.append(some)
        long = np.flatnonzero(sizes > LONGEST)
        if len(long):
            remembered = merges is not None and self.dropout > 0
            ids = [] if remembered else [encode_alone(self.vocabulary, stretches[i], int(keys[i]), dropout) for i in long.tolist()]
            n = np.zeros(len(long), np.int64) if remembered else np.array([len(own) for own in ids])
            out.add(n, np.concatenate(ids) if ids else np.zeros(0, np.int32))
            if merges is not None:
                merges.add(np.zeros(len(long), np.int64), *[np.zeros(0, np.int32)] * 2)
            order.append(long)
        return np.concatenate(order) if order else np.zeros(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        """Remember pieces and merges without dropout; of a long stretch nothing, where there is dropout."""
        known = len(self.pieces.begin)
        order = self._all(self.pieces, new, np.zeros(len(new), np.uint64), 0.0, self.merges)
        self.at.update((new[i], known + place) for place, i in enumerate(order.tolist()))

    def decode(self, ids) -> str:
        """The text of piece ids; the blank that encoding put in front is taken away."""
        text = b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file, read once in a process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encode(docs: DataFrame, model_path: str, seed: int = 0, dropout: float = DROPOUT) -> DataFrame:
    """The rows of `docs` with `pieces`: ids of the whole text, and lossless: whether they decode to the text again.

    What is skipped depends on the seed and doc_id (the text, where doc_id is null), so repeated rows get the same ids. A
    null text has null ids and a null lossless; an empty text has no ids. `model_path` must be readable on every
    executor. A column of `docs` called pieces is replaced. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        codec = Codec(vocabulary(model_path), seed, dropout)
        for texts, keys in batches:
            ids = codec.encode(texts.fillna("").tolist(), keys.fillna("").tolist())
            same = [None if text is None else codec.decode(own.tolist()) == text for text, own in zip(texts, ids)]
            yield pd.DataFrame({"ids": [None if s is None else own for s, own in zip(same, ids)], "lossless": same})

    text = with_type(docs, "text", "string")
    key = F.coalesce(with_type(docs, "doc_id", "string"), F.concat(F.lit("text:"), text))
    return docs.withColumn("pieces", apply.asNondeterministic()(text, key))


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """The rows of `encoded` with the text of a column of ids. Null ids give null, no ids the empty text.

    An id outside the vocabulary, or one of a control piece, adds nothing.
    """
    small_batches(encoded.sparkSession)

    @F.pandas_udf("string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(vocabulary(model_path))
        size = codec.vocabulary.size
        for series in batches:
            yield pd.Series([None if own is None else codec.decode([i for i in own if 0 <= i < size]) for own in series], dtype=object)

    return encoded.withColumn(out, apply(F.col(ids)))
