"""Phrases against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import collocations as c


def plain(rows, top, least, max_words):
    """The contract, word by word: (lang, rank, phrase, a, l, r, n, score)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        cands, kept = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}, []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "the", "ÄÖ", "äö", "日本", "x\x00y", " ", "w1", "w2", "Of", "é"]
    marks = ["", "", "", ".", ", ", "!", "\n", "\x0b", "\t", "  ", ";;"]
    text = lambda: " ".join(rng.choice(vocabulary[: rng.randint(2, 12)]) + rng.choice(marks) for _ in range(rng.randint(0, 60)))
    return [(rng.choice(["en", "de", None, "und", "x y"]), rng.choice([None, ""]) if i % 17 == 0 else text()) for i in range(n)]


@pytest.mark.parametrize("max_words, shard", [(3, 200), (2, 10**6), (4, 90), (5, 300)])
def test_collocations_against_plain_counting(spark, max_words, shard):
    rows = corpus(max_words, 300)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = c.collocations(docs, top=40, least=4, max_words=max_words, shard_words=shard)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = plain(rows, 40, 4, max_words)
    assert sorted(tuple(r) for r in got.select(columns).collect()) == expected and len(expected) > 60


def test_index_extends_both_ways():
    """Intervals of both orders grown in any sequence of sides have the counts and neighbours of plain search."""
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 6, 3000)
    index = c.Index.build([str(i) for i in range(6)], ids, 4)
    text = np.concatenate([[0], ids, [0]]).tolist()
    for sides in (("right", "right", "right"), ("left", "left", "left"), ("right", "left", "right"), ("left", "right", "left")):
        phrases = index.single()
        for side in sides:
            phrases = index.extend(phrases, side)
            size = phrases.ids.shape[1]
            grams = [tuple(text[i : i + size]) for i in range(len(text) - size + 1)]
            plain_counts = Counter(g for g in grams if 0 not in g)
            assert dict(zip(map(tuple, phrases.ids.tolist()), phrases.count.tolist())) == plain_counts
            before = Counter(g for i, g in enumerate(grams) if 0 not in g and i and text[i - 1])
            after = Counter(g for i, g in enumerate(grams) if 0 not in g and text[i + size : i + size + 1] not in ([], [0]))
            for name, expected in (("left", before), ("right", after)):
                found = dict(zip(map(tuple, phrases.ids.tolist()), index.neighbours(phrases, name).tolist()))
                assert found == {g: expected[g] for g in plain_counts}


def test_long_keys_are_ranked():
    """Sort keys that would pass 64 bits."""
    rng = np.random.default_rng(2)
    ids = np.where(rng.random(4000) < 0.9, rng.integers(1, 5, 4000), rng.integers(5, 70_000, 4000))
    words = [str(i) for i in range(70_000)]
    index = c.Index.build(words, ids, 5)
    phrases = index.single().where(np.arange(69_999) < 4)
    for side in ("right", "left", "right", "left"):
        phrases = index.extend(phrases, side)
    found = {tuple(i): n for i, n in zip(phrases.ids.tolist(), phrases.count.tolist())}
    grams = Counter(tuple(ids[i : i + 5].tolist()) for i in range(len(ids) - 4))
    assert found == {g: n for g, n in grams.items() if g[2] < 5} and len(found) > 100


def test_bitmap_misses_nothing(spark):
    hashes = [(x,) for x in (-1, 0, 5, 63, 64, 2**40 + 3, -(2**60))]
    bits = c.bitmap(spark.createDataFrame(hashes, "h long"))
    assert bits.has(np.array([h for (h,) in hashes], np.int64).view(np.uint64)).all()
    assert not bits.has(np.array([6, 2**20], np.uint64)).any()
    assert not c.bitmap(spark.createDataFrame([], "h long")).words.any()


def test_surveys_keep_places_and_counts():
    rng = np.random.default_rng(5)
    at = np.unique(rng.integers(0, 1 << c.PLACE_BITS, 5000))
    n = rng.integers(1, 70_000, len(at))
    places, counts = c._unpacked(c._packed(at, n))
    assert (places == at).all() and (counts == n).all()


def test_lists_keep_phrases_and_counts():
    rng = np.random.default_rng(6)
    texts = [f"w{i} x\x00{i % 7}" for i in range(500)]
    numbers = rng.integers(0, 2**40, (3, 500))
    found, counts = c._unlisted(c._listed(texts, numbers))
    assert found == texts and (counts == numbers).all()
    sums = c.Sums()
    for _ in range(3):
        sums.add(texts[::-1], numbers[:, ::-1])
    sums.add(["new"], np.array([[1], [2], [3]]))
    rows = next(sums.found(("en", 0), 2))
    assert dict(zip(rows["phrase"], zip(rows["a"], rows["before"], rows["after"]))) == {t: tuple(3 * x for x in n) for t, n in zip(texts, numbers.T.tolist()) if n[0] > 0}


def test_rounds_find_the_first_rows(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"), F.col("id").cast("string").alias("k"))
    got = c.first_rows(df, "g", [F.asc("v"), F.asc("k")], F.col("k"), 5, 20_000)
    rows = df.collect()
    for g in (0, 1):
        expected = sorted((r.v, r.k) for r in rows if r.g == g)[:5]
        assert [(r.v, r.k) for r in sorted((r for r in got.collect() if r.g == g), key=lambda r: r.rank)] == expected


def test_odd_tables(spark):
    kind = "doc_id long, text string, lang string, rank string, n string, a long"
    assert c.collocations(spark.createDataFrame([], kind)).count() == 0
    assert c.collocations(spark.createDataFrame([(1, None, None, "x", "y", 1)] * 3 + [(2, " .,", "en", None, None, 2)], kind)).count() == 0
    long = "to be or not " * 50_000
    rows = [(1, long, "en", "r", "n", 3), (1, "Word " * 12, None, "r", "n", 3), (1, "x" * 300_000, "en", "r", "n", 3)]
    got = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n) for r in c.collocations(spark.createDataFrame(rows, kind)).collect()}
    assert got["en", "to be or"] == (50_000, 50_000, 50_000, 200_001) and ("en", "to be") not in got
    # The longer phrase has 10 of 11 occurrences.
    assert got == {**got, ("und", "word word word"): (10, 12, 11, 12)} and ("und", "word word") not in got
    assert c.collocations(spark.createDataFrame([(1,)], "doc_id long")).count() == 0
