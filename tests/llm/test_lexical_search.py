"""Ranked search against scores of all documents."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import lexical_search as s

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(x.lower() if "A" <= x <= "Z" else x for x in text or ""))


def plain(docs, queries, top):
    bags = [(doc_id, terms(text)) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n, total, out = len(bags), sum(len(b) for _, b in bags), []
    for item in {i for i, _ in queries}:
        wanted = {t for i, text in queries if i == item for t in terms(text)}
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in b for _, b in bags) + 1))) for t in wanted}
        found = []
        for doc_id, bag in bags:
            m = 100 - 50 + (50 * len(bag) * n) // total
            score = sum(weight[t] * ((10**9 * bag.count(t)) // (1000 * bag.count(t) + 20 * m)) for t in wanted)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, unnamed, doc_id) in enumerate(sorted(found)[:top], 1):
            out.append((item, rank, None if unnamed else doc_id, -score))
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("th", "Er", "日", "é", "x9") for b in range(30)]
    text = lambda most: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--", "_"]) for _ in range(rng.randint(0, most)))
    docs = [(rng.choice([None, i, i // 2]), rng.choice([None, ""]) if i % 23 == 0 else text(80)) for i in range(n)]
    queries = [(rng.choice([None, i, i // 3]), rng.choice([None, "?"]) if i % 11 == 0 else text(15)) for i in range(40)]
    return docs + docs[:30], queries


@pytest.mark.parametrize("top, block", [(50, 10**6), (7, 20), (1, 1)])
def test_search_against_all_scores(spark, monkeypatch, top, block):
    """One block, several, and a block for every query; long and short results; ties of repeated rows."""
    monkeypatch.setattr(s, "STEP", 4)
    docs, queries = corpus(top, 700)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(queries, "item_id long, text string")
    made = list(s.blocks(asked, block, 9 if block < 10**6 else 1000))
    assert len(made) == 1 if block == 10**6 else len(made) > 3
    whole = s.blocks
    monkeypatch.setattr(s, "blocks", lambda q: whole(q, block, 9 if block < 10**6 else 1000))
    got = sorted(map(tuple, s.search(frame, asked, top).collect()), key=str)
    assert got == plain(docs, queries, top) and len(got) > 20


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(4)
    n_terms, n_queries, n_docs = 5_000, 30, 200
    query_of = np.repeat(np.arange(n_queries), 40)
    term_of = np.concatenate([rng.choice(n_terms, 40, replace=False) for _ in range(n_queries)])
    block = s.Block(list(range(n_queries)), {str(i).encode(): i for i in range(n_terms)}, query_of, term_of)
    scorer = s.Scorer(block, rng.integers(0, 9000, n_terms), n_docs, 40_000)
    sizes = rng.integers(0, 300, n_docs)
    held = np.concatenate([rng.choice(n_terms, k, replace=False) for k in sizes])
    impacts = scorer.impacts(rng.integers(1, 900, n_docs), sizes, held, rng.integers(1, 9, len(held)))
    bounds = scorer.bounds(np.repeat(np.arange(n_docs), sizes), held, impacts, n_docs)
    q, d = (x.ravel() for x in np.meshgrid(np.arange(n_queries), np.arange(n_docs), indexing="ij"))
    exact = scorer.scores(q, d, np.cumsum(sizes), sizes, held, impacts).reshape(n_queries, n_docs)
    sums = np.zeros((n_queries, n_docs), int)
    for i, (t, x) in enumerate(zip(held, impacts)):
        sums[:, np.repeat(np.arange(n_docs), sizes)[i]] += np.where(scorer.wanted[t], x, 0)
    assert (exact == sums).all() and (bounds >= exact).all() and (bounds > exact).any()


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "one Two"), (2, None), (3, " \n"), (4, "two " * 100_000), (1, "one Two"), (None, "two")], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("x")).withColumn("query", F.lit(1)).withColumn("rank", F.lit(None)).withColumn("terms", F.lit(0))
    asked = spark.createDataFrame([(7, "ONE one"), (8, "nowhere"), (9, None), (None, "two"), (7, "two")], "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = sorted(map(tuple, s.search(docs, asked).collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in asked.collect()], 50)
    assert [r[2] for r in got if r[0] == 7][:2] == [1, 1]
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert s.search(nothing, asked).count() == 0
    assert s.search(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert s.search(docs.select("doc_id"), asked.select("item_id")).count() == 0
