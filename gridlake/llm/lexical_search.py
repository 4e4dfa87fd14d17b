"""Ranked lexical search by hashed max-sketches.

Each document's impacts (what a term would add to the score of a query) are folded into a sketch of `SKETCH` coordinates:
a term goes to the coordinate of its hash, and a coordinate holds the largest impact that falls on it. For a query, the sum
of the coordinates of its terms is therefore never below the document's score. These bounds are looked up for all queries
and a batch of documents at once, as one matrix product. Documents are then scored exactly in the order of falling bounds,
until the bound is below the score of the last wanted rank.

Queries are worked off in blocks of bounded size, so that what goes to every task is bounded. A block reads the documents
once and writes, for each of them, its length and the counts of the block's terms to the shared workspace; term statistics
come from there, and the two scoring passes read only that:

1. every task scores the documents with the highest bounds among its own; the last wanted rank of all of them is a limit
   that the true one can't be below;
2. every task scores, by falling bounds, what is not below the limit, raising the limit as it goes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import ascii_lower, small_batches, with_type
from gridlake.workspace import materialise

TOP = 50
SKETCH = 1_024
BLOCK_TERMS, BLOCK_QUERIES = 50_000, 1_000  # of a block of queries; a query with more terms is a block of its own
STEP = 32  # documents of a query scored between two looks at the limit

# Bytes that belong to no term: ASCII but for digits and letters. A-Z is put in lower case.
_BLANKS = bytes(b for b in range(128) if not chr(b).isalnum())
_SPLIT = bytes.maketrans(_BLANKS, b" " * len(_BLANKS))
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

POSTINGS = "doc_id long, unnamed boolean, n long, terms array<int>, counts array<int>"
RESULT = "query int, unnamed boolean, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    return text.encode().lower().translate(_SPLIT).split()


@dataclass
class Block:
    """Queries by number, and pairs (query, term), each once, both numbered."""

    items: list
    terms: dict[bytes, int]
    query_of: np.ndarray
    term_of: np.ndarray


def blocks(queries: DataFrame, most_terms: int = BLOCK_TERMS, most_queries: int = BLOCK_QUERIES) -> Iterator[Block]:
    """The queries in blocks. Rows of the same item_id are one query with the terms of all of them."""
    text = with_type(queries, "text", "string")
    split = F.array_distinct(F.filter(F.split(ascii_lower(text), NO_TERM, -1), lambda t: t != ""))
    pairs = queries.select(with_type(queries, "item_id", "long").alias("item_id"), F.explode(split).alias("term"))
    pairs = pairs.groupBy("item_id").agg(F.collect_set("term").alias("terms"))
    sizes = materialise(pairs.withColumn("size", F.size("terms")), "queries")
    items, terms, query_of, term_of = [], {}, [], []
    # Rows arrive one partition at a time; the driver holds one block of them.
    for row in sizes.orderBy("item_id").toLocalIterator():
        if items and (len(items) >= most_queries or len(terms) + row.size > most_terms):
            yield Block(items, terms, np.array(query_of), np.array(term_of))
            items, terms, query_of, term_of = [], {}, [], []
        for term in sorted(row.terms):
            query_of.append(len(items))
            term_of.append(terms.setdefault(term.encode(), len(terms)))
        items.append(row.item_id)
    if items:
        yield Block(items, terms, np.array(query_of), np.array(term_of))


def _postings(terms: dict[bytes, int]):
    """Map (doc_id, unnamed, text) to the length of each document and its counts of the given terms."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, found, counts = np.zeros(len(batch), np.int64), [], []
            for i, text in enumerate(batch["text"]):
                words = terms_of(text)
                at = np.fromiter(map(terms.get, words, repeat(-1)), np.int32, len(words))
                own, n = np.unique(at[at >= 0], return_counts=True)
                lengths[i] = len(words)
                found.append(own)
                counts.append(n.astype(np.int32))
            rows = pd.DataFrame({"doc_id": batch["doc_id"], "unnamed": batch["unnamed"], "n": lengths, "terms": found, "counts": counts})
            yield rows[rows["n"] > 0]

    return run


@dataclass
class Scorer:
    """Scores of documents for the queries of a block, from the statistics of all documents."""

    block: Block
    weights: np.ndarray
    documents: int
    words: int

    @cached_property
    def wanted(self) -> np.ndarray:
        """Which term belongs to which query: one row for each term."""
        out = np.zeros((len(self.block.terms), len(self.block.items)), bool)
        out[self.block.term_of, self.block.query_of] = True
        return out

    @cached_property
    def slots(self) -> np.ndarray:
        """The coordinate of each term."""
        return np.array([xxhash.xxh3_64_intdigest(t) % SKETCH for t in self.block.terms], np.int64)

    @cached_property
    def lookup(self) -> np.ndarray:
        """How many terms of each query fall on each coordinate: one row for each query."""
        out = np.zeros((len(self.block.items), SKETCH))
        np.add.at(out, (self.block.query_of, self.slots[self.block.term_of]), 1.0)
        return out

    def impacts(self, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What each term of each document adds to the score of a query that asks for it."""
        m = 100 - 50 + (50 * lengths * self.documents) // self.words
        return self.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * np.repeat(m, sizes)))

    def bounds(self, row: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n: int) -> np.ndarray:
        """For each query an upper bound of the score of each document, from the sketches of the documents."""
        sketch = np.zeros((SKETCH, n))
        np.maximum.at(sketch, (self.slots[terms], row), impacts)
        # Sums beyond 2^53 are rounded; a bound must not come out too small for that.
        return self.lookup @ sketch * (1 + 1e-9)

    def scores(self, queries: np.ndarray, docs: np.ndarray, ends: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """Exact scores of pairs (query, document)."""
        n = sizes[docs]
        stops = np.cumsum(n)
        place = np.arange(stops[-1] if len(stops) else 0) + np.repeat((ends - sizes)[docs] - stops + n, n)
        summed = np.append(0, np.cumsum(np.where(self.wanted[terms[place], np.repeat(queries, n)], impacts[place], 0)))
        return summed[stops] - summed[stops - n]


def _search(scorer: Scorer, top: int, limits: np.ndarray, first_only: bool):
    """Map postings to (query, unnamed, doc_id, score): the rows that may be among the first `top` of a query.

    With `first_only`, a batch scores no more than about `top` documents of each query, those of the highest bounds.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limit, kept = limits.copy(), []
        best = [np.zeros(0, np.int64)] * len(limit)
        for batch in batches:
            sizes = batch["terms"].str.len().to_numpy(np.int64)
            if not sizes.sum():
                continue
            terms, counts = (np.concatenate(batch[c].to_list()).astype(np.int64) for c in ("terms", "counts"))
            ends, row = np.cumsum(sizes), np.repeat(np.arange(len(batch)), sizes)
            impacts = scorer.impacts(batch["n"].to_numpy(np.int64), sizes, terms, counts)
            bounds = scorer.bounds(row, terms, impacts, len(batch))
            order = np.argsort(-bounds, axis=1, kind="stable")
            going = np.flatnonzero(bounds.max(axis=1) >= limit)
            for done in range(0, min(top, len(batch)) if first_only else len(batch), STEP):
                docs = order[going, done : done + STEP]
                queries = np.broadcast_to(going[:, None], docs.shape)
                hopeful = bounds[queries, docs] >= limit[queries]
                asked, docs = queries[hopeful], docs[hopeful]
                score = scorer.scores(asked, docs, ends, sizes, terms, impacts)
                good = score >= limit[asked]
                asked, docs, score = asked[good], docs[good], score[good]
                kept.append(pd.DataFrame({"query": asked, "unnamed": batch["unnamed"].to_numpy()[docs], "doc_id": batch["doc_id"].to_numpy()[docs], "score": score}))
                for q in np.unique(asked):
                    best[q] = np.sort(np.append(best[q], score[asked == q]))[-top:]
                    if len(best[q]) == top:
                        limit[q] = max(limit[q], best[q][0])
                # A query goes on while the bounds to come can still reach its limit.
                going = going[hopeful.all(axis=1)]
                if not len(going):
                    break
            if sum(map(len, kept)) > 4 * top * len(limit):
                kept = [_highest(kept, limit, top)]
        if kept:
            yield _highest(kept, limit, top)

    return run


def _highest(parts: list[pd.DataFrame], limit: np.ndarray, top: int) -> pd.DataFrame:
    """The first `top` rows of each query, by score and then by doc_id."""
    rows = pd.concat(parts, ignore_index=True)
    rows = rows[rows["score"] >= limit[rows["query"]]]
    rows = rows.sort_values(["query", "score", "unnamed", "doc_id"], ascending=[True, False, True, True])
    return rows.groupby("query").head(top)


def _block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    postings = materialise(docs.mapInPandas(_postings(block.terms), POSTINGS), "postings")
    documents, words = postings.agg(F.count("*"), F.sum("n")).first()
    held = [0] * len(block.terms)
    # One row for each term of the block, one for each of its queries: both are bounded.
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toLocalIterator():
        held[row.term] = row.df
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held], np.int64)
    scorer = Scorer(block, weights, documents, words or 1)

    def ranked(limits: np.ndarray, first_only: bool) -> DataFrame:
        found = postings.mapInPandas(_search(scorer, top, limits, first_only), RESULT)
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "unnamed", "doc_id"))
        return found.withColumn("rank", place).filter(F.col("rank") <= top)

    limits = np.ones(len(block.items), np.int64)
    for row in ranked(limits, True).filter(F.col("rank") == top).select("query", "score").toLocalIterator():
        limits[row.query] = row.score
    names = docs.sparkSession.createDataFrame(list(enumerate(block.items)), "query int, item_id long")
    doc_id = F.when(~F.col("unnamed"), F.col("doc_id")).alias("doc_id")
    return ranked(limits, False).join(names, "query").select("item_id", "rank", doc_id, "score")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """The `top` highest-scoring documents of each query, score above 0: (item_id, rank, doc_id, score).

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. N documents have a term, L
    terms in all; a document of n terms has m = 100 - 50 + 50 n N div L. A term held by df documents has the weight
    w = floor(1000 ln((2 N + 2) / (2 df + 1))), and adds w (10^9 tf div (1000 tf + 20 m)) once to the score of a query.
    Equal scores rank by ascending doc_id, nulls last.

    Null and empty texts, and texts without a term, are in no result and no statistic. Every row is a document of its own,
    repeated ones too. A query without a term, or whose terms occur nowhere, has no rows. Rows of one item_id are one
    query; a null item_id is one as well. Empty tables give an empty result. Other columns don't matter.
    """
    spark = docs.sparkSession
    small_batches(spark)
    doc_id = with_type(docs, "doc_id", "long")
    # Long columns with nulls would reach Python as doubles.
    narrow = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("unnamed"), with_type(docs, "text", "string").alias("text"))
    narrow = narrow.filter("text is not null")
    out = None
    for block in blocks(queries):
        part = materialise(_block(narrow, block, top), "ranked")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
