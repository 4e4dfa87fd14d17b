"""N-gram Jaccard join by chosen paths.

A document is its set of word shingles, embedded in `SIGNATURE` minima: each (position, minimum) is a token, and two sets
share a token with a probability equal to their similarity. In each of `runs` independent repetitions a set follows the
tokens whose hash under the current path is below 1 / (threshold * SIGNATURE); two sets of at least the threshold share one
chosen token on average. Sets that followed the same path meet in a bucket:

- all paths have `LEVELS` tokens at first, which keeps passages that many documents share from filling buckets;
- a bucket of one is finished;
- a small bucket is compared by brute force on the signatures;
- in a large one each member is first compared with one pivot. Members that surely resemble it join its family and leave:
  by the triangle inequality their partners resemble it as well and are in the same family. The rest choose tokens again,
  under the longer path. After `DEPTH` levels what is left is compared block by block.

The comparisons emit one edge to a family per member, not pairs, so a group of any size costs its own size. The families
hold all candidates; inside them every pair is then verified on the exact shingle sets, in blocks of bounded size. Only
counts of links and spanning edges leave a block.

`runs` follows from the recall that is asked for: a pair at the threshold survives d levels of a run with probability
p(d) = 1 - exp(-p(d-1)), p(0) = 1, and runs = ln(1 - recall) / ln(1 - p(levels)).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import carried, components, small_batches, with_type
from gridlake.llm.shingles import SHINGLE_WORDS, Words, mix, shingles
from gridlake.workspace import materialise

THRESHOLD = 0.8
RECALL = 0.999
LEVELS = 3  # of every path, chosen in one pass over a set; `runs` is computed for them
SIGNATURE = 64
SMALL_BUCKET = 100
DEPTH = 8
BLOCK = 256

_SLACK = 4.5  # standard errors of a similarity estimated on the signature


def runs_for(recall: float, levels: int = LEVELS) -> int:
    survive = 1.0
    for _ in range(levels):
        survive = 1 - math.exp(-survive)
    return math.ceil(math.log(1 - recall) / math.log(1 - survive))


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_likely(similarity: float) -> float:
    """What a pair of this similarity still has by estimate, but for a chance of a few in a million."""
    return similarity - _SLACK * math.sqrt(similarity * (1 - similarity) / SIGNATURE)


def _signatures(size: int):
    """Map batches of (doc_id, class, text) to (doc_id, class, filled, sig)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, factors = Words(), _odd(11, SIGNATURE)
        for batch in batches:
            texts = batch.pop("text").fillna("").tolist()
            sigs: list[bytes | None] = []
            for lot in _lots(texts, 2_000_000):
                values, made = shingles(words, lot, size)
                full = np.flatnonzero(made)
                sig = np.zeros((len(full), SIGNATURE), np.uint32)
                if len(full):
                    starts = (np.cumsum(made) - made)[full]
                    for k in range(SIGNATURE):
                        sig[:, k] = np.minimum.reduceat(values * factors[k], starts) >> np.uint64(32)
                own: list[bytes | None] = [None] * len(lot)
                for row, i in enumerate(full):
                    own[i] = sig[row].tobytes()
                sigs += own
            yield batch.assign(sig=sigs)

    return run


def _lots(texts: list[str], most_chars: int) -> Iterator[list[str]]:
    """The texts in order, in lots of about so many characters; a longer text is a lot of its own."""
    lot, chars = [], 0
    for text in texts:
        if lot and chars + len(text) > most_chars:
            yield lot
            lot, chars = [], 0
        lot.append(text)
        chars += len(text)
    if lot:
        yield lot


def _chosen(sig: np.ndarray, path: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and new paths of the tokens that are chosen under the path of each row."""
    position = np.arange(sig.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    tokens = mix((sig.astype(np.uint64) << np.uint64(16)) ^ position)
    drawn = mix(tokens ^ path[:, None])
    rows, at = np.nonzero(drawn < np.uint64(2**64 / (threshold * sig.shape[1])))
    return rows, mix(drawn[rows, at] + np.uint64(1))


def _as_sig(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(len(column), -1)


def _first_level(runs: int, threshold: float, levels: int):
    """Map (node, sig) to the members (bucket, node) of all runs, after the first `levels` tokens of a path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seeds = mix(np.arange(1, runs + 1, dtype=np.uint64))
        for batch in batches:
            if not len(batch):
                continue
            sig, node = _as_sig(batch["sig"]), batch["node"].to_numpy()
            for seed in seeds:
                rows, path = _chosen(sig, np.full(len(node), seed, np.uint64), threshold)
                for _ in range(levels - 1):
                    deeper, path = _chosen(sig[rows], path, threshold)
                    rows = rows[deeper]
                yield pd.DataFrame({"bucket": path.view(np.int64), "node": node[rows]})

    return run


def _split(threshold: float, captured: float, related: float):
    """Map members of large buckets, each with its pivot's signature, to edges (kind 0) and new members (kind 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sig, pivot_sig, node = _as_sig(batch["sig"]), _as_sig(batch["pivot_sig"]), batch["node"].to_numpy()
            same = (sig == pivot_sig).mean(axis=1)
            near = same >= related
            yield pd.DataFrame({"kind": 0, "a": node[near], "b": batch["pivot"].to_numpy()[near]})
            rest = same < captured
            rows, path = _chosen(sig[rest], batch["bucket"].to_numpy()[rest].view(np.uint64), threshold)
            yield pd.DataFrame({"kind": 1, "a": path.view(np.int64), "b": node[rest][rows]})

    return run


def _groups(batches: Iterator[pd.DataFrame], keys: list[str], most_rows: int) -> Iterator[pd.DataFrame]:
    """Frames of whole groups from batches sorted by `keys`, about `most_rows` rows in each. A group must be bounded."""
    held: list[pd.DataFrame] = []
    rows = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows += len(batch)
        if rows < most_rows:
            continue
        frame = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = len(frame) - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield frame.iloc[:cut].reset_index(drop=True)
        held = [frame.iloc[cut:]]
        rows = len(frame) - cut
    if held:
        frame = pd.concat(held, ignore_index=True)
        if len(frame):
            yield frame


class Forest:
    """Union-find on 0..n-1 with the smallest member as root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        up = self.up
        while len(left):
            a, b = up[left], up[right]
            low, high = np.minimum(a, b), np.maximum(a, b)
            differ = low != high
            if not differ.any():
                break
            left, right, low, high = left[differ], right[differ], low[differ], high[differ]
            np.minimum.at(up, high, low)
            while True:
                above = up[up]
                if (above == up).all():
                    break
                up[:] = above


def _brute(related: float):
    """Map members of small buckets, sorted by bucket, to edges (a, b) that span the related ones of each bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["bucket", "i", "j"], 4000):
            sig = _as_sig(frame["sig"])
            node, n = frame["node"].to_numpy(), len(frame)
            change = (frame[["bucket", "i", "j"]].diff() != 0).any(axis=1).to_numpy()
            group = np.cumsum(change)
            forest = Forest(n)
            touched = np.zeros(n, bool)
            lag = 1
            while lag < n:
                left = np.flatnonzero(group[lag:] == group[:-lag])
                if not len(left):
                    break
                for some in np.array_split(left, -(-len(left) // 20_000)):
                    close = some[(sig[some] == sig[some + lag]).mean(axis=1) >= related]
                    forest.join(close, close + lag)
                    touched[close] = touched[close + lag] = True
                lag += 1
            at = np.flatnonzero(touched & (forest.up != np.arange(n)))
            yield pd.DataFrame({"a": node[at], "b": node[forest.up[at]]}).drop_duplicates()

    return run


def _links(size: int, threshold: float):
    """Map blocks of families, sorted by (root, i, j), to links: (node, root of the verified links in the block, count)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for frame in _groups(batches, ["root", "i", "j"], 400):
            out = []
            for (_, i, j), block in frame.groupby(["root", "i", "j"], sort=False):
                block = block.drop_duplicates("node")
                if len(block) < 2:
                    continue
                values, made = shingles(words, block["text"].tolist(), size)
                row = np.repeat(np.arange(len(block)), made)
                linked = _jaccard_at_least(values, row, len(block), threshold)
                own = block["block"].to_numpy()
                if i != j:
                    linked &= own[:, None] != own[None, :]
                np.fill_diagonal(linked, False)
                left, right = np.nonzero(np.triu(linked))
                forest = Forest(len(block))
                forest.join(left, right)
                node = block["node"].to_numpy()
                counts = linked @ block["copies"].to_numpy()
                some = linked.any(axis=1)
                out.append(pd.DataFrame({"node": node[some], "root": node[forest.up[some]], "links": counts[some]}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def _jaccard_at_least(values: np.ndarray, row: np.ndarray, n: int, threshold: float, cells: int = 8_000_000) -> np.ndarray:
    """Which pairs of the n sets have the similarity. Exact: shared members are counted, some columns at a time."""
    order = np.lexsort((row, values))
    values, row = values[order], row[order]
    once = np.ones(len(values), bool)
    once[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[once], row[once]
    sizes = np.bincount(row, minlength=n).astype(np.float64)
    column = np.concatenate([[0], np.cumsum(values[1:] != values[:-1])]) if len(values) else np.zeros(0, int)
    shared = np.bincount(column, minlength=1)[column] > 1
    row, column = row[shared], column[shared]
    common = np.zeros((n, n))
    if len(column):
        column = np.concatenate([[0], np.cumsum(column[1:] != column[:-1])])
        step = max(1, cells // n)
        for first in range(0, int(column[-1]) + 1, step):
            lo, hi = np.searchsorted(column, [first, first + step])
            part = np.zeros((n, step if first + step <= column[-1] else int(column[-1]) + 1 - first), np.float32)
            part[row[lo:hi], column[lo:hi] - first] = 1
            common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    return (common > 0) & (common >= threshold * union - 1e-9)


def text_class(text: Column) -> Column:
    """Documents with one class have the same text but for letter case."""
    return F.unhex(F.sha2(F.lower(F.coalesce(text, F.lit(""))), 256))


def _candidates(reps: DataFrame, runs: int, threshold: float) -> DataFrame:
    """Edges (u, v) whose components hold every pair of at least the threshold."""
    sigs = reps.select("node", "sig")
    related, apart = least_likely(threshold), least_likely(2 * threshold - 1)
    members = materialise(sigs.mapInPandas(_first_level(runs, threshold, LEVELS), "bucket long, node long"), "members")
    small, edges, level = [], [], LEVELS
    while True:
        sizes = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).filter("n > 1")
        live = materialise(members.join(sizes, "bucket").select("bucket", "node", "n", "pivot"), "live")
        brute = live if level > DEPTH else live.filter(F.col("n") <= SMALL_BUCKET)
        # Past the last level a large bucket is dealt into blocks, each pair of which meets once.
        blocks = F.ceil(F.col("n") / (SMALL_BUCKET / 2)).cast("int")
        own = F.pmod(F.xxhash64("node"), blocks).cast("int")
        whole = brute.filter(F.col("n") <= SMALL_BUCKET).select("bucket", "node", F.lit(0).alias("i"), F.lit(0).alias("j"))
        small.append(whole)
        if level > DEPTH:
            dealt = brute.filter(F.col("n") > SMALL_BUCKET).withColumn("own", own).withColumn("k", F.explode(F.sequence(F.lit(0), blocks - 1)))
            small.append(dealt.select("bucket", "node", F.least("own", "k").alias("i"), F.greatest("own", "k").alias("j")))
            break
        large = live.filter(F.col("n") > SMALL_BUCKET)
        if large.isEmpty():
            break
        faced = large.join(sigs, "node").join(sigs.select(F.col("node").alias("pivot"), F.col("sig").alias("pivot_sig")), "pivot")
        # Members of a hot bucket are dealt out evenly before they are compared.
        faced = faced.select("bucket", "node", "sig", "pivot", "pivot_sig").repartition("node", "bucket")
        split = materialise(faced.mapInPandas(_split(threshold, threshold + 0.05, apart), "kind int, a long, b long"), "split")
        edges.append(split.filter("kind = 0").select("a", "b"))
        members = split.filter("kind = 1").select(F.col("a").alias("bucket"), F.col("b").alias("node"))
        level += 1
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    rows = rows.join(sigs, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = rows.select("bucket", "i", "j", "node", "sig").mapInPandas(_brute(related), "a long, b long")
    for more in edges:
        found = found.unionByName(more)
    return found.select(F.col("a").alias("u"), F.col("b").alias("v"))


def ngram_join(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, size: int = SHINGLE_WORDS
) -> DataFrame:
    """Per text class (`class`): group_id, n_links and copies, for documents whose shingle sets resemble each other.

    Words are runs between white space, in lower case; a text of fewer than `size` words is one shingle. Documents that
    differ in letter case only are copies: one class, compared once. n_links counts the other documents of at least the
    threshold, copies included. group_id is the smallest doc_id among all documents reachable over links.

    Null and empty texts, and texts of white space only, resemble nothing: they are in no class of the result. Documents
    without doc_id take part; a group in which no document has one has a null group_id. Repeated rows are copies of one
    another. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    runs = runs_for(recall)
    text, doc_id = with_type(docs, "text", "string"), with_type(docs, "doc_id", "long")
    base = docs.select(doc_id.alias("doc_id"), text_class(text).alias("class"), text.alias("text"))
    signed = base.mapInPandas(_signatures(size), "doc_id long, class binary, sig binary").filter("sig is not null")
    classes = signed.groupBy("class").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
    reps = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    families = components(_candidates(reps, runs, threshold), "families")
    families = materialise(families, "families")
    sizes = families.groupBy("root").agg(F.count("*").alias("n"))
    chosen = families.join(sizes, "root").join(reps.select("node", "class", "copies"), "node")
    # One row of each class brings its text along; the blocks of a large family meet in pairs.
    texts = base.join(chosen.select("class").distinct(), "class", "left_semi")
    texts = texts.groupBy("class").agg(F.first("text").alias("text"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (
        chosen.join(texts, "class")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("root", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "node", "copies", "text")
        .repartition("root", "i", "j")
        .sortWithinPartitions("root", "i", "j")
    )
    links = materialise(dealt.mapInPandas(_links(size, threshold), "node long, root long, links long"), "links")
    linked = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")), "linked")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    placed = reps.select("node", "class", "rep", "copies").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("rep").alias("group_id"))
    return (
        placed.join(least, "root")
        .join(counts, "node", "left")
        .select("class", "group_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "copies")
    )


def mark(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` with group_id, n_links and kept; of each group the document with the smallest doc_id stays.

    A document that resembles no other, or whose text is null or empty, is its own group. Where the smallest doc_id
    occurs in several rows, all of them are marked as kept; `survivors` leaves one. Columns of `docs` called like an
    added one are replaced.
    """
    marked, added = _marked(docs, **settings), ["group_id", "n_links", "kept"]
    return marked.select(*[F.col(f"carried_row.`{c}`") for c in docs.columns if c not in added], *added)


def _marked(docs: DataFrame, **settings) -> DataFrame:
    """Each row of `docs` as `carried_row`, with doc_id, class, group_id, n_links and kept."""
    rows = carried(docs, ("doc_id", "long"), ("text", "string"))
    classes = materialise(ngram_join(rows.select("doc_id", "text"), **settings), "joined")
    base = rows.select("carried_row", "doc_id", text_class(F.col("text")).alias("class"))
    return (
        base.join(classes.select("class", "group_id", "n_links", F.lit(True).alias("grouped")), "class", "left")
        .withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))
        .withColumn("group_id", F.when(F.col("grouped"), F.col("group_id")).otherwise(F.col("doc_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("group_id"), F.col("group_id").isNull()))
        .drop("grouped")
    )


def survivors(docs: DataFrame, **settings) -> DataFrame:
    """The rows that stay, one for each doc_id and group, with the columns of `docs`. Empty texts all stay."""
    marked = _marked(docs, **settings)
    order = Window.partitionBy("class", "doc_id").orderBy("class")
    stays = marked.filter("kept").withColumn("nth", F.row_number().over(order)).filter("nth = 1")
    return stays.select("carried_row.*")
