"""Near copies among embeddings by an inverted multi-index.

Each half of a vector has a codebook of its own; pairs of codes form a product grid of cells. A vector lies in the cell of
its nearest codes, and visits the cells nearest to it, in the order of the sum of both distances, until the target recall.
In each cell the visitors are compared with the residents by exact cosine in double precision.

How many cells are visited is measured, not guessed: on a sample, partners at exactly the threshold are drawn in random
directions, and the number is the least for which the target share of pairs meets. The number of codes grows with the
square root of the number of vectors, so that a cell holds about the same number of vectors at any size.

A pair can meet in two cells. The visit of the vector itself counts; a visit by the other one counts only where the vector
doesn't visit in turn. Counts are therefore exact for what is found, without a list of pairs: what leaves a cell is a count
and a spanning edge for each vector. Equal vectors are one with a number of copies.

Vectors of different lengths never meet. Each length has cells of its own, and each with more than `EXACT` vectors, the most
common one in any case, an index of its own; vectors of a rarer length are all compared, in blocks.

A vector travels once to each cell that it visits, in the precision that it came in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import carried, components, small_batches, with_type
from gridlake.llm.ngram_join import Forest, _groups
from gridlake.workspace import materialise

THRESHOLD = 0.9
RECALL = 0.97
OCCUPANCY = 400  # vectors in a cell, on average
SAMPLE = 8_192  # vectors that codebooks and the number of visits are fitted on
BLOCK = 2_048
EXACT = 20_000  # vectors of a length that are compared without an index


def _units(keys: pd.Series, dim: int) -> np.ndarray:
    """Unit vectors in doubles from the numbers of vectors of one length; the size of a key tells floats from doubles."""
    data = b"".join(keys)
    x = np.frombuffer(data, np.float32 if len(data) == 4 * dim * len(keys) else np.float64).astype(np.float64).reshape(len(keys), dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _kind(vectors: DataFrame) -> str:
    """The type that embeddings are read as: floats stay floats."""
    given = vectors.schema["embedding"].dataType.simpleString() if "embedding" in vectors.columns else ""
    return given if given == "array<float>" else "array<double>"


def _keys(column: pd.Series, kind: str) -> tuple[list[bytes | None], list[int]]:
    """The numbers of each usable vector, null for others, and how many they are."""
    keys, dims = [], []
    for vector in column:
        x = None if vector is None else np.asarray(vector, np.float32 if kind == "array<float>" else np.float64) + 0
        usable = x is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
        if usable and x.dtype == np.float64 and not 1e-150 <= np.abs(x).max() <= 1e150:
            x = x / np.abs(x).max()  # the squares of the length would overflow or vanish
        keys.append(x.tobytes() if usable else None)
        dims.append(len(x) if usable else 0)
    return keys, dims


def _keyed(kind: str):
    """Map (vec_id, embedding) to (vec_id, key, dim)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, dims = _keys(batch["embedding"], kind)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "key": keys, "dim": dims})

    return run


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spread sample points; empty codes stay where they are."""
    codes = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = _distances(x, codes).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(codes)
        np.add.at(sums, own, x)
        codes[n > 0] = sums[n > 0] / n[n > 0, None]
    return codes


def _distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes**2).sum(axis=1)[None, :]


class Index:
    """Codebooks of both halves and the number of cells to visit."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int = 1):
        self.first, self.second, self.visits = first, second, visits

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The cells that each vector visits, nearest first; the first one is its own."""
        half = self.first.shape[1]
        left, right = _distances(x[:, :half], self.first), _distances(x[:, half:], self.second)
        visits = min(self.visits, left.shape[1] * right.shape[1])
        a, b = np.argsort(left, axis=1, kind="stable"), np.argsort(right, axis=1, kind="stable")
        left, right = np.take_along_axis(left, a, axis=1), np.take_along_axis(right, b, axis=1)
        # At least (i + 1) * (j + 1) - 1 cells come before the one of the i-th and j-th nearest codes.
        i, j = np.nonzero(np.add.outer(np.arange(left.shape[1]), 1)[:, None] * np.arange(1, right.shape[1] + 1)[None, :] <= visits)
        order = np.argsort(left[:, i] + right[:, j], axis=1, kind="stable")[:, :visits]
        return np.take_along_axis(a[:, i], order, axis=1) * right.shape[1] + np.take_along_axis(b[:, j], order, axis=1)


def fit(sample: np.ndarray, vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> Index:
    """An index for so many vectors, from a sample of unit vectors."""
    half = sample.shape[1] // 2
    k = max(1, min(len(sample) // 4, round(math.sqrt(vectors / OCCUPANCY))))
    if not half or k < 2:
        return Index(np.zeros((1, half)), np.zeros((1, sample.shape[1] - half)))
    index = Index(codebook(sample[:, :half], k), codebook(sample[:, half:], k))
    random = np.random.default_rng(5)
    x = sample[random.permutation(len(sample))[:1024]]
    noise = random.standard_normal(x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = threshold * x + math.sqrt(1 - threshold**2) * noise
    index.visits = k * k
    rank = np.minimum(*[(there == home[:, :1]).argmax(axis=1) for there, home in ((index.cells(x), index.cells(y)), (index.cells(y), index.cells(x)))])
    index.visits = int(np.sort(rank)[min(len(rank) - 1, math.ceil(recall * len(rank)) - 1)]) + 1
    return index


def _visits(indexes: dict[int, Index]):
    """Map (node, key, dim, copies) to the same rows with `cells`: the cells to visit, the own one first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                index = indexes.get(int(dim))
                cells = np.zeros((len(own), 1), np.int64) if index is None else index.cells(_units(own["key"], int(dim)))
                yield own.assign(cells=list(cells.astype(np.int64)))

    return run


def _dealt(routed: DataFrame, most: int = BLOCK) -> DataFrame:
    """One row for each block in which a vector is a guest or a resident (host) of a cell.

    A cell with at most `most` guests and `most` hosts is one block, in which a resident is its own guest. The blocks of
    guests and those of hosts of a more crowded cell meet each other once.
    """
    spread = routed.select("*", F.posexplode("cells").alias("nth", "cell"))
    sizes = spread.groupBy("dim", "cell").agg(F.count("*").alias("guests"), F.sum((F.col("nth") == 0).cast("long")).alias("hosts"))
    # A written table of the few cells that are empty or crowded: the planner sees how small it is.
    special = materialise(sizes.filter((F.col("hosts") == 0) | (F.col("guests") > most) | (F.col("hosts") > most)), "cells")
    resident = F.col("nth") == 0
    n_i, n_j = (F.ceil(F.coalesce(c, F.lit(1)) / most).cast("int") for c in ("guests", "hosts"))
    mine = lambda blocks: F.pmod(F.xxhash64("node"), blocks).cast("int")
    place = lambda i, j, guest, host: F.struct(i.alias("i"), j.alias("j"), guest.alias("guest"), host.alias("resident"))
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0)
    as_guest = F.transform(F.sequence(zero, n_j - 1), lambda j: place(mine(n_i), j, yes, no))
    as_host = F.transform(F.sequence(zero, n_i - 1), lambda i: place(i, mine(n_j), no, yes))
    places = F.when((n_i == 1) & (n_j == 1), F.array(place(zero, zero, yes, resident))).when(resident, F.concat(as_guest, as_host)).otherwise(as_guest)
    rows = spread.join(special, ["dim", "cell"], "left").filter(F.coalesce("hosts", F.lit(1)) > 0)
    return rows.select("node", "key", "dim", "copies", "cell", F.col("cells")[0].alias("home"), "cells", F.explode(places).alias("p")).select(
        "node", "key", "dim", "copies", "cell", "home", F.when(F.col("p.resident"), F.col("cells")).alias("visits"), "p.*"
    )


def _links(threshold: float):
    """Map visitors and residents of cells, sorted by cell and block, to (node, root, links)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["dim", "cell", "i", "j"], 2000):
            for (dim, *_), group in frame.groupby(["dim", "cell", "i", "j"], sort=False):
                guests, hosts = group[group["guest"]], group[group["resident"]]
                if not len(guests) or not len(hosts):
                    continue
                x, y = _units(guests["key"], int(dim)), _units(hosts["key"], int(dim))
                a, b = guests["node"].to_numpy(), hosts["node"].to_numpy()
                left, right = np.nonzero(x @ y.T >= threshold)
                differ = a[left] != b[right]
                left, right = left[differ], right[differ]
                if not len(left):
                    continue
                # Whether the host visits the guest's own cell in turn: asked once for each cell that guests come from.
                homes, which = np.unique(guests["home"].to_numpy(), return_inverse=True)
                lists = np.stack(hosts["visits"].to_list())
                returned = np.stack([(lists == home).any(axis=1) for home in homes])[which[left], right]
                to_guest = np.bincount(left, hosts["copies"].to_numpy()[right], len(a))
                to_host = np.bincount(right, np.where(returned, 0, guests["copies"].to_numpy()[left]), len(b))
                nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                forest = Forest(len(nodes))
                forest.join(at[: len(a)][left], at[len(a) :][right])
                links = np.bincount(at, np.concatenate([to_guest, to_host]), len(nodes)).astype(np.int64)
                touched = np.zeros(len(nodes), bool)
                touched[at[: len(a)][left]] = touched[at[len(a) :][right]] = True
                yield pd.DataFrame({"node": nodes[touched], "root": nodes[forest.up[touched]], "links": links[touched]})

    return run


def near_links(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, index: Index | None = None) -> DataFrame:
    """The rows of `vectors` with n_links, component_id and kept (vec_id = component_id).

    Two vectors link if their cosine is at least the threshold. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing; neither do vectors of different lengths. Each of those that link with
    nothing is its own component. Repeated rows are copies of one another. A null vec_id takes part; where all ids of a
    component are null, component_id is null and kept is true. Columns of `vectors` called like an added one are
    replaced. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kind = _kind(vectors)
    vec_id = with_type(vectors, "vec_id", "long")
    base = vectors.select(vec_id.alias("vec_id"), with_type(vectors, "embedding", kind).alias("embedding"))
    keyed = base.mapInPandas(_keyed(kind), "vec_id long, key binary, dim int").filter("key is not null")
    reps = keyed.groupBy("key", "dim").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = materialise(reps.withColumn("node", F.monotonically_increasing_id()), "vectors")
    lengths = reps.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim")
    indexes = {}
    for dim, n in {*lengths.limit(1).collect(), *lengths.filter(F.col("n") > EXACT).collect()}:
        if index is not None and dim == index.first.shape[1] + index.second.shape[1]:
            indexes[dim] = index
            continue
        picked = reps.filter(F.col("dim") == dim).orderBy(F.xxhash64("key")).limit(SAMPLE).select("key").collect()
        indexes[dim] = fit(_units(pd.Series([bytes(row.key) for row in picked]), dim), n, threshold, recall)
    routed = reps.select("node", "key", "dim", "copies").mapInPandas(_visits(indexes), "node long, key binary, dim int, copies long, cells array<long>")
    # A block is read as one group: several tasks share a crowded cell, one task several small cells.
    block = ["dim", "cell", "i", "j"]
    dealt = _dealt(materialise(routed, "visits")).repartition(*block).sortWithinPartitions(*block)
    found = materialise(dealt.mapInPandas(_links(threshold), "node long, root long, links long"), "links")
    linked = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "linked")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = reps.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = placed.join(least, "root").join(counts, "node", "left")
    classes = classes.select(F.col("key").alias("vector_key"), "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.lit(True).alias("grouped"))
    added = ["n_links", "component_id", "kept"]

    @F.pandas_udf("binary")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series(_keys(series, kind)[0], dtype=object)

    rows = carried(vectors, ("vec_id", "long"), ("embedding", kind))
    rows = rows.select("carried_row", "vec_id", keys(F.col("embedding")).alias("vector_key")).join(classes, "vector_key", "left")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.withColumn("component_id", component).select(
        *[F.col(f"carried_row.`{c}`") for c in vectors.columns if c not in added],
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )
