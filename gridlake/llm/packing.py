"""Best-fit packing with conflicts.

Documents are cut into pieces of at most one bin. Open bins are held in the order of the room they have left, and each
carries a bitmap of the sources and one of the duplicate clusters in it. A piece goes to the tightest bin that has the room
and shares no bit with it: the search starts at the first bin with enough room and follows the order until one is
compatible. Bins stand in runs, and each run knows the bits that all its bins have in common, so a run in which every bin
conflicts is passed over as a whole.

The work is dealt into shards of a bounded number of pieces, by a hash of the document and not by source or cluster, so a
hot source is spread over all shards. Bins belong to one shard; each shard leaves a few open bins at its end. What goes
through a shard is (document, size, source, cluster), never text.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import small_batches, with_type
from gridlake.workspace import materialise

CAPACITY = 16_384
SHARD_PIECES = 8_000
RUN = 48
_ALL = -1


class Run:
    """A few open bins in the order of (room, bin), and the bits that all of them have."""

    __slots__ = ("bins", "clusters", "sources")

    def __init__(self, bins: list[tuple[int, int]], state: dict[int, tuple[int, int]]):
        self.bins = bins
        self.count(state)

    def count(self, state) -> None:
        self.sources = self.clusters = _ALL
        for _, b in self.bins:
            sources, clusters = state[b]
            self.sources &= sources
            self.clusters &= clusters


class OpenBins:
    """Bins by the room left. Bitmaps are whole numbers with one bit for each source or cluster of the shard."""

    def __init__(self, capacity: int):
        self.capacity, self.runs, self.state, self.made = capacity, [], {}, 0

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin that takes the piece, and the offset in it. A null source or cluster has no bit (0) and no conflict."""
        state, runs = self.state, self.runs
        for at in range(bisect_left(runs, size, key=lambda run: run.bins[-1][0]), len(runs)):
            run = runs[at]
            if run.sources & source or run.clusters & cluster:
                continue
            for place in range(bisect_left(run.bins, (size, -1)), len(run.bins)):
                room, b = run.bins[place]
                sources, clusters = state[b]
                if not (sources & source or clusters & cluster):
                    del run.bins[place]
                    if run.bins:
                        run.count(state)
                    else:
                        del runs[at]
                    state[b] = (sources | source, clusters | cluster)
                    self._add(room - size, b)
                    return b, self.capacity - room
        b = self.made
        self.made += 1
        state[b] = (source, cluster)
        self._add(self.capacity - size, b)
        return b, 0

    def _add(self, room: int, b: int) -> None:
        if not room:
            del self.state[b]
            return
        runs, state = self.runs, self.state
        if not runs:
            runs.append(Run([(room, b)], state))
            return
        at = min(bisect_left(runs, (room, b), key=lambda run: run.bins[-1]), len(runs) - 1)
        run = runs[at]
        insort(run.bins, (room, b))
        if len(run.bins) > RUN:
            half = len(run.bins) // 2
            runs.insert(at + 1, Run(run.bins[half:], state))
            run.bins = run.bins[:half]
            run.count(state)
        else:
            sources, clusters = state[b]
            run.sources &= sources
            run.clusters &= clusters


def _bits(values: list) -> list[int]:
    """One bit for each distinct value; nothing for null."""
    seen: dict = {}
    return [0 if value is None else 1 << seen.setdefault(value, len(seen)) for value in values]


def _pack(capacity: int):
    """Map the pieces of a shard, sorted by falling size, to their bins."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held = None, []
        for batch in batches:
            for key, part in batch.groupby("shard", sort=False):
                if held and key != shard:
                    yield packed(pd.concat(held))
                    held = []
                shard = key
                held.append(part)
        if held:
            yield packed(pd.concat(held))

    def packed(pieces: pd.DataFrame) -> pd.DataFrame:
        bins = OpenBins(capacity)
        plain = [None if pd.isna(x) else x for x in pieces["source"]], [None if pd.isna(x) else x for x in pieces["cluster"]]
        places = [bins.place(*piece) for piece in zip(pieces["size"].tolist(), _bits(plain[0]), _bits(plain[1]))]
        return pieces.assign(bin=[b for b, _ in places], offset=[o for _, o in places]).drop(columns=["source", "cluster"])

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row for each piece: doc_id, piece, begin, size, bin_id, bin_offset, bin_used (sizes in characters).

    A bin holds at most one document of a source and one of a duplicate cluster (equal texts, letter case aside). Pieces
    of `capacity` characters that a long document is cut into fill a bin each; the rest of it is packed. Pieces are
    placed by falling size, ties by doc_id. A null source conflicts with nothing.

    Null and empty texts make one piece of size 0, which takes no room: bin_id is null. Repeated rows are packed as often
    as they occur, into different bins. Null doc_ids are packed like others. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(with_type(docs, "text", "string"), F.lit(""))
    source = with_type(docs, "source", "string")
    narrow = docs.select(
        with_type(docs, "doc_id", "long").alias("doc_id"),
        F.char_length(text).cast("long").alias("length"),
        source.alias("source"),
        F.xxhash64(F.lower(text)).alias("cluster"),
    )
    # A written table: sizes of shards are taken from it, and it fixes what a repeated task sees.
    narrow = materialise(narrow, "lengths")
    shards = max(1, -(-narrow.count() // shard_pieces))
    pieces = narrow.withColumn("full", F.floor(F.col("length") / capacity)).withColumn("rest", F.col("length") % capacity)
    whole = pieces.filter("full > 0").withColumn("piece", F.explode(F.expr("sequence(0, full - 1)")))
    whole = whole.select("doc_id", "piece", (F.col("piece") * capacity).alias("begin"), F.lit(capacity).cast("long").alias("size"))
    # A hash of the whole row and a number deal repeated rows out as well.
    rest = (
        pieces.filter("rest > 0")
        .select(
            F.pmod(F.xxhash64("doc_id", "cluster", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"),
            "doc_id",
            F.col("full").alias("piece"),
            (F.col("full") * capacity).alias("begin"),
            F.col("rest").alias("size"),
            "source",
            "cluster",
        )
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", F.desc("size"), "doc_id", "cluster", "source")
    )
    kind = "shard int, doc_id long, piece long, begin long, size long, bin long, offset long"
    placed = rest.mapInPandas(_pack(capacity), kind)
    placed = materialise(placed, "placed")
    used = placed.groupBy("shard", "bin").agg(F.sum("size").alias("bin_used"))
    part = placed.join(used, ["shard", "bin"]).select(
        "doc_id", "piece", "begin", "size", F.concat_ws("-", "shard", "bin").alias("bin_id"), F.col("offset").alias("bin_offset"), "bin_used"
    )
    own = whole.select(
        "doc_id", "piece", "begin", "size",
        F.concat_ws("-", F.lit("full"), F.monotonically_increasing_id()).alias("bin_id"),
        F.lit(0).cast("long").alias("bin_offset"), F.col("size").alias("bin_used"),
    )
    nothing = F.lit(None)
    empty = narrow.filter("length = 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("size"),
        nothing.cast("string").alias("bin_id"), nothing.cast("long").alias("bin_offset"), nothing.cast("long").alias("bin_used"),
    )
    return part.unionByName(own).unionByName(empty)


def with_texts(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """The packed pieces with their text; doc_id must be unique and not null in `docs`."""
    texts = docs.select(with_type(docs, "doc_id", "long").alias("doc_id"), with_type(docs, "text", "string").alias("text"))
    piece = F.substring(F.coalesce("text", F.lit("")), F.col("begin") + 1, F.col("size"))
    return packed.join(texts, "doc_id").withColumn("text", piece)
