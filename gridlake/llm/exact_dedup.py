"""Exact dedup by deterministic block naming.

Texts are cut into blocks of a fixed size. Blocks that occur more than once are sorted, and their rank order gives them
integer names: equal names mean equal blocks, compared by content and not by a fingerprint. Adjacent names form pairs,
which are sorted and named in the same way, until a document has one name left. Number of blocks and last name together
are an identity without collisions.

A block, or a pair of names, that occurs once proves that no other document equals the one that holds it. Such documents
leave at once, so the levels above the first see little of a corpus that is mostly unique.

Only DataFrame functions; grouping combines before each shuffle, and each group of copies is one row from then on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import ascii_lower, carried, with_type
from gridlake.workspace import materialise

BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    """What is compared: null as empty, A to Z in lower case."""
    return F.coalesce(ascii_lower(text), F.lit(""))


def _blocks(text: Column, size: int) -> Column:
    """The text in blocks of `size` characters; the empty text has one empty block."""
    return F.when(F.char_length(text) <= size, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))


def _named(values: DataFrame, *columns: str) -> DataFrame:
    """Integer names, in sorted order, for the combinations of `columns` that occur more than once."""
    repeated = values.groupBy(*columns).agg(F.count("*").alias("times")).filter("times > 1").drop("times")
    # Ranges are cut on the first characters, so that the sample for the cuts stays small; a hash splits a common beginning.
    heads = [F.substring(c, 1, 32) if dict(repeated.dtypes)[c] == "string" else F.col(c) for c in columns]
    ordered = repeated.repartitionByRange(*heads, F.xxhash64(*columns)).sortWithinPartitions(*columns)
    return materialise(ordered.select(*columns, F.monotonically_increasing_id().alias("name")), "names")


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row `(row_key, keep_id, group_size)` for each document whose text occurs more than once.

    `row_key` is doc_id and digest of the normalised text. Rows with one doc_id and one text are one document listed
    repeatedly: they share a key, count separately in `group_size` and get the same answer.
    """
    text = normalised(with_type(docs, "text", "string"))
    doc_id = with_type(docs, "doc_id", "long")
    # The digest is taken after the cut into blocks, so that the normalised text is made once.
    cut = docs.select(doc_id.alias("doc_id"), text.alias("text")).select("doc_id", F.sha2("text", 256).alias("sha"), _blocks(F.col("text"), block_chars).alias("blocks"))
    rows = cut.select("doc_id", row_key(F.col("doc_id"), F.col("sha")).alias("row_key"), F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("place", "block"))
    blocks = docs.select(F.explode(_blocks(text, block_chars)).alias("block"))
    names = _named(blocks, "block")
    level = rows.join(names, "block").groupBy("row_key", "doc_id", "n_blocks", "place").agg(F.first("name").alias("name"), F.count("*").alias("times"))
    level = materialise(level, "level")
    done, width = level.filter("n_blocks = 1"), 1
    level = level.filter("n_blocks > 1")
    most = level.agg(F.max("n_blocks")).first()[0] or 0
    while width < most:
        # A level of the documents with more than `width` blocks: names of adjacent positions become pairs.
        pairs = (
            level.groupBy("row_key", "doc_id", "n_blocks", F.floor(F.col("place") / 2).cast("int").alias("place"))
            .agg(
                F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("first"),
                F.max(F.when(F.col("place") % 2 == 1, F.col("name"))).alias("second"),
                F.max("times").alias("times"),
            )
            # An odd last block has no partner and -1 stands in; any other gap means a unique part.
            .withColumn("alone", F.expr(f"(n_blocks + {width - 1}) div {width} = 2 * place + 1"))
            .filter("first is not null and (second is not null or alone)")
            .withColumn("second", F.coalesce("second", F.lit(-1)))
        )
        pairs = materialise(pairs, "pairs")
        # Repeated rows are several occurrences.
        repeated = pairs.groupBy("first", "second").agg(F.sum("times").alias("total")).filter("total > 1").drop("total")
        ordered = repeated.repartitionByRange("first", "second").sortWithinPartitions("first", "second")
        names = materialise(ordered.select("first", "second", F.monotonically_increasing_id().alias("name")), "names")
        width *= 2
        level = pairs.join(names, ["first", "second"]).select("row_key", "doc_id", "n_blocks", "place", "name", "times")
        level = materialise(level, "level")
        done = done.unionByName(level.filter(F.col("n_blocks") <= width))
        level = level.filter(F.col("n_blocks") > width)
    groups = done.groupBy("n_blocks", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size"))
    return done.join(groups.filter("group_size > 1"), ["n_blocks", "name"]).select("row_key", "keep_id", "group_size")


def row_key(doc_id: Column, sha: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), sha)


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs` with keep_id, group_size, kept and text_sha256 added.

    Texts are equal when they are the same after lower-casing A-Z; a null text counts as empty and equals the empty
    text. Of equal texts the largest doc_id stays; null doc_ids rank below all others, and if all are null, they stay.
    A doc_id that occurs several times with one text is kept, or not, in each of its rows; `survivors` leaves one of
    them. Columns of `docs` called like an added one are replaced. An empty table gives an empty result.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256", "row_key"]
    base = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in added],
        F.sha2(normalised(with_type(docs, "text", "string")), 256).alias("text_sha256"),
    ).withColumn("row_key", row_key(with_type(docs, "doc_id", "long"), F.col("text_sha256")))
    found = materialise(identities(docs, block_chars), "identities")
    doc_id = with_type(docs, "doc_id", "long")
    return (
        base.join(found, "row_key", "left")
        .withColumn("keep_id", F.when(F.col("group_size").isNull(), doc_id).otherwise(F.col("keep_id")))
        .withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long"))
        .withColumn("kept", F.coalesce(doc_id == F.col("keep_id"), F.col("keep_id").isNull()))
    )


def survivors(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that stay, one row for each text, with the columns of `docs`."""
    marked = exact_dedup(carried(docs, ("doc_id", "long"), ("text", "string")), block_chars)
    # A document that is listed repeatedly is kept in each of its rows.
    order = Window.partitionBy("row_key").orderBy("row_key")
    return marked.filter("kept").withColumn("nth", F.row_number().over(order)).filter("nth = 1").select("carried_row.*")
