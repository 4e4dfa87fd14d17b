"""From raw documents to packed training sequences: five stages, each one operator of `gridlake.llm`.

A stage takes the documents that the one before it kept and returns what it keeps, with the columns of documents; the last
one returns where each piece of text goes. `run` writes each stage to the shared workspace and reads it back, so that a
lost executor repeats one stage only, and each stage is planned from real sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import exact_dedup, ngram_join, packing, pii, toxicity
from gridlake.llm.common import carried, table
from gridlake.workspace import materialise


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, doesn't call toxic."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(carried(docs, ("text", "string")), model)
    return scored.filter(F.col("toxicity.score") < toxicity.THRESHOLD).select("carried_row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, letter case A-Z aside."""
    return exact_dedup.survivors(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more on shingles of five words."""
    return ngram_join.survivors(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of training text: one row for each piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("pii", without_personal_data),
    ("packing", packed),
]

# The first stage applies a trained model, which SQL can't express; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
