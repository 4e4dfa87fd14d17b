"""Quality votes against plain sums, and held-out accuracy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import quality as q
from gridlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark):
    return q.trained(*[spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")])


def test_votes_against_plain_sums(model):
    texts = ["The thing. And so on, the end", "THE!! END!!", "a | b | c", "go go go go", "one", "x" * 1000]
    got = model.scores(q.Terms().counts(texts), neighbours=9)
    for vector, score in zip(model.latent(q.Terms().counts(texts)).astype(float), got):
        near = [math.fsum(vector * other) for other in model.vectors.astype(float)]
        last = sorted(near)[-9]
        votes = [(max(0.0, s) ** q.SHARPNESS * v, y) for s, v, y in zip(near, model.votes, model.labels) if s >= last - 1e-6]
        assert score == pytest.approx(sum(w * y for w, y in votes) / sum(w for w, _ in votes), abs=1e-4)


def test_terms():
    assert [q.shape(w) for w in ("Hello", "THE!!", "ab12c", "|", "e.g.,", "Éa")] == ["Aa", "A!", "a0a", "|", "a.a.,", "Aa"]
    one, both = q.Terms().counts(["go go on"]), q.Terms(most=1).counts(["go go on", "on go go"])
    assert one[0].sum() == 3 * 3 and one[0, -2:].tolist() == [1, 2]
    assert (both[0] == one[0]).all() and (both[1] == one[0]).all()


def test_axes_are_those_of_the_sample():
    """Latent cosines are the cosines of the weighted vectors while there are as many axes as texts."""
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (20, q.TERMS)).astype(np.float32)
    model = q.fit(counts, np.arange(20) % 2, 0.5)
    full = q._unit(q._weighted(counts, model.idf))
    assert np.allclose(model.vectors @ model.vectors.T, full @ full.T, atol=1e-3)


def test_held_out(spark):
    got = QUERIES["op12_quality"](spark, "/root/testdata/sf0.1").filter("held_out")
    both = got.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").select("score", "predicted", "quality").collect()
    assert all((r.score >= 0.3) == r.predicted and 0 <= r.score <= 1 for r in both)
    for label in (0, 1):
        own = [r.predicted == label for r in both if r.quality == label]
        assert len(own) > 50 and sum(own) / len(own) > 0.95


def test_odd_rows(spark, model):
    rows = [(1, "fine text here"), (1, "fine text here"), (2, None), (3, ""), (4, " \n\t"), (None, "some text"), (5, "word " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality_score", F.lit("x")).withColumn("y", F.lit(1)).withColumn("h", F.lit(2))
    out = q.score(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r.quality_score <= 1 and r.y == 1 and r.h == 2 for r in out)
    assert {r.quality_score for r in out if r.doc_id in (2, 3, 4)} == {model.share}
    assert len({r.quality_score for r in out if r.doc_id == 1}) == 1
    assert q.score(docs.limit(0), model).count() == 0
    assert q.score(docs.select("doc_id"), model).filter(F.col("quality_score") == model.share).count() == len(rows)


@pytest.mark.parametrize("labels, expected", [([], 0.5), ([(i, 1) for i in range(30)], 1.0), ([(i, 0) for i in range(30)] + [(1, None), (None, 1)], 0.0)])
def test_few_labels(spark, labels, expected):
    docs = spark.createDataFrame([(i, f"text number {i} of many") for i in range(30)] + [(None, "x"), (3, None)], "doc_id long, text string")
    docs = docs.withColumn("y", F.lit("y")).withColumn("quality", F.lit("q"))
    model = q.trained(docs, spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("z")))
    assert {round(r.quality_score, 6) for r in q.score(docs, model).collect()} == {expected}


def test_a_document_with_both_labels_is_bad(spark):
    ids = [i for i in range(40) if __import__("zlib").crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    both = spark.createDataFrame([(i, y) for i in ids for y in (1, 0, 1)], "doc_id long, quality int")
    counts, labels, share = q.sample(docs, both)
    assert len(counts) == len(ids) and not labels.any() and share == 0
