"""Redaction at block edges, and of texts with very many spans."""

import random
import time

import pytest
from pyspark.sql import functions as F

from gridlake.llm import pii


def plain(text, spans):
    out, at = "", 0
    for s in sorted(spans, key=lambda s: (s.begin, s.end)):
        if s.begin >= at:
            out += text[at : s.begin] + f"<{s.kind.upper()}>"
        at = max(at, s.end)
    return out + text[at:]


@pytest.mark.parametrize(("part", "block"), [(1, 1), (2, 3), (3, 7), (128, 2048)])
def test_every_edge(spark, monkeypatch, part, block):
    """Spans that touch, overlap and cross blocks, with characters of two code units in between."""
    monkeypatch.setattr(pii, "PART", part)
    monkeypatch.setattr(pii, "BLOCK", block)
    rng = random.Random(part)
    bits = ["a@b.de", "1.2.3.4", "+49 (30) 1234567.8.9.1", "4111 1111 1111 1111", "x", " ", "\U0001f600", "\n", "é", "u@1.2.3.4", "card 12345678901"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None, "", "a@b.de", "no span"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_chars", F.lit(0))
    model = pii.Model()
    spans = {r.doc_id: r.pii for r in pii.annotate(docs, model, 0.4).collect()}
    found = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs, model, 0.4).collect()}
    want = {i: (t if t is None else plain(t, spans[i])) for i, t in enumerate(texts)}
    assert found == {i: (t, t if t is None else len(t)) for i, t in want.items()}


def test_a_text_of_very_many_addresses(spark):
    text = " ".join(f"user{i}@host{i % 7}.org" for i in range(200_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.time()
    row = pii.redact(docs, pii.Model()).first()
    print("seconds", time.time() - begin)
    assert row.text == " ".join(["<EMAIL>"] * 200_000)
