"""The stages of the pipeline, each against a plain version of itself on what the one before it kept."""

import brute
import corpus_pipeline
import pytest

from gridlake.llm import packing, pii, toxicity
from gridlake.llm.common import table
from gridlake.workspace import materialise

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SF), name)
        out.append((before, docs))
    return dict(zip([name for name, _ in corpus_pipeline.STAGES], out))


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns and after.count() > 0, name


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.trained(before, table(spark, SF, "labels"))
    scored = toxicity.score(before, model).select("doc_id", "toxicity.score").collect()
    assert set(texts(after)) == {r.doc_id for r in scored if r.score < toxicity.THRESHOLD}
    assert after.count() < before.count()


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    last = {}
    for i, text in sorted(texts(before).items()):
        last["".join(c.lower() if "A" <= c <= "Z" else c for c in text)] = i
    assert set(texts(after)) == set(last.values())


def test_near_stage(stages):
    before, after = stages["ngram_join"]
    rows = sorted(texts(before).items())
    roots = brute.groups(len(rows), brute.jaccard_pairs([t for _, t in rows]))
    assert set(texts(after)) == {rows[i][0] for i in set(roots)}


def test_pii_stage(stages):
    before, after = stages["pii"]
    own, out = texts(before), texts(after)
    assert set(own) == set(out)
    model = pii.fit(before)
    spans = {r.doc_id: r.pii for r in pii.annotate(before, model).select("doc_id", "pii").collect()}
    assert all(own[i][s.begin : s.end] not in out[i] or s.kind not in ("email", "phone") for i in own for s in spans[i])
    assert all(out[i] == own[i] for i in own if not spans[i])


def test_packing_stage(stages):
    before, after = stages["packing"]
    sizes = {}
    for r in after.collect():
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.size
        assert r.size <= packing.CAPACITY
    assert sizes == {i: len(t) for i, t in texts(before).items()}


def test_empty_corpus(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
