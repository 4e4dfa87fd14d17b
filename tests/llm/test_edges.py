"""Every operator on null, empty, long, repeated and oddly shaped input."""

import pytest
from pyspark.sql import functions as F

from gridlake.llm import (
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    ngram_join,
    packing,
    pii,
    piece_codec,
    toxicity,
    url_filters,
)

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
LONG = "wort " * 40_000 + "x" * 60_000

DOCS = "doc_id long, text string, lang string, source string, kept string, class string, score double, pii string"
ROWS = [
    (1, "Hello there general reader of this", "en", "a", None, None, None, None),
    (1, "Hello there general reader of this", "en", "a", None, None, None, None),
    (2, "HELLO there general reader of this", None, None, "x", "y", 1.0, "z"),
    (3, None, None, None, None, None, None, None),
    (4, "", None, None, None, None, None, None),
    (5, " \n\t ", "en", "b", None, None, None, None),
    (None, "no identity at all", "en", "b", None, None, None, None),
    (None, None, None, None, None, None, None, None),
    (6, LONG, "de", "b", None, None, None, None),
    (7, LONG, "de", "b", None, None, None, None),
]

TEXT_OPERATORS = {
    "exact_dedup": exact_dedup.exact_dedup,
    "ngram_join": ngram_join.mark,
    "pii": lambda d: pii.annotate(d, pii.fit(d)),
    "redact": lambda d: pii.redact(d, pii.fit(d)),
    "license_scan": license_scan.scan,
    "language_id": lambda d: language_id.identify(d, language_id.trained(d)),
    "toxicity": lambda d: toxicity.score(d, toxicity.Model()),
    "piece_codec": lambda d: piece_codec.encode(d, PIECES),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_odd_rows(spark, docs, name):
    """One row out for each row in, with the other columns as they were."""
    out = TEXT_OPERATORS[name](docs)
    found = out.select("doc_id", "lang").collect()
    assert sorted(map(str, found)) == sorted(map(str, docs.select("doc_id", "lang").collect()))
    assert len(set(out.columns)) == len(out.columns)


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_empty_table(spark, name):
    assert TEXT_OPERATORS[name](spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_only_nulls(spark, name):
    rows = [(None,) * 8] * 3
    assert TEXT_OPERATORS[name](spark.createDataFrame(rows, DOCS)).count() == 3


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.filter("doc_id is not null").select("doc_id", *columns).collect()}


def test_exact_dedup_answers(docs):
    out = by_id(exact_dedup.exact_dedup(docs), "keep_id", "group_size", "kept")
    assert out[1] == (2, 3, False) and out[2] == (2, 3, True)
    # Null counts as empty; the null doc_id of the third such row ranks below the others.
    assert out[3] == (4, 3, False) and out[4] == (4, 3, True)
    assert out[6] == (7, 2, False) and out[7] == (7, 2, True)
    assert out[5] == (5, 1, True)


def test_exact_dedup_survivors(spark, docs):
    kept = exact_dedup.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "4", "5", "7", "None"]
    twice = spark.createDataFrame([(1, "Aa"), (1, "aA"), (1, "b")], "doc_id long, text string")
    assert sorted(r.text.lower() for r in exact_dedup.survivors(twice).collect()) == ["aa", "b"]


def test_clashing_columns_are_kept(spark):
    """Stages give back columns that are called like their own results as they were."""
    rows = [(1, "a text of six words here", "k1", "c1", "p1", "t1", 7), (2, "another text, write to a@b.cd", "k2", "c2", "p2", "t2", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, class string, pii string, toxicity string, n_chars long")
    for stage in (exact_dedup.survivors, ngram_join.survivors, lambda d: pii.redact(d, pii.fit(d))):
        out = stage(docs)
        assert out.columns == docs.columns
        assert sorted(r[2:6] for r in out.collect()) == [r[2:6] for r in rows]
    assert {r.text: r.n_chars for r in pii.redact(docs, pii.fit(docs)).collect()} == {rows[0][1]: 24, "another text, write to <EMAIL>": 30}


def test_ngram_join_answers(docs):
    out = by_id(ngram_join.mark(docs), "group_id", "n_links", "kept")
    assert out[1] == (1, 2, True) and out[2] == (1, 2, False)
    assert out[3] == (3, 0, True) and out[4] == (4, 0, True) and out[5] == (5, 0, True)
    assert out[6] == (6, 1, True) and out[7] == (6, 1, False)
    kept = [r.doc_id for r in ngram_join.survivors(docs).filter("doc_id is not null").collect()]
    assert sorted(kept) == [1, 3, 4, 5, 6]


def test_toxicity_of_nothing(docs):
    out = toxicity.score(docs, toxicity.Model()).select("doc_id", "toxicity.*").collect()
    assert all(0 <= r.score < toxicity.THRESHOLD and not r.spans for r in out)


def test_language_of_nothing(docs):
    out = {r.doc_id: r for r in language_id.identify(docs, language_id.trained(docs)).select("doc_id", "language.*").collect()}
    assert out[3].lang == out[4].lang == out[5].lang == "und" and out[3].score == 0 and out[3].spans == []
    assert out[6].lang in ("de", "en")


def test_pieces_of_nothing(docs):
    out = {r.doc_id: r for r in piece_codec.encode(docs, PIECES).select("doc_id", "pieces.*").collect()}
    assert out[3].ids is None and out[3].lossless is None
    assert out[4].ids == [] and out[4].lossless and out[6].lossless


def test_packing_of_odd_rows(spark, docs):
    out = packing.pack(docs, capacity=100_000)
    sizes = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("size").alias("n")).collect()}
    assert sizes[6] == sizes[7] == len(LONG) and sizes[3] == sizes[4] == 0 and sizes[1] == 2 * len(ROWS[0][1])
    empty = out.filter("size = 0").select("bin_id").distinct().collect()
    assert [r.bin_id for r in empty] == [None]
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0
    # A table without a source column has no sources to keep apart.
    assert packing.pack(docs.select("doc_id", "text")).filter("size > 0").count() > 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "mailto:x"), (4, "http://A.Example.COM/en/x?q#f"), (4, "http://A.Example.COM/en/x?q#f"), (5, "x://"), (None, "http://b.net/es/" + "deep/" * 3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("old")).withColumn("verdict", F.lit(None))
    out = {r.page_id: r for r in url_filters.judge(pages, [("block", "example.com/en/"), ("block", "net/es/")]).collect()}
    assert (out[1].host, out[1].path, out[1].rule, out[1].verdict) == ("", "", None, "allow") and out[3].host == out[5].host == ""
    assert (out[4].host, out[4].path, out[4].rule, out[4].verdict) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert out[None].verdict == "block"
    assert url_filters.judge(spark.createDataFrame([], "page_id long, url string"), []).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [5.0, 0.1, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 0.0]), (7, [inf, 1.0, 0.0]), (8, [1.0, None, 0.0]), (9, [1.0, 0.1]), (10, [2.0, 0.2]), (None, [0.0, 0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("kept", F.lit("old"))
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_links(vectors).collect()}
    assert out[1] == (2, 1, True) and out[2] == (2, 1, False) and out[9] == (1, 9, True) and out[10] == (1, 9, False)
    assert all(out[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8)) and out[None] == (0, None, True)
    assert embedding_dedup.near_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_inner_names_may_be_columns(spark):
    """Columns called like what the operators use inside come back as they were."""
    inner = ("grouped", "vector_key", "ruled", "shape", "key", "class", "node", "carried", "h")

    def dressed(rows, schema):
        df = spark.createDataFrame(rows, schema)
        for name in inner:
            df = df.withColumn(name, F.lit(f"my {name}"))
        return df

    text = "one two three four five six seven"
    docs = dressed([(1, text, "en"), (2, text, "en"), (3, None, None)], "doc_id long, text string, lang string")
    vectors = dressed([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None)], "vec_id long, embedding array<double>")
    pages = dressed([(1, "http://a.net/es/x"), (2, "http://a.org/y"), (3, None)], "page_id long, url string")
    for out, id_ in ((ngram_join.mark(docs), "doc_id"), (embedding_dedup.near_links(vectors), "vec_id"), (url_filters.judge(pages, [("block", "net/es/")]), "page_id")):
        rows = out.collect()
        assert sorted(r[id_] for r in rows) == [1, 2, 3] and all(r[name] == f"my {name}" for r in rows for name in inner)
        assert len(set(out.columns)) == len(out.columns)
    assert {r.doc_id: r.group_id for r in ngram_join.mark(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert {r.vec_id: (r.component_id, r.n_links) for r in embedding_dedup.near_links(vectors).collect()} == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    assert {r.page_id: (r.rule, r.verdict) for r in url_filters.judge(pages, [("block", "net/es/")]).collect()}[1] == ("net/es/", "block")


def test_number_signs_are_no_letters(spark):
    rows = [(1, "½ ² ③ Ⅷ ५ 10 \U0001d7d9 \U0001f10b"), (2, "der ½ und die ² und das"), (3, "the cat and the dog"), (4, "the cat ²and Ⅷ the dog"), (5, "一二三 十")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, t, l) for i in range(10) for t, l in (("der und die und das", "de"), ("the cat and the dog", "en"))], "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id.identify(docs, language_id.trained(known)).select("doc_id", "language.*").collect()}
    assert (out[1].lang, out[1].score, out[1].spans) == ("und", 0.0, [])
    assert out[2].lang == "de" and out[3].lang == out[4].lang == "en" and out[5].lang != "und"
    assert [(s.begin, s.end) for s in out[4].spans] == [(0, 22)]
