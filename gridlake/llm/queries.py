"""The registered queries of this package and, where SQL can express them, the statements that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import collocations, embedding_dedup, exact_dedup, language_id, lexical_search, license_scan, ngram_join, packing, pii, piece_codec, quality, toxicity, url_filters
from gridlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query(
    "op10_exact_dedup",
    """WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
      sha256(t) AS text_sha256 FROM d WINDOW g AS (PARTITION BY t)""",
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op4_ngram_join")
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.mark(docs).select("doc_id", "group_id", "n_links", "kept")


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(docs).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("toxicity.spans").alias("n_spans"),
    )


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.annotate(docs, pii.fit(docs))
    counts = [F.size(F.filter("pii", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in pii.BASE]
    base, every = pii.listed(F.col("pii"), *pii.BASE), pii.listed(F.col("pii"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))


def _of_kind(kind: str):
    return lambda span: span.kind == kind


URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query("op7_url_filters")
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query("op8_embedding_dedup")
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embedding_dedup.near_links(vectors).select("vec_id", "n_links", "component_id", "kept")


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.trained(docs)
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        language_id.held_out(docs).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.size("language.spans").alias("n_spans"),
    )


def tokenizer(name: str) -> str:
    """Place of a vocabulary file; the folder is named by GRIDLAKE_TOKENIZERS."""
    return os.path.join(os.environ.get("GRIDLAKE_TOKENIZERS", "/opt/tokenizers"), name)


@query("op2_piece_codec")
def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_codec.encode(docs, tokenizer("piece_bpe_32k.model"), seed=7)
    return coded.select("doc_id", "pieces.ids", F.size("pieces.ids").alias("n_pieces"), "pieces.lossless")


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = F.transform("licenses", lambda s: F.concat_ws(":", s.license, s.begin.cast("string"), s.end.cast("string")))
    return found.select("doc_id", F.size("licenses").alias("n_licenses"), F.concat_ws(",", listed).alias("licenses"))


@query(
    "op11_collocations",
    r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
    g AS (SELECT lang, 1 AS size, unnest(ws) AS phrase FROM w
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
    f AS (SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY ALL),
    n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
    c AS (SELECT *, string_split(phrase, ' ') AS x FROM f WHERE size > 1 AND a >= 10),
    parts AS (SELECT lang, phrase, a, 1 AS k, x[1] AS p, array_to_string(x[2:], ' ') AS q FROM c
      UNION ALL SELECT lang, phrase, a, 2, array_to_string(x[1:2], ' '), x[3] FROM c WHERE size = 3),
    s AS (SELECT parts.lang, parts.phrase, parts.a, k, lf.a AS l, rf.a AS r,
        (1000000::HUGEINT * parts.a * parts.a // (lf.a::HUGEINT * rf.a))::BIGINT AS score
      FROM parts JOIN f lf ON lf.lang = parts.lang AND lf.phrase = p JOIN f rf ON rf.lang = parts.lang AND rf.phrase = q),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    held AS (SELECT lang, h, max(a) AS a FROM (
        SELECT lang, a, unnest([x[1] || ' ' || x[2], x[2] || ' ' || x[3]]) AS h FROM c WHERE size = 3) GROUP BY ALL),
    kept AS (SELECT b.* FROM b LEFT JOIN held ON held.lang = b.lang AND held.h = b.phrase WHERE held.a IS NULL OR 100 * held.a < 50 * b.a)
    SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000""",
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query(
    "op13_lexical_search",
    r"""WITH d AS (SELECT doc_id, row_number() OVER () AS one, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
    q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
    s AS (SELECT count(*) AS docs, sum(len(ts))::BIGINT AS words FROM d WHERE len(ts) > 0),
    f AS (SELECT one, t, count(*) AS tf FROM (SELECT one, unnest(ts) AS t FROM d) GROUP BY ALL),
    w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY t),
    m AS (SELECT one, doc_id, 100 - 50 + (50 * len(ts) * docs) // words AS m FROM d, s WHERE len(ts) > 0),
    r AS (SELECT item_id, doc_id, one, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (one) GROUP BY ALL)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM r WHERE score > 0 QUALIFY rank <= 50""",
)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("op12_quality")
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.trained(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out(docs).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )
