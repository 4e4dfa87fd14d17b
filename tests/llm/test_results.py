"""Operators against plain versions of themselves, exact round trips and held-out accuracy."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import (
    common,
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    ngram_join,
    packing,
    pii,
    piece_codec,
    queries,
    toxicity,
    url_filters,
)

SF = "/root/testdata/sf0.01"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def corpus(spark):
    docs = common.table(spark, SF, "documents")
    return docs, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def test_components_of_a_long_path(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([*zip(order, order[1:]), (1000, 1001), (1001, 1002), (1002, 1000)], "u long, v long")
    found = {r.node: r.root for r in common.components(edges).collect()}
    assert found == {**dict.fromkeys(range(300), 0), 1000: 1000, 1001: 1000, 1002: 1000}


def test_exact_dedup_in_small_blocks(spark):
    """Blocks of three characters, so that texts take several levels of naming."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("aB") for _ in range(rng.randint(0, 40))) for _ in range(120)]
    texts += [rng.choice(texts) for _ in range(80)] + ["ab" * 50, "AB" * 50, "ab" * 50 + "c", "ab" * 49]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(docs, block_chars=3).collect()}
    last = {t.lower(): i for i, t in enumerate(texts)}
    sizes = Counter(t.lower() for t in texts)
    assert found == {i: (last[t.lower()], sizes[t.lower()]) for i, t in enumerate(texts)}


def near_copies(rng, n, words=120, changes=4):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(words)] = f"v{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def test_ngram_join_against_all_pairs(spark, corpus):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [t for _, t in sorted(corpus[1].items())][:400]
    texts += near_copies(rng, 300) + near_copies(rng, 40, words=9, changes=1)
    # A passage in many otherwise different texts fills buckets without making pairs.
    texts += [passage + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(rng.randint(20, 80))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = brute.jaccard_pairs(texts)
    links = Counter(i for pair in pairs for i in pair)
    roots = brute.groups(len(texts), pairs)
    found = {r.doc_id: (r.group_id, r.n_links) for r in ngram_join.mark(docs).collect()}
    assert len(pairs) > 5000
    assert found == {i: (roots[i], links[i]) for i in range(len(texts))}


def test_ngram_runs_follow_from_recall():
    assert ngram_join.runs_for(0.999) > ngram_join.runs_for(0.99) > ngram_join.runs_for(0.9) >= 4


def test_pii_against_plain_patterns(spark, corpus):
    rng = random.Random(3)
    texts = ["a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4", "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111111111", "+1 (361) 555-8283. +1 5 ++49 1234567890 +1-", "é@x.yz 😀 a@b.cd", "x@y@z.com", "a" * 100_000, "1" * 100_000, "1.2.3.4 " * 700]
    texts += ["".join(rng.choice("ab1 23.@-+()_45 6é") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(rng.randint(16, 60))) for _ in range(200)]
    texts += list(corpus[1].values())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.annotate(docs, pii.fit(docs)).select("doc_id", pii.listed(F.col("pii"), *pii.BASE).alias("base")).collect()
    wrong = [texts[r.doc_id][:80] for r in found if r.base != ",".join(brute.base_spans(texts[r.doc_id]))]
    assert not wrong


def test_pii_learns_which_labelers_to_trust():
    def row(kind, votes, n):
        return dict(zip(pii.LABELERS, votes)) | {"kind": kind, "length": 4, "digits": 4, "left": 1, "votes": sum(votes), "n": n}

    # Three labelers agree with each other, the second one contradicts them all.
    rows = [row("number", (1, -1, 1, 1), 500), row("number", (-1, 1, -1, -1), 500), row("number", (1, 1, 1, 1), 20)]
    model = pii.learn(rows)
    assert model.reliability["pattern"][1][0] > 0.9 > 0.1 > model.reliability["pattern"][1][1]
    assert model.reliability["gazetteer"][1][0] < 0.2


def test_pii_adds_keys_and_redacts(spark, corpus):
    docs, texts = corpus
    model = pii.fit(docs)
    spans = {r.doc_id: r.pii for r in pii.annotate(docs, model).select("doc_id", "pii").collect()}
    assert any(s.kind == "key" for own in spans.values() for s in own)
    redacted = pii.redact(docs, model)
    assert redacted.columns == docs.columns
    for r in redacted.collect():
        text, at = texts[r.doc_id], 0
        out = ""
        for s in sorted(spans[r.doc_id], key=lambda s: (s.begin, s.end)):
            if s.begin >= at:
                out += text[at : s.begin] + f"<{s.kind.upper()}>"
            at = max(at, s.end)
        assert r.text == out + text[at:] and r.n_chars == len(r.text)


def test_toxicity_held_out(spark):
    docs = common.table(spark, "/root/testdata/sf0.1", "documents")
    labels = common.table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.trained(docs, labels)
    scored = toxicity.score(docs, model).select("doc_id", toxicity.held_out(docs).alias("h"), "toxicity.score", "toxicity.spans", "text")
    rows = scored.join(labels, "doc_id").filter("h").collect()
    hits = Counter((r.toxic, int(r.score >= toxicity.THRESHOLD)) for r in rows)
    assert hits[1, 1] / (hits[1, 1] + hits[1, 0]) > 0.88 and hits[0, 1] / (hits[0, 1] + hits[0, 0]) < 0.03
    assert any(r.text[s.begin : s.end].lower() in ("idiot", "moron", "loser") for r in rows for s in r.spans)


def test_toxicity_marginals_are_exact():
    """The composed maps against sums over all label sequences."""
    rng = np.random.default_rng(0)
    model = toxicity.Model(start=-0.5, into=-1.2, out=0.4, stay=0.9)
    e = rng.normal(size=9)
    begins = np.zeros(9, bool)
    begins[[0, 5]] = True
    got = model.marginals(e, begins)
    for first, last in ((0, 5), (5, 9)):
        weight = np.zeros((2**(last - first), last - first))
        total = np.zeros(len(weight))
        for k in range(len(weight)):
            tags = [(k >> i) & 1 for i in range(last - first)]
            score = tags[0] * model.start + sum(t * x for t, x in zip(tags, e[first:last]))
            for a, b in zip(tags, tags[1:]):
                score += {(0, 1): model.into, (1, 0): model.out, (1, 1): model.stay}.get((a, b), 0)
            weight[k], total[k] = tags, np.exp(score)
        assert np.allclose(got[first:last], total @ weight / total.sum())
    long = rng.normal(size=1000) * 5
    one = np.zeros(1000, bool)
    one[0] = True
    assert np.isfinite(model.marginals(long, one)).all()


def test_languages_held_out(spark, corpus):
    docs, _ = corpus
    out = language_id.identify(docs, language_id.trained(docs)).select("lang", language_id.held_out(docs).alias("h"), F.col("language.lang").alias("p")).filter("h").collect()
    assert sum(r.lang == r.p for r in out) / len(out) > 0.98


def test_every_language_is_learnt(spark):
    """More languages than 64, one of which has long documents only; these enter by a window."""
    rows = [(10 * k + i, f"w{chr(97 + k % 26)}{chr(97 + k // 26)}q x{chr(97 + k // 26)}{chr(97 + k % 26)}z ", f"l{k:02}") for k in range(70) for i in range(10)]
    rows += [(1000 + i, "lang abc " * 2000, "long") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sampled = language_id.sample(docs)
    assert {lang for lang, _ in sampled} == {r[2] for r in rows} and max(len(text) for _, text in sampled) == language_id.SAMPLE_CHARS
    assert Counter(lang for lang, _ in language_id.sample(docs, most=2))["l05"] <= 2
    out = language_id.identify(docs, language_id.fit(sampled)).select("lang", "language.lang").collect()
    assert all(a == b for a, b in out)


def test_language_paths_are_the_best(spark):
    """The Viterbi path against all label sequences, where one constant path is best and where it is not."""
    rng = np.random.default_rng(1)
    for _ in range(60):
        scores = rng.normal(size=(7, 3)) * rng.choice([1, 4])
        path = language_id.best_path(scores, 2.0)

        def value(p, s=scores):
            return s[np.arange(7), p].sum() - 2.0 * np.count_nonzero(np.diff(p))

        best = max(value(np.array(np.unravel_index(k, (3,) * 7))) for k in range(3**7))
        assert np.isclose(value(path), best)


def test_language_paths_without_the_best_constant():
    """Two halves in languages 0 and 2, with language 1 the best one throughout: the best path never uses it."""
    scores = np.array([(0.0, -2.0, -8.0)] * 5 + [(-8.0, -2.0, 0.0)] * 5)
    assert language_id.best_path(scores, 12.0).tolist() == [0] * 5 + [2] * 5


def test_mixed_text_is_split(spark, corpus):
    docs, texts = corpus
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    parts = [next(t for i, t in texts.items() if langs[i] == lang and 600 < len(t) < 4000) for lang in ("en", "fr")]
    mixed = spark.createDataFrame([(1, parts[0] + "\n" + parts[1])], "doc_id long, text string")
    row = language_id.identify(mixed, language_id.trained(docs)).select("language.spans").first()
    assert [s.lang for s in row.spans] == ["en", "fr"] and abs(row.spans[1].begin - len(parts[0])) < 40


def test_scripts_narrow_languages():
    model = language_id.fit([("ru", "привет мир друг"), ("en", "hello world friend"), ("el", "καλημέρα κόσμε")])
    assert language_id.Labeler(model).label(["незнакомый", "unknownish", "άγνωστος"])["lang"].tolist() == ["ru", "en", "el"]


def test_long_runs_and_script_changes_are_read():
    """Letters after the 64th of a run, and a change of script inside of it, are labelled like others."""
    model = language_id.fit([("ru", "привет мир друг"), ("en", "hello world friend"), ("el", "καλημέρα κόσμε"), ("xx", "abcde" * 12 + "qqzzv" * 20)])
    labeler = language_id.Labeler(model)
    row = labeler.label(["hello" + "мир" * 30]).iloc[0]
    assert [(s["begin"], s["end"], s["lang"]) for s in row.spans] == [(0, 5, "en"), (5, 95, "ru")] and row.lang == "ru"
    assert "qqz" in model.scores
    text = "é日本語かなkana" + "я" * 130 + "ツ x1y_z" + "𐎀" * 70
    pieces = language_id.words_of(text)
    assert "".join(pieces) == "".join(c for c in text if c.isalpha()) and max(map(len, pieces)) == 64
    assert all(len({language_id.script_of(c) for c in piece}) == 1 for piece in pieces)
    assert pieces == language_id._WORD.findall(text)


@pytest.fixture(scope="module")
def vocabulary():
    return piece_codec.vocabulary(PIECES)


ODD = ["", "x", " hello  world ", "a\nb\tc", "ﬁ Ⅷ", "日本語 ümlaut 😀", "      ", "x" * 300, "é" * 100 + " " * 40 + "z", "ab" * 2000]


def test_pieces_without_dropout_are_the_library_s(corpus, vocabulary):
    import sentencepiece

    texts = ODD + list(corpus[1].values())[:300]
    codec = piece_codec.Codec(vocabulary, dropout=0.0)
    want = sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)
    assert [ids.tolist() for ids in codec.encode(texts, ["k"] * len(texts))] == want


def test_pieces_with_dropout(spark, corpus, vocabulary):
    texts = [*ODD, "▁x ▁"] + list(corpus[1].values())[:200]
    names = [str(i) for i in range(len(texts))]
    one, two = piece_codec.Codec(vocabulary, 7), piece_codec.Codec(vocabulary, 8)
    a, b, again = one.encode(texts, names), two.encode(texts, names), piece_codec.Codec(vocabulary, 7).encode(texts[::-1], names[::-1])[::-1]
    assert all(one.decode(ids.tolist()) == text for ids, text in zip(a, texts))
    assert all((x == y).all() for x, y in zip(a, again))
    assert sum(len(x) != len(y) or (x != y).any() for x, y in zip(a, b)) > 150
    stretches = [w for t in texts[-50:] for w in piece_codec._STRETCH.findall(" " + t) if len(w) <= piece_codec.LONGEST][:2000]
    keys = piece_codec.mix(np.arange(len(stretches), dtype=np.uint64))
    flat, n = piece_codec.encode_together(vocabulary, stretches, keys, 0.3)
    alone = [piece_codec.encode_alone(vocabulary, w, int(k), 0.3) for w, k in zip(stretches, keys)]
    assert (flat == np.concatenate(alone)).all() and n.tolist() == [len(x) for x in alone]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    back = piece_codec.decode(piece_codec.encode(docs, PIECES, 7).select("doc_id", "pieces.ids"), PIECES)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))


def test_every_occurrence_has_draws_of_its_own(vocabulary):
    text = "internationalisation of measurements " * 3
    codec = piece_codec.Codec(vocabulary, 3, most=10)
    ids = codec.encode([text] * 1000, [str(i) for i in range(1000)])
    assert len({own.tobytes() for own in ids}) > 900
    assert all(codec.decode(own.tolist()) == text for own in ids)
    # Each occurrence is what its agenda alone gives, remembered or not, and however many are taken together.
    cut = piece_codec._STRETCH.findall(" " + text)
    for key in ("0", "17", "999"):
        keys = codec._drawn_for(key, len(cut))
        alone = [piece_codec.encode_alone(vocabulary, w, int(k), codec.dropout) for w, k in zip(cut, keys)]
        assert ids[int(key)].tolist() == np.concatenate(alone).tolist()
    words = piece_codec._STRETCH.findall(" " + " ".join(["measured values of wind and sun"] * 50))
    one = codec.encode([" ".join(["measured values of wind and sun"] * 50)], ["k"])[0]
    assert one.tolist() == np.concatenate([piece_codec.encode_alone(vocabulary, w, int(k), codec.dropout) for w, k in zip(words, codec._drawn_for("k", len(words)))]).tolist()
    assert len({own.tobytes() for own in (piece_codec.Codec(vocabulary, s).encode([text], ["k"])[0] for s in range(50))}) > 40


def test_lots_of_occurrences_are_cut_anywhere(vocabulary, monkeypatch):
    texts, names = ["one two three " * 40, "", "four " * 7, "x" * 99], ["a", "b", "c", "d"]
    whole = piece_codec.Codec(vocabulary, 5).encode(texts, names)
    monkeypatch.setattr(piece_codec, "_TOGETHER", 11)
    cut = piece_codec.Codec(vocabulary, 5).encode(texts, names)
    assert [a.tolist() for a in whole] == [b.tolist() for b in cut]


def test_packing_keeps_rules(spark, corpus):
    docs, texts = corpus
    out = packing.pack(docs, capacity=3000, shard_pieces=300).join(docs.select("doc_id", "source"), "doc_id").collect()
    pieces, bins = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append((r.begin, r.size))
        if r.bin_id:
            bins.setdefault(r.bin_id, []).append(r)
    for i, text in texts.items():
        at = 0
        for begin, size in sorted(pieces[i]):
            assert begin == at
            at += size
        assert at == len(text)
    for rows in bins.values():
        assert sum(r.size for r in rows) == rows[0].bin_used <= 3000
        assert len({r.source for r in rows}) == len(rows) == len({texts[r.doc_id].lower() for r in rows})
        at = 0
        for r in sorted(rows, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.size
    texts_of = packing.with_texts(packing.pack(docs, capacity=3000), docs).filter("size > 0").collect()
    assert all(r.text == texts[r.doc_id][r.begin : r.begin + r.size] for r in texts_of)


def test_packing_finds_the_tightest_bin():
    rng = random.Random(5)
    bins, rooms = packing.OpenBins(100), {}
    for _ in range(3000):
        size, source, cluster = rng.randint(1, 100), 1 << rng.randint(0, 9), 1 << rng.randint(0, 400)
        fits = [room for room, s, c in rooms.values() if room >= size and not s & source and not c & cluster]
        b, offset = bins.place(size, source, cluster)
        room, s, c = rooms.get(b, (100, 0, 0))
        assert room == (min(fits) if fits else 100) and offset == 100 - room
        rooms[b] = (room - size, s | source, c | cluster)


def test_licenses_against_sets(spark, corpus):
    docs, texts = corpus
    templates = [(f"{name}{i}", text) for i, (name, text) in enumerate(license_scan.TEMPLATES)]
    rng = random.Random(6)
    extra = []
    for _, text in templates:
        words = text.split()
        words[len(words) // 2 : len(words) // 2 + rng.randint(0, 1)] = []
        extra.append("x y z " * rng.randint(0, 40) + " ".join(words) + " end" * rng.randint(0, 40))
    rows = [*texts.items(), *((10_000 + i, t) for i, t in enumerate(extra))]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates).select("doc_id", "licenses").collect()
    sets = [(name, set(license_scan.shingles_of(text))) for name, text in templates]
    texts = dict(rows)
    for r in found:
        words = license_scan.words_of(texts[r.doc_id])
        own = {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}
        share = {name: len(own & s) / len(s) for name, s in sets}
        got = {x.license for x in r.licenses}
        assert got <= {name for name, x in share.items() if x >= 0.8}
        # What is found whole stays; a version of less may give way to it.
        assert {name for name, x in share.items() if x == 1} <= got or not {name for name, x in share.items() if x == 1}
        assert bool(got) == any(x >= 0.8 for x in share.values())
        for x in r.licenses:
            assert 0 <= x.begin < x.end <= len(words)


def test_short_licenses_are_found(spark, corpus):
    """Every planted line of three words is found where it stands, also alone and twice, and next to longer notices."""
    rows = [*corpus[1].items(), (10_000, "All rights reserved."), (10_001, "all rights\nRESERVED, all rights reserved"), (10_002, "rights reserved all"), (10_003, "Released under the MIT License. All rights reserved.")]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "licenses").collect()
    got = {r.doc_id: [(x.begin, x.end) for x in r.licenses if x.license == "All-Rights-Reserved"] for r in found}
    want = {}
    for i, text in rows:
        words = license_scan.words_of(text)
        want[i] = [(k, k + 3) for k in range(len(words)) if words[k : k + 3] == ["all", "rights", "reserved"]]
    assert got == want and sum(map(bool, want.values())) > 5
    assert [x.license for r in found if r.doc_id == 10_003 for x in r.licenses] == ["MIT", "All-Rights-Reserved"]
    short = [("A", "public domain"), ("B", "this text is in the public domain for all")]
    one = spark.createDataFrame([(1, "so this text is in the public domain for any")], "doc_id long, text string")
    assert [x.license for x in license_scan.scan(one, short, containment=0.7).first().licenses] == ["B", "A"]
    assert [x.license for x in license_scan.scan(one, short[:1]).first().licenses] == ["A"]


def test_license_bands_guarantee():
    for kind in license_scan.kinds([1, 2, 4, 8, 16, 32]):
        for size in range(kind.low, kind.high + 1):
            s = license_scan.least_similarity(size, kind.width, 0.8)
            assert s == 1 or 1 - (1 - s) ** kind.bands(0.8, 0.999) >= 0.999
            # Every run of `high` shingles lies in a window whole.
            assert kind.width - kind.high + 1 >= kind.stride


def test_embedding_links_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    vectors = list(base)
    for c in (0.91, 0.95, 0.99):
        for k in range(150):
            z = rng.standard_normal(64)
            z -= (z @ base[k]) * base[k]
            vectors.append(3 * (c * base[k] + np.sqrt(1 - c * c) * z / np.linalg.norm(z)))
    vectors += [base[7] + 0.02 * rng.standard_normal(64) for _ in range(200)] + [base[9]] * 100
    x = np.array(vectors)
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    left, right = np.nonzero(np.triu(units @ units.T >= 0.9, 1))
    links = np.bincount(np.concatenate([left, right]), minlength=len(x))
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in embedding_dedup.near_links(frame).collect()}
    got = np.array([found[i].n_links for i in range(len(x))])
    assert (got <= links).all() and got.sum() >= 0.97 * links.sum()
    roots = brute.groups(len(x), zip(left, right))
    assert np.mean([found[i].component_id == roots[i] for i in range(len(x))]) > 0.97


@pytest.mark.parametrize("exact", [20_000, 50])
def test_embeddings_of_several_lengths_and_crowded_cells(spark, monkeypatch, exact):
    """Floats, two lengths, blocks of a few vectors: with all cells visited every link is counted once."""
    monkeypatch.setattr(embedding_dedup, "EXACT", exact)
    monkeypatch.setattr(embedding_dedup, "fit", lambda sample, n, *_: embedding_dedup.Index(sample[:3, : sample.shape[1] // 2], sample[:3, sample.shape[1] // 2 :], 9))
    dealt = embedding_dedup._dealt
    monkeypatch.setattr(embedding_dedup, "_dealt", lambda routed: dealt(routed, 7))
    rng = np.random.default_rng(4)
    rows = [row.astype(np.float32) for d, n in ((6, 160), (9, 90)) for row in rng.standard_normal((n // 8, d)).repeat(8, axis=0) + 0.2 * rng.standard_normal((n // 8 * 8, d))]
    rows += [rows[0]] * 3
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(rows)], "vec_id long, embedding array<float>")
    want = np.zeros(len(rows), int)
    for d in (6, 9):
        at = [i for i, row in enumerate(rows) if len(row) == d]
        x = np.array([rows[i] for i in at], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        want[at] = (x @ x.T >= 0.9).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_links(frame).collect()}
    assert [found[i] for i in range(len(rows))] == want.tolist()


def test_index_visits_nearest_cells():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((50, 8))
    index = embedding_dedup.Index(rng.standard_normal((6, 4)), rng.standard_normal((5, 4)), visits=9)
    cells = index.cells(x)
    a, b = embedding_dedup._distances(x[:, :4], index.first), embedding_dedup._distances(x[:, 4:], index.second)
    sums = (a[:, :, None] + b[:, None, :]).reshape(50, -1)
    assert (cells == np.argsort(sums, axis=1, kind="stable")[:, :9]).all()


def test_url_templates_learn_from_rules(spark):
    """Branches like the blocked ones are rejected, others pass; nothing carries over to another host."""
    rows = [f"http://a.net/ads/{i}" for i in range(200)] + [f"http://a.net/news/{i}.html" for i in range(200)]
    rows += [f"http://a.net/promo/{i}" for i in range(150)] + [f"http://b.net/ads/{i}" for i in range(50)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    rules = [("block", f"a.net/ads/{k}") for k in range(1, 10)] + [("allow", "a.net/news/1")]
    out = url_filters.judge(pages, rules).collect()
    verdicts = {(r.host, r.path.split("/")[1], r.verdict) for r in out if r.rule is None}
    assert ("a.net", "ads", "block") in verdicts and ("a.net", "ads", "allow") not in verdicts
    assert ("a.net", "news", "allow") in verdicts and ("a.net", "news", "block") not in verdicts
    assert {r.template for r in out if r.path.startswith("/ads")} != {r.template for r in out if r.path.startswith("/news")}


def test_deep_urls_keep_their_branches(spark):
    """Branches far below the root are told apart, and long repeated paths take no step for each segment."""
    deep = "a.net/" + "/".join("abcdefg") * 3
    rows = [f"http://{deep}/ads/{i}" for i in range(200)] + [f"http://{deep}/news/{i}" for i in range(200)]
    rows += ["http://b.net/" + "deep/" * k for k in range(1, 300, 7)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    rules = [("block", f"{deep}/ads/{k}") for k in range(1, 10)] + [("allow", f"{deep}/news/1")]
    out = url_filters.judge(pages, rules).collect()
    assert {(r.path.split("/")[-2], r.verdict) for r in out if r.rule is None and r.host == "a.net"} == {("ads", "block"), ("news", "allow")}
    assert {r.template for r in out if r.host == "b.net"} == {"/deep~" * k for k in range(1, 300, 7)}


def test_variable_words_become_wildcards(spark):
    rng = random.Random(7)
    rows = [f"http://a.org/user/{''.join(rng.choice('abcdefghij') for _ in range(8))}/posts" for _ in range(100)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    assert {r.template for r in url_filters.judge(pages, []).collect()} == {"/user~/*~/posts~"}


def test_registered_columns(spark):
    """The columns that the queries promise."""
    want = {
        "op1_toxicity": {"doc_id", "held_out", "score", "predicted"},
        "op3_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
        "op5_language_id": {"doc_id", "held_out", "lang_pred", "score"},
        "op7_url_filters": {"page_id", "host", "path", "rule", "verdict"},
        "op8_embedding_dedup": {"vec_id", "n_links", "component_id", "kept"},
        "op10_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    }
    for name, columns in want.items():
        out = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert columns <= set(out.columns), name
        assert out.count() > 0
