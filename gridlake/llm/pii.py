"""Personal data by weak supervision.

Spans of four kinds are fixed by patterns with a check (mail addresses, IP addresses, card numbers, phone numbers). Further
candidates, long numbers and keys, are proposed by wide patterns and decided by weak supervision: a pattern, a gazetteer, a
context and a form labeler vote on every candidate for, against or not at all. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is and how likely each pattern means personal data. A span classifier
(naive Bayes over the kind, length, make-up and surroundings of a span) is then trained on these probabilities.

Everything that touches texts is built from DataFrame functions and stays in the row: no shuffle, no Python. What is
collected is one table of counts over combinations of votes and features, which has at most `combinations()` rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import carried, with_type

BASE = ("email", "ip", "card", "phone")
ADDED = ("number", "key")
KINDS = BASE + ADDED
LABELERS = ("pattern", "gazetteer", "context", "form")
FEATURES = ("length", "digits", "left", "votes")
LEAST = 0.8  # probability from which a candidate is added

# Each pattern starts where a match can start at the earliest and never backtracks over a long run, so that it takes linear
# time on any text and finds the same matches as the plain form.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "number": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){8,}+",
    "key": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+",
}
# What a text must hold for a pattern to be tried.
_HOLDS: dict[str, Callable[[Column], Column]] = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: F.contains(t, F.lit(".")) & F.rlike(t, F.lit(r"[0-9]\.[0-9]")),
    "card": lambda t: F.rlike(t, F.lit(r"[0-9](?:[ -]?[0-9]){15}")),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "number": lambda t: F.rlike(t, F.lit(r"[0-9](?:[ -]?[0-9]){8}")),
    "key": lambda t: F.rlike(t, F.lit(r"[A-Za-z0-9_+/=-]{20}")),
}
_CUES = {
    "email": r"mail|contact|write|reach|correo|courriel|schreib",
    "ip": r"\bip\b|host|server|addr|login|client|from",
    "card": r"card|visa|master|credit|pay|karte|carte|tarjeta",
    "phone": r"call|phone|tel|fax|mobile|cell|anruf|llama",
    "number": r"card|account|konto|iban|ssn|social|passport|phone|tel|id\b",
    "key": r"(?:token|key|secret|passw|pwd|auth|bearer|credential)\w*[\"' :=]*$",
}
_AGAINST = r"(?:version|release|section|chapter|isbn|page|total|\bv)[ .:]*$|[$€£%#][ ]*$"
_TOP_DOMAINS = "com|org|net|edu|gov|io|de|fr|es|uk|it|nl|eu|info|biz"
_COUNTRY_CODES = "1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)"
_KEY_PREFIXES = r"^(?:gh[pousr]_|AKIA|ASIA|sk-|pk-|xox[abp]-|eyJ|AIza)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once. A column captured in a lambda would be computed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def found(text: Column, kind: str) -> Column:
    """All matches as array of (begin, end, value, before); begin and end in code points, before: what stands to the left.

    A match begins after all the gaps and matches before it. Sums over the lengths are taken in blocks of 256.
    """
    pattern = F.lit(_PATTERNS[kind])

    def placed(z: Column) -> Column:
        lengths = F.transform(z.m, lambda x, i: F.char_length(x) + F.char_length(F.get(z.g, i)))
        blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(z.m) - 1, F.lit(0)) / 256).cast("int"))

        def of_blocks(lens: Column) -> Column:
            sums = F.transform(blocks, lambda b: _total(F.slice(lens, b * 256 + 1, 256)))

            def of_heads(s: Column) -> Column:
                heads = F.transform(blocks, lambda b: _total(F.slice(s, F.lit(1), b)))

                def of_matches(h: Column) -> Column:
                    def one(x: Column, i: Column) -> Column:
                        block = F.floor(i / 256).cast("int")
                        start = F.get(h, block) + _total(F.slice(lens, block * 256 + 1, i - block * 256)) + F.char_length(F.get(z.g, i))
                        return let(start, lambda b: F.struct(b.alias("begin"), (b + F.char_length(x)).alias("end"), x.alias("value"), F.right(F.get(z.g, i), F.lit(32)).alias("before")))

                    return F.transform(z.m, one)

                return let(heads, of_matches)

            return let(sums, of_heads)

        return let(lengths, of_blocks)

    parts = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"), F.split(text, _PATTERNS[kind], -1).alias("g"))
    none = F.lit(None).cast("array<struct<begin:int,end:int,value:string,before:string>>")
    matches = F.when(_HOLDS[kind](text), let(parts, placed)).otherwise(none)
    return F.coalesce(F.filter(matches, lambda s: _valid(kind, s.value)), F.array().cast("array<struct<begin:int,end:int,value:string,before:string>>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits of `value`, every second one from the right doubled, add up to a multiple of ten."""

    def add(total: Column, digit: Column, i: Column) -> Column:
        doubled = digit * 2
        return total + F.when(i % 2 == 1, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(digit)

    turned = F.transform(F.split(F.reverse(_digits(value)), ""), lambda c, i: F.struct(F.coalesce(c.try_cast("int"), F.lit(0)).alias("d"), i.alias("i")))
    return F.aggregate(turned, F.lit(0), lambda a, s: add(a, s.d, s.i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.char_length(p) <= 3) & (p.try_cast("int") <= 255))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.char_length(_digits(value)).between(8, 15)
    if kind == "key":
        return F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    against = F.when(no, F.lit(-1)) if no is not None else F.when(F.lit(False), F.lit(-1))
    return F.when(yes, F.lit(1)).otherwise(against.otherwise(F.lit(0)))


def _votes(kind: str, value: Column, before: Column) -> list[Column]:
    """The votes of the labelers, in their order: 1 for, -1 against, 0 none."""
    has = lambda column, pattern: F.rlike(column, F.lit(pattern))
    context = _vote(has(F.lower(before), _CUES[kind]), has(F.lower(before), _AGAINST))
    digits = _digits(value)
    issuer = has(digits, _ISSUERS)
    varied = F.size(F.array_distinct(F.split(value, "")))
    if kind == "email":
        form = ~has(value, r"\.\.|^\.|\.@") & (F.char_length(value) <= 254)
        return [_vote(has(value, r"\.[A-Za-z]{2,}$"), F.lit(True)), _vote(has(value, rf"(?i)\.(?:{_TOP_DOMAINS})$")), context, _vote(form, ~form)]
    if kind == "ip":
        plain = ~has(value, r"(?:^|\.)0[0-9]|^0|^2(?:2[4-9]|[3-5])")
        return [_vote(plain, ~plain), _vote(has(value, r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\.")), context, _vote(varied >= 4, varied < 3)]
    if kind == "card":
        return [_vote(has(digits, "^[3-6]")), _vote(issuer, ~issuer), context, F.lit(1)]
    if kind == "phone":
        even = F.regexp_count(value, F.lit(r"\(")) == F.regexp_count(value, F.lit(r"\)"))
        return [_vote(has(value, r"^\+[0-9]{1,3}[ (.-]")), _vote(has(value, rf"^\+(?:{_COUNTRY_CODES})"), ~has(value, rf"^\+(?:{_COUNTRY_CODES})")), context, _vote(even & ~has(value, r"[.-]{2}|  "), ~even)]
    if kind == "number":
        length = F.char_length(digits)
        shaped = length.between(13, 19) | has(value, r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
        # A number as long as a card number ought to pass the card check.
        failed = length.between(13, 19) & ~_luhn(value)
        return [_vote(shaped, ~shaped), _vote(issuer), context, _vote(~failed & (F.size(F.array_distinct(F.split(digits, ""))) >= 5), failed)]
    hexed = has(value, r"(?i)^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$")
    return [_vote(hexed | has(value, r"[a-z].*[A-Z].*[0-9]|[0-9].*[a-z].*[A-Z]")), _vote(has(value, _KEY_PREFIXES)), context, _vote(varied >= 10, varied < 6)]


def _described(kind: str, span: Column) -> Column:
    """A span with its votes and the features of the classifier, each a small whole number."""
    votes = _votes(kind, span.value, span.before)
    length = F.least(F.floor(F.log2(F.char_length(span.value).cast("double"))), F.lit(8)).cast("int")
    digits = F.floor(F.char_length(_digits(span.value)) * 4 / F.char_length(span.value)).cast("int")
    end = F.right(span.before, F.lit(1))
    left = F.when(end == "", 0).when(F.rlike(end, F.lit(r"\s")), 1).when(F.rlike(end, F.lit(r"[\"'=:(]")), 2).when(F.rlike(end, F.lit(r"\w")), 3).otherwise(4)
    total = votes[0] + votes[1] + votes[2] + votes[3]
    named = [v.cast("int").alias(n) for v, n in zip(votes, LABELERS)]
    return F.struct(
        F.lit(kind).alias("kind"), span.begin.alias("begin"), span.end.alias("end"), *named,
        length.alias("length"), digits.alias("digits"), left.alias("left"), total.cast("int").alias("votes"),
    )


def _describer(kind: str) -> Callable[[Column], Column]:
    return lambda span: _described(kind, span)


def combinations() -> int:
    """Most rows of the table of counts: kinds, votes, lengths, shares of digits, surroundings (the total follows)."""
    return len(KINDS) * 3 ** len(LABELERS) * 9 * 5 * 5


def candidates(docs: DataFrame, column: str = "candidates") -> DataFrame:
    """`docs` with an array of described candidates: base spans by kind and start, then added candidates clear of them."""
    text = F.coalesce(with_type(docs, "text", "string"), F.lit(""))
    own = docs.withColumn(column, F.struct(*[found(text, kind).alias(kind) for kind in KINDS]))
    every = [F.transform(F.col(f"{column}.{kind}"), _describer(kind)) for kind in KINDS]

    def clear(parts: Column) -> Column:
        """Added candidates that overlap no base span; a key that overlaps a number stays, the number goes."""
        kept = F.filter(parts.key, lambda s: ~F.exists(parts.base, lambda b: (b.begin < s.end) & (b.end > s.begin)))

        def numbers(keys: Column) -> Column:
            free = F.filter(parts.number, lambda s: ~F.exists(F.concat(parts.base, keys), lambda b: (b.begin < s.end) & (b.end > s.begin)))
            return F.concat(parts.base, free, keys)

        return let(kept, numbers)

    parts = F.struct(F.concat(*every[:4]).alias("base"), every[4].alias("number"), every[5].alias("key"))
    return own.withColumn(column, let(parts, clear))


@dataclass
class Model:
    """Reliability of labelers, and the log odds of the classifier by (kind, feature, value)."""

    reliability: dict[str, dict[int, tuple[float, float]]] = field(default_factory=dict)
    prior: dict[str, float] = field(default_factory=dict)
    odds: dict[str, float] = field(default_factory=dict)

    def probability(self, span: Column) -> Column:
        """Probability that a described span is personal data."""
        if not self.odds:
            return F.lit(0.5)
        entries = [F.lit(x) for item in sorted(self.odds.items()) for x in item]
        table = F.create_map(*entries)
        score = F.coalesce(F.get(F.map_values(F.map_filter(table, lambda k, _: k == span.kind)), 0), F.lit(0.0))
        for name in FEATURES:
            key = F.concat_ws("|", span.kind, F.lit(name), span[name].cast("string"))
            score = score + F.coalesce(F.try_element_at(table, key), F.lit(0.0))
        return 1 / (1 + F.exp(-score))


def fit(docs: DataFrame, rounds: int = 50) -> Model:
    """Estimate labelers and classifier from the candidates of all documents."""
    keys = ["kind", *LABELERS, "length", "digits", "left", "votes"]
    spans = candidates(docs.select(with_type(docs, "text", "string").alias("text"))).select(F.explode("candidates").alias("s"))
    counted = spans.groupBy(*[F.col(f"s.{k}").alias(k) for k in keys]).agg(F.count("*").alias("n"))
    return learn([row.asDict() for row in counted.collect()], rounds)


def learn(rows: list[dict], rounds: int = 50) -> Model:
    """Expectation-maximisation over vote patterns, then the classifier; `rows` are bounded by `combinations()`."""
    if not rows:
        return Model()
    patterns: dict[tuple, float] = defaultdict(float)
    for row in rows:
        patterns[(row["kind"], *[row[name] for name in LABELERS])] += row["n"]
    # Start: the majority of the votes.
    belief = {p: 1 / (1 + math.exp(-sum(p[1:]))) for p in patterns}
    model = Model()
    for _ in range(rounds):
        prior_yes, prior_all = defaultdict(lambda: 1.0), defaultdict(lambda: 2.0)
        # A vote starts as more often right than wrong.
        votes = {name: {-1: [1.0, 2.0], 1: [2.0, 1.0]} for name in LABELERS}
        for p, n in patterns.items():
            prior_yes[p[0]] += n * belief[p]
            prior_all[p[0]] += n
            for name, v in zip(LABELERS, p[1:]):
                if v:  # no vote is no evidence
                    votes[name][v][0] += n * belief[p]
                    votes[name][v][1] += n * (1 - belief[p])
        model.prior = {kind: prior_yes[kind] / prior_all[kind] for kind in prior_all}
        for name in LABELERS:
            yes, no = (sum(votes[name][v][i] for v in (-1, 1)) for i in (0, 1))
            model.reliability[name] = {v: (votes[name][v][0] / yes, votes[name][v][1] / no) for v in (-1, 1)}
        moved = 0.0
        for p in patterns:
            score = math.log(model.prior[p[0]] / (1 - model.prior[p[0]]))
            for name, v in zip(LABELERS, p[1:]):
                if v:
                    yes, no = model.reliability[name][v]
                    score += math.log(yes / no)
            new = 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))
            moved = max(moved, abs(new - belief[p]))
            belief[p] = new
        if moved < 1e-6:
            break
    # The classifier: weighted counts of feature values in each kind.
    yes_all, no_all = defaultdict(float), defaultdict(float)
    yes, no, values = defaultdict(float), defaultdict(float), defaultdict(set)
    for row in rows:
        b = belief[(row["kind"], *[row[name] for name in LABELERS])]
        yes_all[row["kind"]] += row["n"] * b
        no_all[row["kind"]] += row["n"] * (1 - b)
        for name in FEATURES:
            key = (row["kind"], name, row[name])
            values[key[:2]].add(row[name])
            yes[key] += row["n"] * b
            no[key] += row["n"] * (1 - b)
    for kind in yes_all:
        model.odds[kind] = math.log((yes_all[kind] + 1) / (no_all[kind] + 1))
    for key in yes:
        kind, name, value = key
        size = len(values[key[:2]])
        p, q = (yes[key] + 1) / (yes_all[kind] + size), (no[key] + 1) / (no_all[kind] + size)
        model.odds[f"{kind}|{name}|{value}"] = math.log(p / q)
    return model


def annotate(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """The rows of `docs` with `pii`: array of (kind, begin, end, probability) by kind, then start; code points, end exclusive.

    Base spans always stay; further candidates are added from the probability `least` on. A null text counts as empty and
    has no spans. A column of `docs` called pii is replaced. Repeated rows get the same spans; an empty table stays empty.
    """

    def scored(spans: Column) -> Column:
        with_p = F.transform(spans, lambda s: F.struct(s.kind.alias("kind"), s.begin.alias("begin"), s.end.alias("end"), model.probability(s).alias("probability")))
        return F.filter(with_p, lambda s: s.kind.isin(*BASE) | (s.probability >= least))

    return candidates(docs, "pii").withColumn("pii", scored(F.col("pii")))


def listed(spans: Column, *kinds: str) -> Column:
    """Spans as `kind:begin:end`, joined by commas; all kinds unless some are named."""
    own = F.filter(spans, lambda s: s.kind.isin(*kinds)) if kinds else spans
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s.kind, s.begin.cast("string"), s.end.cast("string"))))


PART, BLOCK = 128, 2048  # spans, and characters, that are looked through for one span


def redact(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """The rows of `docs` with each span replaced by its kind, as `<EMAIL>`; overlapping spans become one.

    `n_chars`, if there is such a column, is set to the new length. Null texts stay null; other columns stay as they are.
    """
    marked = annotate(carried(docs, ("text", "string")), model, least)

    def leading(spans: Column) -> Column:
        """Spans by start that begin after all earlier ones end, each with that end, `before`.

        Ends are looked up in parts of PART spans, so the work grows with the number of spans and not with its square.
        """
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.begin.alias("begin"), s.end.alias("end"), s.kind.alias("kind"))))

        def of(ordered: Column) -> Column:
            firsts = F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / PART).cast("int"))
            return let(F.transform(firsts, lambda i: F.slice(ordered, i * PART + 1, PART)), with_ends)

        def with_ends(parts: Column) -> Column:
            ends = F.transform(parts, lambda part: F.array_max(part.end))
            reached = F.aggregate(ends, F.array(F.lit(0)), lambda got, end: F.concat(got, F.array(F.greatest(F.element_at(got, -1), end))))
            return let(reached, lambda reached: F.flatten(F.transform(parts, lambda part, i: of_part(part, F.get(reached, i)))))

        def of_part(part: Column, before: Column) -> Column:
            def seen(s: Column, i: Column) -> Column:
                own = F.greatest(before, F.coalesce(F.array_max(F.slice(part.end, F.lit(1), i)), F.lit(0)))
                return F.struct(s.begin.alias("begin"), own.alias("before"), s.kind.alias("kind"))

            return F.filter(F.transform(part, seen), lambda s: s.begin >= s.before)

        return let(ordered, of)

    def written(blocks: Column) -> Column:
        """The text anew, from its blocks of BLOCK characters: no place is counted from the start of the whole text."""

        def between(begin: Column, end: Column) -> Column:
            first, last = F.floor(begin / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
            head = F.coalesce(F.get(blocks, first), F.lit(""))
            inside = F.substring(head, begin % BLOCK + 1, end - begin)
            whole = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
            tail = F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), end % BLOCK)
            across = F.concat(F.substring(head, begin % BLOCK + 1, F.lit(BLOCK)), whole, tail)
            return F.when(first == last, inside).otherwise(across)

        pieces = F.transform(leading(F.col("pii")), lambda s: F.concat(between(s.before, s.begin), F.lit("<"), F.upper(s.kind), F.lit(">")))
        return F.concat(F.array_join(pieces, ""), between(F.array_max(F.col("pii.end")), F.char_length("text")))

    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    text = F.when(F.size("pii") == 0, F.col("text")).otherwise(let(blocks, written))
    changed = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    columns = [changed.get(c, F.col(f"carried_row.`{c}`")).alias(c) for c in docs.columns]
    return marked.withColumn("text", text).select(*columns)
