"""URL filter by path-template trees.

Fixed rules decide the URLs they fit, and these decisions are the labels. For the others a tree of path segments is grown
for each host, one fork at a time, to the end of the deepest path: segments that all URLs below a branch share are taken
at once, so the number of steps is that of forks on a path, not that of its segments. At every fork

- variable segments become wildcards: numbers and the like by their shape, names where a branch has many different ones
  that hardly repeat;
- statistically alike branches of one parent are merged. Two are alike if the share of blocked URLs among the labelled
  ones, the share of URLs that end there, and the shares of the segments that follow (in eight hash classes) each differ
  by less than the Hoeffding bound. URLs that no rule decides have no say in the first share, so a branch without labels
  can meet a labelled one. Of the branches not yet merged the one with the most labels leads, and all labelled ones alike
  join it; this repeats until every branch has met every leader. A branch without labels joins, of all the leaders it is
  alike, the one with the smallest blocked share, since evidence that is at odds should not reject it. The number of
  repetitions is that of the unlike branches under one parent.

A template is a path of the tree, and its purity the share of blocked URLs among its labelled ones, smoothed by the share
of its host, which is smoothed by that of all. Templates of high purity are rejected.

Only DataFrame functions. URLs are first reduced to (host, shape of the path) with counts, combined before the shuffle, so
a host that holds a third of all URLs is as small as the number of its shapes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import ascii_lower, carried
from gridlake.workspace import materialise

Rule = tuple[str, str]

MANY, RARE = 20, 0.5  # from so many different words, and so large a share of words per URL, a segment is variable
ALPHA = 0.05  # of the Hoeffding bound
PRIOR_WEIGHT = 5.0  # labelled URLs that the prior counts for
PURITY = 0.8
CLASSES = 8  # hash classes of the segments that follow a branch
FOLLOWING = [f"next{i}" for i in range(CLASSES)]
SUMS = ["n", "blocked", "allowed", "ends", *FOLLOWING]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty if it is null or has no `://`."""
    begin = F.locate("://", url)
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null if none does. `rules` are (allow or block, host/path)."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda rule: (len(rule[1]), rule)):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        found, verdict = F.when(fits, F.lit(text)).otherwise(found), F.when(fits, F.lit(action)).otherwise(verdict)
    return found, verdict


def shape(path: Column) -> Column:
    """Segments of a path: numbers and dates as `#`, long hexadecimal names as `?`; empty segments at the ends go.

    A path holds neither mark itself. The signs `*` and `~`, which templates use, are written as `%2A` and `%7E`, which
    mean the same in a URL; digits of such escapes are not numbers.
    """
    safe = F.regexp_replace(F.regexp_replace(path, r"\*", "%2A"), "~", "%7E")
    marked = F.regexp_replace(safe, r"(?<=[/_.-])[0-9a-fA-F]{8,}+(?:-[0-9a-fA-F]{4,}+)*+(?=[/_.-]|$)", "?")
    marked = F.regexp_replace(marked, r"(?<!%)(?<!%[0-9a-fA-F])[0-9]++(?:[-_.][0-9]++)*+", "#")
    return F.regexp_replace(marked, r"^/+|/+$", "")


def _alike() -> Column:
    """Whether a branch and its leader, the struct `top`, differ by less than the Hoeffding bound in every share."""
    width = math.sqrt(0.5 * math.log(2 / ALPHA))

    def near(count: str, of: str) -> Column:
        mine, its = F.col(of), F.col(f"top.{of}")
        bound = width * (1 / F.sqrt(mine) + 1 / F.sqrt(its))
        return (mine == 0) | (its == 0) | (F.abs(F.col(count) / mine - F.col(f"top.{count}") / its) < bound)

    alike = near("blocked", "labelled")
    for count in ("ends", *FOLLOWING):
        alike = alike & near(count, "n")
    return alike


def merged(named: DataFrame) -> DataFrame:
    """(host, prefix, name, leader) for each branch of `named`: host, prefix, name and the columns of SUMS."""
    keys = ["host", "prefix"]
    best = F.lit(None).cast("struct<share:double,leader:string>")
    left = materialise(named.withColumn("labelled", F.col("blocked") + F.col("allowed")).withColumn("best", best), "left")
    done = []
    while not left.isEmpty():
        # Most labels first, then branches that are like no leader so far, then the largest.
        rank = F.struct("labelled", F.col("best").isNull().alias("free"), "n", "name", "blocked", "ends", *FOLLOWING)
        leaders = left.groupBy(*keys).agg(F.max(rank).alias("top"))
        met = left.join(leaders, keys).withColumn("alike", _alike())
        guided = F.col("top.labelled") > 0
        offer = F.struct((F.col("top.blocked") / F.col("top.labelled")).alias("share"), F.col("top.name").alias("leader"))
        better = F.least(F.coalesce("best", offer), offer)
        met = met.withColumn("best", F.when(guided & F.col("alike") & (F.col("labelled") == 0), better).otherwise(F.col("best")))
        joins = F.when(guided, F.when((F.col("labelled") > 0) & F.col("alike"), F.col("top.name"))).otherwise(
            F.when(F.col("best").isNotNull(), F.col("best.leader")).when(F.col("alike"), F.col("top.name"))
        )
        met = materialise(met.withColumn("leader", joins).drop("top", "alike"), "met")
        done.append(met.filter("leader IS NOT NULL").select(*keys, "name", "leader"))
        left = met.filter("leader IS NULL").drop("leader")
    return union(done) if done else named.select(*keys, "name", F.col("name").alias("leader"))


def union(parts: list[DataFrame]) -> DataFrame:
    """The rows of all parts."""
    result = parts[0]
    for more in parts[1:]:
        result = result.unionByName(more)
    return result


def _past_chains(state: DataFrame) -> DataFrame:
    """`state` with each row moved on to the next fork of its branch, or to its own end if that comes first.

    The rows of a branch fork where the first of them leaves the path of the last in order.
    """
    keys = ["host", "prefix"]
    last = materialise(state.groupBy(*keys).agg(F.max("rest").alias("last")), "last")
    leaves = F.filter(F.sequence(F.lit(0), F.size("rest") - 1), lambda i: ~F.get("rest", i).eqNullSafe(F.get("last", i)))
    forks = materialise(state.join(last, keys).groupBy(*keys).agg(F.min(F.array_min(leaves)).alias("fork")), "forks")
    step = F.least("fork", F.size("rest"))
    chain = F.array_join(F.transform(F.slice("rest", F.lit(1), step), lambda part: F.concat(F.lit("/"), part, F.lit("~"))), "")
    moved = state.join(forks, keys).withColumns({"prefix": F.concat("prefix", chain), "rest": F.slice("rest", step + 1, F.size("rest"))})
    return materialise(moved.drop("fork"), "shapes")


def templates(shapes: DataFrame) -> DataFrame:
    """(host, shape, template) for each row of `shapes`: host, shape, n, blocked, allowed."""
    state = shapes.select("host", "shape", "n", "blocked", "allowed", F.split("shape", "/").alias("rest"), F.lit("").alias("prefix"))
    state = materialise(state, "shapes")
    keys = ["host", "prefix"]
    done = []
    while True:
        ended = F.size("rest") == 0
        done.append(state.filter(ended))
        state = state.filter(~ended)
        if state.isEmpty():
            break
        state = _past_chains(state)
        done.append(state.filter(ended))
        state = state.filter(~ended)
        if state.isEmpty():
            break
        rows = state.withColumn("part", F.get("rest", F.lit(0)))
        counts = [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]
        after = F.get("rest", F.lit(1))
        counts.append(F.sum(F.when(after.isNull(), F.col("n")).otherwise(0)).alias("ends"))
        which = F.pmod(F.xxhash64(after), F.lit(CLASSES))
        counts += [F.sum(F.when(after.isNotNull() & (which == i), F.col("n")).otherwise(0)).alias(c) for i, c in enumerate(FOLLOWING)]
        branches = materialise(rows.groupBy(*keys, "part").agg(*counts), "branches")
        # Names that hardly repeat under one parent.
        word = ~F.col("part").isin("#", "?")
        parents = branches.groupBy(*keys).agg(F.count(F.when(word, 1)).alias("words"), F.sum(F.when(word, F.col("n"))).alias("word_n"))
        variable = word & (F.col("words") >= MANY) & (F.col("words") >= RARE * F.col("word_n"))
        general = branches.join(parents, keys).withColumn("name", F.when(variable, F.lit("*")).otherwise(F.col("part")))
        leaders = merged(general.groupBy(*keys, "name").agg(*[F.sum(c).alias(c) for c in SUMS]))
        tokens = general.select(*keys, "part", "name").join(leaders, [*keys, "name"])
        tokens = materialise(tokens.select(*keys, "part", F.concat("leader", F.lit("~")).alias("token")), "tokens")
        moved = rows.join(tokens, [*keys, "part"]).withColumns({"prefix": F.concat_ws("/", "prefix", "token"), "rest": F.slice("rest", F.lit(2), F.size("rest"))})
        state = materialise(moved.drop("part", "token"), "shapes")
    return union(done).select("host", "shape", F.col("prefix").alias("template"), "n", "blocked", "allowed")


def judge(pages: DataFrame, rules: list[Rule], purity: float = PURITY) -> DataFrame:
    """The rows of `pages` with host, path, rule, verdict (allow or block), template and purity.

    A URL that a rule fits gets the verdict of the longest one. Others are blocked if their template's smoothed purity is
    at least `purity`. A null URL, or one without `://`, has an empty host and path and is judged like others of that
    host. Columns of `pages` called like an added one are replaced; repeated rows get the same answer; an empty table
    gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    added = ["host", "path", "rule", "verdict", "template", "purity"]
    base = carried(pages, ("url", "string")).select("carried_row", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "ruled": verdict, "shape": shape(F.col("path"))})
    shapes = base.groupBy("host", "shape").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"),
    )
    tree = materialise(templates(shapes), "tree")
    tallies = [F.sum("blocked").alias("blocked"), F.sum(F.col("blocked") + F.col("allowed")).alias("labelled")]
    hosts = tree.groupBy("host").agg(*tallies)
    everywhere = hosts.agg(F.sum("blocked"), F.sum("labelled")).first()
    share = everywhere[0] / everywhere[1] if everywhere[1] else 0.0
    # At most even, so that it takes labelled URLs of the template itself to reject it.
    prior = F.least(F.lit(0.5), (F.col("blocked") + PRIOR_WEIGHT * share) / (F.col("labelled") + PRIOR_WEIGHT))
    sums = tree.groupBy("host", "template").agg(*tallies).join(hosts.select("host", prior.alias("prior")), "host")
    pure = (F.col("blocked") + PRIOR_WEIGHT * F.col("prior")) / (F.col("labelled") + PRIOR_WEIGHT)
    judged = tree.select("host", "shape", "template").join(sums.select("host", "template", pure.alias("purity")), ["host", "template"])
    judged = materialise(judged, "judged")
    method = F.when(F.col("purity") >= purity, "block").otherwise("allow")
    answered = base.join(judged, ["host", "shape"], "left").withColumn("verdict", F.coalesce("ruled", method))
    return answered.select(*[F.col(f"carried_row.`{c}`") for c in pages.columns if c not in added], *added)
