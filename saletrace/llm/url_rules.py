"""URL filters: a curated rule list, and association rules mined from it.

*Curated rules* (host, path) fit a host and its subdomains and the paths they
begin; the longest that fits decides.

*Mining.*  URLs that a curated rule decides are the labelled ones.  Each
becomes a set of tokens (domain labels, path segments, file ending, query
keys, scheme) plus its verdict, and Spark's FP-growth finds the frequent
combinations: those in a share ``SUPPORT`` of the labelled URLs, and in
``LEAST`` of them.  A combination implies ``block`` if the lower bound (Wilson
score, one-sided 95 %) of its confidence reaches ``CONFIDENCE``; one whose
subset already does so with at least the same confidence is pruned.

*Tokens alike.*  Tokens that stand in the very same labelled URLs say the same
thing, and a score of them would make a million combinations.  One of them is
mined for all; a rule then asks for any token of the class.  Nothing is lost:
that is the set of rules which name one token of each class.

*Matching.*  Each mined rule is indexed under its rarest token.  Every other
URL looks up its tokens in that inverted index (a join) and the rules found
are checked for all their tokens.  URLs share few token sets, since only
tokens that occur in rules count, so distinct sets are matched, not URLs.
A URL that a rule matches is blocked, any other allowed.

Support is a share of the labelled URLs, so the frequent tokens number at
most tokens per URL / ``SUPPORT``, at any size of the input.

Defined results.  Null URL, or one without ``://``: host and path empty, no
rule, allowed.  Null ids and repeated rows are carried through.  Very long
URL: split whole.  Ties: of two curated rules that fit, the longer one
decides, and no two of one length fit the same URL; equally rare tokens of a
mined rule are ordered by name.  Fewer than ``LEAST`` labelled URLs: no mined
rules.  No pages: no rows.  Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: fixed curated rules: verdict, host, path
CURATED = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
           ("allow", "com", "/fr/"), ("block", "com", "/de/"))
SUPPORT, CONFIDENCE, LEAST = 0.01, 0.9, 20
#: one-sided 95 % of the normal distribution
Z = 1.6448536269514722
SPREAD = 256
_BLOCK, _ALLOW = "verdict=block", "verdict=allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; empty where there is no
    ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(
        "substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def curated_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = CURATED):
    """``(rule, verdict)`` of the longest curated rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.filter(F.split(query, "&"), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    return F.array_distinct(F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("path:"), x)),
        F.transform(keys, lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1))),
        F.when(ending != "", F.array(F.concat(F.lit("ending:"), ending)))
        .otherwise(F.array().cast("array<string>")),
        F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))))))


def judged_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: Sequence[tuple[str, str, str]] = CURATED) -> DataFrame:
    """``id, host, path, rule, verdict, tokens``: what the curated rules say."""
    urls = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"))
    host, path = split_url(F.col("url"))
    placed = urls.select("id", "url", F.coalesce(host, F.lit("")).alias("host"),
                         F.coalesce(path, F.lit("")).alias("path"))
    rule, verdict = curated_rule(F.col("host"), F.col("path"), rules)
    tokens = F.when(F.instr("url", "://") > 0, url_tokens(F.col("url"), F.col("host"), F.col("path")))
    return placed.select("id", "host", "path", rule.alias("rule"), verdict.alias("verdict"),
                         F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))


def lower_bound(confidence: Column, n: Column) -> Column:
    """Wilson score lower bound of a share ``confidence`` of ``n`` cases."""
    spread = F.sqrt(confidence * (1 - confidence) / n + Z * Z / (4 * n * n))
    return (confidence + Z * Z / (2 * n) - Z * spread) / (1 + Z * Z / n)


def curated_tokens(rules: Sequence[tuple[str, str, str]]) -> list[list[str]]:
    """The tokens that each blocking curated rule spells."""
    return [[f"host:{x}" for x in host.split(".") if x] + [f"path:{x}" for x in path.split("/") if x]
            for verdict, host, path in rules if verdict == "block"]


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE,
               least: int = LEAST, curated: Sequence[tuple[str, str, str]] = CURATED) -> DataFrame:
    """``labelled``: ``tokens, verdict``.  Returns the pruned rules that imply
    ``block``: ``tokens`` (sorted, one of each class), ``alike`` (the tokens of
    each one's class), ``anchor`` (the rarest), ``confidence, support, bound``
    and ``repeats`` (whether one curated rule spells a token of each class)."""
    spark = labelled.sparkSession
    empty = ("tokens array<string>, alike array<array<string>>, anchor string, confidence double, "
             "support double, bound double, repeats boolean")
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("verdict="), "verdict")))
                              .alias("items"))
    # tokens under the support can be in no rule; dropping them first keeps
    # page numbers and the like out of the pattern trees
    total = baskets.count()
    if total < max(least, 1):
        return spark.createDataFrame([], empty)
    support = max(support, least / total)
    # 31 bits of a basket, so that sums of them stay within a long
    marks = [F.pmod(F.xxhash64("items", F.lit(seed)), F.lit(1 << 31)).alias(f"h{seed}")
             for seed in (1, 2)]
    counts = materialize(baskets.select(F.explode("items").alias("token"), *marks)
                         .groupBy("token").agg(F.count(F.lit(1)).alias("count"),
                                               F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
                         .filter(F.col("count") >= support * total), "frequent-tokens")
    classes: dict[tuple, list[str]] = {}
    for r in counts.collect():
        own = r.token if r.token in (_BLOCK, _ALLOW) else None
        classes.setdefault((own, r["count"], r.h1, r.h2), []).append(r.token)
    members = {min(c): sorted(c) for c in classes.values()}
    if not members:
        return spark.createDataFrame([], empty)
    known = F.array(*[F.lit(t) for t in sorted(members)])
    trimmed = baskets.select(F.array_intersect("items", known).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(trimmed)
    cases = F.round(F.col("support") * total / F.col("confidence"))
    found = materialize(model.associationRules
                        .filter((F.size("consequent") == 1) & (F.col("consequent")[0] == _BLOCK)
                                & ~F.array_contains("antecedent", _ALLOW))
                        .select(F.sort_array("antecedent").alias("tokens"), "confidence", "support",
                                lower_bound(F.col("confidence"), cases).alias("bound"))
                        .filter(F.col("bound") >= confidence), "mined-rules")
    # prune by a more general rule: compared through each rule's tokens
    general = found.select(F.col("tokens").alias("g"), F.col("confidence").alias("c"),
                           F.col("tokens")[0].alias("first"))
    special = found.select("tokens", "confidence", F.explode("tokens").alias("first"))
    beaten = special.join(general, "first").filter(
        (F.size("g") < F.size("tokens")) & (F.col("c") >= F.col("confidence"))
        & (F.size(F.array_except("g", "tokens")) == 0)).select("tokens").distinct()
    pruned = found.join(beaten, "tokens", "left_anti")
    rarest = (pruned.select("tokens", F.explode("tokens").alias("token")).join(counts, "token")
              .groupBy("tokens").agg(F.min(F.struct("count", "token")).alias("m"))
              .select("tokens", F.col("m.token").alias("anchor")))
    of_class = F.create_map(*[x for t in sorted(members)
                              for x in (F.lit(t), F.array(*map(F.lit, members[t])))])
    repeats = F.lit(False)
    for spelled in [F.array(*map(F.lit, s)) for s in curated_tokens(curated)]:
        repeats = repeats | F.forall("alike", lambda c: F.arrays_overlap(c, spelled))  # noqa: B023
    return materialize(pruned.join(rarest, "tokens")
                       .withColumn("alike", F.transform("tokens", lambda t: of_class[t]))
                       .select("tokens", "alike", "anchor", "confidence", "support", "bound",
                               repeats.alias("repeats")), "url-rules")


def match_rules(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``token_sets``: distinct ``tokens``.  Those that a rule matches, with
    the best confidence, through the inverted index of anchors."""
    posted = token_sets.select("tokens", F.explode("tokens").alias("anchor"))
    index = rules.select("anchor", F.col("tokens").alias("needs"), "confidence")
    return (posted.join(index, "anchor")
            .filter(F.size(F.array_except("needs", "tokens")) == 0)
            .groupBy("tokens").agg(F.max("confidence").alias("confidence")))


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 rules: Sequence[tuple[str, str, str]] = CURATED, support: float = SUPPORT,
                 confidence: float = CONFIDENCE, least: int = LEAST) -> DataFrame:
    """The id, ``host, path, rule, verdict`` of every page, and the
    ``confidence`` of the mined rule that blocked it, if one did."""
    judged = materialize(judged_urls(pages, id_col, url_col, rules), "urls")
    mined = mine_rules(judged.filter("rule is not null").select("tokens", "verdict"),
                       support, confidence, least, rules)
    used = mined.select(F.explode(F.arrays_zip("tokens", "alike")).alias("x")).select(
        "x.tokens", F.explode("x.alike").alias("token")).distinct().collect()
    # the tokens that occur in rules, each as the one mined for its class
    named = F.create_map(*[F.lit(v) for r in sorted(used) for v in (r.token, r.tokens)]) if used \
        else F.lit(None).cast("map<string,string>")
    signed = judged.withColumn("sign", F.when(F.col("rule").isNull(), F.sort_array(F.array_distinct(
        F.filter(F.transform("tokens", lambda t: named[t]), lambda t: t.isNotNull())))))
    sets = signed.filter(F.size("sign") > 0).select(F.col("sign").alias("tokens")).distinct()
    hits = match_rules(sets, mined).select(F.col("tokens").alias("sign"), "confidence")
    # many URLs share a set (and those a curated rule decides have none), so
    # URLs are dealt over SPREAD parts of a set, and the few sets repeated
    hits = hits.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    part = F.pmod(F.xxhash64("id", "host", "path"), F.lit(SPREAD)).cast("int")
    out = signed.withColumn("part", part).join(hits, ["sign", "part"], "left")
    verdict = F.coalesce("verdict", F.when(F.col("confidence").isNotNull(), F.lit("block"))
                         .otherwise(F.lit("allow")))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      verdict.alias("verdict"), "confidence")
