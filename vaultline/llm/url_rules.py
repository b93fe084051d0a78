"""URL filtering by association rules.

Labelled URLs become sets of typed tokens (host labels, path and query
tokens); bad ones also hold the item ``LABEL``. Spark's FP-growth finds the
sets frequent among bad ones, and rules "tokens -> LABEL" of any length are
kept that reach the support and confidence bounds and are not implied by a
shorter rule of at least the same confidence. Tokens that always occur together
are mined as one group (any of them says the same), and tokens that make a
rule sure alone, or that all URLs hold, are left out of longer sets, which they
cannot make surer; so a URL shape of many tokens is not mined in all its
subsets. Tokens that overlap without being equal still are. A rule is filed in an
inverted index under its rarest group; a URL meets only the rules filed under
its own tokens, and a rule fires when the URL holds a token of each group. A
URL is blocked when a rule fires.

A list of known (host, path) rules goes first: see :func:`list_verdict`.

Defined results: a null URL, or one without ``://``, has an empty host and
path, no token and the verdict allow; equal URLs are judged once, so copies
cost nothing and repeated rows agree; no labels: no rules. Labels that
disagree count as bad.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import fresh, materialize

LABEL = "label:block"
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.8
# (host, path, verdict) of the contract's list.
LIST_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
              ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", u) > 0, F.substr(u, F.locate("://", u) + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def list_verdict(host: Column, path: Column, rules=LIST_RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule fits
    its host and all subdomains when the path starts with the rule's."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct typed tokens: ``h:`` host labels and the registered domain,
    ``p:`` path words, ``q:`` query words. Numbers become ``#``."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)

    def split(c: Column, by: str, kind: str) -> Column:
        parts = F.filter(F.split(F.lower(c), by), lambda x: x != "")
        return F.transform(parts, lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[0-9]+", "#")))

    domain = F.regexp_extract(host, r"[^.]+\.[^.]+$", 0)
    return F.array_distinct(F.concat(
        split(host, r"\.", "h:"), F.when(domain != "", F.array(F.concat(F.lit("h:"), domain))).otherwise(F.array()),
        split(path, r"[^\p{L}\p{N}-]+", "p:"), split(query, "[&;]", "q:")))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``labelled``: (items array, bad boolean), one row per labelled URL. Gives
    (rule_id, groups, key_tokens, confidence, support): a rule fires on a URL
    that holds a token of each group; ``key_tokens`` is its rarest group."""
    # Copies of a token set are one row with counts.
    baskets = materialize(labelled.select(F.array_sort("items").alias("items"), F.col("bad").cast("long").alias("bad"))
                          .groupBy("items").agg(F.count("*").alias("n"), F.sum("bad").alias("n_bad")), "url-baskets")
    total, bad = baskets.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_bad"), F.lit(0))).first()
    least = max(1, math.ceil(min_support * total))
    # Tokens that are in the same token sets are one group, named by its smallest; sets are told by 128 bits of hashes.
    same = [F.bit_xor(F.xxhash64("items", F.lit(k))).alias(f"sign{k}") for k in (1, 2)]
    seen = (baskets.withColumn("token", F.explode("items"))
            .groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"), *same).filter(F.col("n_bad") >= least))
    groups = materialize(
        seen.groupBy("sign1", "sign2", "n", "n_bad").agg(F.array_sort(F.collect_list("token")).alias("members"))  # one URL's tokens
        .select(F.element_at("members", 1).alias("group"), "members", "n", "n_bad", (F.col("n_bad") / F.col("n")).alias("confidence")),
        "url-token-groups")
    # With a sure token, or with one that all sets hold, a longer rule is no surer than without its other tokens or without it.
    useful = groups.filter((F.col("confidence") < 1) & (F.col("n") < total)).select("group")
    grouped = (baskets.withColumn("group", F.explode("items")).join(useful, "group")
               .groupBy(F.col("items").alias("whole"), "n", "n_bad").agg(F.array_sort(F.collect_list("group")).alias("items")))
    grouped = materialize(grouped.groupBy("items").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")), "url-group-sets")
    ones = groups.select(F.array("group").alias("antecedent"), "n", "n_bad", "confidence")
    sets = materialize(_longer_sets(grouped, least), "url-frequent-sets") if bad >= least else ones.limit(0)
    kept = _not_implied(ones, sets, min_confidence)
    members = groups.select("group", "members", F.col("n").alias("n_group"))
    return (kept.withColumn("rule_id", F.array_join("antecedent", " "))
            .select("rule_id", "confidence", (F.col("n_bad") / F.lit(max(total, 1))).alias("support"), F.explode("antecedent").alias("group"))
            .join(members, "group").groupBy("rule_id", "confidence", "support")
            .agg(F.collect_list("members").alias("groups"), F.min_by("members", F.struct("n_group", "group")).alias("key_tokens")))


def _longer_sets(baskets: DataFrame, least: int) -> DataFrame:
    """(antecedent, n, n_bad, confidence) of all sets of two groups or more
    that ``least`` bad URLs hold: FP-growth on the bad ones; then all URLs that
    hold a set are counted by an index on its rarest group."""
    rows = (baskets.filter("n_bad > 0").select(F.concat("items", F.array(F.lit(LABEL))).alias("items"),
                                               F.explode(F.sequence(F.lit(1), F.col("n_bad"))).alias("copy")).select("items"))
    rows = materialize(rows, "url-bad-sets")
    n_rows = rows.count()
    if n_rows < least:
        empty = baskets.select(F.col("items").alias("antecedent"), "n", "n_bad", F.lit(0.0).alias("confidence"))
        return empty.limit(0)
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_rows).fit(rows)
    found = (model.freqItemsets.filter(F.array_contains("items", LABEL) & (F.size("items") > 2))
             .select(F.array_sort(F.array_remove("items", LABEL)).alias("antecedent"), F.col("freq").alias("n_bad")))
    found = materialize(found.withColumn("set_id", F.array_join("antecedent", " ")), "url-bad-frequent")
    placed = baskets.select(F.xxhash64("items").alias("id"), "items", "n")
    posted = placed.select("id", "n", F.explode("items").alias("group"))
    sizes = posted.groupBy("group").agg(F.sum("n").alias("n_group"))
    key = (found.select("set_id", F.explode("antecedent").alias("group")).join(sizes, "group")
           .groupBy("set_id").agg(F.min_by("group", F.struct("n_group", "group")).alias("group")))
    held = (posted.drop("n").join(found.select("set_id", "antecedent").join(key, "set_id"), "group")
            .join(placed, "id").filter(F.size(F.array_intersect("items", "antecedent")) == F.size("antecedent"))
            .groupBy("set_id").agg(F.sum("n").alias("n")))
    return found.join(held, "set_id").select("antecedent", "n", "n_bad", (F.col("n_bad") / F.col("n")).alias("confidence"))


def _not_implied(ones: DataFrame, sets: DataFrame, min_confidence: float) -> DataFrame:
    """Sets that reach ``min_confidence`` and are surer than all their parts.
    Parts of a frequent set are frequent, so a set learns the best of all its
    parts from those one group shorter: one join a length."""
    named = F.array_join("antecedent", " ")
    level = ones.withColumn("best", F.col("confidence"))
    kept = level
    longest = sets.agg(F.max(F.size("antecedent"))).first()[0] or 1
    for length in range(2, longest + 1):
        mine = sets.filter(F.size("antecedent") == length).withColumn("set_id", named)
        parts = (mine.select("set_id", "antecedent", F.explode("antecedent").alias("out"))
                 .select("set_id", F.array_join(F.array_remove("antecedent", F.col("out")), " ").alias("part")))
        sure = (parts.join(level.select(named.alias("part"), "best"), "part")
                .groupBy("set_id").agg(F.max("best").alias("before")))
        level = materialize(mine.join(sure, "set_id").withColumn("best", F.greatest("confidence", "before"))
                            .drop("set_id"), "url-sets-of-length")
        kept = kept.unionByName(level.filter("before < confidence").drop("before"))
        level = level.drop("before")
    return kept.filter(F.col("confidence") >= min_confidence).drop("best")


def match(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, mined_rule, confidence): the surest rule that fires on each
    distinct URL, by inverted index, named by the URL's own smallest token of each
    group (ties: the rule's name)."""
    distinct = urls.select(F.col(url).alias("url")).filter(F.col("url").isNotNull()).distinct()
    index = rules.select("rule_id", F.explode("key_tokens").alias("key"))
    met = (distinct.withColumn("key", F.explode(tokens(F.col("url")))).join(index, "key")
           .select("url", "rule_id").distinct())  # only tokens are posted, not the URL's whole set
    own = met.join(rules.select("rule_id", "groups", "confidence"), "rule_id").withColumn("items", tokens(F.col("url")))
    fired = (own.filter(F.forall("groups", lambda g: F.arrays_overlap(g, F.col("items"))))
             .withColumn("name", F.array_join(F.array_sort(F.transform(
                 "groups", lambda g: F.array_min(F.array_intersect(g, F.col("items"))))), " ")))
    return (fired.groupBy("url").agg(F.min(F.struct((-F.col("confidence")).alias("unsure"), "name")).alias("b"))
            .select("url", F.col("b.name").alias("mined_rule"), (-F.col("b.unsure")).alias("confidence")))


def judge(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", list_rules=LIST_RULES,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pages`` plus host, path, rule, verdict, mined_rule and confidence.
    ``labels``: (page_id, bad boolean); several rows of a page: bad if any is."""
    truth = (labels.filter(F.col("page_id").isNotNull() & F.col("bad").isNotNull())
             .groupBy(F.col("page_id").alias("_id")).agg(F.max("bad").alias("bad")))
    known = (pages.select(F.col(page_id).alias("_id"), tokens(F.col(url)).alias("items"))
             .filter(F.size("items") > 0).join(truth, "_id").select("items", "bad"))
    rules = materialize(mine_rules(materialize(known, "url-labelled"), min_support, min_confidence), "url-rules-kept")
    u, = fresh(pages, "_url")
    fired = match(pages, rules, url).withColumnRenamed("url", u)
    host, path = host_and_path(F.col(url))
    rule, verdict = list_verdict(F.col("host"), F.col("path"), list_rules)
    clash = [c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict", "mined_rule", "confidence")]
    return (pages.drop(*clash).join(fired, pages[url] == fired[u], "left").drop(u)
            .withColumn("host", host).withColumn("path", path).withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col("mined_rule").isNotNull(), F.lit("block"))
                                              .otherwise(F.lit("allow")))))
