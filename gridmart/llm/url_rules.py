"""URL filtering by explicit rules and by association rules mined from labels.

Explicit rules name a host (with its subdomains) and a path prefix; the longest that fits
decides.  Where none fits, mined rules decide: a URL is a set of tokens (host labels and
path segments by place, digits replaced, query keys, a fragment), FP-growth finds the sets that
enough bad URLs have, an absolute number however many are labelled; how many labelled URLs have each of
them is counted by one join, and sets with enough confidence become rules.  A rule with a shorter rule inside it that is as confident
says nothing new and is dropped.

What is mined stays bounded however many tokens URLs share.  Tokens that very same labelled URLs have are interchangeable: each
is a rule of its own, and the smallest stands for all in combinations.  A URL with more than ``WHOLE`` frequent tokens is given to FP-growth as
parts: its tokens in blocks of ``WHOLE / MAX_TOKENS``, and every ``MAX_TOKENS`` blocks together.  So any rule's tokens are together in a part, no
transaction has more than ``2 ** WHOLE`` subsets, and FP-growth's counts are not below the true ones, which the join then gives.

Matching is by inverted index: each rule is posted under its rarest token; the distinct token sets
of all URLs (a host or pattern that a third of all rows share is one set) look up their
tokens, and the rules found are checked for their other tokens.  All steps are DataFrame functions, and
the FP-growth of Spark's own library.

Defined results: a null url, or one without ``://``, has empty host and path, no tokens, and is allowed; very long
urls only have more tokens, all of which are read; rows that repeat an id are judged each by its own url; without labelled urls there are
no mined rules; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import LOWER, UPPER, Scratch

MIN_CONFIDENCE = 0.6
MIN_HITS = 10             # bad urls a rule must have, however many are labelled
MAX_TOKENS = 3            # in a rule
WHOLE = 12                # tokens of a transaction
MAX_EXPLICIT = 1000       # explicit rules; they are part of the plan

#: Verdict, host, path prefix.
EXPLICIT = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def explicit(host: Column, path: Column, rules: tuple = EXPLICIT) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    if len(rules) > MAX_EXPLICIT:
        raise ValueError(f"more than {MAX_EXPLICIT} explicit rules")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name, prefix in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(prefix))
        rule, verdict = F.when(fits, name + prefix).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens of a url."""
    labels = F.reverse(F.filter(F.split(host_of(url), "\\."), lambda x: x != ""))
    segments = F.filter(F.split(F.regexp_replace(F.translate(path_of(url), UPPER, LOWER), "[0-9]+", "#"), "/"), lambda x: x != "")
    query = F.regexp_extract(url, "(?s)^.*?://[^?#]*\\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    fragment = F.when(F.regexp_like(url, F.lit("(?s)^.*?://[^#]*#")), F.array(F.lit("f"))).otherwise(F.array().cast("array<string>"))
    tokens = F.concat(F.transform(labels, lambda x, i: F.concat(F.lit("h"), i, F.lit(":"), x)),
                      F.transform(segments, lambda x, i: F.concat(F.lit("p"), i, F.lit(":"), x)),
                      F.transform(keys, lambda x: F.concat(F.lit("q:"), x)), fragment)
    return F.coalesce(F.sort_array(F.array_distinct(tokens)), F.array().cast("array<string>"))


def parts_of(items: Column) -> Column:
    """Sorted items as transactions of at most ``WHOLE`` items that have any ``MAX_TOKENS`` of them together."""
    block = WHOLE // MAX_TOKENS
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(items) / block).cast("int") - 1), lambda i: F.slice(items, i * block + 1, F.lit(block)))
    last = F.size(blocks) - 1

    def after(i: Column) -> Column:
        """Places of the blocks behind one."""
        return F.when(i < last, F.sequence(i + 1, last)).otherwise(F.array().cast("array<int>"))

    triples = F.flatten(F.transform(F.sequence(F.lit(0), last), lambda i: F.flatten(F.transform(after(i), lambda j: F.transform(
        after(j), lambda k: F.concat(F.get(blocks, i), F.get(blocks, j), F.get(blocks, k)))))))
    return F.when(F.size(items) <= WHOLE, F.array(items)).otherwise(triples)


def mine(labelled: DataFrame, scratch: Scratch, min_support: float = 0.0,
         min_confidence: float = MIN_CONFIDENCE, min_hits: int = MIN_HITS) -> DataFrame | None:
    """``labelled``: ``url``, ``bad`` (boolean).  Returns ``antecedent`` (sorted tokens), ``anchor`` (the rarest),
    ``support``, ``confidence``; None without labelled urls.  ``min_support`` asks for a share of the labelled urls besides ``min_hits``."""
    sets = labelled.filter("url IS NOT NULL AND bad IS NOT NULL").select(tokens_of(F.col("url")).alias("tokens"), "bad").filter(
        (F.size("tokens") > 0) | F.col("bad"))
    kinds = scratch.write(sets.groupBy("tokens").agg(F.count(F.lit(1)).alias("urls"), F.sum(F.col("bad").cast("long")).alias("wrong")), "kinds")
    n = kinds.agg(F.sum("urls")).first()[0]
    if not n:
        return None
    need = max(1, min_hits, math.ceil(min_support * n))
    # the frequent tokens; those that the same labelled urls have share their sums
    kind = [F.xxhash64("tokens", F.lit(i)).cast("decimal(20,0)") for i in (0, 1)]
    single = kinds.select(F.explode("tokens").alias("token"), "urls", "wrong", kind[0].alias("h0"), kind[1].alias("h1")).groupBy("token").agg(
        F.sum("urls").alias("token_freq"), F.sum("wrong").alias("hits"), F.sum("h0").alias("s0"), F.sum("h1").alias("s1"))
    single = scratch.write(single.filter(F.col("hits") >= need), "single")
    alike = single.groupBy("s0", "s1").agg(F.min("token").alias("token")).select("token")
    items = kinds.filter("wrong > 0").select("wrong", F.col("tokens").alias("_of"), F.explode("tokens").alias("token")).join(alike, "token").groupBy(
        "_of", "wrong").agg(F.sort_array(F.collect_set("token")).alias("items"))
    wrong = scratch.write(items.select("wrong", F.explode(parts_of(F.col("items"))).alias("items")).select(
        "items", F.explode(F.sequence(F.lit(1).cast("long"), "wrong")).alias("_copy")).select("items"), "transactions")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (need - 0.5) / max(wrong.count(), 1)), minConfidence=min_confidence).fit(wrong)
    several = model.freqItemsets.filter(F.size("items").between(2, MAX_TOKENS)).select(F.sort_array("items").alias("antecedent"))
    frequent = scratch.write(several.unionByName(single.select(F.array("token").alias("antecedent"))), "frequent")
    # how many labelled urls, and how many bad ones, have each of them: found by their rarest token
    anchored = frequent.select("antecedent", F.explode("antecedent").alias("token")).join(single.select("token", "token_freq"), "token").groupBy(
        "antecedent").agg(F.min(F.struct("token_freq", "token")).alias("least"))
    anchored = anchored.select("antecedent", F.col("least.token").alias("anchor"))
    having = kinds.select("tokens", "urls", "wrong", F.explode("tokens").alias("anchor")).join(anchored, "anchor").filter(
        F.size(F.array_except("antecedent", "tokens")) == 0)
    rules = having.groupBy("antecedent").agg(F.sum("urls").alias("freq"), F.sum("wrong").alias("hits")).withColumn(
        "confidence", F.col("hits") / F.col("freq")).filter((F.col("hits") >= need) & (F.col("confidence") >= min_confidence))
    rules = scratch.write(rules.withColumn("support", F.col("hits") / F.lit(float(n))), "confident")
    # rules with a shorter one inside that is as confident
    shorter = rules.select(F.col("antecedent").alias("inner"), F.col("confidence").alias("inner_confidence"))
    part = rules.select("antecedent", "confidence", F.explode("antecedent").alias("leave")).select(
        "antecedent", "confidence", F.array_remove("antecedent", F.col("leave")).alias("inner"))
    pairs = part.join(shorter, "inner").unionByName(
        rules.filter(F.size("antecedent") == 3).select(
            "antecedent", "confidence", F.explode(F.transform("antecedent", lambda x: F.array(x))).alias("inner")).join(shorter, "inner"))
    idle = pairs.filter("inner_confidence >= confidence").select("antecedent").distinct()
    kept = rules.join(idle, "antecedent", "left_anti")
    posted = kept.select("antecedent", "support", "confidence", F.explode("antecedent").alias("token")).join(single, "token")
    return scratch.write(posted.groupBy("antecedent", "support", "confidence").agg(
        F.min_by("token", F.struct("token_freq", "token")).alias("anchor")), "rules")


def judge(urls: DataFrame, rules: DataFrame | None, scratch: Scratch, url: str = "url",
          explicit_rules: tuple = EXPLICIT) -> DataFrame:
    """All columns of ``urls`` in ``row``, and ``host``, ``path``, ``rule``, ``verdict``, ``mined`` (the tokens of the most
    confident mined rule that fits), ``confidence``."""
    name = F.col(f"`{url}`")
    rule, verdict = explicit(F.col("host"), F.col("path"), explicit_rules)
    base = urls.select(F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("row"), host_of(name).alias("host"),
                       path_of(name).alias("path"), tokens_of(name).alias("tokens"))
    base = base.withColumn("rule", rule).withColumn("explicit", verdict)
    if rules is None:
        found = base.withColumn("mined", F.lit(None).cast("array<string>")).withColumn("confidence", F.lit(None).cast("double"))
    else:
        sets = base.filter("explicit IS NULL").select("tokens").distinct()
        hits = sets.select("tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor").filter(
            F.size(F.array_except("antecedent", "tokens")) == 0)
        best = hits.groupBy("tokens").agg(F.max_by(F.struct(F.col("antecedent").alias("mined"), "confidence"), F.struct(
            "confidence", "support", "antecedent")).alias("best"))
        best = scratch.write(best.select("tokens", "best.mined", "best.confidence"), "matched")
        # only urls that no explicit rule decides look a mined one up
        asked = F.when(F.col("explicit").isNull(), F.col("tokens"))
        found = base.withColumn("asked", asked)
        found = found.filter("asked IS NOT NULL").join(best.withColumnRenamed("tokens", "asked"), "asked", "left").unionByName(
            found.filter("asked IS NULL").withColumn("mined", F.lit(None).cast("array<string>")).withColumn(
                "confidence", F.lit(None).cast("double")))
    return found.select("row", "host", "path", "rule", F.coalesce(
        "explicit", F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"), "mined", "confidence")
