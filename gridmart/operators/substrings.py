"""Which texts contain which words, through an index of character n-grams (J8, P17, P18 at size).

A word of ``GRAM`` characters or more can only be in a text that has all its n-grams.  Texts are posted under their n-grams; a word looks up
one of its own, the rarest among the texts, and only the texts found there are compared (``contains``).  So the work goes
with the postings of rare n-grams, not with words times texts.  Shorter words look up n-grams of their own length; an empty word is in
every text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def grams(text: Column, size: int) -> Column:
    """Distinct substrings of ``size`` characters."""
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    cut = F.transform(places, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def candidates(texts: DataFrame, words: DataFrame, on: Sequence[str] = (), text: str = "text", word: str = "word") -> DataFrame:
    """Pairs (``on``, ``text``, ``word``) that the index lets through, each once.  ``texts`` and ``words`` are made distinct; a NULL is in
    no pair.  With ``on``, pairs have equal keys there."""
    on = list(on)
    texts = texts.select(*on, text).dropna().distinct()
    words = words.select(*on, word).dropna().distinct()
    found = words.filter(F.length(word) == 0).join(texts, on) if on else words.filter(F.length(word) == 0).crossJoin(texts)
    found = found.select(*on, text, word)
    for size in range(1, GRAM + 1):
        fits = F.length(word) >= GRAM if size == GRAM else F.length(word) == size
        posted = texts.select(*on, text, F.explode(grams(F.col(text), size)).alias("_gram"))
        held = posted.groupBy(*on, "_gram").agg(F.count(F.lit(1)).alias("_held"))
        asked = words.filter(fits).select(*on, word, F.explode(grams(F.col(word), size)).alias("_gram"))
        # a word with an n-gram that no text has is in none
        counted = asked.join(held, [*on, "_gram"], "left").groupBy(*on, word).agg(
            F.min(F.struct(F.coalesce("_held", F.lit(0).cast("long")).alias("held"), "_gram")).alias("_least"))
        rarest = counted.filter("_least.held > 0").select(*on, word, F.col("_least._gram").alias("_gram"))
        found = found.unionByName(posted.join(rarest, [*on, "_gram"]).select(*on, text, word))
    return found


def contained(texts: DataFrame, words: DataFrame, on: Sequence[str] = (), text: str = "text", word: str = "word") -> DataFrame:
    """Pairs (``on``, ``text``, ``word``) of which the text contains the word, each once."""
    return candidates(texts, words, on, text, word).filter(F.col(text).contains(F.col(word)))


def first_rule(df: DataFrame, text: str, rules: DataFrame, out: str, default: Column) -> DataFrame:
    """``df`` with ``out``: the label of the first rule (least ``priority``) whose ``needle`` the lower-cased ``text`` contains; ``default``
    where none is.  ``rules``: ``priority``, ``needle`` (lower case), ``label``; any number of them.

    Each distinct text is matched once; rows get their label by a join that Spark broadcasts while the labels are few."""
    low = F.lower(F.col(f"`{text}`"))
    texts = df.select(low.alias("_text")).distinct()
    pairs = contained(texts, rules.select(F.col("needle").alias("_needle")), text="_text", word="_needle")
    best = pairs.join(rules.select("priority", F.col("needle").alias("_needle"), F.col("label").alias("_label")), "_needle").groupBy(
        F.col("_text").alias("_matched")).agg(F.min(F.struct("priority", "_label")).alias("_best"))
    joined = df.withColumn("_low", low).join(best, F.col("_low") == F.col("_matched"), "left")
    return joined.withColumn(out, F.coalesce("_best._label", default)).drop("_low", "_matched", "_best")


def rules_frame(spark, rules: Sequence) -> DataFrame:
    """A rule table from (label, needles) rules in order."""
    rows = [(i, n, label) for i, (label, n) in enumerate((label, n) for label, needles in rules for n in needles)]
    return spark.createDataFrame(rows, "priority int, needle string, label string")
