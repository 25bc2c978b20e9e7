"""Pairs of sets from different components that can be similar, by exact prefixes.

Ordered from the rarest item on, two sets whose Jaccard similarity is at least ``threshold``
percent share one of the first items of each, and what is left of both sets from their first shared
item on bounds what they have in common.  So sets do not meet at what very many of them hold,
unless that is all but a little of them.  All joins are on items, between tables whose keys adaptive
execution can split; members of one component never pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch, union_all
from gridmart.llm.graph import components

HUB_ROUNDS = 2


def similar_sizes(x: str, y: str, threshold: int) -> Column:
    return 100 * F.least(x, y) >= threshold * F.greatest(x, y)


def rare_items(sets: DataFrame, threshold: int) -> DataFrame:
    """``node``, ``n`` (size), ``item``, ``rest``: the first items of each set (``node``, ``items``), with how many items of
    the set are left from that one on."""
    items = sets.select("node", F.size("items").cast("long").alias("n"), F.explode("items").alias("item"))
    shared = items.groupBy("item").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    # items that one set alone holds come first and meet nothing
    own = Window.partitionBy("node", "n")
    listed = items.join(shared, "item").select(
        "node", "n", "item", F.row_number().over(own.orderBy("held", "item")).alias("at"), F.count(F.lit(1)).over(own).alias("listed"))
    # this one is at place n - listed + at of n; the places up to n - ceil(threshold% of n) + 1 count
    return listed.withColumn("rest", F.col("listed") - F.col("at") + 1).filter(
        F.col("rest") >= F.ceil(F.col("n") * threshold / 100)).select("node", "n", "item", "rest")


def open_rows(rows: DataFrame, group: DataFrame, scratch: Scratch, *key: str, held: str | None = None) -> DataFrame:
    """The rows (``node``, ...) whose ``key`` holds nodes of more than one component, with that as ``c``; ``group``: ``node``,
    ``component`` of nodes that are linked already.  ``held``: a column for the number of rows of the key."""
    placed = scratch.write(rows.join(group, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component"), "placed")
    counts = [F.count(F.lit(1)).alias(held)] if held else []
    open_ = placed.groupBy(*key).agg(F.min("c").alias("low"), F.max("c").alias("high"), *counts).filter("low < high").drop("low", "high")
    open_ = scratch.write(open_, "open")
    out = scratch.write(placed.join(open_, list(key)), "open-rows")
    scratch.drop(placed)
    scratch.drop(open_)
    return out


def cross_links(sets: DataFrame, links: DataFrame, threshold: int, scratch: Scratch,
                verify: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Links (``a``, ``b``) that join further components: of all pairs of ``sets`` (``node``, ``items``) across components that can
    be similar, those that ``verify`` keeps and writes.  ``links`` are the links known so far.

    First each item links its sets to one of them, ``HUB_ROUNDS`` times (the set with most left from there on, then one picked
    by a hash): a group in which most sets are similar grows together without making its pairs.
    Then all pairs that still are in different components are verified."""
    def possible(rest_x: str, n_x: str, rest_y: str, n_y: str) -> Column:
        """Whether sets that first meet with so much left can be similar."""
        return (100 + threshold) * F.least(rest_x, rest_y) >= threshold * (F.col(n_x) + F.col(n_y))

    def side(x: str, frame: DataFrame) -> DataFrame:
        return frame.select("item", *[F.col(c).alias(c + x) for c in frame.columns if c != "item"])

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("node_1", "node_2").alias("a"), F.greatest("node_1", "node_2").alias("b")).distinct()

    fit = possible("rest_1", "n_1", "rest_2", "n_2") & similar_sizes("n_1", "n_2", threshold)
    found, group = [], components(links, scratch)
    rare = open_rows(rare_items(sets, threshold), group, scratch, "item")
    for i in range(HUB_ROUNDS):
        pick = F.struct((F.col("rest") / F.col("n")) if i == 0 else F.lit(0.0), F.xxhash64("node", F.lit(i)), "node", "n", "rest", "c")
        hubs = scratch.write(rare.groupBy("item").agg(F.max(pick).alias("hub")).select(
            "item", *[F.col(f"hub.{c}").alias(c) for c in ("node", "n", "rest", "c")]), "hubs")
        pairs = side("_1", rare).join(side("_2", hubs), "item").filter(F.col("c_1") != F.col("c_2")).filter(fit)
        pairs = scratch.write(ordered(pairs), "hub-pairs")
        found.append(verify(pairs, f"hub{i}"))
        known = union_all([group.select(F.col("node").alias("a"), F.col("component").alias("b")), found[-1]])
        joined = components(known, scratch)
        further = open_rows(rare.drop("c"), joined, scratch, "item")
        for done in (hubs, pairs, group, rare):
            scratch.drop(done)
        group, rare = joined, further
        scratch.settle()

    parts = rare.groupBy("item", "c").agg(F.max("rest").alias("rest"), F.min("n").alias("n"))
    crossing = side("_1", parts).join(side("_2", parts), "item").filter(
        (F.col("c_1") < F.col("c_2")) & possible("rest_1", "n_1", "rest_2", "n_2")).drop("rest_1", "n_1")
    crossing = crossing.join(side("_1", rare), ["item", "c_1"]).filter(possible("rest_1", "n_1", "rest_2", "n_2")).drop("rest_2", "n_2")
    crossing = crossing.join(side("_2", rare), ["item", "c_2"]).filter(fit)
    found.append(verify(scratch.write(ordered(crossing), "cross-pairs"), "cross"))
    return union_all(found)
