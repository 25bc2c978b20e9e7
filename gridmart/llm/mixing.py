"""Mixing sources to target word counts by the cube method.

A source's target is its weight's share of the total, at most ``MOST`` times its own size; what
is above goes to the others by weight until none is above.  A document is taken
``floor(target / size of source)`` times for certain and once more with the fraction as its
inclusion probability.  The fractions are settled by the cube method, balanced on documents and
words: of three undecided documents the probabilities move along the null-space of the two
constraints until one is 0 or 1, which keeps both totals of the source exactly; two
undecided documents at most are left.

Distribution: each source is dealt into groups of at most about ``GROUP_ROWS`` documents by a hash
(a source with a third of all rows has so many groups more); each group's flight leaves two
documents at most, and these are dealt into fewer groups, round after round, until one group of a
source is left.  One group of each source waits for that last flight, so that what is left of the others has
documents of all sizes to move against; of them a few wait for the landing, and land together with the
last two on the whole choice nearest to the expected words.  Very
large documents go into a flight first, so those left at its end are seldom large.

Defined results: a null text has size 0; a source is null, too, as a value of its own, last in order;
repeated rows and doc_ids are documents of their own; documents of equal size are ordered by a hash;
sources without words get target 0 and nothing taken; an empty table gives an empty
result.  Reruns agree, whatever files and partitions the rows come in: all order and chance comes from hashes of doc_id, source and text, and
rows that share all three are numbered (which of them gets which number makes no difference).  Columns other than
the three are carried as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import WORD_PATTERN, Scratch, global_rank, union_all

WEIGHTS = (5, 2, 1)       # by the source's place in order, repeating
SHARE = 1.5               # of all words
MOST = 2.0                # of a source's words
GROUP_ROWS = 2000
LARGE = 4                 # times a group's mean size
HELD = 12                 # documents that wait for a source's landing


def targets(sizes: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """``sizes``: ``source``, ``source_size``, one row per source.  Adds ``target`` (double)."""
    ranked = global_rank(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_rank", scratch)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = scratch.write(ranked.select("source", "source_size", weight.alias("_w"),
                                         (F.col("source_size") * most).alias("_cap")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # the level, in words per weight, at which the sources below their cap fill the rest
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("_w") * level >= F.col("_cap")
        row = ranked.agg(F.sum(F.when(full, F.col("_cap")).otherwise(0.0)).alias("given"),
                         F.sum(F.when(full, 0.0).otherwise(F.col("_w"))).alias("open"),
                         F.sum(full.cast("long")).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (share * total - row["given"]) / row["open"]
    goal = F.least(F.col("_cap"), F.col("_w") * F.lit(float(level or 0.0)))
    return ranked.select("source", "source_size", goal.alias("target"))


def flight(chance: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Moves inclusion probabilities until at most two are not 0 or 1; their sum and the sum of
    probability times size stay as they are."""
    chance, random = chance.copy(), np.random.default_rng(seed)
    open_: list[int] = []
    for k in range(len(chance)):
        if not 0.0 < chance[k] < 1.0:
            continue
        open_.append(k)
        if len(open_) < 3:
            continue
        a, b, c = open_
        move = np.array([size[c] - size[b], size[a] - size[c], size[b] - size[a]])   # sums to 0, also times size
        if not move.any():
            move = np.array([1.0, -1.0, 0.0])
        now = chance[open_]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(move > 0, (1 - now) / move, np.where(move < 0, -now / move, np.inf)).min()
            down = np.where(move > 0, now / move, np.where(move < 0, (now - 1) / move, np.inf)).min()
        now = now + move * (up if random.random() * (up + down) < down else -down)
        now[np.abs(now) < 1e-9] = 0.0
        now[np.abs(now - 1) < 1e-9] = 1.0
        chance[open_] = now
        open_ = [k for k in open_ if 0.0 < chance[k] < 1.0]
    return chance


def landing(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Settles the few probabilities that are left on the choice whose words, then whose documents, are
    nearest to the expected ones."""
    left = np.flatnonzero((chance > 0) & (chance < 1))
    picks = (np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1).astype(float)
    cost = (np.abs(picks @ size[left] - chance[left] @ size[left]) + 0.5 * np.abs(picks.sum(axis=1) - chance[left].sum()))
    out = chance.copy()
    out[left] = picks[int(cost.argmin())]
    return out


def flight_and_landing(chance: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """The last flight of a source: ``HELD`` undecided documents of all sizes wait for the landing, which
    then has sizes enough to come near the expected words."""
    waiting = np.flatnonzero((chance > 0) & (chance < 1) & (size > 0))
    waiting = waiting[np.unique(np.linspace(0, len(waiting) - 1, HELD).astype(int))] if len(waiting) else waiting
    flying = np.setdiff1d(np.arange(len(chance)), waiting)
    out = chance.copy()
    out[flying] = flight(chance[flying], size[flying], seed)
    return landing(out, size)


def numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``_copy``: 0, 1, ... among those that share ``_h0`` and ``_h1``, however many they are: their places in the order of
    all repeated rows, less the first of their own."""
    key = ["_h0", "_h1"]
    repeated = scratch.write(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select(*key), "repeated")
    again = scratch.write(global_rank(rows.select(*key, "_row").join(repeated, key), [*key, "_row"], "_place", scratch), "places")
    first = again.groupBy(*key).agg(F.min("_place").alias("_first"))
    again = again.join(first, key).select("_row", (F.col("_place") - F.col("_first")).alias("_copy"))
    return rows.join(again, "_row", "left").withColumn("_copy", F.coalesce("_copy", F.lit(0).cast("long")))


def mix(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        carry: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        most: float = MOST, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per document: ``row`` (the columns ``carry``; the doc_id alone, when none are named),
    ``size``, ``source_size``, ``target``, ``copies``, ``taken``."""
    row = F.struct(*[F.col(f"`{c}`") for c in (carry or [doc_id])])
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    rows = scratch.write(docs.select(row.alias("row"), F.col(doc_id).alias("_id"), F.col(source).alias("source"),
                                     size.alias("size"), *[F.xxhash64(doc_id, source, text, F.lit(i)).alias(f"_h{i}") for i in (0, 1)]
                                     ).withColumn("_row", F.monotonically_increasing_id()), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    goal = targets(sizes.select("source", "source_size"), scratch, weights, share, most)
    goal = scratch.write(goal.withColumnRenamed("source", "_s").join(
        sizes.select(F.col("source").alias("_s2"), "_n"), F.col("_s").eqNullSafe(F.col("_s2"))).drop("_s2"), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sure = F.floor(ratio + 1e-12)
    # the order inside a flight: large first, equals by hash
    units = numbered(rows.drop("row"), scratch).join(goal, F.col("source").eqNullSafe(F.col("_s"))).select(
        "_row", F.xxhash64("_h0", "_h1", "_copy").alias("_order"), F.hash("source").alias("_source"), "source", "size", "_n",
        F.greatest(ratio - sure, F.lit(0.0)).alias("chance"))
    units = units.withColumn("_groups", F.ceil(F.col("_n") / group_rows)).drop("_n")
    units = scratch.write(units.withColumn("_waits", F.pmod("_order", "_groups") == 0), "units")

    def settle(part: pd.DataFrame) -> pd.DataFrame:
        # very large documents first, then the others in hashed order: only against sizes that differ much can a
        # large document's probability move far before the others are settled
        part["_large"] = np.where(part["size"] > LARGE * max(1.0, part["size"].mean()), -part["size"], 0)
        part = part.sort_values(["_large", "_order", "_row"], ignore_index=True).drop(columns="_large")
        n = part["size"].to_numpy(float)
        last = part["_groups"].iloc[0] == 1
        move = flight_and_landing if last else flight
        part["chance"] = move(part["chance"].to_numpy(float), n, int(part["_order"].iloc[0]) & 0x7FFFFFFF)
        return part.drop(columns="_group")

    settled, most_groups = [], units.agg(F.max("_groups")).first()[0] or 0
    while most_groups:
        waits = F.col("_waits") & (F.col("_groups") > 1)
        dealt = units.filter(~waits).withColumn("_group", F.pmod("_order", F.col("_groups")))
        out = scratch.write(dealt.groupBy("source", "_group").applyInPandas(settle, units.schema), "flight")
        whole = (F.col("chance") <= 0) | (F.col("chance") >= 1)
        settled.append(out.filter(whole).select("_row", F.col("chance").cast("long").alias("extra")))
        # two documents at most are left of a group
        units = out.filter(~whole).unionByName(units.filter(waits)).withColumn("_groups", F.ceil(F.col("_groups") * 2 / group_rows))
        most_groups = 0 if most_groups == 1 else -(-most_groups * 2 // group_rows)
    if not settled:
        settled = [units.select("_row", F.lit(0).cast("long").alias("extra"))]
    copies = (sure + F.coalesce("extra", F.lit(0))).cast("long")
    return (rows.join(goal, F.col("source").eqNullSafe(F.col("_s"))).join(union_all(settled), "_row", "left")
            .select("row", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken")))
