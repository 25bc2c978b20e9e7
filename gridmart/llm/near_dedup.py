"""Near-duplicate documents by an inverted join on MinHash signature coordinates.

A document's set holds its distinct five-word shingles; documents with equal sets are one class,
and the class's smallest doc_id stands for it.  Each representative has a signature of ``K``
coordinates, and is posted under each (coordinate, value) pair.  Two representatives are
candidates when at least ``MATCH`` of the ``K`` coordinates collide.  Prefix merging: ordered
by how many documents a posting has, two signatures with ``MATCH`` collisions share one of the
first ``K - MATCH + 1`` postings of each, so only those postings are merged, the long lists
at the other end are skipped, and a list with one document takes up a place of the prefix
without any work.  The collisions of a candidate pair are then counted on the two signatures,
and pairs above the threshold are confirmed on the full sets.

A pair at similarity 0.75 has 48 of 64 collisions on average and fewer than ``MATCH`` with a
chance of about 2 in a million; no other step loses a link.

Large groups: pairs inside a group that is connected already are not needed, so not all are made.
First each posting links its members to one of its documents only, that which shares most of its
own postings (within a factor of the sizes that can be similar); the links found give components.
The documents of postings that hold more than one component meet once more by exact prefixes of their
sets: ordered by how many of these documents have a shingle, similar sets share one of their rarest quarter, and what is
left of both sets there bounds what they have in common.  So copies which were each changed in many places do not meet at
what they all have, and all pairs across components that can be similar are confirmed.
Components come from ``graph.components``.

Sets hold 64-bit hashes of shingles, built from hashes of words; a class is a 128-bit digest
of a sorted set.

Defined results: a null or empty text, or one without words, has an empty set, size 0 and no link; fewer than
five words make one shingle of them all; rows that repeat a doc_id are one node, linked by any of its
texts; a row without doc_id has no component (null) and is kept; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch, small_batches
from gridmart.llm.graph import components
from gridmart.llm.prefix_join import cross_links, open_rows, similar_sizes

WORDS = 5
THRESHOLD = 75            # percent: 100 * intersection >= THRESHOLD * union
K, MATCH = 64, 32
CACHED_WORDS = 200_000
CHUNK = 1 << 13

_random = np.random.default_rng(20240601)
_MULTIPLY = _random.integers(1, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _random.integers(0, 1 << 63, K, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS and len(word) <= 32:
            self[word] = value
        return value


_words = _Words()


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "replace").lower().split()    # bytes: A-Z, and the six ASCII spaces
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(size, len(ids))
    out = np.zeros(len(ids) - size + 1, np.uint64)
    for i in range(size):
        out = out * _BASE + ids[i: len(ids) - size + 1 + i]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(items: np.ndarray) -> np.ndarray:
    """The least 32-bit value of each of ``K`` hash functions over a set."""
    out = np.full(K, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(items), CHUNK):
        hashed = (items[at: at + CHUNK, None] ^ _XOR) * _MULTIPLY
        out = np.minimum(out, hashed.min(axis=0) >> np.uint64(32))
    return out.astype(np.uint32).view(np.int32)


def describe(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``k1``, ``k2`` (digest of the set), ``sig`` (null for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, sigs = [], [], []
            for body in batch.column(1).to_pylist():
                items = shingles(body)
                n.append(len(items))
                keys.append(np.frombuffer(xxhash.xxh3_128_digest(items.tobytes()), np.int64).tolist())
                sigs.append(signature(items) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
                 pa.array([k[1] for k in keys], pa.int64()), pa.array(sigs, pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "k1", "k2", "sig"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, sig array<int>")


def confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) that are linked on their full sets; ``docs``: ``doc_id``, ``text``."""
    body = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(body, "a").join(body.select(F.col("a").alias("b"), F.col("text_a").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[str, np.ndarray] = OrderedDict()

        def items(body: str) -> np.ndarray:
            if body not in recent:
                recent[body] = shingles(body)
                if len(recent) > 32:
                    recent.popitem(last=False)
            return recent[body]

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = items(x), items(y)
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= THRESHOLD * (len(p) + len(q) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``node``, ``items``: the sets of documents (``doc_id``, ``text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [shingles(t).view(np.int64) for t in batch.column(1).to_pylist()], pa.list_(pa.int64()))], ["node", "items"])

    return docs.select("doc_id", "text").mapInArrow(run, "node long, items array<long>")


def prefix_postings(sigs: DataFrame, k: int, match: int) -> DataFrame:
    """``doc``, ``n``, ``shared`` (postings with other documents), ``token``, ``step``: the postings that must be merged to find
    every pair with ``match`` of ``k`` collisions; ``sigs``: ``doc``, ``n``, ``k1``, ``sig``."""
    # a token is a coordinate and its value in one integer
    tokens = sigs.select("doc", "k1", "n", F.posexplode("sig").alias("i", "v")).select(
        "doc", "k1", "n", (F.shiftleft(F.col("i").cast("long"), 32) + F.col("v").cast("long") + (1 << 31)).alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("posted")).filter("posted > 1")
    # of a document's k tokens those with one document come first in the order and are not in the list
    listed = tokens.join(shared, "token").groupBy("doc", "k1", "n").agg(
        F.sort_array(F.collect_list(F.struct("posted", "token"))).alias("list"))
    listed = listed.withColumn("shared", F.size("list")).withColumn("places", F.col("shared") - (match - 1)).filter("places > 0")
    # documents whose sizes can be similar are in one or two neighbouring steps: each goes to both of its keys
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / THRESHOLD) + 1e-6))
    return listed.select("doc", "n", "shared", F.explode(F.slice("list", F.lit(1), F.col("places"))).alias("t"), step.alias("step")).select(
        "doc", "n", "shared", F.col("t.token").alias("token"), F.explode(F.array("step", F.col("step") + 1)).alias("step")).distinct()


def near_groups(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    small_batches(docs.sparkSession)
    rows = scratch.write(describe(docs, doc_id, text), "rows")
    full = rows.filter("sig IS NOT NULL AND doc_id IS NOT NULL")
    classes = scratch.write(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes")
    placed = scratch.write(full.select("doc_id", "k1", "k2").join(classes, ["k1", "k2"]).select("doc_id", "rep").distinct(),
                           "placed")
    copies = placed.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = scratch.write(full.join(classes, ["k1", "k2"]).filter("doc_id = rep").select(
        F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "k1", "sig").dropDuplicates(["doc", "k1"]), "reps")

    postings = scratch.write(prefix_postings(reps, K, MATCH), "postings")
    bodies = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    # the document that shares most of its postings is in the middle of a group, and links most of it
    hubs = scratch.write(postings.groupBy("token", "step").agg(
        F.max(F.struct("shared", (-F.col("doc")).alias("minus"), "n")).alias("hub"), F.count(F.lit(1)).alias("m")).filter("m > 1").select(
        "token", "step", (-F.col("hub.minus")).alias("hub"), F.col("hub.n").alias("hub_n")), "hubs")
    first = scratch.write(postings.join(hubs, ["token", "step"]).filter(
        (F.col("doc") != F.col("hub")) & similar_sizes("n", "hub_n", THRESHOLD)).select(
        F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).distinct(), "hub-pairs")
    counted = first.join(reps.select(F.col("doc").alias("a"), F.col("sig").alias("sa")), "a").join(
        reps.select(F.col("doc").alias("b"), F.col("sig").alias("sb")), "b")
    same = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda z: z))
    candidates = scratch.write(counted.filter(same >= MATCH).select("a", "b").distinct(), "candidates")
    links = scratch.write(confirm(candidates, bodies).distinct(), "links")

    group = scratch.write(components(links, scratch), "groups")
    # the documents of postings that hold several components meet once more, by their rarest shingles
    here = open_rows(postings.select(F.col("doc").alias("node"), "token", "step"), group, scratch, "token", "step")
    here = scratch.write(here.select(F.col("node").alias("doc_id")).distinct(), "here")
    sets = scratch.write(shingle_sets(bodies.join(here, "doc_id")), "sets")
    more = cross_links(sets, links, THRESHOLD, scratch, lambda pairs, name: scratch.write(
        confirm(pairs, bodies).distinct(), f"{name}-links"))

    component = components(copies.unionByName(links).unionByName(more), scratch)
    return rows.select("doc_id", "n_shingles").join(component.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component").isNull() | (F.col("component") == F.col("doc_id")), F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component of rows the one with the smallest doc_id (a null one comes last), with all its columns.

    Rows are compared each by itself: a doc_id that several rows have, or a null one, gives way to a key of the row's doc_id and text.
    Rows that share both are one document, and all of them stay if it does."""
    repeated = docs.groupBy(F.col(doc_id).alias("_twice")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND _twice IS NOT NULL")
    repeated = scratch.write(repeated.select("_twice"), "repeated")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).cast("long").alias("_id"),
                       F.col(text).alias("_text"))
    own = F.xxhash64("_id", "_text")
    rows = rows.join(repeated, F.col("_id") == F.col("_twice"), "left").withColumn(
        "_key", F.when(F.col("_id").isNull() | F.col("_twice").isNotNull(), own).otherwise(F.col("_id")))
    groups = near_groups(rows.select("_key", "_text"), scratch, "_key", "_text").select(F.col("doc_id").alias("_key"), "component_id").distinct()
    named = groups.join(rows.select("_key", "_id").distinct(), "_key")
    named = scratch.write(named.select("_key", "component_id", F.struct(F.col("_id").isNull().alias("last"), "_id", "_key").alias("place")), "named")
    best = named.groupBy("component_id").agg(F.min("place").alias("best"))
    gone = scratch.write(named.join(best, "component_id").filter(F.col("place") != F.col("best")).select(F.col("_key").alias("_gone")), "gone")
    return rows.join(gone, F.col("_key") == F.col("_gone"), "left_anti").select("row.*")
