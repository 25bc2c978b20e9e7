"""Approximate nearest neighbours by inner product with balanced posting lists.

Vectors are put on the unit sphere of one more dimension, where the largest inner product is
the nearest point.  Balanced k-means on a bounded sample gives about sqrt(n) centroids (at most
``MAX_LISTS``), with a penalty on large clusters; a neighbour graph over them, held in memory, is
searched best-first by each vector.  A vector goes to its nearest list and, near a boundary, to
up to ``REPLICAS`` lists whose centroids are at most ``1 + REPLICA_RATIO`` times as far.  A query
searches every list its graph search finds whose centroid is at most ``1 + QUERY_RATIO`` times as
far as the nearest one, and more of the nearest until they hold ``LEAST * top`` vectors.  Scores are sums of products in double precision in the order of the components.

Equal vectors are one class, indexed once; of a class only the ``TOP + 1`` smallest ids can be
among anyone's nearest, so no large group of copies is gathered.  Lists are dealt into
blocks of bounded size, and the queries of a list, too; each meeting of two blocks is a task's group.
What is broadcast is the centroids and their graph, and a size for each list: bounded by ``MAX_LISTS``.

Defined results: vectors that are null, zero, of another length than most, or that hold a null or non-finite
component, and rows without an id, take no part; with fewer candidates than ``top`` all that
are found are returned; equal scores go to the smaller id; repeated ids count once for each distinct
vector they have, and never answer themselves; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch

TOP = 20
SAMPLE = 100_000          # vectors that the index is fitted on, on average: a dozen for each list
MAX_LISTS = 8192
REPLICAS, REPLICA_RATIO = 4, 0.10
QUERY_RATIO = 0.20
LEAST = 25                # times ``top`` vectors are looked at, whatever their lists' distances
DEGREE, BEAM = 16, 96
BLOCK, QUERY_BLOCK = 2048, 2048


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids; a cluster above the mean size is penalised in proportion to its surplus."""
    random = np.random.default_rng(7)
    centres = x[random.choice(len(x), k, replace=False)].copy()
    penalty, mean = np.zeros(k), len(x) / k
    for _ in range(rounds):
        near = np.concatenate([((centres ** 2).sum(axis=1) - 2 * part @ centres.T + penalty).argmin(axis=1)
                               for part in np.array_split(x, -(-len(x) // 4096))])
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        alive = size > 0
        centres[alive] = sums[alive] / size[alive, None]
        centres[~alive] = x[random.choice(len(x), int((~alive).sum()))]
        spread = 1.0 - (centres ** 2).sum(axis=1).mean()
        penalty += 0.05 * max(spread, 1e-6) * (size / mean - 1)
    return centres.astype(np.float32)


class CentroidGraph:
    """Neighbour graph over the centroids with a few entry points, searched best-first for many vectors at once."""

    def __init__(self, centres: np.ndarray):
        self.centres, n = centres, len(centres)
        self.square = (centres ** 2).sum(axis=1)
        degree = min(DEGREE, n - 1)
        random = np.random.default_rng(11)
        near = np.zeros((n, 0), np.int64)
        if degree > 0:
            near = np.concatenate([
                np.argpartition(self.square - 2 * centres[i: i + 1024] @ centres.T
                                + np.where(np.arange(n) == np.arange(i, min(n, i + 1024))[:, None], np.inf, 0),
                                degree - 1, axis=1)[:, :degree] for i in range(0, n, 1024)])
        # a few long links keep the graph in one piece
        self.links = np.concatenate([near, random.integers(0, n, (n, 4)), (np.arange(n)[:, None] + 1) % n], axis=1)
        self.entries = random.choice(n, min(n, 8), replace=False)

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the nearest centroids found, nearest first."""
        beam, rows = min(beam, len(self.centres)), np.arange(len(x))
        ids = np.tile(self.entries, (len(x), 1))
        own = (x ** 2).sum(axis=1)[:, None]
        distance = own + self.square[ids] - 2 * np.einsum("bd,bkd->bk", x, self.centres[ids])
        done = np.zeros(ids.shape, bool)
        while True:
            open_ = np.where(done, np.inf, distance)
            at = open_.argmin(axis=1)
            busy = np.isfinite(open_[rows, at])
            if not busy.any():
                break
            done[rows, at] = True
            more = self.links[ids[rows, at]]
            far = own + self.square[more] - 2 * np.einsum("bd,bkd->bk", x, self.centres[more])
            known = (more[:, :, None] == ids[:, None, :]).any(axis=2)
            twice = np.triu((more[:, None, :] == more[:, :, None]), 1).any(axis=1)
            far[known | twice | ~busy[:, None]] = np.inf
            ids, distance = np.concatenate([ids, more], axis=1), np.concatenate([distance, far], axis=1)
            done = np.concatenate([done, ~np.isfinite(far)], axis=1)
            if ids.shape[1] > beam:
                best = np.argpartition(distance, beam - 1, axis=1)[:, :beam]
                ids, distance, done = (np.take_along_axis(a, best, axis=1) for a in (ids, distance, done))
        order = distance.argsort(axis=1)
        ids, distance = np.take_along_axis(ids, order, axis=1), np.take_along_axis(distance, order, axis=1)
        return ids, np.sqrt(np.maximum(distance, 0))


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(flat), -1)


def nearest(vectors: DataFrame, scratch: Scratch, every: int, top: int = TOP, vec_id: str = "vec_id",
            embedding: str = "embedding", query_ratio: float = QUERY_RATIO) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the queries: rows whose id is divisible by ``every``."""
    valid = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0))
    length = valid.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return valid.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    valid = valid.filter(F.size("v") == length["d"])
    classes = scratch.write(valid.groupBy("v").agg(F.min("vec_id").alias("cid")), "classes")
    placed = scratch.write(valid.join(classes, "v").select("cid", "vec_id").distinct(), "placed")
    slot = F.row_number().over(Window.partitionBy("cid", F.pmod("vec_id", F.lit(64))).orderBy("vec_id"))
    few = placed.withColumn("r", slot).filter(F.col("r") <= top + 1).drop("r")
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("cid").orderBy("vec_id"))).filter(F.col("r") <= top + 1)
    members = scratch.write(few.drop("r"), "members")
    queries = scratch.write(placed.filter(F.col("vec_id") % every == 0).select(F.col("cid").alias("qcid"),
                                                                             F.col("vec_id").alias("query_id")), "queries")
    # fit on a bounded sample
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("most")).first()
    n, most = facts["n"], float(np.sqrt(facts["most"]))
    drawn = F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) <= F.lit(min(1.0, SAMPLE / n) * (1 << 30))
    sample = matrix(classes.filter(drawn).select("v").toArrow().column(0))

    def lifted(x: np.ndarray) -> np.ndarray:
        x = x / most
        return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x ** 2).sum(axis=1, keepdims=True)))], axis=1).astype(np.float32)

    lists = max(1, min(MAX_LISTS, round(n ** 0.5), len(sample)))
    graph = classes.sparkSession.sparkContext.broadcast(CentroidGraph(balanced_kmeans(lifted(sample), lists)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, len(batch), 512)):
                ids, far = graph.value.search(lifted(matrix(part.column(1))), 32)
                ids, far = ids[:, :REPLICAS], far[:, :REPLICAS]
                row, at = np.nonzero(far <= (1 + REPLICA_RATIO) * far[:, :1] + 1e-12)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                                                  pa.array(ids[row, at], pa.int32())], ["cid", "v", "list"])

    posted = scratch.write(classes.select("cid", "v").mapInArrow(assign, "cid long, v array<double>, list int"), "posted")
    held = np.zeros(lists, np.int64)                          # vectors of each list
    for r in posted.groupBy("list").count().collect():
        held[r["list"]] = r["count"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, len(batch), 512)):
                x = matrix(part.column(1))
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                x = np.concatenate([x, np.zeros((len(x), 1))], axis=1).astype(np.float32)
                ids, far = graph.value.search(x, BEAM)
                before = np.cumsum(held[ids], axis=1) - held[ids]
                row, at = np.nonzero((far <= (1 + query_ratio) * far[:, :1] + 1e-12) | (before < LEAST * top))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                                                  pa.array(ids[row, at], pa.int32())], ["qcid", "q", "list"])

    asked = classes.join(queries.select(F.col("qcid").alias("cid")).distinct(), "cid", "left_semi")
    asked = scratch.write(asked.select("cid", "v").mapInArrow(probe, "qcid long, q array<double>, list int"), "asked")
    blocks = F.broadcast(posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb")))
    askers = F.broadcast(asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("nq")))
    left = posted.join(blocks, "list").join(askers, "list").select(
        "list", F.pmod(F.xxhash64("cid"), "nb").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qblock"), "cid", "v")
    right = asked.join(askers, "list").join(blocks, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"),
        F.pmod(F.xxhash64("qcid"), "nq").cast("int").alias("qblock"), "qcid", "q")

    def meet(key: tuple, here: pa.Table, there: pa.Table) -> pa.Table:
        """The best ``top + 1`` classes of a block for each query of a block, ties to the smaller id."""
        empty = pa.table({"qcid": pa.array([], pa.int64()), "cids": pa.array([], pa.list_(pa.int64())),
                          "scores": pa.array([], pa.list_(pa.float64()))})
        if not len(here) or not len(there):
            return empty
        cids = here.column("cid").to_numpy()
        order = cids.argsort()
        cids, v, q = cids[order], matrix(here.column("v"))[order], matrix(there.column("q"))
        far = float(np.linalg.norm(v, axis=1).max())
        out_ids, out_scores = [], []
        for i in range(0, len(q), 256):
            part = q[i: i + 256]
            rough = part @ v.T
            # all whose exact score can be among the best: the product's rounding is far below the margin
            k = min(top + 1, len(cids))
            least = np.partition(rough, len(cids) - k, axis=1)[:, len(cids) - k]
            margin = 1e-12 * v.shape[1] * np.linalg.norm(part, axis=1) * far
            k = int((rough >= (least - margin)[:, None]).sum(axis=1).max())
            best = np.sort(np.argpartition(-rough, k - 1, axis=1)[:, :k], axis=1)
            score = np.zeros(best.shape)
            for d in range(v.shape[1]):
                score += q[i: i + 256, d: d + 1] * v[best, d]
            first = np.argsort(-score, axis=1, kind="stable")[:, : top + 1]
            out_ids += list(cids[np.take_along_axis(best, first, axis=1)])
            out_scores += list(np.take_along_axis(score, first, axis=1))
        return pa.table({"qcid": there.column("qcid"), "cids": pa.array(out_ids, pa.list_(pa.int64())),
                         "scores": pa.array(out_scores, pa.list_(pa.float64()))})

    found = left.groupBy("list", "block", "qblock").cogroup(right.groupBy("list", "block", "qblock")).applyInArrow(
        meet, "qcid long, cids array<long>, scores array<double>")

    def merge(key: tuple, parts: pa.Table) -> pa.Table:
        ids = parts.column("cids").combine_chunks().flatten().to_numpy()
        scores = parts.column("scores").combine_chunks().flatten().to_numpy()
        ids, first = np.unique(ids, return_index=True)
        scores = scores[first]
        order = np.argsort(-scores, kind="stable")[: top + 1]
        return pa.table({"qcid": pa.array([key[0].as_py()] * len(order), pa.int64()), "cid": pa.array(ids[order], pa.int64()),
                         "score": pa.array(scores[order], pa.float64())})

    best = found.groupBy("qcid").applyInArrow(merge, "qcid long, cid long, score double")
    near = best.join(members, "cid")
    order = [F.desc("score"), F.col("vec_id")]
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("qcid").orderBy(*order))).filter(F.col("r") <= top + 1)
    near = scratch.write(near.select("qcid", "vec_id", "score"), "near")
    ranked = queries.join(near, "qcid").filter("vec_id <> query_id").withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
