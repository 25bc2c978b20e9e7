"""Vector compression to short codes: one codebook for each part of a vector, searched by equal averages.

A vector's components become integers (``floor(scale * x)``) and are cut into equal consecutive parts.  Each part
position has a codebook; a part is coded as the place of its nearest entry (squared Euclidean distance, ties to the lower place).

Search: entries are sorted by the sum of their components.  By Cauchy-Schwarz, an entry whose sum is ``g`` away from that of a part of
``d`` components is at least ``g * g / d`` away from it.  So the search starts at the part's own sum and goes outward in both
directions; a direction ends when ``g * g`` exceeds ``d`` times the best distance so far.  It goes on at equality, as an
entry of a lower place may be as near.  All arithmetic is in integers.

Job: the codebooks (``parts * entries`` rows, whatever the table's size) go to the tasks; each round's tasks return
one sum and count for each entry, which are added up by a grouping.  The integer vectors are written once.

Defined results: rows whose vector is null, empty or holds a null or non-finite component take no part, nor do those of another length than
the first vector (smallest id; null ids come last) or, all of them, of a length that ``parts`` does not divide; components beyond 2**26
after scaling are held at that bound, so that sums stay in 64 bits; rows that repeat an id are coded each, in the order of their
components where their order counts; with fewer rows than ``entries`` codebooks are smaller; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from gridmart.llm.common import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BOUND = 1 << 26
ROWS = 4096               # vectors searched side by side


class EqualAverage:
    """One part position's codebook, ready for searching."""

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.place = np.argsort(sums, kind="stable")
        self.sums, self.sorted, self.n, self.d = sums[self.place], entries[self.place], len(entries), entries.shape[1]

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry's place and its distance for each row of ``x``."""
        sums = x.sum(axis=1)
        at = np.searchsorted(self.sums, sums)
        best = np.full(len(x), np.iinfo(np.int64).max)
        place = np.full(len(x), self.n)
        up, down = np.arange(len(x)), np.arange(len(x))        # rows whose search still goes on in that direction
        for step in range(self.n):
            up = self._visit(x, sums, best, place, up, at[up] + step)
            down = self._visit(x, sums, best, place, down, at[down] - 1 - step)
            if not len(up) and not len(down):
                break
        return place, best

    def _visit(self, x, sums, best, place, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Compares ``rows`` with the sorted entries ``at``; returns those whose direction goes on."""
        inside = (at >= 0) & (at < self.n)
        rows, at = rows[inside], at[inside]
        gap = sums[rows] - self.sums[at]
        near = gap * gap // self.d <= best[rows]                # the same as gap * gap <= d * best, without overflow
        rows, at = rows[near], at[near]
        far = x[rows] - self.sorted[at]
        far = np.einsum("ij,ij->i", far, far)
        now = self.place[at]
        better = (far < best[rows]) | ((far == best[rows]) & (now < place[rows]))
        best[rows[better]], place[rows[better]] = far[better], now[better]
        return rows


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances (rows, parts) of the parts of the vectors ``x`` in ``books`` (parts, entries, components)."""
    parts, _, d = books.shape
    searches = [EqualAverage(book) for book in books]
    found = [s.search(np.ascontiguousarray(x[:, j * d: (j + 1) * d])) for j, s in enumerate(searches)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def integers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, list[bytes]]:
    """Rows of a list array that take part, and their integer components as little-endian int32."""
    flat = vectors.flatten()                                    # skips null rows
    sizes = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0), dtype=np.int64)
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component is NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    rows = np.flatnonzero((sizes > 0) & (bad[ends] == bad[starts]))
    with np.errstate(all="ignore"):
        v = np.clip(np.floor(np.nan_to_num(x, posinf=0.0, neginf=0.0) * scale), -BOUND, BOUND).astype("<i4")
    return rows, [v[a:b].tobytes() for a, b in zip(starts[rows].tolist(), ends[rows].tolist(), strict=True)]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), -1).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(i, ROWS) for i in range(0, len(batch), ROWS))


def integer_vectors(vectors: DataFrame, scratch: Scratch, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """``vec_id``, ``label``, ``size`` (components), ``v`` (int32 components) of the rows that take part."""
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, blobs = integers(batch.column(2), scale)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([len(b) // 4 for b in blobs], pa.int32()),
                 pa.array(blobs, pa.binary())], ["vec_id", "label", "size", "v"])

    source = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"),
                            F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    kinds = dict(source.dtypes)
    return scratch.write(source.mapInArrow(clean, f"vec_id {kinds['vec_id']}, label {kinds['label']}, size int, v binary"), "integers")


def train(clean: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts, entries, components) of ``integer_vectors``; None without a vector of a fitting length."""
    first = clean.orderBy(F.asc_nulls_last("vec_id"), "v").limit(1).collect()
    if not first or first[0]["size"] % parts:
        return None
    size = first[0]["size"]
    clean = clean.filter(F.col("size") == size)
    seeds = clean.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    d = size // parts
    books = np.stack([np.frombuffer(r["v"], "<i4").astype(np.int64).reshape(parts, d) for r in seeds], axis=1)
    for _ in range(rounds):
        books = _moved(clean, books)
    return books


def _moved(clean: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floored mean of the parts that are nearest to it."""
    parts, n, d = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, n, d), np.int64), np.zeros((parts, n), np.int64)
        for batch in _slices(batches):
            x = _matrix(batch.column(0))
            place, _ = assign(x, books)
            for j in range(parts):
                np.add.at(total[j], place[:, j], x[:, j * d: (j + 1) * d])
                count[j] += np.bincount(place[:, j], minlength=n)
        used = np.argwhere(count > 0)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(used[:, 0], pa.int32()), "entry": pa.array(used[:, 1], pa.int32()),
            "count": pa.array(count[count > 0], pa.int64()), "sums": pa.array(list(total[count > 0]), pa.list_(pa.int64()))})

    told = clean.select("v").mapInArrow(sums, "part int, entry int, count long, sums array<long>")
    added = told.groupBy("part", "entry").agg(F.sum("count").alias("count"),
                                              *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(d)])
    books = books.copy()
    for r in added.collect():                                   # at most parts * entries rows
        books[r["part"], r["entry"]] = [r[f"s{i}"] // r["count"] for i in range(d)]
    return books


def encode(clean: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``places`` (an array with one place for each part), ``error`` (squared distances summed over parts)."""
    parts, _, d = books.shape
    kinds = dict(clean.dtypes)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            place, far = assign(_matrix(batch.column(2)), books)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(place.astype(np.int32)), pa.list_(pa.int32())),
                 pa.array(far.sum(axis=1), pa.int64())], ["vec_id", "label", "places", "error"])

    return clean.filter(F.col("size") == parts * d).select("vec_id", "label", "v").mapInArrow(
        code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, places array<int>, error long")


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` with ``v``: the integer components that its ``places`` stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array(batch.column(batch.schema.get_field_index("places")).to_pylist(), np.int64).reshape(len(batch), len(books))
            v = books[np.arange(len(books)), at].reshape(len(batch), -1)
            yield batch.append_column("v", pa.array(list(v), pa.list_(pa.int64())))

    return codes.mapInArrow(run, StructType([*codes.schema.fields, StructField("v", ArrayType(LongType()))]))


def books_sha256(books: np.ndarray) -> str:
    """Digest of all entries' decimal components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, scratch: Scratch, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray | None]:
    """The codes of ``vectors`` (``encode``, written) and the codebooks they stand for."""
    clean = integer_vectors(vectors, scratch, vec_id, embedding, label, scale)
    books = train(clean, parts, entries, rounds)
    if books is None:
        empty = clean.limit(0).select("vec_id", "label", F.array().cast("array<int>").alias("places"), F.lit(0).cast("long").alias("error"))
        return empty, None
    return scratch.write(encode(clean, books), "codes"), books
