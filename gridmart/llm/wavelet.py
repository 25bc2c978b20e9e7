"""Token ids in compressed shard files that answer queries: one wavelet matrix per shard.

File format (little-endian): magic ``GWM2``; documents, tokens, levels (uint64 each); then the
documents' ids with a null mask, their token counts, the shard's distinct token ids in order, the zeros of
each level (zstd frames with a uint64 length in front), and each level's bit-plane, one zstd frame each.
A token's code is its place among the distinct ids.  Level ``l`` holds bit ``levels-1-l`` of the codes, in
the order that a stable partition by the bits above gives.  On opening, counts of ones before each 64-bit word make rank a lookup and a
popcount, and select a binary search; with those, ``access``, ``rank``, ``select`` and
``count`` read single tokens and occurrences without decoding the shard.

Job: documents are range-partitioned by doc_id and sorted, each task appends ids to shards of
bounded size, and the shard files are written, one binary row each, to the shared folder
through Spark, so any store that Spark writes works.  What is returned is read from
the files.  A document's start is its place in its shard, plus the shard's place in its
partition (in the file's row), plus the partitions before (one number per partition is sent
to all tasks).

Defined results: null text is empty and has the end id alone; null doc_ids come first;
repeated doc_ids follow one another, in the order of a hash of their texts, and are spread over tasks; an empty table gives no files and no rows; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch, running_total, small_batches
from gridmart.llm.tokens import encoder

MAGIC = b"GWM2"
SHARD_TOKENS = 1 << 18    # so that a shard is built and decoded in a core's own cache
WORD = 64
CACHE_WORDS = 600_000     # per worker, about 110 MB of the encoder
DENSE = 1 << 20           # below this, distinct ids are found by counting


class WaveletMatrix:
    def __init__(self, planes: list[np.ndarray], zeros: list[int], n: int, symbols: np.ndarray):
        """``planes``: bits of each level, packed (first bit highest) and padded to whole 64-bit words;
        ``symbols``: the distinct tokens in order, whose places are the codes."""
        self.planes, self.zeros, self.n, self.symbols = planes, zeros, n, symbols
        self._before: list[np.ndarray | None] = [None] * len(planes)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        if len(ids) and ids.max() < DENSE:
            held = np.bincount(ids, minlength=1) > 0
            symbols = np.flatnonzero(held).astype(np.uint32)
            now = (np.cumsum(held) - 1).astype(np.uint32).take(ids)
        else:
            symbols, now = np.unique(ids, return_inverse=True)
        levels = max(1, (len(symbols) - 1).bit_length())
        now = now.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(levels):
            bits = (now & now.dtype.type(1 << (levels - 1 - level))) != 0
            packed = np.packbits(bits)
            planes.append(np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]))
            low = now.compress(~bits)
            zeros.append(len(low))
            now = np.concatenate([low, now.compress(bits)])
        return cls(planes, zeros, len(ids), symbols.astype(np.uint32))

    def decode(self) -> np.ndarray:
        """All tokens, undoing the levels from the last to the first."""
        levels = len(self.planes)
        now = np.zeros(self.n, np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.n).view(bool)
            up = np.empty_like(now)
            up[np.flatnonzero(~bits)] = now[: self.zeros[level]]
            up[np.flatnonzero(bits)] = now[self.zeros[level]:] | now.dtype.type(1 << (levels - 1 - level))
            now = up
        return self.symbols.take(now) if self.n else now.astype(np.uint32)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a level."""
        if self._before[level] is None:
            ones = np.bitwise_count(self.planes[level].view(np.uint64)).astype(np.int64)
            self._before[level] = np.concatenate([[0], np.cumsum(ones)])
        word, rest = divmod(i, WORD)
        ones = int(self._before[level][word])
        if rest:
            part = int.from_bytes(self.planes[level][8 * word: 8 * word + 8].tobytes(), "big") >> (WORD - rest)
            ones += part.bit_count()
        return ones

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        """Token at place ``i``."""
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            value, i = value << 1 | bit, self.zeros[level] + ones if bit else i - ones
        return int(self.symbols[value])

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first ``i`` tokens."""
        code = self._code(token)
        if code is None:
            return 0
        begin, end = self._range(code, i)
        return end - begin

    def _code(self, token: int) -> int | None:
        at = int(np.searchsorted(self.symbols, token))
        return at if at < len(self.symbols) and self.symbols[at] == token else None

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _range(self, token: int, i: int) -> tuple[int, int]:
        begin, end = 0, i
        for level in range(len(self.planes)):
            a, b = self._rank1(level, begin), self._rank1(level, end)
            if token >> (len(self.planes) - 1 - level) & 1:
                begin, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th occurrence (from 0) of ``token``; -1 when there are fewer."""
        token = self._code(token)
        if token is None:
            return -1
        begin, end = self._range(token, self.n)
        if not 0 <= k < end - begin:
            return -1
        i = begin + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - level) & 1
            i = self._select(level, one, i - self.zeros[level] if one else i)
        return i

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) such bit of a level."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


def write_shard(doc_ids: list[int | None], blobs: list[bytes]) -> bytes:
    """A shard file of these documents; each blob holds one document's ids as little-endian uint32."""
    pack = zstandard.ZstdCompressor(level=1).compress
    lengths = np.array([len(b) // 4 for b in blobs], dtype="<u8")
    matrix = WaveletMatrix.build(np.frombuffer(b"".join(blobs), dtype="<u4"))
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    ids = np.array([d or 0 for d in doc_ids], dtype="<i8")
    frames = [pack(x.tobytes()) for x in (ids, known, lengths, matrix.symbols.astype("<u4"), np.array(matrix.zeros, dtype="<u8"), *matrix.planes)]
    head = np.array([len(doc_ids), matrix.n, len(matrix.planes)], dtype="<u8").tobytes()
    return MAGIC + head + b"".join(len(f).to_bytes(8, "little") + f for f in frames)


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """A shard file's doc_ids, token counts and wavelet matrix."""
    if data[:4] != MAGIC:
        raise ValueError("not a shard file")
    docs, n, levels = (int(x) for x in np.frombuffer(data, "<u8", 3, 4))
    unpack, at, parts = zstandard.ZstdDecompressor().decompress, 28, []
    for _ in range(5 + levels):
        size = int.from_bytes(data[at: at + 8], "little")
        parts.append(unpack(data[at + 8: at + 8 + size]))
        at += 8 + size
    ids, known = np.frombuffer(parts[0], "<i8").tolist(), np.frombuffer(parts[1], np.uint8)
    matrix = WaveletMatrix([np.frombuffer(p, np.uint8) for p in parts[5:]], np.frombuffer(parts[4], "<u8").tolist(), n,
                           np.frombuffer(parts[3], "<u4"))
    return [d if k else None for d, k in zip(ids, known, strict=True)], np.frombuffer(parts[2], "<u8"), matrix


def write_tokens(docs: DataFrame, tokenizer: str, scratch: Scratch, doc_id: str = "doc_id", text: str = "text",
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shard files and returns their table: ``part``, ``shard``, ``before`` (tokens of the
    partition's earlier shards), ``n_tokens``, ``n_docs``, ``file`` (the file's bytes)."""
    small_batches(docs.sparkSession, rows=3000, size="12m")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("_spread"), F.col(text).alias("text"))
    source = source.repartitionByRange("doc_id", "_spread").sortWithinPartitions("doc_id", "_spread").drop("_spread")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer, CACHE_WORDS).documents, TaskContext.get().partitionId()
        ids, blobs, size, shard, before = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "before": pa.array([before], pa.int64()), "n_tokens": pa.array([size], pa.int64()),
                "n_docs": pa.array([len(ids)], pa.int64()), "file": pa.array([write_shard(ids, blobs)], pa.binary())})

        for batch in batches:
            for one, blob in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                ids.append(one)
                blobs.append(blob)
                size += len(blobs[-1]) // 4
                if size >= shard_tokens:
                    yield flush()
                    ids, blobs, size, shard, before = [], [], 0, shard + 1, before + size
        if ids:
            yield flush()

    files = source.mapInArrow(run, "part int, shard int, before long, n_tokens long, n_docs long, file binary")
    path = scratch.path("shards")
    files.write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.schema(files.schema).parquet(path)


def read_tokens(files: DataFrame) -> DataFrame:
    """One row per document, decoded from the shard files: ``doc_id``, ``start``, ``n_tokens``,
    ``ids_crc32``, ``shard_part``, ``shard``."""
    small_batches(files.sparkSession, rows=8, size="32m")
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    bases = running_total(parts, "part", "tokens", "base")
    placed = files.join(F.broadcast(bases), "part").select(
        "part", "shard", (F.col("base") + F.col("before")).alias("base"), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, base, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids, lengths, matrix = open_shard(file)
                ids = matrix.decode().astype("<u4").tobytes()
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths.astype(np.int64)
                crc = [zlib.crc32(ids[4 * a: 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(starts + base, pa.int64()),
                    "n_tokens": pa.array(lengths.astype(np.int64), pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    "shard_part": pa.array([part] * n, pa.int32()), "shard": pa.array([shard] * n, pa.int32())})

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard_part int, shard int")
