"""Vector bin packing of documents into training sequences.

Every piece has three sizes: tokens, segments (one) and loss-bearing tokens (those after the
document's prompt; all, without a prompt column).  A sequence has a limit on each.  Of the
pieces that fit on every size, the dot-product heuristic places the one whose sizes, as
shares of the limits, have the largest product with the room that is left; when none fits
whole, or one segment is left, the piece that can fill the rest is cut.  What a partition has
left at its end is cut into sequences of power-of-two lengths.

Each task packs the documents of its own input partition in one pass, with a bounded pool of
open pieces: no shuffle, and no group that grows with the data.  A sequence's id is made of
the partition and a count, so a task that is run again gives the same rows.

Defined results: a null or empty text is a document of the end id alone; null and repeated
doc_ids are kept as they are, each row a document of its own; a document longer than a
sequence is cut; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import small_batches
from gridmart.llm.tokens import encoder

MAX_TOKENS, MAX_SEGMENTS = 1024, 64
POOL = 512
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, loss_tokens long")


class Packer:
    """The pool of one task; ``rows`` gets (document, start, length, sequence, offset, loss)."""

    def __init__(self, limits: tuple[int, int, int], pool: int = POOL, rest=lambda document, start: document):
        """``rest`` gives what the pool has to hold of a document from a token on."""
        self.limits, self.rest = np.array(limits, dtype=np.float64), rest
        self.pool, self.rows, self.sequence = pool, [], 0
        self.items: list[list] = []          # [document, start, tokens, prompt]
        self.sizes = np.zeros((2 * pool + 2, 3))

    @staticmethod
    def loss(start: int, length: int, prompt: int) -> int:
        return max(0, start + length - max(start, prompt))

    def _fit(self, item: list, tokens: float, loss: float) -> int:
        """How many of an item's first tokens go into this room."""
        free = max(0, item[3] - item[1])
        return int(min(item[2], tokens, free + loss))

    def _set(self, k: int, item: list) -> None:
        if k == len(self.items):
            self.items.append(item)
        else:
            self.items[k] = item
        self.sizes[k] = (item[2], 1, self.loss(item[1], item[2], item[3]))

    def _remove(self, k: int) -> None:
        last = self.items.pop()
        if k < len(self.items):
            self.items[k] = last
            self.sizes[k] = self.sizes[len(self.items)]

    def add(self, document, tokens: int, prompt: int = 0) -> None:
        start = 0
        while tokens - start >= self.limits[0] or self.loss(start, tokens - start, prompt) >= self.limits[2]:
            n = self._fit([document, start, tokens - start, prompt], self.limits[0], self.limits[2])
            self.rows.append((document, start, n, self.sequence, 0, self.loss(start, n, prompt)))
            self.sequence += 1
            start += n
        if start < tokens:
            self._set(len(self.items), [self.rest(document, start), start, tokens - start, prompt])
        if len(self.items) >= 2 * self.pool:
            while len(self.items) > self.pool:
                self._fill(self.limits.copy())

    def _place(self, k: int, n: int, offset: int) -> int:
        document, start, tokens, prompt = self.items[k]
        loss = self.loss(start, n, prompt)
        self.rows.append((document, start, n, self.sequence, offset, loss))
        if n == tokens:
            self._remove(k)
        else:
            self._set(k, [document, start + n, tokens - n, prompt])
        return loss

    def _fill(self, room: np.ndarray) -> None:
        """Makes one sequence of at most ``room``."""
        offset = 0
        while self.items and room[0] >= 1 and room[1] >= 1:
            sizes = self.sizes[: len(self.items)]
            whole = (sizes <= room).all(axis=1)
            if whole.any() and (room[1] > 1 or (whole & (sizes[:, 0] == room[0])).any()):
                score = np.where(whole, (sizes / self.limits) @ (room / self.limits), -1.0)
                k = int(score.argmax())
                n = self.items[k][2]
            else:                                   # cut the piece that fills most of what is left
                fit = [self._fit(x, room[0], room[2]) for x in self.items]
                k = int(np.argmax(fit))
                n = fit[k]
                if n < 1:
                    break
            loss = self._place(k, n, offset)
            room -= (n, 1, loss)
            offset += n
        self.sequence += 1

    def finish(self) -> None:
        while self.items:
            left = int(self.sizes[: len(self.items), 0].sum())
            if left < self.limits[0]:               # the largest power of two that is left
                self._fill(np.minimum(self.limits, (1 << (left.bit_length() - 1), np.inf, np.inf)))
            else:
                self._fill(self.limits.copy())


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
         max_loss_tokens: int | None = None, doc_id: str = "doc_id", text: str = "text",
         prompt_tokens: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``tokenizer`` is the path of a tokenizer file that every executor has.

    ``prompt_tokens`` names a column with the number of leading tokens that bear no loss.  With
    ``with_ids`` a binary column ``ids`` holds the piece's ids (little-endian unsigned 32-bit)."""
    limits = (max_tokens, max_segments, max_loss_tokens or max_tokens)
    prompt = F.coalesce(F.col(prompt_tokens).cast("long"), F.lit(0)) if prompt_tokens else F.lit(0).cast("long")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), prompt.alias("prompt"))
    small_batches(docs.sparkSession, rows=3000, size="12m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).documents
        # a document: its id, token count, the bytes of its ids from a token on, and that token
        packer = Packer(limits, rest=lambda d, start: (d[0], d[1], d[2][4 * start:], start))
        base = TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            ids = [x[0][2][4 * (x[1] - x[0][3]): 4 * (x[1] - x[0][3] + x[2])] for x in rows]
            columns = [pa.array([x[0][0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()),
                       pa.array([x[2] for x in rows], pa.int64()), pa.array([zlib.crc32(b) for b in ids], pa.int64()),
                       pa.array([x[0][1] for x in rows], pa.int64()),
                       pa.array([base + x[3] for x in rows], pa.int64()), pa.array([x[4] for x in rows], pa.int64()),
                       pa.array([x[5] for x in rows], pa.int64())] + [pa.array(ids, pa.binary())] * with_ids
            names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for one, ids, first in zip(batch.column(0).to_pylist(), encode(batch.column(1)), batch.column(2).to_pylist(),
                                       strict=True):
                packer.add((one, len(ids) // 4, ids, 0), len(ids) // 4, first)
            yield out()
        packer.finish()
        yield out()

    return source.mapInArrow(run, SCHEMA + ", ids binary" * with_ids)
