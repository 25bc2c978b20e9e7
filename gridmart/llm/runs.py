"""Periodic runs of words in a text: maximal repetitions, found through longest common extensions.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) of at least ``LEAST`` words and two periods that no
neighbouring word extends.  Collapsing a text drops the words of each run after its first period.

Longest common extensions (``Extensions``) by a difference cover: of the suffixes only those that begin at places in ``COVER`` (modulo
``MODULUS``) are sorted, by blocks of ``MODULUS`` words whose names are doubled until all differ.  Any two places reach, after fewer
than ``MODULUS`` common steps, two sampled places; so a pair compares those few words and, if they agree, takes the
least of the sorted neighbours' common prefixes between its two samples from a sparse table.  Extensions to the
left are those of the reversed text.

Enumeration on a harmonic grid: a run of period ``p`` holds a place ``i = 0, p, 2p, ...`` whose words agree with those ``p`` further on,
so for each ``p`` up to half a text its grid places are extended to both sides; places that lie in the stretch of the one before are not
extended again.  That is ``n log n`` places for ``n`` words, worked on side by side for many texts.  The suffixes are sorted of those
texts only in which a pair got as far as its samples.  What is found for a multiple of the period has the same place and length, and gives way to the period.

Each row is worked on alone, in one pass without a shuffle; memory is in proportion to the longest text's words, not to its grid.

Defined results: words are what ``[^\\x20\\x09-\\x0D]+`` matches; a null, empty or blank text has no words, no runs and an empty collapsed
text; rows that repeat an id are worked on each; an empty table gives no rows; other columns pass through in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import small_batches

LEAST = 12                        # words
MODULUS, COVER = 21, (3, 6, 7, 12, 14)
GRID = 1_000_000                  # grid places worked on at once


def _meetings() -> np.ndarray:
    """For two places modulo ``MODULUS``, the first number of steps after which both are sampled."""
    sampled = np.isin(np.arange(MODULUS), COVER)
    steps, at = np.arange(MODULUS), np.arange(MODULUS)
    both = sampled[(at[:, None, None] + steps) % MODULUS] & sampled[(at[None, :, None] + steps) % MODULUS]
    if not both.any(axis=2).all():
        raise ValueError("not a difference cover")
    return both.argmax(axis=2).astype(np.int32)


MEETING = _meetings()


class SampledSuffixes:
    """The sampled suffixes of texts in order, and least common prefixes between them.

    ``texts``: arrays that each end in a symbol which occurs nowhere else."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts])
        self.starts = np.cumsum(sizes) - sizes
        words = np.concatenate([*texts, np.zeros(MODULUS, np.int32)]).astype(">i4")
        places = np.concatenate([np.arange(start + c, start + size, MODULUS)
                                 for start, size in zip(self.starts.tolist(), sizes.tolist(), strict=True) for c in COVER])
        n = len(places)
        self.at = np.zeros(len(words), np.int64)                    # a sampled place's number
        self.at[places] = np.arange(n)
        blocks = np.lib.stride_tricks.sliding_window_view(words, MODULUS)[places]
        names = [self._names(np.ascontiguousarray(blocks).view(f"S{4 * MODULUS}").ravel())]
        # the next block of a text's class is the next number; a class ends in a symbol of its own, so none is compared beyond
        while n and names[-1].max() < n - 1:
            step = 1 << (len(names) - 1)
            after = np.zeros(n, np.int64)
            after[: n - step] = names[-1][step:] + 1
            names.append(self._names(names[-1] * (n + 1) + after))
        self.rank = names[-1]
        order = np.empty(n, np.int64)
        order[self.rank] = np.arange(n)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(names) - 2, -1, -1):
            same = names[level][a] == names[level][b]
            a[same] += 1 << level
            b[same] += 1 << level
            common[same] += MODULUS << level
        common += (blocks[a] != blocks[b]).argmax(axis=1)           # the blocks differ
        self.table = [np.concatenate([[0], common]).astype(np.int32)]
        while 2 << (len(self.table) - 1) <= n:
            last, step = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-step], last[step:]))

    @staticmethod
    def _names(keys: np.ndarray) -> np.ndarray:
        return np.unique(keys, return_inverse=True)[1].ravel().astype(np.int64)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of the suffixes at the sampled places ``a`` and ``b``, which differ."""
        a, b = self.rank[self.at[a]], self.rank[self.at[b]]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1      # the least of [low, high)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            rows = level == k
            out[rows] = np.minimum(self.table[k][low[rows]], self.table[k][high[rows] - (1 << k)])
        return out


class Extensions:
    """Common extensions to the right in texts that stand one after another in ``words``, each with a symbol of its own behind it.
    Text ``d`` has ``sizes[d]`` words from ``starts[d]`` on."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.words = np.concatenate([words, np.full(MODULUS, -1, words.dtype)])
        self.starts, self.sizes = starts, sizes
        self.sorted: SampledSuffixes | None = None
        self.moved = np.full(len(starts), -1, np.int64)             # where a text stands among the sorted

    def lengths(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` (places in ``words``, both in text ``doc``, not the same) agree."""
        start = self.starts[doc]
        meeting = MEETING[(a - start) % MODULUS, (b - start) % MODULUS]
        out = np.zeros(len(a), np.int64)
        rows, met = np.arange(len(a)), []
        for step in range(MODULUS):
            here = meeting[rows] == step
            met.append(rows[here])
            rows = rows[~here]
            same = self.words[a[rows] + step] == self.words[b[rows] + step]
            out[rows[~same]] = step
            rows = rows[same]
            if not len(rows):
                break
        met = np.concatenate(met)
        if len(met):
            self._sort(np.unique(doc[met]))
            step, move = meeting[met], self.moved[doc[met]] - start[met]
            out[met] = step + self.sorted.common(a[met] + step + move, b[met] + step + move)
        return out

    def _sort(self, docs: np.ndarray) -> None:
        if self.sorted is not None and (self.moved[docs] >= 0).all():
            return
        docs = np.union1d(docs, np.flatnonzero(self.moved >= 0))
        self.sorted = SampledSuffixes([self.words[self.starts[d]: self.starts[d] + self.sizes[d] + 1] for d in docs.tolist()])
        self.moved[docs] = self.sorted.starts


def find_runs(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """For each text (an array of word numbers, from 0) its runs as rows (start, length, period), by start, then period."""
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    group, held = [], 0
    for d in np.flatnonzero(sizes >= max(least, 2)).tolist():
        places = int(sizes[d] * (np.log(sizes[d]) + 1))              # its grid, about
        if group and held + places > GRID:
            _group(texts, group, least, out)
            group, held = [], 0
        group.append(d)
        held += places
    if group:
        _group(texts, group, least, out)
    return out


def _group(texts: list[np.ndarray], group: list[int], least: int, out: list[np.ndarray]) -> None:
    """Writes the runs of the texts ``group`` to ``out``."""
    sizes = np.array([len(texts[d]) for d in group], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = np.arange(len(group), dtype=np.int32) + 1 + max(int(texts[d].max()) for d in group)
    words = np.concatenate([x for d, end in zip(group, ends, strict=True) for x in (texts[d], [end])]).astype(np.int32)
    doc = np.repeat(np.arange(len(group)), sizes + 1)
    mirror = 2 * starts[doc] + sizes[doc] - 1 - np.arange(len(words))
    mirror[starts + sizes] = starts + sizes
    right, left = Extensions(words, starts, sizes), Extensions(words[mirror], starts, sizes)

    # texts and periods, in portions whose grids are of bounded size
    halves = sizes // 2
    doc = np.repeat(np.arange(len(group)), halves)
    period = np.arange(1, len(doc) + 1) - np.repeat(np.cumsum(halves) - halves, halves)
    count = (sizes[doc] - 1) // period
    ends = np.cumsum(count)
    found, at = [], 0
    while at < len(doc):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 2 * GRID, "right")))
        found.append(_portion(right, left, doc[at:stop], period[at:stop], count[at:stop], least))
        at = stop
    doc, start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, length, start, doc))
    doc, start, length, period = doc[order], start[order], length[order], period[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    doc, runs = doc[first], np.stack([start, length, period], axis=1)[first]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0], doc))]
    bounds = np.searchsorted(doc, np.arange(len(group) + 1))
    for k, d in enumerate(group):
        out[d] = runs[bounds[k]: bounds[k + 1]]


def _portion(right: Extensions, left: Extensions, doc: np.ndarray, period: np.ndarray, count: np.ndarray,
             least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of what the grids of some texts and periods find."""
    words, starts, sizes = right.words, right.starts, right.sizes
    total = int(count.sum())
    first = starts[doc]
    place = np.repeat((first - (np.cumsum(count) - count) * period).astype(np.int32), count)
    step = np.repeat(period.astype(np.int32), count)
    place += np.arange(total, dtype=np.int32) * step                # all modulo 2**32; the places themselves are below 2**31
    hit = np.flatnonzero(words[place] == words[place + step])
    i, p = place[hit].astype(np.int64), step[hit].astype(np.int64)
    # a stretch of p agreeing words goes on to one side at least
    more = (words[i + 1] == words[i + 1 + p]) | ((words[i - 1] == words[i - 1 + p]) & (i > 0)) | (p == 1)
    i, p = i[more], p[more]
    d = np.searchsorted(starts, i, "right") - 1
    reach = right.lengths(d, i, i + p)
    again = np.zeros(len(i), bool)                                  # in the same stretch as the place before
    again[1:] = (p[1:] == p[:-1]) & (d[1:] == d[:-1]) & (i[1:] - i[:-1] <= reach[:-1])
    i, p, d, reach = i[~again], p[~again], d[~again], reach[~again]
    turn = 2 * starts[d] + sizes[d]
    back = left.lengths(d, turn - i - p, turn - i)
    good = (reach + back >= p) & (reach + back + p >= least)
    i, p, d, reach, back = i[good], p[good], d[good], reach[good], back[good]
    return d, i - back - starts[d], reach + back + p, p


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: one that no run holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _runs_array(runs: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
    fields = pa.StructArray.from_arrays([pa.array(flat[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()), fields)


def periodic_runs(docs: DataFrame, text: str = "text", carry: list[str] | None = None, least: int = LEAST) -> DataFrame:
    """One row for each of ``docs``: the columns ``carry`` (all, if None) in ``row``, ``n_words``, ``runs`` (an array of start, length,
    period in words, by start, then period) and ``collapsed`` (the words that stay, joined by one space)."""
    small_batches(docs.sparkSession, rows=2000, size="8m")
    columns = docs.columns if carry is None else carry
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [(t or b"").split() for t in batch.column(1).to_pylist()]     # of bytes: at these six characters only
            codes = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode().indices.to_numpy()
            bounds = np.cumsum([0, *map(len, split)])
            runs = find_runs([codes[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], least)
            joined = []
            for words, found in zip(split, runs, strict=True):
                if len(found):
                    words = [words[k] for k in np.flatnonzero(kept_words(len(words), found)).tolist()]
                joined.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds), pa.int64()), _runs_array(runs), pa.array(joined, pa.binary()).cast(pa.string())],
                ["row", "n_words", "runs", "collapsed"])

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
