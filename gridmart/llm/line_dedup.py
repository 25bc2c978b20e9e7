"""Fuzzy line dedup by MinHash.

A line is compared lower-cased and trimmed.  Its set holds its character shingles: ``SHINGLE`` characters from each place, so every
character counts; a shorter line is one shingle.

Signing (numpy, in one pass over the texts).  The signature has ``ROWS * BANDS`` coordinates in ``BANDS`` bands; a pair at similarity 0.75
shares no band with a chance below 1e-4.  The rows of a band come from permutations of their own, so two unlike lines
share a band with the chance that it should have.  Lines of ``LONG`` shingles and more take ``ROWS`` permutations, each of which gives every
band a coordinate (the least hash in each of ``BANDS`` parts of its range; an empty part takes the next one's); shorter ones, which would leave
parts empty, take a permutation for each coordinate.  Lines that can be similar to one on the other side of that limit are signed in both ways.

Banding.  A posting is a band's key, the line's key and a sketch of ``WIDE`` signature bits of other bands: the band that two lines share says
nothing of them, so unlike lines, whose chance meetings grow with the square of the input, pass the sketch about once in a thousand times.  Equal lines
of a batch are signed and posted once.  Postings travel as packed blocks, dealt by the band key.  The task that has a band compares the
sketches of all its members (``WHOLE`` at most) and gives the pairs that are near, up to ``PAIRS`` a member.  Bands with more of them
are dense: their members that are near another one are given, and which are near the hub, the one with most near ones.  Of bands of more than
``WHOLE`` all members are given.  A slot of more than ``SLOT_POSTINGS`` is gone through by parts of its bands.

Verification.  Near pairs, and members of dense bands with their hub (by sketch: at similarity 0.75 an eighth of the bits differ; ``DIFFER``
and ``WIDE_DIFFER`` are five deviations off), are compared by exact Jaccard on the full sets, and joined into components by contraction
(``graph.components``).  Dense bands whose members are in different components still are looked at again, so no pair that the bands find is lost.
Those of up to ``SMALL_BAND`` members get their lines' texts, and the task that has them compares all pairs across components, by sketch and then
exactly, on bit sets of the shingles that two of the lines or more hold.  The members of larger ones are posted again
under pairs of these (a similar pair that shares one band shares another with a chance of 0.9999; one that shares a smaller band too was
compared there), and go through the same steps; lines of bands that are large even so are joined by exact prefixes of rare shingles (``prefix_join``).  So what
is given for a band is linear in its members.  Texts are fetched for lines in near pairs and dense bands only, by one more
pass over the texts that a bitmap of ``BITMAP`` bits (of fixed size) thins out.  Of a component, the line with the smallest
(doc_id, line number) stays.

Keys are 56-bit; of two lines that share one by chance, told apart by a second hash, only one takes part in the links.

Defined results: null text is one empty line; empty and blank lines are never duplicates; rows that repeat a doc_id repeat its
lines, and those that stay, stay in each row that has them; a null doc_id is smaller than any other; very long lines only have larger sets; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch, small_batches
from gridmart.llm.graph import components
from gridmart.llm.prefix_join import cross_links, open_rows

SHINGLE = 5
BANDS, ROWS = 25, 4
THRESHOLD = 75            # percent
CHARACTERS = 100_000      # signed or compared side by side, in a core's own cache
LONG = 64                 # shingles
DIFFER = 21               # of 64 sketch bits
WIDE, WIDE_DIFFER = 88, 26    # bits of the sketches that lines are first posted with, and how many may differ
PAIRS = 4                 # near pairs that a band gives for each member; a band with more is dense
WHOLE = 1 << 14           # members of a band whose sketches are compared all with all, in the task that has them
AREA = 1 << 20            # sketches compared at once
SMALL_BAND = 4096         # members, TAGS at most; those of larger dense bands are posted again under pairs of bands
BAND_CHARACTERS = 40 * CHARACTERS     # of the lines of a small band, at most
SIFTED = 256              # members of a pair of bands whose sketches are compared all with all
BITMAP = 1 << 26          # bits
SLOT_POSTINGS = 4_000_000     # held at once by a task that reads blocks
FLUSH = 1_000_000         # postings, before a task gives blocks
TAGS = 1 << 14            # lines or pairs, too
_BLANK = " \t\n\x0b\f\r"
_random = np.random.default_rng(20)
_STEP = _random.integers(1 << 62, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_TURN = _random.integers(1 << 30, 1 << 32, (ROWS + ROWS * BANDS, 2), dtype=np.uint32) | np.uint32(1)
_EMPTY = np.uint32(0xFFFFFFFF)
# 32 bits of a band's key, of which the slot is the rest; a line's key; its sketch
_POSTING = np.dtype([("band", "<u4"), ("low", "<u4"), ("middle", "<u2"), ("high", "u1"), ("sketch", "<u8")])
# as lines are first posted: 24 bits of a band's key, and 24 more bits of the sketch
_FIRST = np.dtype([("band", "<u2"), ("band_high", "u1"), ("low", "<u4"), ("middle", "<u2"), ("high", "u1"), ("sketch", "<u8"),
                   ("more", "<u2"), ("more_high", "u1")])
_BAND_BITS = np.uint64((1 << 24) - 1)


# Lines and their sets

def normal(line: str) -> str:
    return line.strip(_BLANK).lower()


def keys_of(norm: str) -> tuple[int, int]:
    """A line's key, and a second one that tells apart lines which share it."""
    h = xxhash.xxh3_128_intdigest(norm.encode("utf-8", "surrogatepass"))
    return h & (1 << 56) - 1, (h >> 64) - (1 << 63)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of non-empty lines, line after line, and how many each line has (repeats counted)."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = np.cumsum(sizes)
    wide = np.concatenate([codes, np.zeros(SHINGLE - 1, np.uint64)])
    h = codes * _STEP[0]
    for k in range(1, SHINGLE):
        h += wide[k: k + len(codes)] * _STEP[k]
    whole, long = np.ones(len(codes), bool), sizes >= SHINGLE
    for k in range(1, SHINGLE):
        whole[ends[long] - k] = False
    for end, size in zip(ends[~long].tolist(), sizes[~long].tolist(), strict=True):
        h[end - size] = (codes[end - size: end] * _STEP[:size]).sum(dtype=np.uint64)
        whole[end - size + 1: end] = False
    return _mixed(h[whole]), np.maximum(sizes - SHINGLE + 1, 1)


def _tagged(h: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers of the tag (14 bits) and 50 bits of the hash."""
    both = (tag.astype(np.uint64) << np.uint64(50)) | (h >> np.uint64(14))
    both.sort()
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    return both[first]


def sets_of(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes (50 bits) of each line (``TAGS`` at most), line after line, and how many each has."""
    h, sizes = shingles(lines)
    both = _tagged(h, np.repeat(np.arange(len(lines)), sizes))
    return both & np.uint64((1 << 50) - 1), np.bincount((both >> np.uint64(50)).astype(np.int64), minlength=len(lines))


def similar(xs: list[str], ys: list[str]) -> np.ndarray:
    """Whether the sets of two lines have a Jaccard similarity of ``THRESHOLD`` percent, pair by pair (``TAGS`` at most)."""
    n, sides = len(xs), []
    for lines in (xs, ys):
        h, sizes = shingles(lines)
        sides.append(_tagged(h, np.repeat(np.arange(n), sizes)))
    nx, ny = (np.bincount((s >> np.uint64(50)).astype(np.int64), minlength=n) for s in sides)
    merged = np.concatenate(sides)
    merged.sort(kind="stable")                                   # two sorted runs
    twice = merged[1:][merged[1:] == merged[:-1]]
    common = np.bincount((twice >> np.uint64(50)).astype(np.int64), minlength=n)
    return 100 * common >= THRESHOLD * (nx + ny - common)


# Signatures

def _permuted(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """A 32-bit permutation of hashes, of which ``low`` and ``high`` are the halves."""
    x = low * _TURN[k, 0]
    x += high * _TURN[k, 1]
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(13)
    return x


def _halves(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)


def _long_signature(h: np.ndarray, line: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(lines, BANDS, ROWS): for each row's permutation, the least hash in each of BANDS parts of the range; and whether a part was empty."""
    out, gaps = np.empty((n, BANDS, ROWS), np.uint32), np.zeros(n, bool)
    base, halves = line * BANDS, _halves(h)
    for row in range(ROWS):
        x = _permuted(*halves, row)
        least = np.full(n * BANDS, _EMPTY)
        np.minimum.at(least, base + (((x >> np.uint32(16)) * np.uint32(BANDS)) >> np.uint32(16)), x)
        least = least.reshape(n, BANDS)
        gaps |= (least == _EMPTY).any(axis=1)
        while (empty := least == _EMPTY).any():
            least = np.where(empty, np.roll(least, -1, axis=1), least)
        out[:, :, row] = least
    return out, gaps


def _short_signature(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(lines, BANDS, ROWS): a permutation for each coordinate."""
    out, halves = np.empty((len(starts), BANDS, ROWS), np.uint32), _halves(h)
    for k in range(BANDS * ROWS):
        out[:, k // ROWS, k % ROWS] = np.minimum.reduceat(_permuted(*halves, ROWS + k), starts)
    return out


def _posted(signature: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (lines, BANDS), and a signature bit of each coordinate: ROWS of a band in a number (lines, BANDS)."""
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(way), signature.shape[:2])
    for row in range(ROWS):
        key = _mixed((key + np.uint64(1)) * _STEP[0] ^ signature[:, :, row])
    bits = (signature & np.uint32(1)) << np.arange(ROWS, dtype=np.uint32)
    return key, bits.sum(axis=2, dtype=np.uint64)


def _sketch(bits: np.ndarray) -> np.ndarray:
    """64 bits, of the first bands."""
    return (bits[:, :16] << np.arange(0, 64, ROWS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _wide_sketches(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each band, WIDE bits of those that follow it (the last one is followed by the first), in two parts (lines, BANDS)."""
    turned, first, more = np.concatenate([bits, bits], axis=1), np.empty(bits.shape, np.uint64), np.empty(bits.shape, np.uint32)
    for part, start, count in ((first, 1, 64 // ROWS), (more, 1 + 64 // ROWS, (WIDE - 64) // ROWS)):
        held = np.zeros(len(bits), np.uint64)
        for k in range(count):
            held |= turned[:, start + k] << np.uint64(ROWS * k)
        for band in range(BANDS):
            part[:, band] = held
            held = held >> np.uint64(ROWS) | turned[:, (start + count + band) % (2 * BANDS)] << np.uint64(ROWS * (count - 1))
    return first, more


def _portions(places: np.ndarray, lines: list[str]) -> Iterator[np.ndarray]:
    """``places`` in portions whose lines are of bounded size."""
    ends = np.cumsum([len(lines[k]) for k in places.tolist()])
    at = 0
    while at < len(places):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARACTERS, "right"))
        stop = min(max(stop, at + 1), at + TAGS)
        yield places[at:stop]
        at = stop


def signed(lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in ``lines`` (distinct, non-empty), band keys (places, BANDS) and sketches, in portions of bounded size."""
    return ((places, bands, _sketch(bits)) for places, bands, bits in _signed(lines))


def _signed(lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``signed``, with the bits of ``_posted`` for sketches."""
    distinct = np.fromiter((max(len(x) - SHINGLE + 1, 1) for x in lines), np.int64, len(lines))
    for places in _portions(np.flatnonzero(distinct >= LONG), lines):
        part = [lines[k] for k in places.tolist()]
        h, sizes = shingles(part)
        signature, gaps = _long_signature(h, np.repeat(np.arange(len(part)), sizes), len(part))
        # sets count, not places: a line that is not much longer than the limit, or leaves a part empty, has its set counted
        count = np.flatnonzero(gaps | (sizes < 4 * LONG * 100 // THRESHOLD))
        if len(count):
            chosen = np.zeros(len(part), bool)
            chosen[count] = True
            both = _tagged(h[np.repeat(chosen, sizes)], np.repeat(np.arange(len(count)), sizes[count]))
            distinct[places[count]] = np.bincount((both >> np.uint64(50)).astype(np.int64), minlength=len(count))
        enough = distinct[places] >= LONG
        if enough.any():
            yield places[enough], *_posted(signature[enough], 0)
    for places in _portions(np.flatnonzero(distinct * THRESHOLD < LONG * 100), lines):
        h, sizes = shingles([lines[k] for k in places.tolist()])
        yield places, *_posted(_short_signature(h, np.cumsum(sizes) - sizes), 1)


# Banding

def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)


def _band(keys: np.ndarray, slots: int) -> np.ndarray:
    """What members call a band: its slot and the bits of its key that lines are first posted with."""
    return _slot(keys, slots) << 32 | (keys & _BAND_BITS).astype(np.int64)


def _packed(bands: np.ndarray, keys: np.ndarray, sketches: np.ndarray, slots: int, more: np.ndarray | None = None) -> pa.RecordBatch:
    """Postings by slot, one packed block each; ``more``: the second parts of wide sketches."""
    slot = _slot(bands, slots)
    order = np.argsort(slot.astype(np.uint16) if slots <= 1 << 16 else slot, kind="stable")
    rows, key, band = np.empty(len(order), _POSTING if more is None else _FIRST), keys[order], bands[order].astype(np.uint32)
    rows["band"], rows["sketch"] = band if more is None else band & 0xFFFF, sketches[order]
    if more is not None:
        further = more[order]
        rows["band_high"], rows["more"], rows["more_high"] = band >> 16 & 0xFF, further & 0xFFFF, further >> 16
    rows["low"], rows["middle"], rows["high"] = key & 0xFFFFFFFF, key >> 32 & 0xFFFF, key >> 48
    slot = slot[order]
    first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
    used = slot[first]
    bounds = [*first.tolist(), len(rows)]
    return pa.RecordBatch.from_pydict({
        "slot": pa.array(used, pa.int32()),
        "block": pa.array([rows[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())})


def _blocks(lines: dict[int, str], slots: int) -> pa.RecordBatch:
    """Packed postings of lines."""
    keys, found = np.fromiter(lines, np.int64, len(lines)), []
    for places, bands, bits in _signed(list(lines.values())):
        first, more = _wide_sketches(bits)
        found.append((bands.ravel(), np.repeat(keys[places], BANDS), first.ravel(), more.ravel()))
    bands, keys, first, more = (np.concatenate(x) for x in zip(*found, strict=True))
    return _packed(bands, keys, first, slots, more)


def refined(texts: DataFrame, large: DataFrame, slots: int, inner: bool = False) -> DataFrame:
    """Postings of lines under pairs of bands: each of those in ``large`` (``band``, ``node``) with each other one of the line, a pair of two
    such bands once; ``inner``: pairs of two such bands only."""
    one, other = np.triu_indices(BANDS, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, len(batch), 500)):
                keys, lines, held = part.column(0).to_numpy(), part.column(1).to_pylist(), part.column(2).to_pylist()
                found = []
                for places, bands, sketches in signed(lines):
                    names = _band(bands, slots)
                    for at, own, name, sketch in zip(places.tolist(), bands, names, sketches, strict=True):
                        met = np.isin(name, held[at])            # none in the way of signing that it was not met in
                        some = met[one] & met[other] if inner else met[one] | met[other]
                        if some.any():
                            pairs = _mixed(own[one[some]] * _STEP[1] ^ own[other[some]] * _STEP[2])
                            found.append((pairs, np.full(len(pairs), keys[at]), np.full(len(pairs), sketch)))
                if found:
                    yield _packed(*(np.concatenate(x) for x in zip(*found, strict=True)), slots)

    wanted = large.groupBy(F.col("node").alias("k1")).agg(F.collect_set("band").alias("bands"))     # 2 * BANDS at most
    return texts.join(wanted, "k1").select("k1", "norm", "bands").mapInArrow(run, "slot int, block binary")


def postings(docs: DataFrame, text: str, slots: int) -> DataFrame:
    """``slot``, ``block``: the postings of all lines; equal lines of some batches once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, str] = {}
        for batch in batches:
            for one in batch.column(0).to_pylist():
                for line in (one or "").split("\n"):
                    norm = normal(line)
                    if norm:
                        held.setdefault(keys_of(norm)[0], norm)
                if len(held) * BANDS >= FLUSH:
                    yield _blocks(held, slots)
                    held = {}
        if held:
            yield _blocks(held, slots)

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "slot int, block binary")


def _line_keys(rows: np.ndarray) -> np.ndarray:
    return rows["low"].astype(np.int64) | rows["middle"].astype(np.int64) << 32 | rows["high"].astype(np.int64) << 48


def _sorted_postings(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys (within the slot), line keys and sketches in order, each line once in a band."""
    rows = np.frombuffer(b"".join(blocks), _POSTING)
    key = _line_keys(rows)
    order = np.lexsort((key, rows["band"]))
    band, key, sketch = rows["band"][order].astype(np.int64), key[order], rows["sketch"][order]
    new = np.ones(len(band), bool)
    new[1:] = (band[1:] != band[:-1]) | (key[1:] != key[:-1])
    return band[new], key[new], sketch[new]


def _members(slot: int, band: np.ndarray, key: np.ndarray, sketch: np.ndarray, hub: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "band": pa.array(band | np.int64(slot) << 32, pa.int64()), "k1": pa.array(key, pa.int64()),
        "sketch": pa.array(sketch.view(np.int64), pa.int64()), "hub": pa.array(hub, pa.int64()), "near": pa.array(near)})


def meet(slot: int, portions: Iterator[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """The members of a slot's bands: all of those with three lines or more; of two lines, the second one if it is near the first.
    ``near``: the sketches allow that it is similar to the band's hub, whose own row says so of itself.

    The first portion is usually the whole slot.  Where others follow, bands are kept with their hubs (and what has not been given yet)
    and the rest streams past them."""
    known = hubs = marks = None
    waiting = next(portions, None)
    while waiting is not None:
        now, waiting = waiting, next(portions, None)
        band, key, sketch = _sorted_postings(now)
        first = np.ones(len(band), bool)
        first[1:] = band[1:] != band[:-1]
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, len(band)))
        hub, mark = np.repeat(key[start], size), np.repeat(sketch[start], size)
        alone = np.repeat(size == 1, size)
        if known is not None:
            at = np.minimum(np.searchsorted(known, band), len(known) - 1)
            old = known[at] == band
            hub[old], mark[old] = hubs[at[old]], marks[at[old]]
            alone &= ~old
        near = np.bitwise_count(sketch ^ mark) <= DIFFER
        streamed = waiting is not None or known is not None       # a band may go on in a portion to come, so all are given
        give = ~alone if not streamed else np.ones(len(band), bool)
        if not streamed:
            two = np.repeat(size == 2, size)
            give &= ~two | (near & (key != hub))
        if give.any():
            yield _members(slot, band[give], key[give], sketch[give], hub[give], near[give])
        if waiting is not None:
            new = start if known is None else start[~old[start]]
            merged = np.concatenate([*([known] if known is not None else []), band[new]])
            order = np.argsort(merged, kind="stable")
            hubs = np.concatenate([*([hubs] if hubs is not None else []), key[new]])[order]
            marks = np.concatenate([*([marks] if marks is not None else []), sketch[new]])[order]
            known = merged[order]


def _met(sketches: np.ndarray) -> np.ndarray:
    """Which members are near another one of their band; a row for each band, all of the same size."""
    found = np.zeros(sketches.shape, bool)
    for k in range(1, sketches.shape[1] // 2 + 1):
        near = np.bitwise_count(sketches ^ np.roll(sketches, -k, axis=1)) <= DIFFER
        found |= near | np.roll(near, k, axis=1)
    return found


def sifted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What ``meet`` gives of a whole slot, without the members of bands of up to ``SIFTED`` that are near no other one."""
    band, sketch = batch.column(0).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
    start = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
    size = np.diff(np.append(start, len(band)))
    keep = np.ones(len(band), bool)
    for n in np.unique(size[(size > 1) & (size <= SIFTED)]).tolist():          # of two lines only the second one is given, if it is near
        at = start[size == n, None] + np.arange(n)
        keep[at] = _met(sketch[at])
    return batch.filter(pa.array(keep))


def _first_bands(rows: np.ndarray) -> np.ndarray:
    return rows["band"] | rows["band_high"].astype(np.uint32) << np.uint32(16)


def _by_bands(portions: list[list[bytes]]) -> Iterator[list[bytes]]:
    """First postings of a slot in as many portions, each with bands of its own."""
    rows, parts = [np.frombuffer(b"".join(x), _FIRST) for x in portions], len(portions)
    for part in range(parts):
        yield [x[_first_bands(x) % np.uint32(parts) == part].tobytes() for x in rows]


def _shared(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Band keys (within the slot), line keys and both parts of the sketches of first postings in order, each line once in a band, without
    those of bands with one line."""
    rows = np.frombuffer(b"".join(blocks), _FIRST)
    band = _first_bands(rows)
    order = np.argsort(band)
    again = np.diff(band[order]) == 0
    at = order[np.append(again, False) | np.append(False, again)] if len(order) else order
    rows, band = rows[at], band[at].astype(np.int64)
    key = _line_keys(rows)
    order = np.lexsort((key, band))
    band, key = band[order], key[order]
    new = np.ones(len(band), bool)
    new[1:] = (band[1:] != band[:-1]) | (key[1:] != key[:-1])
    band, key, rows = band[new], key[new], rows[order[new]]
    return band, key, rows["sketch"].copy(), rows["more"] | rows["more_high"].astype(np.uint32) << np.uint32(16)


def _near_pairs(sketch: np.ndarray, more: np.ndarray, start: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (the earlier one first) of near pairs within bands of ``n`` members from ``start`` on; some bands, or some members of one, at a time."""
    many = max(1, AREA // (n * n))
    for a in range(0, len(start), many):
        at = start[a: a + many, None] + np.arange(n)
        x = sketch[at]
        step = max(1, AREA // n)
        for row in range(0, n, step):
            near = np.bitwise_count(x[:, row: row + step, None] ^ x[:, None, row:]) <= DIFFER
            band, one, other = np.nonzero(near)
            later = other > one
            one, other = at[band[later], row + one[later]], at[band[later], row + other[later]]
            differ = np.bitwise_count(sketch[one] ^ sketch[other]) + np.bitwise_count(more[one] ^ more[other])
            yield one[differ <= WIDE_DIFFER], other[differ <= WIDE_DIFFER]


def near_pairs(slot: int, blocks: list[bytes], per: int, whole: int) -> pa.RecordBatch:
    """Of a slot's first postings: near pairs (``k1``, ``hub``; ``band`` null) of bands with up to ``per`` of them a member; of denser bands the members
    that are near another one, of those with more than ``whole`` members all."""
    band, key, sketch, more = _shared(blocks)
    start = np.flatnonzero(np.append(True, band[1:] != band[:-1])) if len(band) else np.array([], np.int64)
    size = np.diff(np.append(start, len(band)))
    of = np.repeat(np.arange(len(start)), size)
    degree, pairs, dense = np.zeros(len(band), np.int64), [], size > whole
    for n in np.unique(size[(size > 1) & ~dense]).tolist():
        for one, other in _near_pairs(sketch, more, start[size == n], n):
            counted, where = np.unique(np.concatenate([one, other]), return_inverse=True)
            degree[counted] += np.bincount(where, minlength=len(counted))
            if n * n > AREA and len(one):                        # the pairs of one band
                dense[of[one[0]]] |= degree[start[of[one[0]]]: start[of[one[0]]] + n].sum() > 2 * per * n
            pairs.append((one[(stay := ~dense[of[one]])], other[stay]))
    dense |= np.bincount(of, degree, minlength=len(start)) > 2 * per * size
    one, other = (np.concatenate(x) if pairs else np.array([], np.int64) for x in (list(zip(*pairs, strict=True)) or ([], [])))
    stay = ~dense[of[one]]
    one, other = one[stay], other[stay]
    # a dense band's hub is its first member of those with most near ones
    held = np.flatnonzero(dense[of] & ((degree > 0) | (size > whole)[of]))
    order = held[np.lexsort((held, -degree[held], of[held]))]
    first = np.ones(len(order), bool)
    first[1:] = of[order[1:]] != of[order[:-1]]
    hub = np.zeros(len(start), np.int64)
    hub[of[order[first]]] = order[first]
    hub = hub[of[held]]
    near = np.bitwise_count(sketch[held] ^ sketch[hub]) + np.bitwise_count(more[held] ^ more[hub]) <= WIDE_DIFFER
    found = _members(slot, band[held], key[held], sketch[held], key[hub], near)
    alone = pa.RecordBatch.from_pydict({
        "band": pa.nulls(len(one), pa.int64()), "k1": pa.array(key[one], pa.int64()), "sketch": pa.nulls(len(one), pa.int64()),
        "hub": pa.array(key[other], pa.int64()), "near": pa.array(np.ones(len(one), bool))})
    return pa.concat_batches([found, alone])


def members(blocks: DataFrame, first: bool = False) -> DataFrame:
    """``band``, ``k1``, ``sketch``, ``hub``, ``near`` of the bands that lines share; of ``first`` postings, near pairs as in ``near_pairs``."""
    itemsize, per, most = (_FIRST if first else _POSTING).itemsize, PAIRS, WHOLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((s, b) for batch in batches for s, b in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        following = next(rows, None)

        def portions(slot: int) -> Iterator[list[bytes]]:
            nonlocal following
            while following is not None and following[0] == slot:
                held, size = [], 0
                while following is not None and following[0] == slot and size < SLOT_POSTINGS * itemsize:
                    held.append(following[1])
                    size += len(following[1])
                    following = next(rows, None)
                yield held

        while following is not None:
            slot = following[0]
            held = portions(slot)
            now = next(held)
            whole = following is None or following[0] != slot
            if first:
                for blocks_of in [now] if whole else _by_bands([now, *held]):
                    yield near_pairs(slot, blocks_of, per, most)
                continue
            for batch in meet(slot, chain([now], held)):
                yield sifted(batch) if whole else batch

    dealt = blocks.repartition("slot").sortWithinPartitions("slot")
    return dealt.mapInArrow(run, "band long, k1 long, sketch long, hub long, near boolean")


# Texts of single lines

def norms(docs: DataFrame, text: str, nodes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``k1``, ``norm`` of the lines ``nodes`` (``k1``, each once)."""
    spark, at = docs.sparkSession, F.pmod("k1", F.lit(BITMAP)).cast("long")
    bits = nodes.groupBy(F.shiftright(at, 15).alias("part")).agg(
        F.bitmap_construct_agg(at.bitwiseAND(F.lit(32767).cast("long"))).alias("bits"))
    bitmap = np.zeros(BITMAP // 8, np.uint8)
    for r in bits.collect():                                         # BITMAP bits at most
        bitmap[r["part"] * 4096: (r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    wanted = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = wanted.value
        for batch in batches:
            found: dict[int, str] = {}
            for one in batch.column(0).to_pylist():
                for line in (one or "").split("\n"):
                    norm = normal(line)
                    if norm:
                        key = keys_of(norm)[0]
                        if held[key % BITMAP >> 3] >> (key & 7) & 1:
                            found[key] = norm
            yield pa.RecordBatch.from_pydict({"k1": pa.array(found.keys(), pa.int64()), "norm": pa.array(found.values(), pa.string())})

    every = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "k1 long, norm string")
    return scratch.write(every.join(nodes, "k1").dropDuplicates(["k1"]), name)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose lines' sets are similar; ``texts``: ``k1``, ``norm``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            sizes = [len(x) + len(y) for x, y in zip(*(batch.column(k).to_pylist() for k in (2, 3)), strict=True)]
            while at < len(batch):                                   # portions of bounded size
                stop, held = at, 0
                while stop < len(batch) and (stop == at or held + sizes[stop] <= CHARACTERS) and stop - at < TAGS:
                    held += sizes[stop]
                    stop += 1
                part = batch.slice(at, stop - at)
                good = similar(part.column(2).to_pylist(), part.column(3).to_pylist())
                yield part.select(["a", "b"]).filter(pa.array(good))
                at = stop

    both = pairs.join(texts.select(F.col("k1").alias("a"), F.col("norm").alias("na")), "a").join(
        texts.select(F.col("k1").alias("b"), F.col("norm").alias("nb")), "b")
    return both.select("a", "b", "na", "nb").mapInArrow(run, "a long, b long")


def _bit_sets(lines: list[str]) -> tuple[np.ndarray, Callable[[], Iterator[np.ndarray]]]:
    """How many shingles each line (``TAGS`` at most) has, and bit sets of those that two lines or more hold, some shingles at a time."""
    found = []
    for part in _portions(np.arange(len(lines)), lines):
        h, sizes = shingles([lines[k] for k in part.tolist()])
        found.append(h >> np.uint64(14) << np.uint64(14) | np.repeat(part, sizes).astype(np.uint64))
    both = np.concatenate(found)
    both.sort()
    both = both[np.append(True, both[1:] != both[:-1])]
    line = (both & np.uint64(TAGS - 1)).astype(np.int64)
    size = np.bincount(line, minlength=len(lines))
    new = np.append(True, both[1:] >> np.uint64(14) != both[:-1] >> np.uint64(14))
    shared = np.diff(np.append(np.flatnonzero(new), len(both))) > 1
    of = np.cumsum(new) - 1
    line, of = line[shared[of]], (np.cumsum(shared) - 1)[of[shared[of]]]
    items, step = int(shared.sum()), max(64, 32 * AREA // len(lines) // 64 * 64)

    def portion(at: int) -> np.ndarray:
        now = slice(*np.searchsorted(of, (at, at + step)).tolist())
        has = np.zeros((len(lines), min(step, -(-(items - at) // 64) * 64)), bool)
        has[line[now], of[now] - at] = True
        return np.packbits(has, axis=1).view(np.uint64)

    held = [portion(0)] if 0 < items <= step else None
    return size, lambda: iter(held) if held else map(portion, range(0, items, step))


def _near_across(c: np.ndarray, sketch: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of members of one band in different components that are near by sketch, those of some members at a time."""
    step = max(1, AREA // len(c))
    for row in range(0, len(c), step):
        near = np.bitwise_count(sketch[row: row + step, None] ^ sketch) <= DIFFER
        one, other = np.nonzero(near & (c[row: row + step, None] < c))
        yield one + row, other


def across(c: np.ndarray, node: np.ndarray, sketch: np.ndarray, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of one band's members in components ``c``: similar pairs across them, as few as join all components that such pairs join."""
    used = np.zeros(len(c), bool)
    for one, other in _near_across(c, sketch):
        used[one] = used[other] = True
    a, b = [node[:0]], [node[:0]]
    if not used.any():
        return a[0], b[0]
    c, node, sketch = c[used], node[used], sketch[used]
    size, sets = _bit_sets([lines[k] for k in np.flatnonzero(used).tolist()])
    group = np.unique(c, return_inverse=True)[1]                 # components, joined as far as is known
    for one, other in _near_across(c, sketch):
        stay = group[one] != group[other]
        one, other = one[stay], other[stay]
        common = np.zeros(len(one), np.int64)
        for bits in sets():
            many = max(1, AREA // bits.shape[1])
            for k in range(0, len(one), many):
                common[k: k + many] += np.bitwise_count(bits[one[k: k + many]] & bits[other[k: k + many]]).sum(axis=1, dtype=np.int64)
        good = 100 * common >= THRESHOLD * (size[one] + size[other] - common)
        one, other = one[good], other[good]
        _, first = np.unique(group[one] * len(group) + group[other], return_index=True)
        for x, y in zip(one[first].tolist(), other[first].tolist(), strict=True):
            if group[x] != group[y]:
                a.append(node[x: x + 1])
                b.append(node[y: y + 1])
                group[group == group[y]] = group[x]
    return np.concatenate(a), np.concatenate(b)


def open_links(rows: DataFrame) -> DataFrame:
    """``rows``: ``band``, ``c``, ``node``, ``sketch``, ``norm`` of members of bands that are open across components ``c``.  Gives similar pairs
    ``a``, ``b`` that join all that each band can (``band`` null), and as ``a`` the members of bands with more than ``BAND_CHARACTERS``."""
    most = BAND_CHARACTERS

    def links(band: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        part = pa.Table.from_batches(held)
        a, b = across(*(part.column(k).to_numpy() for k in (1, 2)), part.column(3).to_numpy().view(np.uint64), part.column(4).to_pylist())
        return pa.RecordBatch.from_pydict({"band": pa.nulls(len(a), pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def too_large(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"band": part.column(0), "a": part.column(2), "b": pa.nulls(len(part), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, held, size = None, [], 0                           # of the band that has begun; its size is over the limit when its rows go out at once
        for batch in batches:
            bands = batch.column(0).to_numpy()
            bounds = np.append(np.flatnonzero(np.append(True, bands[1:] != bands[:-1])), len(bands)).tolist() if len(bands) else []
            for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                part = batch.slice(start, stop - start)
                if bands[start] != band:
                    if held:
                        yield links(band, held)
                    band, held, size = int(bands[start]), [], 0
                size += sum(map(len, part.column(4).to_pylist()))
                held.append(part)
                if size > most:
                    yield from map(too_large, held)
                    held = []
        if held:
            yield links(band, held)

    dealt = rows.select("band", "c", "node", "sketch", "norm").repartition("band").sortWithinPartitions("band")
    return dealt.mapInArrow(run, "band long, a long, b long")


def sets_frame(texts: DataFrame) -> DataFrame:
    """``node``, ``items``: lines with their sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, len(batch), 1000)):
                h, sizes = sets_of(part.column(1).to_pylist())
                items = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes.tolist()]), pa.int32()), pa.array(h.astype(np.int64), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), items], ["node", "items"])

    return texts.select("k1", "norm").mapInArrow(run, "node long, items array<long>")


# Lines and groups

def row_key(doc_id: str, text: str) -> Column:
    """Tells rows apart that share a doc_id or have none; the same for rows with equal doc_id and text, whose lines are the same."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``row``, ``line_no`` (from 0), ``k1``, ``k2`` (null for a blank line)."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), row_key(doc_id, text).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [(t or "").split("\n") for t in batch.column(2).to_pylist()]
            counts = np.fromiter(map(len, split), np.int64, len(split))
            of = pa.array(np.repeat(np.arange(len(split)), counts))
            numbers = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            keys = [keys_of(n) if (n := normal(x)) else (None, None) for lines in split for x in lines]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(1).take(of), pa.array(numbers, pa.int32()),
                 *(pa.array(c, pa.int64()) for c in zip(*keys, strict=True))] if keys else
                [batch.column(0), batch.column(1), *(pa.array([], t) for t in (pa.int32(), pa.int64(), pa.int64()))],
                ["doc_id", "row", "line_no", "k1", "k2"])

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, row long, line_no int, k1 long, k2 long")


def line_groups(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line: ``doc_id``, ``line_no``, ``keep_doc_id``, ``keep_line_no``, ``kept``."""
    return grouped_lines(docs, scratch, doc_id, text).drop("row")


def line_links(docs: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """Pairs (``a``, ``b``) of keys of lines whose sets are similar, enough to join all that the bands find."""
    slots = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = scratch.write(members(postings(docs, text, slots), first=True), "members")
    nodes = met.select("k1").union(met.filter("near").select("hub")).distinct()
    texts = norms(docs, text, nodes, scratch, "norms")
    scratch.settle()
    links, large = _linked(met, None, texts, scratch)
    if not large.isEmpty():
        several = large.groupBy(F.col("node").alias("k1")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k1")
        held = scratch.write(texts.join(several, "k1"), "large-norms")
        scratch.drop(texts)
        texts = held
        known, first = links, large
        met = scratch.write(members(refined(texts, first, slots, inner=True)), "members")
        links, large = _linked(met, known, texts, scratch)
        scratch.drop(known)
        scratch.drop(first)
        if not large.isEmpty():
            further = scratch.write(texts.join(large.select(F.col("node").alias("k1")).distinct(), "k1"), "further-norms")
            scratch.drop(texts)
            scratch.drop(large)
            texts = further
            sets = scratch.write(sets_frame(texts), "large-sets")
            more = cross_links(sets, links, THRESHOLD, scratch, lambda pairs, name: scratch.write(verified(pairs, texts), name))
            links = links.unionByName(more)
            scratch.drop(sets)
    scratch.drop(texts)
    return links


def _linked(met: DataFrame, known: DataFrame | None, texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The links that ``members`` have (with those ``known``), and the members (``band``, ``node``) of large bands that still are in several
    components; ``texts``: ``k1``, ``norm`` of all of them."""
    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    first = scratch.write(ordered(met.filter("near AND k1 <> hub").select(F.col("k1").alias("a"), F.col("hub").alias("b"))), "hub-pairs")
    hub = scratch.write(verified(first, texts), "hub-links")
    scratch.settle()
    links = hub if known is None else hub.unionByName(known)
    banded = met.filter("band IS NOT NULL").select(F.col("k1").alias("node"), "band", "sketch")
    if banded.isEmpty():
        scratch.drop(first)
        return (links if known is None else scratch.write(links, "links")), banded.select("band", "node")
    group = components(links, scratch)
    rest = open_rows(banded, group, scratch, "band", held="held")
    scratch.drop(met)
    scratch.drop(group)
    scratch.settle()
    small = rest.filter(F.col("held") <= SMALL_BAND).join(texts.withColumnRenamed("k1", "node"), "node")
    found = scratch.write(open_links(small), "across")
    scratch.drop(first)
    scratch.settle()
    links = scratch.write(links.unionByName(found.filter("band IS NULL").select("a", "b")), "links")
    scratch.drop(hub)
    large = rest.filter(F.col("held") > SMALL_BAND).select("band", "node")
    return links, large.unionByName(found.filter("band IS NOT NULL").select("band", F.col("a").alias("node")))


def grouped_lines(docs: DataFrame, scratch: Scratch, doc_id: str, text: str) -> DataFrame:
    """``line_groups`` with the key of each line's ``row``."""
    small_batches(docs.sparkSession, rows=1000, size="8m")
    lines = scratch.write(lines_of(docs, doc_id, text), "lines")
    label = components(line_links(docs, text, scratch), scratch)
    # each key's first line, and how many lines have it: combined map-side, so a very common line is a row for each task
    keys = lines.filter("k1 IS NOT NULL").groupBy("k1").agg(F.min(F.struct("k2", "doc_id", "line_no")).alias("at"), F.count(F.lit(1)).alias("n"))
    # only lines that are repeated or linked need another line's place
    classes = keys.join(label.withColumnRenamed("node", "k1"), "k1", "left").filter("n > 1 OR component IS NOT NULL")
    classes = scratch.write(classes.select("k1", F.col("at.k2").alias("k2"), F.coalesce("component", "k1").alias("c"), F.col("at.doc_id").alias("doc_id"),
                                           F.col("at.line_no").alias("line_no")), "classes")
    best = classes.groupBy("c").agg(F.min(F.struct("doc_id", "line_no")).alias("best"))
    stay = scratch.write(classes.join(best, "c").select("k1", "k2", "best"), "stay")
    # a blank line or one alone looks nothing up; its key is spread by its place
    found = lines.withColumn("_key", F.coalesce("k1", F.xxhash64("row", "line_no")))
    joined = found.join(stay.select(F.col("k1").alias("_key"), F.col("k2").alias("_k2"), "best"), "_key", "left")
    hit = F.col("k1").isNotNull() & (F.col("k2") == F.col("_k2")) & F.col("best").isNotNull()
    keep_doc = F.when(hit, F.col("best.doc_id")).otherwise(F.col("doc_id"))
    keep_line = F.when(hit, F.col("best.line_no")).otherwise(F.col("line_no"))
    return joined.select("doc_id", "row", "line_no", keep_doc.alias("keep_doc_id"), keep_line.alias("keep_line_no")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("line_no") == F.col("keep_line_no")))


def dedup_lines(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines that go taken out of its texts; a text that loses all its lines is empty, a null text stays null.
    A row's dropped line numbers come back to it, never its lines."""
    groups = grouped_lines(docs, scratch, doc_id, text)
    gone = scratch.write(groups.filter("NOT kept").groupBy(F.col("row").alias("_gone_row")).agg(
        F.collect_set("line_no").alias("_gone")), "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(doc_id, text).alias("_row"))
    joined = rows.join(gone, F.col("_row") == F.col("_gone_row"), "left")
    body = F.array_join(F.filter(F.split(F.col(f"row.`{text}`"), "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    body = F.when(F.col("_gone").isNotNull(), body).otherwise(F.col(f"row.`{text}`"))
    return joined.select(*[(body if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
