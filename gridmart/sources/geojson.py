"""GeoJSON FeatureCollections read in ranges, and written as one document.

Reading.  A document is cut into ranges of ``RANGE`` bytes, each moved on to the next comma.  Whether a range begins
inside a string, how deep it is nested and which member of the root it is in depends on all the bytes before it; so there are two passes:

1. ``summaries``: each range is scanned for both cases (begins inside a string or not).  A scan gives the state at its end, the
   change of depth, the lowest depth reached and, for each new lowest depth, the last member name seen there.  All of
   that is relative, so ranges are independent.
2. ``chain`` goes through the summaries of a document in order (one small row a range, the only thing the driver holds) and
   gives each range its true beginning.  Documents that are cut off, nested wrongly or no FeatureCollection are told here.
3. ``extract``: each range scans once more, with its true beginning, and gives the text of every feature that begins in it, reading on
   beyond its end until the last one is closed.  Spark's own JSON functions parse the features.

Scans work on whole blocks with numpy: quotes that no odd number of backslashes precedes toggle strings; braces and brackets outside
strings add up to the depth.  A task holds a range and the rest of one feature, never a document.

Writing.  Features are written in order as parts by Spark's text writer, then joined with header, separators and footer by a streaming copy
through the Hadoop file system, and moved into place in one step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.sources import tables
from gridmart.sources.storage import filesystem

RANGE = 16 << 20          # bytes of a document that one task scans
READ_ON = 1 << 20         # bytes read at a time beyond a range's end
QUOTE, BACKSLASH, COMMA, COLON = b'"\\,:'
OPEN, CLOSE = (ord("{"), ord("[")), (ord("}"), ord("]"))
BOM = b"\xef\xbb\xbf"


class BrokenGeoJson(ValueError):
    """A GeoJSON document that is cut off or is no FeatureCollection."""


# Scanning

def _quotes(block: np.ndarray) -> np.ndarray:
    """Places of the quotes that are not escaped.  A block never begins behind a backslash: it follows a comma."""
    quotes = np.flatnonzero(block == QUOTE)
    slashed = quotes[(quotes > 0) & (block[quotes - 1] == BACKSLASH)]
    escaped = []
    for at in slashed.tolist():
        run = at
        while run and block[run - 1] == BACKSLASH:
            run -= 1
        if (at - run) % 2:
            escaped.append(at)
    return np.setdiff1d(quotes, escaped, assume_unique=True) if escaped else quotes


@dataclass
class Scan:
    """Structure of a block whose first byte is inside a string or not."""

    quotes: np.ndarray        # unescaped
    places: np.ndarray        # of brackets and colons outside strings
    chars: np.ndarray
    depth: np.ndarray         # after each of them, from 0 at the block's beginning
    ends_inside: bool         # a string


def scan(block: np.ndarray, inside: bool, quotes: np.ndarray | None = None) -> Scan:
    quotes = _quotes(block) if quotes is None else quotes
    kind = np.zeros(256, np.int8)
    kind[list(OPEN)], kind[list(CLOSE)], kind[COLON] = 1, -1, 2
    marks = kind[block]
    places = np.flatnonzero(marks)
    before = np.searchsorted(quotes, places)              # quotes before each
    places = places[(before + inside) % 2 == 0]
    steps = marks[places].astype(np.int64)
    steps[steps == 2] = 0
    return Scan(quotes, places, block[places], np.cumsum(steps), bool((len(quotes) + inside) % 2))


def _member(block: np.ndarray, s: Scan, colon: int, inside: bool) -> str | None:
    """The name of the member whose colon is there; None if it begins before the block."""
    k = int(np.searchsorted(s.quotes, colon))
    if k < 2 or (k - 2 + inside) % 2:
        return None
    try:
        return json.loads(block[s.quotes[k - 2]: s.quotes[k - 1] + 1].tobytes())
    except ValueError:
        return None


def _text_value(block: np.ndarray, s: Scan, colon: int) -> str | None:
    """The member's value if it is a string that lies in the block."""
    k = int(np.searchsorted(s.quotes, colon))
    if k + 1 >= len(s.quotes) or block[colon + 1: s.quotes[k]].tobytes().strip():
        return None
    try:
        return json.loads(block[s.quotes[k]: s.quotes[k + 1] + 1].tobytes())
    except ValueError:
        return None


def _array_value(block: np.ndarray, s: Scan, colon: int) -> bool:
    """Whether the member's value is an array."""
    k = int(np.searchsorted(s.places, colon)) + 1
    return k < len(s.places) and s.chars[k] == OPEN[1] and not block[colon + 1: s.places[k]].tobytes().strip()


def summary(block: np.ndarray, inside: bool, quotes: np.ndarray, first: bool = False) -> dict:
    """What a range does to the state it begins in.  Members of the root lie one level deep: in the ``first`` range that is
    depth 1, in any other it is one of the lowest depths reached, as the root is closed last."""
    s = scan(block, inside, quotes)
    lowest = np.minimum.accumulate(np.minimum(s.depth, 0)) if len(s.depth) else s.depth
    names: dict[int, list] = {}                            # depth -> last member there, type's value, arrays named features
    for k in np.flatnonzero((s.chars == COLON) & (s.depth == (1 if first else lowest))).tolist():
        colon, name = int(s.places[k]), _member(block, s, int(s.places[k]), inside)
        entry = names.setdefault(int(s.depth[k]), [None, None, 0])
        entry[0] = name if name != "features" or _array_value(block, s, colon) else "features (no array)"
        if name == "type":
            entry[1] = _text_value(block, s, colon)
        entry[2] += entry[0] == "features"
    return {"inside": s.ends_inside, "depth": int(s.depth[-1]) if len(s.depth) else 0, "low": int(lowest[-1]) if len(s.depth) else 0,
            "names": {str(d): v for d, v in names.items()}}


# Ranges

@dataclass
class Range:
    path: str
    number: int
    begin: int
    end: int                  # after the comma that the next range follows
    size: int                 # of the document


def _next_comma(file, at: int, size: int) -> int:
    """The place after the first comma at or after ``at``; the document's size if there is none."""
    file.seek(at)
    while at < size:
        block = file.read(min(READ_ON, size - at))
        if not block:
            break
        found = block.find(b",")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return size


def _bounds(file, number: int, length: int, size: int) -> tuple[int, int]:
    begin = 0 if number == 0 else _next_comma(file, number * length, size)
    end = size if (number + 1) * length >= size else _next_comma(file, (number + 1) * length, size)
    return begin, max(begin, end)


def _read(file, begin: int, end: int) -> np.ndarray:
    file.seek(begin)
    data = file.read(end - begin)
    if begin == 0 and data[:3] == BOM:
        data = b"   " + data[3:]
    return np.frombuffer(data, np.uint8)


def list_ranges(spark: SparkSession, path: str | Sequence[str], length: int = RANGE) -> DataFrame:
    """``path``, ``number``, ``size``: the ranges of the documents of a path, one partition each (up to 10,000)."""
    found = []
    from gridmart.sources.files import _files
    for one in _files(spark, path):
        fs, p = tables.hadoop(spark, one)
        found.append((one, fs.getFileStatus(p).getLen()))
    docs = spark.createDataFrame(found, "path string, size long")
    each = docs.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
        F.lit(0).cast("long"), F.ceil(F.col("size") / length) - 1))).alias("number"))
    count = sum(max(1, -(-size // length)) for _, size in found)
    return each.repartition(max(1, min(10_000, count)), "path", "number")


SUMMARY = "path string, number long, begin long, end long, size long, outside string, inside string"


def summaries(ranges: DataFrame, length: int = RANGE) -> DataFrame:
    """Pass 1: one row a range, with its summary for both cases as JSON."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, at = filesystem(row["path"])
                with store.open_input_file(at) as file:
                    begin, end = _bounds(file, row["number"], length, row["size"])
                    block = _read(file, begin, end)
                quotes = _quotes(block)
                told = [json.dumps(summary(block, inside, quotes, begin == 0)) for inside in (False, True)]
                yield pa.RecordBatch.from_pylist([{"path": row["path"], "number": row["number"], "begin": begin, "end": end,
                                                   "size": row["size"], "outside": told[0], "inside": told[1]}],
                                                 schema=pa.schema([(n, pa.int64() if t == "long" else pa.string())
                                                                   for n, t in (c.split() for c in SUMMARY.split(", "))]))

    return ranges.select("path", "number", "size").mapInArrow(run, SUMMARY)


@dataclass
class Document:
    """State of the chain through a document's ranges."""

    path: str
    inside: bool = False
    depth: int = 0
    member: str | None = None              # of the root, in which the next range begins
    kind: str | None = None
    arrays: int = 0                        # features arrays seen
    begun: list = field(default_factory=list)

    def step(self, row: dict) -> tuple:
        """The true beginning of a range; moves on to its end."""
        at = (self.path, row["begin"], row["end"], row["size"], self.inside, self.depth, self.member)
        told = json.loads(row["inside" if self.inside else "outside"])
        entry = told["names"].get(str(1 - self.depth))
        if entry:
            self.member = entry[0]
            self.kind = entry[1] if entry[1] is not None else self.kind
            self.arrays += entry[2]
        if self.depth + told["low"] < 0:
            raise BrokenGeoJson(f"{self.path}: closed before it was opened")
        self.inside, self.depth = told["inside"], self.depth + told["depth"]
        return at

    def close(self) -> None:
        if self.inside or self.depth:
            raise BrokenGeoJson(f"{self.path}: cut off")
        if self.kind != "FeatureCollection" or not self.arrays:
            raise BrokenGeoJson(f"{self.path}: no FeatureCollection")


def chain(rows: Sequence[dict]) -> list[tuple]:
    """Pass 2, on the driver: (path, begin, end, size, inside, depth, member) of each range that is not empty."""
    by_path: dict[str, list] = {}
    for row in rows:
        by_path.setdefault(row["path"], []).append(row)
    found = []
    for path, of in sorted(by_path.items()):
        doc = Document(path)
        found += [doc.step(row) for row in sorted(of, key=lambda r: r["number"]) if row["begin"] < row["end"]]
        doc.close()
    return found


def features_of(file, begin: int, end: int, size: int, inside: bool, depth: int, member: str | None) -> Iterator[tuple[int, bytes]]:
    """Pass 3: place and text of each feature that begins in a range."""
    block = _read(file, begin, end)
    s = scan(block, inside)
    depths = s.depth + depth
    # the root's member that each place is in
    names = [(-1, member)] + [(k, _member(block, s, int(s.places[k]), inside))
                              for k in np.flatnonzero((s.chars == COLON) & (depths == 1)).tolist()]
    opens = np.flatnonzero((s.chars == OPEN[0]) & (depths == 3))
    owner = np.searchsorted([k for k, _ in names], opens) - 1
    closes = np.flatnonzero((s.chars == CLOSE[0]) & (depths == 2))
    arrays = _in_arrays(s, depths, opens)
    for k, o, array in zip(opens.tolist(), owner.tolist(), arrays.tolist(), strict=True):
        if names[o][1] != "features" or not array:
            continue
        first = int(s.places[k])
        c = int(np.searchsorted(closes, k))
        if c < len(closes):
            yield begin + first, block[first: s.places[closes[c]] + 1].tobytes()
        else:
            yield begin + first, _read_on(file, block[first:].tobytes(), end, size)


def _in_arrays(s: Scan, depths: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Whether what is opened at depth 3 lies in an array (a feature does) rather than an object."""
    second = np.flatnonzero(((s.chars == OPEN[0]) | (s.chars == OPEN[1])) & (depths == 2))
    k = np.searchsorted(second, opens) - 1
    # opened before the range: the member is known to be the array of features, or is none of interest
    return np.where(k < 0, True, s.chars[second[np.maximum(k, 0)]] == OPEN[1]) if len(second) else np.ones(len(opens), bool)


def _read_on(file, text: bytes, at: int, size: int) -> bytes:
    """A feature's text up to its closing brace, which lies beyond the range."""
    file.seek(at)
    while True:
        s = scan(np.frombuffer(text, np.uint8), False)
        shut = np.flatnonzero((s.depth == 0) & (s.chars == CLOSE[0]))
        if len(shut):
            return text[: s.places[shut[0]] + 1]
        more = file.read(min(max(READ_ON, len(text)), size - at))       # doubles, so a long feature is not scanned often
        if not more:
            raise BrokenGeoJson("a feature is not closed")
        text += more
        at += len(more)


def read_features(spark: SparkSession, path: str | Sequence[str], length: int = RANGE) -> DataFrame:
    """``path``, ``at`` (byte), ``feature`` (its JSON text) for each feature of the FeatureCollections of a path.

    Runs the first pass; a broken document raises :class:`BrokenGeoJson`."""
    rows = [r.asDict() for r in summaries(list_ranges(spark, path, length), length).collect()]
    begun = chain(rows)
    known = spark.createDataFrame(begun, "path string, begin long, end long, size long, inside boolean, depth long, member string")
    known = known.repartition(max(1, min(10_000, len(begun))), "path", "begin")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, at = filesystem(r["path"])
                places, texts, held = [], [], 0
                with store.open_input_file(at) as file:
                    for place, text in features_of(file, *(r[c] for c in ("begin", "end", "size", "inside", "depth", "member"))):
                        places.append(place)
                        texts.append(text)
                        held += len(text)
                        if held >= 4 << 20:
                            yield _features(r["path"], places, texts)
                            places, texts, held = [], [], 0
                if texts:
                    yield _features(r["path"], places, texts)

    return known.mapInArrow(run, "path string, at long, feature string")


def _features(path: str, places: list[int], texts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(texts)), pa.array(places, pa.int64()),
                                       pa.array(texts, pa.binary()).cast(pa.string())], ["path", "at", "feature"])


# Writing

HEADER, SEPARATOR, FOOTER = '{"type":"FeatureCollection","features":[\n', ",\n", "\n]}\n"


def write_document(features: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """One FeatureCollection at ``path`` from a frame whose column ``feature`` holds each Feature's JSON, in the order of the columns
    ``order`` and then of the text itself; the driver copies bytes and holds a buffer."""
    spark = features.sparkSession
    folder = f"{path}.parts-{uuid.uuid4().hex[:12]}"
    lines = features.orderBy(*[F.col(c).asc_nulls_last() for c in order], "feature").select("feature")
    lines.write.option("lineSep", SEPARATOR).text(folder)
    fs, root = tables.hadoop(spark, folder)
    parts = sorted((f.getPath().toString(), f.getLen()) for f in fs.listStatus(root)
                   if f.getPath().getName().startswith("part-") and f.getLen())
    copy = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.copyLarge
    _, staged = tables.hadoop(spark, f"{folder}/_document")
    out = fs.create(staged, True)
    out.write(bytearray(HEADER.encode()))
    for k, (part, size) in enumerate(parts):
        source = fs.open(tables.hadoop(spark, part)[1])
        copy(source, out, 0, size - (len(SEPARATOR) if k == len(parts) - 1 else 0))     # no separator behind the last one
        source.close()
    out.write(bytearray(FOOTER.encode()))
    out.close()
    tables.rename(spark, staged, tables.hadoop(spark, path)[1])
    fs.delete(root, True)
