"""Language identification by error-correcting output codes.

Each learned language has a codeword; one binary classifier per bit tells the languages that
have the bit from those that have not, by hashed character n-grams (log-odds of the
two groups' mean n-gram distributions, averaged over a text's n-grams).  Decoding is
loss-weighted: a bit's loss counts by how often its classifier is right on that language's
sample, and the language with the least loss wins.  The share of the best among all, by a
softmax of the losses, is the score; a small lead over the second flags the text as ambiguous.

Fitting uses a bounded sample, about ``SAMPLE_ROWS`` labelled rows of each language, chosen by a
hash of doc_id; what is gathered is one count per language and n-gram bucket, added up on
the executors.  Prediction is one pass over whole texts without a shuffle.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or when
nothing could be learned; rows without lang, text or doc_id are not learned from; a null doc_id is not
held out; with one learned language every text with a letter gets it; empty tables give no
rows; other columns pass by untouched.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch, small_batches

SAMPLE_ROWS = 2000        # labelled rows of each language, on average
MAX_LANGUAGES = 512       # the labels with most rows; others are not learned, so the model stays small
BUCKET_BITS = 14
ORDERS = (1, 2, 3)
CHUNK = 1 << 20           # characters of a long text handled at once
SHARPNESS = 4.0
AMBIGUOUS_LEAD = 0.2
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_IS_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a text; all that is no letter is a space."""
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    for at in range(0, len(text), CHUNK):
        chars = np.frombuffer(f" {text[at: at + CHUNK].lower()} ".encode("utf-32-le", "replace"), np.uint32)
        chars = np.where((chars >= 1 << 16) | _IS_LETTER[np.minimum(chars, (1 << 16) - 1)], chars, np.uint32(32))
        mixed = np.zeros(len(chars), np.uint32)
        for order in ORDERS:
            mixed = (mixed[: len(chars) - order + 1] ^ chars[order - 1:]) * _MIX[order - 1]
            spread = (mixed ^ (mixed >> np.uint32(15))) * _MIX[0]
            out += np.bincount(spread >> np.uint32(32 - BUCKET_BITS), minlength=len(out))
    return out


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages; every column has both.

    Up to seven languages get the exhaustive code; more get the best of some seeded random codes, by
    the least distance between two rows."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 7:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(columns, dtype=float).T
    bits, best, far = 10 * int(np.ceil(np.log2(n))), None, -1.0
    random = np.random.default_rng(n)
    for _ in range(50):
        code = random.choice([-1.0, 1.0], size=(n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        distance = code.shape[1] - code @ code.T
        np.fill_diagonal(distance, np.inf)
        if distance.min() > far:
            best, far = code, distance.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray        # languages x bits
    weights: np.ndarray     # buckets x bits
    scale: np.ndarray       # bits
    trust: np.ndarray       # languages x bits, rows add up to 1

    def margins(self, text: str) -> np.ndarray:
        counts = gram_counts(text)
        return counts.astype(np.float32) @ self.weights / max(1, counts.sum())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, ambiguous."""
        if not self.languages or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        loss = (self.trust * np.logaddexp(0.0, -2.0 * self.code * (self.margins(text) / self.scale))).sum(axis=1)
        share = np.exp(-SHARPNESS * (loss - loss.min()))
        share /= share.sum()
        first = int(share.argmax())
        second = float(np.delete(share, first).max()) if len(share) > 1 else 0.0
        return self.languages[first], float(share[first]), bool(share[first] - second < AMBIGUOUS_LEAD)


def fit(labelled: DataFrame, scratch: Scratch, sample_rows: int = SAMPLE_ROWS) -> Model:
    """``labelled``: ``doc_id``, ``text``, ``lang``, none null."""
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    sizes.sort(key=lambda r: r["lang"])
    languages = [r["lang"] for r in sizes]
    if not languages:
        return Model([], *[np.zeros(0)] * 4)
    spark = labelled.sparkSession
    small_batches(spark)
    shares = spark.createDataFrame([(r["lang"], i, min(1.0, sample_rows / r["n"])) for i, r in enumerate(sizes)],
                                   "lang string, k int, share double")
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    sample = scratch.write(labelled.join(F.broadcast(shares), "lang").filter(drawn).select("k", "text"), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[k] = sums.get(k, 0) + gram_counts(text)
        for k, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"k": pa.array([k] * len(at), pa.int32()), "bucket": pa.array(at, pa.int32()),
                                              "n": pa.array(counts[at], pa.int64())})

    found = (sample.mapInArrow(count, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n"))
             .toPandas())
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    counts[found["k"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    shares_of = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1])
    code = codewords(len(languages))
    weights = np.zeros((counts.shape[1], code.shape[1]), np.float32)
    if len(languages) > 1:
        for b in range(code.shape[1]):
            weights[:, b] = np.log(shares_of[code[:, b] > 0].mean(axis=0)) - np.log(shares_of[code[:, b] < 0].mean(axis=0))
    model = Model(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, *code.shape))
        for batch in batches:
            for k, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                m = model.margins(text)
                sums[0, k] += 1
                sums[1, k] += np.abs(m)
                sums[2, k] += m * code[k] > 0
        k, b = (x.ravel() for x in np.indices(code.shape))
        yield pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int32()), "b": pa.array(b, pa.int32()),
                                          **{c: pa.array(sums[i].ravel()) for i, c in enumerate(("n", "size", "right"))}})

    seen = (sample.mapInArrow(measure, "k int, b int, n double, size double, right double").groupBy("k", "b")
            .agg(*[F.sum(c).alias(c) for c in ("n", "size", "right")]).toPandas())
    sums = np.zeros((3, *code.shape))
    for i, c in enumerate(("n", "size", "right")):
        sums[i, seen["k"].to_numpy(), seen["b"].to_numpy()] = seen[c].to_numpy()
    model.scale = np.maximum(sums[1].sum(axis=0) / np.maximum(1, sums[0].sum(axis=0)), 1e-9)
    right = (sums[2] + 1) / (sums[0] + 2)
    model.trust = right / right.sum(axis=1, keepdims=True)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that a model learns from."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).dropna()


def identify(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``; all, when none are named), ``held_out``, ``lang_pred``,
    ``score``, ``ambiguous``."""
    carry = carry or docs.columns
    model = fit(labelled_rows(docs, doc_id, text, lang), scratch)
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
                         held_out(F.col(doc_id)).alias("held_out"),
                         *([] if text in carry else [F.col(text).alias("_text")]))
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field(text) if text in carry else batch.column(2)
            found = [model.predict(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                ["row", "held_out", "lang_pred", "score", "ambiguous"])

    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, held_out boolean, "
                                  "lang_pred string, score double, ambiguous boolean")
