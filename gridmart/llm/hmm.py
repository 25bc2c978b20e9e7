"""Hidden Markov language model of whole texts.

Tokens are the words of a text, A-Z lower-cased, and one end token.  Latent states emit word classes: the ``FREQUENT`` words with most
training tokens are classes of their own, other words share ``CLASSES`` classes by a hash, and the end is one; inside a class a word has its
share of the class's training tokens, and a word unseen in training the class's share of unseen words, taken from the words
seen once.  So the states' parameters have a fixed size (words beyond the frequent ones tell states apart by their class only),
while every word's count is learned.

Training is Baum-Welch, and uses every training document: each task runs scaled forward and backward recursions over its documents and gives
expected counts, which Spark adds up.  In each of ``EPOCHS`` epochs the documents are dealt by a hash into ``PARTS`` parts, and a round runs
over each part in turn; its counts are blended into the running ones with a weight that falls from round to round.  Last, a
round runs over all of them.  For training, a document is cut into sequences of at most
``SEGMENT`` tokens.  Scoring is the exact scaled forward recursion over each whole document.

Word counts never meet in one place: documents are dealt into batches of bounded size; each batch sends its
distinct words' counts to where a word's counts are added up, and gets back the totals of words that
other batches have, too.  The vocabulary is never collected or broadcast.

Defined results: a null or empty text, or one without words, is the end token alone; a null doc_id is
neither learned from nor held out; repeated rows are documents of their own; without training documents
all words are unseen; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch, small_batches

STATES, CLASSES, FREQUENT = 8, 8192, 16384
EPOCHS, PARTS = 1, 6
FORGET = 0.7              # round t (from 0) weighs (t + 1) ** -FORGET
SEGMENT = 1024
STEP_TOKENS = 300_000     # that one forward and backward pass handles at once; about 100 MB
BATCH_CHARS = 16_000_000
PRIOR = 50.0              # weight of the overall class shares in a state's
SMOOTH = 0.1              # of the base model
END = b""                 # no word is empty


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def words_of(text: str | None) -> list[bytes]:
    """Bytes: lower-cases A-Z and splits at the six ASCII spaces, nothing else."""
    return (text or "").encode("utf-8", "replace").lower().split()


@dataclass
class Model:
    start: np.ndarray       # states
    move: np.ndarray        # states x states
    emit: np.ndarray        # classes and the end x states


def by_time(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequences, longest first, laid out by time: order, symbols, start of each time, rows active at each time."""
    lengths = np.array([len(s) for s in seqs])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
    begin = np.concatenate([[0], np.cumsum(active)[:-1]])
    flat = np.concatenate([seqs[i] for i in order])
    time = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.empty(len(flat), flat.dtype)
    out[begin[time] + np.repeat(np.arange(len(lengths)), lengths)] = flat
    return order, out, begin, active


def log_likelihood(seqs: list[np.ndarray], model: Model) -> np.ndarray:
    """Natural log of each sequence's probability, by the scaled forward recursion."""
    order, symbols, begin, active = by_time(seqs)
    total, alpha = np.zeros(len(seqs)), None
    for at, n in zip(begin.tolist(), active.tolist(), strict=True):
        seen = model.emit[symbols[at: at + n]]
        alpha = seen * (model.start if alpha is None else alpha[:n] @ model.move)
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[:n] += np.log(scale)
    out = np.empty(len(seqs))
    out[order] = total
    return out


def expected_counts(seqs: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of the states over these sequences, in the model's own precision."""
    _, symbols, begin, active = by_time(seqs)
    n_all, states = len(symbols), len(model.start)
    steps = list(zip(begin.tolist(), active.tolist(), strict=True))
    seen = model.emit.take(symbols, axis=0)
    alpha, scale = np.empty_like(seen), np.empty((n_all, 1), seen.dtype)
    last = None
    for at, n in steps:
        now = alpha[at: at + n]
        if last is None:
            np.multiply(seen[at: at + n], model.start, out=now)
        else:
            np.matmul(last[:n], model.move, out=now)
            now *= seen[at: at + n]
        now.sum(axis=1, keepdims=True, out=scale[at: at + n])
        now /= scale[at: at + n]
        last = now
    seen /= scale
    # seen becomes what the backward recursion sends back from each place: emission, scale and beta together
    gamma, back = alpha.copy(), np.ascontiguousarray(model.move.T)
    for t in range(len(steps) - 2, -1, -1):
        (at, _), (nxt, n) = steps[t], steps[t + 1]
        beta = seen[nxt: nxt + n] @ back
        gamma[at: at + n] *= beta
        seen[at: at + n] *= beta
    rest = np.arange(begin[1], n_all) if len(begin) > 1 else np.arange(0)
    before = rest - np.repeat(active[:-1], active[1:])
    moves = model.move * (alpha.take(before, axis=0).T @ seen[begin[1]:] if len(begin) > 1 else 0.0)
    weights = np.ascontiguousarray(gamma.T)
    emitted = np.stack([np.bincount(symbols, weights=w, minlength=len(model.emit)) for w in weights], axis=1)
    return gamma[: active[0]].sum(axis=0, dtype=np.float64), moves.astype(np.float64), emitted


def estimate(start: np.ndarray, moves: np.ndarray, emitted: np.ndarray) -> Model:
    share = emitted.sum(axis=1) + SMOOTH
    share = (share / share.sum())[:, None]
    return Model((start + 1e-2) / (start + 1e-2).sum(), (moves + 1e-2) / (moves + 1e-2).sum(axis=1, keepdims=True),
                 (emitted + PRIOR * share) / (emitted.sum(axis=0) + PRIOR))


def first_model(states: int, frequent: int = 0) -> Model:
    random = np.random.default_rng(13)
    emit = random.gamma(1.0, 1.0, (frequent + CLASSES + 1, states)) + 0.2
    stay = 0.9 * np.eye(states) + 0.1 / states
    return Model(np.full(states, 1 / states), stay, emit / emit.sum(axis=0))


def classes_of(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Classes of words by their hashes (unsigned); ``frequent``: the sorted hashes of words with classes of their own, which come
    behind the shared ones.  The end token's is the last."""
    out = (hashes % np.uint64(CLASSES)).astype(np.int32)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        out = np.where(frequent[at] == hashes, CLASSES + at, out).astype(np.int32)
    out[hashes == np.uint64(word_hash(END))] = CLASSES + len(frequent)
    return out


def expected(texts: DataFrame, model: Model, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions over ``texts`` (``text``): counts of each task, added up by Spark."""
    states, symbols = len(model.start), len(model.emit)
    names = [f"s{j}" for j in range(states)]
    model = Model(*[x.astype(np.float32) for x in (model.start, model.move, model.emit)])   # counts add up in double

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, moves, emitted = np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape)
        seqs, held = [], 0

        def add() -> None:
            nonlocal seqs, held
            if seqs:
                for total, more in zip((start, moves, emitted), expected_counts(seqs, model), strict=True):
                    total += more
            seqs, held = [], 0

        for batch in batches:
            words, texts = indexed(batch.column(0).to_pylist())
            k = classes_of(np.fromiter(map(word_hash, words), np.uint64, len(words)), frequent)
            for x in texts:
                ids = k[x]
                for i in range(0, len(ids), SEGMENT):
                    seqs.append(ids[i: i + SEGMENT])
                    held += len(seqs[-1])
                    if held >= STEP_TOKENS:
                        add()
        add()
        rows = np.concatenate([emitted, moves, start[None, :]])
        used = np.flatnonzero(rows.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(rows[used, j].astype(np.float32)) for j in range(states)]],
                                         ["k", *names])

    sums = (texts.mapInArrow(run, "k int, " + ", ".join(f"{c} float" for c in names)).groupBy("k")
            .agg(*[F.sum(c).alias(c) for c in names]).toPandas())
    rows = np.zeros((symbols + states + 1, states))
    rows[sums["k"].to_numpy()] = sums[names].to_numpy()
    return rows[-1], rows[symbols: -1], rows[: symbols]


def train(texts: DataFrame, frequent: np.ndarray, states: int = STATES) -> Model:
    """``texts``: the training documents' ``doc_id`` and ``text``."""
    model, running, t = first_model(states, len(frequent)), None, 0
    for epoch in range(EPOCHS):
        for part in range(PARTS):
            mine = F.pmod(F.xxhash64("doc_id", F.lit(f"hmm epoch {epoch}")), F.lit(PARTS)) == part
            counts = expected(texts.filter(mine).select("text"), model, frequent)
            if not counts[0].sum():
                continue                                   # a part without documents teaches nothing
            weight = (t + 1) ** -FORGET
            scaled = [c * PARTS for c in counts]
            running = scaled if running is None else [(1 - weight) * a + weight * b for a, b in zip(running, scaled, strict=True)]
            model, t = estimate(*running), t + 1
    counts = expected(texts.select("text"), model, frequent)
    return estimate(*counts) if counts[0].sum() else model


class _Index(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


def indexed(texts: list[str | None]) -> tuple[list[bytes], list[np.ndarray]]:
    """Distinct tokens, and each text's tokens as indexes into them; the last one is the end."""
    index = _Index()
    index[END]  # noqa: B018  is index 0
    out = []
    for body in texts:
        words = words_of(body)
        ids = np.zeros(len(words) + 1, np.int32)
        ids[:-1] = np.fromiter(map(index.__getitem__, words), np.int32, len(words))
        out.append(ids)
    return list(index), out


def train_counts(ids: list[np.ndarray], learn: np.ndarray, n: int) -> np.ndarray:
    learned = [x for x, yes in zip(ids, learn, strict=True) if yes]
    return np.bincount(np.concatenate(learned), minlength=n) if learned else np.zeros(n, np.int64)


def score(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = docs.sparkSession
    fold = F.crc32(F.col(doc_id).cast("string")) % 10
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.coalesce(fold != 0, F.lit(False)).alias("learn"))
    small_batches(spark)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    batches = max(math.ceil(chars / BATCH_CHARS), spark.sparkContext.defaultParallelism)
    # dealt by the row, not by what is in it, and written, so that every reader sees the same batches
    rows = scratch.write(rows.withColumn("batch", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches)).cast("int")), "rows")

    def count(part: pa.Table) -> pa.Table:
        words, ids = indexed(part.column("text").to_pylist())
        n = train_counts(ids, part.column("learn").to_numpy(), len(words))
        hashes = np.fromiter(map(word_hash, words), np.uint64, len(words)).view(np.int64)
        return pa.table({"batch": pa.array(np.full(len(words), part.column("batch")[0].as_py()), pa.int32()),
                         "word": pa.array(hashes), "n": pa.array(n, pa.int64())})

    counted = rows.select("batch", "text", "learn").groupBy("batch").applyInArrow(count, "batch int, word long, n long")
    same = Window.partitionBy("word")
    words = scratch.write(counted.select(
        "batch", "word", F.sum("n").over(same).alias("total"), F.count(F.lit(1)).over(same).alias("places"),
        (F.min("batch").over(same) == F.col("batch")).alias("first")), "words")

    # the frequent words; hashes are unsigned, and signed in the tables
    end_word = word_hash(END) - (1 << 64) * (word_hash(END) >> 63)
    top = words.filter((F.col("total") > 0) & F.col("first") & (F.col("word") != end_word)).orderBy(F.desc("total"), "word").limit(FREQUENT)
    frequent = np.sort(top.select("word").toPandas()["word"].to_numpy(np.int64).view(np.uint64))
    symbols = len(frequent) + CLASSES + 1
    model = train(rows.filter("learn").select("doc_id", "text"), frequent)

    # per class: training tokens, distinct words and words seen once
    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((symbols, 3))
        for batch in batches:
            k = classes_of(batch.column(0).to_numpy().view(np.uint64), frequent)
            total = batch.column(1).to_numpy()
            for i, x in enumerate((total, np.ones(len(k)), total == 1)):
                sums[:, i] += np.bincount(k, weights=x, minlength=symbols)
        used = np.flatnonzero(sums[:, 1])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(sums[used, i].astype(np.int64)) for i in range(3)]],
                                         ["k", "tokens", "distinct", "once"])

    facts = words.filter("first AND total > 0").select("word", "total").mapInArrow(
        by_class, "k int, tokens long, distinct long, once long").groupBy("k").agg(
        *[F.sum(c).alias(c) for c in ("tokens", "distinct", "once")]).toPandas()
    tokens, once = np.zeros(symbols), np.zeros(symbols)
    tokens[facts["k"].to_numpy()], once[facts["k"].to_numpy()] = facts["tokens"].to_numpy(), facts["once"].to_numpy()
    n_all, distinct = int(facts["tokens"].sum()), int(facts["distinct"].sum())
    unseen = np.where(tokens > 0, (once + 1) / (tokens + 2), 1.0)
    unseen[CLASSES:] = np.where(tokens[CLASSES:] > 0, 0.0, 1.0)     # a frequent word, and the end, is the only one of its class
    floor = math.log10(n_all + SMOOTH * (distinct + 1))

    def apply(key: tuple, part: pa.Table, totals: pa.Table) -> pa.Table:
        words, ids = indexed(part.column("text").to_pylist())
        count = train_counts(ids, part.column("learn").to_numpy(), len(words)).astype(np.float64)
        hashes = np.fromiter(map(word_hash, words), np.uint64, len(words))
        if len(totals):
            known = totals.column("word").to_numpy().view(np.uint64)
            order = known.argsort()
            known, total = known[order], totals.column("total").to_numpy()[order]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            count = np.where(known[at] == hashes, total[at], count)
        k = classes_of(hashes, frequent)
        base = np.log10(count + SMOOTH) - floor
        with np.errstate(divide="ignore"):
            inside = np.log10(np.where(count > 0, (1 - unseen[k]) * count / np.maximum(tokens[k], 1), unseen[k]))
        out = {c: [] for c in ("n_tokens", "n_known", "base_score", "inside")}
        for x in ids:
            out["n_tokens"].append(len(x))
            out["n_known"].append(int((count[x] > 0).sum()))
            out["base_score"].append(float(base[x].sum()))
            out["inside"].append(float(inside[x].sum()))
        hidden = np.zeros(len(ids))
        for i in range(0, len(ids), 2048):
            hidden[i: i + 2048] = log_likelihood([k[x] for x in ids[i: i + 2048]], model)
        return pa.table({
            "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
            "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
            "train_tokens": pa.array([n_all] * len(ids), pa.int64()), "base_score": pa.array(out["base_score"], pa.float64()),
            "score": pa.array(hidden / math.log(10) + np.array(out["inside"]), pa.float64())})

    shared = words.filter("places > 1").select("batch", "word", "total")
    result = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    empty = {f.name: pa.array([], f.type) for f in pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])}
    return rows.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(
        lambda key, part, totals: apply(key, part, totals) if len(part) else pa.table(empty), result)
