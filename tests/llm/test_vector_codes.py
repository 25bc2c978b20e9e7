import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridmart.llm import vector_codes as vc
from gridmart.llm.queries import op12_of

SCHEMA = "vec_id long, embedding array<float>, label int, size int, v string, _key long"


def brute(rows, parts=16, entries=64, rounds=2):
    """All distances to all entries, in Python integers."""
    import math
    kept = []
    for i, e, label in rows:
        if e is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((i, [max(-vc.BOUND, min(vc.BOUND, math.floor(256 * float(np.float32(x))))) for x in e], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    if not kept or len(kept[0][1]) % parts:
        return [], None
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    d = len(kept[0][1]) // parts
    books = [[r[1][j * d: (j + 1) * d] for r in kept[:entries]] for j in range(parts)]

    def near(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(e, part)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for j in range(parts):
            groups = {}
            for r in kept:
                part = r[1][j * d: (j + 1) * d]
                groups.setdefault(near(books[j], part)[1], []).append(part)
            books[j] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[j])]
    out = []
    for i, v, label in kept:
        found = [near(books[j], v[j * d: (j + 1) * d]) for j in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(f for f, _ in found), label))
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, code, error, totals[label], sha) for i, code, error, label in out], books


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2])


def check(spark, scratch, rows):
    df = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in op12_of(df, scratch).collect()]
    assert sorted(got, key=key) == sorted(brute(rows)[0], key=key)


def test_codes_against_brute_force(spark, scratch):
    r = random.Random(3)
    rows = [(i * 3 - 50, [r.gauss(0, 0.3) for _ in range(32)], r.choice([None, 1, 2, 2, 2])) for i in range(300)]
    check(spark, scratch, rows)


def test_ties_and_equal_vectors(spark, scratch):
    """Few distinct values, so many entries are equal or equally near."""
    r = random.Random(4)
    rows = [(i, [r.choice([-1.0, 0.0, 1.0]) for _ in range(16)], 1) for i in range(200)]
    rows += [(1000 + i, [0.5] * 16, None) for i in range(50)]
    check(spark, scratch, rows)


def test_edges(spark, scratch):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [nan] * 32, 1), (4, [0.1] * 31 + [None], 2), (5, [inf] + [0.0] * 31, 2), (6, [0.1] * 32, None),
            (7, [0.2] * 32, None), (7, [0.2] * 32, 3), (7, [-0.2] * 32, 3), (None, [0.3] * 32, 3), (8, [0.1] * 16, 1),
            (9, [1e30] + [-1e30] * 31, 4), (10, [-0.0039] * 32, 4)]
    check(spark, scratch, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0] * 15, 1), (2, [1.0] * 32, 1)]])
def test_nothing_to_code(spark, scratch, rows):
    check(spark, scratch, rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=20),
       st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=20))
def test_search_is_exact(entries, parts):
    entries, parts = np.array(entries), np.array(parts)
    place, far = vc.EqualAverage(entries).search(parts)
    all_ = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert place.tolist() == all_.argmin(axis=1).tolist() and far.tolist() == all_.min(axis=1).tolist()


def test_search_leaves_entries_out(monkeypatch):
    """The bound on the sums spares most distances."""
    r = np.random.default_rng(5)
    x, seen = r.integers(-200, 200, (2000, 4)), []
    visit = vc.EqualAverage._visit
    monkeypatch.setattr(vc.EqualAverage, "_visit", lambda self, *a: seen.append(len(out := visit(self, *a))) or out)
    vc.EqualAverage(r.integers(-200, 200, (64, 4))).search(x)
    assert sum(seen) < 0.5 * 64 * len(x)


def test_decoding_gives_the_error(spark, scratch):
    r = random.Random(6)
    df = spark.createDataFrame([(i, [r.gauss(0, 0.3) for _ in range(32)], 1, 2, "x", 1) for i in range(150)], SCHEMA)
    codes, books = vc.compress(df, scratch)
    back = {row["vec_id"]: row for row in vc.decode(codes, books).collect()}
    for row in df.collect():
        ints = np.floor(256 * np.array(row["embedding"]))
        assert ((ints - np.array(back[row["vec_id"]]["v"])) ** 2).sum() == back[row["vec_id"]]["error"]
