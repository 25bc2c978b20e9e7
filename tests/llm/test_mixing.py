import re
from collections import defaultdict

import numpy as np
import pytest

from gridmart.llm.mixing import flight, landing, mix
from tests.llm.conftest import edge_rows, frame, words


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Water filling: cap what is above twice its size, share the rest again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, out = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in out]
        if not free:
            return out
        level = (total - sum(out.values())) / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not above:
            return out | {s: weight[s] * level for s in free}
        out |= {s: 2.0 * sizes[s] for s in above}


def check(spark, scratch, rows, **more):
    got = mix(frame(spark, rows), scratch, carry=["doc_id", "source", "_gone"], **more).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += size_of(t)
    assert sorted([(r["row"].doc_id, r["size"]) for r in got], key=str) == sorted([(i, size_of(t)) for i, t, *_ in rows], key=str)
    want = brute_targets(dict(sizes))
    for r in got:
        assert r["source_size"] == sizes[r["row"].source] and r["row"]._gone == 4
        assert r["target"] == pytest.approx(want[r["row"].source])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["row"].source] += r["taken"]
    return got, want, taken, sizes


def test_edges(spark, scratch):
    got, *_ = check(spark, scratch, edge_rows())
    again = mix(frame(spark, edge_rows()), scratch, carry=["doc_id", "source", "_gone"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_totals_come_near_targets_over_many_groups(spark, scratch):
    rows = [(i, words(i, 1 + i % 97 + (400 if i % 500 == 0 else 0)), None, f"s{i % 5}" if i % 3 else "s0") for i in range(3000)]
    got, want, taken, sizes = check(spark, scratch, rows, group_rows=100)
    for s in want:
        assert abs(taken[s] - want[s]) <= 0.005 * want[s]
        docs = [r for r in got if r["row"].source == s]
        assert abs(sum(r["copies"] for r in docs) - len(docs) * want[s] / sizes[s]) <= 0.05 * len(docs) + 5


def test_flight_keeps_both_totals():
    r = np.random.default_rng(1)
    chance, size = r.random(300), r.integers(1, 500, 300).astype(float)
    out = flight(chance, size, 3)
    left = (out > 0) & (out < 1)
    assert left.sum() <= 2
    assert out.sum() == pytest.approx(chance.sum()) and out @ size == pytest.approx(chance @ size)
    assert set(landing(out, size)) <= {0.0, 1.0}
    equal = flight(np.full(50, 0.3), np.full(50, 7.0), 5)
    assert equal.sum() == pytest.approx(15.0)


def test_empty_table(spark, scratch):
    assert mix(frame(spark, []), scratch).count() == 0
    assert mix(frame(spark, [(1, None, None, None), (2, " ", None, "a")]), scratch).filter("taken = 0 AND target = 0").count() == 2


def test_files_and_order_do_not_matter(spark, scratch, tmpdir_path):
    """The same rows from one file, from five and in another order; some rows are repeated many times."""
    rows = [(i % 700, words(i % 700, 1 + i % 53), None, f"s{i % 4}") for i in range(1500)] + [(5, "same text here", None, "s1")] * 400 \
        + [(None, "no id", None, None)] * 30
    results = []
    for n, order in ((1, rows), (5, rows), (3, rows[::-1])):
        path = f"{tmpdir_path}/{n}"
        frame(spark, order).repartition(n).write.parquet(path)
        got = mix(spark.read.parquet(path), scratch, carry=["doc_id", "source"], group_rows=100).collect()
        results.append(sorted((str(r["row"]), r["size"], r["target"], r["copies"], r["taken"]) for r in got))
    assert results[0] == results[1] == results[2]
    assert len(set(results[0])) < len(results[0]) == len(rows)
