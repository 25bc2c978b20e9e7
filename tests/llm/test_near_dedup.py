import re

import numpy as np

from gridmart.llm.near_dedup import K, MATCH, near_dedup, near_groups, shingles, signature
from tests.llm.conftest import edge_rows, frame, words

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc_id -> (smallest reachable id), and each row's set size."""
    nodes = [(i, shingle_set(t)) for i, t, *_ in rows]
    parent = {i: i for i, _ in nodes if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(nodes):
        for j, t in nodes[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted([(i, len(s), None if i is None else find(i)) for i, s in nodes], key=str)


def check(spark, scratch, rows):
    got = near_groups(frame(spark, rows), scratch).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_edges_against_brute_force(spark, scratch):
    check(spark, scratch, edge_rows())


def test_large_group_chains_and_shared_passage(spark, scratch):
    base = words(1, 100, 5000).split()
    rows = []
    for i in range(120):                                   # near copies of one text, each changed in one or two places
        w = list(base)
        w[i % 100] = f"n{i}"
        if i % 2:
            w[(i * 7) % 100] = f"m{i}"
        rows.append((i, " ".join(w), None, "s"))
    chain = words(2, 60, 5000).split()
    for i in range(12):                                    # each like the next only
        rows.append((1000 + i, " ".join(chain[4 * i:] + words(50 + i, 4 * i, 5000).split()), None, "s"))
    passage = words(3, 60, 5000)
    rows += [(2000 + i, passage + " " + words(100 + i, 60, 5000), None, "s") for i in range(60)]
    rows += [(3000 + i, words(200 + i, 5 + i % 4, 3), None, "s") for i in range(60)]   # short texts of few words
    check(spark, scratch, rows)


def test_rows_of_other_documents_stay(spark, scratch):
    rows = edge_rows()
    gone = {i for i, _, c in brute(rows) if i is not None and c != i}
    got = near_dedup(frame(spark, rows), scratch)
    assert got.columns == frame(spark, rows).columns
    assert sorted([r.doc_id for r in got.collect()], key=str) == sorted(
        [i for i, t, *_ in rows if i not in gone and not (i is None and t != "alone")], key=str)      # the row without an id is compared, too


def test_empty_tables(spark, scratch):
    assert near_groups(frame(spark, []), scratch).count() == 0
    assert near_groups(frame(spark, [(1, None, None, None), (2, "", None, None)]), scratch).filter("kept").count() == 2


def test_collisions_estimate_similarity():
    """At the threshold a pair has enough collisions, nearly always."""
    r = np.random.default_rng(1)
    low = 0
    for _ in range(300):
        both = r.integers(0, 1 << 63, 300, dtype=np.uint64)
        a = np.unique(np.concatenate([both, r.integers(0, 1 << 63, 50, dtype=np.uint64)]))
        b = np.unique(np.concatenate([both, r.integers(0, 1 << 63, 50, dtype=np.uint64)]))
        low += int((signature(a) == signature(b)).sum() < MATCH)
    assert low == 0 and K == 64
    assert len(shingles("a b c d e a b c d e")) == 5 and len(shingles("A  b")) == 1 and len(shingles(None)) == 0
