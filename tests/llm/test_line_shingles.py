"""Line dedup against all pairs on every 5-character shingle; the definition here is its own, not the module's."""

import random

import numpy as np
import pytest

from gridmart.llm.line_dedup import BANDS, DIFFER, LONG, ROWS, dedup_lines, line_groups, meet, shingles, signed, similar
from tests.llm.conftest import frame

SPACE = " \t\n\x0b\f\r"


def full_set(norm):
    return {norm[i: i + 5] for i in range(max(1, len(norm) - 4))}


def brute(rows):
    """(doc_id, line) -> place that stays, by all pairs."""
    lines = [((i, k), x.strip(SPACE).lower()) for i, t, *_ in rows for k, x in enumerate(t.split("\n"))]
    texts = sorted({n for _, n in lines if n})
    sets, group = [full_set(t) for t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                group = [group[a] if g == group[b] else g for g in group]
    at, best = dict(zip(texts, group, strict=True)), {}
    for place, n in lines:
        if n:
            best[at[n]] = min(best.get(at[n], place), place)
    return sorted((place, best[at[n]] if n else place) for place, n in lines)


def got_of(df):
    return sorted(((r.doc_id, r.line_no), (r.keep_doc_id, r.keep_line_no)) for r in df.collect())


def sentence(r, length):
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(length))[: length * 5].strip()


def test_one_changed_letter_of_short_lines(spark, scratch):
    r, rows = random.Random(4), []
    for i in range(150):
        line = sentence(r, 6 + i % 14)
        at = r.randrange(len(line))
        rows += [(2 * i, line, None, "s"), (2 * i + 1, line[:at] + "#" + line[at + 1:], None, "s")]
    rows += [(1000, "abcd", None, "s"), (1001, "abce", None, "s"), (1002, "😀😁😂🤣😃😄😅😆😉😊😋😎😍😘🥰😗😙😚", None, "s"),
             (1003, "😀😁😂🤣😃😄😅😆😉😊😋😎😍😘🥰😗😙!", None, "s")]
    got, want = got_of(line_groups(frame(spark, rows), scratch)), brute(rows)
    assert sum(a != b for a, b in want) > 100
    assert got == want


def test_long_unbroken_lines_with_a_common_head(spark, scratch):
    r = random.Random(5)
    lines = ["20240101120000123456", "20240101120099887766", "iVBORw0KGgo" + "A" * 9 + "SUhEUgAAAB4", "iVBORw0KGgoxk92mPq0LrT7uYhZ", "ivborw0kggoQwErTyUiOp1234567890"]
    lines += ["ivborw0kggoa" + "".join(r.choice("abcdefghijklmnop0123456789") for _ in range(80)) for _ in range(20)]
    lines.append(lines[-1][:50] + "#" + lines[-1][51:])             # one letter changed: a duplicate
    rows = [(i, x, None, "s") for i, x in enumerate(lines)]
    got = got_of(line_groups(frame(spark, rows), scratch))
    assert got == brute(rows) and sum(a != b for a, b in got) == 1


def test_bands_find_pairs_at_the_threshold():
    assert (1 - 0.75 ** ROWS) ** BANDS < 1e-4


def test_accented_lines(spark, scratch):
    r, rows = random.Random(6), []
    for i in range(120):
        line = "".join(r.choice("éàüßçñöêabcde ") for _ in range(60)).strip()
        rows += [(2 * i, line, None, "s"), (2 * i + 1, line[:20] + "ø" + line[21:], None, "s")]
    got = got_of(line_groups(frame(spark, rows), scratch))
    assert got == brute(rows) and sum(a != b for a, b in got) > 100


def test_rows_without_id_are_rows_of_their_own(spark, scratch):
    a, b = "the quick brown fox jumps over the dog", "an entirely different line of words here"
    rows = [(None, a, None, "s"), (None, "\n".join(["alone one two three", "x1 y2 z3 something", b]), None, "s"), (None, "short\nonly in this row\nnothing like it", None, "s"),
            (1, a + "!", None, "s"), (2, "first\n" + b + "!", None, "s"), (-5, "\n\n" + b, None, "s")]
    out = sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in dedup_lines(frame(spark, rows), scratch).collect())
    assert out == sorted([(False, 0, rows[0][1]), (False, 0, rows[1][1]), (False, 0, rows[2][1]), (True, 1, ""), (True, 2, "first"),
                          (True, -5, "\n")])


def test_unlike_pairs_of_a_bucket_are_sifted_and_similar_ones_are_not():
    r, near, far, alike = random.Random(7), 0, 0, 0
    for i in range(300):
        line = "".join(r.choice("abcdefghijklmnop") for _ in range(10 + 2 * i))
        cut = len(line) - r.randrange(len(line) // 7 + 1)
        x, y, z = line, line[:cut], "".join(r.choice("abcdefghijklmnop") for _ in range(len(line)))
        found = [{int(w): (set(k[n].tolist()), int(s[n])) for w, (p, k, s) in enumerate(signed([t])) for n in range(len(p))} for t in (x, y, z)]
        a, b = full_set(x), full_set(y)
        like = 100 * len(a & b) >= 75 * len(a | b)
        assert like == bool(similar([x], [y])[0]) and not similar([x], [z])[0]
        alike += like
        shared = [s for k, s in found[0].values() for l, t in found[1].values() if k & l and bin(s ^ t).count("1") <= DIFFER]
        near += like and bool(shared)
        far += any(bin(s ^ t).count("1") <= DIFFER for _, s in found[0].values() for _, t in found[2].values())
    assert alike > 150 and near == alike and far < 100


def test_recall_of_the_bands_on_both_sides_of_the_limit():
    """Pairs near the threshold, with sets around the size where the way of signing changes."""
    r, lost, pairs = random.Random(8), 0, 0
    for _ in range(1500):
        n = r.randrange(30, 130)
        x = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)).strip() or "x"
        cut = r.randrange(n // 5 + 1)
        y = x[cut:] if r.random() < 0.5 else x + "".join(r.choice("abcdefgh") for _ in range(n // 4))
        a, b = full_set(x), full_set(y)
        if not y or 100 * len(a & b) < 75 * len(a | b):
            continue
        pairs += 1
        keys = [{int(k) for _, ks, _ in signed([t]) for k in ks.ravel()} for t in (x, y)]
        lost += not keys[0] & keys[1]
    assert pairs > 500 and lost <= 1


def test_lines_of_few_shingles_meet_whatever_their_length():
    lines = ["=" * 8, "=" * 5000, "-=" * 40, "-=" * 900]
    keys = [{int(k) for _, ks, _ in signed([t]) for k in ks.ravel()} for t in lines]
    assert keys[0] & keys[1] and keys[2] & keys[3] and not keys[0] & keys[2]


def test_shingles_do_not_reach_into_the_next_line():
    alone = [shingles([x])[0].tolist() for x in ("abcd", "abcdefg", "x", "ab")]
    h, sizes = shingles(["abcd", "abcdefg", "x", "ab"])
    assert h.tolist() == [y for x in alone for y in x] and sizes.tolist() == [1, 3, 1, 1]
    assert LONG == 64


def blocks_of(rows, per):
    dtype = np.dtype([("band", "<u4"), ("low", "<u4"), ("middle", "<u2"), ("high", "u1"), ("sketch", "<u8")])
    return [np.array([(b, k, 0, 0, s) for b, k, s in rows[i: i + per]], dtype).tobytes() for i in range(0, len(rows), per)]


def test_a_slot_that_streams_gives_the_same_members():
    r = random.Random(9)
    rows = [(r.randrange(400), r.randrange(10 ** 6), r.getrandbits(64)) for _ in range(1500)] + [(7, k, 0) for k in range(500)]
    rows += rows[:100]
    whole = [x for b in meet(3, iter([blocks_of(rows, 10 ** 6)])) for x in b.to_pylist()]
    parts = [x for b in meet(3, iter([[b] for b in blocks_of(rows, 150)])) for x in b.to_pylist()]
    wanted = {}
    for b, k, _ in rows:
        wanted.setdefault(b, set()).add(k)

    def by_band(found, least):
        out = {}
        for x in found:
            out.setdefault(x["band"] & (1 << 32) - 1, set()).add(x["k1"])
        return {b: k for b, k in out.items() if len(k) >= least}

    assert by_band(whole, 3) == by_band(parts, 3) == {b: k for b, k in wanted.items() if len(k) >= 3}
    for found in (whole, parts):                                 # every member is compared with one hub of its band
        assert all(len({x["hub"] for x in found if x["band"] & (1 << 32) - 1 == b}) <= 1 for b in range(400))


def templates():
    """Lines of one template, of which some are near copies of others."""
    r, rows = random.Random(10), []
    for i in range(120):
        tail = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(34))
        rows += [(i, "one template that many lines share, and behind it " + tail, None, "s")]
        if i % 3 == 0:
            rows += [(1000 + i, "one template that many lines share, and behind it " + tail[:-2] + "##", None, "s")]
    return rows


@pytest.mark.parametrize("small", [2, 20, 10 ** 6])
def test_large_bands(spark, scratch, monkeypatch, small):
    """Pairs of bands, and prefixes of rare shingles where those are large, find what all pairs of a band do."""
    from gridmart.llm import line_dedup
    monkeypatch.setattr(line_dedup, "SMALL_BAND", small)
    rows = templates()
    got = got_of(line_groups(frame(spark, rows), scratch))
    assert got == brute(rows) and sum(a != b for a, b in got) >= 40


def test_a_pair_of_large_bands_is_posted_once(spark):
    from gridmart.llm.line_dedup import _POSTING, _band, refined
    lines = {1: "a line of which all bands are large ones, and long enough to be signed in one way only " * 4, 2: "a line with one large band"}
    bands = {k: _band(np.concatenate([b.ravel() for _, b, _ in signed([x])]), 8).tolist() for k, x in lines.items()}
    texts = spark.createDataFrame(list(lines.items()), "k1 long, norm string")
    large = spark.createDataFrame([(b, 1) for b in bands[1]] + [(bands[2][0], 2)], "band long, node long")
    rows = np.frombuffer(b"".join(r.block for r in refined(texts, large, 8).collect()), _POSTING)
    assert (rows["low"] == 1).sum() == len(np.unique(rows["band"][rows["low"] == 1])) == len(bands[1]) // BANDS * BANDS * (BANDS - 1) // 2
    assert (rows["low"] == 2).sum() == BANDS - 1


def test_tables_that_were_read_are_deleted(spark, scratch):
    import os
    from urllib.parse import urlparse

    from gridmart.llm.graph import components
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100 - i, 100 + i) for i in range(1, 20)], "a long, b long")
    assert components(chain, scratch).select("component").distinct().count() == 20

    def tables():
        root = urlparse(scratch.root).path
        return [t for t in os.listdir(root) if os.path.isdir(f"{root}/{t}")]

    assert len(tables()) == 1                                    # the labels
    before = len(tables())
    line_groups(frame(spark, templates()), scratch).count()
    assert len(tables()) - before <= 8


def test_members_near_no_other_one_go_and_no_pair_with_them():
    from gridmart.llm import line_dedup
    r, rows = random.Random(11), []
    for band, size in enumerate([2, 3, 3, 5, 30, 33, 200, line_dedup.SIFTED + 1] * 3):
        near = r.getrandbits(64)
        rows += [(band, band * 1000 + k, near ^ (1 << r.randrange(64)) if r.random() < 0.1 else r.getrandbits(64)) for k in range(size)]
    given = next(meet(3, iter([blocks_of(rows, 10 ** 6)])))
    got = line_dedup.sifted(given)

    def pairs(batch):
        by_band = {}
        for x in batch.to_pylist():
            by_band.setdefault(x["band"], []).append((x["k1"], x["sketch"] & (1 << 64) - 1))
        return {(a, b) for m in by_band.values() for a, s in m for b, t in m if a < b and bin(s ^ t).count("1") <= DIFFER}

    assert pairs(got) == pairs(given) and got.num_rows < given.num_rows
    size = {}
    for x in given.to_pylist():
        size.setdefault(x["band"], []).append(x["k1"])
    in_pairs = {k for p in pairs(given) for k in p}
    assert {x["k1"] for x in got.to_pylist()} == {k for m in size.values() for k in m if len(m) in (1, line_dedup.SIFTED + 1) or k in in_pairs}


def test_lines_are_posted_again_under_pairs_of_large_bands_only(spark):
    from gridmart.llm.line_dedup import _POSTING, _band, refined
    lines = {1: "a line of which three bands are large ones, and long enough to be signed in one way only " * 4, 2: "a line with one large band"}
    bands = {k: _band(np.concatenate([b.ravel() for _, b, _ in signed([x])]), 8).tolist() for k, x in lines.items()}
    texts = spark.createDataFrame(list(lines.items()), "k1 long, norm string")
    large = spark.createDataFrame([(b, 1) for b in bands[1][:3]] + [(bands[2][0], 2)], "band long, node long")
    rows = np.frombuffer(b"".join(r.block for r in refined(texts, large, 8, inner=True).collect()), _POSTING)
    assert rows["low"].tolist() == [1, 1, 1]
