"""Line dedup: what bands give, against all pairs."""

import random

import numpy as np
import pytest

from gridmart.llm import line_dedup
from gridmart.llm.line_dedup import line_groups
from tests.llm.conftest import frame
from tests.llm.test_line_shingles import brute, full_set, got_of, templates


def unlike_lines(count):
    """Lines of few syllables, which have shingles in common and are not similar."""
    r = random.Random(21)
    syllables = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(1, 4))) for _ in range(14)]
    return [" ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(r.randint(30, 60))) for _ in range(count)]


def test_few_pairs_of_unlike_lines_are_compared(spark, scratch, monkeypatch):
    """Chance meetings grow with the square of the input, so few may get as far as their texts."""
    compared, verified = [], line_dedup.verified

    def counted(pairs, texts):
        compared.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(line_dedup, "verified", counted)
    lines = unlike_lines(5000)
    twice = [x[:-3] + "###" for x in lines[:200]]
    rows = [(i, "\n".join(x), None, "s") for i, x in enumerate(zip(*[iter(lines)] * 4, strict=True))] + [(10 ** 6 + i, x, None, "s") for i, x in enumerate(twice)]
    got = got_of(line_groups(frame(spark, rows), scratch))
    assert [(a, b) for a, b in got if a != b] == [((10 ** 6 + i, 0), (i // 4, i % 4)) for i in range(200)]
    assert 200 <= sum(compared) < 400


def first_postings(bands):
    """Packed first postings of {band: [(key, 88 bits)]}, in blocks."""
    rows = [(b & 0xFFFF, b >> 16, k & 0xFFFFFFFF, k >> 32 & 0xFFFF, k >> 48, s & (1 << 64) - 1, s >> 64 & 0xFFFF, s >> 80)
            for b, members in bands.items() for k, s in members]
    random.Random(1).shuffle(rows)
    return [np.array(rows[i: i + 700], line_dedup._FIRST).tobytes() for i in range(0, len(rows), 700)]


def bands_of_all_kinds():
    r, bands = random.Random(22), {}
    for size in [1, 1, 1, 2, 2, 2, 3, 4, 7, 9, 40, 300, 1100]:
        for alike in (0.0, 0.2, 1.0):
            near = r.getrandbits(88)
            members = [(r.getrandbits(56), near ^ sum(1 << r.randrange(88) for _ in range(r.randint(0, 9))) & (1 << 88) - 1
                        if r.random() < alike else r.getrandbits(88)) for _ in range(size)]
            bands[r.getrandbits(24)] = members + members[:2]                 # a line may be posted by several batches
    return bands


def near(s, t):
    return bin(s ^ t).count("1") <= line_dedup.WIDE_DIFFER and bin((s ^ t) & (1 << 64) - 1).count("1") <= line_dedup.DIFFER


@pytest.mark.parametrize("area", [1 << 20, 1 << 12])
def test_near_pairs_against_all_pairs(monkeypatch, area):
    monkeypatch.setattr(line_dedup, "AREA", area)
    bands, per, whole = bands_of_all_kinds(), 4, 1000
    got = line_dedup.near_pairs(5, first_postings(bands), per, whole).to_pylist()
    pairs, dense = set(), {}
    for band, members in bands.items():
        members = sorted(set(members))
        found = {(a, b) for i, (a, s) in enumerate(members) for b, t in members[:i] if len(members) <= whole and near(s, t)}
        if len(members) > whole:
            dense[5 << 32 | band] = {k for k, _ in members}
        elif len(found) > per * len(members):
            dense[5 << 32 | band] = {k for p in found for k in p}
        else:
            pairs |= {(min(p), max(p)) for p in found}
    assert len(dense) > 4 and len(pairs) > 100
    assert {(min(x["k1"], x["hub"]), max(x["k1"], x["hub"])) for x in got if x["band"] is None} == pairs
    members = {}
    for x in got:
        if x["band"] is not None:
            members.setdefault(x["band"], {})[x["k1"]] = x
    assert {b: set(m) for b, m in members.items()} == dense
    sketches = {k: s for m in bands.values() for k, s in m}
    for m in members.values():                                   # all are compared with one hub
        hub, = {x["hub"] for x in m.values()}
        assert hub in m and all(x["near"] == (bin(sketches[k] ^ sketches[hub]).count("1") <= line_dedup.WIDE_DIFFER) for k, x in m.items())


def test_no_postings_give_no_pairs():
    assert line_dedup.near_pairs(0, [], 4, 100).num_rows == 0
    assert line_dedup.near_pairs(0, first_postings({9: [(1, 0)], 10: [(1, 0)]}), 4, 100).num_rows == 0


def test_a_bands_own_bits_are_not_in_its_sketch():
    bits = np.random.default_rng(3).integers(0, 16, (50, line_dedup.BANDS), dtype=np.uint64)
    first, more = line_dedup._wide_sketches(bits)
    for band in range(line_dedup.BANDS):
        turned = [bits[:, (band + 1 + k) % line_dedup.BANDS].tolist() for k in range(22)]
        wanted = [sum(turned[k][i] << 4 * k for k in range(22)) for i in range(50)]
        assert [int(a) | int(b) << 64 for a, b in zip(first[:, band], more[:, band], strict=True)] == wanted


def clusters():
    r, lines = random.Random(23), []
    for i in range(12):
        base = "".join(r.choice("abcdefghijklmnop ") for _ in range(120 + 10 * i)).strip()
        for _ in range(14):
            x = list(base)
            for at in r.sample(range(len(x)), r.randint(1, 11)):
                x[at] = r.choice("0123456789")
            lines.append("".join(x))
    return lines


@pytest.mark.parametrize("area", [1 << 20, 1 << 9])
def test_pairs_across_components_against_all_pairs(monkeypatch, area):
    monkeypatch.setattr(line_dedup, "AREA", area)
    lines = clusters()
    sets, group = [full_set(x) for x in lines], list(range(len(lines)))
    for a in range(len(lines)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                group = [group[a] if g == group[b] else g for g in group]
    sketch = np.zeros(len(lines), np.uint64)                     # all are near by sketch
    a, b = line_dedup.across(np.arange(len(lines)), np.arange(len(lines)), sketch, lines)
    assert len(a) == len(lines) - len(set(group)) > 20 and all(group[x] == group[y] for x, y in zip(a.tolist(), b.tolist(), strict=True))
    assert len(line_dedup.across(np.array(group), np.arange(len(lines)), sketch, lines)[0]) == 0


@pytest.mark.parametrize("most", [10 ** 6, 3000])
def test_open_bands_that_hold_too_much_text_are_given_back(spark, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "BAND_CHARACTERS", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    lines = clusters()
    try:
        rows = spark.createDataFrame([(b, k, k, 0, x) for b, n in ((1, 14), (2, 60), (3, 9)) for k, x in enumerate(lines[:n])],
                                     "band long, c long, node long, sketch long, norm string")
        got = line_dedup.open_links(rows).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    given = {b: sorted(x.a for x in got if x.band == b) for b in (1, 2, 3)}
    assert given == {1: [], 2: list(range(60)) if most == 3000 else [], 3: []}
    assert sum(x.band is None for x in got) > (0 if most == 3000 else 10)


@pytest.mark.parametrize("small, slot", [(2, 4_000_000), (20, 300), (10 ** 6, 4_000_000)])
def test_dense_bands(spark, scratch, monkeypatch, small, slot):
    """All bands dense: those of up to ``small`` members, pairs of larger ones and prefixes find what all pairs do; slots that stream too."""
    monkeypatch.setattr(line_dedup, "PAIRS", 0)
    monkeypatch.setattr(line_dedup, "SMALL_BAND", small)
    monkeypatch.setattr(line_dedup, "SLOT_POSTINGS", slot)
    rows = templates()
    got = got_of(line_groups(frame(spark, rows), scratch))
    assert got == brute(rows) and sum(a != b for a, b in got) >= 40
