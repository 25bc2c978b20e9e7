import random

from gridmart.llm.line_dedup import dedup_lines, line_groups
from tests.llm.conftest import edge_rows, frame, words

SPACE = " \t\n\x0b\f\r"


def shingle_set(norm):
    """Five characters from each place; a shorter line is one."""
    return {norm[i: i + 5] for i in range(max(1, len(norm) - 4))}


def brute(rows):
    """(doc_id, line) -> place that stays, by all pairs."""
    lines = []
    for i, t, *_ in rows:
        for k, line in enumerate((t or "").split("\n")):
            lines.append(((-1 if i is None else i, k), line.strip(SPACE).lower()))
    texts = sorted({n for _, n in lines if n})
    sets, parent = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                parent[find(a)] = find(b)
    at, best = {t: find(i) for i, t in enumerate(texts)}, {}
    for place, n in lines:
        if n:
            best[at[n]] = min(best.get(at[n], place), place)
    return sorted((place, best[at[n]] if n else place) for place, n in lines)


def got_of(df):
    out = []
    for r in df.collect():
        here = (-1 if r.doc_id is None else r.doc_id, r.line_no)
        there = (-1 if r.keep_doc_id is None else r.keep_doc_id, r.keep_line_no)
        assert r.kept == (here == there)
        out.append((here, there))
    return sorted(out)


def corpus():
    r = random.Random(9)
    bases = [words(i, 12 + i % 30, 900) for i in range(25)]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(r.randint(0, 5)):
            w = r.choice(bases).split()
            if r.random() < 0.5:
                w[r.randrange(len(w))] = f"v{r.randrange(10 ** 6)}"
            lines.append(("  " if r.random() < 0.2 else "") + " ".join(w))
        lines.insert(0, "Menu | Home | Contact us today")
        if i % 4 == 0:
            lines.append("")
        rows.append((i, "\n".join(lines), None, "s"))
    return rows


def test_edges_against_brute_force(spark, scratch):
    rows = edge_rows() + [(50, "Same line here\nsame LINE here \n\n  \nother 日本語の文章です", None, "s"), (51, "日本語の文章です\n日本語の文章", None, "s")]
    assert got_of(line_groups(frame(spark, rows), scratch)) == brute(rows)


def test_fuzzy_lines_against_brute_force(spark, scratch):
    rows = corpus()
    got, want = got_of(line_groups(frame(spark, rows), scratch)), brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    # a pair at the threshold is missed with a chance of about 0.01; nothing unlike is joined
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.99 * len(want)
    lines = {(i, k): x for i, t, *_ in rows for k, x in enumerate(t.split("\n"))}
    assert len({lines[a].strip().lower() for a, b in got if a != b}) > 50


def test_texts_lose_only_lines_that_go(spark, scratch):
    rows = corpus()[:40]
    docs = frame(spark, rows)
    gone = {a for a, b in got_of(line_groups(docs, scratch)) if a != b}
    out = dedup_lines(docs, scratch)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t, *_ in rows}


def test_empty_table(spark, scratch):
    assert line_groups(frame(spark, []), scratch).count() == 0
    assert line_groups(frame(spark, [(1, None, None, None), (2, " \n ", None, None)]), scratch).filter("kept").count() == 3
