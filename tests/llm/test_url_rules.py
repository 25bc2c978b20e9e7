import itertools
import random
import re
import time

from pyspark.sql import functions as F

from gridmart.llm.url_rules import EXPLICIT, WHOLE, host_of, judge, mine, parts_of, path_of, tokens_of

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
URLS = [None, "", "no scheme/x", "http://", "http://A.Org", "https://x.org/", "HTTP://EXAMPLE.ORG/es/1?x#y", "http://a.example.org/en/12",
        "http://example.org/en/21", "http://notexample.org/es/3", "https://b.com/de/1", "https://com/fr/", "https://c.com/FR/1",
        "http://x.com?u=http://y.org/fr/", "http://x.net#f", "ftp://É.COM/de/", "http://u:p@h.com:80/fr/1", "x://y://z.org/q", "http://h.com/a\nb",
        "http://long.net/" + "s/" * 3000]


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(AZ), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(len(h) + len(p), h + p, v) for v, h, p in EXPLICIT if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_host_path_and_explicit_rules(spark, scratch):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)] + [(4, URLS[4], "clash")], "page_id long, url string, host string")
    got = judge(df, None, scratch).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = split(URLS[r["row"].page_id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, name, verdict or "allow")
        assert r["row"].host == "clash"
    assert judge(df.limit(0), None, scratch).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([("http://m.Ex.org/en/A1/25.html?page=2&ref=x&page=3#top",), (None,), ("x",)], "url string")
    got = [r[0] for r in df.select(tokens_of(F.col("url"))).collect()]
    assert got == [["f", "h0:org", "h1:ex", "h2:m", "p0:en", "p1:a#", "p2:#.html", "q:page", "q:ref"], [], []]
    assert df.select(host_of(F.col("url")), path_of(F.col("url"))).first()[1] == "/en/A1/25.html"


def labelled_urls():
    r = random.Random(3)
    rows = []
    for i in range(1200):
        host, lang = r.choice(["a.net", "b.net", "c.net", "bad.net", "mixed.net"]), r.choice(["en", "fr"])
        bad = host == "bad.net" or (host == "mixed.net" and lang == "fr" and r.random() < 0.9) or r.random() < 0.05
        rows.append((f"http://{host}/{lang}/{i}", bad))
    return rows


def test_mined_rules_against_brute_force(spark, scratch):
    rows = labelled_urls()
    df = spark.createDataFrame([*rows, (None, True), ("http://a.net", None)], "url string, bad boolean")
    rules = mine(df, scratch, min_support=0.01, min_confidence=0.6)
    got = {tuple(r.antecedent): round(r.confidence, 9) for r in rules.collect()}
    sets = [(set(r.t), r.bad) for r in df.filter("url IS NOT NULL AND bad IS NOT NULL").select(tokens_of(F.col("url")).alias("t"), "bad").collect()]
    names, n, want = sorted(set().union(*(s for s, _ in sets))), len(sets), {}
    for k in (1, 2, 3):
        for items in itertools.combinations(names, k):
            hits = [b for s, b in sets if s.issuperset(items)]
            if hits and sum(hits) >= max(10, 0.01 * n) and sum(hits) / len(hits) >= 0.6:
                want[items] = sum(hits) / len(hits)
    kept = {i: round(c, 9) for i, c in want.items() if not any(
        want.get(j, 0) >= c for k in range(1, len(i)) for j in itertools.combinations(i, k))}
    assert got == kept and ("h1:bad",) in got
    judged = judge(df.withColumn("page_id", F.monotonically_increasing_id()), rules, scratch, explicit_rules=()).collect()
    for r in judged:
        fits = [(c, a) for a, c in got.items() if r["row"].url and set(a) <= set(spark_tokens(r["row"].url))]
        assert r.verdict == ("block" if fits else "allow")
        assert not fits or round(r.confidence, 9) == max(fits)[0]


def spark_tokens(url):
    host, path = split(url)
    return [f"h{i}:{x}" for i, x in enumerate(host.split(".")[::-1])] + [
        f"p{i}:{re.sub('[0-9]+', '#', x)}" for i, x in enumerate([p for p in path.split("/") if p])]


def test_nothing_labelled(spark, scratch):
    assert mine(spark.createDataFrame([], "url string, bad boolean"), scratch) is None
    few = mine(spark.createDataFrame([("http://a.net/x", True)], "url string, bad boolean"), scratch)
    assert few.count() == 0


def test_a_bad_host_is_blocked_however_many_urls_are_labelled(spark, scratch):
    good = spark.range(30000).select(F.concat(F.lit("http://h"), F.col("id") % 3000, F.lit(".net/a/"), "id").alias("url"), F.lit(False).alias("bad"))
    wrong = spark.range(12).select(F.concat(F.lit("http://worst.net/a/"), "id").alias("url"), F.lit(True).alias("bad"))
    few = spark.range(9).select(F.concat(F.lit("http://fewer.net/b/"), "id").alias("url"), F.lit(True).alias("bad"))
    rules = mine(good.unionByName(wrong).unionByName(few), scratch)
    assert [(r.antecedent, r.confidence, r.support) for r in rules.collect()] == [(["h1:worst"], 1.0, 12 / 30021)]
    assert mine(good.limit(20), scratch).count() == 0


def rules_by_brute_force(sets, need=10, confidence=0.6):
    """(tokens, bad) pairs -> rules of up to three tokens; of tokens in the very same sets the smallest stands for all in combinations."""
    holders = {}
    for n, (s, _) in enumerate(sets):
        for t in s:
            holders.setdefault(t, []).append(n)
    stand = {min(ts) for ts in {tuple(h): [t for t in holders if holders[t] == h] for h in holders.values()}.values()}
    frequent = [t for t in holders if sum(sets[n][1] for n in holders[t]) >= need]
    want = {}
    for k in (1, 2, 3):
        for items in itertools.combinations(sorted(t for t in frequent if k == 1 or t in stand), k):
            both = set.intersection(*(set(holders[t]) for t in items))
            bad = sum(sets[n][1] for n in both)
            if bad >= need and bad / len(both) >= confidence:
                want[items] = bad / len(both)
    return {i: round(c, 9) for i, c in want.items() if not any(
        want.get(j, 0) >= c for k in range(1, len(i)) for j in itertools.combinations(i, k))}


def mined_and_wanted(spark, scratch, rows):
    df = spark.createDataFrame(rows, "url string, bad boolean")
    got = {tuple(r.antecedent): round(r.confidence, 9) for r in mine(df, scratch).collect()}
    sets = [(set(r.t), r.bad) for r in df.select(tokens_of(F.col("url")).alias("t"), "bad").collect()]
    return got, rules_by_brute_force(sets)


def test_a_repeated_url_of_many_keys(spark, scratch):
    """Twelve equal urls share 40 keys: 2**40 sets are frequent."""
    url = "http://track.net/a?" + "&".join(f"k{i}=1" for i in range(40))
    began = time.time()
    got, want = mined_and_wanted(spark, scratch, [(url, True)] * 12 + [(f"http://fine.net/{i}", False) for i in range(40)])
    assert got == want and len(got) == 42 and time.time() - began < 60


def test_random_subsets_of_many_keys(spark, scratch):
    r, rows = random.Random(5), []
    for i in range(260):
        bad = i < 60
        keys = [k for k in range(40) if r.random() < (0.8 if bad and k % 4 else 0.3)]
        rows.append((f"http://h{i % 7}.net/?" + "&".join(f"k{k:02d}=1" for k in keys), bad))
    got, want = mined_and_wanted(spark, scratch, rows)
    assert got == want and any(len(a) == 3 for a in got)


def test_parts_have_any_three_items_together(spark):
    for n in (0, 1, WHOLE, WHOLE + 1, 30):
        items = [f"t{i:02d}" for i in range(n)]
        df = spark.createDataFrame([(items,)], "items array<string>")
        parts = df.select(parts_of(F.col("items")).alias("p")).first()["p"]
        assert all(len(p) <= WHOLE for p in parts)
        held = {c for p in parts for c in itertools.combinations(p, 3)}
        assert held >= set(itertools.combinations(items, 3))
