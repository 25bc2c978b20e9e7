"""Words in texts through the n-gram index, and rule tables."""

import random

from pyspark.sql import functions as F

from gridmart.functions.rules import TECH_GROUP_DEFAULT, TECH_GROUP_RULES, TECHNOLOGY_RULES, map_technology, tech_group
from gridmart.operators.substrings import candidates, contained, first_rule, rules_frame
from gridmart.plans import gold


def word(r, n, letters="abcde"):
    return "".join(r.choice(letters) for _ in range(n))


def test_pairs_against_every_pair(spark):
    r = random.Random(1)
    texts = [(k, word(r, r.randrange(0, 12))) for k in (1, 2, 3) for _ in range(40)] + [(1, None), (None, "abc"), (2, "日本語の文章"), (2, "a%b_c")]
    words = [(k, word(r, r.randrange(0, 5))) for k in (1, 2, 4) for _ in range(25)] + [(1, ""), (2, None), (2, "本語"), (2, "%b_"), (3, "zzz")]
    t, w = spark.createDataFrame(texts, "k int, text string"), spark.createDataFrame(words, "k int, word string")
    got = sorted(tuple(x) for x in contained(t, w, ["k"]).collect())
    assert got == sorted({(k, x, y) for k, x in texts for j, y in words if k is not None and k == j and x is not None and y is not None and y in x})
    got = sorted(tuple(x) for x in contained(t.drop("k"), w.drop("k")).collect())
    assert got == sorted({(x, y) for _, x in texts for _, y in words if x is not None and y is not None and y in x})


def test_candidates_are_few(spark):
    """One key with 10,000 labels and 2,000 words: the index lets through little more than what matches."""
    r = random.Random(2)
    labels = sorted({word(r, 14, "abcdefghijklmnopqrstuvwxyz") for _ in range(10_000)})
    words = sorted({x[3:9] for x in r.sample(labels, 2000)})
    t = spark.createDataFrame([(1, x) for x in labels], "k int, text string")
    w = spark.createDataFrame([(1, x) for x in words], "k int, word string")
    found = candidates(t, w, ["k"]).cache()
    assert found.count() < 0.01 * len(labels) * len(words)
    assert found.filter(F.col("text").contains(F.col("word"))).count() >= len(words)


def test_keyword_cuf_by_index(spark):
    r = random.Random(3)
    cap = [("A", 2000 + i % 3, r.choice(["Onshore wind energy", "Hydropower", "Geothermal", "bio", "Pumped storage", None, ""]), float(i)) for i in range(60)]
    gen = [("A", 2000 + i % 4, r.choice(["Wind", "Offshore Wind", "Hydro", "hydro pumped storage", "Bioenergy", None]), i / 8) for i in range(90)]
    c = spark.createDataFrame(cap, "entity string, year int, technology_raw string, capacity_mw double")
    g = spark.createDataFrame(gen, "entity string, year int, variable string, value_clean double")
    rows = [sorted(map(str, gold.keyword_cuf(c, g, indexed=i).collect())) for i in (False, True)]
    assert rows[0] == rows[1] and len(rows[0]) > 10


LABELS = ["Onshore wind energy", "  Solar Photovoltaic ", "solar thermal", "Ocean energy", "Biogas", "biomass", "HYDRO pumped", "Geothermal wind", "", None,
          "Marine hydro", "Pumped storage"]


def test_tables_equal_the_chains(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LABELS * 2)], "i int, technology string")
    chain = df.select("i", map_technology("technology").alias("a"), tech_group("technology").alias("b"))
    table = first_rule(df, "technology", rules_frame(spark, TECHNOLOGY_RULES), "a", F.trim("technology"))
    table = first_rule(table, "technology", rules_frame(spark, TECH_GROUP_RULES), "b", F.lit(TECH_GROUP_DEFAULT)).select("i", "a", "b")
    assert sorted(map(tuple, chain.collect())) == sorted(map(tuple, table.collect()))


def test_ten_thousand_rules_give_the_first_match(spark):
    r = random.Random(4)
    rules = [(i, word(r, r.randrange(2, 7)), f"label {i}") for i in range(10_000)]
    texts = [word(r, r.randrange(0, 9), "abcdefgh").upper() for _ in range(300)]
    got = first_rule(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t",
                     spark.createDataFrame(rules, "priority int, needle string, label string"), "label", F.lit("none"))
    want = [(i, next((label for _, n, label in rules if n in t.lower()), "none")) for i, t in enumerate(texts)]
    assert sorted((x.i, x.label) for x in got.collect()) == want and len({x for _, x in want}) > 30
