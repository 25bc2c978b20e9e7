"""Marts refreshed from changed keys equal marts built whole, and only touched years are read and written."""

import os
import random

import pytest
from pyspark.sql import functions as F

from gridmart.plans import gold, incremental as inc, silver
from gridmart.plans.build import Builder, refresh_marts
from gridmart.sources import files, tables

SOURCES = (("Hydro", "Renewables"), ("Wind", "Renewables"), ("Solar", "Renewables"), ("Gas", "Fossil Fuels"), ("Imports", "Imports"))
EMBER = ("entity string, year int, category string, subcategory string, variable string, unit string, value_clean double, "
         "is_renewable boolean, is_fossil boolean, data_source string, _ingested_at timestamp_ntz")
CAP = ("entity string, year int, country string, technology_raw string, technology string, tech_group string, is_renewable boolean, "
       "capacity_mw double, _source string, _ingested_at timestamp_ntz")
CTX = "entity string, year int, country string, iso_code string, " + ", ".join(f"{c} double" for c, _, _ in silver.OWID_COLUMNS) + \
      ", _ingested_at timestamp_ntz"
YEARS = range(2001, 2013)


def state(seed):
    """Random staging rows: not every entity has every year.  Values are eighths, so that sums do not depend on their order."""
    r = random.Random(seed)
    ember, cap, ctx = {}, {}, {}
    for e in "ABCDE":
        for y in YEARS:
            if r.random() < 0.75:
                ember[e, y] = [(s, r.randrange(1, 72) / 8) for s, _ in SOURCES if r.random() < 0.8]
            if r.random() < 0.6:
                cap[e, y] = [(s, float(r.randrange(1, 900))) for s, _ in SOURCES[:3] if r.random() < 0.8]
            if r.random() < 0.7:
                ctx[e, y] = round(r.random() * 100, 2)
    return ember, cap, ctx


def edited(old, seed):
    """A later state: some keys new, altered or gone; and all keys that differ."""
    r, other = random.Random(seed), state(seed + 1000)
    new, changed = [], set()
    for before, fresh in zip(old, other, strict=True):
        after = dict(before)
        for key in [(e, y) for e in "ABCDE" for y in YEARS]:
            if r.random() < 0.06:
                after.pop(key, None)
                if key in fresh and r.random() < 0.7:
                    after[key] = fresh[key]
                changed.add(key)
        new.append(after)
    return tuple(new), sorted(changed)


def frames(spark, s):
    ember, cap, ctx = s
    e = [(k[0], k[1], "Electricity generation", "Fuel", v, "TWh", x, None, None, "d", None) for k, vs in ember.items() for v, x in vs]
    c = [(k[0], k[1], k[0], v, v, v, True, x, "s", None) for k, vs in cap.items() for v, x in vs]
    o = [(k[0], k[1], k[0], k[0], *[x] * len(silver.OWID_COLUMNS), None) for k, x in ctx.items()]
    return spark.createDataFrame(e, EMBER), spark.createDataFrame(c, CAP), spark.createDataFrame(o, CTX)


def categories(spark):
    return spark.createDataFrame([(s, c, "x", "#1") for s, c in SOURCES], "source_type string, category string, subcategory string, color_hex string")


def marts(ember, cap, ctx, cats):
    unified = silver.stg_energy_unified(ember, cap, ctx, cats)
    mix = gold.renewable_mix(unified)
    return {"staging/stg_energy_unified": unified, "mart/renewable_mix": mix, "mart/capacity_trend": gold.capacity_trend(cap, unified),
            "mart/energy_kpis": gold.energy_kpis(ctx, mix), "mart/generation_by_source": gold.generation_by_source(unified)}


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def store(b, staged, cats):
    for name, df in zip(("stg_ember_generation", "stg_irena_capacity", "stg_owid_energy"), staged, strict=True):
        b.save(f"staging/{name}", df)
    b.save("staging/stg_source_categories", cats)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_refresh_equals_a_full_build(spark, tmpdir_path, seed):
    old = state(seed)
    new, changed = edited(old, seed)
    cats, prefix = categories(spark), f"inc{seed}_"
    b = Builder(spark, tmpdir_path, prefix)
    store(b, frames(spark, old), cats)
    for name, df in marts(*frames(spark, old), cats).items():
        b.save(name, df)
    store(b, frames(spark, new), cats)
    keys = spark.createDataFrame(changed, "entity string, year int")
    found = inc.changed_keys(*[frames(spark, s)[0] for s in (old, new)]).collect()
    assert {(r["entity"], r["year"]) for r in found} <= set(changed)
    done = refresh_marts(spark, tmpdir_path, keys, catalog_prefix=prefix)
    assert done["staging/stg_energy_unified"] == sorted({y for _, y in changed})
    for name, df in marts(*frames(spark, new), cats).items():
        want = rows(df)
        assert rows(files.read_table(spark, b.path(name))) == want, name
        assert rows(spark.table(b.table(name))) == want, name


def test_nothing_changed(spark, tmpdir_path):
    b, cats = Builder(spark, tmpdir_path, "inc0_"), categories(spark)
    staged = frames(spark, state(9))
    store(b, staged, cats)
    for name, df in marts(*staged, cats).items():
        b.save(name, df)
    done = refresh_marts(spark, tmpdir_path, spark.createDataFrame([], "entity string, year int"), catalog_prefix="inc0_")
    assert set(map(tuple, done.values())) == {()}
    assert len(tables.pointer(spark, b.path("mart/renewable_mix")).segments) == 1


def test_a_lag_reaches_the_next_present_year(spark):
    present = spark.createDataFrame([("A", 2001), ("A", 2004), ("A", 2005), ("B", 2003)], "entity string, year int")
    changed = spark.createDataFrame([("A", 2002), ("B", 2003)], "entity string, year int")
    affected = inc.with_next(changed, present)
    assert rows(affected) == [("A", 2002), ("A", 2004), ("B", 2003)]
    assert rows(inc.with_previous(affected, present)) == [("A", 2001), ("A", 2002), ("A", 2004), ("B", 2003)]


def test_only_touched_years_are_read(spark, tmpdir_path):
    """Files of untouched years are made unreadable; the refresh does not notice."""
    cats = categories(spark)
    staged = frames(spark, state(5))
    full = marts(*staged, cats)
    u, m = os.path.join(tmpdir_path, "u"), os.path.join(tmpdir_path, "m")
    files.write_table(full["staging/stg_energy_unified"], u, ["year"])
    files.write_table(full["mart/renewable_mix"].withColumn("renewable_twh", F.when(F.col("year") == 2004, -1.0).otherwise(F.col("renewable_twh"))),
                      m, ["year"])
    want = rows(full["mart/renewable_mix"])
    present = set(inc.years_of(files.read_table(spark, u)))
    version = next(f for f in os.listdir(u) if f.startswith("v-"))
    for y in present - set(range(2001, 2009)):                   # 2004, the years before and the next present ones lie in this range
        folder = os.path.join(u, version, f"year={y}")
        for f in os.listdir(folder):
            if f.endswith(".parquet"):
                with open(os.path.join(folder, f), "wb") as out:
                    out.write(b"no parquet")
                crc = os.path.join(folder, f".{f}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
    with pytest.raises(Exception):
        files.read_table(spark, u).collect()
    keys = spark.createDataFrame([(e, 2004) for e in "ABCDE"], "entity string, year int")
    inc.refresh_mix(inc.Stored(spark, m), files.read_table(spark, u), keys)
    assert rows(files.read_table(spark, m)) == want


def test_bucketed_layers_meet_without_an_exchange(spark, tmpdir_path):
    """J1, J3 and the groupings of the unified table over stored, bucketed layers."""
    from gridmart.plans.build import co_partitioned
    b, cats = Builder(spark, tmpdir_path, "bkt_", buckets=4), categories(spark)
    staged = frames(spark, state(11))
    names = ("stg_ember_generation", "stg_irena_capacity", "stg_owid_energy")
    stored = [b.save(f"staging/{n}", df) for n, df in zip(names, staged, strict=True)]
    key, kept = "spark.sql.requireAllClusterKeysForCoPartition", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    co_partitioned(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unified = silver.stg_energy_unified(*stored, F.broadcast(cats))
        plan = unified._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 3 and plan.count("SortMergeJoin") == 2
        assert [x for x in plan.splitlines() if "Exchange" in x and "BroadcastExchange" not in x] == []
        assert rows(unified) == rows(silver.stg_energy_unified(*staged, cats))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.unset(key)
