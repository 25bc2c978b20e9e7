"""Entity-partitioned window operators: row-to-row LAG across year gaps, RANK ties, latest row."""

from pyspark.sql import functions as F

from gridmart.operators.windows import lag_of, latest_per, rank_desc


def test_lag_is_previous_present_year_per_entity(spark):
    df = spark.createDataFrame([("A", 2000, 1.0), ("A", 2005, 3.0), ("A", 2010, 6.0), ("B", 2005, 10.0)],
                               "entity string, year int, v double")
    got = {(r["entity"], r["year"]): r["d"] for r in
           df.select("entity", "year", (F.col("v") - lag_of("v")).alias("d")).collect()}
    assert got == {("A", 2000): None, ("A", 2005): 2.0, ("A", 2010): 3.0, ("B", 2005): None}


def test_rank_desc_and_latest(spark):
    df = spark.createDataFrame([("A", 2020, "x", 2.0), ("A", 2020, "y", 2.0), ("A", 2020, "z", 1.0),
                                ("A", 2021, "x", 5.0)], "entity string, year int, s string, g double")
    ranks = {(r["year"], r["s"]): r["rk"] for r in
             df.select("year", "s", rank_desc("g", ("entity", "year")).alias("rk")).collect()}
    assert ranks == {(2020, "x"): 1, (2020, "y"): 1, (2020, "z"): 3, (2021, "x"): 1}
    assert dict(df.select(rank_desc("g", ("entity", "year")).alias("rk")).dtypes)["rk"] == "bigint"
    last = latest_per(df.dropDuplicates(["entity", "year"]), ("entity",), "year").collect()
    assert [(r["entity"], r["year"]) for r in last] == [("A", 2021)]
