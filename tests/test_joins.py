"""Join operators: the keyword (theta) join."""

from pyspark.sql import functions as F

from gridmart.operators.joins import keyword_join


def test_keyword_join_residual_like(spark):
    cap = spark.createDataFrame([("E", 2020, "geo", 10.0), ("E", 2020, "sun", 5.0), ("E", 2021, "geo", 1.0)],
                                "entity string, year int, keyword string, mw double")
    gen = spark.createDataFrame([("E", 2020, "geothermal", 2.0), ("E", 2020, "hydro", 3.0),
                                 ("F", 2020, "geothermal", 9.0)],
                                "entity string, year int, label string, gen double")
    out = keyword_join(cap, gen, ["entity", "year"], F.col("r.label"), F.col("l.keyword"), "left")
    picked = out.select(F.col("l.keyword").alias("keyword"), F.col("l.year").alias("year"),
                        F.col("r.gen").alias("gen"))
    rows = sorted((r["keyword"], r["year"], r["gen"]) for r in picked.collect())
    assert rows == [("geo", 2020, 2.0), ("geo", 2021, None), ("sun", 2020, None)]
