"""Column functions and the semantic traps of the reference (rounding, NULLs, CASE order)."""

import math

import pytest

from gridmart.functions import (
    clean_value, cuf, decade, flag_fossil, flag_like, line_color, map_technology, parse_bool,
    round_half_away, round_half_even, tech_group, utm_to_wgs84,
)


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_round_half_away_scales_before_rounding(spark):
    vals = _one(spark, round_half_away("x", 2), "x double", [(1.005,), (2.675,), (-1.005,), (0.125,)])
    # 1.005*100 is 100.49999999999999 (rounds down); 2.675*100 and 0.125*100 are exact
    # halves (round away from zero) -- the values an embedded SQL engine's ROUND gives
    assert vals == [1.0, 2.68, -1.0, 0.13]
    assert _one(spark, round_half_away("x", 0), "x double", [(2.5,), (-2.5,)]) == [3.0, -3.0]


def test_round_half_even(spark):
    assert _one(spark, round_half_even("x", 0), "x double", [(2.5,), (3.5,), (-2.5,)]) == [2.0, 4.0, -2.0]
    assert _one(spark, round_half_even("x", 2), "x double", [(0.125,), (None,)]) == [0.12, None]


def test_clean_value_three_valued_logic(spark):
    rows = [(-1.0, "TWh", "Hydro"), (-1.0, "TWh", " Net Imports "), (-2.0, "TWh", "Demand"),
            (-3.0, "TWh", None), (-4.0, " TWh", "Hydro"), (1.23456789, "TWh", "Hydro"), (-5.0, "GWh", "Hydro")]
    got = _one(spark, clean_value("value", "unit", "variable"),
               "value double, unit string, variable string", rows)
    assert got == [None, -1.0, -2.0, -3.0, -4.0, 1.234568, -5.0]


def test_flags(spark):
    rows = [("Renewables", "Hydro"), (None, "Gas"), (None, "hydro"), ("Fossil Fuels", None), (" gas", "GAS")]
    schema = "category string, subcategory string"
    assert _one(spark, flag_like("category", "renewable"), schema, rows) == [True, False, False, False, False]
    assert _one(spark, flag_fossil("category", "subcategory"), schema, rows) == [False, True, False, True, True]


def test_technology_rules_order(spark):
    rows = [("Geothermal energy",), ("Hydropower",), ("Onshore wind energy",), ("Offshore wind energy",),
            ("Solar photovoltaic",), ("Concentrated solar power",), ("Solar thermal energy",), ("Biogas",),
            ("Solid biomass",), ("Marine energy",), ("  Pumped storage ",), (None,)]
    tech = _one(spark, map_technology("t"), "t string", rows)
    group = _one(spark, tech_group("t"), "t string", rows)
    assert tech == ["Geothermal", "Hydro", "Wind", "Wind", "Solar PV", "Concentrated solar power",
                    "Solar Thermal", "Biogas", "Bioenergy", "Marine", "Pumped storage", None]
    assert group == ["Geothermal", "Hydro", "Wind", "Wind", "Solar", "Solar", "Solar", "Bioenergy",
                     "Bioenergy", "Other Renewables", "Other Renewables", "Other Renewables"]


def test_parse_bool(spark):
    rows = [("true",), ("1",), (" YES ",), ("false",), (None,), ("0",)]
    assert _one(spark, parse_bool("b"), "b string", rows) == [True, True, True, False, False, False]


def test_decade(spark):
    rows = [(1999,), (2000,), (2009,), (2010,), (2019,), (2020,), (2031,), (None,)]
    assert _one(spark, decade("y"), "y int", rows) == [None, "2000s", "2000s", "2010s", "2010s",
                                                       "2020s", "2020s", None]
    assert _one(spark, decade("y", 1990, 2000), "y int", [(1995,), (2001,)]) == ["1990s", "2000s"]


def test_cuf_rules(spark):
    rows = [(5.5, 863.0), (1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (None, 10.0), (1.0, None), (100.0, 1.0),
            (-1.0, 10.0)]
    got = _one(spark, cuf("g", "c"), "g double, c double", rows)
    assert got[0] == round(5.5e6 / (863 * 8760), 4)
    assert got[1:] == [1.0, None, 0.0, None, None, 1.0, 0.0]


def test_greatest_null_guard(spark):
    # greatest(NULL, 0) is 0 in SQL; the clamp must keep NULL
    assert _one(spark, cuf("g", "c"), "g double, c double", [(None, 5.0)]) == [None]


@pytest.mark.parametrize("lat,lng,e,n", [(-1.2921, 36.8219, 257634.5018, 9857079.9660),
                                         (-4.0435, 39.6682, 574171.7589, 9553033.8165)])
def test_utm_inverse_known_points(spark, lat, lng, e, n):
    lo, la = utm_to_wgs84("e", "n")
    r = spark.createDataFrame([(e, n)], "e double, n double").select(lo.alias("lng"), la.alias("lat")).first()
    assert math.isclose(r["lng"], lng, abs_tol=1e-6) and math.isclose(r["lat"], lat, abs_tol=1e-6)


def test_line_color(spark):
    rows = [("220kV Network",), ("132kV Network",), ("66kV Network",), ("33kV",), (None,)]
    assert _one(spark, line_color("r"), "r string", rows) == ["#c0392b", "#e74c3c", "#e67e22",
                                                              "#95a5a6", "#95a5a6"]


def test_grid_round_trip_to_the_sixth_order(spark):
    """Below 1e-9 degrees up to 6 degrees from the central meridian, both hemispheres."""
    from pyspark.sql import functions as F
    from gridmart.functions.geo import lnglat_to_prime, prime_to_lnglat, prime_to_utm, utm_prime, wgs84_to_utm
    rows = [(33.0 + i * 0.37, -84.0 + j * 2.1) for i in range(33) for j in range(81)]
    df = spark.createDataFrame(rows, "lng double, lat double").withColumn("south", F.col("lat") < 0)
    xi, eta = lnglat_to_prime("lng", "lat")
    df = df.withColumns({"xi": xi, "eta": eta})
    e, n = prime_to_utm(F.col("xi"), F.col("eta"), F.col("south"))
    df = df.withColumns({"e": e, "n": n})
    bx, be = utm_prime("e", "n", F.col("south"), order=6)
    df = df.withColumns({"bx": bx, "be": be})
    lng, lat = prime_to_lnglat(F.col("bx"), F.col("be"), order=6)
    worst = df.select(F.max(F.abs(lng - F.col("lng"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-9
    # a published place: the grid coordinates of the library's own examples
    e, n = wgs84_to_utm(F.lit(36.82192), F.lit(-1.29208))
    got = spark.range(1).select(e, n).first()
    back = spark.createDataFrame([(got[0], got[1])], "e double, n double")
    from gridmart.functions.geo import utm_to_wgs84
    lng, lat = utm_to_wgs84("e", "n")
    assert abs(back.select(lng).first()[0] - 36.82192) < 1e-9 and abs(back.select(lat).first()[0] + 1.29208) < 1e-9
