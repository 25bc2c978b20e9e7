"""Serving queries (Q7-Q31) on small hand-made marts."""

from pyspark.sql import functions as F

from gridmart.plans import geo, serving

KPI_SCHEMA = ("entity string, year int, renewable_share_pct double, fossil_share_pct double, "
              "target_progress_ratio double, per_capita_elec_kwh double, carbon_intensity_gco2_kwh double, "
              "co2_from_elec_mtco2 double, access_to_electricity_pct double, total_generation_twh double, "
              "decade string")


def _kpis(spark):
    rows = [("KEN", 2020, 91.7, 8.3, 0.917, 155.0, 48.0, None, None, 9.6, "2020s"),
            ("KEN", 2021, 94.7, 5.3, 0.947, 160.0, None, None, None, 11.4, "2020s"),
            ("KEN", 2019, 90.0, 10.0, 0.9, 150.0, 50.0, None, None, 9.0, "2010s"),
            ("UGA", 2018, 80.0, 20.0, 0.8, 90.0, 30.0, None, None, 2.0, "2010s")]
    return spark.createDataFrame(rows, KPI_SCHEMA)


def test_latest_per_entity_with_previous_share(spark):
    got = {r["entity"]: r for r in serving.latest(_kpis(spark)).collect()}
    assert got["KEN"]["year"] == 2021 and got["KEN"]["prev_renewable_share_pct"] == 91.7
    assert got["UGA"]["year"] == 2018 and got["UGA"]["prev_renewable_share_pct"] is None


def test_target_progress_gap_unrounded(spark):
    r = {x["year"]: x for x in serving.target_progress(_kpis(spark)).collect() if x["entity"] == "KEN"}
    assert r[2021]["gap_pp"] == 100.0 - 94.7                   # not re-rounded
    assert serving.carbon(_kpis(spark)).count() == 3            # NULL intensity dropped


def test_decades_distinct_nulls_last(spark):
    k = _kpis(spark).unionByName(spark.createDataFrame(
        [("X", 1999, None, None, None, None, None, None, None, None, None)], KPI_SCHEMA))
    assert [r["decade"] for r in serving.decades(k).collect()] == ["2010s", "2020s", None]


def _gbs(spark):
    rows = [("KEN", 2020, "Geothermal", "Renewables", 5.5, 0.73, True),
            ("KEN", 2020, "Gas", "Fossil Fuels", 0.8, None, False),
            ("KEN", 2020, "Nuclear", "Nuclear", 0.2, None, False),
            ("KEN", 2021, "Geothermal", "Renewables", 5.7, None, True)]
    return spark.createDataFrame(rows, "entity string, year int, source_type string, category string, "
                                       "generation_twh double, capacity_utilisation_factor double, "
                                       "is_renewable boolean")


def test_renew_vs_fossil_counts_nuclear_as_fossil(spark):
    r = {x["year"]: x for x in serving.renew_vs_fossil(_gbs(spark)).collect()}
    assert r[2020]["renewable_twh"] == 5.5 and r[2020]["fossil_twh"] == 0.8 + 0.2
    assert r[2021]["fossil_twh"] == 0.0


def test_cuf_only_renewable_with_value(spark):
    rows = serving.cuf(_gbs(spark)).collect()
    assert [(r["year"], r["source_type"], r["cuf"]) for r in rows] == [(2020, "Geothermal", 0.73)]


def test_filtered_source_join_keys_once(spark):
    out = serving.filtered_source(_gbs(spark), _kpis(spark), "2020s")
    assert out.columns.count("year") == 1 and out.columns.count("entity") == 1
    assert out.count() == 4 and {r["decade"] for r in out.collect()} == {"2020s"}
    assert serving.filtered_source(_gbs(spark), _kpis(spark), "2010s").count() == 0


def test_geo_page_queries(spark):
    g = spark.createDataFrame(
        [("net", "220kV Network", "LineString", 5), ("net", "132kV Network", "LineString", 3),
         ("net", "Substations", "Point", 2), ("solar", "stations", None, 1)],
        "dataset string, resource_name string, geometry_type string, feature_count bigint")
    t = serving.geo_totals(g).first()
    assert (t["total_datasets"], t["total_layers"], t["total_features"]) == (2, 4, 11)
    assert [tuple(r) for r in serving.by_dataset(g).collect()] == [("net", 10), ("solar", 1)]
    assert {r["geometry_type"]: r["feature_count"] for r in serving.by_geom(g).collect()} == \
        {"LineString": 8, "Point": 2, None: 1}
    ordered = [(r["dataset"], r["feature_count"]) for r in serving.by_resource(g).collect()]
    assert ordered == [("net", 5), ("net", 3), ("net", 2), ("solar", 1)]


def test_substation_table_order_and_rounding(spark):
    s = spark.createDataFrame(
        [("B", "Nairobi", None, None, -1.292149, 36.821951), ("A", None, None, None, -4.04351, 39.66823),
         ("A", "Nairobi", None, None, None, None)],
        "station_name string, county string, owner string, manned string, lat double, lng double")
    rows = serving.substation_table(s).collect()
    assert [(r["county"], r["station_name"]) for r in rows] == [("Nairobi", "A"), ("Nairobi", "B"), (None, "A")]
    assert rows[1]["latitude"] == -1.2921 and rows[1]["longitude"] == 36.822
    view = geo.geo_map_substations_view(s.withColumn("feature_type", F.lit("Substation"))).collect()
    assert len(view) == 2 and {r["lat"] for r in view} == {-1.29215, -4.04351}
