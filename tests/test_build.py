"""End-to-end build on landed files, checks-only rerun, and incremental landing."""

import json
import os

import pytest
from datetime import datetime

from gridmart.plans.bronze import ingest_long
from gridmart.plans.build import Inputs, build_all, run_checks_only
from gridmart.sources import files
from gridmart.streaming.landing import land_and_wait

RUN = datetime(2026, 1, 1, 6, 0)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    return path


LONG_HEADER = "Area,Country code,Year,Category,Subcategory,Variable,Unit,Value\n"


def _long_csv(d):
    rows = []
    for y, vals in {2020: (5.5, 3.2, 0.8), 2021: (5.7, 3.0, 0.6)}.items():
        for src, v in zip(("Geothermal", "Hydro", "Gas"), vals):
            rows.append(f"Kenya,KEN,{y},Electricity generation,Fuel,{src},TWh,{v}")
        rows.append(f"Kenya,KEN,{y},Demand,Demand,Demand,TWh,-1.0")
    rows.append("Uganda,UGA,2021,Electricity generation,Fuel,Hydro,TWh,1.0")
    return _write(os.path.join(d, "long.csv"), LONG_HEADER + "\n".join(rows) + "\n")


def test_build_all(spark, tmpdir_path):
    d = tmpdir_path
    long_csv = _long_csv(d)
    wide = _write(os.path.join(d, "wide.csv"),
                  "iso_code,country,year,per_capita_electricity,carbon_intensity_elec,empty_col\n"
                  "KEN,Kenya,2020,155.0,48.0,\nKEN,Kenya,2021,160.0,46.0,\nUGA,Uganda,2021,99.0,50.0,\n")
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name_ims11": "Juja"},
         "geometry": {"type": "Point", "coordinates": [257634.5018, 9857079.966]}},
        {"type": "Feature", "properties": {"voltage47": "220"},
         "geometry": {"type": "LineString", "coordinates": [[257634.5, 9857079.9], [574171.7, 9553033.8]]}}]}
    gj = _write(os.path.join(d, "net.geojson"), json.dumps(fc))
    st = _write(os.path.join(d, "stations.csv"), "station,elev\nNarok,1890\n")
    res = [{"dataset": "transmission_network", "name": "220kV Network", "id": "a", "format": "GeoJSON", "path": gj},
           {"dataset": "solar_radiation", "name": "stations", "id": "b", "format": "CSV", "path": st},
           {"dataset": "transmission_network", "name": "doc", "id": "c", "format": "PDF", "path": gj},
           {"dataset": "transmission_network", "name": "gone", "id": "d", "format": "JSON",
            "path": os.path.join(d, "missing.geojson")}]
    out = os.path.join(d, "warehouse")
    paths = build_all(spark, Inputs(long_csv, wide, None, res, entities=["KEN"]), out, RUN)
    mix = {r["year"]: r for r in files.read_table(spark, paths["mart/renewable_mix"]).collect()}
    assert set(mix) == {2020, 2021}
    assert mix[2020]["renewable_share_pct"] == round(8.7 / 9.5 * 100, 1)
    raw_wide = files.read_table(spark, paths["ingestion/raw_owid_energy"])
    assert "empty_col" not in raw_wide.columns
    trend = files.read_table(spark, paths["mart/capacity_trend"])
    assert trend.count() == 13                                   # curated fallback years
    kpis = files.read_table(spark, paths["mart/energy_kpis"]).collect()
    assert {r["decade"] for r in kpis} == {"2020s"}
    geo = {(r["dataset"], r["geometry_type"]): r["feature_count"]
           for r in files.read_table(spark, paths["mart/geo_infrastructure"]).collect()}
    assert geo == {("transmission_network", "Point"): 1, ("transmission_network", "LineString"): 1,
                   ("solar_radiation", None): 1}
    assert files.read_table(spark, paths["mart/geo_map_lines"]).count() == 1
    feats = spark.read.text(paths["export/infrastructure_geojson"]).count()
    assert feats == 2
    checks = {(r["table_name"], r["column_name"], r["check_name"]): r
              for r in files.read_table(spark, paths["checks/column_checks"]).collect()}
    assert checks[("mart/renewable_mix", "entity,year", "unique")]["passed"]
    # value_clean is declared not-null, but negative TWh becomes NULL: reported, not fatal
    assert checks[("staging/stg_ember_generation", "value_clean", "not_null")]["violations"] == 0
    again = run_checks_only(spark, out)
    assert again.count() == len(checks)


def test_land_incremental(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "landing")
    target = os.path.join(tmpdir_path, "bronze")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    schema = ("Area string, `Country code` string, Year string, Category string, Subcategory string, "
              "Variable string, Unit string, Value string")
    _write(os.path.join(src, "day1.csv"), LONG_HEADER + "Kenya,KEN,2020,Electricity generation,Fuel,Hydro,TWh,3.2\n"
           "Uganda,UGA,2020,Electricity generation,Fuel,Hydro,TWh,1.0\n")

    def bronze(df):
        return ingest_long(df, RUN, entities=["KEN"])

    land_and_wait(spark, src, schema, target, ckpt, transform=bronze)
    assert spark.read.parquet(target).count() == 1
    _write(os.path.join(src, "day2.csv"), LONG_HEADER + "Kenya,KEN,2021,Electricity generation,Fuel,Hydro,TWh,3.0\n"
           "Kenya,KEN,2021,Electricity generation,Fuel,Wind,TWh,\n")
    land_and_wait(spark, src, schema, target, ckpt, transform=bronze)
    rows = spark.read.parquet(target).collect()
    assert sorted((r["year"], r["variable"]) for r in rows) == [(2020, "Hydro"), (2021, "Hydro")]
    land_and_wait(spark, src, schema, target, ckpt, transform=bronze)     # nothing new: no duplicates
    assert spark.read.parquet(target).count() == 2


def test_cli_build_and_checks(spark, tmpdir_path):
    from gridmart.__main__ import main
    long_csv = _long_csv(tmpdir_path)
    wide = _write(os.path.join(tmpdir_path, "w.csv"), "iso_code,country,year,per_capita_electricity\nKEN,Kenya,2021,160\n")
    out = os.path.join(tmpdir_path, "wh")
    assert main(["build", "--long", long_csv, "--wide", wide, "--entities", "KEN", "--out", out]) == 0
    assert files.read_table(spark, os.path.join(out, "mart/renewable_mix")).count() == 2
    assert main(["checks", "--out", out]) == 0


def test_land_incremental_default_checkpoint(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "landing2")
    target = os.path.join(tmpdir_path, "bronze_default_ckpt")
    schema = ("Area string, `Country code` string, Year string, Category string, Subcategory string, "
              "Variable string, Unit string, Value string")
    _write(os.path.join(src, "a.csv"), LONG_HEADER + "Kenya,KEN,2020,Electricity generation,Fuel,Hydro,TWh,3.2\n")
    land_and_wait(spark, src, schema, target, transform=lambda df: ingest_long(df, RUN))
    assert spark.read.parquet(target).count() == 1
    assert os.path.isdir(os.path.join(target, "_checkpoint"))
    # the target's own checkpoint is found again: one new file, one new row
    _write(os.path.join(src, "b.csv"), LONG_HEADER + "Kenya,KEN,2021,Electricity generation,Fuel,Hydro,TWh,3.0\n")
    land_and_wait(spark, src, schema, target, transform=lambda df: ingest_long(df, RUN))
    assert spark.read.parquet(target).count() == 2
    with pytest.raises(ValueError, match="ends at -1"):
        land_and_wait(spark, src, schema, target, os.path.join(tmpdir_path, "fresh"), transform=lambda df: ingest_long(df, RUN))


def test_an_old_file_is_landed_too(spark, tmpdir_path):
    src, target = os.path.join(tmpdir_path, "landing3"), os.path.join(tmpdir_path, "bronze_old")
    schema = ("Area string, `Country code` string, Year string, Category string, Subcategory string, "
              "Variable string, Unit string, Value string")
    _write(os.path.join(src, "new.csv"), LONG_HEADER + "Kenya,KEN,2020,Electricity generation,Fuel,Hydro,TWh,3.2\n")
    land_and_wait(spark, src, schema, target, transform=lambda df: ingest_long(df, RUN))
    old = _write(os.path.join(src, "old.csv"), LONG_HEADER + "Kenya,KEN,2001,Electricity generation,Fuel,Hydro,TWh,1.0\n")
    os.utime(old, (1_500_000_000, 1_500_000_000))
    land_and_wait(spark, src, schema, target, transform=lambda df: ingest_long(df, RUN))
    assert sorted(r["year"] for r in spark.read.parquet(target).collect()) == [2001, 2020]


def test_capacity_of_an_unknown_country_stops_the_build(spark, tmpdir_path):
    wide = _write(os.path.join(tmpdir_path, "w4.csv"), "iso_code,country,year\nKEN,Kenya,2021\n")
    cap = _write(os.path.join(tmpdir_path, "c4.csv"), "Country,Technology,Year,Capacity MW\nAtlantis,Hydropower,2020,9\n")
    with pytest.raises(ValueError, match="Atlantis"):
        build_all(spark, Inputs(_long_csv(tmpdir_path), wide, cap), os.path.join(tmpdir_path, "wh4"), RUN)


def test_build_reads_parallel_features_and_skips_a_broken_layer(spark, tmpdir_path):
    import json as _json
    wide = _write(os.path.join(tmpdir_path, "w5.csv"), "iso_code,country,year\nKEN,Kenya,2021\n")
    feat = _json.dumps({"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [257634.5, 9857079.9]}})
    lines = _write(os.path.join(tmpdir_path, "p.ndjson"), feat + "\n" + feat + "\n" + feat[:-5] + "\n")
    cut = _write(os.path.join(tmpdir_path, "cut.geojson"), '{"type": "FeatureCollection", "features": [' + feat)
    res = [{"dataset": "stations", "name": "good", "id": "1", "format": "NDJSON", "path": lines},
           {"dataset": "stations", "name": "cut", "id": "2", "format": "GEOJSON", "path": cut},
           {"dataset": "stations", "name": "gone", "id": "3", "format": "GEOJSON", "path": os.path.join(tmpdir_path, "no")}]
    paths = build_all(spark, Inputs(_long_csv(tmpdir_path), wide, geo_resources=res), os.path.join(tmpdir_path, "wh5"), RUN)
    got = files.read_table(spark, paths["mart/geo_infrastructure"]).collect()
    assert [(r["resource_name"], r["feature_count"]) for r in got] == [("good", 2)]


def test_year_window_pushed_into_stored_bronze(spark, tmpdir_path):
    from gridmart.plans import silver
    out = os.path.join(tmpdir_path, "wh2")
    paths = build_all(spark, Inputs(_long_csv(tmpdir_path), _write(os.path.join(tmpdir_path, "w2.csv"),
                                    "iso_code,country,year\nKEN,Kenya,2021\n")), out, RUN)
    stored = files.read_table(spark, paths["ingestion/raw_ember_generation"])
    assert dict(stored.dtypes)["year"] == "int" and dict(stored.dtypes)["value"] == "double"
    import contextlib, io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        silver.stg_ember_generation(stored).explain("formatted")
    folders = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters")][0]
    assert "2000" in folders and "2030" in folders
    pruned = silver.stg_ember_generation(stored, (2021, 2021))
    assert {r["year"] for r in pruned.collect()} == {2021}
    # every asset is in the catalog by schema and name
    assert {"ingestion", "staging", "mart"} <= set(files.list_databases(spark))
    assert spark.table("mart.renewable_mix").count() == 3 and spark.catalog.tableExists("staging.stg_energy_unified")


def test_land_geojson_features_incrementally(spark, tmpdir_path):
    import json as _json
    from gridmart.operators.bronze import tag_resource
    src = os.path.join(tmpdir_path, "geo_landing")
    target = os.path.join(tmpdir_path, "geo_bronze")
    feat = {"type": "Feature", "properties": {"name_ims11": "Juja", "voltage47": 220},
            "geometry": {"type": "Point", "coordinates": [257634.5018, 9857079.966]}}
    _write(os.path.join(src, "f1.json"), _json.dumps(feat) + "\n" + _json.dumps({**feat, "geometry": None}) + "\n")

    def bronze(df):
        return tag_resource(files.features_to_rows(df), "transmission_stations", "stations", "r1")

    land_and_wait(spark, src, files.FEATURE_SCHEMA, target, transform=bronze, fmt="json")
    rows = spark.read.parquet(target).collect()
    assert {r["geometry_wkt"] for r in rows} == {"null", "[257634.5018, 9857079.966]"}
    assert {r["dataset"] for r in rows} == {"transmission_stations"}
    assert [r["properties"]["voltage47"] for r in rows if r["geometry_type"] == "Point"] == ["220"]


def test_each_layer_has_its_own_projection(spark, tmpdir_path):
    """One place as zone 37 south, as zone 36 south and as degrees."""
    import json as _json
    wide = _write(os.path.join(tmpdir_path, "w6.csv"), "iso_code,country,year\nKEN,Kenya,2021\n")

    def layer(name, xy):
        feat = {"type": "Feature", "properties": {"name_ims11": name}, "geometry": {"type": "Point", "coordinates": xy}}
        line = {"type": "Feature", "properties": {}, "geometry": {"type": "LineString", "coordinates": [xy, xy]}}
        return _write(os.path.join(tmpdir_path, f"{name}.ndjson"), _json.dumps(feat) + "\n" + _json.dumps(line) + "\n")

    res = [{"dataset": "d", "name": "66kV Network", "id": "a", "format": "NDJSON", "path": layer("z37", [257634.5018, 9857079.966])},
           {"dataset": "d", "name": "66kV Network", "id": "b", "format": "NDJSON", "path": layer("z37again", [257634.5018, 9857079.966]),
            "zone": 37},
           {"dataset": "d", "name": "132kV Network", "id": "c", "format": "NDJSON", "path": layer("north", [257634.5018, 142920.034]),
            "zone": 37, "south": False},
           {"dataset": "d", "name": "220kV Network", "id": "d", "format": "NDJSON", "path": layer("deg", [36.8219, -1.2921]), "zone": 0},
           {"dataset": "d", "name": "220kV Network", "id": "e", "format": "NDJSON", "path": layer("z36", [257634.5018, 9857079.966]),
            "zone": 36}]
    paths = build_all(spark, Inputs(_long_csv(tmpdir_path), wide, geo_resources=res), os.path.join(tmpdir_path, "wh6"), RUN)
    got = {r["station_name"]: (r["lng"], r["lat"]) for r in files.read_table(spark, paths["mart/geo_map_substations"]).collect()}
    assert got["z37"] == got["z37again"] and got["deg"] == (36.8219, -1.2921)
    assert got["z37"] == pytest.approx((36.8219, -1.2921), abs=1e-6)
    assert got["north"] == pytest.approx((36.8219, 1.2921), abs=1e-6)
    assert got["z36"] == pytest.approx((30.8219, -1.2921), abs=1e-6)
    lines = files.read_table(spark, paths["mart/geo_map_lines"]).collect()
    ends = sorted(tuple(json.loads(r["geojson_wgs84"])["coordinates"][0]) for r in lines)
    assert ends == sorted(got.values())
