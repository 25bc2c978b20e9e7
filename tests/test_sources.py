"""Readers, bronze operators and sinks on temporary landed files."""

import json
import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gridmart.operators.bronze import (
    concat_by_name, drop_all_null_columns, filter_entity, filter_entity_ci, normalize_headers,
    normalize_name, resolve_column, select_existing, uncastable,
)
from gridmart.plans import geo, silver
from gridmart.plans.bronze import country_codes, ingest_capacity, ingest_geo, ingest_long, ingest_wide
from gridmart.sources import files
from gridmart.sources.fallback import FALLBACK_CAPACITY

RUN = datetime(2026, 1, 1, 6, 0)


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_normalize_names():
    assert normalize_name("ISO 3 code") == "iso_3_code"
    assert normalize_name("Value (x)") == "value_x"
    assert normalize_name("Country-Code") == "countrycode"
    assert normalize_name("Capacity MW", strip=False) == "capacity_mw"


def test_long_csv_ingest(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "long.csv"),
               "Area,ISO 3 code,Year,Category,Subcategory,Variable,Unit,Value,Extra col\n"
               "Kenya,KEN,2020,Electricity generation,Fuel,Hydro,TWh,3.2,x\n"
               "Kenya,KEN,2021,Electricity generation,Fuel,Hydro,TWh,,x\n"
               "Uganda,UGA,2020,Electricity generation,Fuel,Hydro,TWh,1.0,x\n")
    raw = ingest_long(files.read_long_csv(spark, p), RUN, entities=["KEN"])
    assert raw.columns == ["country_code", "area", "year", "category", "subcategory", "variable", "unit",
                           "value", "_ingested_at", "_source"]
    rows = raw.collect()
    assert len(rows) == 1 and rows[0]["country_code"] == "KEN" and rows[0]["_source"] == "ember_yearly_csv"
    stg = silver.stg_ember_generation(raw).first()
    assert stg["year"] == 2020 and stg["value_clean"] == 3.2


def test_resolve_column_missing_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        resolve_column(df, ["iso_3_code", "country_code"], "country_code")


def test_wide_csv_drops_all_null_columns_and_silver_fills(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "wide.csv"),
               "iso_code,country,year,per_capita_electricity,access_to_electricity,carbon_intensity_elec\n"
               "KEN,Kenya,2020,155.123,,48.00004\n"
               "KEN,Kenya,2021,160.0,,\n"
               "UGA,Uganda,2021,99.0,50.0,1.0\n")
    raw = ingest_wide(files.read_wide_csv(spark, p), RUN, entities=["KEN"])
    raw = drop_all_null_columns(raw, keep=("iso_code", "year"))
    assert "access_to_electricity" not in raw.columns          # all NULL for KEN
    stg = silver.stg_owid_energy(raw)
    rows = {r["year"]: r for r in stg.collect()}
    assert rows[2020]["per_capita_elec_kwh"] == 155.12
    assert rows[2020]["carbon_intensity_gco2_kwh"] == 48.0
    assert rows[2021]["nuclear_elec_twh"] is None               # column never landed
    assert dict(stg.dtypes)["nuclear_elec_twh"] == "double"


def test_capacity_fallback_and_file(spark, tmpdir_path):
    df, tag = files.read_capacity(spark, None)
    assert tag == "irena_curated_fallback" and df.count() == len(FALLBACK_CAPACITY) == 53
    bad = _write(os.path.join(tmpdir_path, "bad.csv"), "Country,Value\nKenya,1\n")
    df, tag = files.read_capacity(spark, bad)
    assert tag == "irena_curated_fallback"
    good = _write(os.path.join(tmpdir_path, "cap.csv"),
                  "Country,Country code,Technology,Year,Capacity MW\n"
                  "Kenya,KEN,Marine energy,2022,1.5\nKENYA,KEN,Biogas,2022,2\nUganda,UGA,Hydropower,2022,9\n")
    df, tag = files.read_capacity(spark, good)
    assert tag == "irena_api"
    raw = ingest_capacity(df, tag, RUN, country_names=["Kenya"])
    stg = {r["technology_raw"]: r for r in silver.stg_irena_capacity(raw).collect()}
    assert set(stg) == {"Marine energy", "Biogas"}
    assert stg["Marine energy"]["tech_group"] == "Other Renewables"
    assert stg["Biogas"]["tech_group"] == "Bioenergy" and stg["Biogas"]["technology"] == "Biogas"


def test_filters(spark):
    df = spark.createDataFrame([("KEN", "Kenya"), ("UGA", "uganda"), (None, None)], "c string, n string")
    assert filter_entity(df, "c", None).count() == 3
    assert [r["c"] for r in filter_entity(df, "c", ["KEN"]).collect()] == ["KEN"]
    keys = spark.createDataFrame([("UGA",), ("UGA",)], "k string")
    assert [r["c"] for r in filter_entity(df, "c", keys).collect()] == ["UGA"]
    assert [r["c"] for r in filter_entity_ci(df, "n", ["UGANDA"]).collect()] == ["UGA"]
    assert select_existing(df, ["x", "n", "c"]).columns == ["n", "c"]


def test_drop_all_null_columns_keeps_partially_filled(spark):
    df = spark.createDataFrame([(1, None, None), (2, 3, None)], "a int, b int, c string")
    assert drop_all_null_columns(df).columns == ["a", "b"]


def _feature_collection():
    return {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name_ims11": "Juja", "county2": "Kiambu", "voltage47": 220},
         "geometry": {"type": "Point", "coordinates": [257634.5018, 9857079.966]}},
        {"type": "Feature", "properties": {"voltage47": "132"},
         "geometry": {"type": "LineString", "coordinates": [[257634.5018, 9857079.966],
                                                             [574171.7589, 9553033.8165]]}},
        {"type": "Feature", "properties": None,
         "geometry": {"type": "LineString", "coordinates": [[257634.5018, 9857079.966]]}},
        {"type": "Feature", "properties": {"a": "b"}, "geometry": None},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiLineString",
                                                           "coordinates": [[[1, 2], [3, 4]]]}},
    ]}


def test_geojson_to_marts(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "net.geojson"), json.dumps(_feature_collection()))
    feats = files.read_geojson(spark, p)
    lines_frame = feats.withColumns({"dataset": F.lit("transmission_network"),
                                     "resource_name": F.lit("132kV Network"), "resource_id": F.lit("r1")})
    st = _write(os.path.join(tmpdir_path, "st.csv"), "station,elev\nNarok,1890\n")
    stations = files.read_station_csv(spark, st).withColumns(
        {"dataset": F.lit("solar_radiation"), "resource_name": F.lit("stations")})
    raw = ingest_geo([lines_frame, stations], RUN, spark=spark)
    assert raw.count() == 6
    wkts = {r["geometry_type"]: r["geometry_wkt"] for r in raw.collect() if r["dataset"] == "transmission_network"}
    assert wkts[None] == "null"
    props = [r["properties"] for r in raw.collect() if r["geometry_type"] == "Point"][0]
    assert props["voltage47"] == "220" and props["name_ims11"] == "Juja"      # numbers kept as text
    counts = {(r["dataset"], r["geometry_type"]): r["feature_count"]
              for r in geo.geo_infrastructure(raw).collect()}
    assert counts[("transmission_network", "LineString")] == 2
    assert counts[("solar_radiation", None)] == 1
    sub = geo.geo_map_substations(raw).collect()
    assert len(sub) == 1 and sub[0]["station_name"] == "Juja" and sub[0]["feature_type"] == "Substation"
    assert sub[0]["lat"] == pytest.approx(-1.2921, abs=1e-6) and sub[0]["lng"] == pytest.approx(36.8219, abs=1e-6)
    lines = geo.geo_map_lines(raw).collect()
    assert len(lines) == 1                                       # the 1-vertex line is dropped
    assert json.loads(lines[0]["geojson_wgs84"])["coordinates"][0][0] == pytest.approx(36.8219, abs=1e-6)
    g = json.loads(geo.geo_map_lines(raw, digits=6).first()["geojson_wgs84"])
    assert g["type"] == "LineString"
    assert g["coordinates"] == [[36.8219, -1.2921], [39.6682, -4.0435]]
    assert lines[0]["line_color"] == "#e74c3c" and lines[0]["voltage_kv"] == "132"
    out = os.path.join(tmpdir_path, "features")
    files.write_geojson(geo.geo_features(geo.geo_map_lines(raw), geo.geo_map_substations(raw)), out)
    written = [json.loads(line) for f in os.listdir(out) if f.startswith("part-")
               for line in open(os.path.join(out, f))]
    assert sorted(f["properties"]["layer"] for f in written) == ["substation", "transmission_line"]
    point = [f for f in written if f["properties"]["layer"] == "substation"][0]
    assert point["properties"]["owner"] == "" and point["geometry"]["type"] == "Point"


def test_line_delimited_geojson(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "f.jsonl"),
               "\n".join(json.dumps(f) for f in _feature_collection()["features"]))
    assert files.read_geojson(spark, p, line_delimited=True).count() == 5


def test_select_resources():
    res = [{"format": "GeoJSON", "path": "a"}, {"format": "csv", "path": "b"}, {"format": "PDF", "path": "c"},
           {"format": "JSON", "path": ""}]
    assert [r["path"] for _, r in files.select_resources(res, "transmission_network")] == ["a"]
    assert [k for k, _ in files.select_resources(res, "solar_radiation")] == ["geojson", "csv"]


def test_concat_by_name_and_empty(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    out = concat_by_name([a, b])
    assert out.columns == ["a", "b", "c"] and out.count() == 2
    empty = concat_by_name([], empty_schema=files.GEO_COLUMNS, spark=spark)
    assert empty.count() == 0 and "geometry_wkt" in empty.columns


def test_table_round_trip_and_seed(spark, tmpdir_path):
    seed = files.read_seed(spark)
    assert seed.count() == 12
    cats = silver.stg_source_categories(seed)
    path = os.path.join(tmpdir_path, "cats")
    files.write_table(cats, path)
    back = files.read_table(spark, path)
    assert back.count() == 12
    assert {r["source_type"] for r in back.filter("is_renewable").collect()} >= {"Geothermal", "Wind"}
    assert "default" in files.list_databases(spark)


def test_normalize_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`Country Code` int, `Value (x)` int")
    assert normalize_headers(df).columns == ["country_code", "value_x"]


def test_located_only_equals_lat_lng_filter(spark):
    rows = [({"name_ims11": "a"}, "Point", "[257634.5018, 9857079.966]"),
            ({"name_ims11": "b"}, "Point", '["x", 9857079.966]'),
            ({"name_ims11": "c"}, "Point", "[574171.7589]"),
            (None, "Point", "[574171.7589, 9553033.8165]")]
    raw = spark.createDataFrame(rows, "properties map<string,string>, geometry_type string, geometry_wkt string")
    full = geo.geo_map_substations(raw)
    assert full.count() == 4                                       # unlocated stations stay in the mart
    a = sorted((tuple(r) for r in geo.geo_map_substations_view(full).collect()), key=repr)
    b = sorted((tuple(r) for r in geo.geo_map_substations_view(
        geo.geo_map_substations(raw, located_only=True), located=True).collect()), key=repr)
    assert a == b and len(a) == 2


# --- nothing is lost or shifted on the way in --------------------------------


def test_missing_value_tokens_and_cells_that_are_no_number(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "long.csv"),
               "Country code,Year,Variable,Unit,Value\nKEN,2020,Gas,TWh,NA\nKEN,2021,Gas,TWh,n/a\nKEN,2022,Gas,TWh,null\n"
               "KEN,2023,NaN,TWh,1.5\nKEN,2024,Gas,TWh,12 GWh\nKEN,2025,Gas,TWh,2\n")
    raw = files.read_long_csv(spark, p)
    rows = {r["year"]: r for r in ingest_long(raw, RUN).collect()}
    assert set(rows) == {2023, 2025} and rows[2023]["variable"] is None and rows[2025]["value"] == 2.0
    counts = uncastable(normalize_headers(raw), {"year": "int", "value": "double"})
    assert {r["column_name"]: r["uncastable"] for r in counts.collect()} == {"year": 0, "value": 1}


def test_files_are_matched_by_header_not_position(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "a.csv"), "Country code,Year,Variable,Unit,Value\nKEN,2020,Hydro,TWh,1\n")
    _write(os.path.join(tmpdir_path, "b.csv"), "Country code,Year,Unit,Variable,Value,Area\nKEN,2021,TWh,Gas,2,Kenya\n")
    for path in (tmpdir_path, os.path.join(tmpdir_path, "*.csv"), [os.path.join(tmpdir_path, f) for f in ("b.csv", "a.csv")]):
        rows = sorted((r["year"], r["variable"], r["unit"], r["value"], r["area"])
                      for r in ingest_long(files.read_long_csv(spark, path), RUN).collect())
        assert rows == [(2020, "Hydro", "TWh", 1.0, None), (2021, "Gas", "TWh", 2.0, "Kenya")]


def test_capacity_by_name_gets_the_long_tables_code(spark, tmpdir_path):
    long_ = _write(os.path.join(tmpdir_path, "long.csv"),
                   "Country code,Country,Year,Category,Subcategory,Variable,Unit,Value\n"
                   "KEN,Kenya,2020,Electricity generation,Fuel,Wind,TWh,1\n")
    cap = _write(os.path.join(tmpdir_path, "cap.csv"),
                 "Country,Technology,Year,Capacity MW\n KENYA ,Onshore wind energy,2020,300\nAtlantis,Hydropower,2020,1\n")
    raw_long = ingest_long(files.read_long_csv(spark, long_), RUN)
    df, tag = files.read_capacity(spark, cap)
    with pytest.raises(KeyError):
        ingest_capacity(df, tag, RUN)
    raw = ingest_capacity(df, tag, RUN, codes=country_codes(raw_long))
    assert {r["country"].strip(): r["country_code"] for r in raw.collect()} == {"KENYA": "KEN", "Atlantis": None}
    stg = silver.stg_irena_capacity(raw).collect()
    assert [(r["entity"], r["capacity_mw"]) for r in stg] == [("KEN", 300.0)]


def test_a_storage_fault_is_not_a_missing_capacity_file(spark, monkeypatch):
    def fault(*_):
        raise AnalysisException("denied", errorClass="FAILED_READ_FILE.NO_HINT", messageParameters={})
    monkeypatch.setattr(files, "read_csv", fault)
    with pytest.raises(AnalysisException):
        files.read_capacity(spark, "somewhere")


def test_broken_geojson_is_seen(spark, tmpdir_path, caplog):
    whole = json.dumps(_feature_collection())
    cut = _write(os.path.join(tmpdir_path, "cut.geojson"), whole[:-40])
    with pytest.raises(files.BrokenGeoJson):
        files.read_geojson(spark, cut)
    other = _write(os.path.join(tmpdir_path, "other.geojson"), '{"type": "Topology"}')
    with pytest.raises(files.BrokenGeoJson):
        files.read_geojson(spark, other)
    good = [json.dumps(f) for f in _feature_collection()["features"]]
    lines = _write(os.path.join(tmpdir_path, "f.jsonl"), "\n".join([good[0], good[1][:-9], '{"a": 1}', good[2]]))
    with caplog.at_level("WARNING"):
        assert files.read_geojson(spark, lines, line_delimited=True).count() == 2
    assert "2 broken lines" in caplog.text


def test_full_precision_is_the_default(spark):
    raw = spark.createDataFrame([({"name_ims11": "a"}, "Point", "[257634.5018, 9857079.966]")],
                                "properties map<string,string>, geometry_type string, geometry_wkt string")
    stations = geo.geo_map_substations(raw)
    lines = geo.geo_map_lines(raw.withColumn("resource_name", F.lit("66kV Network")))
    lat, lng = stations.select("lat", "lng").first()
    point = json.loads(geo.geo_features(lines, stations).first()["feature"])["geometry"]["coordinates"]
    assert point == [lng, lat]
    short = json.loads(geo.geo_features(lines, stations, 3).first()["feature"])["geometry"]["coordinates"]
    assert short == [round(lng, 3), round(lat, 3)]


def test_damaged_rows_are_set_aside(spark, tmpdir_path):
    """Rejects and landed rows are all rows of the files."""
    good = ["KEN,2020,Gas,1.5", 'KEN,2021,"Oil, heavy",2', "KEN,2022,,", '"KEN","2023","say ""hi""",4']
    bad = ["KEN,2024,Gas", "KEN,2025,Gas,1,2", 'KEN,2026,"Gas,1', "KEN"]
    a = _write(os.path.join(tmpdir_path, "a.csv"), "\n".join(["Country code,Year,Variable,Value", *good[:2], *bad[:3], *good[2:]]) + "\n")
    b = _write(os.path.join(tmpdir_path, "b.csv"), "\n".join(["Year,Country code,Variable,Value,Area", "2001,KEN,Wind,3,Kenya", bad[3]]) + "\n")
    rows, rejects = files.read_csv_and_rejects(spark, tmpdir_path)
    assert sorted(r["Year"] for r in rows.collect()) == ["2001", "2020", "2021", "2022", "2023"]
    told = {(os.path.basename(r["file"]), r["text"]) for r in rejects.collect()}
    assert told == {("a.csv", t) for t in bad[:3]} | {("b.csv", bad[3])}
    assert rows.select("Variable").filter("Variable like 'Oil%'").first()[0] == "Oil, heavy"
    assert rows.count() + rejects.count() == 9
