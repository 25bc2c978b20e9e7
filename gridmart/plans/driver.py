"""The full pipeline over the driver tables, and the registered queries.

``Assets`` wires stand-in inputs (``proxies``) through the library's bronze,
silver, gold, geo and serving functions.  Tables are built lazily and memoised
as DataFrames (plans, not data), so a query only plans what it reads.

Parameters that depend on the data window are explicit: the stand-in years are
1995-2001, so the year windows, KPI start year and decade bounds differ from the
reference defaults (2000-2030, 2000, 2000s-2020s), and CUF relates a year's
output to twelve months at the best month's rate.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.geo import lnglat_to_prime, prime_to_lnglat, prime_to_utm, utm_prime
from gridmart.functions.rounding import round_half_away as R
from gridmart.functions.rules import TECH_GROUP_DEFAULT, TECH_GROUP_RULES, TECHNOLOGY_RULES
from gridmart.operators import checks as C
from gridmart.operators.bronze import non_null_counts, null_tokens, tag_resource
from gridmart.operators.substrings import first_rule, rules_frame
from gridmart.plans import gold, geo, proxies, serving, silver
from gridmart.plans import incremental as inc
from gridmart.plans.bronze import country_codes, ingest_capacity, ingest_geo, ingest_long, ingest_wide
from gridmart.plans.build import CHECKS
from gridmart.session import checkpoint_dir
from gridmart.sources.files import (
    CAPACITY_FILE_SOURCE, FEATURE_SCHEMA, features_to_rows, read_geojson, read_seed, station_rows, write_geojson,
)
from gridmart.sources.tables import publish

PROXY_YEARS = (1996, 2030)
PROXY_CONTEXT_YEARS = (1990, 2030)
PROXY_KPI_MIN_YEAR = 1996
PROXY_DECADES = (1990, 2000)
PROXY_CUF = (1.0, 12.0)          # energy scale, hours (months) per year
PROXY_DECADE_FILTER = "2000s"
PROXY_REGION = "ASIA"
PROXY_COUNTRIES = [" brand#11 ", " BRAND#7 "]
PROXY_DIGITS = 6                 # so that every engine writes the same text


class Assets:
    def __init__(self, spark: SparkSession, sf_dir: str, run_ts=proxies.RUN_TS):
        self.spark, self.sf_dir, self.run_ts = spark, sf_dir, run_ts

    # --- bronze -----------------------------------------------------------
    @cached_property
    def monthly(self) -> DataFrame:
        return proxies.monthly_output(self.spark, self.sf_dir)

    @cached_property
    def raw_long(self) -> DataFrame:
        return ingest_long(proxies.long_rows(self.monthly), self.run_ts)

    @cached_property
    def raw_capacity(self) -> DataFrame:
        return ingest_capacity(proxies.capacity_rows(self.monthly), CAPACITY_FILE_SOURCE, self.run_ts)

    @cached_property
    def raw_wide(self) -> DataFrame:
        return ingest_wide(proxies.wide_rows(self.spark, self.sf_dir), self.run_ts)

    @cached_property
    def raw_messy_long(self) -> DataFrame:
        return ingest_long(proxies.messy_long_rows(self.spark, self.sf_dir), self.run_ts)

    @cached_property
    def raw_labelled_capacity(self) -> DataFrame:
        return ingest_capacity(proxies.labelled_capacity_rows(self.spark, self.sf_dir), CAPACITY_FILE_SOURCE,
                               self.run_ts)

    @cached_property
    def raw_token_long(self) -> DataFrame:
        return ingest_long(null_tokens(proxies.token_long_rows(self.spark, self.sf_dir)), self.run_ts)

    @cached_property
    def raw_region_long(self) -> DataFrame:
        keys = proxies.region_entities(self.spark, self.sf_dir, PROXY_REGION)
        return ingest_long(proxies.messy_long_rows(self.spark, self.sf_dir), self.run_ts, entities=keys)

    @cached_property
    def raw_named_capacity(self) -> DataFrame:
        return ingest_capacity(proxies.named_capacity_rows(self.monthly), CAPACITY_FILE_SOURCE, self.run_ts,
                               codes=country_codes(self.raw_long))

    @cached_property
    def raw_brand_capacity(self) -> DataFrame:
        return ingest_capacity(proxies.labelled_capacity_rows(self.spark, self.sf_dir), CAPACITY_FILE_SOURCE,
                               self.run_ts, country_names=PROXY_COUNTRIES)

    @cached_property
    def landed_features(self) -> DataFrame:
        parsed = proxies.feature_lines(self.spark, self.sf_dir).select(F.from_json("line", FEATURE_SCHEMA).alias("f"))
        return tag_resource(features_to_rows(parsed.select("f.*")), "events", "Event layer", "ev-1")

    def landed_collection(self) -> DataFrame:
        """The event layer written as one FeatureCollection and read back in ranges."""
        path = f"{checkpoint_dir(self.spark)}/events-{uuid.uuid4().hex}.geojson"
        lines = proxies.feature_lines(self.spark, self.sf_dir).withColumnRenamed("line", "feature")
        write_geojson(lines, path, document=True, order=["event_id"])
        return tag_resource(read_geojson(self.spark, path, length=1 << 20), "events", "Event layer", "ev-1")

    @cached_property
    def raw_geo(self) -> DataFrame:
        feats = proxies.geo_feature_rows(self.spark, self.sf_dir)
        stations = station_rows(proxies.station_csv_rows(self.spark, self.sf_dir))
        return ingest_geo([feats, stations], self.run_ts, spark=self.spark)

    def grid_places(self) -> DataFrame:
        """Degrees to the grid and back, to the sixth order."""
        south = F.col("lat") < 0
        xi, eta = lnglat_to_prime("lng", "lat")
        staged = proxies.degree_rows(self.spark, self.sf_dir).withColumns({"xi": xi, "eta": eta, "south": south})
        easting, northing = prime_to_utm(F.col("xi"), F.col("eta"), F.col("south"))
        grid = staged.withColumns({"easting": easting, "northing": northing})
        back = grid.withColumns(dict(zip(("bx", "be"), utm_prime("easting", "northing", F.col("south"), order=6))))
        lng, lat = prime_to_lnglat(F.col("bx"), F.col("be"), order=6)
        off = F.greatest(F.abs(lng - F.col("lng")), F.abs(lat - F.col("lat")))
        return back.select("event_id", R("easting", 3).alias("easting"), R("northing", 3).alias("northing"), (off < 1e-9).alias("exact"))

    def technology_by_table(self) -> DataFrame:
        """P17 and P18 from rule tables, matched through the n-gram index."""
        rows = silver.stg_irena_capacity(self.raw_labelled_capacity)
        named = first_rule(rows, "technology_raw", rules_frame(self.spark, TECHNOLOGY_RULES), "technology", F.col("technology_raw"))
        both = first_rule(named, "technology_raw", rules_frame(self.spark, TECH_GROUP_RULES), "tech_group", F.lit(TECH_GROUP_DEFAULT))
        return both.select(*rows.columns)

    # --- silver -----------------------------------------------------------
    @cached_property
    def categories(self) -> DataFrame:
        return silver.stg_source_categories(read_seed(self.spark))

    @cached_property
    def ember(self) -> DataFrame:
        return silver.stg_ember_generation(self.raw_long, PROXY_YEARS)

    @cached_property
    def capacity(self) -> DataFrame:
        return silver.stg_irena_capacity(self.raw_capacity, PROXY_YEARS)

    @cached_property
    def context(self) -> DataFrame:
        return silver.stg_owid_energy(self.raw_wide, PROXY_CONTEXT_YEARS)

    @cached_property
    def unified(self) -> DataFrame:
        return silver.stg_energy_unified(self.ember, self.capacity, self.context, self.categories,
                                         *PROXY_CUF)

    # --- gold -------------------------------------------------------------
    @cached_property
    def mix(self) -> DataFrame:
        return gold.renewable_mix(self.unified)

    @cached_property
    def capacity_trend(self) -> DataFrame:
        return gold.capacity_trend(self.capacity, self.unified)

    @cached_property
    def kpis(self) -> DataFrame:
        return gold.energy_kpis(self.context, self.mix, PROXY_KPI_MIN_YEAR, *PROXY_DECADES)

    @cached_property
    def gen_by_source(self) -> DataFrame:
        return gold.generation_by_source(self.unified)

    @cached_property
    def geo_infrastructure(self) -> DataFrame:
        return geo.geo_infrastructure(self.raw_geo)

    @cached_property
    def substations(self) -> DataFrame:
        return geo.geo_map_substations(self.raw_geo)

    @cached_property
    def located_substations(self) -> DataFrame:
        return geo.geo_map_substations(self.raw_geo, located_only=True)

    @cached_property
    def lines(self) -> DataFrame:
        return geo.geo_map_lines(self.raw_geo, digits=PROXY_DIGITS)

    @cached_property
    def unified_by_name(self) -> DataFrame:
        """The unified table when the capacity file gives names only."""
        capacity = silver.stg_irena_capacity(self.raw_named_capacity, PROXY_YEARS)
        return silver.stg_energy_unified(self.ember, capacity, self.context, self.categories, *PROXY_CUF)

    # --- incremental refresh ------------------------------------------------
    def _edited(self, df: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
        """An earlier state of a table by (entity, year), and the keys that have changed since: a sixth of the keys were not there or had another
        value, and some years were there that are not any more."""
        h = F.pmod(F.xxhash64("entity", "year"), F.lit(6))
        gone = df.filter((h == 1) & (F.col("year") % 2 == 0)).withColumn("year", F.col("year") + 20)
        before = df.filter((h != 0) | (F.col("year") % 2 == 0)).withColumn(
            value, F.when(h == 0, F.col(value) * 2 + 1).otherwise(F.col(value))).unionByName(gone)
        changed = df.filter(h == 0).select("entity", "year").unionByName(gone.select("entity", "year")).distinct()
        return before, changed

    def _stored(self, df: DataFrame, name: str) -> inc.Stored:
        path = f"{checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        publish(df, path, ["year"])
        return inc.Stored(self.spark, path)

    def refreshed_mix(self) -> DataFrame:
        """M6 from its earlier state and the changed keys."""
        unified = self._stored(self.unified, "unified").read()
        before, changed = self._edited(unified, "generation_twh")
        mart = self._stored(gold.renewable_mix(before), "mix")
        inc.refresh_mix(mart, unified, inc.fixed(changed))
        return mart.read()

    def refreshed_capacity_trend(self) -> DataFrame:
        """M7 from its earlier state and the changed keys."""
        unified, capacity = self._stored(self.unified, "unified").read(), self._stored(self.capacity, "capacity").read()
        before, changed = self._edited(capacity, "capacity_mw")
        mart = self._stored(gold.capacity_trend(before, unified), "trend")
        inc.refresh_capacity_trend(mart, capacity, unified, inc.fixed(changed))
        return mart.read()

    # --- checks -----------------------------------------------------------
    def checks(self) -> DataFrame:
        tables = {
            "raw_ember_generation": self.raw_long, "raw_owid_energy": self.raw_wide,
            "raw_irena_capacity": self.raw_capacity,
            "stg_ember_generation": self.ember, "stg_irena_capacity": self.capacity,
            "stg_owid_energy": self.context, "renewable_mix": self.mix,
            "capacity_trend": self.capacity_trend, "energy_kpis": self.kpis,
            "generation_by_source": self.gen_by_source,
        }
        return C.run_table_checks(tables, CHECK_SPECS, self.spark)


# The declared column checks of each stored asset, keyed by table name.
CHECK_SPECS = {name.split("/")[1]: checks for name, checks in CHECKS.items()}


def _feature_table(landed: DataFrame) -> DataFrame:
    return landed.select(F.col("properties")["name"].alias("name"), F.col("properties")["level"].alias("level"), "geometry_type",
                         "geometry_wkt", "dataset", "resource_name", "resource_id")


def _q(fn):
    return lambda spark, sf_dir: fn(Assets(spark, sf_dir))


QUERIES = {
    # marts (source queries Q1-Q5 with their served order)
    "mix": _q(lambda p: serving.renewable_mix_source(p.mix)),
    "unified": _q(lambda p: p.unified),
    "capacity_trend": _q(lambda p: serving.capacity_trend_source(p.capacity_trend)),
    "kpis": _q(lambda p: serving.energy_kpis_source(p.kpis)),
    "gen_by_source": _q(lambda p: serving.generation_by_source_source(p.gen_by_source)),
    # marts refreshed from changed keys
    "mix_refreshed": _q(lambda p: serving.renewable_mix_source(p.refreshed_mix())),
    "capacity_trend_refreshed": _q(lambda p: serving.capacity_trend_source(p.refreshed_capacity_trend())),
    # silver / bronze assets
    "ember_clean": _q(lambda p: p.ember),
    "capacity_clean": _q(lambda p: p.capacity),
    "owid_clean": _q(lambda p: p.context),
    "raw_wide": _q(lambda p: p.raw_wide),
    "clean_value": _q(lambda p: silver.stg_ember_generation(p.raw_messy_long)),
    "raw_long_messy": _q(lambda p: p.raw_messy_long),
    "raw_wide_counts": _q(lambda p: non_null_counts(p.raw_wide)),
    "raw_long_tokens": _q(lambda p: p.raw_token_long),
    "raw_long_region": _q(lambda p: p.raw_region_long),
    "capacity_countries": _q(lambda p: silver.stg_irena_capacity(p.raw_brand_capacity)),
    "unified_by_name": _q(lambda p: p.unified_by_name),
    "source_categories": _q(lambda p: silver.stg_source_categories(proxies.seed_rows(p.spark, p.sf_dir))),
    "landed_features": _q(lambda p: _feature_table(p.landed_features)),
    "landed_collection": _q(lambda p: _feature_table(p.landed_collection())),
    "map_technology": _q(lambda p: silver.stg_irena_capacity(p.raw_labelled_capacity)),
    # overview / capacity / KPI / sources pages
    "latest": _q(lambda p: serving.latest(p.kpis)),
    "target_progress": _q(lambda p: serving.target_progress(p.kpis)),
    "yoy": _q(lambda p: serving.yoy(p.mix)),
    "geo_vs_others": _q(lambda p: serving.geo_vs_others(p.mix)),
    "additions": _q(lambda p: serving.additions(p.capacity_trend)),
    "latest_cap": _q(lambda p: serving.latest_cap(p.capacity_trend)),
    "cuf": _q(lambda p: serving.cuf(p.gen_by_source)),
    "cuf_by_source": _q(lambda p: serving.cuf_by_source(p.gen_by_source)),
    "per_capita": _q(lambda p: serving.per_capita(p.kpis)),
    "carbon": _q(lambda p: serving.carbon(p.kpis)),
    "shares": _q(lambda p: serving.shares(p.kpis)),
    "all_kpis": _q(lambda p: serving.all_kpis(p.kpis)),
    "decades": _q(lambda p: serving.decades(p.kpis)),
    "filtered_source": _q(lambda p: serving.filtered_source(p.gen_by_source, p.kpis, PROXY_DECADE_FILTER)),
    "renew_vs_fossil": _q(lambda p: serving.renew_vs_fossil(p.gen_by_source)),
    # geo
    "geo_infrastructure": _q(lambda p: serving.geo_infrastructure_source(p.geo_infrastructure)),
    "geo_totals": _q(lambda p: serving.geo_totals(p.geo_infrastructure)),
    "by_dataset": _q(lambda p: serving.by_dataset(p.geo_infrastructure)),
    "by_geom": _q(lambda p: serving.by_geom(p.geo_infrastructure)),
    "by_resource": _q(lambda p: serving.by_resource(p.geo_infrastructure)),
    "substations": _q(lambda p: serving.geo_map_substations_source(
        geo.geo_map_substations_view(geo.geo_map_substations(
            p.raw_geo, located_only=True, order=serving.SUBSTATION_ORDER), located=True), ordered=True)),
    "substation_table": _q(lambda p: serving.substation_table(
        geo.geo_map_substations(p.raw_geo, order=serving.SUBSTATION_TABLE_ORDER), ordered=True)),
    "lines": _q(lambda p: p.lines),
    "layer_counts": _q(lambda p: geo.layer_counts(p.lines, p.located_substations, located=True)),
    "geojson_features": _q(lambda p: geo.geo_features(p.lines, p.located_substations, PROXY_DIGITS, located=True)),
    # theta join (equal keys + keyword LIKE)
    "keyword_cuf_indexed": _q(lambda p: gold.keyword_cuf(p.capacity, p.ember, *PROXY_CUF, indexed=True)),
    "technology_by_table": _q(lambda p: p.technology_by_table()),
    "grid_places": _q(lambda p: p.grid_places()),
    "keyword_cuf": _q(lambda p: gold.keyword_cuf(p.capacity, p.ember, *PROXY_CUF)),
    # data quality
    "checks": _q(lambda p: p.checks()),
}

#: Queries that write something to the shared folder and read it back, so building them runs jobs.
STORING = ("mix_refreshed", "capacity_trend_refreshed", "landed_collection")
