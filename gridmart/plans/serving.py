"""Serving queries Q1-Q31 over the marts: one function per dashboard query.

Every query keeps ``entity`` so one call answers all countries; "latest" means
latest per entity.  Sorts are the served order (marts are small: one row per
entity and year, or per entity, year and source).  Nullable sort keys sort
NULLs last.  User parameters are function arguments, never spliced SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.rounding import round_half_away as R
from gridmart.operators.windows import lag_of, latest_per

# --- Q1-Q6: source queries (whole mart, served order) -----------------------


def capacity_trend_source(cap: DataFrame) -> DataFrame:          # Q1, Q12
    return cap.orderBy("entity", "year")


def energy_kpis_source(kpis: DataFrame) -> DataFrame:            # Q2
    return kpis.orderBy("entity", F.col("year").desc())


def generation_by_source_source(gbs: DataFrame) -> DataFrame:    # Q3, Q21
    return gbs.orderBy("entity", "year", F.col("generation_twh").desc(), "source_type")


def geo_infrastructure_source(geo: DataFrame) -> DataFrame:      # Q4, Q26, Q31
    return geo.orderBy(F.col("dataset").asc_nulls_last(), F.col("feature_count").desc(), "resource_name", "geometry_type")


def renewable_mix_source(mix: DataFrame) -> DataFrame:           # Q5, Q8
    return mix.orderBy("entity", "year")


SUBSTATION_ORDER = ("station_name",)                             # Q6
SUBSTATION_TABLE_ORDER = ("county", "station_name")              # Q28


def _in_order(df: DataFrame, names, ordered: bool) -> DataFrame:
    """Served order, NULLs last, the other columns breaking ties; ``ordered``: the stations were sorted before the
    grid series ran (``geo_map_substations(order=...)``), and projections kept that order."""
    if ordered:
        return df
    rest = [c for c in df.columns if c not in names]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in (*names, *rest)])


def geo_map_substations_source(view: DataFrame, ordered: bool = False) -> DataFrame:    # Q6 (view built by geo.G5)
    return _in_order(view, SUBSTATION_ORDER, ordered)


# --- Q7-Q11: overview page --------------------------------------------------


def latest(kpis: DataFrame) -> DataFrame:                          # Q7
    """Latest KPI row per entity with the previous present year's share."""
    with_prev = kpis.withColumn("prev_renewable_share_pct", lag_of("renewable_share_pct"))
    return latest_per(with_prev, ("entity",), "year")


def target_progress(kpis: DataFrame) -> DataFrame:                 # Q9 (gap unrounded)
    return kpis.select("entity", "year", "renewable_share_pct",
                       (F.lit(100.0) - F.col("renewable_share_pct")).alias("gap_pp"),
                       "target_progress_ratio").orderBy("entity", "year")


def yoy(mix: DataFrame) -> DataFrame:                              # Q10
    return (mix.filter(F.col("renewable_share_yoy_pp").isNotNull())
            .select("entity", "year", "renewable_share_yoy_pp").orderBy("entity", "year"))


def geo_vs_others(mix: DataFrame) -> DataFrame:                    # Q11
    other = F.col("hydro_twh") + F.col("wind_twh") + F.col("solar_twh") + F.col("bioenergy_twh")
    return mix.select("entity", "year", "geothermal_twh", other.alias("other_renewables_twh"),
                      "fossil_twh").orderBy("entity", "year")


# --- Q12-Q15: capacity page -------------------------------------------------


def additions(cap: DataFrame) -> DataFrame:                        # Q13
    return (cap.filter(F.col("mw_added_yoy").isNotNull())
            .select("entity", "year", "mw_added_yoy", "capacity_growth_pct").orderBy("entity", "year"))


def latest_cap(cap: DataFrame) -> DataFrame:                       # Q14
    return latest_per(cap, ("entity",), "year")


def _renewable_cuf(gbs: DataFrame) -> DataFrame:
    return gbs.filter(F.col("capacity_utilisation_factor").isNotNull() & F.col("is_renewable"))


def cuf(gbs: DataFrame) -> DataFrame:                              # Q15
    return (_renewable_cuf(gbs)
            .select("entity", "year", "source_type", F.col("capacity_utilisation_factor").alias("cuf"))
            .orderBy("entity", "year", "source_type"))


def cuf_by_source(gbs: DataFrame) -> DataFrame:                    # Q25
    return (_renewable_cuf(gbs)
            .select("entity", "year", "source_type", "capacity_utilisation_factor")
            .orderBy("entity", "year", "source_type"))


# --- Q16-Q20: KPI page ------------------------------------------------------


def kpis_by_year(kpis: DataFrame) -> DataFrame:                    # Q16
    return kpis.orderBy("entity", "year")


def per_capita(kpis: DataFrame) -> DataFrame:                      # Q17
    return kpis.select("entity", "year", "per_capita_elec_kwh").orderBy("entity", "year")


def carbon(kpis: DataFrame) -> DataFrame:                          # Q18
    return (kpis.filter(F.col("carbon_intensity_gco2_kwh").isNotNull())
            .select("entity", "year", "carbon_intensity_gco2_kwh", "co2_from_elec_mtco2")
            .orderBy("entity", "year"))


def shares(kpis: DataFrame) -> DataFrame:                          # Q19
    return kpis.select("entity", "year", "renewable_share_pct", "fossil_share_pct").orderBy("entity", "year")


def all_kpis(kpis: DataFrame) -> DataFrame:                        # Q20
    return (kpis.select("entity", "year", "renewable_share_pct", "access_to_electricity_pct",
                        "per_capita_elec_kwh", "carbon_intensity_gco2_kwh", "co2_from_elec_mtco2",
                        "total_generation_twh", "decade")
            .orderBy("entity", F.col("year").desc()))


# --- Q21-Q25: sources page --------------------------------------------------


def decades(kpis: DataFrame) -> DataFrame:                         # Q22
    return kpis.select("decade").distinct().orderBy(F.col("decade").asc_nulls_last())


def filtered_source(gbs: DataFrame, kpis: DataFrame, decade: str) -> DataFrame:  # Q23, P26
    """Sources of the years in ``decade``; join keys appear once."""
    k = kpis.filter(F.col("decade") == F.lit(decade))
    return (gbs.join(k, ["entity", "year"], "inner")
            .orderBy("entity", "year", F.col("generation_twh").desc()))


def renew_vs_fossil(gbs: DataFrame) -> DataFrame:                  # Q24 (Nuclear counts as fossil)
    g = F.col("generation_twh")
    return (gbs.groupBy("entity", "year")
            .agg(F.sum(F.when(F.col("is_renewable"), g).otherwise(F.lit(0.0))).alias("renewable_twh"),
                 F.sum(F.when(~F.col("is_renewable"), g).otherwise(F.lit(0.0))).alias("fossil_twh"))
            .orderBy("entity", "year"))


# --- Q26-Q31: geo page ------------------------------------------------------


def geo_totals(geo: DataFrame) -> DataFrame:                       # Q27 / A10
    return geo.agg(F.countDistinct("dataset").alias("total_datasets"),
                   F.countDistinct("resource_name").alias("total_layers"),
                   F.sum("feature_count").cast("bigint").alias("total_features"))


def substation_table(subst: DataFrame, ordered: bool = False) -> DataFrame:               # Q28
    table = subst.select("station_name", "county", "owner", "manned",
                         R("lat", 4).alias("latitude"), R("lng", 4).alias("longitude"))
    return _in_order(table, SUBSTATION_TABLE_ORDER, ordered)


def by_dataset(geo: DataFrame) -> DataFrame:                       # Q29 / A11
    return (geo.groupBy("dataset").agg(F.sum("feature_count").cast("bigint").alias("feature_count"))
            .orderBy(F.col("feature_count").desc()))


def by_geom(geo: DataFrame) -> DataFrame:                          # Q30 / A11
    return (geo.groupBy("geometry_type").agg(F.sum("feature_count").cast("bigint").alias("feature_count"))
            .orderBy(F.col("feature_count").desc()))


def by_resource(geo: DataFrame) -> DataFrame:                      # Q31
    return (geo.select("dataset", "resource_name", "geometry_type", "feature_count")
            .orderBy(F.col("dataset").asc_nulls_last(), F.col("feature_count").desc(), "resource_name", "geometry_type"))
