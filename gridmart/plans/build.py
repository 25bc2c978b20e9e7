"""``build_all``: the full daily build, layer by layer, on shared storage.

Order: bronze (long, wide, capacity, geo) -> silver (ember, capacity, context,
categories, unified) -> gold (mix, capacity trend, KPIs, by source, geo
infrastructure, substations, lines) -> GeoJSON features -> checks.

Every asset is written (full refresh, Parquet) under ``out_dir`` and read back
before the next layer uses it.  That is the medallion materialisation, and it
also cuts lineage at every table: a lost executor costs at most a re-run of the
current layer's tasks, never a recomputation from the landed files.
``out_dir`` must be a shared folder (the warehouse or a bucket path), never a
machine-local one on a cluster.
"""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.operators import checks as C
from gridmart.operators.bronze import drop_all_null_columns, normalize_headers, tag_resource, uncastable
from gridmart.plans import geo, gold, silver
from gridmart.plans import incremental as inc
from gridmart.plans.bronze import country_codes, ingest_capacity, ingest_geo, ingest_long, ingest_wide
from gridmart.sources import files

log = logging.getLogger(__name__)


@dataclass
class Inputs:
    """Locations of landed files (shared storage)."""
    long_csv: str | list[str]
    wide_csv: str | list[str]
    capacity_csv: str | None = None
    # geo resources: dicts with dataset, name, id, format ("GEOJSON"/"JSON", "JSONL"/"GEOJSONL"/"NDJSON" for one
    # Feature per line, "CSV"), path; and where it is not the default, the layer's projection: zone (0: the
    # coordinates are degrees) and south (default true)
    geo_resources: list[dict] = field(default_factory=list)
    seed_csv: str | None = None
    entities: list[str] | None = None           # long/wide codes to keep; None = all
    capacity_countries: list[str] | None = None  # capacity country names; None = all


@dataclass
class Params:
    generation_years: tuple[int, int] = silver.GENERATION_YEARS
    capacity_years: tuple[int, int] = silver.CAPACITY_YEARS
    context_years: tuple[int, int] = silver.CONTEXT_YEARS
    kpi_min_year: int = gold.KPI_MIN_YEAR
    decades: tuple[int, int] = (gold.DECADE_FIRST, gold.DECADE_LAST)
    buckets: int | None = None       # of the layers that the unified table joins; None: folders by year (``refresh_marts`` needs them)


# Declared column checks per stored table.
CHECKS = {
    "ingestion/raw_ember_generation": [C.not_null("country_code"), C.not_null("year"),
                                       C.not_null("variable"), C.not_null("value")],
    "ingestion/raw_owid_energy": [C.not_null("iso_code"), C.not_null("year")],
    "ingestion/raw_irena_capacity": [C.not_null("country"), C.not_null("year"), C.not_null("technology"),
                                     C.not_null("capacity_mw")],
    "staging/stg_ember_generation": [C.not_null("year"), C.accepted_range("year", 2000, 2030),
                                     C.not_null("variable"), C.not_null("unit"), C.not_null("value_clean")],
    "staging/stg_irena_capacity": [C.not_null("year"), C.not_null("technology"), C.not_null("capacity_mw")],
    "staging/stg_owid_energy": [C.not_null("year"), C.accepted_range("year", 1990, 2030),
                                C.not_null("country")],
    "mart/renewable_mix": [C.not_null("year"), C.unique("entity", "year"),
                           C.accepted_range("year", 2000, 2030), C.not_null("total_generation_twh"),
                           C.accepted_range("renewable_share_pct", 0, 100)],
    "mart/capacity_trend": [C.not_null("year"), C.unique("entity", "year"), C.not_null("total_renewable_mw")],
    "mart/energy_kpis": [C.not_null("year"), C.unique("entity", "year")],
    "mart/generation_by_source": [C.not_null("year"), C.not_null("source_type"), C.not_null("generation_twh")],
}


# Tables split into folders by year, so a year window reads only its folders.
PARTITIONED = {"ingestion/raw_ember_generation": "year", "staging/stg_ember_generation": "year",
               "ingestion/raw_owid_energy": "year", "ingestion/raw_irena_capacity": "year",
               "staging/stg_irena_capacity": "year", "staging/stg_owid_energy": "year", "staging/stg_energy_unified": "year",
               "mart/renewable_mix": "year", "mart/capacity_trend": "year", "mart/energy_kpis": "year",
               "mart/generation_by_source": "year"}


# Layers that the unified table joins on (entity, year): with ``Params.buckets`` they are stored in as many hash buckets
# instead of year folders, and their groupings and joins need no exchange (see ``co_partitioned``).
BUCKETED = ("staging/stg_ember_generation", "staging/stg_irena_capacity", "staging/stg_owid_energy")


def co_partitioned(spark: SparkSession) -> None:
    """Lets tables bucketed on (entity, year) meet on more columns than those without an exchange."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


class Builder:
    """Writes assets under ``out_dir`` and registers each in the catalog as ``<prefix><schema>.<table>``."""

    def __init__(self, spark: SparkSession, out_dir: str, prefix: str = "", buckets: int | None = None):
        self.spark, self.out_dir, self.prefix, self.buckets = spark, out_dir, prefix, buckets
        self.reports: list[tuple] = []                      # of the column checks, counted while tables were written

    def path(self, name: str) -> str:
        return os.path.join(self.out_dir, name)

    def table(self, name: str) -> str:
        schema, table = name.split("/")
        return f"`{self.prefix}{schema}`.`{table}`"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        by = PARTITIONED.get(name)
        if by:   # rows of a year meet before writing (few files a folder); a large year is split again by its size
            df = df.hint("rebalance", F.col(by))
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{name.split('/')[0]}`")
        buckets = (self.buckets, ("entity", "year")) if self.buckets and name in BUCKETED else None
        checks = CHECKS.get(name, [])
        df, told = C.observed(df, checks)                   # above the exchange, so a repeated map task counts nothing twice
        files.write_table(df, self.path(name), [by] if by and not buckets else (), table=self.table(name), buckets=buckets)
        stored = self.spark.table(self.table(name)) if buckets else files.read_table(self.spark, self.path(name))
        self.reports += C.report(name, checks, told, stored)
        return stored


def _renamed(raw: DataFrame) -> DataFrame:
    return normalize_headers(raw).select("year", "value")


def _geo_frames(spark: SparkSession, resources: list[dict]) -> list[DataFrame]:
    """Read every selected geo resource (S9); one that cannot be read is skipped
    with a warning, the others still land."""
    frames = []
    by_dataset: dict[str, list[dict]] = {}
    for r in resources:
        by_dataset.setdefault(r.get("dataset", ""), []).append(r)
    for dataset, res in by_dataset.items():
        for kind, r in files.select_resources(res, dataset):
            try:
                if kind == "csv":
                    df = files.read_station_csv(spark, r["path"])
                else:
                    df = files.read_geojson(spark, r["path"], line_delimited=kind == "geojson_lines")
            except (AnalysisException, files.BrokenGeoJson) as exc:  # missing or broken: skip it, keep the rest
                log.warning("skipped geo resource %s (%s)", r.get("path"), exc)
                continue
            grid = (int(r["zone"]), bool(r.get("south", True))) if r.get("zone") is not None else None
            frames.append(tag_resource(df, dataset, r.get("name"), r.get("id"), grid))
    return frames


def build_all(spark: SparkSession, inputs: Inputs, out_dir: str | None = None,
              run_ts: datetime | None = None, params: Params | None = None, catalog_prefix: str = "") -> dict[str, str]:
    """Run the whole pipeline; return {table name: stored location}.

    Every table is registered in the catalog by schema and name (``mart.renewable_mix``);
    ``catalog_prefix`` keeps several builds apart."""
    run_ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    params = params or Params()
    out_dir = out_dir or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "gridmart")
    b = Builder(spark, out_dir, catalog_prefix, params.buckets)
    if params.buckets:
        co_partitioned(spark)

    long_csv, long_rejects = files.read_csv_and_rejects(spark, inputs.long_csv)
    wide_csv, wide_rejects = files.read_csv_and_rejects(spark, inputs.wide_csv)
    rejected = b.save("checks/rejected_rows", long_rejects.unionByName(wide_rejects))
    for r in rejected.groupBy("file").count().orderBy("file").limit(20).collect():
        log.warning("%d rows of %s do not fit its header and were set aside", r["count"], r["file"])
    raw_long = b.save("ingestion/raw_ember_generation", ingest_long(long_csv, run_ts, inputs.entities))
    # P7 on a stored table: the counts read its columns, and the landed file is parsed once
    wide = b.save("ingestion/raw_owid_energy_landed",
                  ingest_wide(wide_csv, run_ts, inputs.entities))
    raw_wide = b.save("ingestion/raw_owid_energy", drop_all_null_columns(wide, keep=("iso_code", "year")))
    cap_df, tag = files.read_capacity(spark, inputs.capacity_csv)
    codes = country_codes(ingest_long(long_csv, run_ts)) if "country_code" not in cap_df.columns else None
    raw_cap = b.save("ingestion/raw_irena_capacity",
                     ingest_capacity(cap_df, tag, run_ts, inputs.capacity_countries, codes))
    unknown = [r["country"] for r in raw_cap.filter("country_code IS NULL").select("country").distinct().limit(10).collect()]
    if unknown:
        raise ValueError(f"capacity rows of countries without a code: {unknown}")
    casts = b.save("checks/uncastable_cells", uncastable(_renamed(long_csv), {"year": "int", "value": "double"}).unionByName(
        uncastable(cap_df, {"year": "int", "capacity_mw": "double"}).withColumn(
            "column_name", F.concat(F.lit("capacity."), "column_name"))))
    for r in casts.filter("uncastable > 0").collect():
        log.warning("%d cells of %s are no number and were taken as missing", r["uncastable"], r["column_name"])
    raw_geo = b.save("ingestion/raw_energydata_geo",
                     ingest_geo(_geo_frames(spark, inputs.geo_resources), run_ts, spark=spark))

    ember = b.save("staging/stg_ember_generation",
                   silver.stg_ember_generation(raw_long, params.generation_years))
    cap = b.save("staging/stg_irena_capacity", silver.stg_irena_capacity(raw_cap, params.capacity_years))
    ctx = b.save("staging/stg_owid_energy", silver.stg_owid_energy(raw_wide, params.context_years))
    cats = b.save("staging/stg_source_categories",
                  silver.stg_source_categories(files.read_seed(spark, inputs.seed_csv)))
    unified = b.save("staging/stg_energy_unified", silver.stg_energy_unified(ember, cap, ctx, cats))

    mix = b.save("mart/renewable_mix", gold.renewable_mix(unified))
    b.save("mart/capacity_trend", gold.capacity_trend(cap, unified))
    b.save("mart/energy_kpis", gold.energy_kpis(ctx, mix, params.kpi_min_year, *params.decades))
    b.save("mart/generation_by_source", gold.generation_by_source(unified))
    b.save("mart/geo_infrastructure", geo.geo_infrastructure(raw_geo))
    subst = b.save("mart/geo_map_substations", geo.geo_map_substations(raw_geo))
    lines = b.save("mart/geo_map_lines", geo.geo_map_lines(raw_geo))
    files.write_geojson(geo.geo_features(lines, subst), b.path("export/infrastructure_geojson"))

    b.save("checks/column_checks", spark.createDataFrame(b.reports, C.CHECK_SCHEMA))
    names = ["ingestion/raw_ember_generation", "ingestion/raw_owid_energy", "ingestion/raw_irena_capacity",
             "ingestion/raw_energydata_geo", "staging/stg_ember_generation", "staging/stg_irena_capacity",
             "staging/stg_owid_energy", "staging/stg_source_categories", "staging/stg_energy_unified",
             "mart/renewable_mix", "mart/capacity_trend", "mart/energy_kpis", "mart/generation_by_source",
             "mart/geo_infrastructure", "mart/geo_map_substations", "mart/geo_map_lines",
             "export/infrastructure_geojson", "checks/column_checks", "checks/uncastable_cells",
             "checks/rejected_rows"]
    return {n: b.path(n) for n in names}


def refresh_marts(spark: SparkSession, out_dir: str, changed: DataFrame, params: Params | None = None,
                  catalog_prefix: str = "") -> dict[str, list[int]]:
    """Brings the unified table and the marts of a build up to date with its staging tables (generation, capacity, context), of which
    the rows of the ``changed`` keys (entity, year) are new, altered or gone.  Returns the years rewritten of each table."""
    params = params or Params()
    b = Builder(spark, out_dir, catalog_prefix)

    def stored(name: str) -> inc.Stored:
        return inc.Stored(spark, b.path(name), b.table(name))

    def source(name: str) -> DataFrame:
        return files.read_table(spark, b.path(f"staging/{name}"))

    ember, cap, ctx, cats = (source(n) for n in ("stg_ember_generation", "stg_irena_capacity", "stg_owid_energy",
                                                 "stg_source_categories"))
    changed = inc.fixed(changed.select("entity", F.col("year").cast("int").alias("year")).dropna().distinct())
    unified = stored("staging/stg_energy_unified")
    done = {"staging/stg_energy_unified": inc.refresh_by_key(
        unified, lambda e, c, o: silver.stg_energy_unified(e, c, o, cats), [ember, cap, ctx], changed)}
    mix = stored("mart/renewable_mix")
    done["mart/renewable_mix"] = inc.refresh_mix(mix, unified.read(), changed)
    done["mart/capacity_trend"] = inc.refresh_capacity_trend(stored("mart/capacity_trend"), cap, unified.read(), changed)
    done["mart/energy_kpis"] = inc.refresh_kpis(stored("mart/energy_kpis"), ctx, mix.read(), changed, done["mart/renewable_mix"],
                                                params.kpi_min_year, *params.decades)
    done["mart/generation_by_source"] = inc.refresh_generation_by_source(stored("mart/generation_by_source"), unified.read(), changed)
    return {name: inc.years_of(keys) for name, keys in done.items()}


def run_checks_only(spark: SparkSession, out_dir: str) -> DataFrame:
    """C4: re-run the declared checks on already stored tables."""
    tables = {name: files.read_table(spark, os.path.join(out_dir, name)) for name in CHECKS}
    return C.run_table_checks(tables, CHECKS, spark)
