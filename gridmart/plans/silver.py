"""Silver assets (M1-M5): typed, cleaned, unified tables keyed by entity.

Every table carries ``entity`` first; every aggregate and window is keyed by it,
so one job serves any number of countries.  Rows without an entity are not kept
(with an entity list, bronze never passes them in the first place).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.functions.rounding import round_half_away as R
from gridmart.functions.rounding import round_half_even
from gridmart.functions.rules import (
    clean_value, cuf, flag_fossil, flag_like, map_technology, parse_bool, tech_group,
)
from gridmart.operators.bronze import col_or_null

GENERATION_YEARS = (2000, 2030)
CAPACITY_YEARS = (2000, 2030)
CONTEXT_YEARS = (1990, 2030)
# The slice of long rows that holds generation by fuel, and the
# categories whose generation makes up a year's total.
GENERATION_SLICE = {"unit": "TWh", "category": "Electricity generation", "subcategory": "Fuel"}
TOTAL_CATEGORIES = ("Renewables", "Fossil Fuels", "Nuclear")


def _years(col: str, years: tuple[int, int]):
    return F.col(col).isNotNull() & F.col(col).cast("int").between(years[0], years[1])


def stg_ember_generation(raw: DataFrame, years: tuple[int, int] = GENERATION_YEARS,
                         entity_col: str = "country_code") -> DataFrame:
    """M1: trim labels, null negative TWh (P14), flags (P15, P16), year window."""
    return (raw
            .filter(_years("year", years) & F.col("value").isNotNull() & F.col(entity_col).isNotNull())
            .select(
                F.col(entity_col).alias("entity"),
                F.col("year").cast("int").alias("year"),
                F.trim("category").alias("category"),
                F.trim("subcategory").alias("subcategory"),
                F.trim("variable").alias("variable"),
                F.trim("unit").alias("unit"),
                clean_value("value", "unit", "variable").alias("value_clean"),
                flag_like("category", "renewable").alias("is_renewable"),
                flag_fossil("category", "subcategory").alias("is_fossil"),
                F.lit("Ember").alias("data_source"),
                F.col("_ingested_at"),
            ))


def stg_irena_capacity(raw: DataFrame, years: tuple[int, int] = CAPACITY_YEARS,
                       entity_col: str = "country_code") -> DataFrame:
    """M3: map technology labels (P17, P18), non-negative capacity (P13), years."""
    cap = F.col("capacity_mw").cast("double")
    return (raw
            .filter(_years("year", years) & F.col("capacity_mw").isNotNull() & (cap >= 0)
                    & F.col(entity_col).isNotNull())
            .select(
                F.col(entity_col).alias("entity"),
                F.col("year").cast("int").alias("year"),
                F.trim("country").alias("country"),
                F.trim("technology").alias("technology_raw"),
                map_technology("technology").alias("technology"),
                tech_group("technology").alias("tech_group"),
                F.lit(True).alias("is_renewable"),
                R(cap, 2).alias("capacity_mw"),
                F.col("_source"),
                F.col("_ingested_at"),
            ))


# Fixed values: (output column, input column, digits; None = typed NULL placeholder)
OWID_COLUMNS = (
    ("access_to_electricity_pct", None, None),
    ("per_capita_elec_kwh", "per_capita_electricity", 2),
    ("energy_per_capita_kwh", "energy_per_capita", 2),
    ("carbon_intensity_gco2_kwh", "carbon_intensity_elec", 4),
    ("total_elec_twh", "electricity_generation", 4),
    ("renewables_elec_twh", "renewables_electricity", 4),
    ("hydro_elec_twh", "hydro_electricity", 4),
    ("wind_elec_twh", "wind_electricity", 4),
    ("solar_elec_twh", "solar_electricity", 4),
    ("other_renewables_elec_twh", "other_renewable_electricity", 4),
    ("fossil_elec_twh", "fossil_electricity", 4),
    ("nuclear_elec_twh", "nuclear_electricity", 4),
    ("renewables_share_elec_pct", "renewables_share_elec", 2),
    ("low_carbon_share_elec_pct", "low_carbon_share_elec", 2),
    ("fossil_share_elec_pct", "fossil_share_elec", 2),
    ("primary_energy_twh", "primary_energy_consumption", 4),
    ("renewables_share_energy_pct", None, None),
    ("co2_from_elec_mtco2", None, None),
    ("ghg_emissions_mtco2eq", "greenhouse_gas_emissions", 4),
)


def stg_owid_energy(raw: DataFrame, years: tuple[int, int] = CONTEXT_YEARS,
                    entity_col: str = "iso_code") -> DataFrame:
    """M2: project, rename, round; a column dropped upstream becomes a typed NULL."""
    cols = [F.col(entity_col).alias("entity"), F.col("year").cast("int").alias("year"),
            col_or_null(raw, "country", "string").alias("country"),
            col_or_null(raw, "iso_code", "string").alias("iso_code")]
    for out, src, digits in OWID_COLUMNS:
        if src is None:
            cols.append(F.lit(None).cast("double").alias(out))
        else:
            cols.append(R(col_or_null(raw, src).cast("double"), digits).alias(out))
    cols.append(F.col("_ingested_at"))
    return raw.filter(_years("year", years) & F.col(entity_col).isNotNull()).select(*cols)


def stg_source_categories(seed: DataFrame) -> DataFrame:
    """M4: trimmed labels, boolean renewable flag."""
    return seed.select(
        F.trim("source_type").alias("source_type"),
        F.trim("category").alias("category"),
        F.trim("subcategory").alias("subcategory"),
        parse_bool("is_renewable").alias("is_renewable"),
        F.trim("color_hex").alias("color_hex"),
    )


CONTEXT_FIELDS = ("access_to_electricity_pct", "per_capita_elec_kwh", "carbon_intensity_gco2_kwh",
                  "renewables_share_elec_pct", "low_carbon_share_elec_pct", "co2_from_elec_mtco2",
                  "total_elec_twh")


def stg_energy_unified(ember: DataFrame, capacity: DataFrame, context: DataFrame,
                       categories: DataFrame, cuf_energy_scale: float = 1e6,
                       cuf_hours: float = 8760.0,
                       total_categories: Sequence[str] = TOTAL_CATEGORIES) -> DataFrame:
    """M5: one row per (entity, year, source_type).

    1. generation = sum of cleaned values of the generation slice (A1; NULL-only
       sums are 0.0); rows without an entity or source label are not grouped
       (a groupby drops NULL keys).
    2. capacity = max MW per mapped technology (A2), left-joined (J1).
    3. CUF (M13), 4 dp half-even, clamped.
    4. categories left-joined on source_type (J2).
    5. context indicators left-joined on (entity, year) (J3).
    6. year total over ``total_categories`` by a window sum (J4, A3) and the
       share of it, 2 dp half-even (W6); total 0 gives a NULL share.

    Both aggregations combine map-side before their shuffle, so a hot entity or
    source costs one partial row per task.
    """
    gen = (ember
           .filter((F.col("unit") == GENERATION_SLICE["unit"])
                   & (F.col("category") == GENERATION_SLICE["category"])
                   & (F.col("subcategory") == GENERATION_SLICE["subcategory"])
                   & F.col("entity").isNotNull() & F.col("variable").isNotNull())
           .groupBy("entity", "year", F.col("variable").alias("source_type"))
           .agg(F.coalesce(F.sum("value_clean"), F.lit(0.0)).alias("generation_twh")))
    cap = (capacity
           .filter(F.col("entity").isNotNull() & F.col("technology").isNotNull())
           .groupBy("entity", "year", F.col("technology").alias("source_type"))
           .agg(F.max("capacity_mw").alias("capacity_mw")))
    cats = categories.select("source_type", "category", "color_hex")
    ctx = context.select("entity", "year", *CONTEXT_FIELDS)

    unified = (gen.join(cap, ["entity", "year", "source_type"], "left")
               .withColumn("cuf", cuf("generation_twh", "capacity_mw", cuf_energy_scale, cuf_hours))
               .join(cats, "source_type", "left")
               .join(ctx, ["entity", "year"], "left"))
    in_total = F.col("category").isin(*total_categories)
    year_total = F.sum(F.when(in_total, F.col("generation_twh"))).over(
        Window.partitionBy("entity", "year"))
    unified = unified.withColumn("year_total_twh", year_total)
    share = round_half_even(F.try_divide(F.col("generation_twh"), F.col("year_total_twh"))
                            * F.lit(100.0), 2)
    return unified.select(
        "entity", "year", "source_type", "generation_twh", "capacity_mw", "cuf", "category",
        "color_hex", *CONTEXT_FIELDS, "year_total_twh", share.alias("share_pct"))
