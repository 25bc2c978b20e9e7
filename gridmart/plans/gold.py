"""Gold marts (M6-M9): yearly mix, capacity trend, KPIs, generation by source.

Each mart first aggregates to one row per (entity, year) — partial aggregation
on the map side, one shuffle on the grouping keys — and only then applies its
LAG/RANK windows, partitioned by entity.  The repeated ``SUM(CASE ...)`` of the
share and its year-on-year change is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.rounding import round_half_away as R
from gridmart.functions.rules import DEFAULT_SOURCE_COLOR, decade, flag_like
from gridmart.operators.joins import keyword_join
from gridmart.operators.substrings import contained
from gridmart.operators.windows import lag_of, rank_desc

# Which sources/categories feed each mart column.
MIX_SOURCE_COLUMNS = (
    ("geothermal_twh", ("Geothermal",)),
    ("hydro_twh", ("Hydro", "Hydropower")),
    ("wind_twh", ("Wind",)),
    ("solar_twh", ("Solar",)),
    ("bioenergy_twh", ("Bioenergy",)),
    ("other_renewables_twh", ("Other Renewables",)),
)
MIX_FOSSIL_COLUMNS = (
    ("gas_twh", ("Gas",)),
    ("oil_twh", ("Oil",)),
    ("coal_twh", ("Coal",)),
)
TOTAL_CATEGORIES = ("Renewables", "Fossil Fuels", "Nuclear")
CAPACITY_GROUP_COLUMNS = (
    ("geothermal_mw", "Geothermal"),
    ("hydro_mw", "Hydro"),
    ("wind_mw", "Wind"),
    ("solar_mw", "Solar"),
    ("bioenergy_mw", "Bioenergy"),
)
CUF_COLUMNS = (
    ("geothermal_cuf", ("Geothermal",)),
    ("hydro_cuf", ("Hydro", "Hydropower")),
    ("wind_cuf", ("Wind",)),
    ("solar_cuf", ("Solar",)),
)
KPI_MIN_YEAR = 2000
DECADE_FIRST, DECADE_LAST = 2000, 2020


def _sum_if(cond, value: str = "generation_twh"):
    """SUM(CASE WHEN cond THEN value ELSE 0 END): a missing source sums to 0 (A4)."""
    return F.sum(F.when(cond, F.col(value)).otherwise(F.lit(0.0)))


def renewable_mix(unified: DataFrame) -> DataFrame:
    """M6: one row per (entity, year) with source totals, shares and YoY."""
    gen = (unified.filter(F.col("category").isNotNull())
           .select("entity", "year", "source_type", "category",
                   F.coalesce("generation_twh", F.lit(0.0)).alias("generation_twh")))
    cat, src = F.col("category"), F.col("source_type")
    aggs = [_sum_if(cat.isin(*TOTAL_CATEGORIES)).alias("tot"),
            _sum_if(cat == "Renewables").alias("ren"),
            _sum_if(cat == "Fossil Fuels").alias("fos")]
    aggs += [_sum_if(src.isin(*names)).alias(name) for name, names in MIX_SOURCE_COLUMNS]
    aggs += [_sum_if(src.isin(*names)).alias(name) for name, names in MIX_FOSSIL_COLUMNS]
    yearly = gen.groupBy("entity", "year").agg(*aggs)
    share = R(F.try_divide(F.col("ren"), F.col("tot")) * F.lit(100.0), 1)
    yearly = yearly.withColumn("renewable_share_pct", share)
    return yearly.select(
        "entity", "year",
        R("tot", 4).alias("total_generation_twh"),
        R("ren", 4).alias("renewable_twh"),
        *[R(name, 4).alias(name) for name, _ in MIX_SOURCE_COLUMNS],
        R("fos", 4).alias("fossil_twh"),
        *[R(name, 4).alias(name) for name, _ in MIX_FOSSIL_COLUMNS],
        "renewable_share_pct",
        R(F.try_divide(F.col("fos"), F.col("tot")) * F.lit(100.0), 1).alias("fossil_share_pct"),
        R(F.col("renewable_share_pct") - lag_of("renewable_share_pct"), 2)
        .alias("renewable_share_yoy_pp"),
    )


def capacity_trend(capacity: DataFrame, unified: DataFrame) -> DataFrame:
    """M7: capacity by technology group, additions and growth, CUF by source.

    Two-stage sum (A6) then a pivot without ELSE (A5: a group missing in a year is
    NULL); LAG difference and growth on the 1-dp totals (W2, W3); conditional
    averages of CUF (A7) left-joined on (entity, year) (J5).
    """
    by_group = (capacity.groupBy("entity", "year", "tech_group")
                .agg(F.sum("capacity_mw").alias("capacity_mw")))
    tg = F.col("tech_group")
    wide = by_group.groupBy("entity", "year").agg(
        R(F.sum("capacity_mw"), 1).alias("total_renewable_mw"),
        *[R(F.sum(F.when(tg == g, F.col("capacity_mw"))), 1).alias(name)
          for name, g in CAPACITY_GROUP_COLUMNS])
    prev = lag_of("total_renewable_mw")
    with_add = wide.select(
        "*",
        (F.col("total_renewable_mw") - prev).alias("mw_added_yoy"),
        R(F.try_divide(F.col("total_renewable_mw") - prev, prev) * F.lit(100.0), 1)
        .alias("capacity_growth_pct"))
    st = F.col("source_type")
    cuf_by_year = (unified.filter(F.col("cuf").isNotNull())
                   .groupBy("entity", "year")
                   .agg(*[R(F.avg(F.when(st.isin(*names), F.col("cuf"))), 3).alias(name)
                          for name, names in CUF_COLUMNS]))
    return with_add.join(cuf_by_year, ["entity", "year"], "left")


def energy_kpis(context: DataFrame, mix: DataFrame, min_year: int = KPI_MIN_YEAR,
                decade_first: int = DECADE_FIRST, decade_last: int = DECADE_LAST) -> DataFrame:
    """M8: context indicators joined with the mix (J6), target progress (P28), decade."""
    o = context.filter(F.col("year") >= min_year).alias("o")
    m = mix.alias("m")
    j = o.join(m, (F.col("o.entity") == F.col("m.entity")) & (F.col("o.year") == F.col("m.year")),
               "left")
    share = F.col("m.renewable_share_pct")
    return j.select(
        F.col("o.entity").alias("entity"), F.col("o.year").alias("year"),
        "o.access_to_electricity_pct", "o.per_capita_elec_kwh",
        "m.total_generation_twh", "m.renewable_twh", "m.fossil_twh",
        "m.renewable_share_pct", "m.fossil_share_pct", "m.renewable_share_yoy_pp",
        "o.carbon_intensity_gco2_kwh", "o.co2_from_elec_mtco2",
        "m.geothermal_twh", "m.hydro_twh", "m.wind_twh", "m.solar_twh", "m.bioenergy_twh",
        R(share / F.lit(100.0), 4).alias("target_progress_ratio"),
        R(F.lit(100.0) - share, 1).alias("gap_to_100pct_target"),
        decade(F.col("o.year"), decade_first, decade_last).alias("decade"),
    )


def generation_by_source(unified: DataFrame, excluded: Sequence[str] = ("Imports",)) -> DataFrame:
    """M9: long table with rounded measures, renewable flag and rank within year.

    RANK orders by the unrounded generation; ties share a rank (W4).
    """
    src = unified.filter(F.col("generation_twh").isNotNull() & F.col("category").isNotNull()
                         & ~F.col("category").isin(*excluded))
    return src.select(
        "entity", "year", "source_type", "category",
        F.coalesce("color_hex", F.lit(DEFAULT_SOURCE_COLOR)).alias("color_hex"),
        R("generation_twh", 4).alias("generation_twh"),
        R("share_pct", 2).alias("share_pct"),
        R("capacity_mw", 1).alias("capacity_mw"),
        R("cuf", 3).alias("capacity_utilisation_factor"),
        flag_like("category", "renewable").alias("is_renewable"),
        rank_desc("generation_twh", ("entity", "year")).alias("rank_within_year"),
    )


# Technology word -> keyword searched in generation labels.
CUF_KEYWORDS = (("geothermal", "geothermal"), ("hydro", "hydro"), ("wind", "wind"), ("solar", "solar"))


def keyword_cuf(capacity: DataFrame, ember: DataFrame, energy_scale: float = 1e6,
                hours: float = 8760.0, indexed: bool = False) -> DataFrame:
    """Capacity rows matched to generation by (entity, year) and keyword.

    A capacity row matches every generation label of the same entity and year
    that contains its technology keyword (case-insensitive LIKE).  Generation is
    first summed per (entity, year, label), so the residual LIKE runs on one row
    per label, never on raw rows.  Unmatched capacity rows keep a NULL sum; the
    factor is clamped with LEAST/GREATEST (a NULL ratio clamps to 0.0).  ``indexed`` finds the matching labels through
    an n-gram index (``operators.substrings``), for years with very many labels and keywords.
    """
    low = F.lower(F.col("technology_raw"))
    kw = None
    for word, key in CUF_KEYWORDS:
        cond = low.contains(word)
        kw = F.when(cond, F.lit(key)) if kw is None else kw.when(cond, F.lit(key))
    cap = capacity.select("entity", "year", "technology_raw", "capacity_mw", kw.otherwise(low).alias("keyword"))
    gen = (ember.filter(F.col("variable").isNotNull())
           .groupBy("entity", "year", F.lower("variable").alias("label"))
           .agg(F.sum("value_clean").alias("gen")))
    key = ["entity", "year"]
    if indexed:
        pairs = contained(gen, cap, key, "label", "keyword").join(gen, [*key, "label"])
        j = cap.alias("l").join(pairs.alias("r"), [F.col(f"l.{k}") == F.col(f"r.{k}") for k in (*key, "keyword")], "left")
    else:
        j = keyword_join(cap, gen, key, F.col("r.label"), F.col("l.keyword"), "left")
    grouped = (j.groupBy(F.col("l.entity").alias("entity"), F.col("l.year").alias("year"),
                         F.col("l.technology_raw").alias("technology"), F.col("l.capacity_mw").alias("capacity_mw"))
               .agg(F.sum("r.gen").alias("gen_twh")))
    ratio = F.try_divide(F.col("gen_twh") * F.lit(float(energy_scale)),
                         F.col("capacity_mw") * F.lit(float(hours)))
    return grouped.withColumn("cuf", F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio)))
