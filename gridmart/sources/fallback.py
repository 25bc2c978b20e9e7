"""Curated capacity records used when no capacity file has been landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.sources.literal import literal_frame

# Curated end-of-year installed capacity (technology, year, MW)
# for the default entity, used verbatim as the fallback capacity table.
FALLBACK_ENTITY = "KEN"
FALLBACK_COUNTRY = "Kenya"
FALLBACK_UNIT = "MW"
FALLBACK_DATA_SOURCE = "irena_manual_verified"
FALLBACK_CAPACITY = [
    ("Geothermal energy", 2000, 45), ("Geothermal energy", 2005, 129),
    ("Geothermal energy", 2010, 167), ("Geothermal energy", 2015, 594),
    ("Geothermal energy", 2016, 636), ("Geothermal energy", 2017, 661),
    ("Geothermal energy", 2018, 823), ("Geothermal energy", 2019, 863),
    ("Geothermal energy", 2020, 863), ("Geothermal energy", 2021, 863),
    ("Geothermal energy", 2022, 929), ("Geothermal energy", 2023, 929),
    ("Geothermal energy", 2024, 929),
    ("Hydropower", 2000, 677), ("Hydropower", 2005, 677),
    ("Hydropower", 2010, 766), ("Hydropower", 2015, 826),
    ("Hydropower", 2016, 826), ("Hydropower", 2017, 826),
    ("Hydropower", 2018, 836), ("Hydropower", 2019, 836),
    ("Hydropower", 2020, 836), ("Hydropower", 2021, 836),
    ("Hydropower", 2022, 836), ("Hydropower", 2023, 836),
    ("Hydropower", 2024, 836),
    ("Onshore wind energy", 2000, 0), ("Onshore wind energy", 2015, 0),
    ("Onshore wind energy", 2017, 0), ("Onshore wind energy", 2018, 0),
    ("Onshore wind energy", 2019, 310), ("Onshore wind energy", 2020, 310),
    ("Onshore wind energy", 2021, 435), ("Onshore wind energy", 2022, 435),
    ("Onshore wind energy", 2023, 435), ("Onshore wind energy", 2024, 435),
    ("Solar photovoltaic", 2000, 0), ("Solar photovoltaic", 2015, 1),
    ("Solar photovoltaic", 2018, 51), ("Solar photovoltaic", 2019, 51),
    ("Solar photovoltaic", 2020, 91), ("Solar photovoltaic", 2021, 156),
    ("Solar photovoltaic", 2022, 233), ("Solar photovoltaic", 2023, 233),
    ("Solar photovoltaic", 2024, 283),
    ("Bioenergy", 2000, 0), ("Bioenergy", 2015, 5),
    ("Bioenergy", 2019, 5), ("Bioenergy", 2020, 5),
    ("Bioenergy", 2021, 5), ("Bioenergy", 2022, 5),
    ("Bioenergy", 2023, 5), ("Bioenergy", 2024, 5),
]


def fallback_capacity(spark: SparkSession) -> DataFrame:
    """The curated records as a bronze capacity frame (53 rows, fixed size)."""
    df = literal_frame(spark, [(t, y, float(mw)) for t, y, mw in FALLBACK_CAPACITY],
                       [("technology", "string"), ("year", "int"), ("capacity_mw", "double")])
    return df.withColumns({
        "country": F.lit(FALLBACK_COUNTRY),
        "country_code": F.lit(FALLBACK_ENTITY),
        "unit": F.lit(FALLBACK_UNIT),
        "data_source": F.lit(FALLBACK_DATA_SOURCE),
    })
