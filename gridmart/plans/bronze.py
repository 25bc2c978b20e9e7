"""Bronze assets: land raw frames with normalised headers and run metadata."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.operators.bronze import (
    add_metadata, run_timestamp, concat_by_name, drop_null_rows, filter_entity,
    filter_entity_ci, normalize_headers, resolve_column, select_existing,
)

# Column names the long statistics file may carry, and the
# ``_source`` tag written for each landed input.
LONG_CODE_CANDIDATES = ("iso_3_code", "country_code")
LONG_KEEP = ("country_code", "area", "country", "year", "category", "subcategory",
             "variable", "unit", "value", "source", "source_name", "ember_region")
LONG_SOURCE = "ember_yearly_csv"
WIDE_SOURCE = "owid_energy_github"
GEO_SOURCE = "energydata_info_ckan"


def ingest_long(raw: DataFrame, run_ts: datetime, entities=None) -> DataFrame:
    """Long statistics rows -> bronze (S1 + P1, P2, P3, P5, P6, P8).

    Headers are normalised, the code column is resolved from its known names and
    renamed ``country_code``, rows are kept for ``entities`` (None: all), the
    known columns are kept, ``year``/``value`` typed int/double (so later year
    windows push into Parquet scans of the stored table), rows without a value
    dropped, metadata stamped.  Cells that are no number count as no value
    (``operators.bronze.uncastable`` reports them); missing-value tokens are NULL
    already (``operators.bronze.null_tokens``, which the CSV readers apply).
    """
    df = normalize_headers(raw)
    df = resolve_column(df, LONG_CODE_CANDIDATES, "country_code")
    df = filter_entity(df, "country_code", entities)
    df = select_existing(df, LONG_KEEP)
    df = df.withColumns({"year": F.col("year").try_cast("int"), "value": F.col("value").try_cast("double")})
    df = drop_null_rows(df, ["value"])
    return add_metadata(df, LONG_SOURCE, run_ts)


def ingest_wide(raw: DataFrame, run_ts: datetime, entities=None,
                code_column: str = "iso_code") -> DataFrame:
    """Wide indicator rows -> bronze (S2 + P3, P8): entity filter, ``year`` as int, metadata.

    All-NULL columns (P7) are dropped on the stored table (``plans.build``), where counting
    reads columns and starts no second parse.  Silver gives a typed NULL for any missing
    column, so dropping one cannot change a silver value.
    """
    df = filter_entity(raw, code_column, entities)
    df = df.withColumn("year", F.col("year").try_cast("int"))
    return add_metadata(df, WIDE_SOURCE, run_ts)


def country_codes(raw_long: DataFrame) -> DataFrame:
    """``name_key`` (trimmed, lower-cased country name) -> ``country_code``, from the long table's pairs.

    A name with several codes keeps the smallest; codes combine map-side, so a country's many
    rows cost one row per task."""
    names = [c for c in ("country", "area") if c in raw_long.columns]
    name = F.lower(F.trim(F.coalesce(*names)))
    return (raw_long.select(name.alias("name_key"), "country_code").dropna()
            .groupBy("name_key").agg(F.min("country_code").alias("country_code")))


def ingest_capacity(raw: DataFrame, source_tag: str, run_ts: datetime,
                    country_names: Sequence[str] | None = None, codes: DataFrame | None = None) -> DataFrame:
    """Capacity rows -> bronze (S3 + P4): case-insensitive country filter, ``year``
    and ``capacity_mw`` typed int/double.

    A file that names countries but gives no codes needs ``codes`` (see :func:`country_codes`): generation is
    keyed by code, and capacity keyed by name would never meet it.  A name that ``codes`` does not
    have gets a NULL code, which ``plans.build`` refuses.
    """
    df = filter_entity_ci(raw, "country", country_names)
    if "country_code" not in df.columns:
        if codes is None:
            raise KeyError("capacity rows carry no country_code and no name-to-code pairs were given")
        df = (df.withColumn("name_key", F.lower(F.trim("country"))).join(codes, "name_key", "left").drop("name_key"))
    return df.withColumns({"year": F.col("year").try_cast("int"),
                           "capacity_mw": F.col("capacity_mw").try_cast("double"),
                           "_source": F.lit(source_tag),
                           "_ingested_at": run_timestamp(run_ts)})


def ingest_geo(frames: Sequence[DataFrame], run_ts: datetime, spark=None) -> DataFrame:
    """Tagged geo frames (features and station rows) -> one bronze table."""
    from gridmart.sources.files import GEO_COLUMNS
    df = concat_by_name(frames, empty_schema=GEO_COLUMNS, spark=spark)
    return add_metadata(df, GEO_SOURCE, run_ts)
