"""Bronze (landing) operators: schema normalisation, entity filters, metadata.

Header handling works on ``df.columns`` only (driver-side metadata, no data
movement); everything else is a narrow projection or filter that Catalyst pushes
into the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_name(name: str, strip: bool = True) -> str:
    """lower-case, spaces to ``_``, then (``strip``) drop every char outside [a-z0-9_]."""
    out = name.lower().replace(" ", "_")
    return re.sub(r"[^a-z0-9_]", "", out) if strip else out


def normalize_headers(df: DataFrame, strip: bool = True) -> DataFrame:
    """Rename all columns to snake case (P1).  ``strip=False`` only lowers and
    replaces spaces, the lighter variant used for API capacity responses."""
    return df.toDF(*[normalize_name(c, strip) for c in df.columns])


def resolve_column(df: DataFrame, candidates: Sequence[str], target: str) -> DataFrame:
    """Rename the first existing candidate to ``target`` (P2); error if none exists."""
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        raise KeyError(f"none of {list(candidates)} in columns {df.columns}")
    return df if found == target else df.withColumnRenamed(found, target)


# Cells that stand for a missing value in landed CSV files.
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                  "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def null_tokens(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value tokens in string columns become NULL (exact match, as landed)."""
    text = [c for c, kind in df.dtypes if kind == "string" and (columns is None or c in columns)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*MISSING_TOKENS), F.col(f"`{c}`")) for c in text})


def uncastable(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per column: ``column_name``, ``uncastable`` = cells that are not NULL and no value of the
    column's type (they become NULL when cast)."""
    counts = [F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), 1)).alias(c) for c, kind in columns.items()]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("uncastable")) for c in columns])
    return df.agg(*counts).select(F.inline(pairs))


def filter_entity(df: DataFrame, column: str, values) -> DataFrame:
    """Keep rows whose ``column`` equals one of ``values``.

    ``values`` may be a list (pushed into the scan as an IN filter) or a
    single-column DataFrame of wanted keys (left-semi join, any size).
    ``None`` keeps every entity.
    """
    if values is None:
        return df
    if isinstance(values, DataFrame):
        key = values.columns[0]
        wanted = values.select(F.col(key).alias("__key")).distinct()
        return df.join(wanted, df[column] == wanted["__key"], "left_semi")
    return df.filter(F.col(column).isin(list(values)))


def filter_entity_ci(df: DataFrame, column: str, values: Iterable[str] | None) -> DataFrame:
    """Case-insensitive equality filter."""
    if values is None:
        return df
    return df.filter(F.lower(F.col(column)).isin([v.lower() for v in values]))


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project the listed columns that exist, in list order (P5)."""
    return df.select(*[c for c in names if c in df.columns])


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row per column: ``column_name``, ``non_null`` (P7's counts), in one aggregation pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null"))
                                            for i, c in enumerate(df.columns)])))


def drop_all_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns that hold no non-NULL value.

    The columns of the result depend on the data, so this runs a job: use it on a stored
    table, where counting reads each column once.  Only the per-column counts reach the driver.
    """
    empty = [r["column_name"] for r in non_null_counts(df).filter("non_null = 0").collect()]
    empty = [c for c in empty if c not in keep]
    return df.drop(*empty) if empty else df


def run_timestamp(run_ts: datetime) -> Column:
    """The run time as a ``timestamp_ntz`` literal, independent of any time zone setting."""
    return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def add_metadata(df: DataFrame, source: str, run_ts: datetime) -> DataFrame:
    """Stamp ``_ingested_at`` (one run timestamp, reproducible reruns) and ``_source``."""
    return df.withColumns({
        "_ingested_at": run_timestamp(run_ts),
        "_source": F.lit(source),
    })


def tag_resource(df: DataFrame, dataset: str, resource_name: str | None = None,
                 resource_id: str | None = None, grid: tuple[int, bool] | None = None) -> DataFrame:
    """Attach dataset / resource identifiers to landed geo rows (P9); ``grid`` is the layer's UTM
    zone (0: already degrees) and whether it lies south of the equator."""
    tags = {
        "dataset": F.lit(dataset).cast("string"),
        "resource_name": F.lit(resource_name).cast("string"),
        "resource_id": F.lit(resource_id).cast("string"),
    }
    if grid is not None:
        tags |= {"grid_zone": F.lit(grid[0]).cast("int"), "grid_south": F.lit(grid[1]).cast("boolean")}
    return df.withColumns(tags)


def concat_by_name(frames: Sequence[DataFrame], empty_schema=None, spark=None) -> DataFrame:
    """Stack frames of unequal columns by name; missing columns become NULL.

    With no frames, return an empty frame of ``empty_schema``.
    """
    frames = list(frames)
    if not frames:
        if spark is None or empty_schema is None:
            raise ValueError("no frames and no empty schema")
        return spark.createDataFrame([], empty_schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def col_or_null(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """``df[name]`` when present, else a typed NULL (a column dropped upstream)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)
