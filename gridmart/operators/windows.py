"""Window operators, always partitioned by entity.

The reference windows run over the whole table (one country); here the frame is
``partitionBy(entity).orderBy(year)`` so every entity is an independent window
partition instead of Spark's single-partition global window.  Inputs are yearly
aggregates (one row per entity and year), so a partition holds at most one row
per year even when one entity owns a large share of the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_entity(keys: Sequence[str], order: str | Column = "year"):
    return Window.partitionBy(*keys).orderBy(order)


def lag_of(x: Column | str, keys: Sequence[str] = ("entity",), order: str = "year") -> Column:
    """Previous present row's value (row-to-row, not calendar: gaps are skipped)."""
    c = F.col(x) if isinstance(x, str) else x
    return F.lag(c).over(by_entity(keys, order))


def rank_desc(x: str, keys: Sequence[str]) -> Column:
    """RANK (ties share, gaps after) by ``x`` descending inside ``keys``; as bigint."""
    return F.rank().over(Window.partitionBy(*keys).orderBy(F.col(x).desc())).cast("bigint")


def latest_per(df: DataFrame, keys: Sequence[str] = ("entity",), order: str = "year") -> DataFrame:
    """Latest row per key (ORDER BY order DESC LIMIT 1, for every key at once), combined map-side: a key's rows never meet."""
    rows = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = F.struct(F.col(order).isNotNull(), F.col(order))          # a row without ``order`` comes last
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max_by(rows, first).alias("__row")).select("__row.*")
