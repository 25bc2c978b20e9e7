"""Incremental refresh of the stored unified table and marts (M5-M9) from changed (entity, year) keys.

A changed key is one whose source rows were added, altered or removed.  Rows of the unified table, the KPIs and the source ranking
depend on the source rows of their own (entity, year) alone.  Rows of the mix and of the capacity trend read, by their LAG, the
row of the entity's previous present year, too: so the change of a year reaches the entity's next present year.

For a table, the affected keys give the affected years; the rows of those years that are not affected are read from the stored table,
the affected ones are built again by the same function that builds the whole table, from the source rows of the affected keys (and, with
a LAG, of the present years before them), and only the affected years' partitions are rewritten
(``sources.tables.replace_partitions``).  Sources that are partitioned by year are read in those years only.

Keys are one row for each entity and year, never raw rows; what the driver gets is lists of years.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.plans import gold
from gridmart.session import checkpoint_dir
from gridmart.sources import tables

KEY = ["entity", "year"]


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys whose rows differ between two versions of a table: by count and by two sums of row hashes."""
    columns = [F.col(f"`{c}`") for c in old.columns]

    def summary(df: DataFrame) -> DataFrame:
        h = F.xxhash64(*columns)
        wide = F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(20,0)"))
        return df.groupBy(*KEY).agg(F.struct(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), wide).alias("s"))

    a, b = summary(old).withColumnRenamed("s", "a"), summary(new).withColumnRenamed("s", "b")
    return a.join(b, KEY, "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select(*KEY)


def years_of(keys: DataFrame) -> list[int]:
    return sorted(r["year"] for r in keys.select("year").distinct().collect())


def in_years(df: DataFrame, years: Sequence[int]) -> DataFrame:
    return df.filter(F.col("year").isin(*years)) if years else df.limit(0)


def of_keys(df: DataFrame, keys: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """The rows of ``df`` with these keys; the years are in the plan, so that partitions are pruned."""
    return in_years(df, years_of(keys) if years is None else years).join(keys, KEY, "left_semi")


def fixed(keys: DataFrame) -> DataFrame:
    """``keys`` as they are now, in the shared checkpoint folder: what they were read from may be replaced."""
    checkpoint_dir(keys.sparkSession)
    return keys.checkpoint()


def with_next(changed: DataFrame, present: DataFrame) -> DataFrame:
    """``changed`` and, of each, the entity's next present year."""
    later = changed.join(present.select("entity", F.col("year").alias("_later")), "entity").filter(F.col("_later") > F.col("year"))
    following = later.groupBy(*KEY).agg(F.min("_later").alias("_next")).select("entity", F.col("_next").alias("year"))
    return changed.unionByName(following).distinct()


def with_previous(keys: DataFrame, present: DataFrame) -> DataFrame:
    """``keys`` and, of each, the entity's previous present year."""
    earlier = keys.join(present.select("entity", F.col("year").alias("_earlier")), "entity").filter(F.col("_earlier") < F.col("year"))
    before = earlier.groupBy(*KEY).agg(F.max("_earlier").alias("_before")).select("entity", F.col("_before").alias("year"))
    return keys.unionByName(before).distinct()


class Stored:
    """A stored table (partitioned by year), by its place and the name it has in the catalog."""

    def __init__(self, spark, path: str, table: str | None = None):
        self.spark, self.path, self.table = spark, path, table

    def read(self) -> DataFrame:
        return tables.read(self.spark, self.path)

    def keys(self) -> DataFrame:
        return self.read().select(*KEY).distinct()

    def replace(self, affected: DataFrame, rebuilt: DataFrame) -> None:
        """Rows of the ``affected`` keys give way to ``rebuilt``."""
        years = years_of(affected)
        kept = in_years(self.read(), years).join(affected, KEY, "left_anti")
        columns = [F.col(f"`{c}`") for c in kept.columns]
        tables.replace_partitions(kept.unionByName(rebuilt.select(*columns)), self.path, "year", years, self.table)
        tables.compact(self.spark, self.path, table=self.table)


def refresh_by_key(stored: Stored, build: Callable[..., DataFrame], sources: Sequence[DataFrame], changed: DataFrame) -> DataFrame:
    """A table whose rows depend on their own key's source rows; returns the affected keys."""
    years = years_of(changed)
    if years:
        stored.replace(changed, build(*[of_keys(s, changed, years) for s in sources]))
    return changed


def refresh_with_lag(stored: Stored, build: Callable[..., DataFrame], sources: Sequence[DataFrame], changed: DataFrame,
                     present: Callable[..., DataFrame]) -> DataFrame:
    """A table whose rows also read the row of the entity's previous present year; returns the affected keys.

    ``present(*sources)`` gives the keys that the sources make rows for.  Those of unchanged keys are read from the stored table's
    keys; only changed years are read from the sources to see which are there now."""
    years = years_of(changed)
    if not years:
        return changed
    now = present(*[of_keys(s, changed, years) for s in sources]).select(*KEY).distinct()
    there = fixed(stored.keys().join(changed, KEY, "left_anti").unionByName(now))
    affected = fixed(with_next(changed, there))
    needed = fixed(with_previous(affected, there))
    read = years_of(needed)
    rebuilt = build(*[of_keys(s, needed, read) for s in sources]).join(affected, KEY, "left_semi")
    stored.replace(affected, rebuilt)
    return affected


def mix_present(unified: DataFrame) -> DataFrame:
    return unified.filter(F.col("category").isNotNull())


def refresh_mix(stored: Stored, unified: DataFrame, changed: DataFrame) -> DataFrame:
    """M6."""
    return refresh_with_lag(stored, gold.renewable_mix, [unified], changed, mix_present)


def refresh_capacity_trend(stored: Stored, capacity: DataFrame, unified: DataFrame, changed: DataFrame) -> DataFrame:
    """M7.  Years come from the capacity table; the utilisation of a year joins from the unified table."""
    return refresh_with_lag(stored, gold.capacity_trend, [capacity, unified], changed, lambda cap, _: cap)


def refresh_kpis(stored: Stored, context: DataFrame, mix: DataFrame, changed: DataFrame, mix_affected: DataFrame,
                 *params) -> DataFrame:
    """M8: the keys whose indicators changed, and those whose row of the mix did."""
    keys = fixed(changed.unionByName(mix_affected).distinct())
    return refresh_by_key(stored, lambda c, m: gold.energy_kpis(c, m, *params), [context, mix], keys)


def refresh_generation_by_source(stored: Stored, unified: DataFrame, changed: DataFrame) -> DataFrame:
    """M9."""
    return refresh_by_key(stored, gold.generation_by_source, [unified], changed)

