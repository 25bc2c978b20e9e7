"""Declarative column checks (not_null, unique, accepted_range) as Spark jobs.

``run_checks`` returns one row per check: (table_name, column_name, check_name,
violations, passed).  Range bounds are inclusive and NULL passes a range check;
``unique`` ignores NULL keys and counts the rows whose key occurs more than once.
Checks report, they never stop a build.

All not_null and range checks of one table run in a single aggregation pass
(partial sums per task), or are observed by the job that writes the table (``observed``, ``report``): then no second read is needed.  Each unique check is one ``groupBy(key).count()``,
which also combines map-side, so a hot key costs one row per task, not one
task for all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECK_SCHEMA = "table_name string, column_name string, check_name string, violations bigint, passed boolean"


@dataclass(frozen=True)
class Check:
    column: str  # for unique: comma-separated key columns
    kind: str  # "not_null" | "unique" | "accepted_range"
    min: float | None = None
    max: float | None = None

    @property
    def name(self) -> str:
        if self.kind == "accepted_range":
            return f"accepted_range[{self.min},{self.max}]"
        return self.kind


def not_null(column: str) -> Check:
    return Check(column, "not_null")


def unique(*columns: str) -> Check:
    """Key uniqueness; several columns form a composite key (e.g. entity, year)."""
    return Check(",".join(columns), "unique")


def accepted_range(column: str, lo=None, hi=None) -> Check:
    return Check(column, "accepted_range", lo, hi)


def _range_violation(c, lo, hi):
    bad = None
    if lo is not None:
        bad = c < lo
    if hi is not None:
        bad = (c > hi) if bad is None else (bad | (c > hi))
    return F.when(bad, F.lit(1)).otherwise(F.lit(0))


def _scalar(checks: Sequence[Check]) -> list[Check]:
    return [c for c in checks if c.kind in ("not_null", "accepted_range")]


def _violation(check: Check):
    """1 for a row that fails a not_null or range check, else 0."""
    col = F.col(check.column)
    if check.kind == "not_null":
        return F.when(col.isNull(), F.lit(1)).otherwise(F.lit(0))
    return _range_violation(col, check.min, check.max)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    spark = df.sparkSession
    parts: list[DataFrame] = []
    scalar = _scalar(checks)
    if scalar:
        aggs = [F.coalesce(F.sum(_violation(c)), F.lit(0)).cast("bigint").alias(f"v{i}") for i, c in enumerate(scalar)]
        wide = df.agg(*aggs)
        stack = ", ".join(
            f"'{table}', '{c.column}', '{c.name}', v{i}" for i, c in enumerate(scalar))
        parts.append(wide.selectExpr(
            f"stack({len(scalar)}, {stack}) AS (table_name, column_name, check_name, violations)"))
    for c in checks:
        if c.kind != "unique":
            continue
        keys = c.column.split(",")
        present = F.lit(True)
        for k in keys:
            present = present & F.col(k).isNotNull()
        dup = (df.filter(present).groupBy(*keys).count()
               .filter(F.col("count") > 1)
               .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("violations")))
        parts.append(dup.select(F.lit(table).alias("table_name"), F.lit(c.column).alias("column_name"),
                                F.lit(c.name).alias("check_name"), "violations"))
    if not parts:
        return spark.createDataFrame([], CHECK_SCHEMA)
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("passed", F.col("violations") == 0)


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation | None]:
    """``df`` with its not_null and range checks counted as the rows pass by, in whichever job writes them."""
    scalar = _scalar(checks)
    if not scalar:
        return df, None
    told = Observation()
    return df.observe(told, *[F.coalesce(F.sum(_violation(c)), F.lit(0)).cast("bigint").alias(f"v{i}") for i, c in enumerate(scalar)]), told


def report(table: str, checks: Sequence[Check], told: Observation | None, stored: DataFrame) -> list[tuple]:
    """The rows of ``run_checks`` from what was ``observed`` (after the write); unique checks read their key columns of the stored table."""
    counts = told.get if told is not None else {}
    rows = [(table, c.column, c.name, counts[f"v{i}"], counts[f"v{i}"] == 0) for i, c in enumerate(_scalar(checks))]
    rest = [c for c in checks if c.kind == "unique"]
    return rows + ([tuple(r) for r in run_checks(stored, table, rest).collect()] if rest else [])


def run_table_checks(tables: dict[str, DataFrame], specs: dict[str, Sequence[Check]],
                     spark: SparkSession | None = None) -> DataFrame:
    """Run every table's checks and stack the reports (C4: checks-only run)."""
    parts = [run_checks(tables[name], name, checks) for name, checks in specs.items()]
    if not parts:
        return spark.createDataFrame([], CHECK_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), parts)
