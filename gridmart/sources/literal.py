"""Small fixed tables as JVM-side literal relations (no Python workers involved)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], schema: Sequence[tuple[str, str]]) -> DataFrame:
    """``rows`` of Python literals with ``schema`` [(name, spark type)] as a DataFrame.

    One ``VALUES`` relation (a single call into the JVM; Catalyst keeps it as a
    local relation), with every column cast to its declared type.
    """
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    cols = ", ".join(f"c{i}" for i in range(len(schema)))
    select = ", ".join(f"CAST(c{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(schema))
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({cols})")
