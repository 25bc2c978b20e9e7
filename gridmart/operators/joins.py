"""Join helpers.  No broadcast hints are given: Spark broadcasts a side whose planned
or measured size is below the thresholds set in ``gridmart.session``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyword_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                 text: Column, keyword: Column, how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` plus the residual ``text LIKE '%' || keyword || '%'``.

    The equality keys drive a hash/sort-merge join; the substring test is a
    residual condition evaluated only on matching key pairs, so no cross product
    is ever formed.  ``text`` and ``keyword`` refer to the sides through the
    aliases ``l`` and ``r`` (e.g. ``F.col("r.text")``).
    """
    l, r = left.alias("l"), right.alias("r")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on]
    cond.append(text.contains(keyword))
    return l.join(r, cond, how)
