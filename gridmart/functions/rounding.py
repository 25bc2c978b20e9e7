"""The two rounding modes the pipeline needs.

* SQL assets round like ``ROUND(x, n)`` in an embedded SQL engine: scale by
  10**n, round half away from zero, unscale.  Spark's ``F.round(x, n)`` rounds the
  shortest decimal string of ``x`` instead (``round(1.005, 2)`` gives 1.01 there,
  1.0 here), so it is applied to the scaled value with 0 digits.
* The unified staging table rounds like numpy: scale, round half to even
  (``rint``), unscale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_away(x, digits: int) -> Column:
    scale = F.lit(float(10 ** digits))
    return F.round(_c(x) * scale, 0) / scale


def round_half_even(x, digits: int) -> Column:
    scale = F.lit(float(10 ** digits))
    return F.rint(_c(x) * scale) / scale
