"""Row-level business rules as Column expressions (JVM-side, codegen'd).

NULL behaviour follows SQL three-valued logic throughout: a ``when`` whose
condition is NULL falls through to the next branch / ``otherwise``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.functions.rounding import round_half_away, round_half_even

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference pipeline's rules).
# ---------------------------------------------------------------------------

# Variables whose negative TWh values are legitimate (not nulled by clean_value).
SIGNED_VARIABLES = ("Net Imports", "Demand")

# Subcategories that mark a fossil row (compared lower-cased, untrimmed).
FOSSIL_SUBCATEGORIES = ("gas", "oil", "coal", "other fossil")

# Technology label rules, checked top to bottom; first match wins; the label is
# matched lower-cased by substring.  No match keeps the trimmed raw label.
TECHNOLOGY_RULES = (
    ("Geothermal", ("geothermal",)),
    ("Hydro", ("hydropower", "hydro")),
    ("Wind", ("onshore wind", "wind")),
    ("Solar PV", ("solar photovoltaic", "solar pv")),
    ("Solar Thermal", ("solar thermal",)),
    ("Bioenergy", ("bioenergy", "biomass")),
    ("Marine", ("marine", "ocean")),
)

# Technology group rules, same matching; no match gives the default group.
TECH_GROUP_RULES = (
    ("Geothermal", ("geothermal",)),
    ("Hydro", ("hydro",)),
    ("Wind", ("wind",)),
    ("Solar", ("solar",)),
    ("Bioenergy", ("bio",)),
)
TECH_GROUP_DEFAULT = "Other Renewables"

# Strings accepted as TRUE by parse_bool (after trim + lower).
TRUE_STRINGS = ("true", "1", "yes")

# Map colours of the three named transmission networks, and the fallback.
LINE_COLORS = (
    ("220kV Network", "#c0392b"),
    ("132kV Network", "#e74c3c"),
    ("66kV Network", "#e67e22"),
)
LINE_COLOR_DEFAULT = "#95a5a6"

# Default colour for a source without a category colour.
DEFAULT_SOURCE_COLOR = "#888780"

# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag_like(x, needle: str) -> Column:
    """TRUE when lower(x) contains ``needle``; NULL input gives FALSE."""
    return F.when(F.lower(_c(x)).contains(needle), F.lit(True)).otherwise(F.lit(False))


def flag_fossil(category, subcategory) -> Column:
    cond = F.lower(_c(category)).contains("fossil") | F.lower(_c(subcategory)).isin(*FOSSIL_SUBCATEGORIES)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def clean_value(value, unit, variable) -> Column:
    """Negative TWh becomes NULL unless the variable is signed; else round to 6 dp.

    ``unit`` is compared untrimmed and ``variable`` trimmed; a NULL variable makes
    the NOT IN unknown, so the value is kept.
    """
    v = _c(value).cast("double")
    bad = (v < 0) & (_c(unit) == F.lit("TWh")) & ~F.trim(_c(variable)).isin(*SIGNED_VARIABLES)
    return F.when(bad, F.lit(None).cast("double")).otherwise(round_half_away(v, 6))


def _ordered_like(x, rules: Sequence, default: Column) -> Column:
    low = F.lower(_c(x))
    expr = None
    for label, needles in rules:
        cond = None
        for n in needles:
            c = low.contains(n)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(default)


def map_technology(technology) -> Column:
    return _ordered_like(technology, TECHNOLOGY_RULES, F.trim(_c(technology)))


def tech_group(technology) -> Column:
    return _ordered_like(technology, TECH_GROUP_RULES, F.lit(TECH_GROUP_DEFAULT))


def parse_bool(x) -> Column:
    s = F.lower(F.trim(_c(x).cast("string")))
    return F.when(s.isin(*TRUE_STRINGS), F.lit(True)).otherwise(F.lit(False))


def decade(year, first: int = 2000, last: int = 2020) -> Column:
    """'2000s' for first..first+9, ..., '<last>s' for every year >= last; else NULL."""
    y = _c(year)
    expr = None
    for d in range(first, last, 10):
        cond = y.between(d, d + 9)
        expr = F.when(cond, F.lit(f"{d}s")) if expr is None else expr.when(cond, F.lit(f"{d}s"))
    cond = y >= last
    expr = F.when(cond, F.lit(f"{last}s")) if expr is None else expr.when(cond, F.lit(f"{last}s"))
    return expr


def cuf(generation, capacity, energy_scale: float = 1e6, hours: float = 8760.0) -> Column:
    """Capacity utilisation factor, 4 dp half-even, clamped to [0, 1].

    ``generation * energy_scale / (capacity * hours)``; defaults turn TWh and MW
    into a fraction of a year at nameplate.  NULL when either input is NULL.  With
    zero capacity the ratio is infinite (1.0 after clamping, 0.0 if negative) or
    undefined (NULL) for zero generation.
    """
    g, cap = _c(generation), _c(capacity)
    ratio = round_half_even((g * F.lit(float(energy_scale))) / (cap * F.lit(float(hours))), 4)
    clamped = F.least(F.greatest(ratio, F.lit(0.0)), F.lit(1.0))
    return (F.when(g.isNull() | cap.isNull(), F.lit(None).cast("double"))
            .when(cap == 0, F.when(g > 0, F.lit(1.0)).when(g < 0, F.lit(0.0)))
            .otherwise(clamped))


def line_color(resource_name) -> Column:
    r = _c(resource_name)
    expr = None
    for name, color in LINE_COLORS:
        expr = F.when(r == name, F.lit(color)) if expr is None else expr.when(r == name, F.lit(color))
    return expr.otherwise(F.lit(LINE_COLOR_DEFAULT))
