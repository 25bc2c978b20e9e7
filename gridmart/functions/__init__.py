"""Column-expression functions: rounding modes, business rules, geodesy."""

from gridmart.functions.rounding import round_half_away, round_half_even
from gridmart.functions.rules import (
    clean_value, cuf, decade, flag_fossil, flag_like, line_color, map_technology,
    parse_bool, tech_group,
)
from gridmart.functions.geo import utm_to_wgs84

__all__ = [
    "round_half_away", "round_half_even", "clean_value", "cuf", "decade", "flag_fossil",
    "flag_like", "line_color", "map_technology", "parse_bool", "tech_group", "utm_to_wgs84",
]
