"""UTM -> WGS84 (longitude, latitude) as plain Column arithmetic.

Inverse transverse Mercator by the Krueger series to third order in the third
flattening n (the form given in public references on UTM).  It is an ordinary
Spark expression: no UDF, no projection library, vectorised in whole-stage
codegen, and usable inside ``transform`` lambdas over coordinate arrays.
Accuracy of the third-order series is well below a millimetre inside a zone.  With ``order=6`` the series go to the sixth order, and
``wgs84_to_utm`` is the way back: a round trip is exact to below 1e-9 degrees up to 6 degrees from the central meridian.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid and UTM grid constants.
WGS84_A = 6378137.0
WGS84_INV_F = 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0

_f = 1.0 / WGS84_INV_F
_n = _f / (2.0 - _f)
RECT_A = WGS84_A / (1.0 + _n) * (1.0 + _n ** 2 / 4.0 + _n ** 4 / 64.0)
BETA = (
    _n / 2.0 - 2.0 * _n ** 2 / 3.0 + 37.0 * _n ** 3 / 96.0,
    _n ** 2 / 48.0 + _n ** 3 / 15.0,
    17.0 * _n ** 3 / 480.0,
)
DELTA = (
    2.0 * _n - 2.0 * _n ** 2 / 3.0 - 2.0 * _n ** 3,
    7.0 * _n ** 2 / 3.0 - 8.0 * _n ** 3 / 5.0,
    56.0 * _n ** 3 / 15.0,
)
# The series to the sixth order; row j holds the coefficients of n**j, n**(j+1), ...
ALPHA6 = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
BETA6 = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)
DELTA6 = (
    (2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675),
    (7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945),
    (56 / 15, -136 / 35, -1262 / 105, 73814 / 2835),
    (4279 / 630, -332 / 35, -399572 / 14175),
    (4174 / 315, -144838 / 6237),
    (601676 / 22275,),
)
RECT_A6 = WGS84_A / (1.0 + _n) * (1.0 + _n ** 2 / 4.0 + _n ** 4 / 64.0 + _n ** 6 / 256.0)
ECCENTRICITY = math.sqrt(_f * (2.0 - _f))


def _series(rows: tuple) -> tuple[float, ...]:
    return tuple(sum(c * _n ** (j + i) for i, c in enumerate(row)) for j, row in enumerate(rows, start=1))


SERIES = {3: (BETA, DELTA, RECT_A), 6: (_series(BETA6), _series(DELTA6), RECT_A6)}
ALPHA = _series(ALPHA6)
RAD_TO_DEG = 180.0 / math.pi
K0A = UTM_K0 * RECT_A


def central_meridian(zone: int) -> float:
    return float(zone * 6 - 183)


def _lit(x: float) -> Column:
    return F.lit(float(x))


def utm_prime(easting, northing, south: bool | Column = True, order: int = 3) -> tuple[Column, Column]:
    """Stage 1: grid coordinates -> (xi', eta') on the conformal sphere; ``south`` may be a column."""
    beta, _, rect = SERIES[order]
    e = F.col(easting) if isinstance(easting, str) else easting
    n = F.col(northing) if isinstance(northing, str) else northing
    if isinstance(south, Column):
        n0 = F.when(south, _lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(_lit(0.0))
    else:
        n0 = _lit(UTM_FALSE_NORTHING_SOUTH if south else 0.0)
    xi = (n - n0) / _lit(UTM_K0 * rect)
    eta = (e - _lit(UTM_FALSE_EASTING)) / _lit(UTM_K0 * rect)
    xi_p = xi
    eta_p = eta
    for j, b in enumerate(beta, start=1):
        xi_p = xi_p - _lit(b) * F.sin(_lit(2 * j) * xi) * F.cosh(_lit(2 * j) * eta)
        eta_p = eta_p - _lit(b) * F.cos(_lit(2 * j) * xi) * F.sinh(_lit(2 * j) * eta)
    return xi_p, eta_p


def prime_to_lnglat(xi_p: Column, eta_p: Column, zone: int | Column = 37, order: int = 3) -> tuple[Column, Column]:
    """Stage 2: (xi', eta') -> (lng, lat) in degrees; ``zone`` may be a column."""
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    phi = chi
    for j, d in enumerate(SERIES[order][1], start=1):
        phi = phi + _lit(d) * F.sin(_lit(2 * j) * chi)
    lam = F.atan2(F.sinh(eta_p), F.cos(xi_p))
    meridian = (zone * 6 - 183).cast("double") if isinstance(zone, Column) else _lit(central_meridian(zone))
    lng = meridian + lam * _lit(RAD_TO_DEG)
    lat = phi * _lit(RAD_TO_DEG)
    return lng, lat


def utm_to_wgs84(easting, northing, zone: int = 37, south: bool = True, order: int = 3) -> tuple[Column, Column]:
    """Return ``(lng, lat)`` in degrees for UTM ``zone`` (EPSG:327xx when south)."""
    xi_p, eta_p = utm_prime(easting, northing, south, order)
    return prime_to_lnglat(xi_p, eta_p, zone, order)


def lnglat_to_prime(lng, lat, zone: int | Column = 37) -> tuple[Column, Column]:
    """Way back, stage 1: degrees -> (xi', eta') on the conformal sphere, by the exact conformal latitude."""
    lng = F.col(lng) if isinstance(lng, str) else lng
    lat = F.col(lat) if isinstance(lat, str) else lat
    meridian = (zone * 6 - 183).cast("double") if isinstance(zone, Column) else _lit(central_meridian(zone))
    lam = (lng - meridian) / _lit(RAD_TO_DEG)
    sin = F.sin(lat / _lit(RAD_TO_DEG))
    # of the latitude and of the conformal one: the inverse hyperbolic tangents of their sines
    tau = F.sinh(F.atanh(sin) - _lit(ECCENTRICITY) * F.atanh(_lit(ECCENTRICITY) * sin))
    return F.atan2(tau, F.cos(lam)), F.asinh(F.sin(lam) / F.sqrt(tau * tau + F.cos(lam) * F.cos(lam)))


def prime_to_utm(xi_p: Column, eta_p: Column, south: bool | Column = True) -> tuple[Column, Column]:
    """Way back, stage 2: (xi', eta') -> (easting, northing), to the sixth order."""
    xi, eta = xi_p, eta_p
    for j, a in enumerate(ALPHA, start=1):
        xi = xi + _lit(a) * F.sin(_lit(2 * j) * xi_p) * F.cosh(_lit(2 * j) * eta_p)
        eta = eta + _lit(a) * F.cos(_lit(2 * j) * xi_p) * F.sinh(_lit(2 * j) * eta_p)
    if isinstance(south, Column):
        n0 = F.when(south, _lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(_lit(0.0))
    else:
        n0 = _lit(UTM_FALSE_NORTHING_SOUTH if south else 0.0)
    return eta * _lit(UTM_K0 * RECT_A6) + _lit(UTM_FALSE_EASTING), xi * _lit(UTM_K0 * RECT_A6) + n0


def wgs84_to_utm(lng, lat, zone: int | Column = 37, south: bool | Column = True) -> tuple[Column, Column]:
    """Return ``(easting, northing)`` of degrees in UTM ``zone``."""
    return prime_to_utm(*lnglat_to_prime(lng, lat, zone), south)
