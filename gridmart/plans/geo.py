"""Geo marts (M10-M12, G1-G5) and the GeoJSON feature export.

All row work is narrow (filter + Column arithmetic, no shuffle); only the
infrastructure counts aggregate, with map-side partial counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.geo import prime_to_lnglat, utm_prime
from gridmart.functions.rounding import round_half_away as R
from gridmart.functions.rules import line_color

# Property keys of the landed layers, the mapped networks, labels.
PROP_STATION_NAME = "name_ims11"
PROP_COUNTY = "county2"
PROP_OWNER = "ownershi23"
PROP_SOURCE = "source"
PROP_STATUS = "status"
PROP_MANNED = "manned50"
PROP_VOLTAGE = "voltage47"
LINE_NETWORKS = ("220kV Network", "132kV Network", "66kV Network")
POINT_FEATURE_TYPE = "Substation"
EMPTY_GEOMETRIES = ("null", "[]")
UTM_ZONE, UTM_SOUTH = 37, True


def _prop(key: str) -> Column:
    return F.col("properties").getItem(key)


DEGREES = 0          # a ``grid_zone`` of layers whose coordinates are longitude and latitude already


def _grid(raw_geo: DataFrame, zone: int, south: bool):
    """Zone and hemisphere of a layer: its own ``grid_zone`` / ``grid_south`` columns where they are given."""
    if "grid_zone" not in raw_geo.columns:
        return zone, south
    return F.coalesce("grid_zone", F.lit(zone)), F.coalesce("grid_south", F.lit(south))


def geo_infrastructure(raw_geo: DataFrame) -> DataFrame:
    """Features per (dataset, resource, geometry type); NULL type is a group."""
    return (raw_geo.filter(F.col("dataset").isNotNull())
            .groupBy("dataset", "resource_name", "geometry_type")
            .agg(F.count(F.lit(1)).cast("bigint").alias("feature_count"),
                 F.min("_ingested_at").alias("first_ingested_at")))


def geo_map_substations(raw_geo: DataFrame, zone: int = UTM_ZONE, south: bool = UTM_SOUTH,
                        located_only: bool = False, order: Sequence[str] = ()) -> DataFrame:
    """Every Point feature as a station with WGS84 lat/lng (G1).

    lat/lng are NULL exactly when the grid x or y does not parse (the series
    maps finite input to finite or NaN output, never NULL).  ``located_only``
    keeps just the located stations by testing x/y right after parsing; a filter
    on the finished lat/lng would be pushed down through the projection chain
    with the whole series substituted into it.

    ``order`` (attribute names) gives the served order, NULLs last.  The parsed rows are sorted,
    not the finished ones, so the sort's sampling pass does not run the series; grid x and y
    break ties, so rows that share a name (or have none) are spread over the sort's tasks
    and always come in the same order.
    """
    pts = raw_geo.filter((F.col("geometry_type") == "Point") & F.col("geometry_wkt").isNotNull()
                         & ~F.col("geometry_wkt").isin(*EMPTY_GEOMETRIES))
    attrs = ["station_name", "county", "owner", "source", "status", "manned", "feature_type"]
    zone, south = _grid(raw_geo, zone, south)
    per_layer = isinstance(zone, Column)
    own = [zone.alias("__zone"), south.alias("__south")] if per_layer else []
    if per_layer:
        zone, south = F.col("__zone"), F.col("__south")
    # Three projections (grid xy -> conformal xi'/eta' -> lat/lng): each stage's
    # outputs are reused several times by the next, so Spark keeps them apart
    # instead of inlining, and every generated method stays small.
    xy = pts.select(
        _prop(PROP_STATION_NAME).alias("station_name"), _prop(PROP_COUNTY).alias("county"),
        _prop(PROP_OWNER).alias("owner"), _prop(PROP_SOURCE).alias("source"),
        _prop(PROP_STATUS).alias("status"), _prop(PROP_MANNED).alias("manned"),
        F.lit(POINT_FEATURE_TYPE).alias("feature_type"),
        F.get_json_object("geometry_wkt", "$[0]").try_cast("double").alias("__x"),
        F.get_json_object("geometry_wkt", "$[1]").try_cast("double").alias("__y"), *own)
    if located_only:
        xy = xy.filter(F.col("__x").isNotNull() & F.col("__y").isNotNull())
    if order:
        xy = xy.orderBy(*[F.col(c).asc_nulls_last() for c in (*order, "__x", "__y", *attrs)])
    xi_p, eta_p = utm_prime(F.col("__x"), F.col("__y"), south)
    staged = xy.select(*attrs, xi_p.alias("__xi"), eta_p.alias("__eta"), *(["__x", "__y", "__zone"] if per_layer else []))
    lng, lat = prime_to_lnglat(F.col("__xi"), F.col("__eta"), zone)
    if per_layer:
        lng, lat = (F.when(zone == DEGREES, plain).otherwise(series) for plain, series in (
            (F.col("__x"), lng), (F.col("__y"), lat)))
    return staged.select(*attrs, lat.alias("lat"), lng.alias("lng"))


def _fixed(x: Column, digits: int | None) -> Column:
    """JSON number text: every digit of the double, or ``digits`` fixed decimals."""
    return x.cast("string") if digits is None else F.format_string(f"%.{digits}f", R(x, digits))


def geo_map_lines(raw_geo: DataFrame, zone: int = UTM_ZONE, south: bool = UTM_SOUTH,
                  networks: Sequence[str] = LINE_NETWORKS, digits: int | None = None) -> DataFrame:
    """LineStrings of the named networks with >= 2 vertices, re-projected
    vertex by vertex inside ``transform`` and written as GeoJSON geometry text in full
    precision, or with ``digits`` fixed decimals (6 dp is about 0.1 m)."""
    ln = raw_geo.filter((F.col("geometry_type") == "LineString")
                        & F.col("resource_name").isin(*networks)
                        & F.col("geometry_wkt").isNotNull()
                        & (F.json_array_length("geometry_wkt") >= 2))
    zone, south = _grid(raw_geo, zone, south)
    per_layer = isinstance(zone, Column)
    coords = F.from_json("geometry_wkt", "array<array<double>>")
    primes = F.transform(coords, lambda p: F.struct(*[c.alias(n) for c, n in zip(
        (*utm_prime(p[0], p[1], south), *((p[0], p[1]) if per_layer else ())), ("xi", "eta", "x", "y"))]))

    def vertex(p):
        lng, lat = prime_to_lnglat(p["xi"], p["eta"], zone)
        if per_layer:
            lng, lat = (F.when(zone == DEGREES, plain).otherwise(series) for plain, series in ((p["x"], lng), (p["y"], lat)))
        return F.concat(F.lit("["), _fixed(lng, digits), F.lit(","), _fixed(lat, digits), F.lit("]"))

    geometry = F.concat(F.lit('{"type":"LineString","coordinates":['),
                        F.array_join(F.transform(primes, vertex), ","), F.lit("]}"))
    return ln.select("resource_name", _prop(PROP_VOLTAGE).alias("voltage_kv"),
                     line_color("resource_name").alias("line_color"),
                     geometry.alias("geojson_wgs84"))


def _located(subst: DataFrame, located: bool) -> DataFrame:
    """Stations with both coordinates; ``located=True`` when ``subst`` was built
    with ``located_only`` (or is otherwise known to hold only located rows)."""
    return subst if located else subst.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())


def geo_map_substations_view(subst: DataFrame, located: bool = False) -> DataFrame:
    """Located stations with 5-dp coordinates (sorted by station name when served)."""
    return (_located(subst, located)
            .select("station_name", "county", "owner", "manned", "feature_type",
                    R("lat", 5).alias("lat"), R("lng", 5).alias("lng")))


def geo_features(lines: DataFrame, subst: DataFrame, digits: int | None = None,
                 located: bool = False) -> DataFrame:
    """One GeoJSON Feature (JSON text) per line and per located station.

    Rows stay distributed; write them with ``sources.files.write_geojson`` (one
    Feature per line), never gathered into one document on the driver.
    """
    keep_nulls = {"ignoreNullFields": "false"}
    line_props = F.to_json(F.struct(F.lit("transmission_line").alias("layer"), "resource_name",
                                    "voltage_kv", "line_color"), keep_nulls)
    line_feats = lines.select(F.concat(F.lit('{"type":"Feature","geometry":'), F.col("geojson_wgs84"),
                                       F.lit(',"properties":'), line_props, F.lit("}")).alias("feature"))
    empty = F.lit("")
    point_props = F.to_json(F.struct(
        F.lit("substation").alias("layer"),
        F.coalesce("station_name", empty).alias("station_name"),
        F.coalesce("county", empty).alias("county"),
        F.coalesce("owner", empty).alias("owner"),
        F.coalesce("manned", empty).alias("manned")), keep_nulls)
    point_geom = F.concat(F.lit('{"type":"Point","coordinates":['), _fixed(F.col("lng"), digits),
                          F.lit(","), _fixed(F.col("lat"), digits), F.lit("]}"))
    point_feats = (_located(subst, located)
                   .select(F.concat(F.lit('{"type":"Feature","geometry":'), point_geom,
                                    F.lit(',"properties":'), point_props, F.lit("}")).alias("feature")))
    return line_feats.unionByName(point_feats)


def layer_counts(lines: DataFrame, subst: DataFrame, located: bool = False) -> DataFrame:
    """Segments per mapped network plus the located station count (map legend)."""
    segs = lines.select(F.lit("transmission_line").alias("layer"), "resource_name")
    pts = (_located(subst, located)
           .select(F.lit("substation").alias("layer"), F.lit("Substations").alias("resource_name")))
    return (segs.unionByName(pts).groupBy("layer", "resource_name")
            .agg(F.count(F.lit(1)).cast("bigint").alias("feature_count")))
