"""Geodesy and geometry as column expressions."""

from __future__ import annotations

from math import pi, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Earth radii in km, by use.
RADIUS_PRELIMINARY, RADIUS_NEAREST, RADIUS_VIEWER = 6371.0088, 6371.0, 6371.0088
#: The region's box, west, south, east, north.
REGION = (-119.0, -57.5, -32.0, 33.0)


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = RADIUS_NEAREST) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.least(F.lit(1.0), h))) * (2 * radius)


def in_box(lon: Column, lat: Column, west: float, south: float, east: float, north: float) -> Column:
    """Containment with all four edges."""
    return lon.between(west, east) & lat.between(south, north)


def boxes_intersect(a: Column, west: float, south: float, east: float, north: float) -> Column:
    """For struct a(xmin, ymin, xmax, ymax): plain range predicates, so that Parquet row groups can be skipped."""
    return (a["xmin"] <= east) & (a["xmax"] >= west) & (a["ymin"] <= north) & (a["ymax"] >= south)


def is_finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def crosses(lon: Column, lat: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether the ray east of a point crosses an edge; half-open, so shared borders count once."""
    spans = (y1 > lat) != (y2 > lat)
    return spans & (lon < F.when(spans, (x2 - x1) * (lat - y1) / F.when(spans, y2 - y1) + x1))


def is_closed(ring: Column) -> Column:
    """Whether an array of points ends where it begins."""
    return F.element_at(ring, 1) == F.element_at(ring, -1)


def shoelace(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """One edge's part of twice the signed area."""
    return x1 * y2 - x2 * y1


def wind_speed(u: Column, v: Column) -> Column:
    return F.round(F.hypot(u, v), 1)


def wind_direction(u: Column, v: Column) -> Column:
    """Where the wind comes from, in whole degrees: rounded first, then brought into 0 to 359."""
    return F.pmod(F.bround(F.lit(270.0) - F.degrees(F.atan2(v, u))), F.lit(360.0)).cast("int")


def compass(degrees: Column) -> Column:
    """One of eight Spanish compass labels."""
    labels = F.array(*[F.lit(x) for x in ("N", "NE", "E", "SE", "S", "SO", "O", "NO")])
    return F.element_at(labels, (F.pmod(F.round(degrees / 45), F.lit(8)) + 1).cast("int"))


def depth_class(km: Column) -> Column:
    return F.when(km < 70, "shallow").when(km <= 300, "intermediate").otherwise("deep")


def tile_floor(x: Column, side: float) -> Column:
    """The lower edge of the tile that holds x, also below zero."""
    return F.floor(x / F.lit(side)) * F.lit(side)


def point_segment_km2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared planar distance from a point to a segment, in the units given."""
    dx, dy = x2 - x1, y2 - y1
    size = dx * dx + dy * dy
    t = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / F.when(size > 0, size)))).otherwise(0.0)
    return F.pow(px - (x1 + t * dx), 2) + F.pow(py - (y1 + t * dy), 2)


def along(x1: Column, x2: Column, part: Column) -> Column:
    """A coordinate at a part of a segment."""
    return x1 + (x2 - x1) * part


#: The WGS 84 ellipsoid.
AXIS_M, FLATTENING = 6378137.0, 1 / 298.257223563
_E2 = FLATTENING * (2 - FLATTENING)
_E = _E2**0.5


def _zone_area(lat: Column) -> Column:
    """Area of the ellipsoid between the equator and a latitude, for a radian of longitude, in square metres."""
    x = F.sin(F.radians(lat))
    return AXIS_M**2 * (1 - _E2) / 2 * (x / (1 - _E2 * x * x) + F.log((1 + _E * x) / (1 - _E * x)) / (2 * _E))


def ellipsoid_area_part(x1: Column, y1: Column, x2: Column, y2: Column, flipped: bool = False) -> Column:
    """What an edge adds to the signed area of its ring on the ellipsoid, in square metres; flipped: (lat, lon) pairs.

    Edges are taken as straight in equal-area latitude, which for buildings and cells is a geodesic to 1e-6.
    """
    lon1, lat1, lon2, lat2 = (y1, x1, y2, x2) if flipped else (x1, y1, x2, y2)
    return F.radians(lon2 - lon1) * (_zone_area(lat1) + _zone_area(lat2)) / 2


def ellipsoid_km(x1: Column, y1: Column, x2: Column, y2: Column, flipped: bool = False) -> Column:
    """Length of a short segment on the ellipsoid, by the radii of curvature at its middle."""
    lon1, lat1, lon2, lat2 = (y1, x1, y2, x2) if flipped else (x1, y1, x2, y2)
    mid = F.radians((lat1 + lat2) / 2)
    w2 = 1 - _E2 * F.pow(F.sin(mid), F.lit(2.0))
    north = F.radians(lat2 - lat1) * AXIS_M * (1 - _E2) / F.pow(w2, F.lit(1.5))
    east = F.radians(lon2 - lon1) * AXIS_M * F.cos(mid) / F.sqrt(w2)
    return F.sqrt(north * north + east * east) / 1000


def wkt_point(text: Column) -> Column:
    """(lon, lat) of 'POINT (x y)'; null for blank, empty or other text."""
    form = r"(?i)^\s*POINT\s*\(\s*(\S+)\s+(\S+?)\s*\)\s*$"
    number = lambda k: F.regexp_extract(text, form, k).try_cast("double")
    return F.when(number(1).isNotNull() & number(2).isNotNull(), F.struct(number(1).alias("lon"), number(2).alias("lat")))


#: The sphere of the Mollweide grid of population rasters, its upper left corner and its tiles' side, in metres.
MOLLWEIDE_RADIUS, MOLLWEIDE_WEST, MOLLWEIDE_NORTH, MOLLWEIDE_TILE = 6378137.0, -18041000.0, 9000000.0, 1000000.0
NEWTON_STEPS = 8


def mollweide(lon: Column, lat: Column, radius: float = MOLLWEIDE_RADIUS) -> Column:
    """struct(x, y) in metres of the equal-area Mollweide projection; null beyond the poles.

    The auxiliary angle t solves 2t + sin 2t = pi sin(lat), by a fixed number of Newton's steps. Near a pole, where both
    sides flatten out, they start from the cube root that the equation comes down to there.
    """
    aim = F.sin(F.radians(lat)) * pi
    near_pole = F.signum(lat) * (pi / 2 - F.cbrt(F.lit(0.75) * (pi - F.abs(aim))))
    first = F.when(F.abs(lat) > 60, near_pole).otherwise(F.radians(lat) * 0.8)

    def newton(t: Column, _: Column) -> Column:
        slope = 2 + 2 * F.cos(2 * t)
        return F.when(slope < 1e-14, t).otherwise(t - (2 * t + F.sin(2 * t) - aim) / slope)

    t = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), first, newton)
    point = F.transform(F.array(t), lambda a: F.struct((F.radians(lon) * F.cos(a) * (2 * sqrt(2) / pi * radius)).alias("x"), (F.sin(a) * (sqrt(2) * radius)).alias("y")))
    return F.when(F.abs(lat) <= 90, F.get(point, F.lit(0)))


def from_mollweide(x: Column, y: Column, radius: float = MOLLWEIDE_RADIUS) -> Column:
    """struct(lon, lat) of a Mollweide point; null outside the world's ellipse. At the poles every longitude is 0."""
    t = F.asin(y / (sqrt(2) * radius))
    wide = F.cos(t) * (2 * sqrt(2) / pi * radius)
    lon = F.when(wide > 1e-6, F.degrees(x / F.when(wide > 1e-6, wide))).otherwise(0.0)
    lat = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (2 * t + F.sin(2 * t)) / pi))))
    return F.when((F.abs(y) <= sqrt(2) * radius) & (F.abs(lon) <= 180 + 1e-9), F.struct(lon.alias("lon"), lat.alias("lat")))


def mollweide_tile(x: Column, y: Column) -> Column:
    """R5_C10: the row from the north and the column from the west of a point's tile, from 1."""
    row = F.floor((MOLLWEIDE_NORTH - y) / MOLLWEIDE_TILE) + 1
    column = F.floor((x - MOLLWEIDE_WEST) / MOLLWEIDE_TILE) + 1
    return F.concat(F.lit("R"), row.cast("string"), F.lit("_C"), column.cast("string"))
