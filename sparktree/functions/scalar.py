"""Column functions: names and predicates of tiles, projections, terrain angles, the treetop window."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Semi-major axis and flattening of GRS 80; the sphere of web maps has the same radius.
RADIUS, FLATTENING = 6378137.0, 1 / 298.257222101
#: Albers equal-area for British Columbia (EPSG:3005): origin, standard parallels, false easting.
LAT0, LON0, LAT1, LAT2, X0, Y0 = 45.0, -126.0, 50.0, 58.5, 1_000_000.0, 0.0


def lit(x: float) -> Column:
    return F.lit(float(x))


# --- tiles -------------------------------------------------------------------------------------------------------


def tile_number(name: Column) -> Column:
    """The last run of three digits; a name without one comes back as it is."""
    return F.regexp_replace(name, r".*([0-9]{3}).*", "$1")


def tile_subdivision(name: Column) -> Column:
    """What follows the first underscore: 1_4_3 of 093h040_1_4_3."""
    return F.regexp_replace(name, r"^[^_]*_", "")


def tile_url(s3_url: Column, path: Column, prefix: str) -> Column:
    missing = s3_url.isNull() | (s3_url == "")
    return F.when(missing, F.concat(F.lit(prefix), F.replace(path, F.lit("\\"), F.lit("/")))).otherwise(s3_url)


def any_prefix(name: Column, prefixes: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [name.startswith(p) for p in prefixes], F.lit(False))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def envelope_json(xmin: Column, ymin: Column, xmax: Column, ymax: Column, wkid: int = 3857) -> Column:
    return F.format_string('{"xmin":%f,"ymin":%f,"xmax":%f,"ymax":%f,"spatialReference":{"wkid":' + str(wkid) + "}}", xmin, ymin, xmax, ymax)


def chunk_prefix(xmin: Column, ymin: Column) -> Column:
    """round(xmin)_round(ymin), halves to even."""
    return F.concat_ws("_", F.bround(xmin).cast("bigint").cast("string"), F.bround(ymin).cast("bigint").cast("string"))


def bitmerge_id(xi: Column, yi: Column) -> Column:
    """One 64-bit id of two 32-bit scaled coordinates."""
    return F.shiftleft(xi.cast("bigint"), 32).bitwiseOR(yi.cast("bigint").bitwiseAND(F.lit(4294967295)))


# --- projections -------------------------------------------------------------------------------------------------


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return lit(RADIUS) * F.radians(lon), lit(RADIUS) * F.log(F.tan(lit(math.pi / 4) + F.radians(lat) / 2))


def web_mercator_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - lit(math.pi / 2))


def _albers() -> tuple[float, float, float, float]:
    """Eccentricity, n, C and rho0 of the projection's formulas."""
    e2 = FLATTENING * (2 - FLATTENING)
    e = math.sqrt(e2)
    m = lambda f: math.cos(f) / math.sqrt(1 - e2 * math.sin(f) ** 2)
    q = lambda f: (1 - e2) * (math.sin(f) / (1 - e2 * math.sin(f) ** 2) - math.log((1 - e * math.sin(f)) / (1 + e * math.sin(f))) / (2 * e))
    f0, f1, f2 = map(math.radians, (LAT0, LAT1, LAT2))
    n = (m(f1) ** 2 - m(f2) ** 2) / (q(f2) - q(f1))
    c = m(f1) ** 2 + n * q(f1)
    return e, n, c, RADIUS * math.sqrt(c - n * q(f0)) / n


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    e, n, c, rho0 = _albers()
    s = F.sin(F.radians(lat))
    q = lit(1 - e * e) * (s / (1 - lit(e * e) * s * s) - F.log((1 - lit(e) * s) / (1 + lit(e) * s)) / lit(2 * e))
    rho = lit(RADIUS) * F.sqrt(lit(c) - lit(n) * q) / lit(n)
    theta = lit(n) * F.radians(lon - LON0)
    return lit(X0) + rho * F.sin(theta), lit(Y0 + rho0) - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude; latitude by the series in the authalic latitude, good to 1e-11 degrees."""
    e, n, c, rho0 = _albers()
    e2 = e * e
    dx, dy = x - X0, lit(rho0 + Y0) - y
    rho = F.sqrt(dx * dx + dy * dy)
    q = (lit(c) - rho * rho * lit(n * n / RADIUS**2)) / lit(n)
    qp = 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))
    beta = F.asin(q / lit(qp))
    lat = (
        beta
        + lit(e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * beta)
        + lit(23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * beta)
        + lit(761 * e2**3 / 45360) * F.sin(6 * beta)
    )
    return lit(LON0) + F.degrees(F.atan2(dx, dy) / lit(n)), F.degrees(lat)


# --- terrain and trees -------------------------------------------------------------------------------------------


def northness(aspect: Column) -> Column:
    """cos of the aspect, which is first brought to [0, 360)."""
    return F.cos(F.pmod(aspect, lit(360)) * lit(math.pi / 180))


def hillshade(slope: Column, aspect: Column, angle: float = 45.0, direction: float = 315.0) -> Column:
    """Of slope and aspect in degrees, the cosine between the surface's normal and the sun."""
    a, d = math.radians(angle), math.radians(direction)
    return F.cos(F.radians(slope)) * lit(math.sin(a)) + F.sin(F.radians(slope)) * lit(math.cos(a)) * F.cos(lit(d) - F.radians(aspect))


#: The treetop window: its gain, rate and least size, and what it is below hmin and above hmax.
WINDOW_GAIN, WINDOW_RATE, WINDOW_LEAST, WINDOW_BELOW, WINDOW_ABOVE = 2.6, 0.08, 3.0, 3.0, 5.0


def window_size(height: Column, hmin: float = 2.0, hmax: float = 30.0) -> Column:
    curve = lit(WINDOW_GAIN) * (1 - F.exp(lit(-WINDOW_RATE) * (height - lit(hmin)))) + lit(WINDOW_LEAST)
    return F.when(height < hmin, lit(WINDOW_BELOW)).when(height > hmax, lit(WINDOW_ABOVE)).otherwise(curve)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def in_ring(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Whether a point is within a polygon's ring, by the number of edges east of it."""
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if y1 != y2:
            straddles = (y > y1) != (y > y2)
            crossings = crossings + F.when(straddles & (x < lit(x2 - x1) * (y - y1) / lit(y2 - y1) + x1), 1).otherwise(0)
    return crossings % 2 == 1
