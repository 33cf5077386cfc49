"""Time in daylight: the share of the time the sun is up in which a cell isn't in the shadow of its surroundings.

The sun's track is a table of days and times of day, made by Spark. Horizons are found per block of cells with a halo of
the furthest distance, for a fixed number of directions. For each direction the sun's altitudes are sorted, so that how
often it stands above a horizon is one binary search.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import GridSpec
from ..functions.scalar import lit


def minutes(clock: str) -> int:
    """Whole minutes since midnight: 23:59:59 is still that day's last minute."""
    h, m, _ = (int(v) for v in clock.split(":"))
    return h * 60 + m


def sun_table(spark: SparkSession, lat: float, lon: float, utc_offset: float = -8.0, start_day: int = 1, end_day: int = 365, start_time: str = "00:00:00", end_time: str = "23:59:59", step: int = 30) -> DataFrame:
    """day, minute, altitude, azimuth (degrees, from north clockwise) at each time step; one fixed offset all year."""
    days = spark.range(start_day, end_day + 1).withColumnRenamed("id", "day")
    t = days.select("day", F.explode(F.sequence(F.lit(minutes(start_time)), F.lit(minutes(end_time)), F.lit(step))).alias("minute"))
    # fractional year, equation of time and declination by the usual short Fourier series
    g = lit(2 * math.pi / 365) * (F.col("day") - 1 + (F.col("minute") / 60 - 12) / 24)
    equation = lit(229.18) * (lit(0.000075) + lit(0.001868) * F.cos(g) - lit(0.032077) * F.sin(g) - lit(0.014615) * F.cos(2 * g) - lit(0.040849) * F.sin(2 * g))
    decl = lit(0.006918) - lit(0.399912) * F.cos(g) + lit(0.070257) * F.sin(g) - lit(0.006758) * F.cos(2 * g) + lit(0.000907) * F.sin(2 * g) - lit(0.002697) * F.cos(3 * g) + lit(0.00148) * F.sin(3 * g)
    hour = F.radians((F.col("minute") + equation + lit(4 * lon - 60 * utc_offset)) / 4 - 180)
    f = math.radians(lat)
    sin_alt = lit(math.sin(f)) * F.sin(decl) + lit(math.cos(f)) * F.cos(decl) * F.cos(hour)
    azimuth = F.pmod(F.degrees(F.atan2(F.sin(hour), F.cos(hour) * lit(math.sin(f)) - F.tan(decl) * lit(math.cos(f)))) + 180, lit(360))
    return t.select("day", "minute", F.degrees(F.asin(sin_alt)).alias("altitude"), azimuth.alias("azimuth"))


def ray(azimuth: float, steps: int) -> list[tuple[int, int]]:
    """Offsets (columns, rows) of the cells that a ray towards an azimuth meets, each once."""
    dx, dy = math.sin(math.radians(azimuth)), math.cos(math.radians(azimuth))
    return list(dict.fromkeys((round(dx * s), round(dy * s)) for s in range(1, steps + 1)))


def horizons(z: np.ndarray, res: float, azimuths: list[float], furthest: float, pad: int) -> np.ndarray:
    """Of the cells inside `pad`, the horizon's angle in each direction, in degrees, at least 0. Rows go north."""
    inner = z[pad:-pad, pad:-pad] if pad else z
    out = np.zeros((len(azimuths), *inner.shape))
    for k, a in enumerate(azimuths):
        for dc, dr in ray(a, int(furthest / res)):
            other = z[pad + dr : pad + dr + inner.shape[0], pad + dc : pad + dc + inner.shape[1]]
            angle = np.degrees(np.arctan((other - inner) / (math.hypot(dc, dr) * res)))
            out[k] = np.fmax(out[k], angle)
    return out


def time_in_daylight(dsm: DataFrame, grid: GridSpec, sun: DataFrame, az_fraction: float = 10.0, max_dist: float = 100.0, block: int = 256) -> DataFrame:
    """col, row, value in [0, 1]. sun is bounded by days and time steps and goes to the driver, as sorted altitudes per direction."""
    n = round(360 / az_fraction)
    azimuths = [k * az_fraction for k in range(n)]
    up = sun.filter("altitude > 0").select("altitude", (F.round(F.col("azimuth") / az_fraction).cast("int") % n).alias("k")).toPandas()
    tracks = [np.sort(up.loc[up["k"] == k, "altitude"].to_numpy()) for k in range(n)]
    total = sum(map(len, tracks))
    pad = int(max_dist / grid.res) + 1
    block = max(block, 2 * pad)
    reach = lambda v: F.sequence(F.floor((F.col(v) - pad) / F.lit(block)), F.floor((F.col(v) + pad) / F.lit(block)))

    def lit_share(key, held):
        c0, r0, side = int(key[0]) * block - pad, int(key[1]) * block - pad, block + 2 * pad
        z = np.full((side, side), np.nan)
        row, col = held["row"].to_numpy() - r0, held["col"].to_numpy() - c0
        z[row, col] = held["value"].to_numpy(float)
        own = (row >= pad) & (row < pad + block) & (col >= pad) & (col < pad + block)
        if not own.any():
            return pd.DataFrame({"col": [], "row": [], "value": []})
        h = horizons(z, grid.res, azimuths, max_dist, pad)[:, row[own] - pad, col[own] - pad]
        light = sum((len(t) - np.searchsorted(t, h[k], "right")) for k, t in enumerate(tracks))
        return pd.DataFrame({"col": held["col"].to_numpy()[own], "row": held["row"].to_numpy()[own], "value": light / total if total else np.zeros(int(own.sum()))})

    cells = dsm.filter("value is not null").select("col", "row", "value")
    dealt = cells.withColumn("bc", F.explode(reach("col"))).withColumn("br", F.explode(reach("row")))
    return dealt.groupBy("bc", "br").applyInPandas(lit_share, "col bigint, row bigint, value double")
