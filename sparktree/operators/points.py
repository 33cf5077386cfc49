"""Points of a cloud: xi, yi in centimetres, x, y, z in metres, cls the classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.grid import chunk_of

GROUND = 2


def deduplicated(points: DataFrame, key: tuple[str, ...] = ("x", "y", "z"), order: tuple[str, ...] = ("point_id", "cls")) -> DataFrame:
    """One point of each place, the first by `order`: which of copies that differ stays doesn't depend on tasks."""
    first = Window.partitionBy(*key).orderBy(*(c for c in order if c in points.columns))
    return points.withColumn("rn_", F.row_number().over(first)).filter("rn_ = 1").drop("rn_")


def ground(points: DataFrame) -> DataFrame:
    return points.filter(F.col("cls") == GROUND)


def not_ground(points: DataFrame) -> DataFrame:
    """Points of another class; those without a class are in neither set."""
    return points.filter(F.col("cls") != GROUND)


def height_band(points: DataFrame, hmax: float = 30.0, height: str = "h") -> DataFrame:
    return points.filter(F.col(height).between(0.0, hmax))


def clipped(points: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    return points.filter(F.col("x").between(xmin, xmax) & F.col("y").between(ymin, ymax))


def clipped_to_ring(points: DataFrame, ring: list[tuple[float, float]]) -> DataFrame:
    """Within a polygon: its box first, which reaches the scan, then the ring."""
    xs, ys = zip(*ring)
    return clipped(points, min(xs), min(ys), max(xs), max(ys)).filter(S.in_ring(F.col("x"), F.col("y"), ring))


def core_of(points: DataFrame, chunk_x: int, chunk_y: int, size: float = 100.0) -> DataFrame:
    return points.filter((chunk_of(F.col("xi"), size) == chunk_x) & (chunk_of(F.col("yi"), size) == chunk_y))


def all_finite(rows: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        rows = rows.filter(S.finite(F.col(c)))
    return rows


def sample_window(points: DataFrame, size: float = 100.0, seed: int = 1) -> DataFrame:
    """The points of one random window: the first, in an order by hash, of those that hold points, so no attempt is in vain."""
    windows = points.select(chunk_of(F.col("xi"), size).alias("wx"), chunk_of(F.col("yi"), size).alias("wy")).distinct()
    chosen = windows.orderBy(F.xxhash64(F.lit(seed), "wx", "wy"), "wx", "wy").limit(1)
    held = points.withColumns({"wx": chunk_of(F.col("xi"), size), "wy": chunk_of(F.col("yi"), size)})
    return held.join(F.broadcast(chosen), ["wx", "wy"], "left_semi").drop("wx", "wy")


def checked(points: DataFrame) -> DataFrame:
    """One row of counts that tell whether a cloud can be used."""
    return points.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull()).alias("n_null"),
        (F.count(F.lit(1)) - F.count_distinct("x", "y", "z")).alias("n_duplicates"),
        F.count_if(F.col("cls") == GROUND).alias("n_ground"),
        F.count_if(F.col("cls").isNull()).alias("n_unclassified"),
        F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"),
    )
