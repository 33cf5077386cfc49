"""One lattice for all chunks: cells and chunks are floors of integer centimetres, so no cell depends on its chunk."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """Square cells of `res` metres anchored at (0, 0); the reference system is a property of the grid, not of rows."""

    res: float
    crs: int = 3005

    @property
    def cm(self) -> int:
        return round(self.res * 100)

    def col(self, xi: Column) -> Column:
        """The column of a coordinate in centimetres."""
        return F.floor(xi / F.lit(self.cm)).cast("bigint")

    def centre(self, index: Column) -> Column:
        return (index * self.cm + self.cm / 2) / F.lit(100.0)

    def centre_cm(self, index: Column) -> Column:
        return index * self.cm + self.cm / 2


def with_cells(points: DataFrame, grid: GridSpec) -> DataFrame:
    return points.withColumns({"col": grid.col(F.col("xi")), "row": grid.col(F.col("yi"))})


def chunk_of(xi: Column, size: float) -> Column:
    return F.floor(xi / F.lit(round(size * 100))).cast("bigint")


def with_halo(points: DataFrame, size: float = 100.0, buffer: float = 10.0) -> DataFrame:
    """A row for each chunk whose core or halo covers the point: chunk_x, chunk_y, is_core.

    A core is [x0, x0 + size), a halo reaches `buffer` beyond it on all sides, closed. Candidate chunks are listed by an
    expression, so nothing is joined: one row becomes at most (2 * ceil(buffer / size) + 1) ** 2.
    """
    reach, s, b = math.ceil(buffer / size), round(size * 100), round(buffer * 100)

    def covering(v: str) -> Column:
        own = F.floor(F.col(v) / F.lit(s)).cast("bigint")
        return F.filter(F.sequence(own - reach, own + reach), lambda k: (F.col(v) >= k * s - b) & (F.col(v) <= k * s + s + b))

    out = points.withColumn("chunk_x", F.explode(covering("xi"))).withColumn("chunk_y", F.explode(covering("yi")))
    return out.withColumn("is_core", (F.col("chunk_x") == chunk_of(F.col("xi"), size)) & (F.col("chunk_y") == chunk_of(F.col("yi"), size)))


def circle_offsets(radius: float, res: float) -> list[tuple[int, int]]:
    """Cells whose centres are within radius of a cell's centre."""
    r = int(radius / res + 1e-9)
    return [(dc, dr) for dc in range(-r, r + 1) for dr in range(-r, r + 1) if math.hypot(dc, dr) * res <= radius + 1e-9]


def dense_cells(cells: DataFrame) -> DataFrame:
    """All cells of the box around cells: a grid's template."""
    box = cells.agg(F.min("col").alias("c0"), F.max("col").alias("c1"), F.min("row").alias("r0"), F.max("row").alias("r1")).filter("c0 is not null")
    rows = box.select("c0", "c1", F.explode(F.sequence("r0", "r1")).alias("row"))
    return rows.select(F.explode(F.sequence("c0", "c1")).alias("col"), "row")
