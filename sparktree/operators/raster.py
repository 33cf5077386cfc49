"""Rasters as tables of cells (col, row, value): rasterising, cell algebra, neighbourhoods, mosaics.

Neighbours are never found by comparing positions, which would plan a nested loop: each cell is sent to the cells that
need it (offsets are a fixed list) and meets them in one shuffle on (col, row).
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grid import GridSpec, circle_offsets, dense_cells, with_cells
from ..functions.scalar import hillshade as shade_of

CELL = ["col", "row"]


def rasterized(points: DataFrame, grid: GridSpec, value: str = "z", how: str = "max") -> DataFrame:
    """The greatest (a surface) or least (a coarse ground) value of each cell that holds points."""
    return with_cells(points, grid).groupBy(*CELL).agg(getattr(F, how)(value).alias("value"))


def surfaces(points: DataFrame, grid: GridSpec) -> DataFrame:
    """col, row, dsm (greatest height) and ground (least height of ground points, null without any), in one pass."""
    low = F.min(F.when(F.col("cls") == 2, F.col("z")))
    return with_cells(points, grid).groupBy(*CELL).agg(F.max("z").alias("dsm"), low.alias("ground"))


def sampled(points: DataFrame, raster: DataFrame, grid: GridSpec, name: str) -> DataFrame:
    """The value of the cell that each point is in; null where the raster has none."""
    return with_cells(points, grid).join(raster.select(*CELL, F.col("value").alias(name)), CELL, "left").drop(*CELL)


def sampled_all(points: DataFrame, rasters: DataFrame, grid: GridSpec) -> DataFrame:
    """As sampled, of several products at once: rasters has a column for each beside col and row, so one join does."""
    return with_cells(points, grid).join(rasters, CELL, "left").drop(*CELL)


def difference(a: DataFrame, b: DataFrame, drop_negative: bool = False) -> DataFrame:
    """a - b where both have a cell; with drop_negative, null below 0."""
    d = F.col("a") - F.col("b")
    both = a.select(*CELL, F.col("value").alias("a")).join(b.select(*CELL, F.col("value").alias("b")), CELL)
    return both.select(*CELL, (F.when(d >= 0, d) if drop_negative else d).alias("value"))


def cropped(cells: DataFrame, grid: GridSpec, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Cells whose centre is in [xmin, xmax) x [ymin, ymax)."""
    x, y = grid.centre(F.col("col")), grid.centre(F.col("row"))
    return cells.filter((x >= xmin) & (x < xmax) & (y >= ymin) & (y < ymax))


def global_max(cells: DataFrame) -> DataFrame:
    return cells.agg(F.max("value").alias("max_value"))


def all_null(cells: DataFrame) -> DataFrame:
    return cells.agg((F.count("value") == 0).alias("all_null"))


def tree_gate(cells: DataFrame, hmin: float = 2.0) -> DataFrame:
    """Chunks whose canopy reaches hmin: those in which trees are looked for."""
    return cells.groupBy("chunk_x", "chunk_y").agg(F.max("value").alias("max_value")).withColumn("has_trees", F.coalesce(F.col("max_value") >= hmin, F.lit(False)))


def gradients(cells: DataFrame, grid: GridSpec) -> DataFrame:
    """zx (to the east) and zy (to the north) by Horn's weights, of cells with all eight neighbours and a value."""
    weights = [(dc, dr, wx, wy) for dc in (-1, 0, 1) for dr in (-1, 0, 1) for wx, wy in [(dc * (2 - abs(dr)), dr * (2 - abs(dc)))]]
    # a cell at offset (dc, dr) of its target
    sent = F.explode(F.array(*(F.struct(F.lit(dc).alias("dc"), F.lit(dr).alias("dr"), F.lit(float(wx)).alias("wx"), F.lit(float(wy)).alias("wy")) for dc, dr, wx, wy in weights)))
    parts = cells.filter("value is not null").select("*", sent.alias("o")).select((F.col("col") - F.col("o.dc")).alias("col"), (F.col("row") - F.col("o.dr")).alias("row"), (F.col("value") * F.col("o.wx")).alias("px"), (F.col("value") * F.col("o.wy")).alias("py"))
    sums = parts.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"), F.sum("px").alias("sx"), F.sum("py").alias("sy")).filter("n = 9")
    return sums.select(*CELL, (F.col("sx") / (8 * grid.res)).alias("zx"), (F.col("sy") / (8 * grid.res)).alias("zy"))


def slope_degrees(zx: Column, zy: Column) -> Column:
    return F.degrees(F.atan(F.sqrt(zx * zx + zy * zy)))


def aspect_degrees(zx: Column, zy: Column, flat: float = 90.0) -> Column:
    """Compass direction of steepest descent; `flat` where there is none."""
    return F.when((zx == 0) & (zy == 0), F.lit(flat)).otherwise(F.pmod(F.degrees(F.atan2(-zx, -zy)), F.lit(360.0)))


def terrain(dtm: DataFrame, grid: GridSpec, angle: float = 45.0, direction: float = 315.0) -> DataFrame:
    """col, row, slope, aspect, hillshade."""
    g = gradients(dtm, grid).select(*CELL, slope_degrees(F.col("zx"), F.col("zy")).alias("slope"), aspect_degrees(F.col("zx"), F.col("zy")).alias("aspect"))
    return g.withColumn("hillshade", shade_of(F.col("slope"), F.col("aspect"), angle, direction))


def presence(points: DataFrame, grid: GridSpec, template: DataFrame | None = None) -> DataFrame:
    """1 in cells with a point, 0 in the template's other cells."""
    held = with_cells(points, grid).select(*CELL).distinct().withColumn("one", F.lit(1.0))
    return (dense_cells(held) if template is None else template.select(*CELL)).join(held, CELL, "left").select(*CELL, F.coalesce("one", F.lit(0.0)).alias("value"))


def focal_circle(cells: DataFrame, grid: GridSpec, radius: float) -> DataFrame:
    """Sum of value over cells with centres within radius; null values count as nothing. The cells fill a box.

    Rows are summed from the left once; a circle is then a chord in each row, the difference of two running sums, so a
    cell sends 2 messages a row of the circle and not one for each of its cells. Sums of integers are exact.
    """
    r = int(radius / grid.res + 1e-9)
    chords = [(dr, int(math.sqrt(max(0.0, (radius / grid.res) ** 2 - dr * dr)) + 1e-9)) for dr in range(-r, r + 1)]
    by_row = Window.partitionBy("row").orderBy("col")
    running = cells.select(*CELL, F.sum(F.coalesce("value", F.lit(0.0))).over(by_row.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.max("col").over(Window.partitionBy("row")).alias("last"))
    chord = F.explode(F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(c).alias("c")) for dr, c in chords)))
    sent = running.select(*CELL, "s", "last", chord.alias("e"))
    row, at, c = (F.col("row") - F.col("e.dr")).alias("row"), F.col("col"), F.col("e.c")
    # a chord ends at the sum of its right end, or at the row's last sum where it goes beyond the row
    right = sent.select(F.explode(F.sequence(at - c, F.when(at == F.col("last"), at).otherwise(at - c))).alias("col"), row, F.col("s").alias("v"))
    left = sent.select((at + c + 1).alias("col"), row, (-F.col("s")).alias("v"))
    spread = right.unionByName(left)
    sums = spread.groupBy(*CELL).agg(F.sum("v").alias("value"))
    return cells.select(*CELL).join(sums, CELL, "left").select(*CELL, F.coalesce("value", F.lit(0.0)).alias("value"))


def focal_blocks(cells: DataFrame, grid: GridSpec, radius: float, block: int = 256) -> DataFrame:
    """As focal_circle, for fine grids: blocks of cells with a halo of the radius, summed by chords in NumPy.

    A cell is sent to the blocks whose halo holds it, at most 4 while the radius is below half a block (the block grows
    with the radius), and a block's work is its cells times the circle's rows.
    """
    import numpy as np
    import pandas as pd

    r = int(radius / grid.res + 1e-9)
    block = max(block, 2 * r)
    reach = lambda v: F.sequence(F.floor((F.col(v) - r) / F.lit(block)), F.floor((F.col(v) + r) / F.lit(block)))
    chords = [(dr, int(math.sqrt(max(0.0, (radius / grid.res) ** 2 - dr * dr)) + 1e-9)) for dr in range(-r, r + 1)]

    def sums(key, held):
        bc, br = key
        c0, r0, side = int(bc) * block - r, int(br) * block - r, block + 2 * r
        values = np.zeros((side, side))
        at = held["row"].to_numpy() - r0, held["col"].to_numpy() - c0
        values[at] = np.nan_to_num(held["value"].to_numpy(float))
        left = np.zeros((side, side + 1))
        np.cumsum(values, axis=1, out=left[:, 1:])
        out = np.zeros((block, block))
        for dr, c in chords:
            rows = left[r + dr : r + dr + block]
            out += rows[:, r + c + 1 : r + c + 1 + block] - rows[:, r - c : r - c + block]
        own = (at[0] >= r) & (at[0] < r + block) & (at[1] >= r) & (at[1] < r + block)
        return pd.DataFrame({"col": held["col"].to_numpy()[own], "row": held["row"].to_numpy()[own], "value": out[at[0][own] - r, at[1][own] - r]})

    dealt = cells.select(*CELL, "value").withColumn("bc", F.explode(reach("col"))).withColumn("br", F.explode(reach("row")))
    return dealt.groupBy("bc", "br").applyInPandas(sums, "col bigint, row bigint, value double")


def tree_density(trees: DataFrame, grid: GridSpec, window: float = 100.0, kind: str = "reference", template: DataFrame | None = None, blocks: bool = True) -> DataFrame:
    """kind "reference": the share of cells within `window` that hold a tree; "per_hectare": cells with trees per hectare of the circle."""
    n = len(circle_offsets(window, grid.res))
    field = presence(trees, grid, template)
    sums = (focal_blocks if blocks else focal_circle)(field, grid, window)
    share = F.col("value") / n if kind == "reference" else F.col("value") * 10_000 / (n * grid.res**2)
    return sums.select(*CELL, share.alias("value"))


def mosaic(tiles: DataFrame, later: str = "tile") -> DataFrame:
    """One value a cell and product where tiles overlap: that of the last tile."""
    last = Window.partitionBy("product", *CELL).orderBy(F.col(later).desc())
    return tiles.withColumn("rn_", F.row_number().over(last)).filter("rn_ = 1").drop("rn_")


def mosaics(by_product: dict[str, DataFrame | None], products: Iterable[str] = ("dtm", "dsm", "chm", "slope", "aspect")) -> DataFrame | None:
    """The union of products' tiles; products without tiles are left out, and None is returned if none has any."""
    found = [by_product[p].withColumn("product", F.lit(p)) for p in products if by_product.get(p) is not None]
    out = None
    for f in found:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return None if out is None else mosaic(out)


def extent(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"))


def centre(rows: DataFrame) -> DataFrame:
    return extent(rows).select(((F.col("xmin") + F.col("xmax")) / 2).alias("center_x"), ((F.col("ymin") + F.col("ymax")) / 2).alias("center_y"))
