"""Treetops on a canopy raster, and the inventory: labels, metrics, summaries and binned counts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canopy, scalar as S
from ..functions.grid import GridSpec, with_cells


def treetops(chm: DataFrame, grid: GridSpec, window: Callable[[Column], Column] = S.window_size, least: float = 2.0, widest: float = 5.4, block: int = 256) -> DataFrame:
    """Cells of at least `least` with no higher cell within half their own window; of equal cells the first by (row, col).

    Cells go to blocks, with those within half the widest window around a block: one row a cell, and a few at blocks' edges.
    """
    pad = int(widest / 2 / grid.res + 1e-9)
    block = max(block, 2 * pad)
    reach = lambda v: F.sequence(F.floor((F.col(v) - pad) / F.lit(block)), F.floor((F.col(v) + pad) / F.lit(block)))

    def highest(key, held):
        c0, r0, side = int(key[0]) * block - pad, int(key[1]) * block - pad, block + 2 * pad
        row, col = held["row"].to_numpy() - r0, held["col"].to_numpy() - c0
        v, w = np.full((side, side), -np.inf), np.zeros((side, side))
        v[row, col], w[row, col] = held["value"].to_numpy(float), held["reach"].to_numpy(float)
        tops = np.array(canopy.highest_within(v, w, grid.res, least, widest), np.int64).reshape(-1, 2)
        tops = tops[((tops >= pad) & (tops < pad + block)).all(1)]
        return pd.DataFrame({"col": tops[:, 1] + c0, "row": tops[:, 0] + r0, "value": v[tops[:, 0], tops[:, 1]]})

    cells = chm.filter("value is not null").select("col", "row", F.col("value").cast("double").alias("value"), (window(F.col("value")) / 2).alias("reach"))
    dealt = cells.withColumn("bc", F.explode(reach("col"))).withColumn("br", F.explode(reach("row")))
    return dealt.groupBy("bc", "br").applyInPandas(highest, "col bigint, row bigint, value double")


def labelled(points: DataFrame, crowns: DataFrame, grid: GridSpec) -> DataFrame:
    """Points with the tree_id of the crown cell they are in; null outside crowns."""
    return with_cells(points, grid).join(crowns.select("col", "row", "tree_id"), ["col", "row"], "left").drop("col", "row")


def apex(z: str = "z") -> Column:
    """The highest point of a group; of equal ones the one of greatest x, then y."""
    return F.max(F.struct(z, "x", "y"))


def tree_metrics(points: DataFrame, extra: dict[str, Column] | None = None, height: str = "h") -> DataFrame:
    """tree_id, z (greatest height), npoints, x and y of the highest point, and any further aggregates."""
    a = F.max(F.struct(height, "x", "y"))
    out = points.filter("tree_id is not null").groupBy("tree_id").agg(a.alias("a"), F.count(F.lit(1)).alias("npoints"), *(c.alias(k) for k, c in (extra or {}).items()))
    return out.select("tree_id", F.col(f"a.{height}").alias("z"), "npoints", F.col("a.x").alias("x"), F.col("a.y").alias("y"), *(extra or {}))


def with_enough_points(trees: DataFrame, least: int = 5) -> DataFrame:
    return trees.filter(F.col("npoints") >= least)


def merged_by_name(layers: list[DataFrame], distinct_ids: bool = False) -> DataFrame:
    """All layers' rows; columns that a layer lacks are null. Columns stand in the order in which they first appear."""
    names = list(dict.fromkeys(c for layer in layers for c in layer.columns))
    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer, allowMissingColumns=True)
    out = out.select(*names)
    return out.dropDuplicates(["tree_id"]) if distinct_ids else out


#: Up to so many rows the quantiles of a column are one aggregate, which keeps a count of each value in one task.
FEW_VALUES = 2_000_000


def order_statistics(rows: DataFrame, column: str, ranks: list[int], enough: int = 10_000) -> dict[int, float]:
    """Exact values at 0-based ranks of a column's non-null values, without bringing them together.

    Each pass counts a thousand bins of each rank's interval, in partial sums, and narrows to the bin that holds the
    rank, until it has one value or few enough to be sorted.
    """
    v = rows.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    low, high, n = v.agg(F.min("v"), F.max("v"), F.count("v")).first()
    within = {k: (low, high, 0, n) for k in ranks}
    out: dict[int, float] = {}
    while open_ := {k: w for k, w in within.items() if k not in out}:
        for k, (lo, hi, below, held) in list(open_.items()):
            inside = v.filter((F.col("v") >= lo) & (F.col("v") <= hi))
            if lo == hi or held <= enough:
                out[k] = lo if lo == hi else inside.orderBy("v").offset(k - below).limit(1).first()[0]
                continue
            at = F.least(F.lit(999), F.floor((F.col("v") - lo) / ((hi - lo) / 1000)))
            bins = inside.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect()
            for b in bins:
                if below + b["n"] > k:
                    within[k] = (b["lo"], b["hi"], below, b["n"])
                    break
                below += b["n"]
    return out


def quantiles(rows: DataFrame, column: str, shares: tuple[float, ...]) -> list[float | None]:
    """Exact quantiles that interpolate between neighbouring values."""
    n = rows.filter(F.col(column).isNotNull()).count()
    if not n:
        return [None] * len(shares)
    places = [(n - 1) * p for p in shares]
    at = order_statistics(rows, column, sorted({int(x) + d for x in places for d in (0, 1) if int(x) + d < n}))
    return [at[int(x)] + (x - int(x)) * (at.get(int(x) + 1, at[int(x)]) - at[int(x)]) for x in places]


def summary(rows: DataFrame, columns: list[str], few: int = FEW_VALUES) -> DataFrame:
    """least, first quartile, median, mean, third quartile, greatest and the number of nulls of each column."""
    large, parts = rows.count() > few, []
    for c in columns:
        v = F.col(c).cast("double")
        if large:
            q = [F.lit(x).cast("double") for x in quantiles(rows, c, (0.25, 0.5, 0.75))]
        else:
            q = F.percentile(v, F.array(*(F.lit(p) for p in (0.25, 0.5, 0.75))))
        parts.append(F.struct(F.lit(c).alias("name"), F.min(v).alias("least"), q[0].alias("q1"), q[1].alias("median"), F.avg(v).alias("mean"), q[2].alias("q3"), F.max(v).alias("greatest"), F.count_if(v.isNull()).alias("n_null")))
    return rows.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def bin2d(rows: DataFrame, x: str, y: str, bins: int = 400, binwidth: tuple[float, float] | None = None) -> DataFrame:
    """bx, by, count, log_count of bins that hold rows with finite x and y.

    Bins are closed to the left and the greatest value is in the last one; a column with one value has one bin. With
    binwidth, bins are multiples of it.
    """
    d = rows.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter(S.finite(F.col("x")) & S.finite(F.col("y")))
    if binwidth:
        placed = d.select(F.floor(F.col("x") / binwidth[0]).cast("bigint").alias("bx"), F.floor(F.col("y") / binwidth[1]).cast("bigint").alias("by"))
    else:
        placed = d.crossJoin(F.broadcast(d.agg(*_ranges()))).select(*_bins(bins))
    return placed.groupBy("bx", "by").agg(F.count(F.lit(1)).alias("count")).withColumn("log_count", F.log10("count"))


def _ranges() -> list[Column]:
    return [f(c).alias(f"{f.__name__}_{c}") for c in "xy" for f in (F.min, F.max)]


def _bins(bins: int) -> list[Column]:
    at = lambda c: F.when(F.col(f"max_{c}") == F.col(f"min_{c}"), F.lit(0)).otherwise(F.least(F.floor((F.col(c) - F.col(f"min_{c}")) / ((F.col(f"max_{c}") - F.col(f"min_{c}")) / bins)), F.lit(bins - 1))).cast("bigint")
    return [at("x").alias("bx"), at("y").alias("by")]


def stacked_bins(rows: DataFrame, maps: tuple[tuple[str, str, str], ...], bins: int = 400) -> DataFrame:
    """map, bx, by, count, log_count: the bins of many heat maps (name, x, y), as bin2d makes them, in one pass for all ranges and one for all counts."""
    each = [F.struct(F.lit(name).alias("map"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for name, x, y in maps]
    d = rows.select(F.inline(F.array(*each))).filter(S.finite(F.col("x")) & S.finite(F.col("y")))
    box = d.groupBy("map").agg(*_ranges())  # a row for each heat map
    placed = d.join(F.broadcast(box), "map").select("map", *_bins(bins))
    return placed.groupBy("map", "bx", "by").agg(F.count(F.lit(1)).alias("count")).withColumn("log_count", F.log10("count"))


#: The nine heat maps of an inventory: name, x, y.
HEATMAPS = (
    ("height_slope", "slope_deg", "z"),
    ("height_northness", "northness", "z"),
    ("area_height", "z", "convhull_area"),
    ("area_elevation", "dtm_z", "convhull_area"),
    ("area_slope", "slope_deg", "convhull_area"),
    ("npoints_height", "z", "npoints"),
    ("npoints_area", "convhull_area", "npoints"),
    ("npoints_elevation", "dtm_z", "npoints"),
    ("height_elevation", "dtm_z", "z"),
)
