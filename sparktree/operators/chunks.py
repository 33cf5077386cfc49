"""Chunks: a core and its halo as one group, handed to a function of pandas frames.

All surface products of a chunk come from one pass: points are replicated to their chunks once, and the chunk's function
returns a tagged union of raster cells, labelled points, trees and its status.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import canopy, tin
from ..functions.grid import GridSpec, with_halo

RESULT = "product string, col bigint, row bigint, value double, point_id bigint, tree_id bigint, x double, y double, z double, npoints bigint, convhull_area double, chunk_x bigint, chunk_y bigint, stage string, reason string"


def apply_chunks(points: DataFrame, fn: Callable[[tuple[int, int], pd.DataFrame], pd.DataFrame], schema: str, size: float = 100.0, buffer: float = 10.0, done: DataFrame | None = None) -> DataFrame:
    """fn((chunk_x, chunk_y), points of the chunk with is_core) for each chunk that has a core point, in parallel.

    A group is a chunk with its halo; its size is bounded by the chunk's area and the cloud's density. The chunks of
    done (chunk_x, chunk_y) are left out before their points are dealt to groups, so nothing is computed for them.
    """

    def run(key, held):
        if not held["is_core"].any():
            return pd.DataFrame(columns=[f.split()[0] for f in schema.split(", ")])
        return fn((int(key[0]), int(key[1])), held)

    dealt = with_halo(points, size, buffer)
    if done is not None:
        dealt = dealt.join(done.select("chunk_x", "chunk_y").distinct(), ["chunk_x", "chunk_y"], "left_anti")
    return dealt.groupBy("chunk_x", "chunk_y").applyInPandas(run, schema)


def _attributes(points: DataFrame) -> DataFrame:
    """What chunks need of a cloud; a cloud may lack classes or return numbers, which are then null."""
    has = {c.lower() for c in points.columns}
    kinds = {"cls": "int", "return_number": "int"}
    return points.select("point_id", "xi", "yi", "x", "y", "z", *((F.col(c) if c in has else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()))


#: Classes of the ground for heights above it: ground, and water, which terrain is made without.
GROUND, LEVEL = 2, (2, 9)


def lattice(xmin: float, ymin: float, xmax: float, ymax: float, cm: int) -> tuple[int, int, int, int]:
    """First and last column and row of cells whose centres are in [xmin, xmax) x [ymin, ymax)."""
    first = lambda v: int(np.ceil((round(v * 100) - cm / 2) / cm))
    return first(xmin), first(ymin), first(xmax) - 1, first(ymax) - 1


def _horn(z: np.ndarray, res: float) -> tuple[np.ndarray, np.ndarray]:
    """Slope and aspect in degrees of the inner cells; NaN at borders and beside gaps. Rows go north."""
    zx, zy = np.full(z.shape, np.nan), np.full(z.shape, np.nan)
    if min(z.shape) >= 3:
        w, e, s, n = z[1:-1, :-2], z[1:-1, 2:], z[:-2, 1:-1], z[2:, 1:-1]
        sw, se, nw, ne = z[:-2, :-2], z[:-2, 2:], z[2:, :-2], z[2:, 2:]
        hole = np.isnan(z[1:-1, 1:-1])
        zx[1:-1, 1:-1] = np.where(hole, np.nan, ((ne + 2 * e + se) - (nw + 2 * w + sw)) / (8 * res))
        zy[1:-1, 1:-1] = np.where(hole, np.nan, ((nw + 2 * n + ne) - (sw + 2 * s + se)) / (8 * res))
    aspect = np.degrees(np.arctan2(-zx, -zy)) % 360
    return np.degrees(np.arctan(np.hypot(zx, zy))), np.where((zx == 0) & (zy == 0), 90.0, aspect)


def _gaps(grid: np.ndarray, empty: np.ndarray, cx: np.ndarray, cy: np.ndarray, fill: dict) -> np.ndarray:
    """Values of a raster's empty cells from the triangulated surface of the others.

    A triangle that covers an empty cell has only corners beside empty cells: a cell whose eight neighbours are there is a
    corner of no triangle but those with them. So cells without an empty neighbour are left out.
    """
    near = np.zeros(np.add(empty.shape, 2), bool)
    for dr in range(3):
        for dc in range(3):
            near[dr : dr + empty.shape[0], dc : dc + empty.shape[1]] |= empty
    use = near[1:-1, 1:-1] & ~empty
    return tin.interpolate(cx[use], cy[use], grid[use], cx[empty], cy[empty], **fill)


def _part(product: str, key: tuple[int, int], **columns) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk's result, a bounded number a batch; columns that aren't given are null."""
    n = len(next(iter(columns.values())))
    for s in range(0, n, OUT_ROWS):
        m = min(n - s, OUT_ROWS)
        fixed = {"product": pa.repeat(pa.scalar(product, pa.string()), m), "chunk_x": pa.repeat(pa.scalar(key[0], pa.int64()), m), "chunk_y": pa.repeat(pa.scalar(key[1], pa.int64()), m)}
        arrays = [fixed[f.name] if f.name in fixed else pa.array(columns[f.name][s : s + m], f.type, from_pandas=True) if f.name in columns else pa.nulls(m, f.type) for f in ARROW]
        yield pa.RecordBatch.from_arrays(arrays, schema=ARROW)


def _cells(product: str, key: tuple[int, int], grid: np.ndarray, c0: int, r0: int, core: tuple[int, int, int, int]) -> Iterator[pa.RecordBatch]:
    rows, cols = np.nonzero(~np.isnan(grid))
    c, r = cols + c0, rows + r0
    own = (c >= core[0]) & (c <= core[2]) & (r >= core[1]) & (r <= core[3])
    return _part(product, key, col=c[own], row=r[own], value=grid[rows[own], cols[own]])


#: Rows of a chunk that are worked on, or handed back, at once.
IN_ROWS, OUT_ROWS = 50_000, 50_000
#: Tasks that chunks are dealt to at least. A chunk's work goes by its area, so few bytes are no reason to put many into one task.
TASKS = 64
ARROW = pa.schema([(f.split()[0], {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}[f.split()[1]]) for f in RESULT.split(", ")])
#: What a chunk gets of a point, in this order; turn is that of its rows.
TAKEN = ("point_id", "xi", "yi", "x", "y", "z", "cls", "first", "turn")
ON_LEVEL, IN_CORE, IN_HALO = 0, 1, 2


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The rows in parts of about IN_ROWS of one turn: the level ones come first, then those of the core, then the halo's."""
    held, n, last = [], 0, ON_LEVEL

    def part():
        table = pa.Table.from_batches(held)
        return {c: table.column(c).to_numpy() for c in TAKEN}

    for batch in batches:
        turns = batch.column(batch.schema.get_field_index("turn")).to_numpy()
        if len(turns) and (turns[0] < last or (np.diff(turns) < 0).any()):
            raise RuntimeError("the rows of a chunk are out of order")
        for turn in np.unique(turns):
            rows = batch.slice(int(np.searchsorted(turns, turn)), int((turns == turn).sum()))
            if n and (turn != last or n >= IN_ROWS):
                yield part()
                held, n = [], 0
            held.append(rows)
            n, last = n + rows.num_rows, turn
    if n:
        yield part()


def _in_crowns(held: BinaryIO, number: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of HELD in cells with a number, of a file that they were written to."""
    held.seek(0)
    while rows := held.read(IN_ROWS * HELD.itemsize):
        part = np.frombuffer(rows, HELD)
        yield part[number[part["at"]] > 0]


#: A point that a crown may hold, with the place of its cell.
HELD = np.dtype([("point_id", "i8"), ("xi", "i8"), ("yi", "i8"), ("x", "f8"), ("y", "f8"), ("height", "f8"), ("at", "i4")])

TERRAIN = {"dtm", "slope", "aspect"}
#: Products for which no crowns are grown, and for which no point of a crown is needed.
RASTERS = {*TERRAIN, "dsm", "chm"}
COUNTED = {*RASTERS, "status"}


def process_chunk(key: tuple[int, int], batches: Iterator[pa.RecordBatch], cfg: PipelineConfig, only: tuple[str, ...] | None = None) -> Iterator[pa.RecordBatch]:
    """Terrain, surface, canopy, treetops, crowns and trees of one chunk; every early end leaves a status row.

    With only, what no product of that list depends on isn't computed; other products may be missing then.

    The rows come in the order of _gathered and are taken a part at a time. What stays of them is the level points, the highest
    return of each cell, and place and height of those that a crown of the chunk may hold; for a status, the cells these are in.
    """
    cm, res = round(cfg.resolution * 100), cfg.resolution
    x0, y0 = key[0] * cfg.chunk_size, key[1] * cfg.chunk_size
    halo = cfg.halo()
    core = lattice(x0, y0, x0 + cfg.chunk_size, y0 + cfg.chunk_size, cm)
    c0, r0, c1, r1 = lattice(x0 - halo, y0 - halo, x0 + cfg.chunk_size + halo, y0 + cfg.chunk_size + halo, cm)
    cols, rows = np.meshgrid(np.arange(c0, c1 + 1), np.arange(r0, r1 + 1))
    cx, cy = ((cols * cm + cm / 2) / 100.0).ravel(), ((rows * cm + cm / 2) / 100.0).ravel()
    shape = rows.shape
    del cols, rows
    fill = dict(k=cfg.idw_k, power=cfg.idw_power, furthest=cfg.idw_max)
    size = round(cfg.chunk_size * 100)

    def done(stage: str, reason: str) -> Iterator[pa.RecordBatch]:
        return _part("status", key, stage=[stage], reason=[reason])

    def cell(p):
        col, row = np.floor(p["xi"] / cm).astype(int) - c0, np.floor(p["yi"] / cm).astype(int) - r0
        return col, row, (col >= 0) & (col < shape[1]) & (row >= 0) & (row < shape[0])

    def of_core(p):
        return (p["xi"] // size == key[0]) & (p["yi"] // size == key[1])

    parts = _gathered(batches)
    level, water = [], []  # x, y, z, whether ground; whole rows that may be in crowns too
    dsm = np.full(shape, -np.inf)
    tops = canopy.Tops(res, cfg.subcircle)
    held = tempfile.TemporaryFile()  # rows of HELD: of most clouds few are in crowns, which are known last
    wanted = set(only) if only else None
    crowned, listed = (wanted is None or not wanted <= least for least in (RASTERS, COUNTED))
    occupied = np.zeros(shape, bool)  # cells with a point that a crown may hold
    surface = None
    has_core = False

    def highest(p):
        col, row, on = cell(p)
        np.maximum.at(dsm, (row[on], col[on]), p["z"][on])

    def over(p):
        """Heights of a part's points: into the tops, and those that crowns may hold are kept."""
        height = p["z"] - surface.at(p["x"], p["y"], **fill)
        use = (p["cls"] != GROUND) & (p["cls"] != -1) & (height >= 0) & (height <= cfg.hmax)
        # the canopy is that of first returns; a cloud without return numbers has none to leave out
        top = use & p["first"]
        tops.add(p["x"][top], p["y"][top], height[top], p["point_id"][top])
        if not crowned:
            return
        col, row, on = cell(p)
        keep = use & on & (of_core(p) if cfg.edge == "core" else True)
        occupied[row[keep], col[keep]] = True
        if listed:
            rest = np.empty(int(keep.sum()), HELD)
            for c in ("point_id", "xi", "yi", "x", "y"):
                rest[c] = p[c][keep]
            rest["height"], rest["at"] = height[keep], row[keep] * shape[1] + col[keep]
            held.write(rest)

    part = next(parts, None)
    while part is not None and part["turn"][0] == ON_LEVEL:
        has_core |= bool(of_core(part).any())
        highest(part)
        ground = part["cls"] == GROUND
        level.append((part["x"], part["y"], part["z"], ground))
        if not ground.all():
            water.append({c: v[~ground] for c, v in part.items()})
        part = next(parts, None)
    if not has_core and (part is None or part["turn"][0] != IN_CORE):
        for _ in parts:
            pass
        return
    lx, ly, lz, ground = (np.concatenate(v) for v in zip(*level)) if level else (np.empty(0), np.empty(0), np.empty(0), np.empty(0, bool))
    level.clear()
    dtm = None
    if ground.any() and wanted != {"dsm"}:
        surface = tin.Surface(lx[ground], ly[ground], lz[ground])
        dtm = surface.at(cx, cy, **fill).reshape(shape)
        slope, aspect = _horn(dtm, res)
        for name, grid in (("dtm", dtm), ("slope", slope), ("aspect", aspect)):
            yield from _cells(name, key, grid, c0, r0, core)
        del slope, aspect, grid
    if wanted and wanted <= TERRAIN:
        for _ in parts:
            pass
        return
    if len(lx) > ground.sum() and wanted != {"dsm"}:
        surface = tin.Surface(lx, ly, lz)
    del lx, ly, lz
    while part is not None:
        highest(part)
        if surface is not None:
            over(part)
        part = next(parts, None)
    for p in water if surface is not None else ():
        over(p)
    water.clear()
    surface = None
    # highest return of each cell; empty cells from the surface of the others
    dsm[np.isinf(dsm)] = np.nan
    empty = np.isnan(dsm)
    if empty.any() and not empty.all():
        dsm[empty] = _gaps(dsm, empty, cx.reshape(shape), cy.reshape(shape), fill)
    yield from _cells("dsm", key, dsm, c0, r0, core)
    if wanted == {"dsm"}:
        return
    if not len(ground):
        yield from done("normalize", "no ground points")
        return
    chm = tops.pit_free(cx, cy, cfg.hmax, cfg.canopy_levels, cfg.max_edge).reshape(shape)
    if np.isnan(chm).all() and dtm is not None:
        chm = np.where(dsm - dtm >= 0, dsm - dtm, np.nan)
    yield from _cells("chm", key, chm, c0, r0, core)
    if not crowned:
        return
    inner = np.zeros(shape, bool)
    inner[core[1] - r0 : core[3] - r0 + 1, core[0] - c0 : core[2] - c0 + 1] = True
    seen = chm if cfg.edge == "halo" else np.where(inner, chm, np.nan)
    most = np.nanmax(np.where(inner, chm, np.nan)) if not np.isnan(np.where(inner, chm, np.nan)).all() else np.nan
    if not most >= cfg.hmin:
        yield from done("gate", "canopy below hmin")
        return
    peaks = canopy.local_maxima(seen, res, cfg.hmin, cfg.hmax, cfg.lmf_hmin)
    if not peaks:
        yield from done("treetops", "none found")
        return
    crowns = canopy.grow_crowns(seen, peaks, cfg.th_tree, cfg.th_seed, cfg.th_cr, cfg.max_cr)
    # a tree is the chunk's if its apex cell is in the core
    own = np.array([False, *(bool(inner[t]) for t in peaks)])
    number = np.where(own[crowns], crowns, 0).ravel()
    if not (occupied.ravel() & (number > 0)).any():
        yield from done("crowns", "no points in crowns")
        return
    if not listed:
        yield from done("done", "")
        return
    found = np.concatenate(list(_in_crowns(held, number)))
    held.close()
    pid, xi, yi, x, y, height, number = *(found[c] for c in ("point_id", "xi", "yi", "x", "y", "height")), number[found["at"]]
    order = np.lexsort((pid, number))
    trees, ids = [], np.full(len(peaks) + 1, -1, np.int64)
    for i in np.split(order, np.flatnonzero(np.diff(number[order])) + 1):
        a = i[np.lexsort((-y[i], -x[i], -height[i]))[0]]
        ids[number[a]] = (int(xi[a]) << 32) | (int(yi[a]) & 0xFFFFFFFF)
        trees.append((ids[number[a]], x[a], y[a], height[a], len(i), round(tin.hull_area(x[i], y[i]), 3)))
    del order
    yield from _part("points", key, point_id=pid, tree_id=ids[number], x=x, y=y, z=height)
    found = [t for t in trees if t[4] >= cfg.min_points]
    if found:
        yield from _part("trees", key, **dict(zip(("tree_id", "x", "y", "z", "npoints", "convhull_area"), map(list, zip(*found)))))
    crown_rows, crown_cols = np.nonzero(inner & (crowns > 0) & (ids[crowns] != -1))
    yield from _part("crowns", key, col=crown_cols + c0, row=crown_rows + r0, tree_id=ids[crowns[crown_rows, crown_cols]])
    yield from done("done", "")


def _highest(dealt: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The highest of each cell of a chunk, of its core and of its halo: all that a surface takes of a cloud, in rows as a chunk gets them."""
    grid = GridSpec(cfg.resolution, cfg.crs)
    cells = dealt.groupBy("chunk_x", "chunk_y", "is_core", grid.col(F.col("xi")).alias("col"), grid.col(F.col("yi")).alias("row"))
    tops = cells.agg(F.min("xi").cast("bigint").alias("xi"), F.min("yi").cast("bigint").alias("yi"), F.max("z").alias("z"))
    turn = F.when(F.col("is_core"), IN_CORE).otherwise(IN_HALO)
    place = (F.col(c + "i") / 100 for c in "xy")
    return tops.select("chunk_x", "chunk_y", F.lit(0).cast("bigint").alias("point_id"), "xi", "yi", *(p.alias(c) for p, c in zip(place, "xy")), "z", F.lit(-1).alias("cls"), F.lit(True).alias("first"), turn.alias("turn"))


def chunk_products(points: DataFrame, cfg: PipelineConfig | None = None, done: DataFrame | None = None, only: tuple[str, ...] | None = None) -> DataFrame:
    """The tagged union of all chunks' products of points(point_id, xi, yi, x, y, z and, if it has them, cls, return_number), columns as in RESULT.

    A chunk's rows are sorted by turn and handed over in batches, so no task holds a chunk's whole cloud.
    only: products without which the others need not be computed, as in process_chunk; None is all.
    """
    cfg = cfg or PipelineConfig()
    dealt = with_halo(_attributes(points), cfg.chunk_size, cfg.halo())
    if done is not None:
        dealt = dealt.join(done.select("chunk_x", "chunk_y").distinct(), ["chunk_x", "chunk_y"], "left_anti")
    cls = F.coalesce("cls", F.lit(-1))
    turn = F.when(cls.isin(*LEVEL), ON_LEVEL).when(F.col("is_core"), IN_CORE).otherwise(IN_HALO)
    rows = dealt.select("chunk_x", "chunk_y", "point_id", "xi", "yi", "x", "y", "z", cls.alias("cls"), F.coalesce(F.col("return_number") == 1, F.lit(True)).alias("first"), turn.alias("turn"))

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from process_chunk((key[0].as_py(), key[1].as_py()), batches, cfg, only)

    if only and set(only) == {"dsm"}:
        rows = _highest(dealt, cfg)
    elif only and set(only) <= TERRAIN:
        rows = rows.filter(F.col("turn") != IN_HALO)  # terrain is that of level points; the core's others tell that it has points
    tasks = max(TASKS, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, "chunk_x", "chunk_y").sortWithinPartitions("chunk_x", "chunk_y", "turn").groupBy("chunk_x", "chunk_y").applyInArrow(run, RESULT)


def interpolated_ground(points: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The points with ground, the height of the ground's triangulated surface, and height above it, from chunks with halo."""

    def run(key, held):
        g = held[held["cls"].isin(LEVEL)]
        core = held[held["is_core"]]
        h = tin.interpolate(g["x"], g["y"], g["z"], core["x"], core["y"], k=cfg.idw_k, power=cfg.idw_power, furthest=cfg.idw_max)
        ground = pd.Series(h, dtype=object).where(~np.isnan(h), None)
        above = core["z"].to_numpy(float) - h
        return pd.DataFrame({"point_id": core["point_id"].to_numpy(), "x": core["x"].to_numpy(), "y": core["y"].to_numpy(), "z": core["z"].to_numpy(), "cls": core["cls"].to_numpy(), "ground": ground.to_numpy(), "height": pd.Series(above, dtype=object).where(~np.isnan(above), None).to_numpy()})

    return apply_chunks(_attributes(points).drop("return_number"), run, "point_id bigint, x double, y double, z double, cls int, ground double, height double", cfg.chunk_size, cfg.chunk_buffer)


def rasterized_crowns(chm: DataFrame, grid: GridSpec, cfg: PipelineConfig, size: float = 100.0) -> DataFrame:
    """col, row, tree_id of crowns grown on a canopy raster in chunks with halo; a crown is named by its top's cell."""
    halo = cfg.max_cr * grid.res + 2.7
    centres = chm.select("col", "row", "value", grid.centre_cm(F.col("col")).cast("bigint").alias("xi"), grid.centre_cm(F.col("row")).cast("bigint").alias("yi"))

    def run(key, held):
        c0, r0 = held["col"].min(), held["row"].min()
        v = np.full((held["row"].max() - r0 + 1, held["col"].max() - c0 + 1), np.nan)
        v[held["row"] - r0, held["col"] - c0] = held["value"].to_numpy(float)
        tops = canopy.local_maxima(v, grid.res, cfg.hmin, cfg.hmax, cfg.lmf_hmin)
        crowns = canopy.grow_crowns(v, tops, cfg.th_tree, cfg.th_seed, cfg.th_cr, cfg.max_cr)
        ids = np.array([-1, *(((c + c0) << 32) | ((r + r0) & 0xFFFFFFFF) for r, c in tops)], np.int64)
        core = held[held["is_core"]]
        k = crowns[core["row"] - r0, core["col"] - c0]
        return pd.DataFrame({"col": core["col"].to_numpy()[k > 0], "row": core["row"].to_numpy()[k > 0], "tree_id": ids[k[k > 0]]})

    return apply_chunks(centres, run, "col bigint, row bigint, tree_id bigint", size, halo)
