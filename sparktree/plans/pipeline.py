"""The entry points: acquire tiles, process a catalogue of chunks, a sample window, mosaics and scene analytics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DownloadConfig, PipelineConfig
from ..functions import scalar as S
from ..functions.grid import GridSpec
from ..operators import chunks, points as P, raster as R, tiles as L, trees as T
from ..operators.daylight import sun_table, time_in_daylight

PRODUCTS = ("dtm", "dsm", "chm", "slope", "aspect")
TREE = ("tree_id", "x", "y", "z", "npoints", "convhull_area")


class PipelineError(ValueError):
    """An input without which a stage can't run."""


def select_tiles(index: DataFrame, cfg: DownloadConfig, aoi: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Tiles to fetch: by the envelope of an area, newest of each sheet; or by sheet, year and subdivision."""
    if cfg.use_aoi:
        if aoi is None:
            raise PipelineError("an area of interest is asked for and none is given")
        found = L.since(L.intersecting(index, *aoi) if "xmin" in index.columns else index, cfg.min_year)
        return L.latest_per_tile(found) if cfg.most_recent else found
    found = L.of_year_and_sheet(index, cfg.year, cfg.map_tile, cfg.letter, cfg.tile_numbers)
    return found if cfg.subdivisions == "all" else L.in_subdivisions(found, list(cfg.subdivisions))


def acquire(index: DataFrame, present: DataFrame, cfg: DownloadConfig, prefix: str, fetch: Callable[[str, str], dict], aoi=None, confirm: Callable[[int], bool] = lambda n: True) -> DataFrame:
    """Fetches the selected tiles that aren't present; returns success, file, status, error of each.

    confirm is asked when there are more than 100; if it declines, nothing is fetched and no row returned.
    """
    from ..sources.download import fetched

    todo = L.with_url(L.missing(select_tiles(index, cfg, aoi), present), prefix)
    n = todo.count()
    if n > 100 and not confirm(n):
        todo = todo.limit(0)
    return fetched(todo, fetch, cfg.max_workers if cfg.parallel else 1)


def catalog_pipeline(points: DataFrame, cfg: PipelineConfig | None = None, done: DataFrame | None = None, only: tuple[str, ...] | None = None) -> DataFrame:
    """All products of all chunks, or with only at least those of that list. done (chunk_x, chunk_y): chunks of an earlier run, such as those of finished_chunks, for
    which nothing is computed again (a restart)."""
    cfg = cfg or PipelineConfig()
    once = points if only and set(only) == {"dsm"} else P.deduplicated(points)  # copies change no cell's highest
    return chunks.chunk_products(once, cfg, done, only)


def rasters(result: DataFrame, product: str) -> DataFrame:
    return result.filter(F.col("product") == product).select("col", "row", "value")


def wide_terrain(result: DataFrame) -> DataFrame:
    """dtm_z, slope_deg, aspect_deg of each cell in one row, so that trees are joined once."""
    of = lambda p: F.max(F.when(F.col("product") == p, F.col("value")))
    return result.filter(F.col("product").isin("dtm", "slope", "aspect")).groupBy("col", "row").agg(of("dtm").alias("dtm_z"), of("slope").alias("slope_deg"), of("aspect").alias("aspect_deg"))


def inventory(result: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Trees with the ground's elevation, slope and aspect at the apex; null where there is no terrain.

    Trees and terrain meet by cell in one grouping, so the result, which may be a whole run of the chunks, is read once.
    """
    grid = GridSpec(cfg.resolution, cfg.crs)
    tree = F.col("product") == "trees"
    at = lambda cell, v: F.when(tree, grid.col(F.round(F.col(v) * 100).cast("bigint"))).otherwise(F.col(cell)).alias(cell)
    rows = result.filter(F.col("product").isin("trees", "dtm", "slope", "aspect")).select("product", at("col", "x"), at("row", "y"), "value", F.when(tree, F.struct(*TREE)).alias("tree"))
    of = lambda p: F.max(F.when(F.col("product") == p, F.col("value")))
    cells = rows.groupBy("col", "row").agg(F.collect_list("tree").alias("trees"), of("dtm").alias("dtm_z"), of("slope").alias("slope_deg"), of("aspect").alias("aspect_deg"))
    return cells.select(F.explode("trees").alias("t"), "dtm_z", "slope_deg", "aspect_deg").select(*(f"t.{c}" for c in TREE), "dtm_z", "slope_deg", "aspect_deg")


def statuses(result: DataFrame) -> DataFrame:
    return result.filter("product = 'status'").select("chunk_x", "chunk_y", "stage", "reason")


def sample_pipeline(points: DataFrame, cfg: PipelineConfig | None = None, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Products and trees of one random window of a cloud, taken as one chunk without a halo, with hillshade."""
    cfg = replace(cfg or PipelineConfig(), edge="core", chunk_buffer=0.0)
    window = P.deduplicated(P.sample_window(points, cfg.bbox_size, seed))
    result = chunks.chunk_products(window, replace(cfg, chunk_size=cfg.bbox_size))
    slope = result.filter("product = 'slope'").select("col", "row", F.col("value").alias("slope"), "chunk_x", "chunk_y")
    aspect = result.filter("product = 'aspect'").select("col", "row", F.col("value").alias("aspect"))
    shade = slope.join(aspect, ["col", "row"]).select(F.lit("hillshade").alias("product"), "col", "row", S.hillshade(F.col("slope"), F.col("aspect"), cfg.hillshade_angle, cfg.hillshade_direction).alias("value"), "chunk_x", "chunk_y")
    return result.unionByName(shade, allowMissingColumns=True), inventory(result, cfg)


def _by_chunk(rows: DataFrame, path: str, *by: str) -> None:
    """One folder for each value of `by`; a rerun of some chunks overwrites those and no others."""
    rows.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def write_products(result: DataFrame, path: str, trees: DataFrame | None = None, size: float = 100.0) -> None:
    """Rasters by product and chunk, statuses, and the trees of an inventory by the chunk of their apex.

    The folders are path itself, path-status and path-trees. Statuses are written last: a chunk that has one is whole.
    """
    path = path.rstrip("/")
    _by_chunk(result.filter(F.col("product").isin(*PRODUCTS)).select("product", "chunk_x", "chunk_y", "col", "row", "value"), path, "product", "chunk_x", "chunk_y")
    if trees is not None:
        of = lambda c: F.floor(F.round(F.col(c) * 100) / F.lit(round(size * 100))).cast("bigint")
        _by_chunk(trees.withColumns({"chunk_x": of("x"), "chunk_y": of("y")}), path + "-trees", "chunk_x", "chunk_y")
    if "stage" in result.columns:
        _by_chunk(statuses(result), path + "-status", "chunk_x", "chunk_y")


def finished_chunks(spark: SparkSession, path: str) -> DataFrame:
    """chunk_x, chunk_y of the chunks that write_products has written to path, however they ended."""
    return spark.read.parquet(path.rstrip("/") + "-status").select(F.col("chunk_x").cast("bigint"), F.col("chunk_y").cast("bigint")).distinct()


def merged_trees(spark: SparkSession, path: str) -> DataFrame:
    """All trees that write_products has written, their columns united by name; null where a chunk's trees lack one."""
    return spark.read.option("mergeSchema", "true").parquet(path.rstrip("/") + "-trees").drop("chunk_x", "chunk_y")


def write_mosaics(spark: SparkSession, path: str, out: str) -> list[str]:
    """A sorted Parquet mosaic of each product in out; products without tiles are left out. Returns those written.

    Rows are dealt by ranges of row and column, so each file is a block of the mosaic and readers skip the others.
    """
    found = spark.read.parquet(path)
    has = {r[0] for r in found.select("product").distinct().collect()}  # a handful of names
    for product in (p for p in PRODUCTS if p in has):
        cells = found.filter(F.col("product") == product).select("col", "row", "value")
        cells.repartitionByRange("row", "col").sortWithinPartitions("row", "col").write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/{product}_mosaic")
    return [p for p in PRODUCTS if p in has]


def read_products(spark: SparkSession, path: str, product: str, bbox: tuple[float, float, float, float] | None = None, size: float = 100.0) -> DataFrame:
    """A product's tiles as one lazy mosaic; with a box, only the folders of its chunks are read."""
    found = spark.read.parquet(path).filter(F.col("product") == product)
    if bbox:
        found = found.filter(F.col("chunk_x").between(int(bbox[0] // size), int(bbox[2] // size)) & F.col("chunk_y").between(int(bbox[1] // size), int(bbox[3] // size)))
    return found


def scene_daylight(dsm: DataFrame, grid: GridSpec, cfg: PipelineConfig) -> DataFrame:
    """Time in daylight of a surface mosaic, with the sun's track at the scene's centre."""
    x, y = grid.centre(F.col("col")), grid.centre(F.col("row"))
    c = R.centre(dsm.select(x.alias("x"), y.alias("y")))
    lon, lat = S.albers_inverse(F.col("center_x"), F.col("center_y"))
    at = c.select(lon.alias("lon"), lat.alias("lat")).first()
    if at["lon"] is None:
        raise PipelineError("the surface has no cells")
    sun = sun_table(dsm.sparkSession, at["lat"], at["lon"], cfg.utc_offset, cfg.start_day, cfg.end_day, cfg.start_time, cfg.end_time, cfg.time_step_minutes)
    return time_in_daylight(dsm, grid, sun, cfg.az_fraction, cfg.max_dist)


def heatmaps(trees: DataFrame, bins: int = 400) -> DataFrame:
    """The nine heat maps of an inventory in one table, told apart by the column map; the inventory is read twice in all."""
    return T.stacked_bins(trees.withColumn("northness", S.northness(F.col("aspect_deg"))), T.HEATMAPS, bins)


def statistics(trees: DataFrame, bins: int = 400) -> dict[str, DataFrame]:
    """The nine heat maps of an inventory, each as a table of its own; heatmaps makes all of them at once."""
    d = trees.withColumn("northness", S.northness(F.col("aspect_deg")))
    return {name: T.bin2d(d, x, y, bins) for name, x, y in T.HEATMAPS}
