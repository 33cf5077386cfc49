"""The tile index: newest acquisition by map sheet, name filters, links, what is still to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as S


def latest_per_tile(tiles: DataFrame, order: str = "tile_row") -> DataFrame:
    """The row of greatest year of each maptile; ties by `order`. Nulls of year come last; null tiles are one group."""
    newest = Window.partitionBy("maptile").orderBy(F.col("year").desc_nulls_last(), F.col(order))
    return tiles.withColumn("base_tile", F.col("maptile")).withColumn("rn_", F.row_number().over(newest)).filter("rn_ = 1").drop("rn_")


def parsed(tiles: DataFrame) -> DataFrame:
    return tiles.withColumns({"tile_number": S.tile_number(F.col("maptile")), "subdivision": S.tile_subdivision(F.col("maptile"))})


def of_year_and_sheet(tiles: DataFrame, year: int, map_tile: str, letter: str, numbers: list[str] | str = "all") -> DataFrame:
    """Tiles of a year whose name starts with the sheet and one of the numbers; "all" is one prefix, not a thousand."""
    sheet = (map_tile + letter).lower()
    prefixes = [sheet] if numbers == "all" else [f"{sheet}{int(n):03d}" for n in numbers]
    return tiles.filter((F.col("year") == year) & S.any_prefix(F.col("maptile"), prefixes))


def since(tiles: DataFrame, min_year: int | None) -> DataFrame:
    return tiles if min_year is None else tiles.filter(F.col("year") >= min_year)


def in_subdivisions(tiles: DataFrame, wanted: list[str]) -> DataFrame:
    return parsed(tiles).filter(F.col("subdivision").isin(wanted))


def subdivision_grid(spark: SparkSession, n: int = 4) -> DataFrame:
    a, b, c = (spark.range(1, n + 1).withColumnRenamed("id", k) for k in "abc")
    return a.crossJoin(b).crossJoin(c).select(F.concat_ws("_", "a", "b", "c").alias("subdivision"))


def with_url(tiles: DataFrame, prefix: str) -> DataFrame:
    if "s3Url" not in tiles.columns:
        raise ValueError("the tile index has no column s3Url")
    return tiles.withColumn("url", S.tile_url(F.col("s3Url"), F.col("path"), prefix))


def intersecting(boxes: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    return boxes.filter((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def intersecting_areas(boxes: DataFrame, areas: DataFrame) -> DataFrame:
    """Tiles with each area whose envelope they meet. Areas are a handful; Spark broadcasts them by their size."""
    a = areas.select("aoi_id", *(F.col(c).alias(f"a_{c}") for c in ("xmin", "ymin", "xmax", "ymax")))
    meets = (F.col("xmin") <= F.col("a_xmax")) & (F.col("xmax") >= F.col("a_xmin")) & (F.col("ymin") <= F.col("a_ymax")) & (F.col("ymax") >= F.col("a_ymin"))
    return boxes.join(a, meets).drop("a_xmin", "a_ymin", "a_xmax", "a_ymax")


def named(files: DataFrame, names: DataFrame | None) -> DataFrame:
    """Files whose basename is wanted; all if no names are given. Equal names in two folders are both kept."""
    return files if names is None else files.join(names.select("name").distinct(), "name", "left_semi")


def missing(tiles: DataFrame, present: DataFrame) -> DataFrame:
    return tiles.join(present.select("filename"), "filename", "left_anti")


def year_range(tiles: DataFrame) -> DataFrame:
    return tiles.agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def download_estimate(tiles: DataFrame, mb: float = 50.0) -> DataFrame:
    gb = F.count(F.lit(1)) * mb / 1024.0
    return tiles.agg(F.count(F.lit(1)).alias("n_tiles"), gb.alias("gb"), F.format_string("%.1f", gb).alias("gb_text"))


def outcome(results: DataFrame) -> DataFrame:
    ok: Column = F.col("success")
    return results.agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"))


def first_failures(results: DataFrame, n: int = 5) -> DataFrame:
    """The first n failures by file, each with the number of those not listed."""
    failed = results.filter(~F.col("success"))
    more = failed.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("n_more"))
    return failed.orderBy("file").limit(n).crossJoin(F.broadcast(more))
