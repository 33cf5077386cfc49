"""Deterministic stand-ins for LiDAR inputs, derived from the driver's tables, with the same SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import basename

#: A 400 m x 400 m cloud on a tilted plane: slope and aspect of the ground are known.
POINTS = """
SELECT point_id, xi, yi, CAST(xi AS DOUBLE) / 100.0 AS x, CAST(yi AS DOUBLE) / 100.0 AS y,
       CAST(1000000 + 10 * xi + 5 * yi + CASE WHEN cls = 2 THEN 0 ELSE 100 * hi END AS DOUBLE) / 10000.0 AS z,
       CAST(1000000 + 10 * xi + 5 * yi AS DOUBLE) / 10000.0 AS g,
       CASE WHEN cls = 2 THEN CAST(0 AS DOUBLE) ELSE CAST(hi AS DOUBLE) / 100.0 END AS h, cls
FROM (SELECT l_orderkey * 8 + l_linenumber AS point_id,
             (l_orderkey * 7919 + l_linenumber * 1049 + l_partkey * 13) % 40000 AS xi,
             (l_suppkey * 6101 + l_partkey * 337 + l_linenumber * 2003) % 40000 AS yi,
             CAST(floor(l_extendedprice / 30) AS BIGINT) AS hi,
             CASE WHEN l_linenumber = 1 THEN 2 ELSE 5 END AS cls
      FROM lineitem) b"""

#: An inventory on a lattice of 5 m, with what an inventory has: height, points, area, elevation, slope, aspect.
TREES = f"""
SELECT tree_id, z, npoints, CAST(npoints * 125 % 4000 AS DOUBLE) / 100.0 AS convhull_area,
       CASE WHEN tree_id % 17 = 0 THEN NULL ELSE dtm_z END AS dtm_z,
       CAST(tree_id % 4500 AS DOUBLE) / 100.0 AS slope_deg,
       CASE WHEN tree_id % 23 = 0 THEN NULL ELSE CAST(tree_id * 7 % 72000 AS DOUBLE) / 100.0 - 360.0 END AS aspect_deg
FROM (SELECT CAST(floor(xi / 500) AS BIGINT) * 100000 + CAST(floor(yi / 500) AS BIGINT) AS tree_id, max(h) AS z, count(*) AS npoints, min(g) AS dtm_z
      FROM ({POINTS}) p WHERE cls <> 2 AND h BETWEEN 0 AND 30 GROUP BY 1) t"""

_TILES = """
SELECT CAST(o_orderkey AS BIGINT) AS tile_row,
       concat('093', substr('abcdefghijkl', CAST(o_custkey % 12 + 1 AS INT), 1), lpad(CAST(o_custkey % 1000 AS {text}), 3, '0'), '_',
              CAST(1 + o_custkey % 4 AS {text}), '_', CAST(1 + CAST(floor(o_custkey / 4) AS BIGINT) % 4 AS {text}), '_',
              CAST(1 + CAST(floor(o_custkey / 16) AS BIGINT) % 4 AS {text})) AS maptile,
       CAST(year(o_orderdate) AS INT) AS year,
       concat('bc_', CAST(o_orderkey AS {text}), '.laz') AS filename,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '' ELSE concat('https://host/', CAST(o_orderkey AS {text}), '.laz') END AS s3Url,
       concat({slash}, 'y', {slash}, CAST(o_orderkey AS {text}), '.laz') AS path
FROM orders"""
TILES = _TILES.format(text="VARCHAR", slash="chr(92)")
TILES_SPARK = _TILES.format(text="STRING", slash="chr(92)")


def _over(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {table}", "FROM {source}"), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, sf_dir, "lineitem", POINTS)


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, sf_dir, "lineitem", TREES)


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, sf_dir, "orders", TILES_SPARK)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder listing: every tile's file, in one of two folders."""
    t = tiles(spark, sf_dir)
    path = F.concat(F.lit("/lidar/"), (F.col("tile_row") % 2).cast("string"), F.lit("/"), "filename")
    return t.select(path.alias("file")).withColumn("name", basename(F.col("file")))
