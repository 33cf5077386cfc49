"""All queries of the engine's own operators, over whole tables, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import scalar as S
from ..functions.grid import GridSpec, chunk_of, circle_offsets, dense_cells, with_cells, with_halo
from ..operators import chunks, points as P, raster as R, tiles as L, trees as T
from ..operators.daylight import ray, sun_table, time_in_daylight
from . import pipeline, views as V

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

PREFIX = "https://host/"
G5, G10, G20 = GridSpec(5.0), GridSpec(10.0), GridSpec(20.0)
WITH_POINTS = f"WITH points AS ({V.POINTS})"
WITH_TREES = f"WITH trees AS ({V.TREES})"
WITH_TILES = f"WITH tiles AS ({V.TILES})"


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        _QUERIES[key] = f
        if sql:
            _ORACLES[key] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Functions of floating point differ in the last digit between engines."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- points ------------------------------------------------------------------------------------------------------


@query(f"""{WITH_POINTS}, twice AS (SELECT * FROM points UNION ALL SELECT * FROM points WHERE cls = 2)
SELECT xi, yi, z, min(point_id) AS point_id FROM twice GROUP BY xi, yi, z""")
def point_dedupe(spark, d):
    p = V.points(spark, d)
    return P.deduplicated(p.unionByName(P.ground(p))).select("xi", "yi", "z", "point_id")


@query(f"{WITH_POINTS} SELECT point_id, xi, yi, z FROM points WHERE cls = 2")
def ground_points(spark, d):
    return P.ground(V.points(spark, d)).select("point_id", "xi", "yi", "z")


@query(f"{WITH_POINTS} SELECT point_id, xi, yi, h FROM points WHERE cls <> 2 AND h BETWEEN 0 AND 30")
def nonground_height_band(spark, d):
    return P.height_band(P.not_ground(V.points(spark, d))).select("point_id", "xi", "yi", "h")


@query(f"{WITH_POINTS} SELECT point_id, x, y, z FROM points WHERE x BETWEEN 120.5 AND 220.5 AND y BETWEEN 80 AND 180")
def clip_rectangle(spark, d):
    return P.clipped(V.points(spark, d), 120.5, 80.0, 220.5, 180.0).select("point_id", "x", "y", "z")


RING = [(50.0, 40.0), (350.0, 80.0), (300.0, 330.0), (120.0, 260.0)]
_CROSSINGS = " + ".join(f"CASE WHEN (y > {y1}) <> (y > {y2}) AND x < {x2 - x1} * (y - {y1}) / {y2 - y1} + {x1} THEN 1 ELSE 0 END" for (x1, y1), (x2, y2) in zip(RING, RING[1:] + RING[:1]) if y1 != y2)


@query(f"{WITH_POINTS} SELECT point_id, x, y FROM (SELECT point_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM points) p WHERE ({_CROSSINGS}) % 2 = 1")
def clip_polygon(spark, d):
    return P.clipped_to_ring(V.points(spark, d), RING).select("point_id", "x", "y")


@query("SELECT event_id, value FROM events WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value) AND event_id % 3 <> 0")
def finite_filter(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))).otherwise(F.col("value")).alias("value"))
    return P.all_finite(e, "value")


@query(f"""{WITH_POINTS} SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_null, count(*) - (SELECT count(*) FROM (SELECT DISTINCT xi, yi, z FROM points)) AS n_duplicates,
  count(*) FILTER (WHERE cls = 2) AS n_ground, CAST(0 AS BIGINT) AS n_unclassified, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax FROM points""")
def catalog_check(spark, d):
    return P.checked(V.points(spark, d))


# --- tiles -------------------------------------------------------------------------------------------------------


def _wanted(spark: SparkSession, d: str) -> DataFrame:
    return V.tiles(spark, d).filter(F.col("tile_row") % 5 == 0).select(F.col("filename").alias("name"))


@query(f"""{WITH_TILES} SELECT concat('/lidar/', CAST(tile_row % 2 AS VARCHAR), '/', filename) AS file, filename AS name FROM tiles WHERE tile_row % 5 = 0""")
def catalog_files_semi(spark, d):
    return L.named(V.files(spark, d), _wanted(spark, d)).select("file", "name")


@query(f"{WITH_TILES} SELECT tile_row, filename FROM tiles WHERE tile_row % 3 <> 0")
def tiles_anti_existing(spark, d):
    t = V.tiles(spark, d)
    return L.missing(t, t.filter(F.col("tile_row") % 3 == 0)).select("tile_row", "filename")


@query("SELECT concat(CAST(a AS VARCHAR), '_', CAST(b AS VARCHAR), '_', CAST(c AS VARCHAR)) AS subdivision FROM range(1, 5) x(a), range(1, 5) y(b), range(1, 5) z(c)")
def subdivision_grid(spark, d):
    return L.subdivision_grid(spark)


@query(f"""{WITH_TILES} SELECT maptile, maptile AS base_tile, year, filename FROM tiles
QUALIFY row_number() OVER (PARTITION BY maptile ORDER BY year DESC NULLS LAST, tile_row) = 1""")
def tile_latest_year(spark, d):
    return L.latest_per_tile(V.tiles(spark, d)).select("maptile", "base_tile", "year", "filename")


@query(f"""{WITH_TILES} SELECT tile_row, maptile, regexp_replace(maptile, '.*([0-9]{{3}}).*', '\\1') AS tile_number, regexp_replace(maptile, '^[^_]*_', '') AS subdivision FROM tiles""")
def tile_parse(spark, d):
    return L.parsed(V.tiles(spark, d)).select("tile_row", "maptile", "tile_number", "subdivision")


@query(f"""{WITH_TILES} SELECT tile_row, maptile FROM tiles WHERE year = 1996 AND (maptile LIKE '093h04%' OR maptile LIKE '093h1%' OR maptile LIKE '093h50%')
  AND regexp_matches(maptile, '^093h(0[4][0-9]|1[0-9][0-9]|50[0-9])')""")
def tile_filter_like(spark, d):
    numbers = [str(n) for n in [*range(40, 50), *range(100, 200), *range(500, 510)]]
    return L.of_year_and_sheet(V.tiles(spark, d), 1996, "093", "H", numbers).select("tile_row", "maptile")


@query(f"{WITH_TILES} SELECT tile_row, year FROM tiles WHERE year >= 1996")
def tile_min_year(spark, d):
    return L.since(V.tiles(spark, d), 1996).select("tile_row", "year")


@query(f"{WITH_TILES} SELECT tile_row, maptile FROM tiles WHERE regexp_replace(maptile, '^[^_]*_', '') IN ('1_1_1', '2_3_4', '4_4_2')")
def tile_subdivision_filter(spark, d):
    return L.in_subdivisions(V.tiles(spark, d), ["1_1_1", "2_3_4", "4_4_2"]).select("tile_row", "maptile")


@query(f"""{WITH_TILES} SELECT tile_row, CASE WHEN s3Url IS NULL OR s3Url = '' THEN concat('{PREFIX}', replace(path, chr(92), '/')) ELSE s3Url END AS url FROM tiles""")
def tile_url_coalesce(spark, d):
    return L.with_url(V.tiles(spark, d), PREFIX).select("tile_row", "url")


_BOXES = "SELECT tile_row, CAST(tile_row * 37 % 1000 AS DOUBLE) AS xmin, CAST(tile_row * 91 % 1000 AS DOUBLE) AS ymin, CAST(tile_row * 37 % 1000 + 25 AS DOUBLE) AS xmax, CAST(tile_row * 91 % 1000 + 25 AS DOUBLE) AS ymax FROM tiles"


def _boxes(spark, d):
    t = V.tiles(spark, d)
    x, y = F.col("tile_row") * 37 % 1000, F.col("tile_row") * 91 % 1000
    return t.select("tile_row", *((v.cast("double")).alias(k) for k, v in (("xmin", x), ("ymin", y), ("xmax", x + 25), ("ymax", y + 25))))


@query(f"{WITH_TILES}, boxes AS ({_BOXES}) SELECT * FROM boxes WHERE xmin <= 420 AND xmax >= 300 AND ymin <= 650 AND ymax >= 500")
def tile_bbox_intersects(spark, d):
    return L.intersecting(_boxes(spark, d), 300.0, 500.0, 420.0, 650.0)


@query(f"""{WITH_TILES}, boxes AS ({_BOXES}), areas AS (SELECT 1 AS aoi_id, 100.0 AS x0, 100.0 AS y0, 180.0 AS x1, 160.0 AS y1 UNION ALL SELECT 2, 150.0, 140.0, 400.0, 300.0)
SELECT tile_row, CAST(aoi_id AS INT) AS aoi_id FROM boxes JOIN areas ON xmin <= x1 AND xmax >= x0 AND ymin <= y1 AND ymax >= y0""")
def tiles_by_area(spark, d):
    areas = spark.createDataFrame([(1, 100.0, 100.0, 180.0, 160.0), (2, 150.0, 140.0, 400.0, 300.0)], "aoi_id int, xmin double, ymin double, xmax double, ymax double")
    return L.intersecting_areas(_boxes(spark, d), areas).select("tile_row", "aoi_id")


@query(f"{WITH_TILES} SELECT min(year) AS first_year, max(year) AS last_year FROM tiles")
def tile_year_range(spark, d):
    return L.year_range(V.tiles(spark, d))


@query(f"{WITH_TILES} SELECT count(*) AS n_tiles, count(*) * CAST(50 AS DOUBLE) / 1024 AS gb, printf('%.1f', count(*) * CAST(50 AS DOUBLE) / 1024) AS gb_text FROM tiles")
def download_estimate(spark, d):
    return L.download_estimate(V.tiles(spark, d))


def _results(spark, d):
    t = V.tiles(spark, d)
    ok = F.col("tile_row") % 11 != 0
    return t.select(ok.alias("success"), F.col("filename").alias("file"), F.when(ok, F.lit(200)).otherwise(F.lit(404)).alias("status"), F.lit(None).cast("string").alias("error"))


_RESULTS = "SELECT tile_row % 11 <> 0 AS success, filename AS file, CAST(CASE WHEN tile_row % 11 <> 0 THEN 200 ELSE 404 END AS INT) AS status FROM tiles"


@query(f"{WITH_TILES}, r AS ({_RESULTS}) SELECT file, status, (SELECT greatest(count(*) - 5, 0) FROM r WHERE NOT success) AS n_more FROM r WHERE NOT success ORDER BY file LIMIT 5")
def failed_head5(spark, d):
    return L.first_failures(_results(spark, d)).select("file", "status", "n_more")


@query(f"{WITH_TILES}, r AS ({_RESULTS}) SELECT count(*) AS n, count(*) FILTER (WHERE success) AS n_ok, count(*) FILTER (WHERE NOT success) AS n_failed FROM r")
def download_outcome(spark, d):
    return L.outcome(_results(spark, d))


@query("""SELECT o_orderkey, concat('093h', lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')) AS tile,
  printf('{"xmin":%f,"ymin":%f,"xmax":%f,"ymax":%f,"spatialReference":{"wkid":3857}}', CAST(o_orderkey AS DOUBLE), CAST(o_custkey AS DOUBLE), CAST(o_orderkey + 1 AS DOUBLE), CAST(o_custkey + 1 AS DOUBLE)) AS envelope FROM orders""")
def index_request_text(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    a, b = F.col("o_orderkey").cast("double"), F.col("o_custkey").cast("double")
    return o.select("o_orderkey", F.concat(F.lit("093h"), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")).alias("tile"), S.envelope_json(a, b, a + 1, b + 1).alias("envelope"))


@query(f"{WITH_TILES}, r AS ({_RESULTS}) SELECT file, status FROM r WHERE NOT success")
def failed_downloads(spark, d):
    return _results(spark, d).filter(~F.col("success")).select("file", "status")


@query(f"{WITH_TILES} SELECT concat('/lidar/', CAST(tile_row % 2 AS VARCHAR), '/', filename) AS file FROM tiles ORDER BY 1 LIMIT 1")
def first_file(spark, d):
    return V.files(spark, d).select("file").orderBy("file").limit(1)


@query(f"{WITH_TILES} SELECT tile_row, maptile FROM tiles ORDER BY tile_row LIMIT 200 OFFSET 400")
def index_page_offset(spark, d):
    return V.tiles(spark, d).select("tile_row", "maptile").orderBy("tile_row").offset(400).limit(200)


@query(f"{WITH_TILES} SELECT maptile, year, tile_row FROM (SELECT *, row_number() OVER (ORDER BY maptile, year DESC, tile_row) AS k FROM tiles) t WHERE k <= 100")
def tile_sort_head(spark, d):
    return V.tiles(spark, d).orderBy(F.asc("maptile"), F.desc("year"), "tile_row").limit(100).select("maptile", "year", "tile_row")


@query(f"{WITH_TREES} SELECT tree_id, z, CAST(NULL AS DOUBLE) AS dtm_z, CAST(NULL AS DOUBLE) AS slope_deg FROM trees")
def trees_without_terrain(spark, d):
    return V.trees(spark, d).select("tree_id", "z", *(F.lit(None).cast("double").alias(c) for c in ("dtm_z", "slope_deg")))


# --- chunks ------------------------------------------------------------------------------------------------------


@query(f"""{WITH_POINTS}, k AS (SELECT unnest(range(-2, 7)) AS k)
SELECT a.k AS chunk_x, b.k AS chunk_y, count(*) AS n, count(*) FILTER (WHERE xi >= a.k * 10000 AND xi < a.k * 10000 + 10000 AND yi >= b.k * 10000 AND yi < b.k * 10000 + 10000) AS n_core
FROM points JOIN k a ON xi >= a.k * 10000 - 1000 AND xi <= a.k * 10000 + 11000 JOIN k b ON yi >= b.k * 10000 - 1000 AND yi <= b.k * 10000 + 11000 GROUP BY 1, 2""")
def chunk_halo_counts(spark, d):
    return with_halo(V.points(spark, d).select("xi", "yi")).groupBy("chunk_x", "chunk_y").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_core").alias("n_core"))


@query(f"{WITH_POINTS} SELECT CAST(floor(xi / 10000) AS BIGINT) AS chunk_x, CAST(floor(yi / 10000) AS BIGINT) AS chunk_y, count(*) AS n FROM points GROUP BY 1, 2")
def chunk_core_counts(spark, d):
    return V.points(spark, d).groupBy(chunk_of(F.col("xi"), 100.0).alias("chunk_x"), chunk_of(F.col("yi"), 100.0).alias("chunk_y")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{WITH_POINTS} SELECT point_id, xi, yi FROM points WHERE floor(xi / 10000) = 1 AND floor(yi / 10000) = 2")
def chunk_core_clip(spark, d):
    return P.core_of(V.points(spark, d), 1, 2).select("point_id", "xi", "yi")


@query(f"""{WITH_POINTS} SELECT DISTINCT concat(CAST(CAST(round_even(floor(x / 0.5) * 0.5, 0) AS BIGINT) AS VARCHAR), '_', CAST(CAST(round_even(floor(y / 0.5) * 0.5, 0) AS BIGINT) AS VARCHAR)) AS prefix FROM points""")
def chunk_prefix(spark, d):
    half = lambda c: F.floor(F.col(c) / S.lit(0.5)) * S.lit(0.5)
    return V.points(spark, d).select(S.chunk_prefix(half("x"), half("y")).alias("prefix")).distinct()


@query(f"""{WITH_POINTS}, w AS (SELECT DISTINCT CAST(floor(xi / 10000) AS BIGINT) AS wx, CAST(floor(yi / 10000) AS BIGINT) AS wy FROM points)
SELECT count(*) AS n_windows FROM w""")
def sample_windows(spark, d):
    p = V.points(spark, d)
    return p.select(chunk_of(F.col("xi"), 100.0).alias("wx"), chunk_of(F.col("yi"), 100.0).alias("wy")).distinct().agg(F.count(F.lit(1)).alias("n_windows"))


# --- rasters -----------------------------------------------------------------------------------------------------


def _cell(cm: int) -> str:
    return f"CAST(floor(xi / {cm}) AS BIGINT) AS col, CAST(floor(yi / {cm}) AS BIGINT) AS row"


DSM10 = f"SELECT {_cell(1000)}, max(z) AS value FROM points GROUP BY 1, 2"
DTM10 = f"SELECT {_cell(1000)}, min(z) AS value FROM points WHERE cls = 2 GROUP BY 1, 2"
CHM10 = f"SELECT {_cell(1000)}, max(h) AS value FROM points WHERE cls <> 2 AND h BETWEEN 0 AND 30 GROUP BY 1, 2"
PLANE20 = f"SELECT col, row, 100 + CAST(col * 2000 + 1000 AS DOUBLE) / 1000 + CAST(row * 2000 + 1000 AS DOUBLE) / 2000 + (col * row % 7) AS value FROM (SELECT DISTINCT {_cell(2000)} FROM points WHERE cls = 2) c"


def _dsm(p):
    return R.rasterized(p, G10)


def _dtm(p):
    return R.rasterized(P.ground(p), G10, how="min")


def _chm(p, grid=G10):
    return R.rasterized(P.height_band(P.not_ground(p)), grid, "h")


def _plane(p):
    cells = with_cells(P.ground(p), G20).select("col", "row").distinct()
    return cells.withColumn("value", 100 + (F.col("col") * 2000 + 1000) / S.lit(1000) + (F.col("row") * 2000 + 1000) / S.lit(2000) + F.col("col") * F.col("row") % 7)


@query(f"{WITH_POINTS} {DSM10}")
def dsm_max_cell(spark, d):
    return _dsm(V.points(spark, d))


@query(f"{WITH_POINTS} {DTM10}")
def dtm_min_cell(spark, d):
    return _dtm(V.points(spark, d))


@query(f"""{WITH_POINTS}, a AS ({DSM10}), b AS ({DTM10})
SELECT col, row, CASE WHEN a.value - b.value - 5 >= 0 THEN a.value - b.value - 5 END AS value FROM a JOIN b USING (col, row)""")
def chm_difference(spark, d):
    p = V.points(spark, d)
    return R.difference(R.difference(_dsm(p), _dtm(p)), _dtm(p).withColumn("value", S.lit(5)), drop_negative=True)


@query(f"{WITH_POINTS}, c AS ({CHM10}) SELECT max(value) AS max_value FROM c")
def chm_global_max(spark, d):
    return R.global_max(_chm(V.points(spark, d)))


@query(f"{WITH_POINTS}, c AS ({CHM10}) SELECT count(value) = 0 AS all_null FROM c WHERE value > 1000")
def raster_all_null(spark, d):
    return R.all_null(_chm(V.points(spark, d)).filter("value > 1000"))


@query(f"{WITH_POINTS}, c AS ({DSM10}) SELECT col, row, value FROM c WHERE (col * 1000 + 500) / 100.0 >= 55 AND (col * 1000 + 500) / 100.0 < 245 AND (row * 1000 + 500) / 100.0 >= 100 AND (row * 1000 + 500) / 100.0 < 305")
def raster_crop(spark, d):
    return R.cropped(_dsm(V.points(spark, d)), G10, 55.0, 100.0, 245.0, 305.0)


@query(f"""{WITH_POINTS}, c AS ({CHM10}) SELECT CAST(floor(col / 10) AS BIGINT) AS chunk_x, CAST(floor(row / 10) AS BIGINT) AS chunk_y, max(value) AS max_value, coalesce(max(value) >= 2, false) AS has_trees FROM c GROUP BY 1, 2""")
def tree_gate(spark, d):
    c = _chm(V.points(spark, d)).withColumns({"chunk_x": F.floor(F.col("col") / 10).cast("bigint"), "chunk_y": F.floor(F.col("row") / 10).cast("bigint")})
    return R.tree_gate(c)


HORN = f"""{WITH_POINTS}, c AS ({PLANE20}), o AS (SELECT a.dc, b.dr FROM (SELECT unnest(range(-1, 2)) AS dc) a, (SELECT unnest(range(-1, 2)) AS dr) b),
g AS (SELECT t.col, t.row, sum(n.value * dc * (2 - abs(dr))) / 160 AS zx, sum(n.value * dr * (2 - abs(dc))) / 160 AS zy
      FROM c t CROSS JOIN o JOIN c n ON n.col = t.col + o.dc AND n.row = t.row + o.dr GROUP BY 1, 2 HAVING count(*) = 9),
s AS (SELECT col, row, degrees(atan(sqrt(zx * zx + zy * zy))) AS slope, CASE WHEN zx = 0 AND zy = 0 THEN 90 ELSE ((degrees(atan2(-zx, -zy)) % 360) + 360) % 360 END AS aspect FROM g)"""


@query(f"{HORN} SELECT col, row, round(slope, 6) AS slope FROM s")
def slope_horn(spark, d):
    return rounded(R.terrain(_plane(V.points(spark, d)), G20).select("col", "row", "slope"), "slope")


@query(f"{HORN} SELECT col, row, round(aspect, 6) AS aspect FROM s")
def aspect_horn(spark, d):
    return rounded(R.terrain(_plane(V.points(spark, d)), G20).select("col", "row", "aspect"), "aspect")


@query(f"{HORN} SELECT col, row, round(cos(radians(slope)) * sin(radians(45)) + sin(radians(slope)) * cos(radians(45)) * cos(radians(315) - radians(aspect)), 6) AS hillshade FROM s")
def hillshade(spark, d):
    return rounded(R.terrain(_plane(V.points(spark, d)), G20).select("col", "row", "hillshade"), "hillshade")


@query(f"{WITH_TREES} SELECT tree_id, round(radians(slope_deg) * 180 / pi(), 6) AS slope_deg FROM trees")
def slope_unit_convert(spark, d):
    return V.trees(spark, d).select("tree_id", F.round(F.degrees(F.radians("slope_deg")), 6).alias("slope_deg"))


PRESENCE = f"""{WITH_POINTS}, t AS (SELECT DISTINCT {_cell(500)} FROM points WHERE h > 33),
box AS (SELECT min(col) AS c0, max(col) AS c1, min(row) AS r0, max(row) AS r1 FROM t),
cells AS (SELECT unnest(range(c0, c1 + 1)) AS col, row FROM (SELECT c0, c1, unnest(range(r0, r1 + 1)) AS row FROM box) b),
f AS (SELECT cells.col, cells.row, CASE WHEN t.col IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS value FROM cells LEFT JOIN t ON t.col = cells.col AND t.row = cells.row)"""


def _focal(radius: float, pick: str) -> str:
    offsets = ", ".join(f"({dc}, {dr})" for dc, dr in circle_offsets(radius, 5.0))
    return f"{PRESENCE}, o(dc, dr) AS (VALUES {offsets}) SELECT t.col, t.row, {pick} AS value FROM f t CROSS JOIN o LEFT JOIN f n ON n.col = t.col + o.dc AND n.row = t.row + o.dr GROUP BY 1, 2"


@query(f"{PRESENCE} SELECT col, row, value FROM f")
def presence_raster(spark, d):
    return R.presence(V.points(spark, d).filter("h > 33"), G5)


@query(_focal(20.0, "sum(coalesce(n.value, 0))"))
def focal_circle_sum(spark, d):
    return R.focal_circle(R.presence(V.points(spark, d).filter("h > 33"), G5), G5, 20.0)


@query(_focal(50.0, f"round(sum(coalesce(n.value, 0)) / {len(circle_offsets(50.0, 5.0))}, 9)"))
def density_reference(spark, d):
    return rounded(R.tree_density(V.points(spark, d).filter("h > 33"), G5, 50.0), "value", digits=9)


@query(_focal(50.0, f"round(sum(coalesce(n.value, 0)) * 10000 / {len(circle_offsets(50.0, 5.0)) * 25}, 6)"))
def density_per_hectare(spark, d):
    return rounded(R.tree_density(V.points(spark, d).filter("h > 33"), G5, 50.0, "per_hectare"), "value")


@query("SELECT CAST(a AS INT) AS dc, CAST(b AS INT) AS dr FROM range(-4, 5) x(a), range(-4, 5) y(b) WHERE a * a + b * b <= 16")
def focal_kernel(spark, d):
    return spark.createDataFrame(circle_offsets(20.0, 5.0), "dc int, dr int")


@query(f"""{WITH_POINTS}, a AS ({DSM10}) SELECT CAST(min((col * 1000 + 500) / 100.0) AS DOUBLE) AS xmin, CAST(max((col * 1000 + 500) / 100.0) AS DOUBLE) AS xmax, CAST(min((row * 1000 + 500) / 100.0) AS DOUBLE) AS ymin, CAST(max((row * 1000 + 500) / 100.0) AS DOUBLE) AS ymax FROM a""")
def raster_extent(spark, d):
    return R.extent(_dsm(V.points(spark, d)).select(G10.centre(F.col("col")).alias("x"), G10.centre(F.col("row")).alias("y")))


@query(f"{WITH_POINTS}, c AS ({CHM10}) SELECT min(col) AS c0, count(*) AS n_cells FROM (SELECT unnest(range(c0, c1 + 1)) AS col, row FROM (SELECT c0, c1, unnest(range(r0, r1 + 1)) AS row FROM (SELECT min(col) AS c0, max(col) AS c1, min(row) AS r0, max(row) AS r1 FROM c) b) r) x")
def grid_template(spark, d):
    return dense_cells(_chm(V.points(spark, d))).agg(F.min("col").alias("c0"), F.count(F.lit(1)).alias("n_cells"))


# --- lookups, mosaics --------------------------------------------------------------------------------------------


@query(f"""{WITH_POINTS}, a AS ({DTM10}), s AS (SELECT *, {_cell(1000)} FROM points WHERE cls <> 2 AND h > 30)
SELECT point_id, x, y, a.value AS dtm_z FROM s LEFT JOIN a ON a.col = s.col AND a.row = s.row""")
def extract_at_points(spark, d):
    p = V.points(spark, d)
    return R.sampled(P.not_ground(p).filter("h > 30"), _dtm(p), G10, "dtm_z").select("point_id", "x", "y", "dtm_z")


@query(f"""{WITH_POINTS}, s AS (SELECT *, {_cell(500)} FROM points WHERE cls <> 2)
SELECT point_id, CAST(CASE WHEN (col + row) % 3 = 0 THEN NULL ELSE col * 100000 + row END AS DOUBLE) AS tree_id FROM s""")
def segment_label_points(spark, d):
    p = P.not_ground(V.points(spark, d))
    crowns = with_cells(p, G5).select("col", "row").distinct().filter((F.col("col") + F.col("row")) % 3 != 0).withColumn("tree_id", F.col("col") * 100000 + F.col("row"))
    return T.labelled(p, crowns, G5).select("point_id", F.col("tree_id").cast("double"))


@query(f"""{WITH_POINTS}, t AS (SELECT 'dsm' AS product, 'a' AS tile, col, row, value FROM ({DSM10}) x WHERE col < 25 UNION ALL SELECT 'dsm', 'b', col, row, value + 1 FROM ({DSM10}) y WHERE col >= 20 UNION ALL SELECT 'chm', 'a', col, row, value FROM ({CHM10}) z)
SELECT product, col, row, value FROM t QUALIFY row_number() OVER (PARTITION BY product, col, row ORDER BY tile DESC) = 1""")
def raster_mosaic_latest_wins(spark, d):
    p = V.points(spark, d)
    dsm, tile = _dsm(p), lambda df, t: df.withColumn("tile", F.lit(t))
    both = tile(dsm.filter("col < 25"), "a").unionByName(tile(dsm.filter("col >= 20").withColumn("value", F.col("value") + 1), "b"))
    return R.mosaics({"dsm": both, "chm": tile(_chm(p), "a"), "dtm": None}).select("product", "col", "row", "value")


# --- trees -------------------------------------------------------------------------------------------------------


@query(f"{WITH_POINTS} SELECT DISTINCT h, round(CASE WHEN h < 2 THEN 3 WHEN h > 30 THEN 5 ELSE 2.6 * (1 - exp(-0.08 * (h - 2))) + 3 END, 6) AS window_size FROM points")
def window_curve(spark, d):
    return V.points(spark, d).select("h", F.round(S.window_size(F.col("h")), 6).alias("window_size")).distinct()


@query(f"""{WITH_POINTS}, c AS (SELECT {_cell(100)}, max(h) AS value FROM points WHERE cls <> 2 AND h BETWEEN 0 AND 30 GROUP BY 1, 2),
w AS (SELECT *, (2.6 * (1 - exp(-0.08 * (value - 2))) + 3) / 2 AS reach FROM c WHERE value >= 2)
SELECT col, row, value FROM w WHERE NOT EXISTS (SELECT 1 FROM c n WHERE n.col BETWEEN w.col - 2 AND w.col + 2 AND n.row BETWEEN w.row - 2 AND w.row + 2
  AND (n.col - w.col) * (n.col - w.col) + (n.row - w.row) * (n.row - w.row) <= w.reach * w.reach
  AND (n.value > w.value OR (n.value = w.value AND (n.row < w.row OR (n.row = w.row AND n.col < w.col)))))""")
def treetops_lmf(spark, d):
    return T.treetops(_chm(V.points(spark, d), GridSpec(1.0)), GridSpec(1.0))


LABELLED = f"SELECT *, CAST(floor(xi / 500) AS BIGINT) * 100000 + CAST(floor(yi / 500) AS BIGINT) AS tree_id FROM points WHERE cls <> 2 AND h BETWEEN 0 AND 30"


def _labelled(spark, d):
    p = P.height_band(P.not_ground(V.points(spark, d)))
    return with_cells(p, G5).withColumn("tree_id", F.col("col") * 100000 + F.col("row")).drop("col", "row")


@query(f"""{WITH_POINTS}, t AS ({LABELLED})
SELECT tree_id, h AS z, n AS npoints, x, y FROM (SELECT *, count(*) OVER (PARTITION BY tree_id) AS n, row_number() OVER (PARTITION BY tree_id ORDER BY h DESC, x DESC, y DESC) AS k FROM t) r WHERE k = 1""")
def tree_metrics(spark, d):
    return T.tree_metrics(_labelled(spark, d))


@query(f"{WITH_POINTS}, t AS ({LABELLED}) SELECT tree_id, count(*) AS npoints FROM t GROUP BY 1 HAVING count(*) >= 5")
def tree_min_points(spark, d):
    return T.with_enough_points(T.tree_metrics(_labelled(spark, d))).select("tree_id", "npoints")


@query(f"""{WITH_POINTS}, t AS ({LABELLED}), r AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY h DESC, x DESC, y DESC) AS k FROM t)
SELECT DISTINCT CAST(xi AS BIGINT) * 4294967296 + CAST(yi AS BIGINT) AS merged_id FROM r WHERE k = 1""")
def tree_bitmerge_id(spark, d):
    m = T.tree_metrics(_labelled(spark, d))
    return m.select(S.bitmerge_id(F.round(F.col("x") * 100), F.round(F.col("y") * 100)).alias("merged_id")).distinct()


@query(f"{WITH_TREES} SELECT tree_id, round(cos(((aspect_deg % 360 + 360) % 360) * pi() / 180), 6) AS northness FROM trees")
def northness(spark, d):
    return V.trees(spark, d).select("tree_id", F.round(S.northness(F.col("aspect_deg")), 6).alias("northness"))


def _northed(spark, d):
    return V.trees(spark, d).withColumn("northness", F.round(S.northness(F.col("aspect_deg")), 6))


def _bin_sql(x: str, y: str, bins: int) -> str:
    at = lambda c: f"CAST(CASE WHEN {c}1 = {c}0 THEN 0 ELSE least(floor(({c} - {c}0) / (({c}1 - {c}0) / {bins})), {bins - 1}) END AS BIGINT)"
    return f"""{WITH_TREES}, n AS (SELECT *, round(cos(((aspect_deg % 360 + 360) % 360) * pi() / 180), 6) AS northness FROM trees),
v AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM n WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM v)
SELECT {at('x')} AS bx, {at('y')} AS by, count(*) AS count, round(log10(count(*)), 6) AS log_count FROM v, b GROUP BY 1, 2"""


for _name, _x, _y in T.HEATMAPS:
    query(_bin_sql(_x, _y, 400), f"bin2d_{_name}")(lambda spark, d, x=_x, y=_y: rounded(T.bin2d(_northed(spark, d), x, y, 400), "log_count"))


@query(" UNION ALL ".join(f"SELECT '{name}' AS map, * FROM ({_bin_sql(x, y, 100)}) {name}" for name, x, y in T.HEATMAPS))
def heatmaps_at_once(spark, d):
    return rounded(T.stacked_bins(_northed(spark, d), T.HEATMAPS, 100), "log_count")


@query(f"{WITH_TREES} SELECT CAST(floor(z / 2) AS BIGINT) AS bx, CAST(floor(npoints / 3) AS BIGINT) AS by, count(*) AS count, round(log10(count(*)), 6) AS log_count FROM trees GROUP BY 1, 2")
def bin2d_binwidth(spark, d):
    return rounded(T.bin2d(V.trees(spark, d), "z", "npoints", binwidth=(2.0, 3.0)), "log_count")


_SUMMARY = " UNION ALL ".join(
    f"SELECT '{c}' AS name, CAST(min({c}) AS DOUBLE) AS least, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, round(avg({c}), 6) AS mean, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, CAST(max({c}) AS DOUBLE) AS greatest, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM trees"
    for c in ("z", "npoints", "convhull_area", "dtm_z", "slope_deg", "aspect_deg")
)


@query(f"{WITH_TREES} SELECT name, least, round(q1, 6) AS q1, round(median, 6) AS median, mean, round(q3, 6) AS q3, greatest, n_null FROM ({_SUMMARY}) s")
def tree_summary(spark, d):
    return rounded(T.summary(V.trees(spark, d), ["z", "npoints", "convhull_area", "dtm_z", "slope_deg", "aspect_deg"]), "q1", "median", "mean", "q3")


# --- sets --------------------------------------------------------------------------------------------------------


@query(f"{WITH_TREES} SELECT tree_id, z, CAST(npoints AS DOUBLE) AS npoints, CAST(NULL AS DOUBLE) AS dtm_z FROM trees WHERE tree_id % 2 = 0 UNION ALL SELECT tree_id, z, NULL, dtm_z FROM trees WHERE tree_id % 2 = 1")
def trees_merge_by_name(spark, d):
    t = V.trees(spark, d)
    return T.merged_by_name([t.filter("tree_id % 2 = 0").select("tree_id", "z", F.col("npoints").cast("double")), t.filter("tree_id % 2 = 1").select("dtm_z", "tree_id", "z")])


@query(f"{WITH_TILES} SELECT tile_row, maptile FROM tiles")
def pages_union(spark, d):
    t = V.tiles(spark, d).select("tile_row", "maptile")
    n = 3
    return reduce(DataFrame.unionByName, [t.filter(F.col("tile_row") % n == k) for k in range(n)])


@query(f"{WITH_TILES} SELECT filename FROM tiles WHERE tile_row % 2 = 0 EXCEPT SELECT filename FROM tiles WHERE tile_row % 3 = 0")
def names_diff(spark, d):
    t = V.tiles(spark, d)
    return t.filter("tile_row % 2 = 0").select("filename").subtract(t.filter("tile_row % 3 = 0").select("filename"))


@query(f"{WITH_TILES} SELECT maptile FROM tiles WHERE tile_row % 2 = 0 UNION SELECT maptile FROM tiles WHERE tile_row % 3 = 0")
def names_union(spark, d):
    t = V.tiles(spark, d)
    return t.filter("tile_row % 2 = 0").select("maptile").union(t.filter("tile_row % 3 = 0").select("maptile")).distinct()


# --- projections -------------------------------------------------------------------------------------------------

LON, LAT = "-139 + (o_orderkey % 2500) / 100.0", "48.3 + (o_custkey % 1170) / 100.0"


def _places(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select("o_orderkey", (F.lit(-139) + (F.col("o_orderkey") % 2500) / S.lit(100)).alias("lon"), (S.lit(48.3) + (F.col("o_custkey") % 1170) / S.lit(100)).alias("lat"))


@query(f"""SELECT o_orderkey, round(6378137 * radians(CAST({LON} AS DOUBLE)), 4) AS x, round(6378137 * ln(tan(pi() / 4 + radians(CAST({LAT} AS DOUBLE)) / 2)), 4) AS y FROM orders""")
def web_mercator(spark, d):
    x, y = S.web_mercator(F.col("lon"), F.col("lat"))
    return _places(spark, d).select("o_orderkey", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


ALBERS = f"""WITH p AS (SELECT o_orderkey, radians(CAST({LON} AS DOUBLE)) AS l, radians(CAST({LAT} AS DOUBLE)) AS f FROM orders),
k AS (SELECT sqrt(f * (2 - f)) AS e, radians(CAST(45 AS DOUBLE)) AS f0, radians(CAST(50 AS DOUBLE)) AS f1, radians(CAST(58.5 AS DOUBLE)) AS f2 FROM (SELECT 1 / CAST(298.257222101 AS DOUBLE) AS f) g),
q AS (SELECT *, cos(f1) / sqrt(1 - e * e * sin(f1) * sin(f1)) AS m1, cos(f2) / sqrt(1 - e * e * sin(f2) * sin(f2)) AS m2,
  (1 - e * e) * (sin(f0) / (1 - e * e * sin(f0) * sin(f0)) - ln((1 - e * sin(f0)) / (1 + e * sin(f0))) / (2 * e)) AS q0,
  (1 - e * e) * (sin(f1) / (1 - e * e * sin(f1) * sin(f1)) - ln((1 - e * sin(f1)) / (1 + e * sin(f1))) / (2 * e)) AS q1,
  (1 - e * e) * (sin(f2) / (1 - e * e * sin(f2) * sin(f2)) - ln((1 - e * sin(f2)) / (1 + e * sin(f2))) / (2 * e)) AS q2 FROM k),
n AS (SELECT *, (m1 * m1 - m2 * m2) / (q2 - q1) AS n FROM q), c AS (SELECT *, m1 * m1 + n * q1 AS c FROM n), r AS (SELECT *, 6378137 * sqrt(c - n * q0) / n AS rho0 FROM c),
t AS (SELECT p.o_orderkey, p.l, p.f, r.*, (1 - e * e) * (sin(p.f) / (1 - e * e * sin(p.f) * sin(p.f)) - ln((1 - e * sin(p.f)) / (1 + e * sin(p.f))) / (2 * e)) AS qf FROM p, r)
SELECT o_orderkey, round(1000000 + 6378137 * sqrt(c - n * qf) / n * sin(n * (l - radians(CAST(-126 AS DOUBLE)))), 4) AS x, round(rho0 - 6378137 * sqrt(c - n * qf) / n * cos(n * (l - radians(CAST(-126 AS DOUBLE)))), 4) AS y FROM t"""


@query(ALBERS)
def albers_bc(spark, d):
    x, y = S.albers(F.col("lon"), F.col("lat"))
    return _places(spark, d).select("o_orderkey", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query(f"SELECT o_orderkey, round(CAST({LON} AS DOUBLE), 6) AS lon, round(CAST({LAT} AS DOUBLE), 6) AS lat FROM orders")
def albers_round_trip(spark, d):
    x, y = S.albers(F.col("lon"), F.col("lat"))
    lon, lat = S.albers_inverse(F.col("x"), F.col("y"))
    return _places(spark, d).select("o_orderkey", x.alias("x"), y.alias("y")).select("o_orderkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query(f"{WITH_POINTS} SELECT (min(x) + max(x)) / 2 AS center_x, (min(y) + max(y)) / 2 AS center_y FROM points")
def scene_center(spark, d):
    return R.centre(V.points(spark, d))


@query("SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_features_explode(spark, d):
    """Events packed as pages of features, as an index service answers, and taken apart again."""
    from ..sources.index import features_of

    e = spark.read.parquet(f"{d}/events.parquet")
    feature = F.struct(F.struct("event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")).alias("attributes"))
    pages = e.groupBy((F.col("event_id") % 97).alias("page")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"), F.lit(False).alias("exceededTransferLimit"))).alias("body"))
    return features_of(pages, "event_id bigint, user_id bigint, k bigint")


# --- flagship and whole pipelines --------------------------------------------------------------------------------


@query(f"""{WITH_POINTS}, one AS (SELECT DISTINCT xi, yi, z, cls FROM points), a AS (SELECT {_cell(1000)}, max(z) AS value FROM one GROUP BY 1, 2),
b AS (SELECT {_cell(1000)}, min(z) AS value FROM one WHERE cls = 2 GROUP BY 1, 2),
v AS (SELECT b.value AS x, a.value - b.value AS y FROM a JOIN b USING (col, row) WHERE a.value - b.value >= 0), box AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM v)
SELECT CAST(least(floor((x - x0) / ((x1 - x0) / 40)), 39) AS BIGINT) AS bx, CAST(least(floor((y - y0) / ((y1 - y0) / 40)), 39) AS BIGINT) AS by, count(*) AS count, round(log10(count(*)), 6) AS log_count FROM v, box GROUP BY 1, 2""")
def chm_ground_heatmap(spark, d):
    cells = R.surfaces(P.deduplicated(V.points(spark, d)), G10)
    chm = cells.select("ground", (F.col("dsm") - F.col("ground")).alias("chm")).filter("chm >= 0")
    return rounded(T.bin2d(chm, "ground", "chm", 40), "log_count")


#: A lattice that suits the stand-in cloud, whose points are some 1.6 m apart at the largest scale.
COARSE = PipelineConfig(resolution=5.0, subcircle=0.2, min_points=2)


@query(f"{WITH_POINTS} SELECT point_id, round(g, 6) AS ground FROM points WHERE cls = 2")
def ground_at_ground_points(spark, d):
    """A triangulated surface passes through its vertices: each ground point is at its own height."""
    p = P.deduplicated(V.points(spark, d), order=("cls", "point_id"))
    out = chunks.interpolated_ground(p, PipelineConfig()).filter("cls = 2").select(F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), F.round("ground", 6).alias("ground")).distinct()
    g = P.ground(V.points(spark, d)).select("point_id", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))
    return g.join(out, ["x", "y"]).select("point_id", "ground")


#: How far from the cloud's edge a place surely has ground points all around, within its chunk and halo. There the surface of the
#: stand-in's ground is its plane; nearer the edge it is a mean of the nearest points, which stays between the least and the greatest.
EDGE = 40
#: A halo as wide as that of a cloud with few ground points has to be, so that a core's corners have some around them.
HALO = 25.0


def _inner(x: str, y: str) -> str:
    return f"{x} BETWEEN {EDGE} AND {400 - EDGE} AND {y} BETWEEN {EDGE} AND {400 - EDGE}"


def _bounded(value, of: DataFrame, column: str):
    """Whether a value lies between the least and the greatest of a column, to a millimetre."""
    box = of.agg(F.min(column).alias("least_"), F.max(column).alias("most_"))
    return box, F.col(value).between(F.col("least_") - 0.001, F.col("most_") + 0.001)


@query(f"""{WITH_POINTS} SELECT point_id, CASE WHEN {_inner("x", "y")} THEN round(g, 6) END AS ground, CASE WHEN {_inner("x", "y")} THEN round(z - g, 6) END AS height, TRUE AS bounded FROM points""")
def normalize_height(spark, d):
    p = V.points(spark, d)
    box, bounded = _bounded("ground", P.ground(p), "g")
    out = chunks.interpolated_ground(p, PipelineConfig(chunk_buffer=HALO)).crossJoin(F.broadcast(box))  # one row
    inner = F.expr(_inner("x", "y"))
    return out.select("point_id", F.when(inner, F.round("ground", 6)).alias("ground"), F.when(inner, F.round("height", 6)).alias("height"), bounded.alias("bounded"))


def _products(spark, d, cfg=COARSE, *only):
    return pipeline.catalog_pipeline(V.points(spark, d), cfg, only=only or None)


#: All cells of the coarse lattice: the cloud covers 400 m by 400 m.
CELLS = "cells AS (SELECT a.k AS col, b.k AS row, CAST(a.k * 5 AS DOUBLE) + 2.5 AS x, CAST(b.k * 5 AS DOUBLE) + 2.5 AS y FROM (SELECT unnest(range(80)) AS k) a, (SELECT unnest(range(80)) AS k) b)"


@query(f"""WITH {CELLS} SELECT col, row, CASE WHEN {_inner("x", "y")} THEN round(100 + x / 10 + y / 20, 6) END AS value, TRUE AS bounded FROM cells""")
def dtm_tin(spark, d):
    """The terrain at every cell: inside the cloud it is the plane that the ground points were made on."""
    box, bounded = _bounded("value", P.ground(V.points(spark, d)), "g")
    out = pipeline.rasters(_products(spark, d, replace(COARSE, chunk_buffer=HALO), "dtm"), "dtm").crossJoin(F.broadcast(box))
    x, y = F.col("col") * 5 + 2.5, F.col("row") * 5 + 2.5
    inner = x.between(EDGE, 400 - EDGE) & y.between(EDGE, 400 - EDGE)
    return out.select("col", "row", F.when(inner, F.round("value", 6)).alias("value"), bounded.alias("bounded"))


@query(f"""{WITH_POINTS}, {CELLS}, s AS (SELECT {_cell(500)}, max(z) AS value FROM points GROUP BY 1, 2)
SELECT cells.col, cells.row, round(s.value, 6) AS value, TRUE AS bounded FROM cells LEFT JOIN s ON s.col = cells.col AND s.row = cells.row""")
def dsm_fill(spark, d):
    """The surface at every cell: that of its highest return, and where it has none, a value between the others'."""
    p = V.points(spark, d)
    box, bounded = _bounded("value", p, "z")
    seen = with_cells(p, G5).groupBy("col", "row").agg(F.lit(True).alias("seen"))
    out = pipeline.rasters(_products(spark, d, COARSE, "dsm"), "dsm").crossJoin(F.broadcast(box)).join(seen, ["col", "row"], "left")
    return out.select("col", "row", F.when(F.col("seen"), F.round("value", 6)).alias("value"), bounded.alias("bounded"))


@query()
def chm_pitfree(spark, d):
    return rounded(pipeline.rasters(_products(spark, d, COARSE, "chm"), "chm"), "value")


#: The lattice of production. On cells of 5 m a treetop's window and a crown hold one cell, so every cell would be a tree of its own.
FINE = replace(COARSE, resolution=PipelineConfig.resolution)


@query()
def catalog_pipeline(spark, d):
    return pipeline.inventory(_products(spark, d, FINE), FINE)


@query(f"""{WITH_POINTS}, c AS (SELECT CAST(floor(xi / 10000) AS BIGINT) AS chunk_x, CAST(floor(yi / 10000) AS BIGINT) AS chunk_y,
  count(*) FILTER (WHERE cls = 2) AS n_ground, max(h) FILTER (WHERE cls <> 2 AND h BETWEEN 0 AND 30) AS highest FROM points GROUP BY 1, 2)
SELECT chunk_x, chunk_y, CASE WHEN n_ground = 0 THEN 'normalize' WHEN coalesce(highest, 0) < 2 THEN 'gate' ELSE 'done' END AS stage,
  CASE WHEN n_ground = 0 THEN 'no ground points' WHEN coalesce(highest, 0) < 2 THEN 'canopy below hmin' ELSE '' END AS reason FROM c""")
def chunk_statuses(spark, d):
    return pipeline.statuses(_products(spark, d, COARSE, "status"))


@query()
def sample_pipeline(spark, d):
    return pipeline.sample_pipeline(V.points(spark, d), COARSE)[1]


@query()
def crowns_dalponte(spark, d):
    g = GridSpec(2.0)
    return chunks.rasterized_crowns(_chm(V.points(spark, d), g), g, PipelineConfig(), 100.0)


@query(f"""{WITH_POINTS}, t AS (SELECT DISTINCT tree_id, xi - floor(tree_id / 100000) * 500 AS x, yi - tree_id % 100000 * 500 AS y FROM ({LABELLED}) l),
e AS (SELECT p.tree_id, p.x AS px, p.y AS py, q.x AS qx, q.y AS qy FROM t p JOIN t q ON p.tree_id = q.tree_id AND (p.x <> q.x OR p.y <> q.y)),
outside AS (SELECT DISTINCT e.tree_id, px, py, qx, qy FROM e JOIN t r ON r.tree_id = e.tree_id
  WHERE (qx - px) * (r.y - py) - (qy - py) * (r.x - px) < 0
     OR ((qx - px) * (r.y - py) - (qy - py) * (r.x - px) = 0 AND (r.x - px) * (r.x - qx) + (r.y - py) * (r.y - qy) > 0)),
hull AS (SELECT * FROM e EXCEPT SELECT * FROM outside)
SELECT tree_id, CAST(coalesce((SELECT sum(px * qy - qx * py) FROM hull h WHERE h.tree_id = i.tree_id), 0) AS BIGINT) AS twice_area_cm2 FROM (SELECT DISTINCT tree_id FROM t) i""")
def crown_hull_area(spark, d):
    """Hulls of points on a lattice of centimetres: twice their area in square centimetres is a whole number."""
    import pandas as pd

    from ..functions.tin import hull_area

    def hull(held: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tree_id": held["tree_id"].iloc[:1], "twice_area_cm2": [round(hull_area(held["x"], held["y"]) * 20_000)]})

    return _labelled(spark, d).select("tree_id", "x", "y").groupBy("tree_id").applyInPandas(hull, "tree_id bigint, twice_area_cm2 bigint")


SUN = """WITH t AS (SELECT day, minute, 2 * pi() / 365 * (day - 1 + (CAST(minute AS DOUBLE) / 60 - 12) / 24) AS g FROM (SELECT unnest(range(1, 366)) AS day) a, (SELECT CAST(unnest(range(0, 1440, 60)) AS INT) AS minute) b),
e AS (SELECT *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS equation,
  0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS decl, radians(CAST(54 AS DOUBLE)) AS f FROM t),
h AS (SELECT *, radians((minute + equation + 4 * -122 - 60 * -8) / 4 - 180) AS hour FROM e)
, sun AS (SELECT day, minute, degrees(asin(sin(f) * sin(decl) + cos(f) * cos(decl) * cos(hour))) AS altitude,
  (degrees(atan2(sin(hour), cos(hour) * sin(f) - tan(decl) * cos(f))) + 180 + 360) % 360 AS azimuth FROM h)"""


@query(f"{SUN} SELECT day, minute, round(altitude, 6) AS altitude, round(azimuth, 6) AS azimuth FROM sun")
def sun_positions(spark, d):
    return rounded(sun_table(spark, 54.0, -122.0, step=60), "altitude", "azimuth")


#: The cells that a ray of each of 36 directions meets within 100 m, and how far away they are, on a lattice of 10 m.
RAYS = ", ".join(f"({k}, {dc}, {dr}, sqrt({100 * (dc * dc + dr * dr)}))" for k in range(36) for dc, dr in ray(k * 10.0, 10))


@query(f"""{SUN}, points AS ({V.POINTS}), d AS ({DSM10}), rays(k, dc, dr, dist) AS (VALUES {RAYS}),
up AS (SELECT altitude, CAST(round(azimuth / 10) AS INT) % 36 AS k FROM sun WHERE altitude > 0),
horizon AS (SELECT c.col, c.row, k, max(degrees(atan((o.value - c.value) / dist))) AS angle FROM d c CROSS JOIN rays JOIN d o ON o.col = c.col + dc AND o.row = c.row + dr GROUP BY 1, 2, 3)
SELECT c.col, c.row, round(CAST(count(*) FILTER (WHERE altitude > greatest(coalesce(angle, 0), 0)) AS DOUBLE) / count(*), 6) AS value
FROM d c CROSS JOIN up LEFT JOIN horizon h ON h.col = c.col AND h.row = c.row AND h.k = up.k GROUP BY 1, 2""")
def time_in_daylight_share(spark, d):
    return rounded(time_in_daylight(_dsm(V.points(spark, d)), G10, sun_table(spark, 54.0, -122.0, step=60)), "value")


from . import file_queries  # noqa: E402,F401  adds its queries
