"""Queries through files and services: each writes the stand-in tables in a format, reads them back and gives their rows.

Files go to the shared folder, a new folder for each call; they stay, since the DataFrame that is returned still reads them.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import functions as F

from ..config import DownloadConfig
from ..functions.grid import chunk_of
from ..sources import gtiff, las, vector
from ..sources.download import fetched, to_folder
from ..sources.index import read_index
from ..sources.store import located, shared_dir, write_files
from . import pipeline, views as V
from .catalogue import _BOXES, COARSE, DSM10, DTM10, G10, PREFIX, WITH_POINTS, WITH_TILES, WITH_TREES, _boxes, _dsm, _dtm, query, rounded

CHUNKS = "CAST(floor(xi / 10000) AS BIGINT) AS chunk_x, CAST(floor(yi / 10000) AS BIGINT) AS chunk_y"


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- clouds ------------------------------------------------------------------------------------------------------


def _clouds(spark, d) -> str:
    """A folder of clouds, one file for each chunk of 100 m."""
    p = V.points(spark, d).withColumns({"chunk_x": chunk_of(F.col("xi"), 100.0), "chunk_y": chunk_of(F.col("yi"), 100.0)})
    folder = _folder(spark, "clouds")
    write_files(las.encoded_clouds(p.select("chunk_x", "chunk_y", "x", "y", "z", "cls"), "chunk_x", "chunk_y", scale=0.0001), folder)
    return folder


_CLOUD = "concat('cloud_', CAST(chunk_x AS VARCHAR), '_', CAST(chunk_y AS VARCHAR), '.las')"


def _name(column: str):
    return F.element_at(F.split(column, "/"), -1).alias("name")


@query(f"{WITH_POINTS}, c AS (SELECT *, {CHUNKS} FROM points) SELECT {_CLOUD} AS name, xi, yi, round(z, 4) AS z, CAST(cls AS INT) AS cls, CAST(1 AS INT) AS return_number FROM c")
def las_points(spark, d):
    """All points, read by ranges of 1,000 records, so that files have several."""
    return las.read_points(spark, _clouds(spark, d), a_task=1_000).select(_name("file"), "xi", "yi", F.round("z", 4).alias("z"), "cls", "return_number")


@query(f"{WITH_POINTS}, c AS (SELECT {CHUNKS} FROM points) SELECT {_CLOUD} AS name, count(*) AS n_points, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_gaps FROM c GROUP BY 1")
def las_point_ids(spark, d):
    """The ids of a file's points are unique and without gaps."""
    p = las.read_points(spark, _clouds(spark, d), a_task=1_000)
    return p.groupBy(_name("file")).agg(F.count(F.lit(1)).alias("n_points"), F.count_distinct("point_id").alias("n_ids"), (F.max("point_id") - F.min("point_id") + 1 - F.count(F.lit(1))).alias("n_gaps"))


@query(f"""{WITH_POINTS}, c AS (SELECT *, {CHUNKS} FROM points) SELECT {_CLOUD} AS name, CAST(1 AS INT) AS point_format, FALSE AS compressed, count(*) AS n_points,
  round(min(x), 4) AS xmin, round(min(y), 4) AS ymin, round(min(z), 4) AS zmin, round(max(x), 4) AS xmax, round(max(y), 4) AS ymax, round(max(z), 4) AS zmax FROM c GROUP BY 1""")
def las_catalog(spark, d):
    found = las.read_catalog(spark, _clouds(spark, d))
    return rounded(found.select(_name("path"), "point_format", "compressed", "n_points", "xmin", "ymin", "zmin", "xmax", "ymax", "zmax"), "xmin", "ymin", "zmin", "xmax", "ymax", "zmax", digits=4)


@query(f"{WITH_POINTS}, c AS (SELECT DISTINCT {CHUNKS} FROM points) SELECT {_CLOUD} AS name, CAST(2 AS INT) AS n_asked, CAST(1 AS INT) AS n_found FROM c")
def folders_listed(spark, d):
    """The clouds of two folders of which one isn't there."""
    asked = (_clouds(spark, d), _folder(spark, "missing"))
    found = las.existing_folders(spark, *asked)
    return las.list_clouds(spark, *asked).select("name", F.lit(len(asked)).alias("n_asked"), F.lit(len(found)).alias("n_found"))


# --- vector layers -----------------------------------------------------------------------------------------------


def _square(x: float, y: float, side: float) -> list[tuple[float, float]]:
    return [(x, y), (x, y + side), (x + side, y + side), (x + side, y), (x, y)]


def _areas(spark, d):
    """An area for each nation: a square with a hole in it."""
    nations = [r[0] for r in spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey").orderBy("n_nationkey").collect()]  # 25 rows
    shapes = [[_square(100.0 * k, 50.0 * k, 40.0 + k), _square(100.0 * k + 10, 50.0 * k + 10, 5.0)[::-1]] for k in nations]
    folder = _folder(spark, "areas")
    write_files(spark.createDataFrame([("areas.shp", bytearray(vector.encode_polygons(shapes)))], "name string, content binary"), folder)
    return vector.read_areas(spark, f"{folder}/areas.shp")


_RING = "CAST(5 AS INT) AS n_corners, CAST(x AS DOUBLE) AS xmin, CAST(y AS DOUBLE) AS ymin, CAST(x + side AS DOUBLE) AS xmax, CAST(y + side AS DOUBLE) AS ymax"
_RINGS = f"""WITH n AS (SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INT) AS aoi_id, CAST(n_nationkey AS INT) AS k FROM nation),
s AS (SELECT aoi_id, CAST(0 AS INT) AS part, FALSE AS hole, 100 * k AS x, 50 * k AS y, 40 + k AS side FROM n UNION ALL SELECT aoi_id, CAST(1 AS INT), TRUE, 100 * k + 10, 50 * k + 10, 5 FROM n),
rings AS (SELECT aoi_id, part, hole, {_RING} FROM s)"""


@query(f"{_RINGS} SELECT * FROM rings")
def areas_read(spark, d):
    of = lambda f, c: f(F.transform("ring", lambda p: p[c]))
    return _areas(spark, d).select("aoi_id", "part", "hole", F.size("ring").alias("n_corners"), of(F.array_min, "x").alias("xmin"), of(F.array_min, "y").alias("ymin"), of(F.array_max, "x").alias("xmax"), of(F.array_max, "y").alias("ymax"))


@query(f"{_RINGS} SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM rings")
def areas_envelope(spark, d):
    return spark.createDataFrame([vector.envelope(_areas(spark, d))], "xmin double, ymin double, xmax double, ymax double")


_TREE_PLACES = "CAST(floor(tree_id / 100000) AS DOUBLE) * 5 + CAST(2.5 AS DOUBLE) AS x, CAST(tree_id % 100000 AS DOUBLE) * 5 + CAST(2.5 AS DOUBLE) AS y"
_TREE_REST = "z, npoints, convhull_area, dtm_z, slope_deg, aspect_deg"


def _placed_trees(spark, d):
    at = {"x": F.floor(F.col("tree_id") / 100_000).cast("double") * 5 + 2.5, "y": (F.col("tree_id") % 100_000).cast("double") * 5 + 2.5}
    return V.trees(spark, d).withColumns(at).select(*vector.TREE_COLUMNS)


@query(f"{WITH_TREES} SELECT tree_id, {_TREE_PLACES}, {_TREE_REST} FROM trees")
def trees_geopackage(spark, d):
    """Trees written as one GeoPackage for each chunk, by the tasks that hold them."""
    t = _placed_trees(spark, d)
    chunk = lambda c: chunk_of(F.round(F.col(c) * 100).cast("bigint"), 100.0)
    folder = _folder(spark, "layers")
    write_files(vector.encoded_layers(t.withColumns({"chunk_x": chunk("x"), "chunk_y": chunk("y")}), "chunk_x", "chunk_y"), folder)
    kinds = ", ".join(f"{c} {'bigint' if c in ('tree_id', 'npoints') else 'double'}" for c in vector.TREE_COLUMNS)
    return vector.read_gpkg(spark, folder, kinds)


# --- rasters -----------------------------------------------------------------------------------------------------


def _tiled(cells, product: str):
    return cells.select(F.lit(product).alias("product"), F.floor(F.col("col") / 10).alias("chunk_x"), F.floor(F.col("row") / 10).alias("chunk_y"), "col", "row", "value")


def _geotiffs(spark, d) -> str:
    folder = _folder(spark, "tiles")
    write_files(gtiff.encoded_tiles(_tiled(_dsm(V.points(spark, d)), "dsm"), G10.res, G10.crs), folder)
    return folder


_BY_TILE = "CAST(floor(col / 10) AS BIGINT) AS chunk_x, CAST(floor(row / 10) AS BIGINT) AS chunk_y"


@query(f"{WITH_POINTS}, a AS ({DSM10}) SELECT col, row, round(CAST(CAST(value AS REAL) AS DOUBLE), 6) AS value FROM a")
def geotiff_cells(spark, d):
    """The surface written as one GeoTIFF for each chunk, of 32-bit floats, and read as one mosaic."""
    return rounded(gtiff.read_cells(spark, _geotiffs(spark, d)).select("col", "row", "value"), "value")


@query(f"""{WITH_POINTS}, a AS (SELECT *, {_BY_TILE} FROM ({DSM10}) c)
SELECT concat('DSM_', CAST(min(col) * 10 AS VARCHAR), '_', CAST(min(row) * 10 AS VARCHAR), '.tif') AS name, max(col) - min(col) + 1 AS n_cols, max(row) - min(row) + 1 AS n_rows, CAST(min(col) * 10 AS DOUBLE) AS xmin, CAST(max(row) * 10 + 10 AS DOUBLE) AS ymax,
  CAST(10 AS DOUBLE) AS res, CAST(3005 AS INT) AS crs, count(*) AS n_values FROM a GROUP BY chunk_x, chunk_y""")
def geotiff_extents(spark, d):
    return gtiff.read_extents(spark, _geotiffs(spark, d)).select(_name("path"), "n_cols", "n_rows", "xmin", "ymax", "res", "crs", "n_values")


def _written(spark, d, trees=None) -> str:
    p, out = V.points(spark, d), _folder(spark, "products")
    pipeline.write_products(_tiled(_dsm(p), "dsm").unionByName(_tiled(_dtm(p), "dtm")), out, trees)
    return out


@query(f"{WITH_POINTS}, a AS (SELECT *, {_BY_TILE} FROM ({DTM10}) c) SELECT col, row, value FROM a WHERE chunk_x BETWEEN 1 AND 2 AND chunk_y BETWEEN 0 AND 1")
def products_in_window(spark, d):
    """A window of a product's tiles: only the folders of its chunks are read."""
    return pipeline.read_products(spark, _written(spark, d), "dtm", (100.0, 0.0, 250.0, 150.0)).select("col", "row", "value")


@query(f"{WITH_POINTS}, a AS ({DSM10}), b AS ({DTM10}) SELECT 'dsm' AS product, col, row, value FROM a UNION ALL SELECT 'dtm' AS product, col, row, value FROM b")
def mosaics_written(spark, d):
    out = _folder(spark, "mosaics")
    made = [spark.read.parquet(f"{out}/{p}_mosaic").withColumn("product", F.lit(p)) for p in pipeline.write_mosaics(spark, _written(spark, d), out)]
    return made[0].unionByName(made[1]).select("product", "col", "row", "value")


@query(f"{WITH_TREES} SELECT tree_id, z, npoints, dtm_z FROM trees")
def trees_of_all_chunks(spark, d):
    """An inventory written by chunk and read as one."""
    return pipeline.merged_trees(spark, _written(spark, d, _placed_trees(spark, d))).select("tree_id", "z", "npoints", "dtm_z")


# --- services ----------------------------------------------------------------------------------------------------


@lru_cache(maxsize=4)
def _stretches(folder: str) -> tuple[list[tuple[str, int]], list[int]]:
    """The row groups of a folder's files and, one longer, the number of rows before each: from the footers alone."""
    store, at = located(folder)
    groups, starts = [], [0]
    for path in sorted(f.path for f in store.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")):
        with store.open_input_file(path) as file:
            footer = pq.read_metadata(file)
        for k in range(footer.num_row_groups):
            groups.append((path, k))
            starts.append(starts[-1] + footer.row_group(k).num_rows)
    return groups, starts


@lru_cache(maxsize=2)
def _stretch(folder: str, k: int, fields: str) -> pa.Table:
    """One row group: successive pages mostly lie in the same one."""
    (path, group), store = _stretches(folder)[0][k], located(folder)[0]
    with store.open_input_file(path) as file:
        return pq.ParquetFile(file).read_row_group(group, fields.split(","))


def _page(folder: str, first: int, n: int, fields: str) -> tuple[list[dict], int]:
    """Rows first to first + n, from the row groups that hold them, and the number of all rows."""
    starts = _stretches(folder)[1]
    rows, k = [], bisect_right(starts, first) - 1
    while k < len(starts) - 1 and starts[k] < first + n:
        rows += _stretch(folder, k, fields).slice(max(0, first - starts[k]), first + n - max(first, starts[k])).to_pylist()
        k += 1
    return rows, starts[-1]


def _service(spark, d: str):
    """An index service over orders: it evaluates columns, offset and page, and says whether more are to come.

    Its table is a copy in small row groups, so a page costs what it holds and not the table, in whatever store that is."""
    folder = _folder(spark, "index")
    spark.read.parquet(f"{d}/orders.parquet").select(*_FIELDS.split(",")).write.option("parquet.block.size", 1 << 20).parquet(folder)

    def fetch(q: dict) -> tuple[int, str]:
        first, n = int(q["resultOffset"]), int(q["resultRecordCount"])
        rows, there = _page(folder, first, n, q["outFields"])
        return 200, json.dumps({"features": [{"attributes": r} for r in rows], "exceededTransferLimit": first + n < there})

    return fetch


_FIELDS, _SCHEMA = "o_orderkey,o_custkey", "o_orderkey bigint, o_custkey bigint"


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey FROM orders")
def index_in_turn(spark, d):
    """All pages of a service that doesn't say how many there are."""
    return read_index(spark, _service(spark, d), _SCHEMA, fields=_FIELDS)


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey FROM orders")
def index_by_page(spark, d):
    """All pages of a service that tells its count, a task each."""
    n = spark.read.parquet(f"{d}/orders.parquet").count()
    return read_index(spark, _service(spark, d), _SCHEMA, fields=_FIELDS, n_features=n, page=500)


def _get(url: str, timeout: float) -> tuple[int, bytes]:
    """A server: every 7th file isn't there, every 11th breaks off."""
    key = int(url.rsplit("/", 1)[1].split(".")[0])
    if key % 11 == 0:
        raise OSError(f"{url} broke off")
    return (404, b"") if key % 7 == 0 else (200, b"LASF")


_SUPPLIED = f"""WITH s AS (SELECT CAST(s_suppkey AS BIGINT) AS k, concat(CAST(s_suppkey AS VARCHAR), '.las') AS file FROM supplier),
r AS (SELECT file, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN NULL WHEN k % 7 = 0 THEN 404 ELSE 200 END AS status,
  CASE WHEN k % 13 = 0 THEN 'no url' WHEN k % 11 = 0 THEN concat('{PREFIX}', file, ' broke off') END AS error FROM s)"""


@query(f"{_SUPPLIED} SELECT file, coalesce(status = 200, FALSE) AS success, CAST(status AS INT) AS status, error, coalesce(status = 200, FALSE) AS present FROM r")
def files_fetched(spark, d):
    """The outcome of each transfer, and whether its file is there afterwards."""
    name = F.concat(F.col("s_suppkey").cast("string"), F.lit(".las"))
    files = spark.read.parquet(f"{d}/supplier.parquet").select(F.when(F.col("s_suppkey") % 13 != 0, F.concat(F.lit(PREFIX), name)).alias("url"), name.alias("filename"))
    folder, log = _folder(spark, "fetched"), _folder(spark, "fetched-log")
    store, at = located(folder)
    store.create_dir(at)
    fetched(files, to_folder(at, _get)).write.parquet(log)
    there = las.list_clouds(spark, folder).select(F.col("name").alias("file"), F.lit(True).alias("there"))
    return spark.read.parquet(log).join(there, "file", "left").select("file", "success", "status", "error", F.coalesce("there", F.lit(False)).alias("present"))


def _status(url: str, name: str) -> int:
    return 404 if int(name[3:-4]) % 11 == 0 else 200


def _present(spark, d):
    return V.tiles(spark, d).filter("tile_row % 3 = 0").select("filename")


_FETCHED = "tile_row % 11 <> 0 AS success, filename AS file, CAST(CASE WHEN tile_row % 11 <> 0 THEN 200 ELSE 404 END AS INT) AS status"


@query(f"{WITH_TILES} SELECT {_FETCHED} FROM tiles WHERE year = 1996 AND maptile LIKE '093h%' AND tile_row % 3 <> 0")
def acquire_by_sheet(spark, d):
    """Tiles of a year and sheet that aren't there yet, fetched in turn by one task."""
    cfg = DownloadConfig(use_aoi=False, year=1996, tile_numbers="all", parallel=False)
    return pipeline.acquire(V.tiles(spark, d), _present(spark, d), cfg, PREFIX, _status).select("success", "file", "status")


@query(f"""{WITH_TILES}, boxes AS ({_BOXES}), found AS (SELECT tiles.*, row_number() OVER (PARTITION BY maptile ORDER BY year DESC NULLS LAST, tile_row) AS rn FROM tiles JOIN boxes USING (tile_row)
  WHERE xmin <= 420 AND xmax >= 300 AND ymin <= 650 AND ymax >= 500 AND year >= 1994) SELECT {_FETCHED} FROM found WHERE rn = 1 AND tile_row % 3 <> 0""")
def acquire_by_area(spark, d):
    """The newest tile of each sheet that meets an area, unless it is there."""
    index = V.tiles(spark, d).join(_boxes(spark, d), "tile_row")
    return pipeline.acquire(index, _present(spark, d), DownloadConfig(min_year=1994), PREFIX, _status, (300.0, 500.0, 420.0, 650.0)).select("success", "file", "status")


@query(f"{WITH_TILES} SELECT count(*) AS n_asked, count(*) AS n_confirmed, CAST(0 AS BIGINT) AS n_declined FROM tiles WHERE tile_row % 3 <> 0 AND year >= 1992")
def acquire_confirmed(spark, d):
    """More than a hundred tiles are fetched only if the caller confirms it."""
    asked: list[int] = []
    run = lambda answer: pipeline.acquire(V.tiles(spark, d), _present(spark, d), DownloadConfig(min_year=1992, most_recent=False), PREFIX, _status, (0.0, 0.0, 1.0, 1.0), lambda n: asked.append(n) or answer).count()
    confirmed, declined = run(True), run(False)
    return spark.createDataFrame([(asked[0], confirmed, declined)], "n_asked bigint, n_confirmed bigint, n_declined bigint")


# --- restart -----------------------------------------------------------------------------------------------------


@query(f"""{WITH_POINTS}, c AS (SELECT {CHUNKS}, count(*) FILTER (WHERE cls = 2) AS n_ground, max(h) FILTER (WHERE cls <> 2 AND h BETWEEN 0 AND 30) AS highest FROM points GROUP BY 1, 2)
SELECT chunk_x, chunk_y, CASE WHEN n_ground = 0 THEN 'normalize' WHEN coalesce(highest, 0) < 2 THEN 'gate' ELSE 'done' END AS stage FROM c WHERE (chunk_x + chunk_y) % 2 = 1""")
def chunks_left_to_do(spark, d):
    """A restart after half of the chunks: the others' statuses."""
    p = V.points(spark, d)
    chunk = lambda c: chunk_of(F.col(c), 100.0)
    done = p.select(chunk("xi").alias("chunk_x"), chunk("yi").alias("chunk_y")).distinct().filter("(chunk_x + chunk_y) % 2 = 0")
    return pipeline.statuses(pipeline.catalog_pipeline(p, COARSE, done)).select("chunk_x", "chunk_y", "stage")
