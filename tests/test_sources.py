import json

import numpy as np
import pandas as pd
import pytest

from sparktree.config import DownloadConfig
from sparktree.plans import pipeline
from sparktree.sources import gtiff, index, las, store, vector
from sparktree.sources.download import fetched, to_folder


@pytest.mark.parametrize("shape", [(1, 1), (300, 500), (17, 256)])
@pytest.mark.parametrize("compression", [gtiff.NONE, gtiff.LZW, gtiff.DEFLATE])
@pytest.mark.parametrize("big", [False, True])
def test_geotiff_round_trip(shape, compression, big):
    rng = np.random.default_rng(1)
    v = np.round(rng.random(shape) * 30, 2).astype("f4").astype(float)
    v[rng.random(shape) < 0.1] = np.nan
    got, *where = gtiff.decode(gtiff.encode(v, 100.0, 250.5, 0.15, 3005, compression, 256, big))
    assert np.array_equal(v, got, equal_nan=True) and where == [100.0, 250.5, 0.15, 3005]


@pytest.mark.parametrize("n", [0, 1, 2, 511, 5000, 100_000])
def test_lzw(n):
    rng = np.random.default_rng(n)
    for high in (1, 2, 256):
        d = bytes(rng.integers(0, high, n, dtype=np.uint8))
        assert gtiff.lzw_decode(gtiff.lzw_encode(d)) == d


def test_tiles_are_written_and_read_as_one_mosaic(spark, tmp_path):
    rows = [("dsm", cx, 0, cx * 10 + c, r, float(c + r)) for cx in (0, 1) for c in range(10) for r in range(10) if (c, r) != (3, 3)]
    cells = spark.createDataFrame(rows, "product string, chunk_x bigint, chunk_y bigint, col bigint, row bigint, value double")
    for name, content in gtiff.encoded_tiles(cells, 2.0).collect():
        (tmp_path / name).write_bytes(content)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["DSM_0_0.tif", "DSM_20_0.tif"]
    got = gtiff.read_cells(spark, str(tmp_path)).drop("path")
    assert sorted(map(tuple, got.collect())) == sorted((c, r, v) for _, _, _, c, r, v in rows)
    pipeline.write_products(cells, str(tmp_path / "out"))
    pipeline.write_products(cells.filter("chunk_x = 1"), str(tmp_path / "out"))  # a rerun replaces its own chunks
    assert pipeline.read_products(spark, str(tmp_path / "out"), "dsm").count() == len(rows)
    assert pipeline.read_products(spark, str(tmp_path / "out"), "dsm", (0.0, 0.0, 50.0, 50.0)).count() == 99


def test_las(spark, tmp_path):
    rng = np.random.default_rng(0)
    c = pd.DataFrame({"x": rng.random(500) * 100 + 1e6, "y": rng.random(500) * 100, "z": rng.random(500) * 30, "cls": rng.integers(0, 6, 500), "return_number": 1, "number_of_returns": 2, "intensity": rng.integers(0, 60000, 500), "gps_time": rng.random(500)})
    (tmp_path / "a.las").write_bytes(las.encode(c))
    (tmp_path / "b.las").write_bytes(las.encode(c.iloc[:0]))
    (tmp_path / "c.txt").write_text("no cloud")
    p = las.read_points(spark, str(tmp_path)).toPandas().sort_values("point_id")
    assert len(p) == 500 and np.abs(p["x"].to_numpy() - c["x"]).max() < 1e-3 and (p["cls"].to_numpy() == c["cls"]).all() and (p["xi"] == np.round(p["x"] * 100)).all()
    cat = {r["path"].rsplit("/")[-1]: r for r in las.read_catalog(spark, str(tmp_path)).collect()}
    assert cat["a.las"]["n_points"] == 500 and cat["b.las"]["n_points"] == 0 and cat["a.las"]["xmin"] == pytest.approx(c["x"].min())
    assert sorted(r["name"] for r in las.list_clouds(spark, str(tmp_path)).collect()) == ["a.las", "b.las"]
    squeezed = bytearray(las.encode(c))
    squeezed[104] |= 0x80
    with pytest.raises(las.LasError, match="compressed"):
        las.points(bytes(squeezed))
    with pytest.raises(las.LasError):
        las.header(b"nothing of the kind")


def test_a_cloud_is_read_by_ranges(spark, tmp_path):
    c = pd.DataFrame({"x": np.arange(100) / 8, "y": np.arange(100) / 4, "z": np.arange(100) / 2, "cls": np.arange(100) % 7})
    clouds = spark.createDataFrame(c.assign(part=(np.arange(100) >= 30).astype(int)))
    for _ in range(2):  # a rerun replaces the files
        store.write_files(las.encoded_clouds(clouds, "part"), str(tmp_path / "some clouds"))
    assert sorted(p.name for p in (tmp_path / "some clouds").iterdir()) == ["cloud_0.las", "cloud_1.las"]
    whole, parts = (sorted(map(tuple, las.read_points(spark, str(tmp_path), a_task=n).drop("gps_time").collect())) for n in (10**6, 7))
    assert whole == parts and len({r[0] for r in parts}) == 100 and las.read_points(spark, str(tmp_path), a_task=7).rdd.getNumPartitions() == 5 + 10
    assert sorted((r[3], r[6]) for r in parts) == sorted(zip(c["x"], c["cls"]))
    assert whole == sorted(map(tuple, las.read_points(spark, str(tmp_path), whole=True).drop("gps_time").collect()))
    assert sorted(map(tuple, las.read_catalog(spark, str(tmp_path)).collect())) == sorted(map(tuple, las.read_catalog(spark, str(tmp_path), whole=True).collect()))
    (tmp_path / "cut.las").write_bytes(las.encode(c)[:-1])
    with pytest.raises(Exception, match="the file ends before point 100"):
        las.read_points(spark, str(tmp_path)).count()


def test_ranges_of_bytes(tmp_path):
    (tmp_path / "f").write_bytes(bytes(range(10)))
    for path in (f"{tmp_path}/f", f"file:{tmp_path}/f", f"file://{tmp_path}/f"):
        assert [store.read_range(path, *r) for r in ((0, 3), (8, 5), (10, 1), (99, 1))] == [b"\0\1\2", b"\x08\x09", b"", b""]


def test_geopackage(spark, tmp_path):
    a = pd.DataFrame({"tree_id": [1, 2], "x": [1.5, 2.5], "y": [3.5, 4.5], "z": [10.0, None], "name": ["a", None]})
    vector.write_gpkg(a, str(tmp_path / "a.gpkg"))
    vector.write_gpkg(a, str(tmp_path / "a.gpkg"))
    vector.write_gpkg(a[["tree_id", "x", "y"]].iloc[:1], str(tmp_path / "b.gpkg"))
    got = vector.read_gpkg(spark, str(tmp_path), "tree_id bigint, x double, y double, z double, name string").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 1.5, 3.5, 10.0, "a"), (2, 2.5, 4.5, None, None), (1, 1.5, 3.5, None, None)], key=repr)


def test_folders_of_clouds(spark, tmp_path):
    c = pd.DataFrame({"x": [1.0, 2.0], "y": [1.0, 2.0], "z": [3.0, 4.0]})
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.las").write_bytes(las.encode(c))
    squeezed = bytearray(las.encode(c))
    squeezed[104] |= 0x80
    (tmp_path / "b" / "z.laz").write_bytes(bytes(squeezed))
    a, b, none = str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "none")
    with pytest.warns(UserWarning, match="using 2 of 3"):
        assert sorted(r["name"] for r in las.list_clouds(spark, a, none, b).collect()) == ["a.las", "b.las", "z.laz"]
    with pytest.raises(las.LasError, match="none of the 1"):
        las.list_clouds(spark, none)
    got = las.read_points(spark, str(tmp_path), compressed="skip").toPandas()
    assert len(got) == 4 and got["point_id"].is_unique and got.groupby("file")["point_id"].apply(lambda v: v.max() - v.min()).tolist() == [1, 1]
    assert [r["compressed"] for r in las.read_catalog(spark, str(tmp_path)).orderBy("path").collect()] == [False, False, True]


def test_areas_of_several_parts_are_reprojected(spark, tmp_path):
    square = lambda x, y, d, back=False: [(x, y), (x, y + d), (x + d, y + d), (x + d, y), (x, y)][:: -1 if back else 1]
    shapes = [[square(-122.0, 54.0, 0.2), square(-121.9, 54.1, 0.05, True), square(-120.0, 53.0, 0.1)]]
    (tmp_path / "aoi.shp").write_bytes(vector.encode_polygons(shapes))
    as_is = vector.read_areas(spark, str(tmp_path / "aoi.shp"), 4326, 4269).orderBy("part").collect()
    assert [(r["aoi_id"], r["part"], r["hole"]) for r in as_is] == [(0, 0, False), (0, 1, True), (0, 2, False)] and [(p["x"], p["y"]) for p in as_is[2]["ring"]] == shapes[0][2]
    box = vector.envelope(vector.read_areas(spark, str(tmp_path / "aoi.shp"), 4326, 3005))
    assert 1e6 < box[0] < box[2] < 1.5e6 and 8e5 < box[1] < box[3] < 1.2e6
    web = vector.envelope(vector.read_areas(spark, str(tmp_path / "aoi.shp"), 4326, 3857))
    assert web[0] == pytest.approx(-122 * 111319.49, rel=1e-4)
    with pytest.raises(ValueError, match="EPSG:1"):
        vector.read_areas(spark, str(tmp_path / "aoi.shp"), 1, 3005)


def test_errors_of_the_index_service_are_raised():
    answers = iter([(200, json.dumps({"features": [1], "exceededTransferLimit": True})), (503, "busy")])
    with pytest.raises(index.IndexServiceError, match="503"):
        list(index.pages(lambda q: next(answers)))
    for body in ('{"error": {"code": 400}}', "<html>oops"):
        with pytest.raises(index.IndexServiceError):
            list(index.pages(lambda q: body))


def test_shapefile(spark, tmp_path):
    shapes = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]], [[(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 5.0)], [(5.2, 5.1), (5.3, 5.1), (5.3, 5.2), (5.2, 5.1)]]]
    assert vector.polygons(vector.encode_polygons(shapes)) == shapes
    (tmp_path / "aoi.shp").write_bytes(vector.encode_polygons(shapes))
    rows = vector.read_areas(spark, str(tmp_path / "aoi.shp")).orderBy("aoi_id", "part").collect()
    assert [(p["x"], p["y"]) for p in rows[1]["ring"]] == shapes[1][0]
    with pytest.raises(ValueError):
        vector.polygons(b"\0" * 120)


def service(n, silent=False):
    def fetch(q):
        first, size = int(q["resultOffset"]), int(q["resultRecordCount"])
        part = range(first, min(n, first + size))
        body = {"features": [{"attributes": {"filename": f"f{k}.laz", "year": 2000 + k % 20, "s3Url": None, "maptile": f"093h{k % 1000:03d}_1_1_1", "path": "\\a\\b"}} for k in part]}
        if not silent:
            body["exceededTransferLimit"] = first + size < n
        return json.dumps(body)

    return fetch


@pytest.mark.parametrize("n", [0, 1, 1999, 2000, 2001, 4500])
def test_index_pages(spark, n):
    assert index.read_index(spark, service(n)).count() == n
    assert index.read_index(spark, service(n), n_features=n).select("filename").distinct().count() == n


def test_index_without_the_flag_ends_after_a_page(spark):
    assert index.read_index(spark, service(4500, silent=True)).count() == 2000


def test_acquire(spark, tmp_path):
    tiles = index.read_index(spark, service(300)).withColumnRenamed("filename", "f").selectExpr("f filename", "year", "s3Url", "maptile", "path", "cast(substring(f, 2) as int) tile_row")
    tiles = tiles.filter("not f like 'f7%'") if "f" in tiles.columns else tiles
    present = spark.createDataFrame([("f1.laz",)], "filename string")

    def get(url, timeout):
        if "f5" in url:
            raise OSError("no route")
        return (404, b"") if url.endswith("x") else (200, url.encode())

    rows = tiles.limit(40).withColumn("url", tiles["filename"])
    out = fetched(rows, to_folder(str(tmp_path), get), 3).toPandas()
    assert len(out) == 40 and out.loc[~out["success"].astype(bool), "error"].eq("no route").all()
    assert {p.name for p in tmp_path.iterdir()} == set(out.loc[out["success"].astype(bool), "file"])
    cfg = DownloadConfig(use_aoi=False, year=2003, tile_numbers="all")
    got = pipeline.acquire(tiles, present, cfg, "https://host/", lambda url, name: 200 if url == "https://host//a/b" else 500)
    assert got.count() == 15 and got.filter("success").count() == 15
    assert pipeline.acquire(tiles, present, DownloadConfig(most_recent=False), "https://h", lambda u, n: 200, aoi=(0, 0, 1, 1), confirm=lambda n: False).count() == 0
    with pytest.raises(pipeline.PipelineError):
        pipeline.select_tiles(tiles, DownloadConfig())


def test_a_page_of_the_stand_in_service_costs_what_it_holds(spark, sf, monkeypatch):
    """The service read its whole table again for every page."""
    from sparktree.plans import file_queries

    read = []
    stretch = file_queries._stretch
    monkeypatch.setattr(file_queries, "_stretch", lambda *a: read.append(a) or stretch(*a))
    fetch = file_queries._service(spark, sf)
    there = spark.read.parquet(f"{sf}/orders.parquet").count()
    said = [json.loads(fetch(index.request(fields="o_orderkey,o_custkey", offset=k, page=700))[1]) for k in range(0, there + 700, 700)]
    keys = [f["attributes"]["o_orderkey"] for s in said for f in s["features"]]
    assert len(keys) == len(set(keys)) == there and not said[-1]["features"]
    assert [s["exceededTransferLimit"] for s in said] == [k + 700 < there for k in range(0, there + 700, 700)]
    _, starts = file_queries._stretches(read[0][0])
    assert all(starts[k] < there for _, k, _ in read) and len(read) < len(said) + len(starts)


def test_many_pages_share_a_task_and_each_is_a_batch():
    from sparktree.sources.index import A_TASK, TASKS, _Reader

    fetch = lambda q: json.dumps({"features": [q["resultOffset"]]})
    for n in (0, 1, 7, 64 * 5, 64 * 5 + 1, 100_000):
        reader = _Reader(fetch, {"n_features": str(n), "page": "5"})
        parts = reader.partitions()
        assert [o for p in parts for o in p.offsets] == list(range(0, max(1, n), 5))
        assert max(len(p.offsets) for p in parts) <= A_TASK and len(parts) <= max(TASKS, -(-n // 5 // A_TASK) + 1)
        batches = list(reader.read(parts[-1]))
        assert [b.num_rows for b in batches] == [1] * len(parts[-1].offsets)


def test_pages_in_turn_have_no_end_but_the_service_s():
    def body(first, n, there):
        return json.dumps({"features": [{"attributes": {"k": k}} for k in range(first, min(first + n, there))], "exceededTransferLimit": first + n < there})

    many = index.pages(lambda q: body(int(q["resultOffset"]), int(q["resultRecordCount"]), 100_003), page=1)
    assert sum(1 for _ in many) == 100_003
    for fewest in (1, 7, 10):  # a service that gives at most so many features, whatever is asked for
        got = index.pages(lambda q: body(int(q["resultOffset"]), min(fewest, int(q["resultRecordCount"])), 25), page=10)
        assert [f["attributes"]["k"] for b in got for f in json.loads(b)["features"]] == list(range(25))


def test_offsets_beyond_two_billion():
    assert index._row(3_000_000_000, "{}").column(0).to_pylist() == [3_000_000_000]
