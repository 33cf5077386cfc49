"""Surfaces, crowns and light on shapes whose answers are known."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparktree.config import PipelineConfig
from sparktree.functions import canopy, tin
from sparktree.functions.grid import GridSpec, circle_offsets
from sparktree.operators import chunks, points as P, raster as R, trees as T
from sparktree.operators.daylight import sun_table, time_in_daylight
from sparktree.plans import pipeline


@pytest.mark.parametrize("n", [3, 4, 30, 2000])
def test_a_plane_is_interpolated_exactly(n):
    rng = np.random.default_rng(n)
    x, y = rng.random(n) * 100, rng.random(n) * 100
    q = rng.random((3000, 2)) * 100
    got = tin.interpolate(x, y, 3 + 0.5 * x - 0.2 * y, q[:, 0], q[:, 1], extrapolate=False)
    inside = ~np.isnan(got)
    assert np.allclose(got[inside], 3 + 0.5 * q[inside, 0] - 0.2 * q[inside, 1], atol=1e-9)
    assert np.isfinite(tin.interpolate(x, y, x, q[:, 0], q[:, 1], furthest=200.0)).all()


def test_triangles_are_delaunay_and_fill_the_hull():
    rng = np.random.default_rng(0)
    x, y = rng.random(150) * 10, rng.random(150) * 10
    d = tin.Delaunay(x, y)
    t = d.tri[d.real]
    area = 0.0
    for a, b, c in t:
        e = np.array([[d.px[i] - d.px[a], d.py[i] - d.py[a]] for i in (b, c)])
        area += abs(np.linalg.det(e)) / 2
        o = np.linalg.solve(e, (e**2).sum(1) / 2)
        assert ((d.px[:150] - d.px[a] - o[0]) ** 2 + (d.py[:150] - d.py[a] - o[1]) ** 2 >= (o**2).sum() * (1 - 1e-9)).all()
    assert area == pytest.approx(tin.hull_area(x, y))


def test_points_on_circles_lines_and_one_place():
    gx, gy = np.meshgrid(np.arange(20.0), np.arange(20.0))
    q = np.random.default_rng(1).random((200, 2)) * 19
    assert np.allclose(tin.interpolate(gx.ravel(), gy.ravel(), (gx + 2 * gy).ravel(), q[:, 0], q[:, 1]), q[:, 0] + 2 * q[:, 1])
    line = np.arange(10.0)
    assert np.isfinite(tin.interpolate(line, line, line, q[:, 0], q[:, 1])).all()
    assert (tin.interpolate([5.0] * 4, [5.0] * 4, [1.0, 2.0, 3.0, 0.0], [6.0], [6.0]) == 3).all()
    assert np.isnan(tin.interpolate([], [], [], [1.0], [1.0])).all()
    assert np.isnan(tin.interpolate([0.0], [0.0], [1.0], [51.0], [0.0])).all()


def test_hull_areas():
    assert tin.hull_area([0, 1, 1, 0, 0.5], [0, 0, 1, 1, 0.5]) == 1.0
    assert tin.hull_area([0, 1, 0], [0, 0, 1]) == 0.5
    assert tin.hull_area([0, 1, 2], [0, 1, 2]) == 0.0 and tin.hull_area([1], [1]) == 0.0


def cones(size=40):
    yy, xx = np.mgrid[0:size, 0:size] * 1.0
    return np.maximum(0, np.maximum(12 - np.hypot(xx - 10, yy - 10) * 1.2, 15 - np.hypot(xx - 28, yy - 26) * 1.5))


def brute_maxima(v, res, least=2.0):
    reach = canopy.window_size(v) / 2
    out = []
    for r, c in np.argwhere(v >= least):
        near = [(v[i, j], -i, -j) for i in range(v.shape[0]) for j in range(v.shape[1]) if math.hypot(i - r, j - c) * res <= reach[r, c]]
        if max(near) == (v[r, c], -r, -c):
            out.append((int(r), int(c)))
    return out


def test_treetops(spark):
    v = cones()
    assert canopy.local_maxima(v, 1.0) == [(10, 10), (26, 28)] == brute_maxima(v, 1.0)
    noisy = np.round(np.random.default_rng(3).random((15, 15)) * 8) * 4
    want = brute_maxima(noisy, 0.8)
    assert canopy.local_maxima(noisy, 0.8) == want
    cells = spark.createDataFrame(pd.DataFrame([(c, r, noisy[r, c]) for r in range(15) for c in range(15)], columns=["col", "row", "value"]))
    assert sorted((r["row"], r["col"]) for r in T.treetops(cells, GridSpec(0.8)).collect()) == want


def test_crowns_of_two_cones():
    v = cones()
    c = canopy.grow_crowns(v, [(10, 10), (26, 28)])
    for k, (r0, c0, h) in enumerate(((10, 10, 12), (26, 28, 15)), 1):
        at = np.argwhere(c == k)
        assert (v[c == k] > max(2, 0.45 * h)).all() and (np.abs(at - (r0, c0)) < 10).all() and c[r0, c0] == k
        assert (v[c == k] <= 1.05 * h).all()
    assert canopy.grow_crowns(v, []).sum() == 0


def test_pit_free_fills_pits():
    yy, xx = np.mgrid[0:30, 0:30] + 0.5
    h = np.full(900, 20.0)
    h[450] = 1.0  # a pit
    got = canopy.pit_free(xx.ravel(), yy.ravel(), h, xx.ravel(), yy.ravel(), 1.0, subcircle=0.0)
    assert got[450] == pytest.approx(20.0)


def cells_of(spark, v):
    return spark.createDataFrame(pd.DataFrame([(c, r, float(v[r, c])) for r in range(v.shape[0]) for c in range(v.shape[1]) if not np.isnan(v[r, c])], columns=["col", "row", "value"]))


def test_terrain_needs_all_neighbours(spark):
    yy, xx = np.mgrid[0:6, 0:7] * 5.0
    z = 0.1 * xx + 0.05 * yy
    z[2, 2] = np.nan
    got = R.terrain(cells_of(spark, z), GridSpec(5.0)).toPandas()
    assert len(got) == 4 * 5 - 9
    assert np.allclose(got["slope"], math.degrees(math.atan(math.hypot(0.1, 0.05)))) and np.allclose(got["aspect"], 243.434949)
    flat = R.terrain(cells_of(spark, np.zeros((3, 3))), GridSpec(1.0)).collect()[0]
    assert (flat["slope"], flat["aspect"]) == (0.0, 90.0)


@pytest.mark.parametrize("radius", [0.5, 1.0, 2.5, 7.0])
def test_focal_sums_agree_with_brute_force(spark, radius):
    v = (np.random.default_rng(5).random((12, 17)) < 0.2).astype(float)
    off = circle_offsets(radius, 1.0)
    want = {(c, r): sum(v[r + dr, c + dc] for dc, dr in off if 0 <= r + dr < 12 and 0 <= c + dc < 17) for r in range(12) for c in range(17)}
    for f in (R.focal_circle, lambda *a: R.focal_blocks(*a, block=5)):
        assert {(r["col"], r["row"]): r["value"] for r in f(cells_of(spark, v), GridSpec(1.0), radius).collect()} == want


def test_daylight(spark):
    sun = sun_table(spark, 54.0, -122.0, step=120)
    noon = sun.filter("day = 172").orderBy(F.desc("altitude")).first()
    assert noon["altitude"] == pytest.approx(90 - 54 + 23.44, abs=1.5) and noon["azimuth"] == pytest.approx(180, abs=25)
    flat = time_in_daylight(cells_of(spark, np.zeros((8, 8))), GridSpec(10.0), sun)
    assert {r["value"] for r in flat.collect()} == {1.0}
    wall = np.zeros((9, 9))
    wall[4, :] = 30.0  # from west to east: its northern side is dark
    got = {(r["row"], r["col"]): r["value"] for r in time_in_daylight(cells_of(spark, wall), GridSpec(10.0), sun, block=4).collect()}
    assert got[5, 4] < got[3, 4] and got[4, 4] == 1.0 and len(got) == 81


def cloud(spark, trees=((30.0, 40.0, 12.0), (71.0, 66.0, 15.0), (99.9, 100.2, 14.0)), side=112.0, step=1.5, seed=0):
    """A flat ground of 100 m with conical trees."""
    rng = np.random.default_rng(seed)
    g = np.arange(0.5, side, step)
    gx, gy = (a.ravel() for a in np.meshgrid(g, g))
    x, y = [gx + rng.random(len(gx)) * 0.4 - 0.2], [gy + rng.random(len(gx)) * 0.4 - 0.2]
    z, cls = [np.full(len(gx), 100.0)], [np.full(len(gx), 2)]
    for tx, ty, h in trees:
        a, d = rng.random(400) * 6.283, np.sqrt(rng.random(400)) * 4
        x.append(np.append(tx + d * np.cos(a), tx))
        y.append(np.append(ty + d * np.sin(a), ty))
        z.append(np.append(100 + h - d * 1.5, 100 + h))
        cls.append(np.full(401, 5))
    p = pd.DataFrame({"xi": np.round(np.concatenate(x) * 100).astype(int), "yi": np.round(np.concatenate(y) * 100).astype(int), "z": np.round(np.concatenate(z), 3), "cls": np.concatenate(cls).astype("int32")})
    p["x"], p["y"], p["point_id"] = p["xi"] / 100.0, p["yi"] / 100.0, np.arange(len(p))
    return spark.createDataFrame(p)


def found(spark, **how):
    # without undergrowth the canopy is a sheet between the trees; what is found on it has few points
    cfg = PipelineConfig(resolution=1.0, min_points=50, **how)
    return sorted((round(r["x"]), round(r["y"]), round(r["z"]), r["npoints"], round(r["dtm_z"], 3)) for r in pipeline.inventory(pipeline.catalog_pipeline(cloud(spark), cfg), cfg).collect())


def test_trees_are_found_and_halo_mode_ignores_seams(spark):
    one = found(spark, chunk_size=200.0, edge="halo")
    assert [t[:3] for t in one] == [(30, 40, 12), (71, 66, 15), (100, 100, 14)] and all(t[4] == 100.0 for t in one)
    # a surface depends a little on how far its points reach, so crowns may gain or lose a few points at their edge
    small = found(spark, chunk_size=50.0, edge="halo")
    assert [t[:3] + t[4:] for t in small] == [t[:3] + t[4:] for t in one] and all(abs(a[3] - b[3]) < 0.1 * b[3] for a, b in zip(small, one))
    cut = found(spark, chunk_size=100.0, edge="core")  # the tree on the corner of four chunks falls apart
    assert [t[:3] for t in cut if t[0] < 80] == [t[:3] for t in one if t[0] < 80] and len([t for t in cut if t[0] > 80]) >= 2


def test_early_ends_leave_a_status(spark):
    p = cloud(spark, side=60.0, trees=((30.0, 30.0, 12.0),))
    cfg = PipelineConfig(resolution=1.0, chunk_size=60.0)
    stage = lambda q: {r["stage"] for r in pipeline.statuses(pipeline.catalog_pipeline(q, cfg)).filter("chunk_x = 0 and chunk_y = 0").collect()}
    assert stage(p) == {"done"}
    assert stage(p.filter("cls <> 2")) == {"normalize"}
    assert stage(p.filter("cls = 2")) == {"gate"}
    assert stage(p.filter("z < 101.5")) == {"gate"}
    assert pipeline.catalog_pipeline(p.limit(0), cfg).count() == 0
    done = spark.createDataFrame([(0, 0)], "chunk_x bigint, chunk_y bigint")
    assert pipeline.catalog_pipeline(p, cfg, done).filter("chunk_x = 0 and chunk_y = 0").count() == 0


def test_normalised_ground_is_zero(spark):
    p = cloud(spark, side=50.0, trees=((20.0, 20.0, 9.0),))
    got = chunks.interpolated_ground(p, PipelineConfig(chunk_size=50.0)).toPandas()
    assert np.allclose(got.loc[got["cls"] == 2, "height"].astype(float), 0) and got.loc[got["cls"] == 5, "height"].max() == pytest.approx(9.0, abs=1e-6)


def test_sample_pipeline_and_scene(spark):
    cfg = PipelineConfig(resolution=1.0, time_step_minutes=240)
    result, trees = pipeline.sample_pipeline(cloud(spark), cfg, seed=3)
    assert {r["product"] for r in result.select("product").distinct().collect()} >= {"dtm", "dsm", "slope", "aspect", "hillshade", "status"}
    assert trees.columns[:3] == ["tree_id", "x", "y"]
    dsm = pipeline.rasters(pipeline.catalog_pipeline(cloud(spark, side=60.0, trees=()), cfg), "dsm")
    assert pipeline.scene_daylight(dsm, GridSpec(1.0), cfg).agg(F.min("value")).first()[0] == 1.0
    with pytest.raises(pipeline.PipelineError):
        pipeline.scene_daylight(dsm.limit(0), GridSpec(1.0), cfg)
    assert len(pipeline.statistics(trees, 20)) == 9


def test_quantiles_without_one_task(spark):
    rng = np.random.default_rng(4)
    v = np.round(rng.random(4000) ** 3 * 500, 1)
    rows = spark.createDataFrame(pd.DataFrame({"v": np.append(v, [np.nan] * 5)})).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    assert T.quantiles(rows, "v", (0.0, 0.25, 0.5, 0.75, 1.0)) == pytest.approx(np.quantile(v, [0, 0.25, 0.5, 0.75, 1]).tolist())
    at = T.order_statistics(rows, "v", [0, 17, 2000, 3999], enough=20)
    assert at == {k: np.sort(v)[k] for k in (0, 17, 2000, 3999)}
    assert T.summary(rows, ["v"], few=0).collect()[0][1:7] == pytest.approx(T.summary(rows, ["v"]).collect()[0][1:7])
    assert T.quantiles(rows.limit(0), "v", (0.5,)) == [None]


def test_clouds_as_they_come(spark):
    """First returns make the canopy; water is level ground but no terrain; classes and return numbers may be missing."""
    cfg = PipelineConfig(resolution=1.0, chunk_size=60.0)
    p = cloud(spark, side=60.0, trees=((30.0, 30.0, 12.0),)).withColumn("return_number", F.lit(1))
    high = p.filter("cls = 5").withColumns({"z": F.col("z") + 10, "return_number": F.lit(2), "point_id": F.col("point_id") + 10**6})
    top = lambda q: pipeline.rasters(pipeline.catalog_pipeline(q, cfg), "chm").agg(F.max("value")).first()[0]
    assert top(p.unionByName(high)) == pytest.approx(top(p), abs=1e-6)  # returns above that aren't first ones change nothing
    assert top(p.unionByName(high).drop("return_number")) > top(p) + 5
    water = p.withColumn("cls", F.when((F.col("cls") == 2) & (F.col("x") > 20), 9).otherwise(F.col("cls")))
    got = chunks.interpolated_ground(water, cfg).filter("cls = 9").agg(F.max(F.abs("height"))).first()[0]
    assert got == pytest.approx(0, abs=1e-9)
    result = pipeline.catalog_pipeline(water.filter("cls <> 2"), cfg)
    made = {r["product"] for r in result.select("product").distinct().collect()}
    assert {"chm", "dsm", "trees"} <= made and not {"dtm", "slope"} & made
    without = pipeline.catalog_pipeline(p.drop("cls"), cfg)
    assert {r["product"] for r in without.select("product").distinct().collect()} == {"dsm", "status"}


def test_exact_duplicates_only(spark):
    d = spark.createDataFrame([(1, 100, 100, 1.001, 1.0, 5.0, 2), (2, 100, 100, 1.004, 1.0, 5.0, 2), (3, 100, 100, 1.004, 1.0, 5.0, 5)], "point_id long, xi long, yi long, x double, y double, z double, cls int")
    assert sorted(r["point_id"] for r in P.deduplicated(d).collect()) == [1, 2]


def test_a_restart_computes_no_finished_chunk(spark, tmp_path):
    cfg = PipelineConfig(resolution=2.0, chunk_size=30.0)
    p = cloud(spark, side=60.0, trees=((15.0, 15.0, 12.0),))
    first = pipeline.catalog_pipeline(p.filter("x < 30"), cfg).persist()
    out = str(tmp_path / "products")
    pipeline.write_products(first, out, pipeline.inventory(first, cfg), cfg.chunk_size)
    done = pipeline.finished_chunks(spark, out)
    n = done.count()
    assert n >= 2

    def refuses(key, held):
        assert key not in finished, "a finished chunk was computed again"
        return pd.DataFrame({"chunk_x": [key[0]], "chunk_y": [key[1]]})

    finished = {(r["chunk_x"], r["chunk_y"]) for r in done.collect()}
    ran = chunks.apply_chunks(p, refuses, "chunk_x bigint, chunk_y bigint", 30.0, 5.0, done).collect()
    assert len(ran) == chunks.apply_chunks(p, lambda k, h: pd.DataFrame({"n": [1]}), "n bigint", 30.0, 5.0).count() - n and not finished & {tuple(r) for r in ran}
    rest = pipeline.catalog_pipeline(p, cfg, done).persist()
    pipeline.write_products(rest, out, pipeline.inventory(rest, cfg), cfg.chunk_size)
    assert pipeline.finished_chunks(spark, out).count() == n + len(ran)
    assert pipeline.merged_trees(spark, out).columns[:3] == ["tree_id", "x", "y"] and pipeline.merged_trees(spark, out).count() >= 1
    made = pipeline.write_mosaics(spark, out, str(tmp_path / "mosaic"))
    assert set(made) == set(pipeline.PRODUCTS)
    assert spark.read.parquet(str(tmp_path / "mosaic" / "dtm_mosaic")).count() == pipeline.read_products(spark, out, "dtm").count()


def test_nearest_means_by_tiles():
    rng = np.random.default_rng(6)
    px, py, pz = rng.random(500) * 40, rng.random(500) * 90, rng.random(500)
    x, y = rng.random(800) * 200 - 80, rng.random(800) * 200 - 80
    got = tin.nearest_mean(px, py, pz, x, y, 3, 1.0, 50.0, tiles=7)
    d = np.hypot(x[:, None] - px, y[:, None] - py)
    near = np.argsort(d, 1)[:, :3]
    dist = np.take_along_axis(d, near, 1)
    w = np.where(dist <= 50, 1 / dist, 0)
    with np.errstate(invalid="ignore"):
        want = np.where(w.sum(1) > 0, (w * pz[near]).sum(1) / w.sum(1), np.nan)
    assert np.allclose(got, want, equal_nan=True) and np.isnan(want).any()


def test_gaps_from_the_cells_beside_them():
    rng = np.random.default_rng(7)
    cx, cy = np.meshgrid(np.arange(30) + 0.5, np.arange(30) + 0.5)
    grid = 3 * cx - cy + 2
    empty = rng.random((30, 30)) < 0.2
    empty[5:12, 8:20] = True
    inner = np.zeros_like(empty)
    inner[2:-2, 2:-2] = True
    got = np.where(empty, np.nan, grid)
    got[empty] = chunks._gaps(got, empty, cx, cy, {})
    assert np.allclose(got[inner], grid[inner])


@pytest.mark.parametrize("shape", ["square", "corner", "two"])
def test_blocks_find_the_triangles_of_the_whole(shape, monkeypatch):
    """A surface of many points was triangulated at once, some hundred bytes of Python objects for each triangle."""
    r = np.random.default_rng(3)
    x, y = r.random(3000) * 100, r.random(3000) * 100
    if shape == "corner":
        x, y = x[keep := (x < 30) | (y < 30)], y[keep]
    if shape == "two":
        x, y = np.r_[x / 10, x / 10 + 80], np.r_[y / 10, y / 20 + 50]
    z, qx, qy = r.random(len(x)), r.random(4000) * 110 - 5, r.random(4000) * 110 - 5
    whole = tin.Surface(x, y, z).at(qx, qy, extrapolate=False)
    made, of = [], tin.Delaunay
    monkeypatch.setattr(tin, "A_BLOCK", 300)
    monkeypatch.setattr(tin, "Delaunay", lambda x, *how: made.append(len(x)) or of(x, *how))
    surface = tin.Surface(x, y, z)
    assert np.allclose(surface.at(qx, qy, extrapolate=False), whole, equal_nan=True, atol=1e-9)
    assert np.allclose(surface.at(qx[:9], qy[:9], extrapolate=False), whole[:9], equal_nan=True, atol=1e-9)
    assert surface.blocks.whole is None and max(made) < len(x) / 2 or shape != "square"


@pytest.mark.parametrize("edge", ["core", "halo"])
def test_a_chunk_taken_in_parts_has_the_same_products(spark, edge, monkeypatch):
    """All rows of a chunk were held at once."""
    cfg = PipelineConfig(resolution=1.0, subcircle=0.2, min_points=2, edge=edge, chunk_size=40.0, max_edge=(0.0, 1.5))
    rows = chunks.chunk_products(cloud(spark), cfg)
    taken = cloud(spark).selectExpr("point_id", "cast(xi as bigint) xi", "cast(yi as bigint) yi", "x", "y", "z", "cls", "true first").toPandas()
    s, b, key = 4000, round(cfg.halo() * 100), (1, 1)
    taken = taken[(taken.xi >= s - b) & (taken.xi <= 2 * s + b) & (taken.yi >= s - b) & (taken.yi <= 2 * s + b)].copy()
    in_core = (taken.xi // s == 1) & (taken.yi // s == 1)
    taken["turn"] = np.where(taken.cls == 2, chunks.ON_LEVEL, np.where(in_core, chunks.IN_CORE, chunks.IN_HALO)).astype("int32")
    whole = rows.filter("chunk_x = 1 and chunk_y = 1").toPandas()
    monkeypatch.setattr(chunks, "IN_ROWS", 100)
    monkeypatch.setattr(chunks, "OUT_ROWS", 100)
    table = pa.Table.from_pandas(taken.sort_values("turn")[list(chunks.TAKEN)], preserve_index=False)
    parts = list(chunks.process_chunk(key, iter(table.to_batches(max_chunksize=70)), cfg))
    assert max(p.num_rows for p in parts) <= 100 < len(whole)
    order = ["product", "col", "row", "point_id", "tree_id"]
    got = pa.Table.from_batches(parts).to_pandas().sort_values(order).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, whole.sort_values(order).reset_index(drop=True), check_dtype=False)
    with pytest.raises(RuntimeError, match="out of order"):
        list(chunks.process_chunk(key, iter(table.to_batches(max_chunksize=70)[::-1]), cfg))


def test_an_inventory_reads_its_result_once(spark):
    cfg = PipelineConfig(resolution=1.0, subcircle=0.2, min_points=2, chunk_size=40.0)
    plan = pipeline.inventory(pipeline.catalog_pipeline(cloud(spark), cfg), cfg)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1


def test_only_the_products_asked_for_are_the_same(spark):
    """Every query of one raster computed heights, crowns and trees too."""
    cfg = PipelineConfig(resolution=1.0, subcircle=0.2, min_points=2, chunk_size=40.0)
    cells = lambda q, p: sorted(map(tuple, pipeline.rasters(q, p).collect()))
    whole = pipeline.catalog_pipeline(cloud(spark), cfg).persist()
    for p in ("dtm", "slope", "dsm", "chm"):
        some = pipeline.catalog_pipeline(cloud(spark), cfg, only=(p,)).persist()
        assert cells(some, p) == cells(whole, p) != [] and some.filter("product in ('trees', 'points', 'status')").count() == 0


def test_a_surface_alone_takes_the_highest_of_each_cell(spark, monkeypatch):
    """all points of a chunk, once each, were sent to its task and sorted there."""
    cfg = PipelineConfig(resolution=1.5, chunk_size=40.0, chunk_buffer=7.3)  # seams and halos cut through cells
    p = cloud(spark)
    key = ["chunk_x", "chunk_y", "col", "row", "value"]
    cells = lambda q: sorted(map(tuple, q.filter("product = 'dsm'").select(key).collect()))
    whole, twice = cells(pipeline.catalog_pipeline(p, cfg)), p.unionAll(p)
    alone = pipeline.catalog_pipeline(twice, cfg, only=("dsm",))
    assert cells(alone) == whole != []
    plan = alone._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "max(z" in plan
    monkeypatch.setattr(chunks, "process_chunk", lambda key, batches, cfg, only: chunks._part("status", key, col=[sum(b.num_rows for b in batches)]))
    got = {(r["chunk_x"], r["chunk_y"]): r["col"] for r in pipeline.catalog_pipeline(twice, cfg, only=("dsm",)).collect()}
    assert got[1, 1] <= 40 * 40 < twice.filter("xi between 4000 and 7999 and yi between 4000 and 7999").count()


@pytest.mark.parametrize("shape", ["random", "lattice"])
def test_triangles_and_their_neighbours_fit(shape):
    """Triangles are linked around each new point in the order in which their edges are found."""
    r = np.random.default_rng(2)
    x, y = r.random((2, 700)) if shape == "random" else (a.ravel() * 1.0 for a in np.meshgrid(np.arange(25), np.arange(28)))
    d = tin.Delaunay(x, y, tin._in_rounds)
    assert len(d.tri) == 2 * 700 + 1
    for t, (v, others) in enumerate(zip(d.tri.tolist(), d.near.tolist())):
        for k, o in enumerate(others):
            edge = {v[k - 2], v[k - 1]}
            assert o < 0 or edge <= set(d.tri[o].tolist()) and set(d.tri[o].tolist()) - edge == {d.tri[o].tolist()[d.near[o].tolist().index(t)]}


def test_the_highest_of_each_cell_from_any_parts():
    r = np.random.default_rng(4)
    x, y, h = r.random(3000) * 9, r.random(3000) * 9, np.round(r.random(3000) * 20)
    one, many, apart = (canopy.Tops(0.5, 0.2) for _ in range(3))
    one.add(x, y, h, np.arange(3000))
    for at in np.array_split(r.permutation(3000), 7):
        many.add(x[at], y[at], h[at], at)
        apart.add(np.append(x[at], 1e6), np.append(y[at], 1e6), np.append(h[at], 5.0), np.append(at, 3000))  # a box that isn't laid out
    assert (one.held == many.held).all() and (apart.held[apart.held["x"] < 1e5] == one.held).all()
    for (dx, dy), k in zip(zip(*one.by), range(8)):
        assert all(h[(np.floor((x + dx) / 0.5) == c) & (np.floor((y + dy) / 0.5) == w)].max(initial=0) <= z for c, w, z in one.held[["col", "row", "h"]].tolist())


def test_a_canopy_keeps_no_points(monkeypatch):
    """place and height of all points that crowns might hold were kept."""
    r = np.random.default_rng(6)
    n, cfg = 600, PipelineConfig(resolution=1.0, chunk_size=20.0, chunk_buffer=0.0)
    xi, yi, ground = r.integers(0, 2000, n), r.integers(0, 2000, n), np.arange(n) < 200
    z = np.where(ground, 0.0, r.random(n) * 20)
    columns = [np.arange(n), xi, yi, xi / 100, yi / 100, z, np.where(ground, 2, 5), np.ones(n, bool), np.where(ground, chunks.ON_LEVEL, chunks.IN_CORE)]
    batches = pa.table(dict(zip(chunks.TAKEN, columns))).to_batches()
    cells = lambda parts: [tuple(v) for p in parts for v in p.to_pandas().query("product == 'chm'")[["col", "row", "value"]].to_numpy().tolist()]
    whole = cells(chunks.process_chunk((0, 0), iter(batches), cfg))

    class Kept(np.ndarray):
        def astype(self, kind, *a, **how):
            assert kind is not np.int32, "the cells of single points are kept"
            return super().astype(kind, *a, **how)

    floor = np.floor
    monkeypatch.setattr(np, "floor", lambda v, *a: floor(v, *a).view(Kept) if isinstance(v, np.ndarray) else floor(v, *a))
    assert cells(chunks.process_chunk((0, 0), iter(batches), cfg, ("chm",))) == whole != []


def test_statuses_need_no_points_of_crowns(spark):
    """for statuses, rows of all points of crowns and hulls of all trees were made too."""
    cfg = PipelineConfig(resolution=1.0, subcircle=0.2, min_points=2, chunk_size=40.0)
    ends = lambda q: sorted(map(tuple, pipeline.statuses(q).collect()))
    clouds = [cloud(spark), cloud(spark, trees=()), cloud(spark).filter("cls <> 2"), cloud(spark).filter("cls = 2 or point_id % 50 = 0")]
    whole = [ends(pipeline.catalog_pipeline(p, cfg)) for p in clouds]
    assert {w[2] for w in sum(whole, [])} >= {"done", "gate", "normalize"}
    for p, want in zip(clouds, whole):
        some = pipeline.catalog_pipeline(p, cfg, only=("status",))
        assert ends(some) == want != [] and some.filter("product in ('trees', 'points', 'crowns')").count() == 0


def test_the_inventory_query_has_crowns_of_many_cells(spark, sf, monkeypatch):
    """On a lattice too coarse for windows and crowns each cell of the canopy would be a tree."""
    from sparktree.plans import catalogue

    run, seen = pipeline.catalog_pipeline, []
    monkeypatch.setattr(pipeline, "catalog_pipeline", lambda *a, **how: seen.append((a[1], run(*a, **how))) or seen[-1][1])
    catalogue.queries()["catalog_pipeline"](spark, sf)
    (cfg, result), *more = seen
    assert not more and canopy.window_size(np.array(cfg.hmin)) / 2 > 2 * cfg.resolution and cfg.resolution == PipelineConfig().resolution
    cells = [r["count"] for r in result.filter("product = 'crowns'").groupBy("tree_id").count().collect()]
    assert cells and np.median(cells) > 20


def test_tops_of_parts_far_apart():
    rng = np.random.default_rng(5)
    x, y, h, ids = rng.random(400) * 3, rng.random(400) * 3, rng.integers(0, 4, 400) * 1.0, rng.permutation(400)
    x[:9] += 1e6  # a box of cells far larger than their number
    want: dict = {}
    for k, a in enumerate(np.arange(8) * (math.pi / 4)):
        px, py = x + 0.2 * np.cos(a), y + 0.2 * np.sin(a)
        for i in range(400):
            cell, one = (math.floor(px[i] / 0.5), math.floor(py[i] / 0.5)), (-h[i], ids[i], k)
            want[cell] = min(want.get(cell, one), one)
    for near in (True, False):
        tops = canopy.Tops(0.5, 0.2)
        of = np.arange(9 if near else 0, 400)
        for part in np.array_split(of, 3):
            tops.add(x[part], y[part], h[part], ids[part])
        got = {(c, r): (-v, i, k) for c, r, v, i, k, *_ in tops.held.tolist()}
        assert list(got) == sorted(got) and all(got[c] == want[c] for c in got) and (near or got == want)
