from sparktree.config import PipelineConfig
from sparktree.plans import pipeline, views
from sparktree.streaming.arrivals import arriving_points, process_arrivals


def test_arriving_tiles_give_what_one_run_gives(spark, sf, tmp_path):
    cfg = PipelineConfig(resolution=10.0, chunk_buffer=0.0, min_points=2)
    p = views.points(spark, sf).select("point_id", "xi", "yi", "x", "y", "z", "cls")
    west, east = p.filter("xi < 20000"), p.filter("xi >= 20000")
    folder, trees = str(tmp_path / "in"), []
    for part in (west, east):
        part.coalesce(1).write.mode("append").parquet(folder)
        process_arrivals(arriving_points(spark, folder), str(tmp_path / "out"), str(tmp_path / "state"), cfg, lambda t: trees.append(t.count())).awaitTermination()
    assert len(trees) == 2
    once = pipeline.catalog_pipeline(p, cfg)
    for product in pipeline.PRODUCTS:
        read = pipeline.read_products(spark, str(tmp_path / "out"), product).select("col", "row", "value")
        assert sorted(map(tuple, read.collect())) == sorted(map(tuple, pipeline.rasters(once, product).collect()))
