"""Tiles that arrive: a file stream of points, each batch's chunks processed once and written by product and chunk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import PipelineConfig
from ..plans import pipeline

POINT_SCHEMA = "point_id bigint, xi bigint, yi bigint, x double, y double, z double, cls int"


def arriving_points(spark: SparkSession, folder: str, files_per_batch: int = 8) -> DataFrame:
    return spark.readStream.schema(POINT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def process_arrivals(points: DataFrame, out: str, checkpoint: str, cfg: PipelineConfig | None = None, then: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Runs the catalogue pipeline on each batch's chunks. A batch that is replayed overwrites its own chunks, so results
    are the same as if it had run once. Files must hold whole chunks: what is beyond their edge isn't known to them.
    """
    cfg = cfg or PipelineConfig()

    def batch(rows: DataFrame, _: int) -> None:
        result = pipeline.catalog_pipeline(rows, cfg).persist()
        try:
            pipeline.write_products(result, out)
            if then:
                then(pipeline.inventory(result, cfg))
        finally:
            result.unpersist()

    return points.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
