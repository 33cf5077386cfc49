"""The tile index service: pages of features as JSON, read by a Spark data source with one partition a page.

A fetcher is any picklable function of a request (a dict of parameters) that returns the response's body, or its status and
body; none is built in, so nothing here needs a network. Another status than 200 and an error in the body are raised.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE = 2000
#: Pages by count: up to so many tasks of one page each, then more pages a task, up to the second number.
TASKS, A_TASK = 64, 100
INDEX_SCHEMA = "filename string, year int, s3Url string, maptile string, path string"


def request(where: str = "1=1", envelope: str | None = None, fields: str = "filename,year,s3Url,maptile,path", offset: int = 0, page: int = PAGE) -> dict[str, str]:
    """One page's parameters: predicate, envelope and columns are evaluated by the service."""
    out = {"where": where, "outFields": fields, "returnGeometry": "false", "f": "json", "resultOffset": str(offset), "resultRecordCount": str(page)}
    if envelope:
        out |= {"geometry": envelope, "geometryType": "esriGeometryEnvelope", "spatialRel": "esriSpatialRelIntersects", "inSR": "3857"}
    return out


def pages(fetch: Callable[[dict], str], page: int = PAGE, **how) -> Iterator[str]:
    """Bodies of successive pages, however many, until one is empty or doesn't say that more are to come."""
    for _, body in _in_turn(fetch, page, **how):
        yield body


def _in_turn(fetch: Callable[[dict], str], page: int, **how) -> Iterator[tuple[int, str]]:
    """Successive pages with their offsets. A page begins after the features of those before it: a service may give fewer than asked for."""
    offset = 0
    while True:
        body, decoded = _answered(fetch(request(offset=offset, page=page, **how)))
        if not decoded.get("features"):
            return
        yield offset, body
        if not decoded.get("exceededTransferLimit"):
            return
        offset += len(decoded["features"])


def features_of(bodies: DataFrame, schema: str = INDEX_SCHEMA, column: str = "body") -> DataFrame:
    """The attributes of all features of JSON pages."""
    page = f"features array<struct<attributes:struct<{', '.join(f.strip().replace(' ', ':', 1) for f in schema.split(','))}>>>, exceededTransferLimit boolean"
    return bodies.select(F.explode(F.from_json(column, page)["features"]).alias("f")).select("f.attributes.*")


class IndexServiceError(RuntimeError):
    """The index service answered with a status other than 200, or with an error instead of features."""


def checked(answer: str | tuple[int, str]) -> str:
    """The body of an answer, which may be a body alone or a status and a body."""
    return _answered(answer)[0]


def _answered(answer: str | tuple[int, str]) -> tuple[str, dict]:
    """The body of an answer and what it says, decoded once."""
    status, body = answer if isinstance(answer, tuple) else (200, answer)
    if status != 200:
        raise IndexServiceError(f"status {status}: {body[:200]}")
    try:
        said = json.loads(body)
    except ValueError as e:
        raise IndexServiceError(f"the answer isn't JSON: {body[:200]}") from e
    if "error" in said and "features" not in said:
        raise IndexServiceError(f"the service says: {said['error']}")
    return body, said


class FeatureIndex(DataSource):
    """Option n_features: what the service counts for the query; pages are then read in parallel, up to A_TASK successive ones
    by a task. Without it, in turn by one task."""

    fetch: Callable[[dict], str] | None = None

    @classmethod
    def name(cls) -> str:
        return "feature_index"

    def schema(self) -> str:
        return "offset bigint, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(type(self).fetch, dict(self.options))


class _Pages(InputPartition):
    def __init__(self, offsets: range | None):
        super().__init__(offsets)
        self.offsets = offsets


class _Reader(DataSourceReader):
    def __init__(self, fetch, options: dict[str, str]):
        self.fetch, self.page = fetch, int(options.get("page", PAGE))
        self.count = options.get("n_features", options.get("nfeatures"))
        self.how = {k: v for k, v in options.items() if k in ("where", "envelope", "fields")}

    def partitions(self):
        if self.count is None:
            return [_Pages(None)]
        offsets = range(0, max(1, int(self.count)), self.page)
        a_task = min(A_TASK, -(-len(offsets) // TASKS))  # few pages are a task each
        return [_Pages(offsets[k : k + a_task]) for k in range(0, len(offsets), a_task)]

    def read(self, partition):
        if partition.offsets is None:
            for offset, body in _in_turn(self.fetch, self.page, **self.how):
                yield _row(offset, body)
        else:
            for offset in partition.offsets:
                yield _row(offset, checked(self.fetch(request(offset=offset, page=self.page, **self.how))))


def _row(offset: int, body: str) -> pa.RecordBatch:
    """A batch of its own for each page: rows would be gathered by the ten thousand, and a page may have a megabyte."""
    return pa.RecordBatch.from_arrays([pa.array([offset], pa.int64()), pa.array([body], pa.string())], names=["offset", "body"])


def read_index(spark: SparkSession, fetch: Callable[[dict], str], schema: str = INDEX_SCHEMA, **options) -> DataFrame:
    source = type("FeatureIndex", (FeatureIndex,), {"fetch": staticmethod(fetch)})
    spark.dataSource.register(source)
    return features_of(spark.read.format("feature_index").options(**options).load(), schema)
