"""Point clouds in LAS 1.0 to 1.4, point formats 0 to 10: headers as a catalogue, points as rows, and a writer.

Files are listed by Spark; tasks read headers and ranges of records, so a file is read by as many tasks as it has parts, and
none is held whole. Compressed files (LAZ) need a codec that isn't there: their header is read, so that the catalogue tells
which they are; their points are left out or raise an error.
"""

from __future__ import annotations

import struct
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import read_range

#: Bytes of the longest header.
HEAD = 375
#: Bytes of a record of each point format.
RECORD = (20, 28, 26, 34, 57, 63, 30, 36, 38, 59, 67)
CATALOG = "path string, point_format int, compressed boolean, n_points bigint, xmin double, ymin double, zmin double, xmax double, ymax double, zmax double"
POINTS = "point_id bigint, xi bigint, yi bigint, x double, y double, z double, cls int, return_number int, number_of_returns int, intensity int, gps_time double, file string"


class LasError(ValueError):
    """A file that isn't LAS, or is LAS of a kind that can't be read."""


def header(data: bytes) -> dict:
    if data[:4] != b"LASF":
        raise LasError("no LAS signature")
    minor = data[25]
    head, offset = struct.unpack_from("<HI", data, 94)
    fmt, record = struct.unpack_from("<BH", data, 104)
    n = struct.unpack_from("<I", data, 107)[0]
    if minor >= 4 and head >= 375:
        n = struct.unpack_from("<Q", data, 247)[0] or n
    sx, sy, sz, ox, oy, oz, xmax, xmin, ymax, ymin, zmax, zmin = struct.unpack_from("<12d", data, 131)
    return dict(minor=minor, offset=offset, format=fmt & 0x3F, compressed=bool(fmt & 0xC0), record=record, n=n, scale=(sx, sy, sz), shift=(ox, oy, oz), box=(xmin, ymin, zmin, xmax, ymax, zmax))


def readable(h: dict) -> dict:
    """The header, if the records behind it can be read."""
    if h["compressed"]:
        raise LasError("the file is compressed (LAZ); convert it to LAS or Parquet first")
    if h["format"] >= len(RECORD) or h["record"] < RECORD[h["format"]]:
        raise LasError(f"unknown point format {h['format']}")
    return h


def points(data: bytes) -> pd.DataFrame:
    """All points of a file."""
    h = readable(header(data))
    return records(data[h["offset"] : h["offset"] + h["n"] * h["record"]], h, 0, h["n"])


def records(data: bytes, h: dict, first: int, n: int) -> pd.DataFrame:
    """Points `first` to `first + n` of a file with the header h, from the bytes of these records alone."""
    if len(data) < n * h["record"]:
        raise LasError(f"the file ends before point {first + n}")
    raw = np.frombuffer(data, np.uint8, n * h["record"]).reshape(n, h["record"])
    part = lambda at, kind: np.ascontiguousarray(raw[:, at : at + np.dtype(kind).itemsize]).view(kind)[:, 0]
    new = h["format"] >= 6
    scaled = [part(4 * k, "<i4").astype(np.int64) for k in range(3)]
    x, y, z = (v * s + o for v, s, o in zip(scaled, h["scale"], h["shift"]))
    time_at = 22 if new else 20 if h["format"] in (1, 3, 4, 5) else None
    flags = raw[:, 14]
    return pd.DataFrame(
        {
            "point_id": np.arange(first, first + n), "xi": np.round(x * 100).astype(np.int64), "yi": np.round(y * 100).astype(np.int64), "x": x, "y": y, "z": z,
            "cls": raw[:, 16].astype(np.int32) if new else (raw[:, 15] & 0x1F).astype(np.int32),
            "return_number": (flags & (0x0F if new else 0x07)).astype(np.int32), "number_of_returns": (flags >> 4 if new else flags >> 3 & 0x07).astype(np.int32),
            "intensity": part(12, "<u2").astype(np.int32), "gps_time": part(time_at, "<f8") if time_at else np.full(n, np.nan),
        }
    )


def encode(cloud: pd.DataFrame, scale: float = 0.001) -> bytes:
    """A LAS 1.2 file of point format 1."""
    n = len(cloud)
    xyz = [cloud[c].to_numpy(float) for c in "xyz"]
    shift = [float(np.floor(v.min())) if n else 0.0 for v in xyz]
    out = np.zeros((n, 28), np.uint8)

    def put(at: int, v, kind: str) -> None:
        out[:, at : at + np.dtype(kind).itemsize] = np.ascontiguousarray(v, kind).view(np.uint8).reshape(n, np.dtype(kind).itemsize)

    for k, (v, o) in enumerate(zip(xyz, shift)):
        put(4 * k, np.round((v - o) / scale).astype("<i4"), "<i4")
    of = lambda c, d: cloud[c].fillna(d).to_numpy() if c in cloud else np.full(n, d)
    put(12, of("intensity", 0).astype("<u2"), "<u2")
    out[:, 14] = (of("return_number", 1).astype(int) & 7) | (of("number_of_returns", 1).astype(int) & 7) << 3
    out[:, 15] = of("cls", 0).astype(int) & 0x1F
    put(20, of("gps_time", 0.0).astype("<f8"), "<f8")
    box = [f(v) if n else 0.0 for v in xyz for f in (np.max, np.min)]
    head = bytearray(227)
    head[:4] = b"LASF"
    head[24:26] = bytes((1, 2))
    struct.pack_into("<HIIBHI5I", head, 94, 227, 227, 0, 1, 28, n, n, 0, 0, 0, 0)
    struct.pack_into("<12d", head, 131, scale, scale, scale, *shift, *box)
    return bytes(head) + out.tobytes()


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


def existing_folders(spark: SparkSession, *folders: str) -> list[str]:
    """The folders that are there, in any store that Spark reads; a warning says how many aren't, an error that none is."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = [f for f in folders if (p := path(f)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)]
    if not found:
        raise LasError(f"none of the {len(folders)} folders is there")
    if len(found) < len(folders):
        warnings.warn(f"{len(folders) - len(found)} folders not found, using {len(found)} of {len(folders)}", stacklevel=2)
    return found


def list_clouds(spark: SparkSession, *folders: str) -> DataFrame:
    """file, name of all .las and .laz files of those of the folders that exist."""
    found = None
    for folder in existing_folders(spark, *folders):
        part = _files(spark, folder, "*.la[sz]").select(F.col("path").alias("file"))
        found = part if found is None else found.unionByName(part)
    return found.withColumn("name", F.element_at(F.split("file", "/"), -1))


def read_catalog(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """One row a file, from its header; no more than that is read of a file, unless whole (see read_points) is set."""

    def run(frames):
        for held in frames:
            rows = []
            for file, head in zip(held["path"], held["head"]):
                h = header(bytes(head) if whole else read_range(file, 0, HEAD))
                rows.append((file, h["format"], h["compressed"], h["n"], *h["box"]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CATALOG.split(", ")])

    head = F.substring("content", 1, HEAD) if whole else F.lit(None).cast("binary")
    return _files(spark, path, "*.la[sz]").select("path", head.alias("head")).mapInPandas(run, CATALOG)


def read_points(spark: SparkSession, path: str, compressed: str = "error", a_task: int = 1_000_000, whole: bool = False) -> DataFrame:
    """All points under a path. A point's id is its file's number, by name, times 2**40 and its place in the file.

    compressed: "error", or "skip" to leave compressed files out; read_catalog says which those are. a_task: the most points
    of one range. Headers are read once to count the ranges, which are then dealt to as many tasks, 100,000 at most. The
    files' names are listed on the driver, as Spark's own listing does. whole: for stores that only Spark can open; each file
    then goes to one task, of up to 2 GB.
    """
    files = _files(spark, path, "*.la[sz]").select("path")
    number = {r[0]: k for k, r in enumerate(sorted(files.collect()))}

    def ranges(frames):
        for held in frames:
            rows = []
            for file in held["path"]:
                head = read_range(file, 0, HEAD)
                h = header(head)
                if h["compressed"] and compressed == "skip":
                    continue
                readable(h)
                rows += [(file, head, k, min(a_task, h["n"] - k)) for k in range(0, h["n"], a_task)]
            yield pd.DataFrame(rows, columns=["file", "head", "first", "n"])

    def run(frames):
        for held in frames:
            for file, head, first, n in zip(held["file"], held["head"], held["first"], held["n"]):
                h = header(bytes(head))
                found = records(read_range(file, h["offset"] + first * h["record"], n * h["record"]), h, first, n).assign(file=file)
                found["point_id"] += number[file] << 40
                yield found

    def at_once(frames):
        for held in frames:
            for file, data in zip(held["path"], held["content"]):
                data = bytes(data)
                if header(data)["compressed"] and compressed == "skip":
                    continue
                found = points(data).assign(file=file)
                found["point_id"] += number[file] << 40
                yield found

    if whole:
        return _files(spark, path, "*.la[sz]").select("path", "content").mapInPandas(at_once, POINTS)
    parts = files.mapInPandas(ranges, "file string, head binary, first bigint, n bigint")
    return parts.repartition(max(1, min(parts.count(), 100_000))).mapInPandas(run, POINTS)


def encoded_clouds(cloud: DataFrame, *by: str, scale: float = 0.001) -> DataFrame:
    """name, content: a file for each group of points, such as a chunk's, named by the group; one group is held by one task."""

    def run(key, held):
        return pd.DataFrame({"name": ["cloud_" + "_".join(map(str, key)) + ".las"], "content": [encode(held, scale)]})

    return cloud.groupBy(*by).applyInPandas(run, "name string, content binary")
