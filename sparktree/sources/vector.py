"""Vector layers: points in GeoPackage files, polygons in shapefiles."""

from __future__ import annotations

import os
import sqlite3
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S

TREE_COLUMNS = ("tree_id", "x", "y", "z", "npoints", "convhull_area", "dtm_z", "slope_deg", "aspect_deg")


def point_blob(x: float, y: float, srs: int) -> bytes:
    """A GeoPackage geometry: header, then WKB, little-endian."""
    return b"GP\0\1" + struct.pack("<i", srs) + struct.pack("<BIdd", 1, 1, x, y)


def point_of(blob: bytes) -> tuple[float, float]:
    order = "<" if blob[3] & 1 else ">"
    at = 8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    order = "<" if blob[at] else ">"
    kind = struct.unpack_from(f"{order}I", blob, at + 1)[0]
    if kind % 1000 != 1:
        raise ValueError("the geometry isn't a point")
    return struct.unpack_from(f"{order}dd", blob, at + 5)


def encode_layer(rows: pd.DataFrame, layer: str = "trees", srs: int = 3005) -> bytes:
    """A GeoPackage of one layer of points with columns x and y."""
    db = sqlite3.connect(":memory:")
    db.execute("PRAGMA application_id = 1196444487")
    db.execute("PRAGMA user_version = 10300")
    db.executescript(
        """CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
        CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change TEXT, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
        CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);"""
    )
    db.executemany("INSERT INTO gpkg_spatial_ref_sys VALUES (?,?,?,?,?,NULL)", [(f"EPSG:{srs}", srs, "EPSG", srs, "undefined"), ("Undefined cartesian", -1, "NONE", -1, "undefined"), ("Undefined geographic", 0, "NONE", 0, "undefined")])
    other = [c for c in rows.columns if c not in ("x", "y")]
    kinds = {c: "INTEGER" if pd.api.types.is_integer_dtype(rows[c]) else "DOUBLE" if pd.api.types.is_float_dtype(rows[c]) else "TEXT" for c in other}
    db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom POINT, ' + ", ".join(f'"{c}" {kinds[c]}' for c in other) + ")")
    box = (rows["x"].min(), rows["y"].min(), rows["x"].max(), rows["y"].max()) if len(rows) else (None,) * 4
    db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, '', strftime('%Y-%m-%dT%H:%M:%fZ','now'), ?,?,?,?, ?)", (layer, layer, *box, srs))
    db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POINT', ?, 0, 0)", (layer, srs))
    values = rows[other].astype(object).where(rows[other].notna(), None)
    db.executemany(f'INSERT INTO "{layer}" VALUES (NULL, ?' + ", ?" * len(other) + ")", ((point_blob(x, y, srs), *v) for x, y, v in zip(rows["x"], rows["y"], values.itertuples(index=False))))
    db.commit()
    out = db.serialize()
    db.close()
    return out


def write_gpkg(rows: pd.DataFrame, path: str, layer: str = "trees", srs: int = 3005) -> None:
    """A layer of points with columns x and y, replacing the file. For one layer's export; encoded_layers makes many."""
    part = path + ".part"
    with open(part, "wb") as f:
        f.write(encode_layer(rows, layer, srs))
    os.replace(part, path)


def encoded_layers(rows: DataFrame, *by: str, layer: str = "trees", srs: int = 3005) -> DataFrame:
    """name, content: a GeoPackage for each group of rows with columns x and y, named by the group; `by` isn't written."""

    def run(key, held):
        return pd.DataFrame({"name": [f"{layer}_" + "_".join(map(str, key)) + ".gpkg"], "content": [encode_layer(held.drop(columns=list(by)), layer, srs)]})

    return rows.groupBy(*by).applyInPandas(run, "name string, content binary")


def layer_points(data: bytes, layer: str | None = None) -> pd.DataFrame:
    """The points of a GeoPackage's layer, its first one if none is named."""
    db = sqlite3.connect(":memory:")
    db.deserialize(data)
    table, column = db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns" + (" WHERE table_name = ?" if layer else ""), (layer,) if layer else ()).fetchone()
    found = pd.read_sql_query(f'SELECT * FROM "{table}"', db)
    db.close()
    xy = [point_of(b) for b in found.pop(column)]
    found["x"], found["y"] = [p[0] for p in xy], [p[1] for p in xy]
    return found.drop(columns=[c for c in ("fid",) if c in found])


def read_gpkg(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All layers' rows under a path with the schema's columns; those that a file lacks are null."""
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(frames):
        for held in frames:
            for data in held["content"]:
                found = layer_points(bytes(data)).reindex(columns=names).astype(object)
                yield found.where(found.notna(), None)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gpkg").load(path).select("content").mapInPandas(run, schema)


def polygons(data: bytes) -> list[list[list[tuple[float, float]]]]:
    """Rings of each polygon of a shapefile's main file."""
    if struct.unpack_from(">i", data, 0)[0] != 9994:
        raise ValueError("no shapefile signature")
    at, out = 100, []
    while at + 8 <= len(data):
        size = struct.unpack_from(">i", data, at + 4)[0] * 2
        kind = struct.unpack_from("<i", data, at + 8)[0]
        if kind in (5, 15, 25):
            n_parts, n_points = struct.unpack_from("<2i", data, at + 44)
            parts = [*struct.unpack_from(f"<{n_parts}i", data, at + 52), n_points]
            flat = struct.unpack_from(f"<{2 * n_points}d", data, at + 52 + 4 * n_parts)
            xy = list(zip(flat[::2], flat[1::2]))
            out.append([xy[a:b] for a, b in zip(parts, parts[1:])])
        elif kind != 0:
            raise ValueError(f"shape type {kind} isn't a polygon")
        at += 8 + size
    return out


def encode_polygons(shapes: list[list[list[tuple[float, float]]]]) -> bytes:
    records, box = b"", [float("inf"), float("inf"), float("-inf"), float("-inf")]
    for k, rings in enumerate(shapes, 1):
        xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
        own = (min(xs), min(ys), max(xs), max(ys))
        box = [min(box[0], own[0]), min(box[1], own[1]), max(box[2], own[2]), max(box[3], own[3])]
        starts = [sum(len(r) for r in rings[:i]) for i in range(len(rings))]
        body = struct.pack("<i4d2i", 5, *own, len(rings), len(xs)) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for r in rings for p in r)
        records += struct.pack(">2i", k, len(body) // 2) + body
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(records)) // 2) + struct.pack("<2i8d", 1000, 5, *(box if shapes else [0.0] * 4), 0, 0, 0, 0)
    return head + records


def _area(ring: list[tuple[float, float]]) -> float:
    """Twice the signed area: negative for an outer ring, which goes clockwise."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))


def read_areas(spark: SparkSession, path: str, crs: int = 3005, to: int = 3005) -> DataFrame:
    """aoi_id, part, hole, ring: every ring of a shapefile's polygons, in the reference system `to`.

    Parts of one shape have one aoi_id; a ring that goes against the clock is a hole. An area of interest is a handful of
    rows. Known are longitude and latitude (4326, 4269), British Columbia's Albers (3005) and the web's Mercator (3857).
    """

    def run(frames):
        for held in frames:
            rows = [(k, i, _area(r) > 0, [{"x": x, "y": y} for x, y in r]) for data in held["content"] for k, s in enumerate(polygons(bytes(data))) for i, r in enumerate(s)]
            yield pd.DataFrame(rows, columns=["aoi_id", "part", "hole", "ring"])

    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "aoi_id int, part int, hole boolean, ring array<struct<x:double,y:double>>")
    return rows.withColumn("ring", F.transform("ring", lambda p: reprojected(p, crs, to)))


def reprojected(p: Column, crs: int, to: int) -> Column:
    """A point struct (x, y) of one reference system in another."""
    same = {4269: 4326}
    crs, to = same.get(crs, crs), same.get(to, to)
    known = {4326: (lambda x, y: (x, y), lambda x, y: (x, y)), 3005: (S.albers_inverse, S.albers), 3857: (S.web_mercator_inverse, S.web_mercator)}
    if crs == to:
        return p
    if crs not in known or to not in known:
        raise ValueError(f"no way from EPSG:{crs} to EPSG:{to}")
    x, y = known[to][1](*known[crs][0](p["x"], p["y"]))
    return F.struct(x.alias("x"), y.alias("y"))


def envelope(areas: DataFrame) -> tuple[float, float, float, float]:
    """xmin, ymin, xmax, ymax of all rings."""
    p = areas.select(F.explode("ring").alias("p"))
    return tuple(p.agg(F.min("p.x"), F.min("p.y"), F.max("p.x"), F.max("p.y")).first())
