"""Single-band GeoTIFF of 32- or 64-bit floats: tiled, with LZW or Deflate, as classic TIFF or, where it must, BigTIFF."""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Codes of the TIFF specification.
NONE, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
NODATA = -9999.0
CELLS = "path string, col bigint, row bigint, value double"
EXTENTS = "path string, n_cols bigint, n_rows bigint, xmin double, ymax double, res double, crs int, n_values bigint"
SIZES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "Q", 11: "f", 12: "d", 16: "Q"}


def lzw_encode(data: bytes) -> bytes:
    table = {bytes((k,)): k for k in range(256)}
    out, held, bits, width, word = bytearray(), 0, 0, 9, b""

    def put(code: int) -> None:
        nonlocal held, bits
        held = held << width | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 0xFF)
        held &= (1 << bits) - 1

    put(256)
    n = 258
    for b in data:
        longer = word + bytes((b,))
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = n
        n += 1
        if n == 4095:
            put(256)
            table = {bytes((k,)): k for k in range(256)}
            n, width = 258, 9
        elif n in (512, 1024, 2048):
            width += 1
        word = bytes((b,))
    if word:
        put(table[word])
        n += 1
        if n in (512, 1024, 2048):
            width += 1
    put(257)
    if bits:
        out.append(held << 8 - bits & 0xFF)
    return bytes(out)


def lzw_decode(data: bytes) -> bytes:
    out, table, held, bits, width, before = bytearray(), [], 0, 0, 9, None
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        while bits >= width:
            bits -= width
            code = held >> bits & (1 << width) - 1
            held &= (1 << bits) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                table, width, before = [bytes((k,)) for k in range(256)] + [b"", b""], 9, None
                continue
            word = table[code] if code < len(table) else before + before[:1]
            out += word
            if before is not None:
                table.append(before + word[:1])
                if len(table) + 1 in (512, 1024, 2048):
                    width += 1
            before = word
    return bytes(out)


def encode(values: np.ndarray, x0: float, y1: float, res: float, crs: int = 3005, compression: int = LZW, tile: int = 256, big: bool | None = None) -> bytes:
    """values: rows from north to south, NaN for no value; (x0, y1) is the north-western corner."""
    rows, cols = values.shape
    data = np.where(np.isnan(values), NODATA, values).astype("<f4")
    pack = {NONE: bytes, LZW: lzw_encode, DEFLATE: zlib.compress}[compression]
    tiles = []
    for r in range(0, rows, tile):
        for c in range(0, cols, tile):
            block = np.full((tile, tile), NODATA, "<f4")
            part = data[r : r + tile, c : c + tile]
            block[: part.shape[0], : part.shape[1]] = part
            tiles.append(pack(block.tobytes()))
    size = sum(map(len, tiles))
    big = size > 4_000_000_000 if big is None else big
    keys = (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, crs)
    entries = [
        (256, 4, (cols,)), (257, 4, (rows,)), (258, 3, (32,)), (259, 3, (compression,)), (262, 3, (1,)), (277, 3, (1,)), (322, 4, (tile,)), (323, 4, (tile,)),
        (324, 16 if big else 4, None), (325, 4, tuple(map(len, tiles))), (339, 3, (3,)), (33550, 12, (res, res, 0.0)), (33922, 12, (0.0, 0.0, 0.0, x0, y1, 0.0)), (34735, 3, keys), (42113, 2, f"{NODATA:g}\0".encode()),
    ]
    start, slot = (16, 8) if big else (8, 4)
    at, offsets = start, []
    for t in tiles:
        offsets.append(at)
        at += len(t)
    at += at % 2
    entries[8] = (324, entries[8][1], tuple(offsets))
    head, extra = bytearray(), bytearray()
    directory = (8 + 20 * len(entries) + 8) if big else (2 + 12 * len(entries) + 4)
    for tag, kind, v in entries:
        raw = v if kind == 2 else struct.pack(f"<{len(v)}{SIZES[kind]}", *v)
        place = raw.ljust(slot, b"\0")
        if len(raw) > slot:
            place = struct.pack("<Q" if big else "<I", at + directory + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        head += struct.pack("<HHQ" if big else "<HHI", tag, kind, len(v)) + place
    first = struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHI", b"II", 42, at)
    body = first + b"".join(tiles)
    body += b"\0" * (at - len(body))
    return body + (struct.pack("<Q", len(entries)) if big else struct.pack("<H", len(entries))) + bytes(head) + b"\0" * (8 if big else 4) + bytes(extra)


def decode(data: bytes) -> tuple[np.ndarray, float, float, float, int]:
    """values (rows from north to south), x0, y1, cell size and the reference system's code, 0 if it isn't told."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    version = struct.unpack_from(f"{order}H", data, 2)[0] if order else 0
    if version not in (42, 43):
        raise ValueError("no TIFF signature")
    big = version == 43
    at = struct.unpack_from(f"{order}Q", data, 8)[0] if big else struct.unpack_from(f"{order}I", data, 4)[0]
    n = struct.unpack_from(f"{order}Q" if big else f"{order}H", data, at)[0]
    tags = {}
    for k in range(n):
        p = at + (8 + 20 * k if big else 2 + 12 * k)
        tag, kind, count = struct.unpack_from(f"{order}HHQ" if big else f"{order}HHI", data, p)
        if kind not in SIZES:
            continue
        length, slot = count * struct.calcsize(SIZES[kind].replace("s", "B")), 8 if big else 4
        q = p + (12 if big else 8)
        if length > slot:
            q = struct.unpack_from(f"{order}Q" if big else f"{order}I", data, q)[0]
        tags[tag] = data[q : q + count] if kind == 2 else struct.unpack_from(f"{order}{count}{SIZES[kind]}", data, q)
    cols, rows, bits, how = tags[256][0], tags[257][0], tags[258][0], tags.get(259, (NONE,))[0]
    kind = f"{order}f{bits // 8}" if tags.get(339, (1,))[0] == 3 else f"{order}{'i' if tags.get(339, (1,))[0] == 2 else 'u'}{bits // 8}"
    unpack = {NONE: bytes, LZW: lzw_decode, DEFLATE: zlib.decompress, OLD_DEFLATE: zlib.decompress}.get(how)
    if unpack is None:
        raise ValueError(f"compression {how} can't be read")
    tiled = 324 in tags
    width, height = (tags[322][0], tags[323][0]) if tiled else (cols, tags.get(278, (rows,))[0])
    offsets, sizes = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    out = np.full((rows, cols), np.nan)
    across = math.ceil(cols / width)
    for k, (o, s) in enumerate(zip(offsets, sizes)):
        r, c = k // across * height, k % across * width
        block = np.frombuffer(unpack(data[o : o + s]), kind)
        block = block[: len(block) // width * width].reshape(-1, width).astype(float)
        if tags.get(317, (1,))[0] == 2:
            block = np.cumsum(block, axis=1)
        part = block[: max(0, rows - r), : cols - c]
        out[r : r + len(part), c : c + part.shape[1]] = part[: rows - r]
    if 42113 in tags:
        out[out == np.float64(np.array(float(tags[42113].split(b"\0")[0]), kind))] = np.nan
    res = tags[33550][0] if 33550 in tags else 1.0
    tie = tags.get(33922, (0, 0, 0, 0.0, 0.0, 0))
    keys = tags.get(34735, ())
    crs = next((keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k] in (3072, 2048)), 0)
    return out, tie[3] - tie[0] * res, tie[4] + tie[1] * res, res, crs


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """path, col, row, value of the cells that have one, on the lattice anchored at (0, 0)."""

    def run(frames):
        for held in frames:
            for file, data in zip(held["path"], held["content"]):
                values, x0, y1, res, _ = decode(bytes(data))
                r, c = np.nonzero(~np.isnan(values))
                yield pd.DataFrame({"path": file, "col": np.round(x0 / res).astype(np.int64) + c, "row": np.round(y1 / res).astype(np.int64) - 1 - r, "value": values[r, c]})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load(path).select("path", "content").mapInPandas(run, CELLS)


def read_extents(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: its size in cells, north-western corner, cell size, reference system and the number of values."""

    def run(frames):
        for held in frames:
            rows = []
            for file, data in zip(held["path"], held["content"]):
                values, x0, y1, res, crs = decode(bytes(data))
                rows.append((file, values.shape[1], values.shape[0], x0, y1, res, crs, int((~np.isnan(values)).sum())))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in EXTENTS.split(", ")])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load(path).select("path", "content").mapInPandas(run, EXTENTS)


def encoded_tiles(cells: DataFrame, res: float, crs: int = 3005, compression: int = LZW) -> DataFrame:
    """name, content: a file for each product and chunk of cells(product, chunk_x, chunk_y, col, row, value), named by its corner."""

    def run(key, held):
        c0, r1 = held["col"].min(), held["row"].max()
        grid = np.full((r1 - held["row"].min() + 1, held["col"].max() - c0 + 1), np.nan)
        grid[r1 - held["row"], held["col"] - c0] = held["value"]
        name = f"{key[0].upper()}_{round(c0 * res)}_{round(held['row'].min() * res)}.tif"
        return pd.DataFrame({"name": [name], "content": [encode(grid, c0 * res, (r1 + 1) * res, res, crs, compression)]})

    return cells.select("product", "chunk_x", "chunk_y", "col", "row", "value").groupBy("product", "chunk_x", "chunk_y").applyInPandas(run, "name string, content binary")


def named(product: str, xmin: float, ymin: float) -> str:
    return f"{product}_{round(xmin)}_{round(ymin)}.tif"


__all__ = ["decode", "encode", "encoded_tiles", "lzw_decode", "lzw_encode", "named", "read_cells", "read_extents"]
