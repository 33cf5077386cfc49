"""Work on one chunk's canopy raster in NumPy: pit-free height models, local maxima, crowns."""

from __future__ import annotations

import math

import numpy as np

from .grid import circle_offsets
from .scalar import WINDOW_ABOVE, WINDOW_BELOW, WINDOW_GAIN, WINDOW_LEAST, WINDOW_RATE
from .tin import interpolate


def window_size(h: np.ndarray, hmin: float = 2.0, hmax: float = 30.0) -> np.ndarray:
    return np.where(h < hmin, WINDOW_BELOW, np.where(h > hmax, WINDOW_ABOVE, WINDOW_GAIN * (1 - np.exp(-WINDOW_RATE * (h - hmin))) + WINDOW_LEAST))


def pit_free(x, y, h, cell_x, cell_y, res: float, hmax: float = 30.0, levels=(0.0, 0.5, 1.0), subcircle: float = 0.2, max_edge=(0.0, 1.0)) -> np.ndarray:
    """The greatest, over thresholds, of the surfaces of the returns above each threshold.

    A return stands for eight on a circle around it; the highest of each cell are triangulated. Above the lowest
    threshold, triangles with a longer edge than max_edge[1] span gaps and are left out. NaN where there is no surface.
    """
    tops = Tops(res, subcircle)
    tops.add(x, y, h, np.arange(len(np.asarray(h))))
    return tops.pit_free(cell_x, cell_y, hmax, levels, max_edge)


class Tops:
    """The highest return of each cell, from any number of parts of a cloud; of equal ones the first by id, then around the circle.

    The highest above a threshold is the highest of all, if that is above it, so one table serves all thresholds.
    """

    def __init__(self, res: float, subcircle: float):
        angle = np.arange(8) * (math.pi / 4)
        self.res, self.by = res, (subcircle * np.cos(angle), subcircle * np.sin(angle)) if subcircle else ([0.0], [0.0])
        self.held = np.empty(0, TOP)

    def add(self, x, y, h, ids) -> None:
        x, y, h = (np.asarray(v, float) for v in (x, y, h))
        if not len(h):
            return
        ids = np.asarray(ids)
        cells = lambda dx, dy: (np.floor((x + dx) / self.res).astype(np.int64), np.floor((y + dy) / self.res).astype(np.int64))
        number, n = self._numbered(x, y, cells)
        most, held = np.full(n, -np.inf), number(self.held["col"], self.held["row"])
        most[held] = self.held["h"]
        for dx, dy in zip(*self.by):
            np.fmax.at(most, number(*cells(dx, dy)), h)
        new = []  # those as high as the highest of their cell, mostly one a cell
        for k, (dx, dy) in enumerate(zip(*self.by)):
            col, row = cells(dx, dy)
            at = np.flatnonzero(h >= most[number(col, row)])
            part = np.empty(len(at), TOP)
            part["col"], part["row"], part["h"], part["id"], part["k"], part["x"], part["y"] = col[at], row[at], h[at], ids[at], k, x[at] + dx, y[at] + dy
            new.append(part)
        part = np.concatenate(new)
        del new, most
        met = np.zeros(n, bool)
        met[number(part["col"], part["row"])] = True
        met = met[held]
        both = np.concatenate([self.held[met], part])
        del part
        both = both[np.lexsort((both["k"], both["id"], -both["h"], both["row"], both["col"]))]
        both = np.concatenate([self.held[~met], both[_firsts(both["col"], both["row"])]])
        self.held = both[np.argsort(number(both["col"], both["row"]), kind="stable")]

    def _numbered(self, x, y, cells):
        """A number, in order of column and row, for each cell held or in cells, and how many there are: all of their box, or those with something where that is far larger."""
        ends = [cells_of(v, d, self.res) for v, d in ((x, self.by[0]), (y, self.by[1]))]
        (c0, c1), (r0, r1) = ((min(e[0], int(self.held[f].min())), max(e[1], int(self.held[f].max()))) if len(self.held) else e for e, f in zip(ends, ("col", "row")))
        side = r1 - r0 + 1
        if (c1 - c0 + 1) * side <= 4 * (len(x) + len(self.held)) + 1_000_000:
            return lambda col, row: (col - c0) * side + (row - r0), (c1 - c0 + 1) * side
        pairs = np.unique(np.concatenate([_pairs(self.held["col"], self.held["row"]), *(_pairs(*cells(dx, dy)) for dx, dy in zip(*self.by))]))
        return lambda col, row: np.searchsorted(pairs, _pairs(col, row)), len(pairs)

    def pit_free(self, cell_x, cell_y, hmax: float, levels=(0.0, 0.5, 1.0), max_edge=(0.0, 1.0)) -> np.ndarray:
        out = np.full(len(cell_x), np.nan)
        for share in levels:
            use = self.held["h"] >= share * hmax
            if not use.any():
                continue
            x, y, h = (self.held[c][use] for c in ("x", "y", "h"))
            edge = max_edge[0] if share == 0 else max(max_edge[1], 2.9 * self.res)  # a triangle must be able to join neighbouring cells
            out = np.fmax(out, interpolate(x, y, h, cell_x, cell_y, max_edge=edge, extrapolate=False))
        return out


TOP = np.dtype([("col", "i8"), ("row", "i8"), ("h", "f8"), ("id", "i8"), ("k", "i8"), ("x", "f8"), ("y", "f8")])


def cells_of(v: np.ndarray, by, res: float) -> tuple[int, int]:
    """The first and the last cell of coordinates moved by some distances."""
    return int(np.floor((v.min() + min(by)) / res)), int(np.floor((v.max() + max(by)) / res))


def _pairs(col: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A whole number for each column and row, in their order."""
    return (col << 32) + row


def _firsts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a pair of values begins, in arrays in order."""
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return first


def local_maxima(chm: np.ndarray, res: float, hmin: float = 2.0, hmax: float = 30.0, least: float = 2.0, widest: float = 5.4) -> list[tuple[int, int]]:
    """(row, col) of cells of at least `least` with no higher one within half their window; of equal ones the first by (row, col)."""
    v = np.where(np.isnan(chm), -np.inf, chm)
    return highest_within(v, window_size(v, hmin, hmax) / 2, res, least, widest)


def highest_within(v: np.ndarray, reach: np.ndarray, res: float, least: float, widest: float) -> list[tuple[int, int]]:
    """(row, col) of the cells of at least `least` that are the highest, or the first of these, within their own reach."""
    r = int(widest / 2 / res + 1e-9)
    padded = np.pad(v, r, constant_values=-np.inf)
    rows, cols = np.nonzero(v >= least)
    h, reach = v[rows, cols], reach[rows, cols]
    # nearest first: after a few of them hardly a cell is left
    for dc, dr in sorted(circle_offsets(widest / 2, res), key=lambda o: math.hypot(*o)):
        if dc or dr:
            other = padded[rows + (r + dr), cols + (r + dc)]
            beats = (other > h) | ((other == h) & ((dr < 0) | ((dr == 0) & (dc < 0))))
            left = ~(beats & (math.hypot(dc, dr) * res <= reach))
            if not left.all():
                rows, cols, h, reach = rows[left], cols[left], h[left], reach[left]
    return list(zip(rows.tolist(), cols.tolist()))


def grow_crowns(chm: np.ndarray, tops: list[tuple[int, int]], th_tree: float = 2.0, th_seed: float = 0.45, th_cr: float = 0.55, max_cr: int = 10) -> np.ndarray:
    """Number of the crown (from 1, in order of tops) of each cell, 0 for none: region growing over 4 neighbours, in sweeps.

    A free neighbour of a crown cell joins if it is above th_tree, above th_seed of the seed's height and th_cr of the
    crown's mean height, at most 5 % above the seed, and less than max_cr rows and columns from it. Means are those at
    the sweep's start; if two crowns want a cell the first takes it.
    """
    v = np.where(np.isnan(chm), -np.inf, chm)
    crown = np.zeros(v.shape, np.int64)
    n = len(tops)
    if not n:
        return crown
    seed_row, seed_col = np.array([t[0] for t in tops]), np.array([t[1] for t in tops])
    height = v[seed_row, seed_col]
    crown[seed_row, seed_col] = np.arange(1, n + 1)
    total, count = height.copy(), np.ones(n)
    fresh = np.stack([seed_row, seed_col], 1)
    while len(fresh):
        mean = total / count
        want: dict[tuple[int, int], int] = {}
        at = np.concatenate([fresh + d for d in ((-1, 0), (1, 0), (0, -1), (0, 1))])
        owner = np.tile(crown[fresh[:, 0], fresh[:, 1]] - 1, 4)
        within = (at[:, 0] >= 0) & (at[:, 0] < v.shape[0]) & (at[:, 1] >= 0) & (at[:, 1] < v.shape[1])
        at, owner = at[within], owner[within]
        h = v[at[:, 0], at[:, 1]]
        joins = (crown[at[:, 0], at[:, 1]] == 0) & (h > th_tree) & (h > height[owner] * th_seed) & (h > mean[owner] * th_cr) & (h <= height[owner] * 1.05)
        joins &= (np.abs(at[:, 0] - seed_row[owner]) < max_cr) & (np.abs(at[:, 1] - seed_col[owner]) < max_cr)
        for (r, c), o in zip(at[joins].tolist(), owner[joins].tolist()):
            if o < want.get((r, c), n):
                want[r, c] = o
        if not want:
            # cells refused by a mean of an earlier sweep are tried again only while crowns change
            break
        fresh = np.array(list(want))
        owner = np.array(list(want.values()))
        crown[fresh[:, 0], fresh[:, 1]] = owner + 1
        np.add.at(total, owner, v[fresh[:, 0], fresh[:, 1]])
        np.add.at(count, owner, 1)
        # every crown cell looks at its free neighbours again: means have moved
        fresh = np.argwhere(crown > 0)
    return crown
