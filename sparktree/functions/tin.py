"""Triangulated surfaces of one chunk in NumPy: Delaunay triangles, point location, interpolation."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def unique_places(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One point a place, the highest."""
    order = np.lexsort((-z, y, x))
    x, y, z = x[order], y[order], z[order]
    first = np.ones(len(x), bool)
    first[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    return x[first], y[first], z[first]


def _curve(x: np.ndarray, y: np.ndarray, levels: int = 8) -> np.ndarray:
    """Positions along a snake of strips: successive points are near each other."""
    n = 1 << levels // 2
    span = lambda v: (v - v.min()) / max(np.ptp(v), 1e-12)
    strip = np.minimum((span(x) * n).astype(int), n - 1)
    along = np.where(strip % 2 == 0, y, -y)
    return np.lexsort((along, strip))


def _in_rounds(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A few random points, four times as many, and so on, each round along its curve: half the walk and fewer triangles replaced."""
    turn = np.minimum(-np.log2(np.random.default_rng(len(x)).random(len(x))) // 2, 5)
    rounds = [np.flatnonzero(turn == k) for k in range(5, -1, -1)]
    return np.concatenate([i[_curve(x[i], y[i], max(2, 2 * int(np.log2(max(4, np.sqrt(len(i) / 3))))))] for i in rounds if len(i)])


def _filled(seed: np.ndarray) -> np.ndarray:
    """Empty cells (-1) get the value before them in their row, or else after them; empty rows that of a row beside them."""
    for _ in range(2):
        for _ in range(2):
            last = np.maximum.accumulate(np.where(seed >= 0, np.arange(seed.shape[1]), -1), axis=1)
            seed = np.where(last >= 0, np.take_along_axis(seed, np.maximum(last, 0), 1), -1)[:, ::-1]
        seed = seed.T
    return seed


def _edges(tri: list, near: list, px: list, py: list, ax: float, ay: float, t: int, bad: set, gone: list) -> list[tuple[int, int, int, int]]:
    """The edges, in no order, around the triangles whose circle holds (ax, ay), where these meet around a corner (by rounding); fills bad and gone."""
    bad.clear()
    bad.add(t)
    stack, edge = [t], []
    while stack:
        s = stack.pop()
        v = tri[s]
        for k in range(3):
            o = near[s][k]
            if o in bad:
                continue
            if o >= 0:
                a, b, c = tri[o]
                dx, dy, ex, ey, fx, fy = px[a] - ax, py[a] - ay, px[b] - ax, py[b] - ay, px[c] - ax, py[c] - ay
                ap, bp, cp = dx * dx + dy * dy, ex * ex + ey * ey, fx * fx + fy * fy
                if dx * (ey * cp - bp * fy) - dy * (ex * cp - bp * fx) + ap * (ex * fy - ey * fx) > 0:
                    bad.add(o)
                    stack.append(o)
                    continue
            edge.append((v[(k + 1) % 3], v[(k + 2) % 3], o, s))
    gone[:] = bad
    # an edge between two bad triangles was noted if one of them was found later
    return [(u, v, o, near[o].index(s) if o >= 0 else 0) for u, v, o, s in edge if o not in bad]


class Delaunay:
    """Triangles of distinct points, by insertion: a walk finds the triangle, and those whose circle holds the point are replaced.

    tri: vertices, counter-clockwise; near: the triangle across the edge opposite to each vertex, -1 outside.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, order: Callable[[np.ndarray, np.ndarray], np.ndarray] = _curve):
        n = len(x)
        self.x0, self.y0 = float(np.mean(x)), float(np.mean(y))
        scale = max(float(np.ptp(x)), float(np.ptp(y)), 1e-9)
        far = 1e4 * scale
        px = np.append(x - self.x0, [-3 * far, 3 * far, 0.0]).tolist()
        py = np.append(y - self.y0, [-3 * far, -3 * far, 3 * far]).tolist()
        at = list(zip(px, py))
        tri: list[tuple[int, int, int] | None] = [(n, n + 1, n + 2)]
        near: list[list[int]] = [[-1, -1, -1]]
        free: list[int] = []
        t = 0
        eps = -1e-12 * scale * scale
        for p in order(np.asarray(x), np.asarray(y)).tolist() if n else []:
            ax, ay = at[p]
            for _ in range(4 * len(tri) + 50):
                a, b, c = tri[t]
                (x0, y0), (x1, y1), (x2, y2) = at[a], at[b], at[c]
                o0, o1, o2 = near[t]
                if o0 >= 0 and (x2 - x1) * (ay - y1) - (y2 - y1) * (ax - x1) < eps:
                    t = o0
                elif o1 >= 0 and (x0 - x2) * (ay - y2) - (y0 - y2) * (ax - x2) < eps:
                    t = o1
                elif o2 >= 0 and (x1 - x0) * (ay - y0) - (y1 - y0) * (ax - x0) < eps:
                    t = o2
                else:
                    break
            a, b, c = tri[t]
            o0, o1, o2 = near[t]
            # edges around the bad triangles, counter-clockwise: an edge gives way to the two others of a bad triangle across it
            bad, gone = {t}, [t]
            stack = [(a, b, o2, t), (c, a, o1, t), (b, c, o0, t)]
            edge, ring = [], True
            while stack:
                u, v, o, s = stack.pop()
                if o >= 0:
                    if o in bad:
                        edge, ring = _edges(tri, near, px, py, ax, ay, gone[0], bad, gone), False
                        break
                    a, b, c = tri[o]
                    (dx, dy), (ex, ey), (fx, fy) = at[a], at[b], at[c]
                    dx -= ax
                    dy -= ay
                    ex -= ax
                    ey -= ay
                    fx -= ax
                    fy -= ay
                    bp, cp = ex * ex + ey * ey, fx * fx + fy * fy
                    if dx * (ey * cp - bp * fy) - dy * (ex * cp - bp * fx) + (dx * dx + dy * dy) * (ex * fy - ey * fx) > 0:
                        bad.add(o)
                        gone.append(o)
                        o0, o1, o2 = near[o]
                        if o0 == s:
                            stack += ((a, v, o2, o), (u, a, o1, o))
                        elif o1 == s:
                            stack += ((b, v, o0, o), (u, b, o2, o))
                        else:
                            stack += ((c, v, o1, o), (u, c, o0, o))
                        continue
                    edge.append((u, v, o, near[o].index(s)))
                else:
                    edge.append((u, v, o, 0))
            # new triangles take the numbers of the bad ones
            while len(gone) < len(edge):
                if free:
                    gone.append(free.pop())
                else:
                    gone.append(len(tri))
                    tri.append(None)
                    near.append([-1, -1, -1])
            for s in gone[len(edge) :]:
                tri[s] = None
                free.append(s)
            if not ring:
                starts = {e[0]: s for e, s in zip(edge, gone)}
                for (u, v, o, k), t in zip(edge, gone):
                    tri[t], near[t] = (p, u, v), [o, starts[v], -1]
                    if o >= 0:
                        near[o][k] = t
                for t in gone[: len(edge)]:
                    near[near[t][1]][2] = t
                continue
            before, t = gone[len(edge) - 1], gone[0]
            for (u, v, o, k), after in zip(edge, (*gone[1 : len(edge)], t)):
                tri[t] = (p, u, v)
                near[t] = [o, after, before]
                if o >= 0:
                    near[o][k] = t
                before, t = t, after
        keep = [t for t, v in enumerate(tri) if v is not None]
        index = np.full(len(tri) + 1, -1)
        index[keep] = np.arange(len(keep))
        self.tri = np.array([tri[t] for t in keep]).reshape(-1, 3)
        self.near = index[np.array([near[t] for t in keep]).reshape(-1, 3)]
        self.px, self.py, self.n = np.array(px), np.array(py), n
        self.real = (self.tri < n).all(1)
        self.seeds: np.ndarray | None = None

    def locate(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The triangle of each place: all walk at once, starting from the last place's neighbourhood."""
        x, y = np.asarray(x) - self.x0, np.asarray(y) - self.y0
        t = np.zeros(len(x), np.int64)
        # seeds: the triangle of a vertex near the place, by coarse cells
        if len(self.tri) > 64 and len(x):
            k = max(1, int(np.sqrt(self.n / 4)))
            cell = lambda u, v: np.clip(((u - lo[0]) / w[0] * k).astype(int), 0, k - 1) * k + np.clip(((v - lo[1]) / w[1] * k).astype(int), 0, k - 1)
            lo = self.px[: self.n].min(), self.py[: self.n].min()
            w = max(np.ptp(self.px[: self.n]), 1e-9), max(np.ptp(self.py[: self.n]), 1e-9)
            if self.seeds is None and len(real := np.flatnonzero(self.real)):
                seed = np.full(k * k, -1, np.int32)
                for corner in range(3):
                    v = self.tri[real, corner]
                    seed[cell(self.px[v], self.py[v])] = real
                self.seeds = _filled(seed.reshape(k, k)).ravel()
            if self.seeds is not None:
                t = self.seeds[cell(x, y)].astype(np.int64)
        on = np.arange(len(x))
        for _ in range(len(self.tri) + 10):
            if not len(on):
                break
            v = self.tri[t[on]]
            ux, uy = self.px[v], self.py[v]
            side = np.stack([(ux[:, (k + 2) % 3] - ux[:, (k + 1) % 3]) * (y[on] - uy[:, (k + 1) % 3]) - (uy[:, (k + 2) % 3] - uy[:, (k + 1) % 3]) * (x[on] - ux[:, (k + 1) % 3]) for k in range(3)], 1)
            side[self.near[t[on]] < 0] = 0
            worst = side.argmin(1)
            moves = side[np.arange(len(on)), worst] < -1e-9
            t[on[moves]] = self.near[t[on[moves]], worst[moves]]
            on = on[moves]
        return t

    def longest_edges(self) -> np.ndarray:
        ux, uy = self.px[self.tri], self.py[self.tri]
        return np.max([np.hypot(ux[:, k] - ux[:, k - 1], uy[:, k] - uy[:, k - 1]) for k in range(3)], axis=0)


def nearest_mean(px, py, pz, x, y, k: int = 3, power: float = 1.0, furthest: float = 50.0, tiles: int = 24) -> np.ndarray:
    """The mean of the k nearest points by inverse distance, of those within `furthest`; else NaN.

    Places are taken by tiles. If the k-th nearest point of a tile's centre is d away, no place of the tile has its k nearest
    further than d and the tile's diagonal from the centre, so only those are looked at, a bounded block of places at a time.
    """
    out, m = np.full(len(x), np.nan), min(k, len(px))
    if not m or not len(x):
        return out
    edge = max(np.ptp(x), np.ptp(y), 1e-9) / tiles
    col, row = np.floor((x - x.min()) / edge).astype(int), np.floor((y - y.min()) / edge).astype(int)
    order = np.lexsort((col, row))
    starts = np.flatnonzero(np.r_[True, (np.diff(col[order]) != 0) | (np.diff(row[order]) != 0)])
    for at in np.split(order, starts[1:]):
        qx, qy = x.min() + (col[at[0]] + 0.5) * edge, y.min() + (row[at[0]] + 0.5) * edge
        d = np.hypot(px - qx, py - qy)
        by = np.flatnonzero(d <= np.partition(d, m - 1)[m - 1] + 1.5 * edge)
        step = max(1, 4_000_000 // len(by))
        for s in range(0, len(at), step):
            i = at[s : s + step]
            d2 = (x[i][:, None] - px[by]) ** 2 + (y[i][:, None] - py[by]) ** 2
            near = np.argpartition(d2, m - 1, axis=1)[:, :m]
            dist = np.sqrt(np.take_along_axis(d2, near, 1))
            w = np.where(dist <= furthest, 1 / np.maximum(dist, 1e-9) ** power, 0)
            total = w.sum(1)
            with np.errstate(invalid="ignore"):
                out[i] = np.where(total > 0, (w * pz[by[near]]).sum(1) / total, np.nan)
    return out


def _hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Indices of the convex hull's corners; points within the polygon of the extremes in 64 directions are left out first."""
    angle = np.arange(64) * (np.pi / 32)
    far = np.array([np.argmax(x * c + y * s) for c, s in zip(np.cos(angle), np.sin(angle))])
    far = far[np.r_[True, far[1:] != far[:-1]]]
    inside = np.ones(len(x), bool)
    for a, b in zip(far, np.roll(far, -1)):
        if a != b:
            inside &= (x[b] - x[a]) * (y - y[a]) - (y[b] - y[a]) * (x - x[a]) > 0
    left = np.flatnonzero(~inside)
    left = left[np.lexsort((y[left], x[left]))]

    def half(order):
        out: list[int] = []
        for q in order:
            while len(out) > 1 and (x[out[-1]] - x[out[-2]]) * (y[q] - y[out[-2]]) - (y[out[-1]] - y[out[-2]]) * (x[q] - x[out[-2]]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.unique(half(left.tolist()) + half(left[::-1].tolist()))


def _circles(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, from each triangle's first corner, and radii of the circles around triangles (n, 3)."""
    bx, by, cx, cy = x[:, 1] - x[:, 0], y[:, 1] - y[:, 0], x[:, 2] - x[:, 0], y[:, 2] - y[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        d = 2 * (bx * cy - by * cx)
        ux, uy = (cy * (bx * bx + by * by) - by * (cx * cx + cy * cy)) / d, (bx * (cx * cx + cy * cy) - cx * (bx * bx + by * by)) / d
    return ux, uy, np.hypot(ux, uy)


class Blocks:
    """The Delaunay triangles of many points where they are asked for, a block of points at a time.

    A block is triangulated with a margin around it and the corners of the hull of all. A triangle whose circle, within the box
    of all points, doesn't leave the block and its margin is one of the whole: no other point can be in it. Outside the
    block's hull is outside that of all. For places in the other triangles (along the hull, and across gaps) the points around
    them are triangulated, and those found inside a circle are added until there are none.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, a_block: int, once: bool = False):
        self.x, self.y, self.a_block, self.once = x, y, a_block, once  # in order of x
        self.box = float(x.min()), float(x.max()), float(y.min()), float(y.max())
        self.apart = max(float(np.sqrt((self.box[1] - self.box[0]) * (self.box[3] - self.box[2]) / len(x))), 1e-9)
        self.hull = _hull(x, y)
        self.root = self._split(np.arange(len(x), dtype=np.int32), self.box)
        self.nets: dict[tuple, tuple[Delaunay, np.ndarray, np.ndarray]] = {}
        self.whole: Delaunay | None = None

    def _split(self, at: np.ndarray, box: tuple):
        """A tree of blocks, halved across their longer side, where half of the points are."""
        v = self.x if box[1] - box[0] >= box[3] - box[2] else self.y
        if len(at) <= self.a_block:
            return box
        cut = float(np.median(v[at]))
        low = v[at] < cut
        if not low.any():
            return box
        k = 0 if v is self.x else 2
        return v is self.x, cut, self._split(at[low], (*box[: k + 1], cut, *box[k + 2 :])), self._split(at[~low], (*box[:k], cut, *box[k + 1 :]))

    def _by_block(self, node, x: np.ndarray, y: np.ndarray, at: np.ndarray):
        if len(at) and len(node) == 4 and isinstance(node[0], bool):
            low = (x if node[0] else y)[at] < node[1]
            yield from self._by_block(node[2], x, y, at[low])
            yield from self._by_block(node[3], x, y, at[~low])
        elif len(at):
            yield node, at

    def _within(self, x0: float, x1: float, y0: float, y1: float) -> np.ndarray:
        i = np.arange(np.searchsorted(self.x, x0), np.searchsorted(self.x, x1, "right"))
        return i[(self.y[i] >= y0) & (self.y[i] <= y1)]

    def _net(self, box: tuple) -> tuple[Delaunay, np.ndarray, np.ndarray]:
        """A block's triangles, the points they are of, and which of them are surely triangles of the whole."""
        if box not in self.nets:
            m = 8 * self.apart
            x0, x1, y0, y1 = box[0] - m, box[1] + m, box[2] - m, box[3] + m
            use = np.union1d(self._within(x0, x1, y0, y1), self.hull)
            net = Delaunay(self.x[use], self.y[use], _in_rounds)
            tx, ty = net.px[net.tri] + net.x0, net.py[net.tri] + net.y0
            cx, cy, r = _circles(tx, ty)
            cx, cy = cx + tx[:, 0], cy + ty[:, 0]
            left, right, low, high = self.box
            sure = np.isfinite(r)
            for a, b, c, d in ((left, x0, low, high), (x1, right, low, high), (left, right, low, y0), (left, right, y1, high)):
                if a < b and c < d:  # a strip of the box beyond the margin
                    sure &= np.hypot(np.maximum(0, np.maximum(a - cx, cx - b)), np.maximum(0, np.maximum(c - cy, cy - d))) >= r
            net.tri, net.near = net.tri.astype(np.int32), net.near.astype(np.int32)
            found = net, use.astype(np.int32), sure | ~net.real
            if self.once:  # no block is asked for again
                return found
            self.nets[box] = found
        return self.nets[box]

    def triangles(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The corners of the triangle around each place; -1 outside all."""
        out = np.full((len(x), 3), -1, np.int32)
        unsure = []
        for box, at in self._by_block(self.root, x, y, np.arange(len(x))):
            if box not in self.nets and len(at) * FEW < self.a_block:
                out[at] = self._searched(x[at], y[at])  # a few places don't need all triangles of their block
                continue
            net, use, sure = self._net(box)
            t = net.locate(x[at], y[at])
            fine = sure[t] & net.real[t]
            out[at[fine]] = use[net.tri[t[fine]]]
            unsure.append(at[~sure[t]])
        left = np.concatenate(unsure) if unsure else np.empty(0, int)
        if len(left):
            out[left] = self._searched(x[left], y[left])
        return out

    def _inside(self, a: np.ndarray, ux: float, uy: float, r: float, most: int) -> np.ndarray:
        """Points within the circle around a + u: the deepest, up to `most`."""
        left, right, low, high = self.box
        cy = a[1] + uy
        beyond = max(cy - high, low - cy, 0.0)
        half = np.sqrt(max((r - beyond) * (r + beyond), 0.0)) * (1 + 1e-9) + 1e-6
        i = np.arange(np.searchsorted(self.x, a[0] + ux - half), np.searchsorted(self.x, a[0] + ux + half, "right"))
        dx, dy = self.x[i] - a[0], self.y[i] - a[1]
        power = dx * dx + dy * dy - 2 * (dx * ux + dy * uy)
        found = power < -1e-9 * (1 + r)
        i, power = i[found], power[found]
        return i if len(i) <= most else i[np.argpartition(power, most)[:most]]

    def _searched(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, most: int = 24) -> np.ndarray:
        m = 6 * self.apart
        cells = np.unique(np.stack([np.floor(x / m), np.floor(y / m)], 1), axis=0)
        use = np.unique(np.concatenate([self.hull, *(self._within(c * m - m / 2, c * m + 1.5 * m, r * m - m / 2, r * m + 1.5 * m) for c, r in cells)]))
        empty: set[tuple] = set()
        for _ in range(rounds):
            net = Delaunay(self.x[use], self.y[use])
            t = net.locate(x, y)
            more = []
            for k in np.unique(t[net.real[t]]):
                corners = use[net.tri[k]]
                if (name := tuple(sorted(corners.tolist()))) in empty:
                    continue
                ux, uy, r = (float(v[0]) for v in _circles(self.x[corners][None], self.y[corners][None]))
                found = self._inside((self.x[corners[0]], self.y[corners[0]]), ux, uy, r, most) if np.isfinite(r) else np.empty(0, int)
                if len(found := np.setdiff1d(found, use)):
                    more.append(found)
                else:
                    empty.add(name)
            if not more:
                break
            use = np.unique(np.concatenate([use, *more]))
        else:
            use = np.arange(len(self.x))
            net = self.whole = self.whole or Delaunay(self.x, self.y)
            t = net.locate(x, y)
        return np.where(net.real[t][:, None], use[np.where(net.tri[t] < len(use), net.tri[t], 0)], -1)


#: Points that are triangulated at once; more are taken by blocks of so many.
A_BLOCK = 24_000
#: Places whose heights are worked out at once.
AT_ONCE = 100_000
#: The points of a block for each place asked for, from which on only those around the places are triangulated.
FEW = 300


class Surface:
    """The triangulated surface of points, of which the highest of each place counts; it can be asked more than once, unless once is
    said: then no triangles are kept."""

    def __init__(self, px, py, pz, once: bool = False):
        self.px, self.py, self.pz = unique_places(np.asarray(px, float), np.asarray(py, float), np.asarray(pz, float))
        n, self.net, self.blocks = len(self.px), None, None
        if n > A_BLOCK and np.ptp(self.px) > 0 and np.ptp(self.py) > 0:
            self.blocks = Blocks(self.px, self.py, A_BLOCK, once)
        elif n >= 3:
            self.net = Delaunay(self.px, self.py)

    def _triangles(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if self.blocks:
            return self.blocks.triangles(x, y)
        d = self.net
        t = d.locate(x, y)
        return np.where(d.real[t][:, None], d.tri[t], -1)

    def at(self, x, y, max_edge: float = 0.0, k: int = 3, power: float = 1.0, furthest: float = 50.0, extrapolate: bool = True) -> np.ndarray:
        """Heights at (x, y): linear in the triangle around; outside all, the mean of the k nearest by inverse distance, if
        extrapolate, up to `furthest`; else NaN. With max_edge, triangles of a longer edge count as missing."""
        x, y = np.asarray(x, float), np.asarray(y, float)
        out = np.full(len(x), np.nan)
        if not len(self.px) or not len(x):
            return out
        if self.net or self.blocks:
            corners = self._triangles(x, y)
            for k0 in range(0, len(x), AT_ONCE):
                part = slice(k0, k0 + AT_ONCE)
                out[part] = self._linear(corners[part], x[part], y[part], max_edge)
        if extrapolate:
            todo = np.flatnonzero(np.isnan(out))
            out[todo] = nearest_mean(self.px, self.py, self.pz, x[todo], y[todo], k, power, furthest)
        return out

    def _linear(self, v: np.ndarray, x: np.ndarray, y: np.ndarray, max_edge: float) -> np.ndarray:
        """Heights at places in the triangles of corners v; NaN where there is none, or one of too long an edge."""
        out = np.full(len(x), np.nan)
        inside = v[:, 0] >= 0
        if max_edge:
            ux, uy = self.px[v], self.py[v]
            inside &= np.max([np.hypot(ux[:, j] - ux[:, j - 1], uy[:, j] - uy[:, j - 1]) for j in range(3)], axis=0) <= max_edge
        v = v[inside]
        x0, y0 = (self.net.x0, self.net.y0) if self.net else (self.px[0], self.py[0])
        ax, ay = self.px[v] - x0, self.py[v] - y0
        qx, qy = x[inside] - x0, y[inside] - y0
        area = (ax[:, 1] - ax[:, 0]) * (ay[:, 2] - ay[:, 0]) - (ax[:, 2] - ax[:, 0]) * (ay[:, 1] - ay[:, 0])
        with np.errstate(divide="ignore", invalid="ignore"):
            b = ((qx - ax[:, 0]) * (ay[:, 2] - ay[:, 0]) - (ax[:, 2] - ax[:, 0]) * (qy - ay[:, 0])) / area
            c = ((ax[:, 1] - ax[:, 0]) * (qy - ay[:, 0]) - (qx - ax[:, 0]) * (ay[:, 1] - ay[:, 0])) / area
            z = self.pz[v]
            out[inside] = z[:, 0] * (1 - b - c) + z[:, 1] * b + z[:, 2] * c
        return out


def interpolate(px, py, pz, x, y, **how) -> np.ndarray:
    """Heights of the points' triangulated surface at (x, y), as in Surface.at."""
    return Surface(px, py, pz, once=True).at(x, y, **how)


def hull_area(x, y) -> float:
    """Area of the convex hull, 0 below three points that aren't on a line."""
    p = sorted(set(zip(map(float, x), map(float, y))))
    if len(p) < 3:
        return 0.0

    def half(points):
        out = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    h = half(p) + half(p[::-1])
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(h, h[1:] + h[:1]))) / 2
