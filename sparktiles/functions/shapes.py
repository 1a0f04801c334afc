"""Clipping, simplification and quantisation of a batch of shapes, as numpy passes over all their vertices at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .ragged import offsets_of, spans

POINT, LINE, POLYGON = 1, 2, 3
EXTENT = 4096


@dataclass
class Shapes:
    """Rings (or lines, or points) of many pieces. Rings of a piece are adjacent; closed rings do not repeat their start."""

    xy: np.ndarray  # vertices, (n, 2) float64, world units
    off: np.ndarray  # ring -> vertex offsets
    piece: np.ndarray  # ring -> piece
    kind: np.ndarray  # ring -> POINT, LINE or POLYGON
    poly: np.ndarray  # ring -> polygon number inside its piece
    hole: np.ndarray  # ring -> is a hole

    def __len__(self) -> int:
        return len(self.piece)

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.off)

    def rings(self, rows: np.ndarray, piece: np.ndarray | None = None) -> Shapes:
        n = self.sizes[rows]
        xy = self.xy[spans(self.off[:-1][rows], n)]
        own = self.piece[rows] if piece is None else piece
        return Shapes(xy, offsets_of(n), own, self.kind[rows], self.poly[rows], self.hole[rows])

    def shifted(self, dx: float) -> Shapes:
        return Shapes(self.xy + np.array([dx, 0.0]), self.off, self.piece, self.kind, self.poly, self.hole)

    def ring_min(self, axis: int) -> np.ndarray:
        return np.minimum.reduceat(self.xy[:, axis], self.off[:-1])

    def ring_max(self, axis: int) -> np.ndarray:
        return np.maximum.reduceat(self.xy[:, axis], self.off[:-1])


def concat(parts: list[Shapes]) -> Shapes:
    if len(parts) == 1:
        return parts[0]
    return Shapes(
        np.concatenate([p.xy for p in parts]),
        offsets_of(np.concatenate([p.sizes for p in parts])),
        *(np.concatenate([getattr(p, f) for p in parts]) for f in ("piece", "kind", "poly", "hole")),
    )


def _prune(s: Shapes) -> Shapes:
    """Rings need three vertices, lines two, points one."""
    ok = s.sizes >= s.kind
    return s if ok.all() else s.rings(np.flatnonzero(ok))


def _half_plane(s: Shapes, axis: int, bound: np.ndarray, sign: int) -> Shapes:
    """Keep the side where sign * (v - bound) >= 0; `bound` is per ring. Points need > 0 on the upper side."""
    if not len(s):
        return s
    low, high = s.ring_min(axis), s.ring_max(axis)
    near, far = (low, high) if sign > 0 else (high, low)
    whole = sign * (near - bound) >= 0
    gone = sign * (far - bound) < 0
    if sign < 0:
        edge = (s.kind == POINT) & (near == bound)
        whole, gone = whole & ~edge, gone | edge
    if whole.all():
        return s
    cut = np.flatnonzero(~whole & ~gone)
    keep = np.flatnonzero(whole)
    if not len(cut):
        return s.rings(keep)
    clipped, source = _cut(s.rings(cut), axis, bound[cut], sign)
    both = concat([s.rings(keep), clipped])
    order = np.argsort(np.concatenate([keep, cut[source]]), kind="stable")
    return both.rings(order)


def _cut(s: Shapes, axis: int, bound: np.ndarray, sign: int) -> tuple[Shapes, np.ndarray]:
    """One pass of Sutherland-Hodgman over every ring; the same pass cuts lines, which may fall into several."""
    ring = np.repeat(np.arange(len(s)), s.sizes)
    first = np.zeros(len(s.xy), bool)
    first[s.off[:-1]] = True
    prev = np.arange(len(s.xy)) - 1
    prev[s.off[:-1]] = s.off[1:] - 1
    d = sign * (s.xy[:, axis] - bound[ring])
    inside = d >= 0
    line = s.kind[ring] == LINE
    open_start = first & line  # no segment leads to the first vertex of a line
    cross = (inside != inside[prev]) & ~open_start
    count = cross.astype(np.int64) + inside
    at = offsets_of(count)
    out = np.empty((at[-1], 2))
    c = np.flatnonzero(cross)
    p = prev[c]
    t = d[p] / (d[p] - d[c])
    hit = s.xy[p] + (s.xy[c] - s.xy[p]) * t[:, None]
    hit[:, axis] = bound[ring[c]]
    out[at[:-1][c]] = hit
    i = np.flatnonzero(inside)
    out[at[:-1][i] + cross[i]] = s.xy[i]
    out_ring = np.repeat(ring, count)
    start = np.zeros(len(out), bool)
    start[1:] = out_ring[1:] != out_ring[:-1]
    if len(out):
        start[0] = True
    enter = line & cross & inside
    start[at[:-1][enter]] = True
    heads = np.flatnonzero(start)
    source = out_ring[heads]
    made = Shapes(
        out, np.append(heads, len(out)), s.piece[source], s.kind[source], s.poly[source], s.hole[source]
    )
    ok = made.sizes >= made.kind
    return (made, source) if ok.all() else (made.rings(np.flatnonzero(ok)), source[ok])


def clip(s: Shapes, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> Shapes:
    """TIL-5: each ring against the box of its piece."""
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        s = _half_plane(s, axis, bound[s.piece], sign)
    return _prune(s)


def split(s: Shapes, zoom: int, tx: np.ndarray, ty: np.ndarray, buffer: int) -> tuple[Shapes, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of the four child tiles at `zoom`: shapes, source piece, tile x, tile y.

    A child's grown box lies inside its parent's, so cutting level by level loses nothing and a large shape is never copied
    whole to each of its tiles.
    """
    side = float(1 << (32 - zoom))
    grow = buffer * side / 256
    made, source, cx, cy = [], [], [], []
    base = 0
    low = [s.ring_min(axis) for axis in (0, 1)]
    high = [s.ring_max(axis) for axis in (0, 1)]
    point = s.kind == POINT
    for i in (0, 1):
        for j in (0, 1):
            x, y = 2 * tx + i, 2 * ty + j
            box = x * side - grow, y * side - grow, (x + 1) * side + grow, (y + 1) * side + grow
            x0, y0, x1, y1 = (c[s.piece] for c in box)
            out = (high[0] < x0) | (low[0] > x1) | (high[1] < y0) | (low[1] > y1)
            whole = (low[0] >= x0) & (high[0] <= x1) & (low[1] >= y0) & (high[1] <= y1)
            whole &= ~(point & ((high[0] == x1) | (high[1] == y1)))
            part = s.rings(np.flatnonzero(whole))
            cut = np.flatnonzero(~out & ~whole)
            if len(cut):
                part = concat([part, clip(s.rings(cut), *box)])
                part = part.rings(np.lexsort((part.hole, part.poly, part.piece)))
            if not len(part):
                continue
            used, renumbered = np.unique(part.piece, return_inverse=True)
            part.piece = renumbered + base
            made.append(part)
            source.append(used)
            cx.append(x[used])
            cy.append(y[used])
            base += len(used)
    if not made:
        none = np.zeros(0, np.int64)
        return s.rings(none), none, none, none
    return concat(made), np.concatenate(source), np.concatenate(cx), np.concatenate(cy)


def simplify(s: Shapes, tolerance: np.ndarray) -> Shapes:
    """TIL-6: Douglas-Peucker on all rings together, one pass per level of subdivision. `tolerance` is per ring.

    A ring that would be left with fewer than three vertices keeps all of them.
    """
    closed = s.kind == POLYGON
    n = s.sizes + closed
    idx = spans(s.off[:-1], s.sizes + closed)
    ends = np.cumsum(n) - 1
    idx[ends[closed]] = s.off[:-1][closed]  # a ring walks back to its start
    xy = s.xy[idx]
    keep = np.zeros(len(xy), bool)
    a, b = np.cumsum(n) - n, ends
    keep[a], keep[b] = True, True
    tol = np.where(s.kind == POINT, np.inf, tolerance) ** 2
    live = np.flatnonzero(b - a > 1)
    a, b, tol_ab = a[live], b[live], tol[live]
    while len(a):
        inner = b - a - 1
        at = spans(a + 1, inner)
        seg = np.repeat(np.arange(len(a)), inner)
        p, q = xy[a][seg], xy[b][seg]
        dv, w = q - p, xy[at] - p
        length = (dv * dv).sum(axis=1)
        t = np.clip(np.divide((w * dv).sum(axis=1), length, out=np.zeros(len(at)), where=length > 0), 0, 1)
        off = w - dv * t[:, None]
        dist = (off * off).sum(axis=1)
        heads = np.cumsum(inner) - inner
        worst = np.maximum.reduceat(dist, heads)
        split_here = worst > tol_ab
        first = np.full(len(a), len(at))
        np.minimum.at(first, seg, np.where(dist == worst[seg], np.arange(len(at)), len(at)))
        mid = at[first[split_here]]
        keep[mid] = True
        a, b = np.concatenate([a[split_here], mid]), np.concatenate([mid, b[split_here]])
        tol_ab = np.concatenate([tol_ab[split_here]] * 2)
        more = b - a > 1
        a, b, tol_ab = a[more], b[more], tol_ab[more]
    keep[ends[closed]] = False  # drop the repeated start again
    starts = np.cumsum(n) - n
    left = np.add.reduceat(keep.astype(np.int64), starts)
    restore = np.repeat(closed & (left < 3), n)
    keep |= restore
    keep[ends[closed]] = False
    kept = np.add.reduceat(keep.astype(np.int64), starts)
    return Shapes(xy[keep], offsets_of(kept), s.piece, s.kind, s.poly, s.hole)


def quantise(s: Shapes, zoom: int, tx: np.ndarray, ty: np.ndarray) -> Shapes:
    """TIL-7: floor to the tile grid, drop consecutive repeats and what has collapsed, wind exteriors positive (y down)."""
    ring = np.repeat(np.arange(len(s)), s.sizes)
    own = s.piece[ring]
    origin = np.stack([tx[own], ty[own]], axis=1) * float(1 << (32 - zoom))
    grid = np.floor((s.xy - origin) * (EXTENT / float(1 << (32 - zoom)))).astype(np.int64)
    prev = np.arange(len(grid)) - 1
    prev[s.off[:-1]] = np.where(s.kind == POLYGON, s.off[1:] - 1, -1)
    repeat = (prev >= 0) & (grid == grid[prev]).all(axis=1)
    alone = s.sizes == 1
    repeat[s.off[:-1][alone]] = False
    keep = ~repeat
    counts = np.add.reduceat(keep.astype(np.int64), s.off[:-1]) if len(s) else np.zeros(0, np.int64)
    out = _prune_empty(Shapes(grid[keep], offsets_of(counts), s.piece, s.kind, s.poly, s.hole))
    return _wind(_prune(out))


def _prune_empty(s: Shapes) -> Shapes:
    ok = s.sizes > 0
    return s if ok.all() else s.rings(np.flatnonzero(ok))


def _wind(s: Shapes) -> Shapes:
    closed = s.kind == POLYGON
    if not closed.any():
        return s
    nxt = np.arange(len(s.xy)) + 1
    nxt[s.off[1:] - 1] = s.off[:-1]
    twice = np.add.reduceat(s.xy[:, 0] * s.xy[nxt, 1] - s.xy[nxt, 0] * s.xy[:, 1], s.off[:-1])
    # a hole whose exterior has collapsed goes with it
    outer = closed & ~s.hole & (twice != 0)
    key = s.piece * (int(s.poly.max()) + 1) + s.poly
    ok = ~closed | ((twice != 0) & np.isin(key, key[outer]))
    flip = closed & (np.where(s.hole, -twice, twice) < 0)
    ring = np.repeat(np.arange(len(s)), s.sizes)
    at = np.arange(len(s.xy))
    mirrored = s.off[:-1][ring] + s.off[1:][ring] - 1 - at
    xy = s.xy[np.where(flip[ring], mirrored, at)]
    out = Shapes(xy, s.off, s.piece, s.kind, s.poly, s.hole)
    return out if ok.all() else out.rings(np.flatnonzero(ok))
