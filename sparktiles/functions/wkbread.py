"""Geometry columns as rings: WKB of a whole batch read by offsets, without a tree per row (FEA-10).

Every row has a place in the buffer, and all rows take a step together: a header, a member, a ring. Coordinates are gathered once, at the
end. Rows that hold a collection, or bytes that do not add up, are left to the tree reader, which knows the exact complaint.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from . import wkb
from .ragged import Ragged, spans

POINT, LINE, POLYGON = 1, 2, 3


@dataclass
class Rings:
    """Points, lines and rings that hold any vertex, in row order. `member` numbers the geometries of a collection."""

    row: np.ndarray
    member: np.ndarray
    gtype: np.ndarray
    poly: np.ndarray
    hole: np.ndarray
    size: np.ndarray
    xy: np.ndarray

    def __len__(self) -> int:
        return len(self.row)


@dataclass
class Headers:
    """Per row: geometry code (0: null or odd), third ordinate, emptiness; `odd` rows are for the tree reader."""

    code: np.ndarray
    has_z: np.ndarray
    empty: np.ndarray
    odd: np.ndarray


class _Blobs:
    def __init__(self, blobs: pa.Array) -> None:
        r = Ragged.from_arrow(blobs)
        self.end = r.offsets[1:].astype(np.int64)
        self.pos = r.offsets[:-1].astype(np.int64).copy()
        self.data = np.concatenate([r.data, np.zeros(32, np.uint8)])
        n = len(blobs)
        self.code, self.odd = np.zeros(n, np.int64), np.zeros(n, bool)
        self.big, self.width, self.has_z = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, bool)

    def fit(self, rows: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """The rows that have `size` more bytes; the others are odd."""
        short = self.pos[rows] + size > self.end[rows]
        self.odd[rows[short]] = True
        return rows[~short]

    def uint(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        raw = self.data[at[:, None] + np.arange(4)]
        big = self.big[rows]
        raw[big] = raw[big][:, ::-1]
        return np.ascontiguousarray(raw).view("<u4")[:, 0].astype(np.int64)

    def header(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a sound header and their codes; their places are behind it."""
        rows = self.fit(rows, 5)
        mark = self.data[self.pos[rows]]
        self.odd[rows[mark > 1]] = True
        rows, mark = rows[mark <= 1], mark[mark <= 1]
        self.big[rows] = mark == 0
        raw = self.uint(rows, self.pos[rows] + 1)
        dims, code = np.divmod(raw & 0x0FFFFFFF, 1000)
        self.pos[rows] += 5
        known = (dims <= 3) & (code >= 1) & (code <= 7)
        self.odd[rows[~known]] = True
        rows, raw, dims, code = rows[known], raw[known], dims[known], code[known]
        marked = rows[(raw & wkb.HAS_SRID) != 0]
        self.pos[self.fit(marked, 4)] += 4
        z = ((raw & wkb.HAS_Z) != 0) | (dims == 1) | (dims == 3)
        m = ((raw & wkb.HAS_M) != 0) | (dims == 2) | (dims == 3)
        self.has_z[rows], self.width[rows] = z, 2 + z + m
        sound = ~self.odd[rows]
        return rows[sound], code[sound]

    def count(self, rows: np.ndarray, unit: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose next count fits the bytes that are left, and the counts; their places are behind it."""
        rows_in, unit = rows, np.broadcast_to(np.asarray(unit, np.int64), rows.shape)
        rows = self.fit(rows, 4)
        unit = unit[~self.odd[rows_in]] if len(rows) < len(rows_in) else unit
        n = self.uint(rows, self.pos[rows])
        self.pos[rows] += 4
        over = n * unit > self.end[rows] - self.pos[rows]
        self.odd[rows[over]] = True
        return rows[~over], n[~over]


def read_wkb(blobs: pa.Array) -> tuple[Headers, Rings]:
    """Headers of all rows, and the rings of those that are neither null nor odd."""
    b = _Blobs(blobs)
    n = len(blobs)
    valid = blobs.is_valid().to_numpy(zero_copy_only=False)
    members, rings, poly, ring = (np.zeros(n, np.int64) for _ in range(4))
    empty = np.zeros(n, bool)
    found: list[tuple[np.ndarray, ...]] = []

    def record(rows: np.ndarray, gtype: int, size: np.ndarray, hole: np.ndarray | None = None) -> None:
        """Vertices at the rows' places, which move behind them; those that do not fit are odd."""
        bytes_ = 8 * b.width[rows] * size
        fits = b.pos[rows] + bytes_ <= b.end[rows]
        b.odd[rows[~fits]] = True
        rows, size, bytes_ = rows[fits], size[fits], bytes_[fits]
        hole = np.zeros(len(rows), bool) if hole is None else hole[fits]
        found.append((rows, np.full(len(rows), gtype), poly[rows] if gtype == POLYGON else np.zeros(len(rows), np.int64), hole, size, b.pos[rows], b.width[rows], b.big[rows]))
        b.pos[rows] += bytes_

    def open_members(rows: np.ndarray, code: np.ndarray) -> None:
        """Points and lines are read at once; polygons begin."""
        points = rows[code == POINT]
        record(points, POINT, np.ones(len(points), np.int64))
        lines = rows[code == LINE]
        lines, size = b.count(lines, 8 * b.width[lines])
        record(lines, LINE, size)
        polygons, count = b.count(rows[code == POLYGON], 4)
        rings[polygons], ring[polygons] = count, 0

    rows, code = b.header(np.flatnonzero(valid))
    b.code[rows] = code
    outer_z = b.has_z.copy()
    b.odd[rows[code == 7]] = True
    simple = code <= 3
    lines = rows[code == LINE]
    peek = lines[b.pos[lines] + 4 <= b.end[lines]]
    empty[peek] = b.uint(peek, b.pos[peek]) == 0
    open_members(rows[simple], code[simple])
    polygons = rows[code == POLYGON]
    empty[polygons] = rings[polygons] == 0
    multi = (code >= 4) & (code <= 6)
    several, count = b.count(rows[multi], 5)
    members[several] = count
    empty[several] = count == 0
    poly[several] = -1
    while True:
        drawn = np.flatnonzero((rings > 0) & ~b.odd)
        if len(drawn):
            drawn, size = b.count(drawn, 8 * b.width[drawn])
            record(drawn, POLYGON, size, ring[drawn] > 0)
            ring[drawn] += 1
            rings[drawn] -= 1
        waiting = np.flatnonzero((rings == 0) & (members > 0) & ~b.odd)
        if len(waiting):
            members[waiting] -= 1
            rows, code = b.header(waiting)
            wrong = code != b.code[rows] - 3
            b.odd[rows[wrong]] = True
            rows, code = rows[~wrong], code[~wrong]
            poly[rows] += 1
            open_members(rows, code)
        if not len(drawn) and not len(waiting):
            break

    rings_of = _gathered(b, found)
    b.code[b.odd] = 0
    alone = np.flatnonzero(b.code == POINT)
    there = np.zeros(n, bool)
    there[rings_of.row] = True
    empty[alone] = ~there[alone]
    return Headers(b.code, outer_z, empty, b.odd), rings_of


def _gathered(b: _Blobs, found: list[tuple[np.ndarray, ...]]) -> Rings:
    row, gtype, poly, hole, size, at, width, big = (np.concatenate(c) for c in zip(*found, strict=True))
    use = np.flatnonzero((size > 0) & ~b.odd[row])
    use = use[np.argsort(at[use], kind="stable")]
    row, gtype, poly, hole, size, at, width, big = (c[use] for c in (row, gtype, poly, hole, size, at, width, big))
    vertex = np.repeat(at, size) + spans(np.zeros(len(size), np.int64), size) * np.repeat(8 * width, size)
    raw = b.data[vertex[:, None] + np.arange(16)]
    swapped = np.repeat(big, size)
    if swapped.any():
        raw[swapped] = raw[swapped].reshape(-1, 2, 8)[:, :, ::-1].reshape(-1, 16)
    xy = np.ascontiguousarray(raw).view("<f8").reshape(-1, 2)
    # A point of two NaNs is how WKB writes an empty one.
    points = np.repeat(gtype == POINT, size)
    none = points & np.isnan(xy).all(axis=1)
    if none.any():
        keep = ~none
        rings = np.ones(len(size), bool)
        rings[np.repeat(np.arange(len(size)), size)[none]] = False
        row, gtype, poly, hole, size = (c[rings] for c in (row, gtype, poly, hole, size))
        xy = xy[keep]
    return Rings(row, np.zeros(len(row), np.int64), gtype, poly, hole, size, xy)


def rings_of_trees(rows: list[int], trees: list[wkb.Geometry]) -> Rings:
    found = [
        (row, member, gtype, poly, hole, v)
        for row, tree in zip(rows, trees, strict=True)
        for member, (gtype, parts) in enumerate(wkb.simple_parts(tree))
        for v, poly, hole in parts
    ]
    row, member, gtype, poly, hole, verts = zip(*found, strict=True) if found else ((),) * 6
    ints = [np.array(c, np.int64) for c in (row, member, gtype, poly)]
    xy = np.concatenate(verts) if verts else np.zeros((0, 2))
    return Rings(*ints, np.array(hole, bool), np.array([len(v) for v in verts], np.int64), xy)


def merged(a: Rings, b: Rings) -> Rings:
    if not len(b):
        return a
    if not len(a):
        return b
    order = np.argsort(np.concatenate([a.row, b.row]), kind="stable")
    size = np.concatenate([a.size, b.size])
    at = (np.cumsum(size) - size)[order]
    xy = np.concatenate([a.xy, b.xy])[spans(at, size[order])]
    each = [np.concatenate([getattr(a, c), getattr(b, c)])[order] for c in ("row", "member", "gtype", "poly", "hole")]
    return Rings(*each, size[order], xy)


def read_geometries(b: pa.RecordBatch, skip: np.ndarray | None = None) -> Rings:
    """Rings of a batch's `geom` (WKB) or `geojson` column; `skip` rows, nulls and empty geometries have none (FEA-5)."""
    if "geom" not in b.schema.names:
        texts = [(i, t) for i, t in enumerate(b.column("geojson").to_pylist()) if t is not None]
        trees = [(i, g) for i, g in ((i, wkb.from_geojson(t)) for i, t in texts) if g is not None and not g.empty]
        return rings_of_trees([i for i, _ in trees], [g for _, g in trees])
    blobs = b.column("geom")
    if skip is not None and len(skip):
        keep = np.ones(b.num_rows, bool)
        keep[skip] = False
        numbers = np.flatnonzero(keep)
        blobs = blobs.filter(pa.array(keep))
    else:
        numbers = np.arange(b.num_rows)
    headers, rings = read_wkb(blobs)
    odd = np.flatnonzero(headers.odd)
    if len(odd):
        trees = [wkb.from_wkb(v) for v in blobs.take(pa.array(odd)).to_pylist()]
        rings = merged(rings, rings_of_trees(odd.tolist(), trees))
    rings.row = numbers[rings.row]
    return rings
