"""Geometry columns to tile features (FEA-10, FEA-11, TIL-3, TIL-5, TIL-6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import lines as ln
from ..functions import mvt, wkb
from ..functions import shapes as sh
from ..functions.projection import BAD_LAT, BAD_LON, LAT_LIMIT, LON_LIMIT, WORLD
from ..functions.ragged import offsets_of, spans
from ..functions.wkbread import read_geometries, read_wkb
from ..options import MAX_BUILD_ZOOM

Batches = Iterator[pa.RecordBatch]
# Zoom after which the pieces of heavy shapes are dealt out again, so that the tiles of one large shape are cut by many tasks.
SPLIT_ZOOM = 5
# A row with more pieces than this, by estimate, is heavy: moving the pieces of others costs more than cutting them.
HEAVY_PIECES = 500_000
# Vertices cut in one numpy pass, and pieces per output batch: bounds the memory of a task.
PASS_VERTICES = 200_000
# The same for segments of lines: few enough for their columns to stay in a core's cache.
PASS_SEGMENTS = 40_000


def project(lonlat: np.ndarray) -> np.ndarray:
    """The forward projection of `functions.projection`, for vertex arrays."""
    lon, lat = lonlat[:, 0], lonlat[:, 1]
    lon = np.where(np.isfinite(lon), np.clip(np.nan_to_num(lon), -LON_LIMIT, LON_LIMIT), BAD_LON)
    lat = np.where(np.isfinite(lat), np.clip(np.nan_to_num(lat), -LAT_LIMIT, LAT_LIMIT), BAD_LAT)
    phi = lat * np.pi / 180
    x = WORLD * ((lon + 180) / 360)
    y = WORLD * (1 - np.log(np.tan(phi) + 1 / np.cos(phi)) / np.pi) / 2
    both = np.stack([x, y], axis=1)
    return np.where(both >= 0, np.floor(both + 0.5), -np.floor(0.5 - both))


def _load(b: pa.RecordBatch, skip: np.ndarray) -> tuple[sh.Shapes, np.ndarray, np.ndarray]:
    """Shapes of a batch in world units, their source rows, and which are single points; `skip` rows are left out."""
    r = read_geometries(b, skip)
    first = np.ones(len(r), bool)
    first[1:] = (r.row[1:] != r.row[:-1]) | (r.member[1:] != r.member[:-1])
    piece = np.cumsum(first) - 1
    single = (r.gtype[first] == sh.POINT) & (np.bincount(piece) == 1 if len(piece) else np.zeros(0, bool))
    # Points that are nowhere go, and the vertex that closes a ring.
    ring = np.repeat(np.arange(len(r)), r.size)
    ends = np.cumsum(r.size)
    keep = (r.gtype[ring] != sh.POINT) | np.isfinite(r.xy).all(axis=1)
    closed = (r.gtype == sh.POLYGON) & (r.size > 1) & (r.xy[ends - r.size] == r.xy[ends - 1]).all(axis=1) if len(r) else np.zeros(0, bool)
    keep[ends[closed] - 1] = False
    size = np.bincount(ring[keep], minlength=len(r))
    some = size > 0
    s = sh.Shapes(project(r.xy[keep]), offsets_of(size[some]), piece[some], r.gtype[some], r.poly[some], r.hole[some])
    return s, r.row[first], single


def _wrapped(s: sh.Shapes) -> tuple[sh.Shapes, np.ndarray]:
    """World copies: a shape past the antimeridian appears on both sides, one inside the world only once."""
    made, source, base = [], [], 0
    for k in (-1, 0, 1):
        t = s.shifted(float(k * WORLD))
        low, high = np.full(s.piece.max() + 1, np.inf), np.full(s.piece.max() + 1, -np.inf)
        np.minimum.at(low, t.piece, t.ring_min(0))
        np.maximum.at(high, t.piece, t.ring_max(0))
        meets = (high >= 0) & (low < WORLD)
        rings = np.flatnonzero(meets[t.piece])
        if len(rings):
            used, number = np.unique(t.piece[rings], return_inverse=True)
            made.append(t.rings(rings, number + base))
            source.append(used)
            base += len(used)
    if not made:  # nothing of the batch lies in the world
        none = np.zeros(0, np.int64)
        return s.rings(none, none), none
    return sh.concat(made), np.concatenate(source)


def _regroup(s: sh.Shapes, cols: list[np.ndarray], limit: int) -> Iterator[tuple[sh.Shapes, list[np.ndarray]]]:
    """Runs of pieces with about `limit` vertices each."""
    per_piece = np.bincount(s.piece, weights=s.sizes, minlength=len(cols[0]))
    block = (np.cumsum(per_piece) // limit).astype(np.int64)
    for k in np.unique(block):
        pieces = np.flatnonzero(block == k)
        rings = np.flatnonzero(block[s.piece] == k)
        yield s.rings(rings, s.piece[rings] - pieces[0]), [c[pieces] for c in cols]


def _passes(s: sh.Shapes | ln.Segments, cols: list[np.ndarray]) -> Iterator[tuple[sh.Shapes | ln.Segments, list[np.ndarray]]]:
    return ln.regroup(s, cols, PASS_SEGMENTS) if isinstance(s, ln.Segments) else _regroup(s, cols, PASS_VERTICES)


def _by_kind(s: sh.Shapes, cols: list[np.ndarray]) -> Iterator[tuple[sh.Shapes | ln.Segments, list[np.ndarray]]]:
    """Lines as segments, and what else there is."""
    other = (s.kind != sh.LINE) | (s.poly != 0) | s.hole | (s.sizes < 2)
    pieces = np.zeros(len(cols[0]), bool)
    pieces[s.piece[other]] = True
    for flag in (False, True):
        rings = np.flatnonzero(pieces[s.piece] == flag)
        if len(rings):
            used, number = np.unique(s.piece[rings], return_inverse=True)
            part = s.rings(rings, number)
            if not flag:
                part = ln.segments_of(part if (np.diff(number) >= 0).all() else part.rings(np.argsort(number, kind="stable")))
            yield part, [c[used] for c in cols]


def _emit(s: sh.Shapes, zoom: int, tx: np.ndarray, ty: np.ndarray, tolerance: float) -> tuple[sh.Shapes, np.ndarray]:
    """Tile-local rings of one zoom and the pieces that still have any."""
    if tolerance > 0:
        s = sh.simplify(s, np.full(len(s), tolerance * (1 << (32 - zoom)) / sh.EXTENT))
    q = sh.quantise(s, zoom, tx, ty)
    used, number = np.unique(q.piece, return_inverse=True)
    return q.rings(np.arange(len(q)), number), used


def _nested(s: sh.Shapes, dtype: pa.DataType) -> pa.Array:
    """list<list<...>> of x0,y0,x1,y1,... per ring, per piece; rings are in piece order."""
    order = np.argsort(s.piece, kind="stable")
    s = s.rings(order)
    flat = pa.array(s.xy.reshape(-1)).cast(dtype, safe=False)
    rings = pa.ListArray.from_arrays(pa.array(s.off * 2, pa.int32()), flat)
    n = int(s.piece.max()) + 1 if len(s) else 0
    return pa.ListArray.from_arrays(pa.array(offsets_of(np.bincount(s.piece, minlength=n)), pa.int32()), rings)


def _features(
    s: sh.Shapes | ln.Segments, zoom: int, tx: np.ndarray, ty: np.ndarray, tolerance: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The pieces that still have any vertices on the grid of their tiles: which, their types, first vertices and parts."""
    if isinstance(s, ln.Segments) and tolerance <= 0:
        xy, off, line = ln.quantise(s, zoom, tx, ty)
        begins = np.flatnonzero(_new(line))
        rings = pa.ListArray.from_arrays(pa.array((off * 2).astype(np.int32)), pa.array(xy.reshape(-1)))
        parts = pa.ListArray.from_arrays(pa.array(np.append(begins, len(line)).astype(np.int32)), rings)
        return line[begins], np.full(len(begins), sh.LINE), xy[off[begins]], parts
    q, used = _emit(s.shapes() if isinstance(s, ln.Segments) else s, zoom, tx, ty, tolerance)
    kind, first = _row_info(q, len(used)) if len(used) else (used, q.xy)
    return used, kind, first, _nested(q, pa.int32())


def _row_info(s: sh.Shapes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Geometry type and first vertex per piece."""
    first = np.searchsorted(s.piece, np.arange(n)) if (np.diff(s.piece) >= 0).all() else None
    if first is None:
        order = np.argsort(s.piece, kind="stable")
        first = order[np.searchsorted(s.piece[order], np.arange(n))]
    return s.kind[first], s.xy[s.off[:-1][first]]


class _Cutter:
    """State of one task: which columns ride along, the zoom range, and where the pieces are handed on."""

    def __init__(self, carry: list[str], arrow: pa.Schema, minzoom: int, maxzoom: int, stop: int, buffer: int, tol: float):
        self.carry, self.arrow = carry, arrow
        self.encoded = "commands" in arrow.names
        self.minzoom, self.maxzoom, self.stop = minzoom, maxzoom, stop
        self.buffer, self.tol = buffer, tol

    def _batch(self, b: pa.RecordBatch, rows: np.ndarray, cols: dict) -> pa.RecordBatch:
        n = len(rows)
        out = []
        for f in self.arrow:
            if f.name in self.carry:
                out.append(b.column(f.name).take(pa.array(rows)).cast(f.type))
            elif f.name in cols:
                out.append(pa.array(cols[f.name]).cast(f.type) if not isinstance(cols[f.name], pa.Array) else cols[f.name].cast(f.type))
            else:
                out.append(pa.nulls(n, f.type))
        return pa.record_batch(out, schema=self.arrow)

    def _points(self, b: pa.RecordBatch, rows: np.ndarray, xy: np.ndarray) -> pa.RecordBatch:
        wx = xy[:, 0].astype(np.int64) & (WORLD - 1)
        wy = np.clip(xy[:, 1].astype(np.int64), 0, WORLD - 1)
        return self._batch(b, rows, {"gtype": np.full(len(rows), sh.POINT), "wx": wx, "wy": wy})

    def _shapes(self, b: pa.RecordBatch, s: sh.Shapes, rows: np.ndarray, rest: np.ndarray) -> Batches:
        """The `rest` of the rings, wrapped around the world and cut from the whole of it down."""
        if not len(rest):
            return
        used, number = np.unique(s.piece[rest], return_inverse=True)
        s, source = _wrapped(s.rings(rest, number))
        if not len(s):
            return
        rows = rows[used][source]
        zeros = np.zeros(len(rows), np.int64)
        side = np.full(len(rows), float(WORLD))
        grow = self.buffer * WORLD / 256
        s = sh.clip(s, zeros - grow, zeros - grow, side + grow, side + grow)
        if len(s):
            for part, (r, x, y) in _by_kind(s, [rows, zeros, zeros]):
                yield from self._descend(b, part, r, 0, x, y)

    def start(self, batches: Batches) -> Batches:
        for b in batches:
            none = np.zeros(0, np.int64)
            plain, lonlat = wkb.plain_points(b.column("geom")) if "geom" in b.schema.names else (none, np.zeros((0, 2)))
            filled = np.isfinite(lonlat).all(axis=1)
            if filled.any():
                yield self._points(b, plain[filled], project(lonlat[filled]))
            s, rows, single = _load(b, plain)
            if not len(s):
                continue
            points = single[s.piece]
            if points.any():
                p = s.rings(np.flatnonzero(points))
                yield self._points(b, rows[p.piece], p.xy)
            yield from self._shapes(b, s, rows, np.flatnonzero(~points))

    def part(self, batches: Batches, limit: int) -> Batches:
        """Rows as they are, for one task to cut. Of heavy rows, marked by a `zoom`, that is down to this zoom; their pieces of it follow."""
        source = "geom" if "geom" in self.arrow.names else "geojson"
        for b in batches:
            plain = wkb.plain_points(b.column("geom"))[0] if source == "geom" else np.zeros(0, np.int64)
            s, rows, single = _load(b, plain)
            work = np.zeros(b.num_rows)
            np.add.at(work, rows[s.piece], _pieces(s, self.maxzoom, self.buffer))
            heavy = work > limit
            some = np.flatnonzero(b.column(source).is_valid().to_numpy(zero_copy_only=False))
            zoom = pa.array(np.full(len(some), self.stop), mask=~heavy[some])
            yield self._batch(b, some, {source: b.column(source).take(pa.array(some)), "zoom": zoom})
            yield from self._shapes(b, s, rows, np.flatnonzero(heavy[rows[s.piece]] & ~single[s.piece]))

    def resume(self, batches: Batches) -> Batches:
        for b in batches:
            waiting = b.column("pending").is_valid().to_numpy(zero_copy_only=False)
            done = b.filter(pa.array(~waiting))
            if done.num_rows:
                yield done.select(self.arrow.names).cast(self.arrow) if done.schema != self.arrow else done
            w = b.filter(pa.array(waiting))
            if not w.num_rows:
                continue
            outer = w.column("pending")
            outer = outer.combine_chunks() if isinstance(outer, pa.ChunkedArray) else outer
            counts = np.diff(outer.offsets.to_numpy())
            rings = outer.flatten()
            sizes = np.diff(rings.offsets.to_numpy()) // 2
            xy = rings.flatten().to_numpy().reshape(-1, 2)
            marks = w.column("pending_rings").flatten().to_numpy()
            piece = np.repeat(np.arange(w.num_rows), counts)
            kind = w.column("gtype").to_numpy().astype(np.int64)[piece]
            s = sh.Shapes(xy, offsets_of(sizes.astype(np.int64)), piece, kind, marks >> 1, (marks & 1).astype(bool))
            zoom = int(w.column("zoom")[0].as_py())
            tx, ty = (w.column(c).to_numpy().astype(np.int64) for c in ("tile_x", "tile_y"))
            for part, (r, x, y) in _by_kind(s, [np.arange(w.num_rows), tx, ty]):
                yield from self._below(w, part, r, zoom, x, y)

    def _descend(self, b, s, rows, zoom, tx, ty) -> Batches:
        """Emit this zoom, then hand on or cut further; depth first, in passes of bounded size."""
        for part, (r, x, y) in _passes(s, [rows, tx, ty]):
            if zoom >= self.minzoom:
                used, kind, first, parts = _features(part, zoom, x, y, self.tol if zoom < self.maxzoom else 0.0)
                if len(used):
                    side = 1 << (32 - zoom)
                    at = first * (side / sh.EXTENT) + np.stack([x[used], y[used]], axis=1) * float(side)
                    at = np.clip(at, 0, WORLD - 1).astype(np.int64)
                    n = np.full(len(used), zoom)
                    cols = {"zoom": n, "tile_x": x[used], "tile_y": y[used], "gtype": kind, "wx": at[:, 0], "wy": at[:, 1]}
                    made = {"commands": mvt.geometry_bytes(kind, parts).to_arrow()} if self.encoded else {"parts": parts}
                    yield self._batch(b, r[used], {**cols, **made})
            if zoom == self.maxzoom:
                continue
            if zoom == self.stop:
                if "pending" not in self.arrow.names:  # cut by others
                    continue
                p = part.shapes() if isinstance(part, ln.Segments) else part
                kind, _ = _row_info(p, len(r))
                p = p.rings(np.argsort(p.piece, kind="stable"))
                marks = pa.ListArray.from_arrays(
                    pa.array(offsets_of(np.bincount(p.piece, minlength=len(r))), pa.int32()), pa.array(p.poly * 2 + p.hole)
                )
                cols = {"zoom": np.full(len(r), zoom), "tile_x": x, "tile_y": y, "gtype": kind}
                yield self._batch(b, r, {**cols, "pending": _nested(p, pa.float64()), "pending_rings": marks})
                continue
            yield from self._below(b, part, r, zoom, x, y)

    def _below(self, b, s, rows, zoom, tx, ty) -> Batches:
        for part, (r, x, y) in _passes(s, [rows, tx, ty]):
            child, source, cx, cy = (ln if isinstance(part, ln.Segments) else sh).split(part, zoom + 1, x, y, self.buffer)
            if len(child):
                yield from self._descend(b, child, r[source], zoom + 1, cx, cy)


def _pieces(s: sh.Shapes, maxzoom: int, buffer: int) -> np.ndarray:
    """About how many pieces each ring falls into, at most: what its outline crosses, and the tiles inside of a polygon's box."""
    if not len(s):
        return np.zeros(0)
    side = float(1 << (32 - maxzoom))
    step = np.abs(np.diff(s.xy, axis=0, append=s.xy[-1:])).sum(axis=1)
    step[s.off[1:] - 1] = 0
    wide, high = (np.maximum(s.ring_max(a) - s.ring_min(a), 0) / side for a in (0, 1))
    closing = np.where(s.kind == sh.POLYGON, wide + high, 0)
    across = np.add.reduceat(step, s.off[:-1]) / side + closing
    inside = np.where((s.kind == sh.POLYGON) & ~s.hole, wide * high, 0)
    return ((s.sizes + across) * 2 + inside * 4 / 3) * (1 + buffer / 128) ** 2 + maxzoom


def tile_shapes(
    df: DataFrame,
    minzoom: int,
    maxzoom: int,
    buffer: int = 5,
    simplification: float = 1.0,
    split_zoom: int = SPLIT_ZOOM,
    encoded: bool = False,
    heavy: int = HEAVY_PIECES,
) -> DataFrame:
    """Rows with a `geom` (WKB) or `geojson` column to tile features.

    Lines, polygons and multi-points come out once per zoom and tile, with `zoom`, `tile_x`, `tile_y`, `gtype` and `parts`. Single
    points come out once, with `zoom` NULL and `wx`, `wy`: fanning them out is a projection the caller does in Catalyst.
    Rows are dealt out before they are cut. Of those with more than `heavy` pieces, the pieces below `split_zoom` are dealt out, so one country-sized polygon does
    not keep one task busy; all others are cut by one task, as it costs more to move their pieces. With `encoded`, geometries come as
    `commands`, the binary tile form, which is cheaper to move than nested arrays.
    """
    carry = [c for c in df.columns if c not in ("geom", "geojson")]
    fixed = T.StructType(
        [
            T.StructField("zoom", T.IntegerType()),
            T.StructField("tile_x", T.IntegerType()),
            T.StructField("tile_y", T.IntegerType()),
            T.StructField("gtype", T.IntegerType()),
            T.StructField("commands", T.BinaryType()) if encoded else T.StructField("parts", T.ArrayType(T.ArrayType(T.IntegerType()))),
            T.StructField("wx", T.LongType()),
            T.StructField("wy", T.LongType()),
        ]
    )
    waiting = [
        T.StructField("pending", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("pending_rings", T.ArrayType(T.LongType())),
    ]
    kept = T.StructType([df.schema[c] for c in carry] + fixed.fields)
    if maxzoom <= split_zoom:
        cut = _Cutter(carry, _arrow(kept), minzoom, maxzoom, maxzoom, buffer, simplification)
        return df.mapInArrow(cut.start, kept)
    source = "geom" if "geom" in df.columns else "geojson"
    dealing = T.StructType([df.schema[source]] + [df.schema[c] for c in carry] + fixed.fields[:4] + waiting)
    first = _Cutter(carry, _arrow(dealing), split_zoom + 1, maxzoom, split_zoom, buffer, simplification)
    whole, coarse = (_Cutter(carry, _arrow(kept), minzoom, maxzoom, z, buffer, simplification) for z in (maxzoom, split_zoom))

    def cut(batches: Batches) -> Batches:
        for b in batches:
            own, marked = (b.column(c).is_valid() for c in (source, "zoom"))
            for rows, run in (
                (pc.and_not(own, marked), whole.start),
                (pc.and_(own, marked), coarse.start),
                (b.column("pending").is_valid(), whole.resume),
            ):
                some = b.filter(rows)
                if some.num_rows:
                    yield from run(iter([some]))

    # By place and content, so that a retried task deals its rows out the same way. A stated number of tasks, as the adaptive
    # planner would merge them by bytes, and it is the cutting that costs.
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    content = F.xxhash64(source, "pending", *(c for c in ("fid", "rid") if c in carry))
    dealt = df.mapInArrow(lambda batches: first.part(batches, heavy), dealing).repartition(tasks, "zoom", "tile_x", "tile_y", content)
    return dealt.mapInArrow(cut, kept)


def cut_level(df: DataFrame, zoom: int, buffer: int, key: str = "rid") -> DataFrame:
    """Shapes cut to the tiles of one zoom, in a form that can be cut further: pass it the shapes first, then its own rows.

    Rows with `pending` are pieces as clipped; rows with a `zoom` but without `pending` are the features that a tile of
    that zoom holds once the piece is on its grid; rows without a `zoom` are single points.
    """
    fixed = "zoom int, tile_x int, tile_y int, gtype int, wx long, wy long, pending array<array<double>>, pending_rings array<long>"
    schema = T.StructType([df.schema[key], *T.StructType.fromDDL(fixed).fields])
    cut = _Cutter([key], _arrow(schema), zoom, MAX_BUILD_ZOOM + 1, zoom, buffer, 0.0)
    if "pending" in df.columns:
        return df.filter(F.col("pending").isNotNull()).mapInArrow(cut.resume, schema)
    source = "geom" if "geom" in df.columns else "geojson"
    return df.select(key, source).mapInArrow(cut.start, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def _new(*keys: np.ndarray) -> np.ndarray:
    """Where a key differs from the row before."""
    out = np.ones(len(keys[0]), bool)
    out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


def _since(begins: np.ndarray) -> np.ndarray:
    """How far each row is behind the last that begins."""
    at = np.arange(len(begins))
    return at - np.maximum.accumulate(np.where(begins, at, 0))


# --- FEA-10 ------------------------------------------------------------------------------------------------------------


def vertices(df: DataFrame, key: str) -> DataFrame:
    """One row per vertex in world units: `key`, `member`, `gtype`, `part`, `ring`, `pos`, `x`, `y`."""
    schema = T.StructType(
        [df.schema[key]]
        + [T.StructField(n, T.IntegerType()) for n in ("member", "gtype", "part", "ring", "pos")]
        + [T.StructField(n, T.LongType()) for n in ("x", "y")]
    )
    arrow = _arrow(schema)

    def run(batches: Batches) -> Batches:
        for b in batches:
            r = read_geometries(b)
            if not len(r):
                continue
            # A polygon's rings are numbered within it; points and lines are parts of their own.
            polygon = r.gtype == sh.POLYGON
            shape = _new(r.row, r.member)
            part = np.where(polygon, r.poly, _since(shape))
            ring = np.where(polygon, _since(_new(r.row, r.member, part)), 0)
            xy = project(r.xy).astype(np.int64)
            cols = [np.repeat(c, r.size) for c in (r.member, r.gtype, part, ring)]
            cols.append(spans(np.zeros(len(r), np.int64), r.size))
            keys = b.column(key).take(pa.array(np.repeat(r.row, r.size)))
            arrays = [keys, *map(pa.array, cols), pa.array(xy[:, 0]), pa.array(xy[:, 1])]
            yield pa.record_batch([a.cast(f.type) for a, f in zip(arrays, arrow)], schema=arrow)

    source = "geom" if "geom" in df.columns else "geojson"
    return df.select(key, source).mapInArrow(run, schema)


# --- FEA-11 ------------------------------------------------------------------------------------------------------------


def look(blob: bytes) -> tuple:
    try:
        g = wkb.from_wkb(blob)
    except wkb.GeometryError as e:
        return None, None, None, str(e)
    return wkb.NAMES[g.code], g.has_z, g.empty, None


def inspect_geometry(df: DataFrame, column: str = "geom") -> DataFrame:
    """`geom_type`, `has_z`, `is_empty`, `error` per row; a malformed blob is a row here, not a failed job."""
    schema = "geom_type string, has_z boolean, is_empty boolean, error string"
    arrow = pa.schema(
        [("geom_type", pa.string()), ("has_z", pa.bool_()), ("is_empty", pa.bool_()), ("error", pa.string())]
    )

    def run(batches: Batches) -> Batches:
        for b in batches:
            blobs = b.column(0)
            headers, _ = read_wkb(blobs)
            known = headers.code > 0
            kinds = pa.array([None, *wkb.NAMES.values()], pa.string()).take(pa.array(headers.code))
            has_z, empty = (pa.array(c, mask=~known) for c in (headers.has_z, headers.empty))
            cols = [kinds, has_z, empty, pa.nulls(len(blobs), pa.string())]
            odd = np.flatnonzero(headers.odd)
            if len(odd):  # collections and broken bytes
                rows = [look(v) for v in blobs.take(pa.array(odd)).to_pylist()]
                place = np.arange(len(blobs))
                place[odd] = len(blobs) + np.arange(len(odd))
                cols = [pa.concat_arrays([c, pa.array(list(o), c.type)]).take(pa.array(place)) for c, o in zip(cols, zip(*rows))]
            yield pa.record_batch([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return df.select(column).mapInArrow(run, schema)


def geometry_profile(df: DataFrame, column: str = "geom") -> DataFrame:
    """FEA-11: rows by type, dimension, emptiness and error."""
    keys = ["geom_type", "has_z", "is_empty", "error"]
    return inspect_geometry(df, column).groupBy(*keys).agg(F.count("*").alias("n"))
