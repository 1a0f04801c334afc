"""SRC-10: tile table to features. A narrow job: any (zoom, tile_x, tile_y, tile_data) table, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions import mvt, tileread

# The columns that come before the attributes.
FIXED = T.StructType(
    [
        T.StructField("geom", T.BinaryType()),
        T.StructField("layer", T.StringType()),
        T.StructField("zoom", T.IntegerType()),
        T.StructField("tile_x", T.IntegerType()),
        T.StructField("tile_y", T.IntegerType()),
        T.StructField("feature_id", T.LongType()),
    ]
)
ARROW = {"double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
# Features handed on at once, and what is decoded at once. A tile of more than LARGE_BYTES, unpacked, is read in stretches.
BATCH_FEATURES = 10_000
LARGE_BYTES = 2 << 20
BATCH_BYTES, BATCH_TILES = 1 << 20, 4096
# The column that numbers the stretches of a tile, where a table has tiles in several rows.
STRETCH = "_stretch"


def output_schema(attributes: list[tuple[str, str]]) -> T.StructType:
    """Attributes are (name, type); one named like a fixed column is prefixed, since Spark could not tell them apart."""
    taken = {f.name.lower() for f in FIXED.fields}
    out = list(FIXED.fields)
    for name, kind in attributes:
        unique = name
        while unique.lower() in taken:
            unique = f"attr_{unique}"
        taken.add(unique.lower())
        out.append(T.StructField(unique, SPARK[kind]))
    return T.StructType(out)


SPARK = {"double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType()}
_TRUE, _FALSE = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")


def cast_value(v: object, kind: str, strict: bool) -> object:
    """A tile value as the type its column was promised."""
    if v is None:
        return None
    try:
        if kind == "double":
            return float(v)
        if kind == "string":
            if isinstance(v, bool):
                return "true" if v else "false"
            return repr(v).replace("e+", "e") if isinstance(v, float) else str(v)
        if isinstance(v, str):
            text = v.strip().lower()
            if text not in _TRUE + _FALSE:
                raise ValueError
            return text in _TRUE
        return v != 0
    except ValueError:
        if strict:
            raise ValueError(f"Could not convert tile attribute value {v!r} to {kind}") from None
        return None


def decode_rows(
    tiles: Iterator[tuple[int, int, int, bytes | tileread.Spool]], attributes: list[tuple[str, str]], layer: str | None, strict: bool = True
) -> Iterator[pa.RecordBatch]:
    """Record batches of `output_schema(attributes)` from (zoom, x, y, uncompressed or gzipped bytes, or a file of them)."""
    names = [n for n, _ in attributes]
    schema = pa.schema(
        [
            ("geom", pa.binary()),
            ("layer", pa.string()),
            ("zoom", pa.int32()),
            ("tile_x", pa.int32()),
            ("tile_y", pa.int32()),
            ("feature_id", pa.int64()),
            *((f.name, ARROW[k]) for f, (_, k) in zip(output_schema(attributes).fields[len(FIXED) :], attributes)),
        ]
    )

    def rows_of(got: tileread.TileColumns, at: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
        n = len(got.fid)
        if not n:
            return
        if (got.fid > 0x7FFFFFFFFFFFFFFF).any():
            raise ValueError("feature id does not fit a LONG")
        zoom, x, y = np.array(at, np.int64).T[:, got.tile]
        parts = tileread.read_parts(got.ints, got.bounds)
        own = parts.owner
        lonlat = tileread.degrees(parts.xy, x[own].astype(float), y[own].astype(float), np.exp2(zoom[own]), got.extent[own])
        geom = tileread.wkb_column(got.gtype, parts, lonlat)
        cols = [geom, got.layer, *(pa.array(c.astype(np.int32)) for c in (zoom, x, y)), pa.array(got.fid.astype(np.int64), mask=~got.has_fid)]
        cols += [value_column(got.values, number, kind, strict) for number, (_, kind) in zip(got.slots, attributes)]
        out = pa.record_batch(cols, schema=schema)
        out = out.filter(geom.is_valid()) if geom.null_count else out
        for low in range(0, out.num_rows, BATCH_FEATURES):
            yield out.slice(low, BATCH_FEATURES)

    at, buffers, size = [], [], 0
    for zoom, x, y, data in tiles:
        if isinstance(data, tileread.Spool):
            for got in tileread.read_large(data, names, layer):
                yield from rows_of(got, [(zoom, x, y)])
            data.close()
            continue
        view = memoryview(data).cast("B")
        if mvt.unpacked_size(view) > LARGE_BYTES:
            for got in tileread.read_large(view, names, layer):
                yield from rows_of(got, [(zoom, x, y)])
            continue
        at.append((zoom, x, y))
        buffers.append(mvt.gunzip_tile(bytes(view)))
        size += len(buffers[-1])
        if size >= BATCH_BYTES or len(at) >= BATCH_TILES:
            yield from rows_of(tileread.read_tiles(buffers, names, layer), at)
            at, buffers, size = [], [], 0
    if at:
        yield from rows_of(tileread.read_tiles(buffers, names, layer), at)


def value_column(values: tileread.Values, number: np.ndarray, kind: str, strict: bool) -> pa.Array:
    """The values of one attribute, as the type its column was promised; the usual kinds without a step per value."""
    there = number >= 0
    rows = number[there]
    kinds = values.kind[rows]
    place = pa.array(np.where(there, np.cumsum(there) - 1, 0), mask=~there)
    if kind == "double" and not np.isin(kinds, (0, tileread.STRING)).any():
        return pa.array(values.doubles(rows)).take(place)
    if kind == "string" and (kinds == tileread.STRING).all():
        return values.raw.take(pa.array(np.maximum(number, 0), mask=~there)).cast(pa.string()) if len(rows) else pa.nulls(len(number), pa.string())
    distinct, again = np.unique(rows, return_inverse=True)
    cast = [cast_value(values.one(n), kind, strict) for n in distinct.tolist()]
    return pa.array(cast, ARROW[kind]).take(pa.array(again)).take(place)


Address = tuple[int, int, int]


def joined_stretches(rows: Iterator[tuple[Address, int, pa.Buffer]]) -> Iterator[tuple[int, int, int, pa.Buffer | tileread.Spool]]:
    """Tiles from their stretches, which stand together and in order; one of several goes through a file."""
    address, tile, n = None, None, 0
    for at, stretch, data in rows:
        if not stretch:
            if tile is not None:
                yield *address, tile
            address, tile, n = at, data, 1
            continue
        if at != address or stretch != n:
            raise ValueError(f"tile {'/'.join(map(str, at))}: its stretch {stretch} does not stand behind the one before")
        if n == 1:
            tile = tileread.Spool(memoryview(tile))
        tile.add(memoryview(data))
        n += 1
    if tile is not None:
        yield *address, tile


def stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Address, int, pa.Buffer]]:
    """Address, number of the stretch and bytes of every row that has some."""
    for b in batches:
        data = b.column("tile_data")  # one tile at a time, none of them copied
        stretch = b.column(STRETCH).to_pylist() if STRETCH in b.schema.names else [0] * b.num_rows
        for i, address in enumerate(zip(*(b.column(k).to_pylist() for k in ("zoom", "tile_x", "tile_y")))):
            if data[i].is_valid and (one := data[i].as_buffer()).size:
                yield address, stretch[i], one


def _decode(attributes: list[tuple[str, str]], layer: str | None, strict: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from decode_rows(joined_stretches(stretch_rows(batches)), attributes, layer, strict)

    return run


def whole_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles in stretches as tiles of one value each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *address, data in joined_stretches(stretch_rows(batches)):
            one = b"".join(data.blocks()) if isinstance(data, tileread.Spool) else data.to_pybytes()
            yield pa.record_batch([*(pa.array([k], pa.int32()) for k in address), pa.array([one], pa.binary())], names=["zoom", "tile_x", "tile_y", "tile_data"])

    return tiles.mapInArrow(run, "zoom int, tile_x int, tile_y int, tile_data binary")


def decode_tiles(
    tiles: DataFrame, attributes: list[tuple[str, str]], layer: str | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """One row per feature. `attributes` are (name, 'double' | 'boolean' | 'string'). Tiles may be in stretches, as `encode_tiles` gives
    them, with nothing in between that moves rows."""
    narrow = tiles.select("zoom", "tile_x", "tile_y", "tile_data", *(c for c in tiles.columns if c == STRETCH))
    return narrow.mapInArrow(_decode(attributes, layer, mode.upper() == "FAILFAST"), output_schema(attributes))
