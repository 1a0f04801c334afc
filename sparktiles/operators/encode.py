"""TIL-16: features to encoded tiles, in batches of whole tiles."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import mvt
from ..functions.jsontext import render
from ..functions.ragged import Ragged, offsets_of, vconcat
from .dealing import by_range
from .decode import STRETCH
from .features import property_fields
from .packing import by_bucket, packed_bytes, unpacked_bytes, unpacked_rows
from .tiling import TILE, fullest, tile_counts

# A tile with more rows than this is encoded in pieces, by several tasks.
PIECE_ROWS = 100_000
# Rows an encoding task is given.
TASK_ROWS = 500_000
# The list of tiles to split is broadcast up to this many rows, and joined with a shuffle beyond.
BROADCAST_TILES = 100_000

TILE_SCHEMA = "zoom int, tile_x int, tile_y int, tile_data binary"
# A piece's parts: its head (bytes of its features, number and bytes of its values), its features, and its values in blocks.
HEAD, FEATURES, VALUES = 0, 1, 2
PART_SCHEMA = (
    "zoom int, tile_x int, tile_y int, layer string, section int, block int, piece long, pieces long, size long, n long, bytes long, "
    "data binary, tile_data binary"
)
TILE_ARROW = pa.schema(
    [("zoom", pa.int32()), ("tile_x", pa.int32()), ("tile_y", pa.int32()), ("tile_data", pa.binary())]
)
STRETCH_SCHEMA = f"zoom int, tile_x int, tile_y int, {STRETCH} int, tile_data binary"
STRETCH_ARROW = pa.schema([*list(TILE_ARROW)[:3], (STRETCH, pa.int32()), ("tile_data", pa.binary())])
PART_ARROW = pa.schema(
    [
        ("zoom", pa.int32()),
        ("tile_x", pa.int32()),
        ("tile_y", pa.int32()),
        ("layer", pa.string()),
        ("section", pa.int32()),
        ("block", pa.int32()),
        *((k, pa.int64()) for k in ("piece", "pieces", "size", "n", "bytes")),
        ("data", pa.binary()),
        ("tile_data", pa.binary()),
    ]
)
PART_KEYS = [*TILE, "layer", "piece", "pieces"]
Batches = Iterator[pa.RecordBatch]
# Values of a block: of all pieces of a layer together.
JOINED_VALUES = 2_000_000
# Filler for a value number that no piece uses: an empty value message.
EMPTY_VALUE = bytes([mvt.LAYER_VALUE, 0])


def whole_groups(batches: Batches, keys: list[str]) -> Batches:
    """Re-cut a sorted stream so that no group is split; holds back one group at most."""
    held: list[pa.RecordBatch] = []

    def same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int) -> bool:
        return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)

    for b in batches:
        if b.num_rows == 0:
            continue
        if held and not same(held[-1], held[-1].num_rows - 1, b, 0):
            yield _one(held)
            held = []
        tail = np.ones(b.num_rows, bool)
        for k in keys:
            c = b.column(k).to_numpy(zero_copy_only=False)
            tail &= c == c[-1]
        cut = b.num_rows - int(np.argmin(tail[::-1])) if not tail.all() else 0
        if cut:
            yield _one([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One batch of a group's parts. A column of over 2 GiB does not fit one batch: that is an error with the tile's address."""
    if len(batches) == 1:
        return batches[0]
    try:
        return pa.concat_batches(batches)
    except pa.ArrowInvalid as e:
        address = "/".join(str(batches[0].column(k)[0].as_py()) for k in TILE)
        raise ValueError(f"tile {address}: its rows are too large to be encoded by one task") from e


def _starts(b: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    change = np.zeros(b.num_rows, bool)
    change[0] = True
    for k in keys:
        c = b.column(k)
        if pa.types.is_string(c.type) or pa.types.is_large_string(c.type):
            c = c.dictionary_encode().indices
        v = c.to_numpy(zero_copy_only=False)
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def _property_columns(b: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    out, props = [], b.column("props")
    children = dict(zip((f.name for f in props.type), props.flatten()))
    for arr in (children[n] for n in names):
        if pa.types.is_nested(arr.type):
            arr = pa.array(render(arr), pa.string())
        out.append(arr)
    return out


def _geometries(b: pa.RecordBatch, gtype: np.ndarray) -> Ragged:
    """Command streams: as they come in `commands` where that is filled, else from `parts`, else from the point `px`, `py`."""

    def made(b: pa.RecordBatch, gtype: np.ndarray) -> Ragged:
        if "parts" in b.schema.names:
            return mvt.geometry_bytes(gtype, b.column("parts"))
        return mvt.point_bytes(*(b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("px", "py")))

    if "commands" not in b.schema.names:
        return made(b, gtype)
    ready = b.column("commands").is_valid().to_numpy(zero_copy_only=False)
    given = Ragged.from_arrow(b.column("commands"))
    if ready.all():
        return given
    place = np.arange(len(gtype))
    place[~ready] = len(gtype) + np.arange((~ready).sum())
    return vconcat([given, made(b.filter(pa.array(~ready)), gtype[~ready])]).take(place)


def _layers(b: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, Ragged, Ragged, np.ndarray]:
    """First row of each (tile, piece, layer), its features, all value fields, and their bounds per layer."""
    starts = _starts(b, [*TILE, "layer", "piece"])
    bounds = np.append(starts, b.num_rows)
    group = np.repeat(np.arange(len(starts)), np.diff(bounds))
    gtype = b.column("gtype").to_numpy().astype(np.int64)
    pieces, piece = (b.column(k).to_numpy().astype(np.int64) for k in ("pieces", "piece"))
    tags, values, counts = mvt.attribute_tables(group, len(starts), _property_columns(b, names), pieces, piece)
    features = mvt.feature_bytes(b.column("fid"), tags, gtype, _geometries(b, gtype))
    value_bounds = np.append(0, np.cumsum(counts))
    return starts, features.merge(bounds), values.field(mvt.LAYER_VALUE), value_bounds


def _whole_tiles(b: pa.RecordBatch, names: list[str], level: int) -> list[pa.Array]:
    """zoom, tile_x, tile_y, tile_data of a batch that holds whole tiles."""
    starts, features, values, value_bounds = _layers(b, names)
    layer = Ragged.from_arrow(b.column("layer").take(pa.array(starts)))
    layers = mvt.layer_bytes(layer, features, names, values.merge(value_bounds))
    heads = _starts(b, TILE)
    tiles = layers.merge(np.append(np.searchsorted(starts, heads), len(starts)))
    data = pa.array([mvt.gzip_tile(t, level) for t in tiles.tolist()], pa.binary())
    return [*(b.column(k).take(pa.array(heads)) for k in TILE), data]


def _encode(names: list[str], level: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for b in whole_groups(batches, TILE):
            yield pa.record_batch(_whole_tiles(b, names, level), schema=TILE_ARROW)

    return run


def _filled(cols: dict[str, pa.Array]) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    arrays = [cols[f.name].cast(f.type) if f.name in cols else pa.nulls(n, f.type) for f in PART_ARROW]
    return pa.record_batch(arrays, schema=PART_ARROW)


def block_values(pieces: int | np.ndarray) -> int | np.ndarray:
    """How many values of each piece are in a block."""
    return np.maximum(1, JOINED_VALUES // pieces)


def _value_parts(values: Ragged, bounds: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """The value fields of pieces, given by their bounds, in blocks of `each` values: the piece and the columns of every block."""
    counts = np.diff(bounds)
    blocks = -(-counts // each)
    of = np.repeat(np.arange(len(counts)), blocks)
    block = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = bounds[:-1][of] + block * each[of]
    high = np.minimum(low + each[of], bounds[1:][of])
    lengths, at = values.lengths.astype("<u4"), values.offsets
    raw = [lengths[a:b].tobytes() + values.data[at[a] : at[b]].tobytes() for a, b in zip(low.tolist(), high.tolist(), strict=True)]
    sizes = pa.array([len(r) for r in raw], pa.int64())
    return of, {"block": pa.array(block), "n": pa.array(high - low), "size": sizes, "data": pa.array([packed_bytes(r) for r in raw], pa.binary())}


def _encode_pieces(names: list[str], level: int) -> Callable[[Batches], Batches]:
    """Tiles in one piece are finished here; of the others, the parts of each piece."""

    def run(batches: Batches) -> Batches:
        for b in whole_groups(batches, [*TILE, "piece"]):
            alone = b.column("pieces").to_numpy() == 1
            if alone.any():
                yield _filled(dict(zip([*TILE, "tile_data"], _whole_tiles(b.filter(pa.array(alone)), names, level))))
            if alone.all():
                continue
            cut = b.filter(pa.array(~alone))
            starts, features, values, value_bounds = _layers(cut, names)
            keys = pa.record_batch([cut.column(k).take(pa.array(starts)) for k in PART_KEYS], names=PART_KEYS)
            place = dict(zip(PART_KEYS, keys.columns, strict=True))
            n = len(starts)
            numbers = {"size": features.lengths, "n": np.diff(value_bounds), "bytes": np.diff(values.offsets[value_bounds])}
            place["block"] = pa.array(np.zeros(n, np.int32))
            yield _filled(place | {k: pa.array(v) for k, v in numbers.items()} | {"section": pa.array(np.full(n, HEAD))})
            packed = pa.array([packed_bytes(f) for f in features.tolist()], pa.binary())
            yield _filled(place | {"section": pa.array(np.full(n, FEATURES)), "size": pa.array(features.lengths), "data": packed})
            each = block_values(keys.column("pieces").to_numpy())
            of, columns = _value_parts(values, value_bounds, each)
            if len(of):
                owner = dict(zip(PART_KEYS, keys.take(pa.array(of)).columns, strict=True))
                yield _filled(owner | columns | {"section": pa.array(np.full(len(of), VALUES))})

    return run


# Values of a block that are put in line at a time, and packed bytes of a tile that are handed on at a time.
STEP_VALUES, STRETCH_BYTES = 100_000, 1 << 20


class JoinedTile:
    """A tile from its parts, as they come in order of layer, section, block and piece: bytes are only strung together, nothing is encoded
    again. The heads of a layer's pieces say how long it will be, so packed bytes can go on as soon as they are there; held are one
    block of values and a few numbers per piece."""

    def __init__(self, address: tuple[int, int, int], names: list[str], level: int):
        self.address, self.names, self.layer, self.stretch = address, names, None, 0
        self.packer, self.out = zlib.compressobj(level, zlib.DEFLATED, 31), bytearray()

    def add(self, layer: str, section: int, block: int | None, rows: pa.RecordBatch) -> None:
        """Parts of one layer, section and block, in order of their pieces."""
        if layer != self.layer:
            self._close()
            self.layer, self.section, self.heads = layer, HEAD, []
        if section == HEAD:
            self.heads.append(rows.select(["piece", "pieces", "size", "n", "bytes"]))
            return
        if self.section == HEAD:
            self._open()
        if section == FEATURES:
            for data, size in zip(rows.column("data"), rows.column("size").to_pylist(), strict=True):
                self._write(unpacked_bytes(data.as_buffer(), size))
        else:
            if block != self.block:
                self._values_upto(block)
            for data, size, n, piece in zip(rows.column("data"), *(rows.column(k).to_pylist() for k in ("size", "n", "piece")), strict=True):
                raw = unpacked_bytes(data.as_buffer(), size)
                self.lengths.append(np.frombuffer(raw, np.uint32, n))
                self.values.append(np.frombuffer(raw, np.uint8)[4 * n :])
                self.held.append((piece, n))

    def _write(self, data: bytes | np.ndarray | pa.Buffer) -> None:
        self.out += self.packer.compress(memoryview(data).cast("B") if len(data) else b"")

    def _open(self) -> None:
        heads = pa.Table.from_batches(self.heads)
        piece, n = heads["piece"].to_numpy(), heads["n"].to_numpy()
        self.pieces, self.heads, self.section = heads["pieces"][0].as_py(), [], FEATURES
        self.counts = np.zeros(self.pieces, np.int64)
        self.counts[piece] = n
        self.depth, self.each = int(self.counts.max()), int(block_values(self.pieces))
        size = int(heads["bytes"].to_numpy().sum()) + (self.depth * self.pieces - int(n.sum())) * len(EMPTY_VALUE)
        front, self.keys = mvt.layer_front(self.layer, self.names, int(heads["size"].to_numpy().sum()), size)
        self._write(front)
        self.block, self.values, self.lengths, self.held = -1, [], [], []

    def _values_upto(self, block: int) -> None:
        """The values of the block that is held, in line; before the first come the keys."""
        if self.block < 0:
            self._write(self.keys)
        else:
            held, firsts = np.zeros(self.pieces, np.int64), np.zeros(self.pieces, np.int64)
            piece, n = np.array(self.held, np.int64).T
            total = int(n.sum())
            held[piece], firsts[piece] = n, np.cumsum(n) - n
            # The value behind the last is the filler of numbers that no piece uses.
            ends = offsets_of(np.append(np.concatenate(self.lengths), len(EMPTY_VALUE)))
            table = Ragged(np.concatenate([*self.values, np.frombuffer(EMPTY_VALUE, np.uint8)]), ends)
            self.values, self.lengths, self.held = [], [], []
            upto, step = min(self.each, self.depth - self.block * self.each), max(1, STEP_VALUES // self.pieces)
            for low in range(0, upto, step):
                local = np.arange(low, min(low + step, upto))[:, None]
                self._write(table.take(np.where(local < held, firsts + local, total).reshape(-1)).data)
        self.block = block

    def _close(self) -> None:
        if self.layer is None:
            return
        if self.section == HEAD:
            self._open()
        self._values_upto(-1)
        self._write(mvt.LAYER_TAIL)
        self.layer = None

    def done(self) -> None:
        self._close()
        self.out += self.packer.flush()

    def ready(self, least: int = STRETCH_BYTES) -> Batches:
        """Packed bytes as they are, a stretch of the tile each."""
        while len(self.out) >= least and self.out:
            data = bytes(memoryview(self.out)[:STRETCH_BYTES])
            del self.out[: len(data)]
            yield pa.record_batch([*(pa.array([k], pa.int32()) for k in (*self.address, self.stretch)), pa.array([data], pa.binary())], schema=STRETCH_ARROW)
            self.stretch += 1

    def batch(self) -> pa.RecordBatch:
        """The whole tile."""
        if len(self.out) >= 1 << 31:
            raise ValueError(f"tile {'/'.join(map(str, self.address))}: its {len(self.out)} bytes are too many for one value")
        ends = pa.py_buffer(np.array([0, len(self.out)], np.int32))
        made = pa.Array.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(self.out)])
        return pa.record_batch([*(pa.array([k], pa.int32()) for k in self.address), made], schema=TILE_ARROW)


def _join_pieces(names: list[str], level: int, stretches: bool) -> Callable[[Batches], Batches]:
    """Parts of a tile to the tile."""

    def made(tile: JoinedTile) -> Batches:
        tile.done()
        if stretches:
            yield from tile.ready(0)
        else:
            yield tile.batch()

    def run(batches: Batches) -> Batches:
        tile = None
        for b in batches:
            done = b.column("tile_data").is_valid().to_numpy(zero_copy_only=False)
            runs = np.flatnonzero(np.diff(done, prepend=not done[0])).tolist() if len(done) else []
            for low, high in zip(runs, [*runs[1:], len(done)]):
                if done[low]:  # in their place: nothing may come between the stretches of a tile
                    if tile is not None:
                        yield from made(tile)
                        tile = None
                    yield _as_stretches(pa.record_batch([b.column(f.name).slice(low, high - low) for f in TILE_ARROW], schema=TILE_ARROW), stretches)
                    continue
                cut = b.slice(low, high - low)
                bounds = np.append(_starts(cut, [*TILE, "layer", "section", "block"]), cut.num_rows).tolist()
                for start, end in zip(bounds, bounds[1:]):
                    address = tuple(cut.column(k)[start].as_py() for k in TILE)
                    if tile is not None and tile.address != address:
                        yield from made(tile)
                        tile = None
                    if tile is None:
                        tile = JoinedTile(address, names, level)
                    tile.add(*(cut.column(k)[start].as_py() for k in ("layer", "section", "block")), cut.slice(start, end - start))
                    if stretches:
                        yield from tile.ready()
        if tile is not None:
            yield from made(tile)

    return run


def _as_stretches(tiles: pa.RecordBatch, stretches: bool) -> pa.RecordBatch:
    """Tiles of one stretch each, where stretches are asked for."""
    if not stretches:
        return tiles
    return pa.record_batch([*tiles.columns[:3], pa.array(np.zeros(tiles.num_rows, np.int32)), tiles.columns[3]], schema=STRETCH_ARROW)


def encode_tiles(
    df: DataFrame,
    largest: int | None = None,
    total: int | None = None,
    piece_rows: int = PIECE_ROWS,
    level: int = 6,
    key: str = "fid",
    bounds: list[int] | None = None,
    stretches: bool = False,
) -> DataFrame:
    """Tile table from `zoom, tile_x, tile_y, layer, fid, gtype, props` and a geometry.

    The geometry is `parts`, array<array<int>> of tile-local x0,y0,x1,y1,..., or `px`, `py` for single points; a `commands`
    column, where filled, is the geometry already in tile form and goes before either. `props` is a struct. One shuffle by tile,
    into tasks of about `TASK_ROWS` rows. `largest` and `total` are the row counts of the fullest tile and of all (counted
    here if not given): when the fullest is over `piece_rows`, such tiles are cut by a hash of `key` into pieces that separate
    tasks encode, and a second shuffle, of encoded bytes only, brings the pieces together; both are of packed values. With `stretches` a
    tile may be several rows, numbered by `STRETCH`, whose bytes one behind the other are the tile; they stand together. With `bounds` (`dealing.curve_bounds`) tasks
    get ranges of the Hilbert curve instead of hashed tiles, and tiles come out in curve order.
    """
    names = property_fields(df.schema["props"].dataType)
    columns = [*TILE, "layer", "fid", "gtype", "props", "commands", "parts"]
    columns += ["px", "py"] if "parts" not in df.columns else []
    df = df.select(*(c for c in columns if c in df.columns), *([F.col(key)] if key not in columns else []))
    order = list(dict.fromkeys([*TILE, "layer", "fid", key]))  # rows of one id, or of none, stand in the same order in every layout
    if largest is None or total is None:
        largest, total = fullest(tile_counts(df))
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))
    if largest <= piece_rows:
        whole = df.withColumns({"piece": F.lit(0).cast("long"), "pieces": F.lit(1).cast("long")})
        if bounds is None:
            sorted_rows = whole.repartition(tasks, *TILE).sortWithinPartitions(*order).drop(*({key} - {"fid"}))
        else:
            sorted_rows = by_range(whole, bounds, *order[3:]).drop(*({key} - {"fid"}))
        tiles = sorted_rows.mapInArrow(_encode(names, level), TILE_SCHEMA)
        return tiles.select(*TILE, F.lit(0).alias(STRETCH), "tile_data") if stretches else tiles
    split = tile_counts(df).filter(F.col("n") > piece_rows).select(*TILE, F.ceil(F.col("n") / piece_rows).alias("pieces"))
    small = split.limit(BROADCAST_TILES + 1).count() <= BROADCAST_TILES
    cut = df.join(F.broadcast(split) if small else split, TILE, "left")
    cut = cut.withColumn("pieces", F.coalesce("pieces", F.lit(1).cast("long")))
    cut = cut.withColumn("piece", F.pmod(F.xxhash64(key), F.col("pieces")))
    line = list(dict.fromkeys([*TILE, "piece", "layer", "fid", key]))
    groups, encode = [*TILE, "piece"], _encode_pieces(names, level)
    packed, schema = by_bucket(cut, groups, line, total, tasks)
    parts = packed.mapInArrow(lambda batches: encode(unpacked_rows(batches, schema, groups, line)), PART_SCHEMA)
    together = ("layer", "section", "block", "piece")
    joined = parts.repartition(tasks, *TILE).sortWithinPartitions(*TILE, *together) if bounds is None else by_range(parts, bounds, *together)
    return joined.mapInArrow(_join_pieces(names, level, stretches), STRETCH_SCHEMA if stretches else TILE_SCHEMA)


def points_as_parts(df: DataFrame) -> DataFrame:
    """Tile points (`px`, `py`) in the form `encode_tiles` takes."""
    return df.withColumns({"gtype": F.lit(mvt.POINT), "parts": F.array(F.array("px", "py"))})
