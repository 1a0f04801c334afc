"""Vector tiles of a batch, read as columns: fields of all messages of one kind at once, geometries as WKB in one go (DEC-2 to DEC-5).

Tiles stand one behind the other in one buffer. Layers hold one field per feature, key and value, so their fields are found by
jumping: at every byte that could be a tag, where the next one would be, then two, four, eight fields on. Tiles, features and values have a
few fields each and are walked in step, all of them together.
"""

from __future__ import annotations

import math
import os
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa

from .mvt import CLOSE_PATH, EXTENT, LAYER_FEATURE, LAYER_KEY, LAYER_NAME, LAYER_VALUE, LINE, LINE_TO, MOVE_TO, POINT, POLYGON, TILE_LAYER, unzigzag
from .ragged import Ragged, hstack, offsets_of, read_varints, spans, vconcat

# Field tags of a layer's extent and version, and the value kinds by field number with their wire types.
LAYER_EXTENT, LAYER_VERSION = 0x28, 0x78
STRING, FLOAT, DOUBLE, SIGNED, UNSIGNED, ZIGZAG, BOOL = range(1, 8)
VALUE_WIRES = {STRING: 2, FLOAT: 5, DOUBLE: 1, SIGNED: 0, UNSIGNED: 0, ZIGZAG: 0, BOOL: 0}

_LAYER_TAG = np.zeros(256, bool)
_LAYER_TAG[[LAYER_NAME, LAYER_FEATURE, LAYER_KEY, LAYER_VALUE, LAYER_EXTENT, LAYER_VERSION]] = True
U64 = np.uint64


class BrokenTile(ValueError):
    pass


# --- Fields ------------------------------------------------------------------------------------------------------------


def numbers_at(data: np.ndarray, pos: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The varint at each place, and the place behind it; none may reach `end`."""
    if (pos >= end).any():
        raise BrokenTile("broken tile: a message ends inside a field")
    byte = data[pos]
    value, at = (byte & np.uint8(0x7F)).astype(U64), pos + 1
    live, shift = np.flatnonzero(byte >= 0x80), 7
    while len(live):
        if shift > 63:
            raise BrokenTile("broken tile: a number of more than ten bytes")
        if (at[live] >= end[live]).any():
            raise BrokenTile("broken tile: a message ends inside a field")
        byte = data[at[live]]
        value[live] |= (byte & np.uint8(0x7F)).astype(U64) << U64(shift)
        at[live] += 1
        live, shift = live[byte >= 0x80], shift + 7
    return value, at


@dataclass
class Fields:
    """Fields of many messages: message number, field number, wire type, the number of a varint, and the range of the payload."""

    message: np.ndarray
    field: np.ndarray
    wire: np.ndarray
    number: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def where(self, mask: np.ndarray) -> Fields:
        return Fields(*(getattr(self, k)[mask] for k in self.__dataclass_fields__))

    def of(self, field: int, wire: int) -> Fields:
        return self.where((self.field == field) & (self.wire == wire))


def walk(data: np.ndarray, start: np.ndarray, end: np.ndarray, done: np.ndarray | None = None) -> Iterator[Fields]:
    """The first field of every message, then the second, and so on. A message that the caller marks as `done` is left there."""
    pos = start.astype(np.int64).copy()
    live = np.flatnonzero(pos < end)
    while len(live):
        stop = end[live]
        tag, at = numbers_at(data, pos[live], stop)
        field, wire = (tag >> U64(3)).astype(np.int64), (tag & U64(7)).astype(np.int64)
        number, size = np.zeros(len(live), U64), np.zeros(len(live), np.int64)
        counted = np.flatnonzero((wire == 0) | (wire == 2))
        value, behind = numbers_at(data, at[counted], stop[counted])
        at[counted] = behind
        number[counted] = value
        size[counted] = np.where(wire[counted] == 2, np.minimum(value, U64(1 << 62)).astype(np.int64), 0)
        size[wire == 1], size[wire == 5] = 8, 4
        odd = ~np.isin(wire, (0, 1, 2, 5))
        if odd.any():
            raise BrokenTile(f"broken tile: no field has wire type {int(wire[odd][0])}")
        behind = at + size
        if (behind > stop).any():
            raise BrokenTile("broken tile: a message ends inside a field")
        yield Fields(live, field, wire, number, at, behind)
        pos[live] = behind
        more = behind < stop
        if done is not None:
            more &= ~done[live]
        live = live[more]


def gathered(steps: Iterator[Fields]) -> Fields:
    """All fields of a walk in the order of their places."""
    found = list(steps)
    if not found:
        return Fields(*(np.zeros(0, U64 if k == "number" else np.int64) for k in Fields.__dataclass_fields__))
    every = Fields(*(np.concatenate([getattr(f, k) for f in found]) for k in Fields.__dataclass_fields__))
    return every.where(np.argsort(every.end, kind="stable"))


def layer_fields(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Fields:
    """All fields of all layers, by place. Layers with tags beyond the usual six are walked instead of jumped through."""
    jumped, odd = _jump(data, start, end)
    if not len(odd):
        return jumped
    walked = gathered(walk(data, start[odd], end[odd]))
    walked.message = odd[walked.message]
    both = [jumped.where(~np.isin(jumped.message, odd)), walked]
    every = Fields(*(np.concatenate([getattr(f, k) for f in both]) for k in Fields.__dataclass_fields__))
    return every.where(np.argsort(every.end, kind="stable"))


def _jump(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[Fields, np.ndarray]:
    """Fields of layers by pointer doubling, and the layers in which that led to no known tag."""
    could = np.flatnonzero(_LAYER_TAG[data])
    layer = np.searchsorted(start, could, "right") - 1
    inside = (layer >= 0) & (could < end[np.maximum(layer, 0)])
    could, layer = could[inside], layer[inside]
    n, stop = len(could), end[layer]
    tag = data[could]
    # The length, or the number of a varint, behind each; places whose bytes do not fit lead nowhere.
    value, at, ends = np.zeros(n, U64), could + 1, np.zeros(n, bool)
    live = np.arange(n)
    for k in range(10):
        live = live[at[live] < stop[live]]
        if not len(live):
            break
        byte = data[at[live]]
        value[live] |= (byte & np.uint8(0x7F)).astype(U64) << U64(7 * k)
        at[live] += 1
        last = byte < 0x80
        ends[live[last]] = True
        live = live[~last]
    sized = (tag & 7) == 2
    behind = at + np.where(sized, np.minimum(value, U64(1 << 40)).astype(np.int64), 0)
    place = np.full(len(data) + 1, n + 1, np.int64)  # n: the layer's end, n + 1: nowhere
    place[could] = np.arange(n)
    fits = ends & (behind <= stop)
    jump = np.full(n + 2, n + 1, np.int64)
    jump[:n] = np.where(fits & (behind == stop), n, np.where(fits, place[np.minimum(behind, len(data))], n + 1))
    jump[n] = n
    filled = np.flatnonzero(start < end)
    first = place[start[filled]]
    odd = filled[first > n]
    reached = first[first <= n]
    while len(reached):
        ahead = jump[reached]
        odd = np.concatenate([odd, layer[reached[ahead > n]]])
        new = ahead[ahead < n]
        if not len(new):
            break
        reached = np.concatenate([reached, new])
        jump = jump[jump]
    reached = np.sort(reached)
    tag = tag[reached].astype(np.int64)
    return Fields(layer[reached], tag >> 3, tag & 7, value[reached], at[reached], behind[reached]), np.unique(odd)


# --- Layers and features -----------------------------------------------------------------------------------------------


def binaries(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    return Ragged(data[spans(start, size)], offsets_of(size)).to_arrow()


def texts(column: pa.Array) -> pa.Array:
    """Binaries as strings; what is no UTF-8 is replaced."""
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in column.to_pylist()], pa.string())


def _last(n: int, rows: np.ndarray, values: np.ndarray, default) -> np.ndarray:
    out = np.full(n, default, dtype=values.dtype)
    out[rows] = values  # the last of several stays
    return out


@dataclass
class Values:
    """Property values of all layers, as they are stored."""

    kind: np.ndarray
    number: np.ndarray
    raw: pa.Array  # strings

    def one(self, i: int) -> object:
        """A value as a Python object."""
        kind, number = int(self.kind[i]), int(self.number[i])
        if kind == STRING:
            return self.raw[i].as_py()
        if kind in (FLOAT, DOUBLE):
            return float(self.doubles(np.array([i]))[0])
        if kind == SIGNED:
            return number - (1 << 64) if number >= 1 << 63 else number
        if kind == ZIGZAG:
            return (number >> 1) ^ -(number & 1)
        return {UNSIGNED: number, BOOL: number != 0}.get(kind)

    def doubles(self, rows: np.ndarray) -> np.ndarray:
        """Numbers and booleans as doubles; NaN for anything else."""
        kind, number = self.kind[rows], self.number[rows]
        out = np.full(len(rows), np.nan)
        for k, read in (
            (FLOAT, lambda v: v.astype(np.uint32).view(np.float32)),
            (DOUBLE, lambda v: v.view(np.float64)),
            (SIGNED, lambda v: v.view(np.int64)),
            (UNSIGNED, lambda v: v),
            (ZIGZAG, unzigzag),
            (BOOL, lambda v: v != 0),
        ):
            at = np.flatnonzero(kind == k)
            if len(at):
                out[at] = read(np.ascontiguousarray(number[at]))
        return out


def read_values(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Values:
    """The first field of a known kind is the value; a message without one has none."""
    n = len(start)
    kind, number, at, upto, done = np.zeros(n, np.int8), np.zeros(n, U64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for f in walk(data, start, end, done):
        for k, wire in VALUE_WIRES.items():
            mine = f.where((f.field == k) & (f.wire == wire))
            if not len(mine.message):
                continue
            rows = mine.message
            kind[rows], done[rows] = k, True
            if wire == 2:
                at[rows], upto[rows] = mine.start, mine.end
            elif wire == 0:
                number[rows] = mine.number
            else:
                width = 8 if wire == 1 else 4
                wide = np.zeros((len(rows), 8), np.uint8)
                wide[:, :width] = padded[mine.start[:, None] + np.arange(width)]
                number[rows] = wide.view("<u8")[:, 0]
    return Values(kind, number, texts(binaries(data, at, upto)))


@dataclass
class TileColumns:
    """Features of many tiles: per feature its tile, layer name, extent, id, type and geometry as command numbers; per attribute slot the
    number of its value, -1 where it has none."""

    tile: np.ndarray
    layer: pa.Array
    extent: np.ndarray
    fid: np.ndarray
    has_fid: np.ndarray
    gtype: np.ndarray
    ints: np.ndarray
    bounds: np.ndarray
    slots: list[np.ndarray]
    values: Values


@dataclass
class Tables:
    """What features of layers refer to: per layer its name, extent and numbers of keys and values, and per key its attribute slot."""

    names: pa.Array
    extent: np.ndarray
    counts: np.ndarray  # layer -> keys, values
    key_slots: np.ndarray
    width: int


def key_slots(keys: pa.Array, attributes: list[str]) -> np.ndarray:
    """The slot of each key, -1 where none is asked for. Names match without regard to case (DEC-5)."""
    slot_of: dict[str, int] = {}
    for i, name in enumerate(attributes):
        slot_of.setdefault(name.lower(), i)
    named = keys.dictionary_encode()
    found = np.array([slot_of.get(t.lower(), -1) for t in texts(named.dictionary).to_pylist()], np.int64)
    return found[named.indices.to_numpy()] if len(keys) else np.zeros(0, np.int64)


def read_tiles(buffers: list[bytes], attributes: list[str], layer: str | None = None) -> TileColumns:
    """Columns of uncompressed tiles. `layer` keeps the layers of that name, without regard to case (SRC-9): others' features are not
    looked into. Features without a geometry or of an unknown type are left out (DEC-4), but their tags must be sound too."""
    data = np.frombuffer(b"".join(buffers), np.uint8)
    ends = np.cumsum([len(b) for b in buffers], dtype=np.int64)
    starts = ends - np.array([len(b) for b in buffers], np.int64)
    layers = gathered(walk(data, starts, ends)).of(TILE_LAYER >> 3, 2)
    fields = layer_fields(data, layers.start, layers.end)
    n_layers = len(layers.message)
    named = fields.of(LAYER_NAME >> 3, 2)
    name_at = _last(n_layers, named.message, np.arange(len(named.message)), -1)
    raw = binaries(data, named.start, named.end).dictionary_encode()
    names = texts(raw.dictionary).take(raw.indices).take(pa.array(np.maximum(name_at, 0), mask=name_at < 0)).fill_null("") if len(named.message) else pa.array([""] * n_layers, pa.string())
    if layer:
        distinct = names.dictionary_encode()
        wanted = np.array([t.lower() == layer.lower() for t in distinct.dictionary.to_pylist()], bool)
        chosen = wanted[distinct.indices.to_numpy()] if n_layers else np.zeros(0, bool)
        fields = fields.where(chosen[fields.message])
    extents = fields.of(LAYER_EXTENT >> 3, 0)
    extent = _last(n_layers, extents.message, extents.number.astype(np.float64), float(EXTENT))
    features, keys, values = (fields.of(tag >> 3, 2) for tag in (LAYER_FEATURE, LAYER_KEY, LAYER_VALUE))
    counts = np.stack([np.bincount(k.message, minlength=n_layers) for k in (keys, values)], axis=1)
    tables = Tables(names, extent, counts, key_slots(binaries(data, keys.start, keys.end), attributes), len(attributes))
    return feature_columns(data, features, layers.message, tables, read_values(data, values.start, values.end))


def feature_columns(data: np.ndarray, features: Fields, tile_of: np.ndarray, tables: Tables, values: Values) -> TileColumns:
    """Columns of feature messages, whose `message` is the layer they are in; `tile_of` is the tile of each layer."""
    n = len(features.message)
    fid, has_fid, gtype = np.zeros(n, U64), np.zeros(n, bool), np.zeros(n, np.int64)
    geometry, tags = (np.zeros(n, np.int64), np.zeros(n, np.int64)), []
    for f in walk(data, features.start, features.end):
        one = f.of(1, 0)
        fid[one.message], has_fid[one.message] = one.number, True
        tags.append(f.of(2, 2))
        kind = f.of(3, 0)
        gtype[kind.message] = np.minimum(kind.number, U64(99)).astype(np.int64)
        drawn = f.of(4, 2)
        geometry[0][drawn.message], geometry[1][drawn.message] = drawn.start, drawn.end
    live = (geometry[1] > geometry[0]) & (gtype >= POINT) & (gtype <= POLYGON)
    slots = _slots(data, features, gathered(iter(tags)), tables, live)
    size = (geometry[1] - geometry[0])[live]
    drawn = Ragged(data[spans(geometry[0][live], size)], offsets_of(size))
    ints, bounds = whole_varints(drawn)
    owner = features.message[live]
    return TileColumns(tile_of[owner], tables.names.take(pa.array(owner)), tables.extent[owner], fid[live], has_fid[live], gtype[live], ints, bounds, slots, values)


# --- Large tiles -------------------------------------------------------------------------------------------------------

# Bytes of a large tile that are unpacked at a time, and packed bytes that are handed to the unpacker for that.
STRETCH_BYTES, PACKED_BYTES = 1 << 20, 1 << 16


def blocks_of(data: memoryview | Spool) -> Iterator[memoryview]:
    """A tile's bytes as they are stored, some at a time."""
    if isinstance(data, Spool):
        yield from data.blocks()
        return
    for low in range(0, len(data), PACKED_BYTES):
        yield data[low : low + PACKED_BYTES]


class Spool:
    """Bytes of a large tile that came in stretches, in a nameless file of this machine rather than in memory."""

    def __init__(self, first: memoryview | bytes = b"") -> None:
        self.file, self.size = tempfile.TemporaryFile(prefix="sparktiles-"), 0
        self.add(first)

    def __len__(self) -> int:
        return self.size

    def add(self, data: memoryview | bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def blocks(self) -> Iterator[memoryview]:
        self.file.flush()
        for low in range(0, self.size, PACKED_BYTES):
            yield memoryview(os.pread(self.file.fileno(), PACKED_BYTES, low))

    def close(self) -> None:
        self.file.close()


class ValueFiles:
    """The values of a large layer, as they come; what is made of them lies in nameless files of this machine, not in memory."""

    def __init__(self) -> None:
        self.n, self.text = 0, 0
        self.files = [tempfile.TemporaryFile(prefix="sparktiles-") for _ in range(4)]
        self.files[2].write(np.zeros(1, np.int64).tobytes())

    def add(self, some: Values) -> None:
        raw = Ragged.from_arrow(some.raw)
        for file, column in zip(self.files, (some.kind, some.number, raw.offsets[1:] + self.text, raw.data), strict=True):
            file.write(np.ascontiguousarray(column).data)
        self.n, self.text = self.n + len(some.kind), self.text + len(raw.data)

    def values(self) -> Values:
        def mapped(file, kind: type, n: int) -> np.ndarray:
            file.flush()
            return np.memmap(file, kind, "r", shape=(n,)) if n else np.zeros(0, kind)

        kind, number, ends, text = (mapped(f, k, n) for f, k, n in zip(self.files, (np.int8, U64, np.int64, np.uint8), (self.n, self.n, self.n + 1, self.text), strict=True))
        raw = pa.LargeStringArray.from_buffers(self.n, pa.py_buffer(ends), pa.py_buffer(text))
        for file in self.files:  # what is mapped stays until nobody uses it
            file.close()
        return Values(kind, number, raw)


def unpacked(data: memoryview | Spool) -> Iterator[bytes]:
    """A tile's bytes, some at a time; what is not gzip passes through."""
    blocks = blocks_of(data)
    first = next(blocks, memoryview(b""))
    out, held = bytearray(), chain([first], blocks)
    if bytes(first[:2]) != b"\x1f\x8b":
        for block in held:
            out += block
            if len(out) >= STRETCH_BYTES:
                yield bytes(out)
                out.clear()
        if out:
            yield bytes(out)
        return
    opened = zlib.decompressobj(31)
    try:
        for packed in held:
            while len(packed) and not opened.eof:
                out += opened.decompress(packed, STRETCH_BYTES)
                packed = opened.unconsumed_tail
                if len(out) >= STRETCH_BYTES:
                    yield bytes(out)
                    out.clear()
        out += opened.flush()
    except zlib.error as e:
        raise ValueError(f"broken tile: its gzip data cannot be unpacked ({e})") from None
    if not opened.eof:
        raise ValueError("broken tile: its gzip data cannot be unpacked (incomplete or truncated stream)")
    if out:
        yield bytes(out)


def leading_fields(data: np.ndarray) -> tuple[Fields, int]:
    """The whole fields at the start of a layer's bytes that end anywhere, and the place behind them. Fields end at a tag beyond the
    usual six, too."""
    could = np.flatnonzero(_LAYER_TAG[data])
    n, tag = len(could), data[could]
    value, at, ends = np.zeros(n, U64), could + 1, np.zeros(n, bool)
    live = np.arange(n)
    for k in range(10):
        live = live[at[live] < len(data)]
        if not len(live):
            break
        byte = data[at[live]]
        value[live] |= (byte & np.uint8(0x7F)).astype(U64) << U64(7 * k)
        at[live] += 1
        last = byte < 0x80
        ends[live[last]] = True
        live = live[~last]
    behind = at + np.where((tag & 7) == 2, np.minimum(value, U64(1 << 40)).astype(np.int64), 0)
    fits = ends & (behind <= len(data))
    place = np.full(len(data) + 1, n, np.int64)  # n: no field begins here
    place[could[fits]] = np.flatnonzero(fits)
    jump = np.full(n + 1, n, np.int64)
    jump[:n][fits] = place[behind[fits]]
    reached = place[:1]
    reached = reached[reached < n]
    while len(reached):
        ahead = jump[reached]
        ahead = ahead[ahead < n]
        if not len(ahead):
            break
        reached = np.concatenate([reached, ahead])
        jump = jump[jump]
    reached = np.sort(reached)
    kind = tag[reached].astype(np.int64)
    found = Fields(np.zeros(len(reached), np.int64), kind >> 3, kind & 7, value[reached], at[reached], behind[reached])
    return found, int(behind[reached[-1]]) if len(reached) else 0


def _one_field(data: np.ndarray) -> tuple[Fields, int] | None:
    """The field at the start of some bytes, and the place behind its payload, which may lie beyond them; None where not even its head
    is there."""
    head = data[:20]
    ends = np.flatnonzero(head < 0x80)
    if len(ends) < 1 or len(ends) < 2 and (head[0] & 7) in (0, 2):
        if len(head) == 20 or len(ends) == 0 and len(head) > 10:
            raise BrokenTile("broken tile: a number of more than ten bytes")
        return None
    whole = np.array([len(head)])
    tag, at = numbers_at(head, np.zeros(1, np.int64), whole)
    field, wire, number, size = int(tag[0]) >> 3, int(tag[0]) & 7, np.zeros(1, U64), 0
    if wire in (0, 2):
        number, at = numbers_at(head, at, whole)
        size = int(number[0]) if wire == 2 else 0
    elif wire in (1, 5):
        size = 8 if wire == 1 else 4
    else:
        raise BrokenTile(f"broken tile: no field has wire type {wire}")
    behind = min(int(at[0]) + size, 1 << 62)
    return Fields(np.zeros(1, np.int64), np.array([field]), np.array([wire]), number, at, np.array([behind])), behind


def stretches(raw: Iterator[bytes]) -> Iterator[tuple[int, np.ndarray, Fields]]:
    """The fields of a tile's layers, some at a time: the number of the layer, its bytes, and the fields that lie in them."""
    held, number, left, skipped, ended = b"", -1, 0, 0, False
    while True:
        if skipped or not held:
            gone = min(skipped, len(held))
            held, skipped = held[gone:], skipped - gone
            if not held:
                held = next(raw, b"")
                if not held:
                    if left or skipped:
                        raise BrokenTile("broken tile: a message ends inside a field")
                    return
            continue
        data = np.frombuffer(held, np.uint8)
        data = data[:left] if left else data
        fields, upto = leading_fields(data) if left else (None, 0)
        if not upto:
            one = _one_field(data)
            if one is not None and not left:  # of the tile: a layer, or something else to pass over
                if one[0].field[0] == TILE_LAYER >> 3 and one[0].wire[0] == 2:
                    number, left = number + 1, int(one[0].number[0])
                    held = held[int(one[0].start[0]) :]
                else:
                    skipped = one[1]
                continue
            if one is None or one[1] > len(data):
                more = b"" if left and len(data) == left else next(raw, b"")
                if not more:
                    raise BrokenTile("broken tile: a message ends inside a field")
                held += more
                continue
            fields, upto = one
        yield number, data[:upto], fields
        held, left = held[upto:], left - upto


def read_large(data: memoryview | Spool, attributes: list[str], layer: str | None = None) -> Iterator[TileColumns]:
    """`read_tiles` of one tile, packed or not, some features at a time. Its layers' tables may stand behind the features, so the tile is
    unpacked once for them (and once before for the names, where a `layer` is asked for) and once for the features. Held are the keys and a
    stretch of features; values that are asked for lie in files."""
    names: dict[int, str] = {}
    wanted = lambda number: not layer or names.get(number, "").lower() == layer.lower()

    def note_names(number: int, part: np.ndarray, fields: Fields) -> None:
        named = fields.of(LAYER_NAME >> 3, 2)
        if len(named.message):
            names[number] = texts(binaries(part, named.start[-1:], named.end[-1:]))[0].as_py()

    if layer:
        for number, part, fields in stretches(unpacked(data)):
            note_names(number, part, fields)
    extent, keys, n_values, found = {}, {}, {}, {}
    for number, part, fields in stretches(unpacked(data)):
        note_names(number, part, fields)
        if not wanted(number):
            continue
        extents, named, values = fields.of(LAYER_EXTENT >> 3, 0), fields.of(LAYER_KEY >> 3, 2), fields.of(LAYER_VALUE >> 3, 2)
        if len(extents.message):
            extent[number] = float(extents.number[-1])
        if len(named.message):
            keys.setdefault(number, []).append(binaries(part, named.start, named.end))
        if len(values.message):
            n_values[number] = n_values.get(number, 0) + len(values.message)
            some = read_values(part, values.start, values.end)
            if attributes:
                if number not in found:
                    found[number] = ValueFiles()
                found[number].add(some)
    none = Values(np.zeros(0, np.int8), np.zeros(0, U64), pa.array([], pa.large_string()))
    tables: dict[int, tuple[Tables, Values]] = {}
    for number, part, fields in stretches(unpacked(data)):
        features = fields.of(LAYER_FEATURE >> 3, 2)
        if not wanted(number) or not len(features.message):
            continue
        if number not in tables:
            named = pa.concat_arrays(keys.get(number, [pa.array([], pa.binary())]))
            counts = np.array([[len(named), n_values.get(number, 0)]])
            values = found.pop(number).values() if number in found else none
            one = Tables(pa.array([names.get(number, "")], pa.string()), np.array([extent.get(number, float(EXTENT))]), counts, key_slots(named, attributes), len(attributes))
            tables[number] = one, values
        yield feature_columns(part, features, np.zeros(1, np.int64), *tables[number])


def whole_varints(rows: Ragged) -> tuple[np.ndarray, np.ndarray]:
    """Varints of all rows, and the rows' bounds among them; none may go on past its row."""
    ints, ends = read_varints(rows.data)
    bounds = np.searchsorted(ends, rows.offsets, side="right")
    if len(ints) and not np.array_equal(np.concatenate([[0], ends])[bounds], rows.offsets):
        raise BrokenTile("broken tile: a message ends inside a field")
    return ints, bounds


def _slots(data, features: Fields, tags: Fields, tables: Tables, live: np.ndarray) -> list[np.ndarray]:
    """Per attribute, the value number of each live feature. The first match of a name wins (DEC-5)."""
    order = np.argsort(tags.message, kind="stable")  # tags may come in several fields
    size = (tags.end - tags.start)[order]
    pieces = Ragged(data[spans(tags.start[order], size)], offsets_of(size))
    per_feature = np.bincount(tags.message, weights=tags.end - tags.start, minlength=len(features.message)).astype(np.int64)
    ints, bounds = whole_varints(Ragged(pieces.data, offsets_of(per_feature)))
    pairs = np.diff(bounds) // 2  # an odd trailing tag is ignored
    flat = ints[spans(bounds[:-1], pairs * 2)].reshape(-1, 2)
    owner = np.repeat(np.arange(len(features.message)), pairs)
    layer = features.message[owner]
    counts = tables.counts
    first = np.cumsum(counts, axis=0) - counts
    if len(flat) and (flat >= counts[layer].astype(U64)).any():
        raise BrokenTile("broken tile: a tag points behind the end of its layer's tables")
    grid = np.full((int(live.sum()), tables.width), -1, np.int64)
    if len(flat) and tables.width and len(tables.key_slots):
        slots = tables.key_slots[flat[:, 0].astype(np.int64) + first[layer, 0]]
        use = np.flatnonzero((slots >= 0) & live[owner])[::-1]
        row = np.cumsum(live) - 1
        # written back to front, so that the first of several matches is what stays
        grid[row[owner[use]], slots[use]] = flat[use, 1].astype(np.int64) + first[layer[use], 1]
    return list(grid.T)


# --- Geometries --------------------------------------------------------------------------------------------------------


@dataclass
class Parts:
    """Tile-local vertices of features, and the parts (points, lines, rings) that they fall into."""

    xy: np.ndarray
    owner: np.ndarray  # vertex -> feature
    heads: np.ndarray  # part -> first vertex
    sizes: np.ndarray  # part -> vertices
    feature: np.ndarray  # part -> feature


def read_parts(ints: np.ndarray, bounds: np.ndarray) -> Parts:
    """DEC-2 for all features: commands are walked in step, deltas are summed over all of them and taken apart again."""
    pos, end, n = bounds[:-1].astype(np.int64), bounds[1:], len(bounds) - 1
    live, found = np.flatnonzero(pos < end), []
    pos = pos.copy()
    while len(live):
        word = ints[pos[live]]
        command, count = (word & U64(7)).astype(np.int64), (word >> U64(3)).astype(np.int64)
        odd = ~np.isin(command, (MOVE_TO, LINE_TO, CLOSE_PATH))
        if odd.any():
            raise BrokenTile(f"broken tile: {int(command[odd][0])} is no geometry command")
        count[command == CLOSE_PATH] = 0
        behind = pos[live] + 1 + 2 * count
        if (behind > end[live]).any():
            raise BrokenTile("broken tile: a geometry ends inside a command")
        found.append((live, pos[live] + 1, command, count))
        pos[live] = behind
        live = live[behind < end[live]]
    if not found:
        none = np.zeros(0, np.int64)
        return Parts(np.zeros((0, 2), np.int64), none, none, none, none)
    feature, at, command, count = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    feature, at, command, count = feature[order], at[order], command[order], count[order]
    vertex = np.cumsum(count) - count
    total = int(count.sum())
    xy = np.cumsum(unzigzag(ints[spans(at, 2 * count)]).reshape(-1, 2), axis=0)
    owner = np.repeat(feature, count)
    first = offsets_of(np.bincount(owner, minlength=n))[:-1]
    before = np.concatenate([np.zeros((1, 2), np.int64), xy])[first]
    xy = xy - before[owner]
    cut = np.zeros(total + 1, bool)
    moves = command == MOVE_TO
    cut[spans(vertex[moves], count[moves])] = True
    cut[vertex[command == CLOSE_PATH]] = True
    cut[first[owner]] = True
    heads = np.flatnonzero(cut[:total])
    return Parts(xy, owner, heads, np.diff(np.append(heads, total)), owner[heads])


def degrees(xy: np.ndarray, tx, ty, scale, extent) -> np.ndarray:
    lon = (tx + xy[:, 0] / extent) / scale * 360.0 - 180.0
    n = math.pi * (1.0 - 2.0 * (ty + xy[:, 1] / extent) / scale)
    return np.stack([lon, np.degrees(np.arctan(np.sinh(n)))], axis=1)


def heads_of(code: int, counts: np.ndarray) -> Ragged:
    """WKB headers of a code with a count each."""
    raw = np.zeros((len(counts), 9), np.uint8)
    raw[:, 0], raw[:, 1] = 1, code
    raw[:, 5:] = counts.astype("<u4").view(np.uint8).reshape(-1, 4)
    return Ragged.fixed(raw)


def _vertex_rows(xy: np.ndarray) -> Ragged:
    return Ragged.fixed(np.ascontiguousarray(xy, "<f8").view(np.uint8).reshape(-1, 16))


def wkb_column(gtype: np.ndarray, parts: Parts, lonlat: np.ndarray) -> pa.Array:
    """DEC-3 and DEC-4: WKB per feature, null where a feature has no vertex."""
    n = len(gtype)
    kind = gtype[parts.feature]
    made, rows = [], []
    for code, build in ((POINT, _points), (LINE, _lines), (POLYGON, _polygons)):
        mine = np.flatnonzero(kind == code)
        if len(mine):
            used, number = np.unique(parts.feature[mine], return_inverse=True)
            made.append(build(parts, mine, number, len(used), lonlat))
            rows.append(used)
    if not made:
        return pa.nulls(n, pa.binary())
    place = np.full(n, -1, np.int64)
    place[np.concatenate(rows)] = np.arange(sum(map(len, rows)))
    return vconcat(made).to_arrow().take(pa.array(place, mask=place < 0))


def _points(parts: Parts, mine: np.ndarray, number: np.ndarray, n: int, lonlat: np.ndarray) -> Ragged:
    at = spans(parts.heads[mine], parts.sizes[mine])
    counts = np.bincount(np.repeat(number, parts.sizes[mine]), minlength=n)
    raw = np.zeros((len(at), 21), np.uint8)
    raw[:, 0], raw[:, 1] = 1, POINT
    raw[:, 5:] = np.ascontiguousarray(lonlat[at], "<f8").view(np.uint8).reshape(-1, 16)
    members = Ragged.fixed(raw).merge(offsets_of(counts))
    return members if (counts == 1).all() else hstack(heads_of(4, counts).where(counts > 1), members)


def _lines(parts: Parts, mine: np.ndarray, number: np.ndarray, n: int, lonlat: np.ndarray) -> Ragged:
    sizes = parts.sizes[mine]
    xy = _vertex_rows(lonlat[spans(parts.heads[mine], sizes)]).merge(offsets_of(sizes))
    counts = np.bincount(number, minlength=n)
    members = hstack(heads_of(LINE, sizes), xy).merge(offsets_of(counts))
    return members if (counts == 1).all() else hstack(heads_of(5, counts).where(counts > 1), members)


def ring_areas(xy: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Signed areas in double precision; tile coordinates, y down: positive is an exterior ring."""
    at = spans(heads, sizes)
    after = at + 1
    last = np.cumsum(sizes) - 1
    after[last] = heads
    x, y = xy[:, 0].astype(np.float64), xy[:, 1].astype(np.float64)
    cross = x[at] * y[after] - x[after] * y[at]
    return np.add.reduceat(cross, last - sizes + 1) / 2


def _polygons(parts: Parts, mine: np.ndarray, number: np.ndarray, n: int, lonlat: np.ndarray) -> Ragged:
    ring = parts.sizes[mine] >= 3
    mine, number = mine[ring], number[ring]
    heads, sizes = parts.heads[mine], parts.sizes[mine]
    if not len(mine):
        return heads_of(POLYGON, np.zeros(n, np.int64))
    begins = ring_areas(parts.xy, heads, sizes) > 0
    begins[np.searchsorted(number, np.unique(number))] = True  # a feature's first ring, whatever its winding
    open_ring = (parts.xy[heads] != parts.xy[heads + sizes - 1]).any(axis=1)
    full = sizes + open_ring
    at = spans(heads, full)
    at[(np.cumsum(full) - 1)[open_ring]] = heads[open_ring]
    counts = Ragged.fixed(full.astype("<u4").view(np.uint8).reshape(-1, 4))
    rings = hstack(counts, _vertex_rows(lonlat[at]).merge(offsets_of(full)))
    firsts = np.flatnonzero(begins)
    polygons = hstack(heads_of(POLYGON, np.diff(np.append(firsts, len(begins)))), rings.merge(np.append(firsts, len(begins))))
    per_feature = np.bincount(number[firsts], minlength=n)
    members = polygons.merge(offsets_of(per_feature))
    if (per_feature == 1).all():
        return members
    none = heads_of(POLYGON, np.zeros(n, np.int64)).where(per_feature == 0)
    return hstack(none, heads_of(6, per_feature).where(per_feature > 1), members)
