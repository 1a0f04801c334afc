"""Vector-tile bytes of a batch of features. Columnar numpy helpers of the encode job; `tileread` has the way back."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .ragged import Ragged, hstack, offsets_of, vconcat

EXTENT = 4096
# Geometry types and commands of the tile format.
POINT, LINE, POLYGON = 1, 2, 3
MOVE_TO, LINE_TO, CLOSE_PATH = 1, 2, 7
# Field tags (number << 3 | wire type).
TILE_LAYER = 0x1A
LAYER_NAME, LAYER_FEATURE, LAYER_KEY, LAYER_VALUE = 0x0A, 0x12, 0x1A, 0x22
LAYER_TAIL = b"\x28\x80\x20\x78\x02"  # extent 4096, version 2
FEATURE_ID, FEATURE_TAGS, FEATURE_TYPE, FEATURE_GEOMETRY = 0x08, 0x12, 0x18, 0x22


def zigzag(v: np.ndarray) -> np.ndarray:
    return ((v << 1) ^ (v >> 63)).astype(np.uint64)


def unzigzag(v: np.ndarray) -> np.ndarray:
    return (v >> np.uint64(1)).astype(np.int64) ^ -(v & np.uint64(1)).astype(np.int64)


# --- Encode ------------------------------------------------------------------------------------------------------------


def geometry_bytes(gtype: np.ndarray, parts: pa.ListArray) -> Ragged:
    """Command streams. `parts` is list<list<int>>: per feature its points, lines or open rings as x0,y0,x1,y1,..."""
    n = len(gtype)
    part_off = parts.offsets.to_numpy().astype(np.int64)
    inner = parts.values
    coord_off = inner.offsets.to_numpy().astype(np.int64)[part_off[0] : part_off[-1] + 1]
    coords = inner.values.to_numpy(zero_copy_only=False)[coord_off[0] : coord_off[-1]].astype(np.int64).reshape(-1, 2)
    part_off, coord_off = part_off - part_off[0], (coord_off - coord_off[0]) // 2
    per_part = np.diff(coord_off)
    n_parts = np.diff(part_off)
    part_feature = np.repeat(np.arange(n), n_parts)
    kind = gtype[part_feature]
    # Integers written per part: points share one MoveTo per feature, lines have two commands, rings three.
    width = 2 * per_part + np.where(kind == POINT, 0, np.where(kind == LINE, 2, 3))
    is_point = gtype == POINT
    width_before = np.concatenate([[0], np.cumsum(width)])
    feature_width = width_before[part_off[1:]] - width_before[part_off[:-1]] + is_point
    base = offsets_of(feature_width)
    # First integer of each part, behind the shared command of a point feature.
    part_base = base[part_feature] + (width_before[:-1] - width_before[part_off[part_feature]]) + (kind == POINT)
    out = np.zeros(base[-1], np.uint64)
    out[base[:-1][is_point]] = (n_parts[is_point] << 3) | MOVE_TO
    shaped = kind != POINT
    out[part_base[shaped]] = (1 << 3) | MOVE_TO
    out[part_base[shaped] + 3] = ((per_part[shaped] - 1) << 3) | LINE_TO
    rings = kind == POLYGON
    out[part_base[rings] + 2 * per_part[rings] + 2] = (1 << 3) | CLOSE_PATH
    # Vertices: deltas from the previous vertex of the same feature.
    prev = np.zeros_like(coords)
    prev[1:] = coords[:-1]
    firsts = coord_off[part_off[:-1][n_parts > 0]]
    prev[firsts[firsts < len(coords)]] = 0
    delta = zigzag(coords - prev)
    part_of = np.repeat(np.arange(len(per_part)), per_part)
    k = np.arange(len(coords)) - np.repeat(coord_off[:-1], per_part)
    at = part_base[part_of] + 2 * k + np.where(kind[part_of] == POINT, 0, np.where(k == 0, 1, 2))
    out[at], out[at + 1] = delta[:, 0], delta[:, 1]
    return Ragged.varints(out).merge(base)


def point_bytes(px: np.ndarray, py: np.ndarray) -> Ragged:
    """Command streams of single points."""
    ints = np.stack([np.full(len(px), (1 << 3) | MOVE_TO, np.uint64), zigzag(px), zigzag(py)], axis=1)
    return Ragged.varints(ints.reshape(-1)).merge(np.arange(len(px) + 1) * 3)


def value_bytes(values: pa.Array) -> Ragged:
    """Value messages of distinct, non-null property values."""
    t = values.type
    if pa.types.is_boolean(t):
        flags = values.cast(pa.uint8()).to_numpy()
        return Ragged.fixed(np.stack([np.full(len(flags), 0x38, np.uint8), flags], axis=1))
    if pa.types.is_integer(t):
        v = values.cast(pa.int64()).to_numpy()
        neg = v < 0
        tags = np.where(neg, 0x30, 0x20).astype(np.uint8).reshape(-1, 1)
        return hstack(Ragged.fixed(tags), Ragged.varints(np.where(neg, zigzag(v), v.astype(np.uint64))))
    if pa.types.is_floating(t):
        raw = values.cast(pa.float64()).to_numpy().astype("<f8").view(np.uint8).reshape(-1, 8)
        return Ragged.fixed(np.concatenate([np.full((len(raw), 1), 0x19, np.uint8), raw], axis=1))
    return Ragged.from_arrow(values).field(0x0A)


def attribute_tables(
    group: np.ndarray, n_groups: int, props: list[pa.Array], pieces: np.ndarray, piece: np.ndarray
) -> tuple[Ragged, Ragged, np.ndarray]:
    """Tags per feature, the distinct values, and how many values each group has.

    A value's number is `local * pieces + piece`, so the pieces of a split tile never share a number and their tables
    interleave into one.
    """
    n, width = len(group), len(props)
    index = np.full((n, width), -1, np.int64)
    entries, messages = [], []
    for c, arr in enumerate(props):
        enc = pc.dictionary_encode(arr)
        if isinstance(enc, pa.ChunkedArray):
            enc = enc.combine_chunks()
        if len(enc.dictionary) == 0:
            continue
        rows = np.flatnonzero(enc.is_valid().to_numpy(zero_copy_only=False))
        codes = enc.indices.drop_null().to_numpy().astype(np.int64)
        uniq, inverse = np.unique(group[rows] * len(enc.dictionary) + codes, return_inverse=True)
        index[rows, c] = inverse + sum(len(e) for e in entries)
        entries.append(uniq // len(enc.dictionary))
        messages.append(value_bytes(enc.dictionary).take(uniq % len(enc.dictionary)))
    owner = np.concatenate(entries) if entries else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=n_groups)
    local = np.empty(len(owner), np.int64)
    local[order] = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    values = vconcat(messages).take(order) if messages else Ragged(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    present = index >= 0
    number = np.where(present, local[index] if len(local) else 0, 0) * pieces[:, None] + piece[:, None]
    pairs = np.stack([np.broadcast_to(np.arange(width), (n, width)), number], axis=2)
    tags = Ragged.varints(pairs[present].reshape(-1)).merge(offsets_of(2 * present.sum(axis=1)))
    return tags, values, counts


def feature_bytes(fid: pa.Array, tags: Ragged, gtype: np.ndarray, geometry: Ragged) -> Ragged:
    n = len(gtype)
    has_id = fid.is_valid().to_numpy(zero_copy_only=False)
    ids = hstack(Ragged.constant(bytes([FEATURE_ID]), n), Ragged.varints(fid.fill_null(0).to_numpy())).where(has_id)
    kinds = Ragged.fixed(np.stack([np.full(n, FEATURE_TYPE), gtype], axis=1).astype(np.uint8))
    body = hstack(ids, tags.field(FEATURE_TAGS).where(tags.lengths > 0), kinds, geometry.field(FEATURE_GEOMETRY))
    return body.field(LAYER_FEATURE)


def layer_bytes(name: Ragged, features: Ragged, keys: list[str], values: Ragged) -> Ragged:
    """Layer messages; `values` are already fields, joined per layer."""
    n = len(name)
    key_fields = Ragged.of([k.encode() for k in keys]).field(LAYER_KEY).data.tobytes() if keys else b""
    body = hstack(
        name.field(LAYER_NAME), features, Ragged.constant(key_fields, n), values, Ragged.constant(LAYER_TAIL, n)
    )
    return body.field(TILE_LAYER)


def layer_front(name: str, keys: list[str], features: int, values: int) -> tuple[bytes, bytes]:
    """What stands in a layer message before its features, and between them and its values, by the bytes that either take."""
    named = Ragged.of([name.encode()]).field(LAYER_NAME).data.tobytes()
    key_fields = Ragged.of([k.encode() for k in keys]).field(LAYER_KEY).data.tobytes() if keys else b""
    size = len(named) + features + len(key_fields) + values + len(LAYER_TAIL)
    return bytes([TILE_LAYER]) + Ragged.varints(np.array([size])).data.tobytes() + named, key_fields


class PackedBytes:
    """Bytes packed as they come, into blocks that refer to nothing before them, so that they can be put behind any others."""

    def __init__(self, level: int):
        self.packer, self.out, self.size, self.crc = zlib.compressobj(level, zlib.DEFLATED, -15), bytearray(), 0, 0

    def add(self, data: bytes | np.ndarray) -> PackedBytes:
        view = memoryview(data).cast("B") if len(data) else b""
        self.out += self.packer.compress(view)
        self.size, self.crc = self.size + len(view), zlib.crc32(view, self.crc)
        return self


class PackedTile:
    """One gzip file of stretches that were packed on their own."""

    ZEROS = bytes(1 << 20)

    def __init__(self):
        self.out, self.size, self.crc = bytearray(b"\x1f\x8b\x08\0\0\0\0\0\0\x03"), 0, 0

    def append(self, part: PackedBytes) -> None:
        part.out += part.packer.flush(zlib.Z_FULL_FLUSH)
        self.out += part.out
        # The checksum of both: that of the first moved on by as many zeros as the second has bytes, and what the zeros add taken off.
        moved, zeros = self.crc, 0
        for low in range(0, part.size, len(self.ZEROS)):
            block = memoryview(self.ZEROS)[: part.size - low]
            moved, zeros = zlib.crc32(block, moved), zlib.crc32(block, zeros)
        self.size, self.crc = self.size + part.size, moved ^ zeros ^ part.crc

    def done(self) -> bytearray:
        self.out += b"\x03\0" + struct.pack("<II", self.crc, self.size & 0xFFFFFFFF)
        return self.out


def gzip_tile(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


# --- Decode ------------------------------------------------------------------------------------------------------------


def unpacked_size(data: memoryview) -> int:
    """How many bytes a tile has without its packing, or takes up with it, if that is more."""
    if len(data) < 18 or bytes(data[:2]) != b"\x1f\x8b":
        return len(data)
    stated = int.from_bytes(data[-4:], "little")  # modulo 2^32; zero is an empty tile
    return max(stated, len(data)) if stated else 0


def gunzip_tile(data: bytes) -> bytes:
    """SRC-11: what is not gzip passes through; a stored size of zero is an empty tile."""
    if len(data) < 18 or data[:2] != b"\x1f\x8b":
        return data
    if data[-4:] == b"\0\0\0\0":
        return b""
    try:
        return zlib.decompress(data, 31)
    except zlib.error as e:
        raise ValueError(f"broken tile: its gzip data cannot be unpacked ({e})") from None
