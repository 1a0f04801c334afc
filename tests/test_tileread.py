"""Columnar reading of tiles against a reader that goes field by field."""

from __future__ import annotations

import random
import struct

import numpy as np
import pytest

from sparktiles.functions import tileread
from sparktiles.functions.ragged import Ragged
from sparktiles.operators.decode import decode_rows


def number(v: int) -> bytes:
    return Ragged.varints(np.array([v], np.uint64)).data.tobytes()


def sized(tag: int, body: bytes) -> bytes:
    return bytes([tag]) + number(len(body)) + body


def fields(buf: bytes):
    pos = 0

    def varint() -> int:
        nonlocal pos
        out = shift = 0
        while True:
            byte = buf[pos]
            pos += 1
            out |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return out

    while pos < len(buf):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, wire, varint()
            continue
        size = varint() if wire == 2 else 8 if wire == 1 else 4
        yield tag >> 3, wire, buf[pos : pos + size]
        pos += size


def value_of(buf: bytes) -> object:
    for f, w, v in fields(buf):
        if (f, w) == (1, 2):
            return v.decode("utf-8", "replace")
        if (f, w) == (2, 5):
            return struct.unpack("<f", v)[0]
        if (f, w) == (3, 1):
            return struct.unpack("<d", v)[0]
        if (f, w) == (4, 0):
            return v - (1 << 64) if v >= 1 << 63 else v
        if (f, w) == (5, 0):
            return v
        if (f, w) == (6, 0):
            return (v >> 1) ^ -(v & 1)
        if (f, w) == (7, 0):
            return v != 0
    return None


def numbers(buf: bytes) -> list[int]:
    return [v for _, _, v in fields(b"".join(b"\x00" + b for b in split_varints(buf)))]


def split_varints(buf: bytes) -> list[bytes]:
    out, start = [], 0
    for i, b in enumerate(buf):
        if b < 0x80:
            out.append(buf[start : i + 1])
            start = i + 1
    return out


def read(buf: bytes, wanted: str | None) -> list[tuple]:
    """(layer, extent, fid, type, attributes, commands) of the features of a tile."""
    out = []
    for f, w, layer in fields(buf):
        if (f, w) != (3, 2):
            continue
        name, extent, keys, values, feats = "", 4096, [], [], []
        for g, v, body in fields(layer):
            if (g, v) == (1, 2):
                name = body.decode("utf-8", "replace")
            elif (g, v) == (2, 2):
                feats.append(body)
            elif (g, v) == (3, 2):
                keys.append(body.decode("utf-8", "replace"))
            elif (g, v) == (4, 2):
                values.append(value_of(body))
            elif (g, v) == (5, 0):
                extent = body
        if wanted and name.lower() != wanted.lower():
            continue
        for body in feats:
            fid, tags, kind, geom = None, [], 0, b""
            for h, v, x in fields(body):
                if (h, v) == (1, 0):
                    fid = x
                elif (h, v) == (2, 2):
                    tags += numbers(x)
                elif (h, v) == (3, 0):
                    kind = x
                elif (h, v) == (4, 2):
                    geom = x
            attrs: dict[str, object] = {}
            for k, n in zip(tags[::2], tags[1::2]):
                attrs.setdefault(keys[k].lower(), values[n])
            if geom and kind in (1, 2, 3):
                out.append((name, extent, fid, kind, attrs, numbers(geom)))
    return out


def random_tile(draw: random.Random, odd: bool) -> bytes:
    tile = b""
    for _ in range(draw.randrange(0, 4)):
        n_keys, n_values = draw.randrange(0, 4), draw.randrange(0, 6)
        pieces = [sized(0x0A, draw.choice([b"roads", b"Water", b"\xffbad", b""]))] if draw.random() < 0.9 else []
        pieces += [sized(0x1A, draw.choice([b"name", b"NAME", b"size", b"open", b"k\xff"])) for _ in range(n_keys)]
        for _ in range(n_values):
            v = draw.choice(
                [
                    sized(0x0A, draw.choice([b"text", "Straße".encode(), b"\xfe", b"7.5", b""])),
                    b"\x15" + struct.pack("<f", draw.random()),
                    b"\x19" + struct.pack("<d", draw.random() * 1e9),
                    b"\x20" + number(draw.randrange(1 << 64)),
                    b"\x28" + number(draw.randrange(1 << 64)),
                    b"\x30" + number(draw.randrange(1 << 20)),
                    b"\x38" + bytes([draw.randrange(2)]),
                    b"\x48\x05",
                    b"\x48\x05" + sized(0x0A, b"late"),
                ]
            )
            pieces.append(sized(0x22, v))
        if draw.random() < 0.7:
            pieces.append(b"\x28" + number(draw.choice([256, 4096, 8192])))
        pieces.append(b"\x78\x02")
        if odd and draw.random() < 0.5:
            pieces.append(draw.choice([b"\x68\x01", sized(0x72, b"other"), b"\xf8\x01\x07", b"\x6d" + b"abcd"]))
        for _ in range(draw.choice([0, 1, 3, 30])):
            kind = draw.randrange(0, 5)
            ints: list[int] = []
            for _ in range(draw.randrange(1, 4)):
                if kind == 1:
                    n = draw.randrange(1, 4)
                    ints += [n << 3 | 1] + [draw.randrange(9000) for _ in range(2 * n)]
                else:
                    n = draw.randrange(0, 6)
                    ints += [9, draw.randrange(9000), draw.randrange(9000), n << 3 | 2] + [draw.randrange(900) for _ in range(2 * n)]
                    ints += [15] if kind == 3 else []
            body = b"\x18" + bytes([kind])
            if draw.random() < 0.9:
                body += sized(0x22, b"".join(map(number, ints)))
            if draw.random() < 0.6:
                body = b"\x08" + number(draw.randrange(1 << 40)) + body
            for _ in range(draw.choice([0, 1, 1, 2])):
                if n_keys and n_values:
                    tags = [draw.randrange(n) for _ in range(draw.randrange(3)) for n in (n_keys, n_values)]
                    body += sized(0x12, b"".join(map(number, tags)))
            pieces.append(sized(0x12, body + (b"\x50\x01" if odd and draw.random() < 0.2 else b"")))
        draw.shuffle(pieces)
        tile += sized(0x1A, b"".join(pieces))
        tile += b"\x28\x07" if odd and draw.random() < 0.3 else b""
    return tile


@pytest.mark.parametrize("seed", range(8))
def test_random_tiles(seed):
    draw = random.Random(seed)
    tiles = [random_tile(draw, odd=seed % 2 == 1) for _ in range(40)]
    for wanted in (None, "ROADS"):
        want = [(i, *row) for i, t in enumerate(tiles) for row in read(t, wanted)]
        got = tileread.read_tiles(tiles, ["Name", "size", "open", "absent"], wanted)
        assert got.tile.tolist() == [w[0] for w in want] and got.layer.to_pylist() == [w[1] for w in want]
        assert got.extent.tolist() == [w[2] for w in want] and got.gtype.tolist() == [w[4] for w in want]
        assert [int(f) if h else None for f, h in zip(got.fid, got.has_fid)] == [w[3] for w in want]
        for slot, name in enumerate(["name", "size", "open", "absent"]):
            for n, w in zip(got.slots[slot].tolist(), want):
                assert (None if n < 0 else got.values.one(n)) == w[5].get(name)
        for i, w in enumerate(want):
            assert got.ints[got.bounds[i] : got.bounds[i + 1]].tolist() == w[6]


def wkb_of(kind: int, ints: list[int], zoom: int, x: int, y: int, extent: int) -> bytes | None:
    parts: list[list[tuple[int, int]]] = []
    px = py = pos = 0
    fresh = True
    while pos < len(ints):
        command, count = ints[pos] & 7, ints[pos] >> 3
        pos += 1
        if command == 7:
            fresh = True
            continue
        for _ in range(count):
            px += (ints[pos] >> 1) ^ -(ints[pos] & 1)
            py += (ints[pos + 1] >> 1) ^ -(ints[pos + 1] & 1)
            pos += 2
            if command == 1 or fresh:
                parts.append([])
            fresh = False
            parts[-1].append((px, py))
    if not parts:
        return None
    at = lambda p: struct.pack("<dd", *tileread.degrees(np.array([p]), float(x), float(y), float(1 << zoom), float(extent))[0])
    head = lambda code, n=None: struct.pack("<BI", 1, code) + (b"" if n is None else struct.pack("<I", n))
    line = lambda ps: struct.pack("<I", len(ps)) + b"".join(map(at, ps))
    if kind == 1:
        points = [head(1) + at(p) for part in parts for p in part]
        return points[0] if len(points) == 1 else head(4, len(points)) + b"".join(points)
    if kind == 2:
        lines = [head(2) + line(p) for p in parts]
        return lines[0] if len(lines) == 1 else head(5, len(lines)) + b"".join(lines)
    polygons: list[list[bytes]] = []
    for ring in parts:
        if len(ring) < 3:
            continue
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))
        if area > 0 or not polygons:
            polygons.append([])
        polygons[-1].append(line(ring if ring[0] == ring[-1] else ring + ring[:1]))
    shapes = [head(3, len(p)) + b"".join(p) for p in polygons]
    return head(3, 0) if not shapes else shapes[0] if len(shapes) == 1 else head(6, len(shapes)) + b"".join(shapes)


@pytest.mark.parametrize("seed", range(4))
def test_geometries_as_wkb(seed):
    draw = random.Random(100 + seed)
    tiles = [(5, i % 32, i // 32, random_tile(draw, odd=False)) for i in range(60)]
    want = [(z, x, y, wkb_of(k, ints, z, x, y, extent)) for z, x, y, t in tiles for _, extent, _, k, _, ints in read(t, None)]
    want = [w for w in want if w[3] is not None]
    got = [r for b in decode_rows(iter(tiles), [], None) for r in b.to_pylist()]
    assert [(r["zoom"], r["tile_x"], r["tile_y"], r["geom"]) for r in got] == want and len(want) > 300


def test_values_become_columns():
    layer = sized(0x0A, b"a") + sized(0x1A, b"k")
    for v in (b"\x15" + struct.pack("<f", 0.5), b"\x30\x03", b"\x38\x01", sized(0x0A, b"1e3"), b"\x28" + number((1 << 64) - 1)):
        layer += sized(0x22, v)
    for i in range(5):
        layer += sized(0x12, sized(0x12, bytes([0, i])) + b"\x18\x01" + sized(0x22, b"\x09\x00\x00"))
    layer += sized(0x12, b"\x18\x01" + sized(0x22, b"\x09\x00\x00"))
    rows = lambda kind, strict=True: [r["k"] for b in decode_rows(iter([(0, 0, 0, sized(0x1A, layer))]), [("k", kind)], None, strict) for r in b.to_pylist()]
    assert rows("double") == [0.5, -2.0, 1.0, 1000.0, 2.0**64, None]
    assert rows("string") == ["0.5", "-2", "true", "1e3", str((1 << 64) - 1), None]
    assert rows("boolean", strict=False) == [True, True, True, None, True, None]
    with pytest.raises(ValueError, match="Could not convert"):
        rows("boolean")


def test_one_layer_of_many_features_takes_few_jumps(monkeypatch):
    body = sized(0x12, b"\x18\x01" + sized(0x22, b"\x09\x12\x12"))
    layer = sized(0x0A, b"a") + body * 50_000
    data = np.frombuffer(layer, np.uint8)
    monkeypatch.setattr(tileread, "walk", lambda *a: pytest.fail("walked"))
    got = tileread.layer_fields(data, np.array([0]), np.array([len(data)]))
    assert len(got.message) == 50_001 and (np.diff(got.start[1:]) == len(body)).all()


def test_large_tiles_are_read_in_stretches(monkeypatch):
    """A tile over the bound gives the same rows, a stretch at a time; what is held at once does not grow with it."""
    from sparktiles.functions import mvt
    from sparktiles.operators import decode

    draw = random.Random(11)
    tiles = [(5, i % 32, i // 32, random_tile(draw, odd=i % 2 == 1)) for i in range(40)]
    packed = [(z, x, y, mvt.gzip_tile(t)) for z, x, y, t in tiles]
    for wanted in (None, "roads"):
        plain = [r for b in decode_rows(iter(tiles), [("Name", "string"), ("size", "string")], wanted, False) for r in b.to_pylist()]
        monkeypatch.setattr(decode, "LARGE_BYTES", 0)
        for stretch in (37, 1 << 20):
            monkeypatch.setattr(tileread, "STRETCH_BYTES", stretch)
            for given in (tiles, packed):
                got = [r for b in decode_rows(iter(given), [("Name", "string"), ("size", "string")], wanted, False) for r in b.to_pylist()]
                key = lambda r: (r["tile_y"], r["tile_x"])
                assert sorted(got, key=key) == sorted(plain, key=key)
        monkeypatch.undo()
    body = sized(0x12, b"\x18\x01" + sized(0x22, b"\x09\x12\x12"))
    long = sized(0x1A, sized(0x0A, b"a") + body * 200_000)
    parts = [len(data) for _, data, _ in tileread.stretches(tileread.unpacked(memoryview(mvt.gzip_tile(long))))]
    assert len(parts) > 1 and max(parts) <= 1 << 21
    assert sum(b.num_rows for b in decode_rows(iter([(0, 0, 0, mvt.gzip_tile(long))]), [], None)) == 200_000
    for bad in (long[:-1], sized(0x1A, sized(0x0A, b"a") + body * 200_000 + b"\x12\x7f")):
        with pytest.raises(ValueError, match="ends inside"):
            list(decode_rows(iter([(0, 0, 0, bad)]), [], None))
    with pytest.raises(ValueError, match="truncated"):
        list(decode_rows(iter([(0, 0, 0, mvt.gzip_tile(long)[:-9] + long[:9])]), [], None))


def test_stretches_packed_on_their_own_are_one_file():
    from sparktiles.functions import mvt

    tile, whole = mvt.PackedTile(), b""
    for size in (0, 5, 3_000_000, 17):
        data = np.arange(size, dtype=np.uint32).tobytes()
        tile.append(mvt.PackedBytes(6).add(data[: size // 2]).add(data[size // 2 :]))
        whole += data
    assert mvt.gunzip_tile(bytes(tile.done())) == whole
